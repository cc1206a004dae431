"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

from __future__ import annotations

from tessera.llm import quality

_WORDS = r"list_filter(string_split_regex({0}, '[ \t-\r]+'), lambda w: w <> '')"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _windows(words: str, k: int) -> str:
    return f"list_transform(range(1, len({words}) - {k - 2}), lambda i: array_to_string({words}[i:i + {k - 1}], ' '))"


JACCARD = f"""with recursive d as (select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), {_AZ})")} as w from documents),
  s as (select doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN ['short ' || array_to_string(w, ' ')] ELSE {_windows('w', 5)} END) as s from d),
  t as (select doc_id, len(s) as n, unnest(s) as x from s),
  c as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as o from t a join t b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
  l as (select a, b from c where 100 * o >= 80 * (n + m - o)),
  e as (select a, b from l union all select b, a from l),
  r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
  select doc_id, len(s)::bigint as n_shingles, least(doc_id, coalesce((select min(b) from r where a = doc_id), doc_id)) as component_id from s"""


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = rf"""(?:{'|'.join(_either(w) for w in ('password', 'passwd', 'secret', 'token'))}|{_either('api')}_?{_either('key')})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_USER = rf"""(?:{_either('user')}(?:{_either('name')})?|{_either('login')}|{_either('client')}_?{_either('id')}|{_either('account')}(?:_?{_either('id')})?)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9._@+-]{{3,}}"""
_KINDS = (
    ("assign", _ASSIGN, "s"), ("access", "AKIA[A-Z0-9]{16,}", "i"), ("hex", "[0-9a-f]{24,}", "s"),
    ("user", _USER, "i"), ("blob", "[A-Za-z0-9+/]{40,}", "s"), ("endpoint", "https?://[A-Za-z0-9.-]+[A-Za-z0-9/_.:-]*", "e"),
)
_FOUND = " union all ".join(
    f"select r, {i} as k, '{name}' as name, '{role}' as role, regexp_extract_all(t, '{rx}') as f, regexp_extract_all(t, '{rx}', {1 if name == 'assign' else 0}) as g, string_split_regex(t, '{rx}') as p from d" for i, (name, rx, role) in enumerate(_KINDS)
)
SECRETS = f"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents), m as ({_FOUND}),
  x as (select r, k, name, role, f[i] as v, g[i] as g, list_sum(list_transform(p[1:i], lambda z: len(z))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda z: len(z))), 0) as start
    from (select *, unnest(range(1, len(f) + 1)) as i from m where len(f) > 0)),
  y as (select r, k, name, role, start::bigint as s, (start + len(v))::bigint as e from x where CASE name WHEN 'assign' THEN len(g) >= 6 WHEN 'blob' THEN regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Z]') and regexp_matches(v, '[a-z]') ELSE true END),
  z as (select *, k < 3 or CASE role WHEN 'i' THEN has_s WHEN 's' THEN has_i ELSE has_s and has_i END as shown from (select *,
    exists (select 1 from y b where b.r = y.r and b.role = 'i' and abs(b.s - y.s) <= 200) as has_i, exists (select 1 from y b where b.r = y.r and b.role = 's' and abs(b.s - y.s) <= 200) as has_s,
    (select arg_min(b.s, 2 * abs(b.s - y.s) + (b.s > y.s)::int) from y b where b.r = y.r and b.role = 'i' and abs(b.s - y.s) <= 200) as i_at, (select arg_min(b.s, 2 * abs(b.s - y.s) + (b.s > y.s)::int) from y b where b.r = y.r and b.role = 's' and abs(b.s - y.s) <= 200) as s_at from y)),
  a as (select r, count(*) filter (where k = 0) as n0, count(*) filter (where k = 1) as n1, count(*) filter (where k = 2) as n2, count(*) filter (where k > 2) as n3,
    string_agg(name || ':' || s || ':' || e, ',' order by s, k) filter (where k < 3) as base, string_agg(name || ':' || s || ':' || e, ',' order by s, k) as spans,
    string_agg(name || ':' || s || ':' || i_at || ':' || s_at, ',' order by s, k) filter (where k > 2) as links from z where shown group by r)
  select doc_id, coalesce(n0, 0) as n_assign, coalesce(n1, 0) as n_access, coalesce(n2, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n3, 0) as n_linked, coalesce(links, '') as links from d left join a using (r)"""

_NIBBLE = "(instr('0123456789abcdef', substr(h, 5 * (j // 4) + {0}, 1)) - 1)"
_GROUP = " + ".join(f"{_NIBBLE.format(i + 1)} * {16 ** (4 - i)}" for i in range(5))
WARC = f"""with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages), k as (select h, max(page_id) as keep from p group by 1),
  q as (select *, array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((({_GROUP})::bigint >> (15 - 5 * (j % 4))::bigint) & 31) + 1)::bigint, 1)), '') as digest from p join k using (h))
  select page_id, octet_length(encode(t))::bigint as payload_bytes, digest as payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END as record_type, CASE WHEN page_id <> keep THEN keep END as refers_to from q"""

_RATIOS = {"symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeats": "n_repeat_words", "word_length": "word_chars"}
_LIMITS = ", ".join(f"quantile_disc({c} / nullif(n_words, 0), 0.25) as {m}1, quantile_disc({c} / nullif(n_words, 0), 0.75) as {m}3" for m, c in _RATIOS.items())
_CHOSEN = ", ".join(f"CASE WHEN o.n >= {quality.LEAST} THEN o.{m}{q} WHEN l.n >= {quality.LEAST} THEN l.{m}{q} ELSE a.{m}{q} END as {m}{q}" for m in _RATIOS for q in (1, 3))
_INSIDE = " and ".join(f"coalesce({c} / nullif(n_words, 0) between {m}1 - {quality.REACH} * greatest({m}3 - {m}1, {quality.MEASURES[m]}) and {m}3 + {quality.REACH} * greatest({m}3 - {m}1, {quality.MEASURES[m]}), true)" for m, c in _RATIOS.items())
QUALITY = rf"""with d as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t, {_WORDS.format("coalesce(text, '')")} as w from documents),
  g as (select r, unnest({_windows('w', 5)}) as x, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5),
  c as (select r, count(distinct i + j) as n from (select r, i from (select *, count(*) over (partition by r, x) as k from g) where k > 1), range(0, 5) u(j) group by 1),
  b as (select d.r, doc_id, lang, source, len(w)::bigint as n_words, len(array_to_string(w, ''))::bigint as word_chars, (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')))))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
    from d left join c using (r)),
  o as (select lang, source, count(*) as n, {_LIMITS} from b group by 1, 2), l as (select lang, count(*) as n, {_LIMITS} from b group by 1), a as (select {_LIMITS} from b),
  q as (select o.lang, o.source, {_CHOSEN} from o join l on o.lang is not distinct from l.lang, a)
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed,
    not (n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words) and {_INSIDE} as kept
  from b join q on b.lang is not distinct from q.lang and b.source is not distinct from q.source"""

LINES = rf"""with p as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos from documents where text is not null),
  q as (select *, row_number() over (order by doc_id, pos) as o from p where regexp_matches(line, '[^ \t-\r]')), f as (select line, min(o) as first from q group by 1),
  s as (select first, list_distinct({_WORDS.format('lower(line)')}) as s from f),
  t as (select first, len(s) as n, unnest(s) as x from s),
  c as (select a.first as later, any_value(a.n) as n, any_value(b.n) as m, count(*) as k from t a join t b on a.x = b.x and b.first < a.first group by a.first, b.first),
  g as (select distinct later from c where 100 * k >= 80 * (n + m - k)),
  r as (select doc_id, pos from q join f using (line) where o <> first or first in (select later from g)),
  z as (select doc_id, count(*) as n, string_agg(pos::varchar, ',' order by pos) as removed from r group by 1)
  select doc_id, CASE WHEN text is null THEN 0 ELSE len(string_split(text, chr(10))) END::bigint as n_lines, coalesce(n, 0)::bigint as n_removed, coalesce(removed, '') as removed from documents left join z using (doc_id)"""


def _spans(condition: str, name: str) -> str:
    """Unions of 50-word windows that start where the condition holds."""
    return f"""{name} as (select doc_id, min(i) - 1 as a, max(i) + 49 as b from (select doc_id, i, sum(new) over (partition by doc_id order by i) as run from
      (select doc_id, i, CASE WHEN i - lag(i) over (partition by doc_id order by i) <= 50 THEN 0 ELSE 1 END as new from h where {condition})) group by doc_id, run)"""


REPEATS = f"""with d as (select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), {_AZ})")} as w from documents),
  g as (select doc_id, unnest(list_transform({_windows('w', 50)}, lambda z: md5(z))) as x, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50),
  k as (select x, min(doc_id) as lo, max(doc_id) as hi from g group by 1 having min(doc_id) < max(doc_id)), h as (select doc_id, i, lo from g join k using (x)),
  {_spans('true', 's')}, {_spans('lo < doc_id', 't')},
  u as (select doc_id, sum(b - a) as n, string_agg(a || ':' || b, ',' order by a) as spans from s group by 1), v as (select doc_id, sum(b - a) as m from t group by 1)
  select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_repeated_words, coalesce(m, 0)::bigint as n_later_words, coalesce(spans, '') as spans from d left join u using (doc_id) left join v using (doc_id)"""

AUDIT = rf"""with t as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents), w as (select *, {_WORDS.format('t')} as w from t),
  l as (select doc_id, coalesce(max(quality), 0) = 1 as good, coalesce(max(toxic), 0) = 1 as toxic from labels group by 1),
  f as (select part, good, toxic, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) over (partition by t) THEN 'E' ELSE '' END as f from w left join l using (doc_id)),
  c as (select part, f, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from f group by 1, 2),
  x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x), o as (select a.x || b.x || c.x || d.x || e.x as o from x a, x b, x c, x d, x e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
  s as (select o, unnest(range(1, 6))::int as step from o), q as (select o, step, substr(o, step, 1) as x from s),
  p as (select c.*, o, step, x, coalesce(list_min(list_transform(string_split(nullif(f, ''), ''), lambda z: instr(o, z))), 9) as pos from c, q),
  r as (select part, o, step, x, coalesce(sum(n) filter (where pos > step), 0) as kept, coalesce(sum(n) filter (where pos = step), 0) as removed, coalesce(sum(n) filter (where pos < step and contains(f, x)), 0) as redundant,
    coalesce(sum(n) filter (where f = x), 0) as unique_fails, coalesce(sum(good) filter (where pos = step), 0) as good_lost, coalesce(sum(toxic) filter (where pos = step), 0) as toxic_lost from p group by 1, 2, 3, 4)
  select part, o as filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, x))::bigint as shapley from r"""

_TERMS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH = f"""with d as (select row_number() over () as r, doc_id, {_TERMS.format('text')} as w from documents), s as (select count(*) as n_docs, sum(len(w)) as n_terms from d where len(w) > 0),
  i as (select item_id, x, count(*) as times from (select item_id, unnest({_TERMS.format('text')}) as x from benchmark) group by 1, 2),
  p as (select r, any_value(doc_id) as doc_id, any_value(n) as n, x, count(*) as tf from (select r, doc_id, len(w) as n, unnest(w) as x from d) where x in (select x from i) group by r, x),
  w as (select x, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, s group by x, n_docs),
  m as (select r, doc_id, x, tf::bigint as tf, (75 + (25 * n * n_docs) // n_terms)::bigint as m from p, s),
  c as (select item_id, r, any_value(doc_id) as doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score from i join m using (x) join w using (x) group by item_id, r)
  select * from (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from c where score > 0) where rank <= 20"""

ORACLES = {
    "op2_jaccard_components": JACCARD,
    "op3_secret_scan": SECRETS,
    "op5_warc_round_trip": WARC,
    "op7_quality_rules": QUALITY,
    "op9_line_dedup": LINES,
    "op10_suffix_repeats": REPEATS,
    "op11_filter_audit": AUDIT,
    "op12_ranked_search": SEARCH,
}
