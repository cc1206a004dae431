"""A query for each operator over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.functions import vocabulary as V
from tessera.operators import graph as G
from tessera.operators import matching as M
from tessera.operators import order as O
from tessera.operators import relational as R
from tessera.operators import sequential as Q
from tessera.operators import spatial as P
from tessera.plans.pattern_query import run_query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(column: str, pairs: dict[str, str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items()) + f" ELSE {other} END"


def normalised_sql(c: str) -> str:
    bare = rf"regexp_replace(array_to_string(regexp_extract_all(lower(replace({c}, '&', 'and')), '[a-z0-9]+'), ' '), '{X.suffix_pattern()}', '')"
    return f"coalesce(array_to_string(list_transform(string_split({bare}, ' '), lambda w: {_case('w', V.WORD_SPELLINGS, 'w')}), ' '), '')"


_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda t: t <> ''))"
_ENDINGS = (" Pty Ltd", " Resources Limited", " & Sons Group", " Minerals Australia", " S.A.C.", " Holdings Inc", "")


def ending(c, n):  # noqa: ANN001, ANN201
    """The column with one of a few endings, chosen by a number."""
    out = F.lit("")
    for i, e in enumerate(_ENDINGS):
        out = F.when(F.pmod(n, F.lit(len(_ENDINGS))) == i, e).otherwise(out)
    return F.concat(c, out)


def ending_sql(c: str, n: str) -> str:
    return f"{c} || CASE {n} % {len(_ENDINGS)} " + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(_ENDINGS)) + " END"


# -- names ------------------------------------------------------------------------
@query(f"select p_partkey, {normalised_sql(ending_sql('p_name', 'p_partkey'))} as norm from part")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", X.normalize_name(ending(F.col("p_name"), F.col("p_partkey"))).alias("norm"))


@query("select lower(trim(p_type)) in ('minerals', 'mining corp') or p_brand = 'x' as dirty, count(*) as n from part group by 1")
def dirty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(X.is_dirty("p_type").alias("dirty")).agg(F.count(F.lit(1)).alias("n"))


_PAIRS = f"""names as (select distinct p_name as name from part), idx as (select distinct unnest({_WORDS.format('name')}) as token, name from names),
  pairs as (select distinct a.name as l, b.name as r from idx a join idx b using (token))"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()


@query(f"with {_PAIRS} select token, count(*) as names from idx group by token")
def token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.token_index(_names(spark, sf_dir), "name").groupBy("token").agg(F.count(F.lit(1)).alias("names"))


@query(f"with {_PAIRS} select l, r from pairs")
def token_block_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _names(spark, sf_dir)
    return M.token_pairs(names, names, "name", "name")


_JACCARD = f"len(list_intersect({_WORDS.format('l')}, {_WORDS.format('r')}))::double / len(list_distinct(list_concat({_WORDS.format('l')}, {_WORDS.format('r')})))"


@query(f"""with {_PAIRS}, scored as (select l, r, round({_JACCARD}, 9) as jaccard from pairs where l <> r)
  select l, r, jaccard from (select *, row_number() over (partition by l order by jaccard desc, r) as k from scored) where k = 1""")
def best_name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part name, the other name with the best word Jaccard."""
    names = _names(spark, sf_dir)
    best = M.best_jaccard(M.token_pairs(names, names, "name", "name").filter("l <> r"))
    return best.select("l", "r", F.round("jaccard", 9).alias("jaccard"))


#: The row of the subsequence table, letter by letter; all in one list expression.
_LCS = """list_reduce(string_split(l, ''), lambda row, c: list_reduce(range(1, len(r) + 1), lambda done, j: list_append(done,
  CASE WHEN substr(r, j, 1) = c THEN greatest(row[j] + 1, row[j + 1], done[len(done)]) ELSE greatest(row[j + 1], done[len(done)]) END), [0::bigint]), list_transform(range(0, len(r) + 1), lambda x: 0::bigint))"""


@query(f"""with {_PAIRS}, lcs as (select l, r, {_LCS} as t from pairs)
  select l, r, round(200.0::double * t[len(t)] / (len(l) + len(r)), 6) as ratio from lcs""")
def indel_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _names(spark, sf_dir)
    return M.token_pairs(names, names, "name", "name").withColumn("ratio", F.round(S.indel_ratio_udf("l", "r"), 6))


_SORTED = "array_to_string(list_sort({0}), ' ')"
_GRAMS = "list_distinct(list_transform(range(1, greatest(len({0}), 1) + 1), lambda i: substr(' ' || {0} || ' ', i, 3)))"
#: The weighted ratio in full: every pair of texts whose subsequence it needs, once, then the ratios from their lengths.
def _status_sql(low: int, high: int, vector: str, more: str = "", joined: str = "") -> str:
    return f"""with part_names as (select distinct p_name as n, {ending_sql('p_name', 'p_partkey')} as o from part),
  left_names as (select distinct {normalised_sql('n')} as l from part_names where {normalised_sql('n')} <> ''), right_names as (select distinct {normalised_sql('o')} as r from part_names where {normalised_sql('o')} <> ''),
  lt as (select l, unnest({_WORDS.format('l')}) as token from left_names), rt as (select r, unnest({_WORDS.format('r')}) as token from right_names),
  pairs as (select distinct l, r from lt join rt using (token) where greatest(len(l), len(r)) <= 8 * least(len(l), len(r))),
  w as (select l, r, {_WORDS.format('l')} as a, {_WORDS.format('r')} as b, greatest(len(l), len(r)) / least(len(l), len(r)) >= 1.5 as far, CASE WHEN len(l) <= len(r) THEN l ELSE r END as s, CASE WHEN len(l) <= len(r) THEN r ELSE l END as g from pairs),
  c as (select l, r, far, s, g, {_SORTED.format("string_split(l, ' ')")} as ls, {_SORTED.format("string_split(r, ' ')")} as rs, {_SORTED.format('list_intersect(a, b)')} as common,
    {_SORTED.format('list_filter(a, lambda x: not list_contains(b, x))')} as x, {_SORTED.format('list_filter(b, lambda y: not list_contains(a, y))')} as y from w),
  e as (select l, r, s, unnest(list_transform(range(1, len(g) + len(s)), lambda z: substr(g, greatest(0, z - len(s)) + 1, least(z, len(g)) - greatest(0, z - len(s))))) as v from c where far),
  asked as (select l, r from c union select ls, rs from c where not far union select x, y from c where not far and x <> '' and y <> '' union select s, v from e),
  lcs as (select l as p, r as q, t[len(t)] as n from (select l, r, {_LCS} as t from asked)),
  part_ratio as (select e.l, e.r, max(200.0::double * n / (len(s) + len(v))) as ratio from e join lcs on p = s and q = v group by 1, 2),
  ratios as (select c.*, 200.0::double * k.n / (len(c.l) + len(c.r)) as whole, 200.0::double * o.n / (len(ls) + len(rs)) as by_token, len(common) + 1 + len(x) as nx, len(common) + 1 + len(y) as ny, len(x) + len(y) - 2 * d.n as apart, h.ratio as part
    from c join lcs k on k.p = c.l and k.q = c.r left join lcs o on not far and o.p = ls and o.q = rs left join lcs d on d.p = x and d.q = y left join part_ratio h on h.l = c.l and h.r = c.r),
  scored as (select l, r, whole, CASE WHEN far THEN greatest(whole, 0.9::double * part, 0.95::double * 0.9::double * 100.0::double) ELSE greatest(whole, 0.95::double * greatest(by_token, CASE WHEN x = '' or y = '' THEN 100.0::double
    ELSE greatest(100.0::double * (1 - apart::double / (nx + ny)), 100.0::double * (1 - (1 + len(x))::double / (len(common) + nx)), 100.0::double * (1 - (1 + len(y))::double / (len(common) + ny))) END)) END as ratio from ratios),
  best as (select l, r, ratio, whole from (select *, row_number() over (partition by l order by ratio desc, whole desc, r) as k from scored where ratio >= 80) where k = 1),{more}
  f as (select l, r, round(ratio, 6) as w_ratio, round(whole, 6) as levenshtein_ratio, round({_JACCARD}, 6) as jaccard_similarity,
    CASE WHEN ratio >= {low} and ratio < {high} THEN round({vector}, 6) ELSE 0 END as vector_similarity,
    (replace(l, ' ', '') = replace(r, ' ', ''))::int as no_space_exact_match, CASE WHEN {normalised_sql('l')} like '% au' THEN (left({normalised_sql('l')}, len({normalised_sql('l')}) - 3) = {normalised_sql('r')})::int ELSE 0 END as au_removed_match from best {joined})
  select left_names.l, f.* exclude (l), CASE WHEN r is null THEN 'no_candidate_found' WHEN no_space_exact_match = 1 THEN 'no_space_exact_match' WHEN au_removed_match = 1 THEN 'au_removed_match'
    WHEN w_ratio >= 95 and levenshtein_ratio >= 90 and jaccard_similarity >= 0.5 and vector_similarity >= 0.5 THEN 'confident_score_match' ELSE 'low_confidence' END as status from left_names left join f using (l)"""


_STATUS = _status_sql(95, 100, f"len(list_intersect({_GRAMS.format('l')}, {_GRAMS.format('r')})) / sqrt(len({_GRAMS.format('l')})::double * len({_GRAMS.format('r')}))")


@query(_STATUS)
def match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six scores and the status of the best candidate, names of parts against the same names with endings."""
    part = table(spark, sf_dir, "part").withColumn("other", ending(F.col("p_name"), F.col("p_partkey")))
    left = M.prepared(part, "p_name", "p_partkey")
    right = M.prepared(part, "other", "p_partkey")
    return M.match(left, right).withColumns({c: F.round(c, 6) for c in ("w_ratio", "levenshtein_ratio", "jaccard_similarity", "vector_similarity")})


_MEANS = """
  word_vectors as (select word, embedding from (select word, row_number() over (order by word) as k from (select token as word from lt union select token from rt)) join embeddings on vec_id = k where k % 5 <> 0),
  spread as (select name, len(ws) as n, unnest(ws) as word from (select name, list_filter(string_split(name, ' '), lambda z: z <> '') as ws from (select l as name from left_names union select r from right_names))),
  sums as (select name, d, sum(embedding[d]::double) / max(n) as m from (select *, unnest(range(1, len(embedding) + 1)) as d from spread join word_vectors using (word)) group by 1, 2),
  means as (select name, list(m order by d) as v from sums group by 1),"""
_COSINE = "coalesce(list_dot_product(p.v, q.v) / nullif(sqrt(list_dot_product(p.v, p.v)) * sqrt(list_dot_product(q.v, q.v)), 0), 0)"


@query(_status_sql(80, 101, _COSINE, _MEANS, "left join means p on p.name = l left join means q on q.name = r"))
def match_word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As match_status, with a table of word vectors in place of trigrams; every fifth word has none."""
    part = table(spark, sf_dir, "part").withColumn("other", ending(F.col("p_name"), F.col("p_partkey")))
    left, right = M.prepared(part, "p_name", "p_partkey"), M.prepared(part, "other", "p_partkey")
    words = left.select("norm").unionByName(right.select("norm")).select(F.explode(S.word_set("norm")).alias("word")).distinct()
    numbered = O.dense_ids(words, ["word"], alias="vec_id").filter("vec_id % 5 <> 0")
    vectors = numbered.join(table(spark, sf_dir, "embeddings"), "vec_id").select("word", F.col("embedding").alias("vector"))
    return M.match(left, right, vector=vectors, vector_gate=(80.0, 101.0)).withColumns({c: F.round(c, 6) for c in ("w_ratio", "levenshtein_ratio", "jaccard_similarity", "vector_similarity")})


@query(f"""with n as (select distinct {normalised_sql(ending_sql('p_name', 'p_partkey'))} as a, lower(p_name) as b from part)
  select a, b, (replace(a, ' ', '') = replace(b, ' ', ''))::int as no_space,
    CASE WHEN a like '% au' THEN (left(a, len(a) - 3) = {normalised_sql('b')})::int ELSE 0 END as no_au from n""")
def name_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    n = part.select(X.normalize_name(ending(F.col("p_name"), F.col("p_partkey"))).alias("a"), F.lower("p_name").alias("b")).distinct()
    return n.withColumn("no_space", S.same_without_spaces("a", "b")).withColumn("no_au", S.same_without_au("a", "b"))


def _good(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    return M.best_jaccard(M.token_pairs(left, right, a, b)).filter("jaccard >= 0.3").select("l", "r", F.round("jaccard", 9).alias("jaccard"))


def _stage_sql(n: int) -> str:
    names = " ".join(f"and name not in (select l from m{i})" for i in range(n))
    return f"""t{n} as (select distinct p_name as name from part where p_size % 3 = {n}),
      i{n} as (select distinct unnest({_WORDS.format('name')}) as token, name from t{n}),
      p{n} as (select distinct a.name as l, b.name as r from idx a join i{n} b using (token) where true {names.replace('name not', 'a.name not')}),
      s{n} as (select l, r, round({_JACCARD}, 9) as jaccard from p{n}),
      m{n} as (select l, r, jaccard, 's{n}' as matched_source from (select *, row_number() over (partition by l order by jaccard desc, r) as k from s{n} where jaccard > 0) where k = 1 and jaccard >= 0.3)"""


@query(f"""with {_PAIRS}, {_stage_sql(0)}, {_stage_sql(1)}, {_stage_sql(2)}, found as (select * from m0 union all select * from m1 union all select * from m2)
  select * from found union all select name, null, null, null from names where name not in (select l from found)""")
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part name's match in the first of three sources that has a good one; all parts are dealt to the sources."""
    part = table(spark, sf_dir, "part")
    sources = [(f"s{n}", part.filter(F.col("p_size") % 3 == n).select(F.col("p_name").alias("other")).distinct(), "other") for n in range(3)]
    return M.cascade(_names(spark, sf_dir), "name", sources, _good)


# -- enrich and append ----------------------------------------------------------------
@query("""select n_nationkey as nation, n_name, s.total, 'nation' as source from nation left join (select s_nationkey, round(sum(s_acctbal), 2) as total from supplier group by 1) s on n_nationkey = s_nationkey
  union all select distinct c_nationkey, null, null, 'customer' from customer where c_nationkey not in (select n_nationkey from nation)""")
def enrich_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_name", F.lit("nation").alias("source"))
    totals = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.round(F.sum("s_acctbal"), 2).alias("total"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    return R.append_unmatched(R.enrich(nation, totals, "nation"), customers, "nation", "source", "customer").select("nation", "n_name", "total", "source")


# -- order ---------------------------------------------------------------------------
@query("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey) as k from orders) where k = 1")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("select c_custkey, 'comp_' || row_number() over (order by c_mktsegment, c_custkey) as id from customer")
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.dense_ids(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"], "comp_").select("c_custkey", "id")


@query("select user_id, arg_max(event_type, event_id) as last_type, arg_min(event_type, event_id) as first_type from events group by 1")
def last_and_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return O.last_wins(events, ["user_id"], "event_type", "event_id", "last_type").join(O.first_wins(events, ["user_id"], "event_type", "event_id", "first_type"), "user_id")


@query("""with u as (select o_custkey as k, o_orderkey as ord, 0 as src from orders union all select c_custkey, c_custkey, 1 from customer union all select l_partkey, l_orderkey * 10 + l_linenumber, 2 from lineitem)
  select k, ord, src from (select *, row_number() over (partition by k order by src, ord) as n from u) where n = 1""")
def union_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"), F.lit(0).alias("src"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").alias("ord"), F.lit(1).alias("src"))
    c = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.lit(2).alias("src"))
    return O.union_keep_first([a, b, c], "k", "ord")


@query("""with u as (select s_nationkey as k, s_suppkey as v, 0 as src from supplier union all select c_nationkey, c_custkey, 1 from customer)
  select k, v, src from (select *, min(src) over (partition by k) as f from u) where src = f""")
def union_first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("v"), F.lit(0).alias("src"))
    b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("v"), F.lit(1).alias("src"))
    return O.union_first_source([a, b], "k")


_SEGMENTS = ("BUILDING", "MACHINERY", "AUTOMOBILE")


@query(f"""with c as (select c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END as cap, c_custkey % 97 as assets, {_case('c_mktsegment', {s: str(i) for i, s in enumerate(_SEGMENTS)}, 'null')} as seg from customer)
  select c_custkey, row_number() over (order by (cap is null or cap = 0)::int, seg::int asc nulls last, CASE WHEN cap is not null and cap <> 0 THEN cap ELSE assets END desc nulls last, c_custkey) as place from c""")
def tiered_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("cap"), (F.col("c_custkey") % 97).alias("assets"), "c_mktsegment")
    keys = O.tiered_order("cap", "assets", O.list_rank("c_mktsegment", _SEGMENTS), "c_custkey")
    tier, rank, value = (F.when(F.col("cap").isNotNull() & (F.col("cap") != 0), 0).otherwise(1), O.list_rank("c_mktsegment", _SEGMENTS), F.when(F.col("cap").isNotNull() & (F.col("cap") != 0), F.col("cap")).otherwise(F.col("assets")))
    assert len(keys) == 4
    return O.dense_ids(c, [tier, F.coalesce(rank, F.lit(99)), F.coalesce(-value, F.lit(float("inf"))), "c_custkey"], "", "place").select("c_custkey", "place")


# -- cleaning -----------------------------------------------------------------------------
@query("""select c_custkey, CASE WHEN t is null or trim(t) = '' or t in ('0', '--') THEN null ELSE t END as cleaned from
  (select c_custkey, CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN '--' WHEN 2 THEN '  ' WHEN 3 THEN null ELSE c_mktsegment END as t from customer)""")
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    t = F.when(k == 0, "0").when(k == 1, "--").when(k == 2, "  ").when(k == 4, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.null_tokens(t).alias("cleaned"))


@query("""with t as (select c_custkey, CASE c_custkey % 6 WHEN 0 THEN (c_custkey % 100) || 'K' WHEN 1 THEN (c_custkey % 100) || '.5m' WHEN 2 THEN ' ' || c_custkey || 'B ' WHEN 3 THEN 'x' || c_custkey WHEN 4 THEN '' ELSE c_custkey::varchar END as t from customer),
  u as (select c_custkey, upper(trim(t)) as u from t)
  select c_custkey, CASE WHEN u = '' THEN null WHEN u like '%K' THEN try_cast(left(u, len(u) - 1) as double) * 1e3 WHEN u like '%M' THEN try_cast(left(u, len(u) - 1) as double) * 1e6 WHEN u like '%B' THEN try_cast(left(u, len(u) - 1) as double) * 1e9 ELSE try_cast(u as double) END as number from u""")
def shorthand_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text, small = key.cast("string"), (key % 100).cast("string")
    t = F.when(key % 6 == 0, F.concat(small, F.lit("K"))).when(key % 6 == 1, F.concat(small, F.lit(".5m"))).when(key % 6 == 2, F.concat(F.lit(" "), text, F.lit("B "))).when(key % 6 == 3, F.concat(F.lit("x"), text)).when(key % 6 == 4, "").otherwise(text)
    return table(spark, sf_dir, "customer").select("c_custkey", X.shorthand_number(t).alias("number"))


@query("select c_custkey from customer where not (c_mktsegment is distinct from 'BUILDING' and c_acctbal <= 0 and c_nationkey % 2 = 0)")
def without_unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("cap", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))).withColumn("rev", F.when(F.col("c_nationkey") % 2 != 0, 1))
    return R.without_unlisted(c, "c_mktsegment", "BUILDING", ["cap", "rev"]).select("c_custkey")


_STATUSES = ("Mining", " historic mine", "Scoping", "processing ", "unknown", "Infrastructure")
_STATE_NAMES = ("Queensland", "Victoria ", "Nowhere", "Northern Territory")


@query(f"""with t as (select o_orderkey, CASE o_orderkey % 6 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATUSES))} END as s, CASE o_orderkey % 4 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_STATE_NAMES))} END as t from orders)
  select o_orderkey, {_case('lower(trim(s))', {s: k for k, ss in V.STATUS_GROUPS.items() for s in ss}, 's')} as kind, {_case('trim(t)', V.STATES, 'trim(t)')} as state from t""")
def mapped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (key % len(xs) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.status_kind(pick(_STATUSES)).alias("kind"), X.state_code(pick(_STATE_NAMES)).alias("state"))


# -- aggregates ---------------------------------------------------------------------------
@query("""select l_orderkey, array_to_string(list_sort(list_distinct(list(l_shipdate::date::varchar))), ', ') as dates, array_to_string(list(l_returnflag order by l_linenumber, l_returnflag), '') as flags from lineitem group by 1""")
def grouped_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy("l_orderkey").agg(R.sorted_concat(F.to_date("l_shipdate")).alias("dates"), F.array_join(R.ordered_list("l_returnflag", "l_linenumber"), "").alias("flags"))


@query("""select o_custkey, """ + ", ".join(f"""nullif(array_to_string(list_sort(list_distinct(list(o_orderpriority) filter (where o_orderstatus = '{s.upper()}'))), ','), '') as {s}""" for s in "fop") + " from orders group by 1")
def pivot_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pivot_concat(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderpriority", ("f", "o", "p"))


@query("select event_type, count(*) as count from events group by 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.value_counts(table(spark, sf_dir, "events"), "event_type")


_ROLE = {"R": "Primary", "A": "Secondary"}


@query("""with w as (select l_orderkey as e, l_partkey % 20 as i, max(CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'A' THEN 0.5 ELSE 0.1 END::double) as w from lineitem group by 1, 2),
  ab as (select distinct o_orderkey as a, o_orderkey + 1 as b from orders),
  m as (select a, b, i, max(CASE WHEN s = 0 THEN w ELSE 0 END) as x, max(CASE WHEN s = 1 THEN w ELSE 0 END) as y from (select a, b, 0 as s, i, w from ab join w on e = a union all select a, b, 1, i, w from ab join w on e = b) group by 1, 2, 3)
  select a, b, round(sum(least(x, y)) / sum(greatest(x, y)), 6) as similarity from m group by 1, 2""")
def weighted_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_partkey") % 20).alias("item"), F.coalesce(X.literal_map(_ROLE)[F.col("l_returnflag")], F.lit("Other")).alias("role"))
    pairs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), (F.col("o_orderkey") + 1).alias("b"))
    out = R.weighted_jaccard(lines, "l_orderkey", "item", "role", {"Primary": 1.0, "Secondary": 0.5}, 0.1, pairs)
    return out.withColumn("similarity", F.round("similarity", 6))


# -- texts -------------------------------------------------------------------------------
@query("""with t as (select p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || ', ' || p_type || ' (' || p_name || ', x)' WHEN 1 THEN p_brand || ' (a), b (c)' WHEN 2 THEN p_type ELSE null END as s from part)
  select p_partkey, array_to_string(list_filter(list_transform(string_split(regexp_replace(coalesce(s, ''), '[(（](.*)[)）]', ''), ','), lambda x: trim(x)), lambda x: x <> ''), ', ') as prim,
    array_to_string(list_filter(list_transform(string_split(regexp_extract(coalesce(s, ''), '[(（](.*)[)）]', 1), ','), lambda x: trim(x)), lambda x: x <> ''), ', ') as sec from t""")
def primary_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    s = F.when(k == 0, F.concat("p_brand", F.lit(", "), "p_type", F.lit(" ("), "p_name", F.lit(", x)"))).when(k == 1, F.concat("p_brand", F.lit(" (a), b (c)"))).when(k == 2, F.col("p_type"))
    out = table(spark, sf_dir, "part").select("p_partkey", X.split_primary_secondary(s).alias("x"))
    return out.select("p_partkey", F.col("x.primary").alias("prim"), F.col("x.secondary").alias("sec"))


@query("""select p_partkey, p_type as environment, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END as "group", p_brand || ': z' as type from part""")
def parsed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.concat(F.lit("Type: old, ENVIRONMENT : "), "p_type", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(", Group:"), "p_name")).otherwise(", no pair"), F.lit(", type: "), "p_brand", F.lit(": z"))
    out = table(spark, sf_dir, "part").select("p_partkey", X.parse_pairs(s, ("environment", "group", "type")).alias("x"))
    return out.select("p_partkey", "x.environment", "x.group", "x.type")


@query("""with t as (select l_orderkey as k, list(l_shipdate::date::varchar || lower(l_returnflag) order by l_linenumber, l_shipdate::date::varchar || lower(l_returnflag)) as a,
    list(l_shipdate::date::varchar || l_linestatus order by l_linenumber, l_shipdate::date::varchar || l_linestatus) || list(l_shipdate::date::varchar || l_returnflag order by l_linenumber, l_shipdate::date::varchar || l_returnflag) as b from lineitem group by 1)
  select k, array_to_string(a || list_filter(b, lambda x: not list_contains(list_transform(a, lambda y: lower(y)), lower(x))), ',') as merged from t""")
def merged_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("d", F.to_date("l_shipdate").cast("string"))
    lines = lines.select(F.col("l_orderkey").alias("k"), "l_linenumber", F.concat("d", F.lower("l_returnflag")).alias("x"), F.concat("d", "l_linestatus").alias("y"), F.concat("d", "l_returnflag").alias("z"))
    t = lines.groupBy("k").agg(R.ordered_list("x", "l_linenumber").alias("a"), R.ordered_list("y", "l_linenumber").alias("b"), R.ordered_list("z", "l_linenumber").alias("c"))
    return t.select("k", F.array_join(X.merge_names("a", F.concat("b", "c")), ",").alias("merged"))


_VARIANTS = "CASE s_suppkey % 4 WHEN 0 THEN ' ltd' WHEN 1 THEN ' Corp Limited' WHEN 2 THEN ' Corporation' ELSE '' END"


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.expr(_VARIANTS)).alias("name"))


_SWAPS = [("LTD", "LIMITED"), ("LIMITED", "LTD"), ("CORP", "CORPORATION"), ("CORPORATION", "CORP")]
_VARIANT_SQL = f"""t as (select s_suppkey, upper(s_name || {_VARIANTS}) as u from supplier),
  v as (select s_suppkey, 0 as prio, u as variant from t """ + " ".join(f"union all select s_suppkey, {i}, regexp_replace(u, '\\b{a}\\b', '{b}', 'g') from t where regexp_matches(u, '\\b{a}\\b')" for i, (a, b) in enumerate(_SWAPS, 1)) + ")"


@query(f"with {_VARIANT_SQL} select s_suppkey, string_agg(variant, '|' order by prio) as variants from v group by 1")
def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suppliers(spark, sf_dir).select("s_suppkey", F.array_join(X.name_variants("name"), "|").alias("variants"))


@query(f"with {_VARIANT_SQL}, reg as (select variant, 'n' || max(s_suppkey) as acn from v where prio > 0 group by 1) select s_suppkey, arg_min(acn, prio) as acn from v join reg using (variant) group by 1")
def variant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _suppliers(spark, sf_dir).select("s_suppkey", F.posexplode(X.name_variants("name")).alias("prio", "variant"))
    registered = v.filter("prio > 0").groupBy("variant").agg(F.concat(F.lit("n"), F.max("s_suppkey").cast("string")).alias("acn"))
    return R.first_hit(v, registered, "s_suppkey", "variant", "prio", "acn")


@query("""select distinct p_name, array_to_string(list_transform(regexp_extract_all(upper(p_name) || ' o''neil-3m (' || p_brand || ')', '[A-Za-z]+|[^A-Za-z]+'), lambda r: upper(left(r, 1)) || lower(substr(r, 2))), '') as titled from part""")
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.concat(F.upper("p_name"), F.lit(" o'neil-3m ("), "p_brand", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_name", X.title_case(s).alias("titled")).distinct()


@query("select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("""select vec_id, CASE WHEN vec_id % 7 = 0 THEN '' ELSE 'point({longitude: ' || vec_id || ', latitude: ' || label || '})' END as location, label + 1 as number from embeddings""")
def point_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    x = F.when(F.col("vec_id") % 7 == 0, "").otherwise(F.col("vec_id").cast("string"))
    return e.select("vec_id", X.point_text(x, F.col("label").cast("string")).alias("location"), (X.id_number(F.concat(F.lit("node_"), F.col("label").cast("string"))) + 1).cast("int").alias("number"))


@query("""with t as (select l_orderkey, list(l_returnflag order by l_linenumber, l_returnflag) as a, list(l_linestatus order by l_linenumber, l_linestatus)[1:3] as b from lineitem group by 1)
  select l_orderkey, array_to_string(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] || '=' || b[i]), ';') as zipped from t""")
def zipped_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(R.ordered_list("l_returnflag", "l_linenumber").alias("a"), R.ordered_list("l_linestatus", "l_linenumber").alias("b"))
    pairs = X.zip_shorter(F.col("a"), F.slice("b", 1, 3))
    return g.select("l_orderkey", F.array_join(F.transform(pairs, lambda p: F.concat_ws("=", p["symbol"], p["name"])), ";").alias("zipped"))


# -- graph -------------------------------------------------------------------------------
def trade_graph(spark: SparkSession, sf_dir: str) -> G.PropertyGraph:
    """Regions, nations, customers and orders as a property graph."""
    region, nation, customer, orders = (table(spark, sf_dir, n) for n in ("region", "nation", "customer", "orders"))
    g = G.PropertyGraph(aliases={"Buyer": "Customer"})
    g.add_nodes("Region", region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("text")))
    g.add_nodes("Nation", nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("text")))
    g.add_nodes("Customer", customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("text"), F.col("c_mktsegment").alias("segment")))
    g.add_nodes("Order", orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status")))
    link = lambda df, a, x, b, y: df.select(F.concat(F.lit(a), F.col(x).cast("string")).alias("src"), F.concat(F.lit(b), F.col(y).cast("string")).alias("dst"))
    g.add_edges("PART_OF", "Nation", "Region", link(nation, "n", "n_nationkey", "r", "n_regionkey"))
    g.add_edges("LOCATED_IN", "Customer", "Nation", link(customer, "c", "c_custkey", "n", "c_nationkey"))
    g.add_edges("PLACED", "Customer", "Order", link(orders, "c", "o_custkey", "o", "o_orderkey"))
    return g


@query("select 'seg_' || row_number() over (order by c_mktsegment) as id, c_mktsegment as text from (select distinct c_mktsegment from customer)")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.make_nodes(table(spark, sf_dir, "customer"), "c_mktsegment", "seg_")


@query("with n as (select 'seg_' || row_number() over (order by c_mktsegment) as id, c_mktsegment as t from (select distinct c_mktsegment from customer)) select distinct c_nationkey as src, id as dst from customer join n on t = c_mktsegment")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return G.make_edges(customer, "c_nationkey", "c_mktsegment", G.make_nodes(customer, "c_mktsegment", "seg_"))


@query("select user_id as id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by 1")
def upserted_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.upsert_nodes(table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id", "event_type", "value"), "id", "event_id")


@query("select distinct o_custkey as src, l_suppkey as dst, l_returnflag as role from orders join lineitem on l_orderkey = o_orderkey where l_suppkey in (select s_suppkey from supplier) and o_custkey in (select c_custkey from customer)")
def merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    edges = rows.select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst"), F.col("l_returnflag").alias("role"))
    sources = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    targets = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return G.merge_edges(edges, sources, targets)


@query("select o_custkey as id, count(*) as n from orders group by 1 having count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.duplicate_ids(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id")


@query("""select c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 3 = 1 THEN n_name END, r_name) as finest from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def finest_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("c_custkey") % 3
    return c.select("c_custkey", R.finest_level([F.when(k == 0, F.col("c_mktsegment")).otherwise(" "), F.when(k == 1, F.col("n_name")), "r_name"]).alias("finest"))


@query("""with e as (select distinct 'n' || n_nationkey as src, 'r' || n_regionkey as dst from nation union select distinct 'c' || c_custkey, 'n' || c_nationkey from customer)
  select src, dst, 1 as depth from e union all select a.src, b.dst, 2 from e a join e b on a.dst = b.src""")
def hierarchy_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = trade_graph(spark, sf_dir)
    return G.closure(g.edge("PART_OF").select("src", "dst").unionByName(g.edge("LOCATED_IN").select("src", "dst")))


@query("select 'c' || c_custkey as customer, n_name as nation from customer join nation on c_nationkey = n_nationkey where c_mktsegment = 'BUILDING'")
def one_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    hop = trade_graph(spark, sf_dir).hop("Customer", "LOCATED_IN", "Nation", F.col("a.segment") == "BUILDING")
    return hop.select(F.col("a.id").alias("customer"), F.col("b.text").alias("nation"))


@query("select 'n' || a.n_nationkey as a, 'r' || a.n_regionkey as x, 'n' || b.n_nationkey as b from nation a join nation b on a.n_regionkey = b.n_regionkey where 'n' || a.n_nationkey < 'n' || b.n_nationkey")
def common_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_graph(spark, sf_dir).common_targets("PART_OF")


_TERMS = ("_1", "AS", "a", "zzz", "AS")


@query("with t as (select distinct unnest(['_1', 'AS', 'a', 'zzz']) as term) select term, n_name as text from t join nation on contains(lower(n_name), lower(term))")
def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = spark.createDataFrame([(t,) for t in _TERMS], "term string")
    return trade_graph(spark, sf_dir).search("Nation", "text", terms).select("term", "text")


@query("""with t as (select unnest(['_1', 'AS', 'a', 'zzz']) as term), h as (select term, r_name as x from t join region on contains(lower(r_name), lower(term)))
  select t.term, count(x) as match_count, coalesce(string_agg(x, '|' order by x), '') as matches from t left join h using (term) group by 1""")
def search_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = spark.createDataFrame([(t,) for t in _TERMS], "term string")
    out = G.search_report(table(spark, sf_dir, "region"), "r_name", terms)
    return out.withColumn("matches", F.array_join("matches", "|"))


@query("""select c_name as customer, n_name as nation, o_totalprice as total from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join orders on o_custkey = c_custkey
  where c_mktsegment = 'BUILDING' and contains(lower(r_name), 'a') and not o_orderstatus = 'F' and (o_totalprice > 100000 or o_totalprice < 2000)""")
def pattern_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """MATCH (o:Order)<-[:PLACED]-(c:Buyer {segment: $segment})-[:LOCATED_IN]->(n:Nation)-[:PART_OF]->(r:Region)
      WHERE toLower(r.text) CONTAINS 'a' AND NOT o.status = 'F' AND (o.total > 100000 OR o.total < 2000)
      RETURN c.text AS customer, n.text AS nation, o.total AS total"""
    return run_query(trade_graph(spark, sf_dir), text, {"segment": "BUILDING"})


@query("select n_name as name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1 union all select r_name, count(*) from nation join region on n_regionkey = r_regionkey group by 1")
def pattern_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """MATCH (c:Customer)-[]->(n:Nation) RETURN n.text AS name, count(*) AS n
      UNION ALL MATCH (n:Nation)-[:PART_OF]->(r:Region) RETURN r.text AS name, count(*) AS n"""
    return run_query(trade_graph(spark, sf_dir), text)


@query("""select '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' as record from region""")
def serialised_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.serialised(table(spark, sf_dir, "region"), ["r_regionkey", "r_name"])


# -- places ------------------------------------------------------------------------------
#: Three regions on the plane: one with a hole, two that share a border.
_POLYGONS = (
    ("west", "igneous", [[(-3, -3), (0, -3), (0, 3), (-3, 3)]]),
    ("east", "tectonic", [[(0, -3), (3, -3), (3, 3), (0, 3)], [(1, -1), (2, -1), (2, 1), (1, 1)]]),
    ("north", "igneous", [[(-2, 1), (2, 1), (0, 3)]]),
)


def _polygons(spark: SparkSession) -> DataFrame:
    rows = [(i, name, kind, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, (name, kind, rings) in enumerate(_POLYGONS)]
    return spark.createDataFrame(rows, "ord int, name string, type string, rings array<array<struct<x: double, y: double>>>")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as points on a grid of eighths, so that some lie on borders."""
    at = lambda i: F.round(F.element_at("embedding", i).cast("double") * 64) / 8
    return table(spark, sf_dir, "embeddings").select("vec_id", at(1).alias("x"), at(2).alias("y"))


def _edge_rows() -> str:
    rows = [(n, *ring[i], *ring[(i + 1) % len(ring)]) for n, _, rings in _POLYGONS for ring in rings for i in range(len(ring))]
    return ", ".join(f"('{n}', {a}::double, {b}::double, {c}::double, {d}::double)" for n, a, b, c, d in rows)


_PIP = f"""p as (select vec_id, round(embedding[1]::double * 64) / 8 as x, round(embedding[2]::double * 64) / 8 as y from embeddings),
  e(name, x1, y1, x2, y2) as (values {_edge_rows()}),
  t as (select vec_id, name, bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) and x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2)) as on_edge,
    count(*) filter (where (y1 > y) <> (y2 > y) and x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1 as odd from p, e group by 1, 2)"""


def _pip_sql(condition: str) -> str:
    return f"with {_PIP}, h as (select vec_id, name from t where {condition}) select p.vec_id, h.name from p left join h using (vec_id)"


@query(_pip_sql("on_edge or odd"))
def points_covered_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.point_in_polygon(_points(spark, sf_dir), _polygons(spark), "x", "y", "rings", "covered_by").select("vec_id", "name")


@query(_pip_sql("odd and not on_edge"))
def points_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.point_in_polygon(_points(spark, sf_dir), _polygons(spark), "x", "y", "rings", "within").select("vec_id", "name")


@query(f"""with {_PIP}, h as (select vec_id, name, {_case('name', {n: k for n, k, _ in _POLYGONS}, 'null')} as kind from t where odd and not on_edge)
  select vec_id, string_agg(name, ',' order by name) filter (where kind = 'igneous') as igneous, null::varchar as metallogenic, null::varchar as sedimentary, string_agg(name, ',' order by name) filter (where kind = 'tectonic') as tectonic from h group by 1""")
def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = P.point_in_polygon(_points(spark, sf_dir), _polygons(spark), "x", "y", "rings", "within")
    return R.pivot_concat(inside, "vec_id", "type", "name", V.PROVINCE_KINDS)


@query("""with v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings)
  select a.vec_id, round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) as cosine from v a join v b on b.vec_id = a.vec_id + 1""")
def vector_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    pairs = e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    return pairs.select("vec_id", F.round(S.cosine("a", "b"), 6).alias("cosine"))


# -- scans in order ----------------------------------------------------------------------------
def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A register of names made of orders: names repeat, and some name a previous one."""
    o = table(spark, sf_dir, "orders")
    name = lambda n: F.concat(F.lit("COMPANY "), (n % 3001).cast("string"))
    key = F.col("o_orderkey")
    return o.select(key.alias("ord"), name(key * 7).alias("name"), (F.col("o_custkey") + 1000).cast("string").alias("acn"), F.when(key % 5 == 0, name(key * 11 + 3)).otherwise("").alias("previous"), F.when(key % 13 == 0, 3).otherwise(14).alias("n_columns"))


#: One pass over the register in order, as a fold; what a name is found with is kept beside it.
_FOLD = """list_reduce(rows, lambda found, r: CASE WHEN (r.prev = '' or not list_contains(list_transform(found, lambda f: f.name), r.prev)) and not list_contains(list_transform(found, lambda f: f.name), r.name)
  THEN list_append(found, r) ELSE found END, rows[1:0])"""


_REGISTER_NAMES = f"""with o as (select o_orderkey as ord, 'COMPANY ' || (o_orderkey * 7 % 3001) as name, (o_custkey + 1000)::varchar as acn, CASE WHEN o_orderkey % 5 = 0 THEN 'COMPANY ' || ((o_orderkey * 11 + 3) % 3001) ELSE '' END as prev
    from orders where o_orderkey % 13 <> 0),
  x as (select name from o where prev <> '' union select prev from o where prev <> ''),
  g as (select list(struct_pack(name := name, acn := acn, prev := prev) order by ord) as rows from o where name in (select name from x)),
  h as (select unnest({_FOLD}) as f from g)
  select f.name as name, f.acn as acn from h union all select name, arg_min(acn, ord) from o where name not in (select name from x) group by 1"""


@query(_REGISTER_NAMES)
def register_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.register_names(register(spark, sf_dir))


#: Names registered by the rows that stay, found by one fold in order; rows, fills and synonyms follow from them.
_CONSOLIDATED = """with m as (select p_partkey as ord, p_name || ' ' || p_brand as name, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' ' || p_type END as synonyms, CASE WHEN p_partkey % 5 = 0 THEN p_partkey::varchar END as acn, CASE WHEN p_size % 2 = 0 THEN p_retailprice END as revenue from part),
  o as (select *, list_filter([trim(name), trim(coalesce(synonyms, ''))], lambda x: x <> '') as own, list_distinct(list_transform(list_filter([trim(name), trim(coalesce(synonyms, ''))], lambda x: x <> ''), lambda x: lower(x))) as keys from m),
  f as (select list_reduce(list(struct_pack(ord := ord, acn := acn, keys := keys) order by ord), lambda reg, r: CASE WHEN r.acn is null and list_has_any(list_transform(reg, lambda z: z.k), r.keys) THEN reg
    ELSE list_concat(reg, list_transform(list_filter(r.keys, lambda k: not list_contains(list_transform(reg, lambda z: z.k), k)), lambda k: struct_pack(k := k, place := r.ord))) END, []::struct(k varchar, place bigint)[]) as reg from o),
  g as (select z.k as k, z.place as place from (select unnest(reg) as z from f)),
  h as (select o.ord, arg_min(g.place, CASE WHEN lower(trim(o.name)) = g.k THEN 0 ELSE 1 END) as target from o join g on list_contains(keys, g.k) and g.place < o.ord where acn is null group by 1),
  a as (select target, list(struct_pack(own := own) order by o.ord) as rows, arg_min(revenue, o.ord) filter (where revenue is not null) as more from h join o using (ord) group by 1)
  select o.ord, name, nullif(CASE WHEN rows is null THEN coalesce(synonyms, '') ELSE list_reduce(rows, lambda syn, r: CASE WHEN len(list_filter(r.own, lambda x: lower(x) <> lower(trim(name)) and not list_contains(list_transform(string_split(syn, ','), lambda y: lower(trim(y))), lower(x)))) = 0 THEN syn
    ELSE concat_ws(', ', nullif(syn, ''), array_to_string(list_sort(list_filter(r.own, lambda x: lower(x) <> lower(trim(name)) and not list_contains(list_transform(string_split(syn, ','), lambda y: lower(trim(y))), lower(x)))), ', ')) END, coalesce(synonyms, '')) END, '') as synonyms,
    acn, coalesce(revenue, more) as revenue from o left join a on a.target = o.ord where o.ord not in (select ord from h)"""


@query(_CONSOLIDATED)
def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    master = part.select(F.col("p_partkey").alias("ord"), F.concat("p_name", F.lit(" "), "p_brand").alias("name"), F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" "), "p_type")).alias("synonyms"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey").cast("string")).alias("acn"), F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")).alias("revenue"))
    return Q.consolidate(master, fill=("revenue",))[0]
