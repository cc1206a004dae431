"""Texts and names, as Column -> Column functions that stay in generated code."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import vocabulary as V


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def suffix_pattern() -> str:
    """One anchored expression that takes all legal endings off a name, the longest first."""
    endings = {tuple(re.findall("[a-z0-9]+", s.lower())) for s in V.LEGAL_SUFFIXES}
    longest_first = sorted(endings, key=lambda t: (-len(t), -sum(map(len, t)), t))
    return "(?:(?:^| )(?:" + "|".join(" ".join(t) for t in longest_first) + "))+$"


def name_tokens(name: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(F.replace(_col(name), F.lit("&"), F.lit("and"))), F.lit("[a-z0-9]+"), F.lit(0))


def normalize_name(name: Column | str) -> Column:
    """Lower case, "&" as "and", no signs, no legal endings, one spelling of some words; "" for null."""
    bare = F.regexp_replace(F.array_join(name_tokens(name), " "), suffix_pattern(), "")
    spelled = F.transform(F.split(bare, " "), lambda w: F.coalesce(literal_map(V.WORD_SPELLINGS)[w], w))
    return F.coalesce(F.array_join(spelled, " "), F.lit(""))


def is_dirty(name: Column | str) -> Column:
    return F.lower(F.trim(_col(name))).isin(*V.DIRTY_NAMES)


def split_list(text: Column | str, sep: str = ",") -> Column:
    """Trimmed, non-blank items."""
    return F.filter(F.transform(F.split(_col(text), sep), lambda x: F.trim(x)), lambda x: x != "")


def split_primary_secondary(text: Column | str) -> Column:
    """(primary, secondary) items of "a, b (c, d)"; the parentheses are the outermost ones, ASCII or full-width."""
    s = F.coalesce(_col(text), F.lit(""))
    outer = r"[(（](.*)[)）]"
    join = lambda x: F.array_join(split_list(x), ", ")
    return F.struct(join(F.regexp_replace(s, outer, "")).alias("primary"), join(F.regexp_extract(s, outer, 1)).alias("secondary"))


def parse_pairs(text: Column | str, keys: tuple[str, ...]) -> Column:
    """Values of "k: v, k: v" for the keys, whatever their case; the last of a repeated key, "" for a missing one."""
    parts = F.filter(F.split(F.coalesce(_col(text), F.lit("")), ","), lambda p: p.contains(":"))
    pairs = F.transform(parts, lambda p: F.struct(F.lower(F.trim(F.substring_index(p, ":", 1))).alias("k"), F.trim(F.regexp_replace(p, "^[^:]*:", "")).alias("v")))
    last = lambda k: F.coalesce(F.element_at(F.filter(pairs, lambda x: x["k"] == k), -1)["v"], F.lit(""))
    safe = lambda k: F.when(F.exists(pairs, lambda x: x["k"] == k), last(k)).otherwise("")
    return F.struct(*[safe(k).alias(k) for k in keys])


def clean_breaks(text: Column | str) -> Column:
    return F.translate(_col(text), "\r\n", "")


def shorthand_number(text: Column | str) -> Column:
    """1.5M as 1500000.0; K, M and B in either case; null for blanks and what is no number."""
    s = F.upper(F.trim(_col(text)))
    number = lambda x: x.try_cast("double")
    head = F.substring(s, F.lit(1), F.length(s) - 1)
    scaled = reduce(lambda out, x: out.when(s.endswith(x[0]), number(head) * x[1]), (("K", 1e3), ("M", 1e6), ("B", 1e9)), F.when(s == "", None))
    return scaled.otherwise(number(s))


def null_tokens(text: Column | str) -> Column:
    """Null for blanks, "0" and "--"."""
    c = _col(text)
    return F.when(F.trim(c).eqNullSafe("") | c.isin("0", "--"), None).otherwise(c)


def null_zero(number: Column | str) -> Column:
    c = _col(number)
    return F.when(c == 0, None).otherwise(c)


def name_variants(name: Column | str) -> Column:
    """The upper-cased name, then with each of LTD/LIMITED and CORP/CORPORATION exchanged, in that order."""
    up = F.upper(F.trim(_col(name)))
    swaps = (("LTD", "LIMITED"), ("LIMITED", "LTD"), ("CORP", "CORPORATION"), ("CORPORATION", "CORP"))
    made = [F.when(up.rlike(rf"\b{a}\b"), F.regexp_replace(up, rf"\b{a}\b", b)) for a, b in swaps]
    return F.filter(F.array(up, *made), lambda x: x.isNotNull())


def title_case(text: Column | str) -> Column:
    """A capital for each run of letters, lower case within it."""
    runs = F.regexp_extract_all(_col(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(r.substr(F.lit(2), F.length(r))))), "")


def map_value(value: Column | str, pairs: dict[str, str]) -> Column:
    """The value's entry in the table, or the value itself."""
    c = _col(value)
    return F.coalesce(literal_map(pairs)[c], c)


def status_kind(status: Column | str) -> Column:
    """The kind of project of a status, or the status as it is."""
    c = _col(status)
    kinds = {s: kind for kind, statuses in V.STATUS_GROUPS.items() for s in statuses}
    return F.coalesce(literal_map(kinds)[F.lower(F.trim(c))], c)


def state_code(state: Column | str) -> Column:
    return map_value(F.trim(_col(state)), V.STATES)


def point_text(longitude: Column | str, latitude: Column | str) -> Column:
    """point({longitude: x, latitude: y}), or "" where either is blank."""
    x, y = (F.trim(_col(c).cast("string")) for c in (longitude, latitude))
    blank = F.coalesce(x, F.lit("")).eqNullSafe("") | F.coalesce(y, F.lit("")).eqNullSafe("")
    return F.when(blank, "").otherwise(F.format_string("point({longitude: %s, latitude: %s})", x, y))


def id_number(identifier: Column | str) -> Column:
    return F.regexp_extract(_col(identifier), r"(\d+)", 1).try_cast("bigint")


def merge_names(old: Column | str, new: Column | str) -> Column:
    """old, then those of new that it does not hold in any case; repeats within new stay."""
    a, b = _col(old), _col(new)
    return F.concat(a, F.filter(b, lambda n: ~F.exists(a, lambda o: F.lower(o) == F.lower(n))))


def zip_shorter(left: Column | str, right: Column | str) -> Column:
    """Pairs of items at one place, as many as the shorter list has."""
    a, b = _col(left), _col(right)
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, 1, n).alias("symbol"), F.slice(b, 1, n).alias("name"))


def contains_ci(text: Column | str, term: Column | str) -> Column:
    return F.lower(_col(text)).contains(F.lower(_col(term)))
