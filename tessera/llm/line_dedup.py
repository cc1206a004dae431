"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line's tokens are its distinct words, in lower case. Of two lines whose token
sets have a Jaccard similarity of at least ``percent``, the later one is removed,
whether or not the earlier one is; lines come by doc_id (those without one last),
then by a digest of the document, then by their place. Lines of one text are a
class whose first line stands for it, so copies cost one aggregation with partial
results and no join.

Parts. Two linked sets of n and m tokens have at most d = (n + m) * (100 - percent) / (100 + percent)
tokens apart. The hashes are dealt into more than d ranges, and what a set has in
a range is a part: sets that differ in d tokens differ in d parts at most, and all
other parts are equal. So among the d + 1 strongest parts of either set is one that
both have, and these parts are a line's keys. Strength is what the lengths of a
part's words add up to, as long words are rare; any strength gives the same links. A
line with d tokens or more in too few ranges has its strongest tokens as keys too.
The number of ranges goes by groups of sizes, powers of two: a line has keys for its
own group and for that of the largest set that it can link with.

Filter. Keys go through one aggregation, which tells those that two classes have;
a bitmap of fixed size picks their rows, and what it picks too much meets nothing.
Sizes and a sketch of 128 bits, of which each token turns one, bound how many
tokens two sets have apart. What passes is verified on the token sets.

Leaders. A line is first verified against the earliest line of each of its keys,
which is linear and settles the many variants of one line; those that no such
leader removed are then held against all earlier lines of their keys, in parts where the join is skewed.

Defined cases: a null text is a text without lines; lines without a word are
never removed; a document whose lines are all removed has an empty text; rows
that repeat both id and text are one document and get the same result; an empty
table gives an empty result; other columns are kept by ``deduplicated`` and
ignored by ``removals``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.llm.shared import materialize, release, scratch

PERCENT = 80
#: Longs of a bitmap that is sent to all tasks.
BITMAP_LONGS = 1 << 20
SPACE = r"[ \t-\r]+"
_SKETCH = ("b0", "b1")


def doc_key(doc_id: str, text: str) -> Column:
    """What orders documents: those with an id by it, then a digest of the text."""
    return F.struct(F.col(f"`{doc_id}`").isNull().alias("none"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("digest"))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, pos and line of every line with a word."""
    # the key first: computed beside the lines, it would hash the whole text for each of them
    whole = docs.select(doc_key(doc_id, text).alias("doc"), F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1).alias("lines"))
    lines = whole.select("doc", F.posexplode_outer("lines").alias("pos", "line"))
    return lines.filter(F.col("line").rlike(r"[^ \t-\r]"))


def places(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """h1, h2, at and line of every line with a word; at is (document, place)."""
    return _lines(docs, doc_id, text).select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.struct("doc", "pos").alias("at"), "line")


def words(line: str) -> Column:
    """The words of a line in lower case, with empty strings between spaces; a pattern is only matched where a line has other space."""
    low = F.lower(F.col(line))
    odd = F.lit(False)
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(F.col(line), F.lit(c))
    return F.when(odd, F.split(low, SPACE)).otherwise(F.split(low, " "))


def _hashes(line: str) -> Column:
    """The hash of each word of a line."""
    return F.transform(F.array_remove(words(line), ""), lambda w: F.xxhash64(w))


def _tokens(line: str) -> Column:
    """The distinct tokens of a line in order: 57 bits of a hash, which part them, above the word's length, 63 at most."""
    token = lambda w: F.xxhash64(w).bitwiseAND(0x7FFFFFFFFFFFFFC0).bitwiseOR(F.least(F.length(w), F.lit(63)).cast("long"))
    return F.sort_array(F.array_distinct(F.transform(F.array_remove(words(line), ""), token)))


def _apart(sizes: str, percent: int) -> str:
    """How many tokens two linked sets whose sizes add up to this can have apart."""
    return f"cast(floor(({sizes}) * {100 - percent} / {100 + percent}) as int)"


def _deal(percent: int) -> list[int]:
    """The number of parts of each group of sizes: a fifth more than can differ, and one."""
    most = [2 * ((1 << g) - 1) * (100 - percent) // (100 + percent) for g in range(32)]
    return [1 + k + -(-k // 5) for k in most]


def _literal(values: list[int]) -> str:
    return f"array({', '.join(f'{v}L' for v in values)})"


def parted(docs: DataFrame, doc_id: str, text: str, percent: int = PERCENT) -> DataFrame:
    """h1, h2, at, own, n, a sketch of 128 bits and the keys of every line with a word, by group of sizes; own is set in the first row of each."""
    group = lambda n: f"length(bin({n}))"  # noqa: E731  sizes from 2 ** (g - 1) to 2 ** g - 1
    found = places(docs, doc_id, text).select("h1", "h2", "at", _tokens("line").alias("tokens")).withColumn("n", F.size("tokens"))
    # tokens are in order, so those of either half of the hashes are a slice
    half = found.withColumn("low", F.filter("tokens", lambda t: t < (1 << 62)))
    halves = (F.col("low"), F.slice("tokens", F.size("low") + 1, F.col("n")))
    bits = [F.aggregate(t, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, 20).bitwiseAND(63).cast("int")))).alias(b) for b, t in zip(_SKETCH, halves, strict=True)]
    larger = f"floor(100L * n / {percent})"
    sized = half.select("h1", "h2", "at", "n", *bits, "tokens", F.expr(group("n")).alias("g0"), F.expr(f"sequence({group('n')}, {group(larger)})").alias("gs"))
    each = sized.select("h1", "h2", "at", "n", *_SKETCH, "tokens", "g0", F.explode("gs").alias("g"))
    need = F.expr(_apart(f"n + least({larger}, shiftleft(1L, g) - 1)", percent)) + 1
    # a part is a range of hashes; where each begins, a long without a length is set among the tokens
    deal = _deal(percent)
    starts = f"transform(sequence(0L, {_literal(deal)}[g] - 1), p -> p * {_literal([((1 << 63) - 1) // k for k in deal])}[g] & -64)"
    merged = each.select("h1", "h2", "at", "n", *_SKETCH, "tokens", "g0", "g", need.alias("need"), F.expr(f"sort_array(concat(tokens, {starts}))").alias("merged"))
    cut = merged.withColumn("cuts", F.expr("filter(sequence(0, size(merged) - 1), i -> merged[i] & 63 = 0)"))
    runs = cut.withColumn("runs", F.expr("transform(cuts, (c, k) -> slice(merged, c + 1, coalesce(get(cuts, k + 1), size(merged)) - c))"))
    # a key: what the lengths of a part's words add up to, above 53 bits of the part's hash
    key = "shiftleft(least({0}, 1023), 53) | shiftrightunsigned(xxhash64({1}), 11)"
    best = "slice(sort_array(transform({0}, {1}), false), 1, need)"
    keyed = runs.withColumn("keys", F.expr(best.format("runs", f"r -> {key.format('aggregate(r, 0L, (a, t) -> a + (t & 63))', 'g, r')}")))
    # where all parts that are not empty may differ, the tokens are parts of their own too
    alone = F.expr(best.format("tokens", f"t -> {key.format('t & 63', 'g, t, 0')}"))
    full = F.expr("shiftrightunsigned(element_at(keys, -1), 53) > 0")
    every = F.when(full, F.col("keys")).otherwise(F.concat(F.filter("keys", lambda k: F.shiftrightunsigned(k, 53) > 0), alone))
    return keyed.select("h1", "h2", "at", (F.col("g") == F.col("g0")).alias("own"), "n", *_SKETCH, every.alias("keys"))


def bitmap(values: DataFrame, count: int, name: str) -> tuple[DataFrame, int]:
    """A table of one row, an array of longs with one bit for each value of the only column, a long; and the array's length, for about count values."""
    n = min(BITMAP_LONGS, max(64, 1 << (count // 4).bit_length()))
    v = F.col(values.columns[0])
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(v, 20).bitwiseAND(63).cast("int"))
    none = values.sparkSession.range(n).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("b"))
    packed = values.select(v.bitwiseAND(n - 1).alias("at"), bit.alias("b")).unionByName(none).groupBy("at").agg(F.bit_or("b").alias("b"))
    return materialize(packed.agg(F.sort_array(F.collect_list(F.struct("at", "b")))["b"].alias("bits")), name), n


def among(key: str, bits: tuple[DataFrame, int]) -> Column:
    """Whether a row's key may be among the values of a bitmap; true for all that are."""
    k = F.col(key)
    word = F.get(bits[0].scalar(), k.bitwiseAND(bits[1] - 1).cast("int"))
    return F.call_function("shiftrightunsigned", word, F.shiftrightunsigned(k, 20).bitwiseAND(63).cast("int")).bitwiseAND(1) == 1


def _may_link(percent: int) -> str:
    """Condition on rows x and y of one key: sizes and sketches allow a link."""
    return f"""x.h1 <> y.h1 and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
        and {100 + percent} * ({" + ".join(f"bit_count(x.{b} ^ y.{b})" for b in _SKETCH)}) <= {100 - percent} * (x.n + y.n)"""


def _pairs(met: DataFrame) -> DataFrame:
    """The classes a, b of rows x, y, each pair once."""
    return met.select(F.least("x.h1", "y.h1").alias("a"), F.greatest("x.h1", "y.h1").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """h1, h2 of the later class of each pair (a, b) whose token sets are similar."""
    with scratch() as held:
        held.append(pairs := materialize(pairs, "lines-pairs"))
        wanted = bitmap(pairs.select(F.explode(F.array("a", "b")).alias("h1")), 2 * pairs.count(), "lines-wanted")
        held.append(wanted[0])
        texts = places(docs, doc_id, text).filter(among("h1", wanted)).groupBy("h1", "h2").agg(F.min("at").alias("first"), F.first("line").alias("line"))
        held.append(sets := materialize(texts.select("h1", "h2", "first", F.sort_array(F.array_distinct(_hashes("line"))).alias("s")), "lines-sets"))
        left = sets.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("first").alias("fa"), F.col("s").alias("sa"))
        right = sets.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("first").alias("fb"), F.col("s").alias("sb"))
        both = pairs.join(left, "a").join(right, "b").withColumn("o", F.size(F.array_intersect("sa", "sb")))
        good = both.filter(100 * F.col("o") >= percent * (F.size("sa") + F.size("sb") - F.col("o")))
        later = F.when(F.col("fa") > F.col("fb"), F.struct(F.col("a").alias("h1"), F.col("a2").alias("h2"))).otherwise(F.struct(F.col("b").alias("h1"), F.col("b2").alias("h2")))
        return materialize(good.select(later.alias("l")).select("l.*").distinct(), "lines-later")


def _shared(every: DataFrame, copied: DataFrame) -> DataFrame:
    """t, h1, n, the sketch and o of each key of each class that another class may have too; o never falls along the order of lines."""
    keys = every.select(F.explode("keys").alias("t"), "h1")
    ends = keys.groupBy("t").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    with scratch() as held:
        common = bitmap(ends.filter("a <> b").select("t"), every.count(), "lines-common")
        several = bitmap(copied.select("h1"), copied.count(), "lines-several")
        held += [common[0], several[0]]
        whole = isinstance(every.schema["at"].dataType["doc"].dataType["id"].dataType, IntegralType)
        o = F.coalesce(F.col("at.doc.id").cast("long"), F.lit((1 << 63) - 1)) if whole else F.lit(0).cast("long")
        own = ["t", "h1", "n", *_SKETCH]
        rows = every.select(F.explode("keys").alias("t"), "h1", "n", *_SKETCH, o.alias("o")).filter(among("t", common))
        once = rows.filter(~among("h1", several))
        often = rows.filter(among("h1", several)).groupBy(*own).agg(F.min("o").alias("o"))  # copies of a line ask once
        return materialize(once.unionByName(often), "lines-rows")


def similar_later(docs: DataFrame, every: DataFrame, copied: DataFrame, doc_id: str, text: str, percent: int = PERCENT) -> DataFrame:
    """h1, h2 of the classes of lines that are similar to an earlier one."""
    link = F.expr(_may_link(percent))
    with scratch() as held:
        held.append(rows := _shared(every, copied))
        # each step is written, so that the shuffles of one are gone before those of the next
        lead = rows.groupBy("t").agg(*[F.min_by(c, "o").alias(c) for c in ("h1", "n", *_SKETCH)], F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
        led = rows.alias("x").join(lead.alias("y"), F.col("x.t") == F.col("y.t")).filter(link)
        held.append(by_leader := _verified(_pairs(led), docs, doc_id, text, percent))

        held.append(left := materialize(rows.join(by_leader.select("h1").distinct(), "h1", "left_anti"), "lines-left"))
        met = left.alias("x").join(rows.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("y.o") <= F.col("x.o")) & link)
        held.append(rest := _verified(_pairs(met), docs, doc_id, text, percent))
        return materialize(by_leader.unionByName(rest).distinct(), "lines-removed")


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc (none, id, digest) and the places of the lines to remove, for documents that lose any."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    with scratch() as held:
        held.append(every := materialize(parted(docs, doc_id, text, percent), "lines-parted"))
        lines = every.filter("own").select("h1", "h2", "at")
        held.append(classes := materialize(lines.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "lines-copied"))
        held.append(later := similar_later(docs, every, classes, doc_id, text, percent))
        touched = classes.select("h1", "h2", "first").join(later.withColumn("gone", F.lit(True)), ["h1", "h2"], "full")
        held.append(touched := materialize(touched, "lines-touched"))
        bits = bitmap(touched.select("h1"), touched.count(), "lines-gone")
        held.append(bits[0])
        drop = lines.filter(among("h1", bits)).join(touched, ["h1", "h2"]).filter("gone or at <> first")
        return materialize(drop.groupBy(F.col("at.doc").alias("doc")).agg(F.sort_array(F.collect_set("at.pos")).alias("removed")), "lines-places")


def _with_removed(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """row (all columns of docs, whatever their names) and removed (null where nothing is)."""
    gone = removals(docs, doc_id, text, percent).select(F.struct("doc", "removed").alias("g"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_key(doc_id, text).alias("d"))
    same = F.col("d.none").eqNullSafe(F.col("g.doc.none")) & F.col("d.id").eqNullSafe(F.col("g.doc.id")) & F.col("d.digest").eqNullSafe(F.col("g.doc.digest"))
    return packed.join(gone, same, "left").select("row", F.col("g.removed").alias("removed"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs without the lines that are copies of, or similar to, earlier ones; all columns and rows stay."""
    joined = _with_removed(docs, doc_id, text, percent)
    kept = F.expr(f"array_join(transform(filter(transform(split(row.`{text}`, '\\n', -1), (l, i) -> struct(l, i)), x -> not array_contains(removed, x.i)), x -> x.l), '\\n')")
    return joined.select(*[(F.when(F.col("removed").isNull(), F.col(f"row.`{c}`")).otherwise(kept) if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def document_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines, n_removed and the removed places, comma-joined, of every document."""
    joined = _with_removed(docs.select("doc_id", "text"), "doc_id", "text", percent)
    n = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n", -1))).cast("long")
    return joined.select(F.col("row.doc_id").alias("doc_id"), n.alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))
