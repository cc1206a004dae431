"""Secret scans with DataFrame functions only: base findings, and weak ones linked to complementary parts.

Spans. Spark's regular expressions give matches without places. Splitting at
the same expression gives the texts between them, so a match starts where the
lengths of all pieces and matches before it add up to; a running sum over the
exploded lengths is linear in a document's matches.

Linking. Access identifiers, secrets and endpoints are parts of one credential.
Base findings stand by themselves. A weak part is reported only if parts of the
complementary roles start within ``scope`` code points of it: an interval join
of the parts of a document with themselves, run as a range frame over the
starts, so a part meets the few parts near it and never all of its document. Each
linked part names the identifier and the secret nearest to it (the earlier one of
two as near), so a credential can be put together from its parts.

One shuffle, by document, carries lengths and never texts. Defined cases: a null
text is an empty one and has no spans; documents that repeat, or have no id, are
rows of their own; spans of one kind that tie in place go by the order of kinds; a
text of any length is one row, searched whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points between the starts of parts that may belong to one credential.
SCOPE = 200
# The base patterns, with the least length of what must match, and the weak ones.
# A run of hexadecimal digits, or of an access identifier, is as long as it can be, so its least
# length may stand in the pattern; an assignment that is too short still uses up its text.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
USER = r"(?i:user(?:name)?|login|client_?id|account(?:_?id)?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@+-]{3,}"
BLOB = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+[A-Za-z0-9/_.:-]*"
#: kind, pattern, role, whether it stands by itself; the order is that of kinds with one start.
KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "identifier", True),
    ("hex", HEX, "secret", True),
    ("user", USER, "identifier", False),
    ("blob", BLOB, "secret", False),
    ("endpoint", ENDPOINT, "endpoint", False),
)


def _lengths(text: Column, k: int) -> Column:
    """For kind k, an array of (kind, number, code points before, code points, whether it counts) for each match."""
    name, pattern, _, _ = KINDS[k]
    rx = F.lit(pattern)
    found = F.regexp_extract_all(text, rx, F.lit(0))
    good = F.regexp_extract_all(text, rx, F.lit(1)) if name == "assign" else found
    between = F.split(text, pattern, -1)

    def one(z: Column, i: Column) -> Column:
        match = z["m"]
        counts = F.length(z["g"]) >= 6 if name == "assign" else F.lit(True)
        if name == "blob":
            counts = match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
        return F.struct(F.lit(k).alias("kind"), i.alias("number"), F.length(z["p"]).alias("before"), F.length(match).alias("long"), counts.alias("counts"))

    zipped = F.arrays_zip(found.alias("m"), good.alias("g"), F.slice(between, 1, F.size(found)).alias("p"))
    none = F.expr("cast(array() as array<struct<kind:int,number:int,before:int,long:int,counts:boolean>>)")
    return F.when(text.rlike(pattern), F.transform(zipped, one)).otherwise(none)


def find_spans(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), scope: int = SCOPE) -> DataFrame:
    """A row for each reported span, and one without a span for each document that has none.

    Columns: __row (of the document), those in ``keep``, kind, start, end, base, and
    identifier_at and secret_at: where the nearest parts of these roles within scope
    start (a part's own start for its own role).
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("__text"), F.monotonically_increasing_id().alias("__row"))
    found = rows.select(*[F.col(f"`{c}`") for c in keep], "__row", F.concat(*[_lengths(F.col("__text"), k) for k in range(len(KINDS))]).alias("__found"))
    each = found.select(*[F.col(f"`{c}`") for c in keep], "__row", F.inline_outer("__found")).repartition("__row")
    running = Window.partitionBy("__row", "kind").orderBy("number")
    upto = F.sum(F.col("before") + F.col("long")).over(running)
    each = each.withColumn("end", upto).withColumn("start", F.col("end") - F.col("long"))
    # a match that does not count stays a row, without a role, so that its document does
    each = each.withColumn("kind", F.when(F.col("counts"), F.col("kind")))
    roles = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(k), F.lit(kind[2]))])
    each = each.withColumn("role", roles[F.col("kind")]).withColumn("base", F.col("kind") < sum(k[3] for k in KINDS))
    near = Window.partitionBy("__row").orderBy("start").rangeBetween(-scope, scope)
    has = {r: F.coalesce(F.max(F.when(F.col("role") == r, 1)).over(near), F.lit(0)) == 1 for r in ("identifier", "secret")}
    each = each.withColumns({"__id": has["identifier"], "__secret": has["secret"]})
    before, after = Window.partitionBy("__row").orderBy("start").rangeBetween(-scope, 0), Window.partitionBy("__row").orderBy("start").rangeBetween(0, scope)

    def nearest(role: str) -> Column:
        start = F.when(F.col("role") == role, F.col("start"))
        a, b = F.max(start).over(before), F.min(start).over(after)
        return F.when(b.isNull() | (F.col("start") - a <= b - F.col("start")), a).otherwise(b)

    each = each.withColumns({"identifier_at": nearest("identifier"), "secret_at": nearest("secret")})
    linked = (
        F.when(F.col("role") == "identifier", F.col("__secret"))
        .when(F.col("role") == "secret", F.col("__id"))
        .otherwise(F.col("__id") & F.col("__secret"))
    )
    reported = F.col("base") | linked
    # a document whose weak parts are all left out still has its row: its first part stays, without a span
    first = F.row_number().over(Window.partitionBy("__row").orderBy(F.col("base").desc_nulls_last(), "start", "kind")) == 1
    each = each.withColumn("__shown", F.coalesce(reported, F.lit(False))).withColumn("__first", first).filter("__shown or __first")
    names = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(k), F.lit(kind[0]))])
    shown = lambda c: F.when(F.col("__shown"), c)
    return each.select("__row", *[F.col(f"`{c}`") for c in keep], shown(F.col("kind")).alias("kind"), shown(names[F.col("kind")]).alias("name"), shown(F.col("start")).alias("start"), shown(F.col("end")).alias("end"), shown(F.col("base")).alias("base"), shown(F.col("identifier_at")).alias("identifier_at"), shown(F.col("secret_at")).alias("secret_at"))


def document_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked and links of every document.

    links has name:start:identifier:secret of each linked part, by start, the last two
    being the starts of the parts it goes with.
    """
    spans = find_spans(docs, text, (doc_id,), scope)
    entry = F.struct("start", "kind", F.concat_ws(":", "name", "start", "end").alias("shown"))
    link = F.struct("start", "kind", F.concat_ws(":", "name", "start", "identifier_at", "secret_at").alias("shown"))
    grouped = spans.groupBy("__row").agg(
        F.first(F.col(f"`{doc_id}`")).alias(doc_id),
        *[F.count(F.when(F.col("name") == k, 1)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.count(F.when(~F.col("base"), 1)).alias("n_linked"),
        F.array_sort(F.collect_list(F.when(F.col("base"), entry))).alias("__base"),
        F.array_sort(F.collect_list(F.when(F.col("start").isNotNull(), entry))).alias("__all"),
        F.array_sort(F.collect_list(F.when(~F.col("base"), link))).alias("__links"),
    )
    joined = lambda c: F.array_join(F.transform(F.col(c), lambda x: x["shown"]), ",")
    return grouped.select(doc_id, "n_assign", "n_access", "n_hex", F.sha2(joined("__base"), 256).alias("base_sha256"), joined("__all").alias("spans"), "n_linked", joined("__links").alias("links"))
