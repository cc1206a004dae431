"""Two scans whose outcome for a row depends on the rows before it, settled by rounds of joins.

Every name has bounds of the place of the first row that counts for it. Rows whose
outcome follows from the bounds are settled, which narrows the bounds, until no row
is open. A round's tables are written to the cluster's shared folder
(spark.checkpoint.dir), and those of the round before deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.stages import release, written


def register_names(register: DataFrame, order: str = "ord", name: str = "name", number: str = "acn", previous: str = "previous", width: str = "n_columns") -> DataFrame:
    """name -> number of the first row of each name that is eligible when the register is read in order.

    A row of at least 14 columns is eligible if it names no previous company, or one
    that, in upper case, is not yet a name of the result.

    Each name has a lower and an upper bound of the place of its first eligible row:
    its first row not ruled out, and its first row known to be eligible. A row is
    settled where the bounds of its previous name lie on one side of it. Rows depend on
    earlier rows only, so joins of rows with bounds settle the earliest open row at
    least, and mostly all. Names with one open row form chains, in which a row is
    eligible if and only if the one before it is not: a chain of any length is settled by
    following its links two by two, in rounds as many as the logarithm of its length.
    """
    rows = register.select(F.col(order).alias("ord"), F.trim(name).alias("name"), F.trim(F.col(number).cast("string")).alias("acn"), F.upper(F.trim(F.coalesce(F.col(previous), F.lit("")))).alias("prev"), F.col(width).alias("n"))
    rows = rows.filter("name <> '' and acn <> '' and n >= 14")
    # numbers come back at the end; what is after a name's first row without a previous name cannot count
    first = rows.filter("prev = ''").groupBy("name").agg(F.min("ord").alias("hi"))
    lean = rows.select("ord", "name", "prev").join(first, "name", "left").filter("hi is null or ord <= hi")
    now = written(lean.select("ord", "name", "prev", (F.col("prev") == "").alias("eligible")), "register")
    while not now.filter("not eligible").isEmpty():
        after = _settled(now)
        release(now)
        now = after
    firsts = now.groupBy("name").agg(F.min("ord").alias("ord"))
    return rows.select("name", "ord", "acn").join(firsts, ["name", "ord"], "left_semi").groupBy("name").agg(F.min_by("acn", "ord").alias("acn"))


def _settled(now: DataFrame) -> DataFrame:
    """One round: rows of (ord, name, prev, eligible) with those ruled out left out, and those now known to be eligible marked."""
    bounds = now.groupBy("name").agg(F.min("ord").alias("lo"), F.min(F.when(F.col("eligible"), F.col("ord"))).alias("hi"), F.count_if(~F.col("eligible")).alias("open"))
    bounds = written(bounds, "register-bounds")
    own = bounds.select("name", F.col("hi").alias("own_hi"), F.col("open").alias("own_open"))
    of_prev = bounds.select(F.col("name").alias("prev"), "lo", F.col("hi").alias("prev_hi"), F.col("open").alias("prev_open"))
    held = now.filter("not eligible").join(own, "name").filter("own_hi is null or ord <= own_hi").join(of_prev, "prev", "left")
    verdict = F.when(F.col("lo").isNull() | (F.col("lo") >= F.col("ord")), True).when(F.col("prev_hi") < F.col("ord"), False)
    held = written(held.select("ord", "name", "prev", "own_open", "prev_open", verdict.alias("verdict")), "register-held")
    release(bounds)
    chain = held.filter("own_open = 1")
    link = F.when(F.col("verdict").isNull() & (F.col("prev_open") == 1), F.col("prev"))
    chain = written(chain.select("name", link.alias("source"), F.lit(True).alias("flip"), "verdict"), "register-chain")
    while not chain.filter("source is not null").isEmpty():
        up = chain.select(F.col("name").alias("source"), F.col("source").alias("further"), F.col("flip").alias("flip_up"), F.col("verdict").alias("verdict_up"))
        stepped = chain.join(up, "source", "left")
        turned = F.when(F.col("source").isNull(), F.col("verdict")).otherwise(F.col("verdict_up") != F.col("flip"))
        after = written(stepped.select("name", F.when(F.col("source").isNotNull(), F.col("further")).alias("source"), F.when(F.col("further").isNull(), True).otherwise(F.col("flip") != F.col("flip_up")).alias("flip"), turned.alias("verdict")), "register-chain")
        release(chain)
        chain = after
    known = chain.filter("verdict is not null").select("name", F.col("verdict").alias("by_chain"))
    judged = held.join(known, "name", "left").withColumn("verdict", F.coalesce("verdict", "by_chain")).filter("verdict is null or verdict")
    left = judged.select("ord", "name", "prev", F.coalesce("verdict", F.lit(False)).alias("eligible"))
    out = written(now.filter("eligible").unionByName(left), "register")
    release(held, chain)
    return out


def consolidate(master: DataFrame, order: str = "ord", company: str = "name", synonyms: str = "synonyms", number: str = "acn", fill: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The master table with rows absorbed by earlier ones that have one of their names, and a log of what was absorbed.

    In order, a row without a number one of whose names an earlier kept row
    registered is dropped: it fills that row's null columns (``fill``) and appends its
    new names, sorted. Other rows stay and register the names not yet known. Names
    that a row gains by absorbing are not registered.

    Rows are settled as those of the register: a row stays where no row that may stay
    has one of its names before it, and goes where one that does stay has; each round
    settles the earliest open row at least, and most rows at once. What a kept row gains is
    then a matter of aggregates, so a row that absorbs very many others is no group of its own.
    """
    names = F.expr(f"filter(transform(concat(array(coalesce(`{company}`, '')), coalesce(split(`{synonyms}`, ','), array())), x -> trim(x)), x -> x <> '')")
    rows = written(master.withColumns({"__ord": F.col(f"`{order}`").cast("long"), "__names": names}), "consolidate")
    each = rows.select("__ord", F.col(f"`{number}`").isNotNull().alias("fixed"), F.posexplode("__names").alias("pos", "spelling"))
    each = each.groupBy("__ord", "fixed", F.lower("spelling").alias("key")).agg(F.min(F.struct("pos", "spelling")).alias("s"))
    own = written(each.select("__ord", "fixed", "key", "s.pos", "s.spelling"), "consolidate-names")
    first_of = lambda kept: kept.groupBy("key").agg(F.min("__ord").alias("__ord")).select("__ord", "key", F.lit(True).alias("stays"))
    now = written(first_of(own.filter("fixed")).unionByName(own.filter("not fixed").select("__ord", "key", F.lit(False).alias("stays"))), "consolidate-open")
    while not now.filter("not stays").isEmpty():
        bounds = now.groupBy("key").agg(F.min("__ord").alias("lo"), F.min(F.when(F.col("stays"), F.col("__ord"))).alias("hi"))
        bounds = written(bounds, "consolidate-bounds")
        waiting = now.filter("not stays").join(bounds, "key").groupBy("__ord").agg(F.bool_or(F.coalesce(F.col("hi") < F.col("__ord"), F.lit(False))).alias("goes"), F.bool_and(F.col("lo") >= F.col("__ord")).alias("stays"))
        left = now.filter("not stays").drop("stays").join(waiting.filter("not goes").drop("goes"), "__ord")
        after = written(first_of(now.filter("stays").unionByName(left.filter("stays"))).unionByName(left.filter("not stays").select("__ord", "key", "stays")), "consolidate-open")
        release(bounds, now)
        now = after
    owners = now.select("key", F.col("__ord").alias("target"))
    hits = own.filter("not fixed").join(owners, "key").filter("target < __ord")
    gone = written(hits.groupBy("__ord").agg(F.min_by("target", "pos").alias("__target"), F.min_by("spelling", "pos").alias("__matched")), "consolidate-gone")
    release(now)

    # names that the target lacks, each as the first row that brings it spells it
    brought = gone.select("__ord", "__target").join(own.select("__ord", "key", "spelling"), "__ord").groupBy("__target", "key").agg(F.min(F.struct("__ord", "spelling")).alias("s"))
    new = brought.join(own.select(F.col("__ord").alias("__target"), "key"), ["__target", "key"], "left_anti")
    gained = new.groupBy("__target").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["spelling"]), ", ").alias("__gained"))
    absorbed = gone.join(rows.select("__ord", *[F.col(f"`{c}`").alias(f"__fill_{c}") for c in fill]), "__ord")
    firsts = [F.min(F.when(F.col(f"__fill_{c}").isNotNull(), F.struct("__ord", f"__fill_{c}"))).alias(f"__first_{c}") for c in fill]
    gains = gained if not fill else gained.join(absorbed.groupBy("__target").agg(*firsts), "__target", "full")
    gains = written(gains, "consolidate-gains")

    kept = rows.join(gone.select("__ord"), "__ord", "left_anti").join(gains, F.col("__ord") == F.col("__target"), "left")
    values = {c: F.coalesce(F.col(f"`{c}`"), F.col(f"__first_{c}.__fill_{c}")) for c in fill}
    values[synonyms] = F.when(F.col("__gained").isNull(), F.col(f"`{synonyms}`")).otherwise(F.concat_ws(", ", F.nullif(F.col(f"`{synonyms}`"), F.lit("")), "__gained"))
    out = kept.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in master.columns])

    said = own.groupBy("__ord").agg(F.array_join(F.array_sort(F.collect_list("spelling")), ", ").alias("merged_names"))
    used = gone.join(said, "__ord").join(gains.drop("__gained"), "__target", "left").join(rows.select(F.col("__ord").alias("__target"), *[F.col(f"`{c}`").isNull().alias(f"__empty_{c}") for c in fill]), "__target")
    filled = [F.when(F.col(f"__empty_{c}") & (F.col(f"__first_{c}.__ord") == F.col("__ord")), F.lit(c)) for c in fill]
    log = used.select(F.col("__matched").alias("matched_name"), F.col("__target").alias("target"), F.col("__ord").alias("dropped"), "merged_names", F.concat_ws(", ", *filled).alias("updated_columns") if fill else F.lit("").alias("updated_columns"))
    return out, log
