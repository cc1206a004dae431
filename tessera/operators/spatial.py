"""Points in polygons by a cover of cells.

A grid is laid over each polygon, and a cell that many of its edges touch is cut
into four, again and again. A cell then lies inside, outside (and is left out), or on
the border, where it carries the edges that touch it and whether its corner lies inside.
A point in an inside cell is settled without a test. In a border cell, a path from
the corner up the cell's left side and then across to the point changes sides at each
edge that it crosses, and those edges touch the cell: the point is settled by them alone,
with the same result as a ray through all edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.stages import written

#: Edges above which a border cell is cut, and how often at most.
CELL_EDGES = 64
CUTS = 12
#: Part of a cell's width by which its box is widened, as points at its sides are dealt to it by a rounded quotient.
_SLACK = 1e-9


def _edges(rings: str) -> Column:
    """All edges (x1, y1, x2, y2) of an array of closed or open rings of (x, y)."""
    return F.expr(
        f"""flatten(transform({rings}, r -> transform(sequence(0, size(r) - 1), i -> named_struct(
            'x1', r[i].x, 'y1', r[i].y, 'x2', r[(i + 1) % size(r)].x, 'y2', r[(i + 1) % size(r)].y))))"""
    )


def _crosses(e: str, x: str, y: str) -> str:
    """Whether a ray from (x, y) to the right crosses the edge."""
    return f"(({e}.y1 > {y}) <> ({e}.y2 > {y}) and {e}.y1 <> {e}.y2 and ({e}.x2 - {e}.x1) * ({y} - {e}.y1) / if({e}.y2 = {e}.y1, 1.0D, {e}.y2 - {e}.y1) + {e}.x1 > {x})"


def _inside(x: str, y: str, x0: str, y0: str, corner: str, edges: str) -> str:
    """Whether (x, y) lies inside, from whether (x0, y0) does and the edges that touch a box with both.

    An edge with ends on both sides of the line x = x0 counts on the way up where
    what it adds to the rays from that line differs at y0 and y; ends to the right cancel
    in pairs, as rings are closed. On the way across an edge counts where one of the two rays crosses it.
    """
    up = f"((e.x1 > {x0}) <> (e.x2 > {x0}) and ((if(e.x1 > {x0}, e.y1, e.y2) > {y0}) <> {_crosses('e', x0, y0)}) <> ((if(e.x1 > {x0}, e.y1, e.y2) > {y}) <> {_crosses('e', x0, y)}))"
    across = f"({_crosses('e', x0, y)} <> {_crosses('e', x, y)})"
    return f"(({corner} + size(filter({edges}, e -> {up} <> {across}))) % 2 = 1)"


def _on(x: str, y: str, edges: str) -> str:
    """Whether (x, y) is on an edge."""
    return f"""exists({edges}, e -> (e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1)
        and {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2) and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2))"""


def cell_cover(polygons: DataFrame, rings: str, cell: float = 1.0, cell_edges: int = CELL_EDGES, cuts: int = CUTS) -> DataFrame:
    """__poly, __level, __cx, __cy, __corner (1 where the cell's lower left corner is inside) and __edges, which are none in an inside cell.

    Cells of level n are cell / 2**n wide. polygons have __poly, a number of their own.
    """
    box = lambda of, c: F.floor(of / c)
    edges = polygons.select("__poly", F.explode(_edges(rings)).alias("e"))
    slack = cell * _SLACK
    near = lambda a, b: F.sequence(box(F.least(f"e.{a}", f"e.{b}") - slack, cell), box(F.greatest(f"e.{a}", f"e.{b}") + slack, cell))
    touched = edges.withColumn("__cx", F.explode(near("x1", "x2"))).withColumn("__cy", F.explode(near("y1", "y2"))).groupBy("__poly", "__cx", "__cy").agg(F.collect_list("e").alias("__edges"))
    # on the line below each row of cells: where edges cross it, and for each cell how many do to its right
    sides = edges.groupBy("__poly").agg(*[f(f"e.{c}1").alias(n) for n, f, c in (("x0", F.min, "x"), ("x1", F.max, "x"), ("y0", F.min, "y"), ("y1", F.max, "y"))])
    rows = sides.select("__poly", F.sequence(box(F.col("x0") - slack, cell), box(F.col("x1") + slack, cell)).alias("__xs"), F.explode(F.sequence(box(F.col("y0") - slack, cell), box(F.col("y1") + slack, cell))).alias("__cy"))
    lines = edges.withColumn("__cy", F.explode(near("y1", "y2"))).withColumn("__y", F.col("__cy") * F.lit(cell)).filter("(e.y1 > __y) <> (e.y2 > __y)")
    lines = lines.groupBy("__poly", "__cy").agg(F.collect_list(F.expr("(e.x2 - e.x1) * (__y - e.y1) / (e.y2 - e.y1) + e.x1")).alias("__at"))
    corners = rows.join(lines, ["__poly", "__cy"], "left").select("__poly", "__cy", "__at", F.explode("__xs").alias("__cx"))
    corners = corners.select("__poly", "__cx", "__cy", (F.size(F.filter(F.coalesce("__at", F.expr("cast(array() as array<double>)")), lambda x: x > F.col("__cx") * F.lit(cell))) % 2).alias("__corner"))
    none = F.expr("cast(array() as array<struct<x1:double,y1:double,x2:double,y2:double>>)")
    now = corners.join(touched, ["__poly", "__cx", "__cy"], "left").withColumn("__edges", F.coalesce("__edges", none)).filter("__corner = 1 or size(__edges) > 0").withColumn("__level", F.lit(0))
    columns = ["__poly", "__level", "__cx", "__cy", "__corner", "__edges"]
    now = written(now.select(*columns), "cells")
    done = now.filter(F.size("__edges") <= cell_edges)
    for level in range(1, cuts + 1):
        crowded = now.filter(F.size("__edges") > cell_edges)
        if crowded.isEmpty():
            return done
        width, slack = cell / 2**level, cell / 2**level * _SLACK
        four = crowded.withColumn("q", F.explode(F.expr("sequence(0, 3)"))).select(
            "__poly", "__edges", "__corner", (F.col("__cx") * 2 * F.lit(width)).alias("px"), (F.col("__cy") * 2 * F.lit(width)).alias("py"),
            (F.col("__cx") * 2 + F.col("q") % 2).alias("__cx"), (F.col("__cy") * 2 + F.floor(F.col("q") / 2)).alias("__cy"),
        )
        four = four.withColumns({"x": F.col("__cx") * F.lit(width), "y": F.col("__cy") * F.lit(width)})
        own = F.expr(f"""filter(__edges, e -> least(e.x1, e.x2) <= x + {width + slack!r}D and greatest(e.x1, e.x2) >= x - {slack!r}D
            and least(e.y1, e.y2) <= y + {width + slack!r}D and greatest(e.y1, e.y2) >= y - {slack!r}D)""")
        four = four.select("__poly", F.lit(level).alias("__level"), "__cx", "__cy", F.expr(f"int({_inside('x', 'y', 'px', 'py', '__corner', '__edges')})").alias("__corner"), own.alias("__edges"))
        now = written(four.filter("__corner = 1 or size(__edges) > 0"), "cells")
        done = done.unionByName(now.filter(F.size("__edges") <= cell_edges) if level < cuts else now)
    return done


def point_in_polygon(points: DataFrame, polygons: DataFrame, x: str, y: str, rings: str, predicate: str = "covered_by", cell: float = 1.0, cell_edges: int = CELL_EDGES, cuts: int = CUTS) -> DataFrame:
    """points with the columns of each polygon they lie in; a point in none, or without a place, has nulls.

    covered_by takes points on an edge, within leaves them out. Cells begin with the
    width of ``cell`` and are cut where edges are dense. A point row meets the cells
    of one place, which come to it as a list, so it stays one row until its polygons are
    known, however the points are dealt. Each level of cells that is in use is one join, whose
    larger side may be split.
    """
    if predicate not in ("covered_by", "within"):
        raise ValueError(predicate)
    attributes = [c for c in polygons.columns if c != rings]
    numbered = written(polygons.withColumn("__poly", F.monotonically_increasing_id()), "polygons")
    cover = written(cell_cover(numbered, rings, cell, cell_edges, cuts).join(numbered.select("__poly", F.struct(*[F.col(f"`{c}`") for c in attributes], F.lit(1).alias("__in")).alias("__of")), "__poly"), "cover")
    levels = sorted(r[0] for r in cover.select("__level").distinct().collect())  # at most one for each cut
    out = points.withColumns({"__px": F.col(x).cast("double"), "__py": F.col(y).cast("double")})
    lists = []
    for n in levels:
        width = cell / 2**n
        here = cover.filter(F.col("__level") == n).groupBy("__cx", "__cy").agg(F.collect_list(F.struct("__of", "__corner", "__edges")).alias(f"__cells{n}"))
        here = written(here, "cover-level")
        out = out.withColumns({"__cx": F.floor(F.col("__px") / width), "__cy": F.floor(F.col("__py") / width)}).join(here, ["__cx", "__cy"], "left")
        x0, y0 = f"(floor(__px / {width!r}D) * {width!r}D)", f"(floor(__py / {width!r}D) * {width!r}D)"
        inside, on = _inside("__px", "__py", x0, y0, "k.__corner", "k.__edges"), _on("__px", "__py", "k.__edges")
        hit = f"{inside} or {on}" if predicate == "covered_by" else f"{inside} and not {on}"
        lists.append(F.expr(f"transform(filter(coalesce(__cells{n}, array()), k -> {hit}), k -> k.__of)"))
    found = F.concat(*lists) if lists else F.array().cast(f"array<{numbered.select(F.struct(*[F.col(f'`{c}`') for c in attributes]).alias('s')).schema['s'].dataType.simpleString()}>")
    own = [F.col(f"`{c}`") for c in points.columns]
    each = out.select(*own, F.explode_outer(found).alias("__of"))
    return each.select(*own, *[F.col(f"__of.`{c}`").alias(c) for c in attributes])
