"""Cell covers, the register's rounds, the graph store, closures and substring search against plain Python."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import sequential as Q
from tessera.operators import spatial as P
from tessera.operators.substring import containing
from tessera.plans.pattern_query import QueryError, run_query


# -- points in polygons --------------------------------------------------------------
RINGS = "array<array<struct<x: double, y: double>>>"


def shape(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]


def by_rays(px, py, rings):
    on = odd = False
    for ring in rings:
        for i, (a, b) in enumerate(ring):
            c, d = ring[(i + 1) % len(ring)]
            on |= (c - a) * (py - b) == (d - b) * (px - a) and min(a, c) <= px <= max(a, c) and min(b, d) <= py <= max(b, d)
            odd ^= (b > py) != (d > py) and px < (c - a) * (py - b) / (d - b) + a
    return on, odd


def star(edges):
    """A wound line whose teeth are finer than any cell of the first grid."""
    turn = [2 * math.pi * i / edges for i in range(edges)]
    return [((2 + math.sin(9 * t) + 0.05 * math.sin(301 * t)) * math.cos(t), (2 + math.sin(9 * t) + 0.05 * math.sin(301 * t)) * math.sin(t)) for t in turn]


@pytest.mark.parametrize(("predicate", "cell", "most"), [("covered_by", 1.0, 64), ("within", 0.7, 4), ("covered_by", 50.0, 16)])
def test_cells_settle_points_as_rays_do(spark, predicate, cell, most):
    r = random.Random(3)
    polygons = [("star", [star(3000)]), *[(f"b{i}", [[(r.randrange(-12, 12) / 4, r.randrange(-12, 12) / 4) for _ in range(r.randrange(3, 12))]]) for i in range(6)], ("hole", [[(-3, -3), (3, -3), (3, 3), (-3, 3)], [(-1, -1), (1, -1), (1, 1), (-1, 1)]])]
    points = [(i % 300, r.randrange(-14, 15) / 4, r.randrange(-14, 15) / 4) for i in range(400)] + [(400 + i, r.uniform(-3.3, 3.3), r.uniform(-3.3, 3.3)) for i in range(400)] + [(2000, None, 1.0), (None, 0.0, None)]
    df = spark.createDataFrame(points, "id long, x double, y double").repartition(6)
    shapes = spark.createDataFrame([(n, shape(*rings)) for n, rings in polygons], f"name string, rings {RINGS}")
    got = sorted(str((p["id"], p["name"])) for p in P.point_in_polygon(df, shapes, "x", "y", "rings", predicate, cell, most).collect())
    want = []
    for i, x, y in points:
        tests = {n: by_rays(x, y, rings) for n, rings in polygons} if x is not None and y is not None else {}
        hits = [n for n, (on, odd) in tests.items() if (on or odd if predicate == "covered_by" else odd and not on)]
        want += [str((i, n)) for n in hits or [None]]
    assert got == sorted(want)


def test_every_dealt_point_comes_back(spark):
    """Rows of a shuffled table keep their number, and equal rows stay apart."""
    df = spark.range(2000).select((F.col("id") % 100).alias("k"), (F.col("id") % 40 / 10).alias("x"), (F.col("id") % 13).cast("double").alias("y")).repartition(6)
    square = spark.createDataFrame([("p", shape([(1, 1), (3, 1), (3, 9), (1, 9)]))], f"name string, rings {RINGS}")
    out = P.point_in_polygon(df, square, "x", "y", "rings")
    assert sorted(map(tuple, out.select("k", "x", "y").collect())) == sorted(map(tuple, df.collect()))
    assert P.point_in_polygon(df, square.limit(0), "x", "y", "rings").filter("name is null").count() == 2000


def test_cover_has_cells_without_edges(spark):
    cover = P.cell_cover(spark.createDataFrame([(1, shape(star(5000)))], f"__poly long, rings {RINGS}"), "rings", 4.0, 32)
    kinds = cover.select((F.size("__edges") == 0).alias("inside"), F.size("__edges").alias("n"), "__level").collect()
    assert sum(k["inside"] for k in kinds) > 20 and max(k["n"] for k in kinds) <= 32 and max(k["__level"] for k in kinds) >= 5


# -- the register ----------------------------------------------------------------------
REGISTER = "ord long, name string, acn string, previous string, n_columns int"


def scanned(rows):
    found = {}
    for _, name, acn, previous, width in sorted(rows):
        if width >= 14 and (not previous or previous.upper() not in found):
            found.setdefault(name, acn)
    return found


@pytest.mark.parametrize("names", [5, 40, 400])
def test_register_rounds_equal_a_scan(spark, names):
    r = random.Random(names)
    rows = [(i, f"N{r.randrange(names)}", str(i), f"n{r.randrange(names)}" if r.random() < 0.85 else "", 14 if r.random() < 0.95 else 3) for i in range(500)]
    got = Q.register_names(spark.createDataFrame(rows, REGISTER).repartition(5))
    assert {x["name"]: x["acn"] for x in got.collect()} == scanned(rows)


def test_register_chain_of_a_thousand_names(spark, monkeypatch):
    """Every name hangs on the one before; the rounds are some tens, not a thousand."""
    rows = [(i, f"N{i}", str(i), f"N{i - 1}" if i else "", 14) for i in range(1000)] + [(2000, "N7", "x", "", 14)]
    rounds = []
    settled = Q._settled
    monkeypatch.setattr(Q, "_settled", lambda now: rounds.append(1) or settled(now))
    got = Q.register_names(spark.createDataFrame(rows, REGISTER).repartition(3))
    assert {x["name"]: x["acn"] for x in got.collect()} == scanned(rows) and len(rounds) <= 3


# -- graphs ----------------------------------------------------------------------------
def nodes(spark, *names):
    return spark.createDataFrame([(n, n) for n in names], "id string, text string")


def test_save_replaces_the_whole_graph(spark, tmp_path):
    path = str(tmp_path / "g")
    G.PropertyGraph(nodes={"Old": nodes(spark, "a")}).save(path)
    new = G.PropertyGraph(nodes={"New": nodes(spark, "b", "c")}, aliases={"N": "New"})
    new.add_edges("KNOWS", "New", "New", spark.createDataFrame([("b", "c")], "src string, dst string")).save(path)
    held = G.PropertyGraph.load(spark, path)
    assert list(held.nodes) == ["New"] and held.label("N").count() == 2 and held.ends == {"KNOWS": [("New", "New")]} and held.edge("KNOWS").count() == 1
    assert sorted(p.name for p in (tmp_path / "g").iterdir() if not p.name.startswith(".")) == sorted(["graph.json", next(p.name for p in (tmp_path / "g").iterdir() if p.is_dir())])
    held.save(path)  # over the files that it reads
    assert G.PropertyGraph.load(spark, path).label("New").count() == 2


def test_a_failed_save_leaves_the_old_graph(spark, tmp_path):
    path = str(tmp_path / "g")
    G.PropertyGraph(nodes={"Old": nodes(spark, "a")}).save(path)
    bad = nodes(spark, "b").select("id", F.raise_error(F.lit("no")).cast("string").alias("text"))
    with pytest.raises(Exception, match="no"):
        G.PropertyGraph(nodes={"New": nodes(spark, "b"), "Bad": bad}).save(path)
    assert G.PropertyGraph.load(spark, path).label("Old").count() == 1


@pytest.mark.parametrize("limit", [None, 3])
def test_closure(spark, limit):
    r = random.Random(9)
    edges = [(f"n{r.randrange(25)}", f"n{r.randrange(25)}") for _ in range(40)]
    step, depth = {}, {}
    for a, b in edges:
        step.setdefault(a, set()).add(b)
    for a in step:
        level, d = {a}, 0
        while level := {y for x in level for y in step.get(x, ()) if (a, y) not in depth}:
            d += 1
            depth.update({(a, y): d for y in level})
    got = {(x["src"], x["dst"]): x["depth"] for x in G.closure(spark.createDataFrame(edges, "src string, dst string"), limit).collect()}
    assert got == {k: v for k, v in depth.items() if limit is None or v <= limit}


def test_closure_of_a_long_chain_in_few_rounds(spark, monkeypatch):
    rounds = []
    cut = G.cut
    monkeypatch.setattr(G, "cut", lambda *a: rounds.append(1) or cut(*a))
    out = G.closure(spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    assert out.count() == 300 * 301 // 2 and out.agg(F.max("depth")).first()[0] == 300 and len(rounds) <= 11


# -- substrings -------------------------------------------------------------------------
def test_substring_search(spark):
    r = random.Random(2)
    texts = [*{"".join(r.choice("abcAB é") for _ in range(r.randrange(12))) for _ in range(300)}, None, "tail abcabc"]
    terms = [*{"".join(r.choice("abCé ") for _ in range(r.randrange(6))) for _ in range(60)}, "", None, "zzzz", "AbC", "abc"]
    found = containing(spark.createDataFrame([(t,) for t in texts * 2], "name string"), "name", spark.createDataFrame([(t,) for t in terms * 2], "term string"))
    got = [(x["term"], x["text"]) for x in found.collect()]
    want = {(w, t) for w in terms for t in texts if w is not None and t is not None and w.lower() in t.lower()}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 500


def test_substring_plans_have_no_nested_loop(spark):
    graph = G.PropertyGraph(nodes={"Name": nodes(spark, "alpha", "beta", "Alpine", "xa")})
    terms = spark.createDataFrame([("alp",), ("A",), ("et",), ("",)], "term string")
    for df in (graph.search("Name", "text", terms), G.search_report(graph.label("Name"), "text", terms)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted((x["term"], x["id"]) for x in graph.search("Name", "text", terms).collect() if x["term"]) == [("A", "Alpine"), ("A", "alpha"), ("A", "beta"), ("A", "xa"), ("alp", "Alpine"), ("alp", "alpha"), ("et", "beta")]


def test_walks_use_no_edge_twice(spark):
    r = random.Random(4)
    pairs = sorted({(f"n{r.randrange(7)}", f"n{r.randrange(7)}") for _ in range(14)})
    graph = G.PropertyGraph(nodes={"N": nodes(spark, *{x for p in pairs for x in p})})
    graph.add_edges("E", "N", "N", spark.createDataFrame(pairs, "src string, dst string"))
    for way in ("out", "in", "both"):
        ahead = [(a, b, i) for i, (a, b) in enumerate(pairs)]
        back = [(b, a, i) for a, b, i in ahead]
        steps = ahead if way == "out" else back if way == "in" else ahead + [s for s in back if s[0] != s[1]]
        want, level = [], [(x, x, ()) for x in {y for p in pairs for y in p}]
        for n in range(1, 4):
            level = [(a, t, (*used, i)) for a, b, used in level for s, t, i in steps if s == b and i not in used]
            want += [(a, b, n) for a, b, _ in level if n >= 2]
        got = graph.paths(graph.label("N"), [("E", "N", "N")], 2, 3, way)
        assert sorted((x["a"], x["b"], x["length"]) for x in got.collect()) == sorted(want) and want
    with pytest.raises(ValueError, match="steps"):
        graph.paths(graph.label("N"), [("E", "N", "N")], 3, 2)


def test_patterns_of_walks_and_options(spark):
    graph = G.PropertyGraph(nodes={"P": nodes(spark, "p1", "p2", "p3"), "C": nodes(spark, "c1", "c2")})
    graph.add_edges("HAS", "P", "C", spark.createDataFrame([("p1", "c1", "x"), ("p2", "c1", "y"), ("p2", "c2", "x")], "src string, dst string, role string"))
    ask = lambda text: sorted((tuple(x) for x in run_query(graph, text).collect()), key=str)
    assert ask("MATCH (a:P)-[:HAS*2..2]-(b:P) RETURN a.id AS a, b.id AS b") == [("p1", "p2"), ("p2", "p1")]
    assert ask("MATCH (a:C)-[w:HAS*1..3]-(b:C) RETURN a.id AS a, b.id AS b, w.length AS n") == [("c1", "c2", 2), ("c2", "c1", 2)]
    assert ask("MATCH (c:C)-[r:HAS {role: 'x'}]-(p:P) RETURN c.id AS c, p.id AS p, r.src AS s") == [("c1", "p1", "p1"), ("c2", "p2", "p2")]
    assert ask("MATCH (p:P) OPTIONAL MATCH (p)-[:HAS]->(c:C) WHERE c.id = 'c2' RETURN p.id AS p, c.id AS c") == [("p1", None), ("p2", "c2"), ("p3", None)]
    assert ask("MATCH (p:P) OPTIONAL MATCH (p)-[:HAS]->(c:C) RETURN p.id AS p, count(c.id) AS n") == [("p1", 1), ("p2", 2), ("p3", 0)]
    for bad in ("MATCH (a:P)-[:HAS*]-(b:P) RETURN a.id", "MATCH (a:P)-[:HAS*2..]-(b:P) RETURN a.id", "MATCH (a:P)<-[:HAS]->(b:C) RETURN a.id", "MATCH (a:P) OPTIONAL MATCH (x:C) RETURN x.id"):
        with pytest.raises(QueryError):
            run_query(graph, bad)
