"""Operators against plain loops, and independence of row order."""

from __future__ import annotations

import random
import struct

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators import matching as M
from tessera.operators import order as O
from tessera.operators import relational as R
from tessera.operators import sequential as Q
from tessera.operators import spatial as P
from tessera.plans.pattern_query import QueryError, ask, run_query, strip_fence
from tessera.sources import readers, writers


@pytest.mark.parametrize("n", [1, 5])
def test_ids_do_not_depend_on_partitions(spark, n):
    df = spark.createDataFrame([(f"k{i * 37 % 200:03d}",) for i in range(200)], "k string").repartition(n)
    got = {r["k"]: r["id"] for r in O.dense_ids(df, ["k"], "p_", range_partitions=3).collect()}
    assert got == {f"k{i:03d}": f"p_{i + 1}" for i in range(200)}


def test_order_operators(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, "b", 2), (4, None, 9)], "ord int, k string, v int").repartition(3)
    assert sorted(r["ord"] for r in O.keep_first(df, ["k"], ["ord"]).collect()) == [1, 3, 4]
    assert {r["k"]: r["x"] for r in O.last_wins(df, ["k"], "v", "ord", "x").collect()} == {"a": 1, "b": 2, None: 9}
    other = spark.createDataFrame([(1, "b", 5), (2, "c", 6), (3, "c", 7)], "ord int, k string, v int")
    assert sorted((r["k"], r["v"]) for r in O.union_keep_first([df, other], "k", "ord").collect()) == [("a", 3), ("b", 2), ("c", 6)]
    assert sorted((r["k"], r["v"]) for r in O.union_first_source([df.filter("k is not null"), other], "k").collect()) == [("a", 1), ("a", 3), ("b", 2), ("c", 6), ("c", 7)]


def test_relational(spark):
    df = spark.createDataFrame([("AU", None, None), (None, None, None), ("US", 1.0, None), ("US", None, None)], "c string, x double, y double")
    assert sorted((r["c"], r["x"]) for r in R.without_unlisted(df, "c", "AU", ["x", "y"]).collect()) == [("AU", None), ("US", 1.0)]
    pairs = spark.createDataFrame([("A", "B"), ("A", "Z")], "a string, b string")
    roles = spark.createDataFrame([("A", "Au", "Primary"), ("A", "Ag", "Secondary"), ("B", "Au", "Secondary"), ("B", "Cu", "Primary"), ("A", "Ag", "Other")], "e string, i string, r string")
    got = {r["b"]: r["similarity"] for r in R.weighted_jaccard(roles, "e", "i", "r", {"Primary": 1.0, "Secondary": 0.5}, 0.1, pairs).collect()}
    assert got["B"] == pytest.approx(0.2) and got["Z"] == 0
    assert R.rename_if_count(df, ["p", "q"]).columns == ["c", "x", "y"] and R.rename_if_count(df, ["p", "q", "r"]).columns == ["p", "q", "r"]
    assert R.move_column(df, "y", "c", drop_target=True).columns == ["y", "x"]
    assert R.fixed_columns(df, ["c", "z"]).first() == ("AU", "")
    assert R.ensure_columns(df, ["z", "c"]).columns == ["z", "c"] and R.upper_columns(df).columns == ["C", "X", "Y"]
    assert R.differing(spark.createDataFrame([("a", "a"), ("a", None), (None, "a")], "a string, b string"), "a", "b").count() == 1


def test_matching(spark):
    left = spark.createDataFrame([(1, "Acme Gold Ltd"), (2, "Zinc Road"), (3, "Acme Gold"), (4, "Ltd"), (5, "Blue Star Mining")], "ord int, name string")
    right = spark.createDataFrame([(1, "Acme Gold Australia", 10), (2, "ACME GOLD", 20), (3, "Other Thing", 30), (4, "Blue Star Minings", 40)], "ord int, name string, staff int")
    a, b = M.prepared(left, "name", "ord"), M.prepared(right, "name", "ord")
    assert sorted(r["norm"] for r in a.collect()) == ["acme gold", "blue star mining", "zinc road"]
    got = {r["l"]: (r["r"], r["status"]) for r in M.match(a, b).collect()}
    assert got["acme gold"] == ("acme gold", "no_space_exact_match") and got["zinc road"] == (None, "no_candidate_found")
    assert got["blue star mining"] == ("blue star minings", "confident_score_match")
    off = {r["l"]: r["status"] for r in M.match(a, b, vector=None).collect()}
    assert off["blue star mining"] == "low_confidence"
    merged = M.enrich_append(left.withColumn("Source", F.lit("A")), right, "name", "ord", ["staff"], "B")
    rows = {r["norm"]: (r["staff"], r["Source"]) for r in merged.collect()}
    assert rows == {"acme gold": (20, "A"), "blue star mining": (40, "A"), "zinc road": (None, "A"), "acme gold au": (10, "B"), "other thing": (30, "B")}
    ids = {r["norm"]: r["companyID"] for r in M.with_company_ids(merged, ["Source", "ord"]).collect()}
    assert ids["acme gold"] == "comp_1" and ids["other thing"] == "comp_5"


def test_register_names_equals_a_scan(spark):
    r = random.Random(3)
    rows = [(i, f"N{r.randrange(30)}", str(100 + i), r.choice(["", f"n{r.randrange(30)}", f"N{r.randrange(30)}"]), r.choice([14, 14, 14, 5])) for i in range(120)]
    found: dict[str, str] = {}
    for _, name, acn, previous, width in rows:
        if width >= 14 and (not previous or previous.upper() not in found):
            found.setdefault(name, acn)
    df = spark.createDataFrame(rows, "ord long, name string, acn string, previous string, n_columns int").repartition(4)
    assert {x["name"]: x["acn"] for x in Q.register_names(df).collect()} == found


def consolidated_by_loop(rows):
    kept, owner, dropped = {}, {}, []
    for ord_, name, synonyms, acn, revenue in rows:
        own = {}
        for n in [name or "", *(synonyms or "").split(",")]:
            if n.strip():
                own.setdefault(n.strip().lower(), n.strip())
        hit = next((k for k in own if k in owner), None)
        if hit is not None and acn is None:
            t = kept[owner[hit]]
            t[3] = revenue if t[3] is None else t[3]
            held = {t[0].strip().lower(), *(s.strip().lower() for s in (t[1] or "").split(","))}
            new = sorted(n for k, n in own.items() if k not in held)
            if new:
                t[1] = ", ".join([*([t[1]] if t[1] else []), *new])
            dropped.append(ord_)
        else:
            kept[ord_] = [name, synonyms, acn, revenue]
            for k in own:
                owner.setdefault(k, ord_)
    return {k: tuple(v) for k, v in kept.items()}, dropped


def test_consolidate_equals_a_scan(spark):
    r = random.Random(5)
    name = lambda: r.choice("ABCDEFGH") + r.choice("xyz")
    rows = [(i, name(), r.choice([None, name(), f"{name()}, {name().lower()}"]), r.choice([None, None, str(i)]), r.choice([None, float(i)])) for i in range(40)]
    kept, log = Q.consolidate(spark.createDataFrame(rows, "ord long, name string, synonyms string, acn string, revenue double").repartition(3), fill=("revenue",))
    want, dropped = consolidated_by_loop(rows)
    assert {x["ord"]: (x["name"], x["synonyms"], x["acn"], x["revenue"]) for x in kept.collect()} == want
    assert sorted(x["dropped"] for x in log.collect()) == dropped and dropped


def test_points_on_borders(spark):
    square = [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}], [{"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 1.0}, {"x": 2.0, "y": 2.0}, {"x": 1.0, "y": 2.0}]]
    polygons = spark.createDataFrame([("p", square)], "name string, rings array<array<struct<x: double, y: double>>>")
    points = [("edge", 0.0, 2.0), ("corner", 4.0, 4.0), ("in", 3.0, 3.0), ("hole", 1.5, 1.5), ("rim", 1.0, 1.5), ("out", 5.0, 2.0), ("none", None, 1.0)]
    df = spark.createDataFrame(points, "id string, x double, y double")
    got = lambda how: {r["id"] for r in P.point_in_polygon(df, polygons, "x", "y", "rings", how).collect() if r["name"]}
    assert got("covered_by") == {"edge", "corner", "in", "rim"} and got("within") == {"in"}
    assert P.point_in_polygon(df, polygons, "x", "y", "rings", "within").count() == len(points)


@pytest.fixture(scope="module")
def graph(spark):
    g = G.PropertyGraph(aliases={"Deposit": "Project", "HAS": "HAS_COMMODITY"})
    g.add_nodes("Project", spark.createDataFrame([("p1", "Alpha", 1), ("p2", "Beta", 2)], "id string, name string, eno int"))
    g.add_nodes("Commodity", spark.createDataFrame([("c1", "Au"), ("c2", "Cu")], "id string, symbol string"))
    edges = [("p1", "c1", "Primary"), ("p1", "c1", "Primary"), ("p1", "c2", "Secondary"), ("p2", "c1", "Secondary"), ("p9", "c1", "Primary")]
    return g.add_edges("HAS_COMMODITY", "Project", "Commodity", spark.createDataFrame(edges, "src string, dst string, role string"))


def test_pattern_queries(graph):
    run = lambda q, **p: sorted(tuple(r) for r in run_query(graph, q, p).collect())
    assert run("MATCH (d:Deposit {eno: $eno})-[h:HAS]->(c:Commodity) RETURN c.symbol AS symbol, h.role AS role", eno=1) == [("Au", "Primary"), ("Cu", "Secondary")]
    assert run("MATCH (a:Project)-[:HAS]->(x:Commodity)<-[:HAS]-(b:Project) WHERE a.eno < b.eno RETURN a.name AS a, x.symbol AS x, b.name AS b") == [("Alpha", "Au", "Beta")]
    assert run("UNWIND $names AS n MATCH (p:Project) WHERE toLower(p.name) CONTAINS toLower(n) RETURN n, p.name AS name", names=["ALP", "zz"]) == [("ALP", "Alpha")]
    assert run("MATCH (p:Project) RETURN p.name AS name ORDER BY name DESC LIMIT 1") == [("Beta",)]
    assert run("MATCH (p:Project)-[]->(c:Commodity) RETURN DISTINCT c.symbol AS s UNION MATCH (c:Commodity) RETURN c.symbol AS s") == [("Au",), ("Cu",)]
    for bad in ("CREATE (n:Project)", "MATCH (p:Project) DELETE p", "MATCH (p:Project) RETURN q.x", "MATCH (p:Nothing)-[:HAS]->(c) RETURN c.id", "RETURN ;;"):
        with pytest.raises((QueryError, KeyError)):
            run(bad)
    assert strip_fence("```cypher\nMATCH\n```") == "MATCH"
    assert ask(graph, "which?", lambda q, schema: "```\nMATCH (p:Project) RETURN p.name AS n\n```" if "Project" in schema else "").count() == 2


def test_graph_tables(spark, graph, tmp_path):
    assert graph.edge("HAS").count() == 3  # the repeated edge once, the one without a node not at all
    graph.save(str(tmp_path / "g"))
    assert G.PropertyGraph.load(spark, str(tmp_path / "g")).label("Project").count() == 2
    graph.register()
    assert spark.sql("select count(*) from node_Project join edge_HAS_COMMODITY on id = src").first()[0] == 3
    terms = spark.createDataFrame([("a",), ("zz",)], "term string")
    assert {r["term"]: r["match_count"] for r in G.search_report(graph.label("Project"), "name", terms).collect()} == {"a": 2, "zz": 0}
    closed = G.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d")], "src string, dst string"))
    assert {(r["src"], r["dst"]): r["depth"] for r in closed.collect()} == {("a", "b"): 1, ("b", "c"): 1, ("a", "c"): 1, ("c", "d"): 1, ("b", "d"): 2, ("a", "d"): 2}


def shp_bytes(polygons):
    body = b""
    for i, rings in enumerate(polygons):
        points = [p for ring in rings for p in ring]
        starts, at = [], 0
        for ring in rings:
            starts.append(at)
            at += len(ring)
        content = struct.pack("<i4dii", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">ii", i + 1, len(content) // 2) + content
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<ii8d", 1000, 5, *([0.0] * 8)) + body


def dbf_bytes(fields, rows):
    width = 1 + sum(n for _, n in fields)
    head = struct.pack("<BBBBIHH20x", 3, 0, 0, 0, len(rows), 33 + 32 * len(fields), width)
    head += b"".join(name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([n]) + b"\0" * 15 for name, n in fields)
    return head + b"\r" + b"".join(b" " + b"".join(str(v).encode().ljust(n) for v, (_, n) in zip(row, fields, strict=True)) for row in rows)


def test_readers_and_writers(spark, tmp_path):
    square = [[(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]]
    (tmp_path / "r.shp").write_bytes(shp_bytes([square, square]))
    (tmp_path / "r.dbf").write_bytes(dbf_bytes([("NAME", 8), ("TYPE", 10)], [("One", "Igneous"), ("Two", "")]))
    shapes = readers.shapefile(spark, str(tmp_path / "r.shp"), ["NAME", "TYPE"])
    assert [(r["NAME"], r["TYPE"], len(r["rings"][0])) for r in shapes.orderBy("ord").collect()] == [("One", "Igneous", 4), ("Two", None, 4)]
    points = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert P.point_in_polygon(points, shapes, "x", "y", "rings").count() == 2
    with pytest.raises(Exception, match="missing fields"):
        readers.shapefile(spark, str(tmp_path / "r.shp"), ["NOPE"]).collect()

    (tmp_path / "d.json").write_text('﻿{"features": [{"properties": {"ENO": "7", "STATE": null}, "geometry": {"coordinates": [1.5, 2]}}, {"properties": null, "geometry": null}]}', encoding="utf-8")
    got = readers.geojson_points(spark, str(tmp_path / "d.json"), ["ENO", "STATE"]).orderBy("ord").collect()
    assert [(r["ENO"], r["longitude"], r["latitude"]) for r in got] == [("7", 1.5, 2.0), (None, None, None)]

    (tmp_path / "reg.tsv").write_text('A LTD\t11\nB\t12' + "\t" * 12 + "OLD B\nragged\n")
    reg = readers.register_tsv(spark, str(tmp_path / "reg.tsv")).orderBy("ord").collect()
    assert [(r["name"], r["acn"], r["previous"], r["n_columns"]) for r in reg] == [("A LTD", "11", "", 2), ("B", "12", "OLD B", 14)]

    df = spark.createDataFrame([("1", 'say "hi"\nthere', None), ("2", "", "x")], "id string, t string, u string")
    writers.write_csv(df, str(tmp_path / "out"), bom=True)
    back = readers.csv_strings(spark, str(tmp_path / "out"))
    assert back.columns == ["id", "t", "u"]
    assert sorted((r["id"], r["t"], r["u"]) for r in back.collect()) == [("1", 'say "hi"\nthere', None), ("2", None, "x")]
    assert readers.csv_or_none(spark, str(tmp_path / "absent.csv")) is None
    (tmp_path / "f1").mkdir()
    (tmp_path / "f1" / "b.csv").write_text("Ticker,x\nT1,1\nT1,2\n")
    (tmp_path / "f1" / "a.csv").write_text("Ticker,x\nT2,3\n")
    (tmp_path / "f1" / "c.csv").write_text("Other\n1\n")
    (tmp_path / "f1" / "d.csv").write_text("")
    folder = readers.csv_folders(spark, [str(tmp_path / "f1")], "Ticker")
    assert sorted((r["Ticker"], r["x"], r["file_rank"]) for r in folder.collect()) == [("T1", "1", 1), ("T1", "2", 1), ("T2", "3", 0)]

    pairs = spark.createDataFrame([("Au", "Gold", 1), ("Copper", "Cu", 2), ("Au", "Golden", 3), ("", "x", 4)], "a string, b string, o int")
    names, symbols = readers.lookup_pairs(pairs, "a", "b", "o")
    assert {r["symbol"]: r["name"] for r in names.collect()} == {"Au": "Golden", "Cu": "Copper"}
    assert {r["name"]: r["symbol"] for r in symbols.collect()} == {"Gold": "Au", "Golden": "Au", "Copper": "Cu"}
