"""Queries that take whole tables, on small tables that exercise every step."""

from __future__ import annotations

import pytest
from test_operators import consolidated_by_loop

from tessera.operators import graph as G
from tessera.plans import queries as core


def put(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def by_sql(folder, name, *tables):
    con = pytest.importorskip("duckdb").connect()
    for t in tables:
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    out = con.sql(core.ORACLES[name])
    return out.columns, out.fetchall()


def test_cascade_reaches_every_source(spark, tmp_path):
    rows = [("red gold mine", 3), ("red gold pit", 4), ("blue zinc", 1), ("blue zinc road", 5), ("grey tin", 2), ("lone word", None)]
    sf = put(spark, tmp_path, part=([(i, n, s, "Brand#1", "STANDARD") for i, (n, s) in enumerate(rows)], "p_partkey long, p_name string, p_size int, p_brand string, p_type string"))
    df = core.QUERIES["cascade_match"](spark, sf)
    got = {r["l"]: (r["r"], r["matched_source"]) for r in df.collect()}
    assert got == {
        "red gold mine": ("red gold mine", "s0"), "red gold pit": ("red gold mine", "s0"), "blue zinc": ("blue zinc", "s1"),
        "blue zinc road": ("blue zinc", "s1"), "grey tin": ("grey tin", "s2"), "lone word": (None, None),
    }
    columns, want = by_sql(sf, "cascade_match", "part")
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want))


def test_consolidated_takes_every_row(spark, tmp_path):
    rows = [(i, f"n{i * 7 % 5}", f"Brand#{i % 2}", f"T{i % 3}", i % 6, float(i)) for i in range(1, 41)]
    sf = put(spark, tmp_path, part=(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"))
    master = [(k, f"{n} {b}", f"{n} {t}" if k % 3 == 0 else None, str(k) if k % 5 == 0 else None, price if size % 2 == 0 else None) for k, n, b, t, size, price in rows]
    want, dropped = consolidated_by_loop(master)
    assert dropped and {k % 4 for k in dropped} == {0, 1, 2, 3}
    assert {r["ord"]: (r["name"], r["synonyms"], r["acn"], r["revenue"]) for r in core.QUERIES["consolidated"](spark, sf).collect()} == want


def test_merged_edges_of_all_ends(spark, tmp_path):
    sf = put(
        spark, tmp_path, customer=([(1, 3), (2, 17)], "c_custkey long, c_nationkey int"), supplier=([(4,), (6,)], "s_suppkey long"),
        orders=([(10, 1), (11, 2), (12, 9), (13, None)], "o_orderkey long, o_custkey long"),
        lineitem=([(10, 4, "A"), (10, 4, "A"), (10, 4, "R"), (11, 6, "N"), (11, 5, "N"), (12, 4, "A"), (13, 4, "A"), (11, None, "A")], "l_orderkey long, l_suppkey long, l_returnflag string"),
    )
    got = sorted((r["src"], r["dst"], r["role"]) for r in core.QUERIES["merged_edges"](spark, sf).collect())
    assert got == [(1, 4, "A"), (1, 4, "R"), (2, 6, "N")]
    columns, want = by_sql(sf, "merged_edges", "customer", "supplier", "orders", "lineitem")
    assert columns == ["src", "dst", "role"] and got == sorted(want)


def test_match_status_holds_names_against_all(spark, tmp_path):
    # endings go by the number: 3 and 6 have ' Minerals Australia' and none, 7 ' Pty Ltd'
    rows = [(3, "red gold"), (6, "blue zinc"), (7, "grey tin"), (9, "Ltd")]
    sf = put(spark, tmp_path, part=(rows, "p_partkey long, p_name string"))
    got = {r["l"]: r["r"] for r in core.QUERIES["match_status"](spark, sf).collect()}
    assert got["blue zinc"] == "blue zinc" and got["grey tin"] == "grey tin" and got["red gold"] == "red gold mineral au"


def test_closure_of_a_deep_hierarchy_with_a_cycle(spark):
    edges = [(i, i + 1) for i in range(36)] + [(50, 51), (51, 50), (51, None), (50, None)]
    got = sorted(((r["src"], r["dst"], r["depth"]) for r in G.closure(spark.createDataFrame(edges, "src long, dst long")).collect()), key=repr)
    chain = [(i, j, j - i) for i in range(37) for j in range(i + 1, 37)]
    assert got == sorted([*chain, (50, 51, 1), (51, 50, 1), (50, 50, 2), (51, 51, 2), (50, None, 1), (51, None, 1)], key=repr)
