"""The composite operators on tables small enough to follow by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import vocabulary as V
from tessera.operators import graph as G
from tessera.plans import pipelines as C
from tessera.sources.readers import PROPERTIES
from tessera.streaming.matching import match_stream


@pytest.fixture(scope="module")
def projects(spark):
    values = {"ENO": "10", "DEPOSIT_NAME": "Alpha\n", "SYNONYMS": "Alfa, Al", "COMMODITY_CODES": "Au, Cu (Ag)", "COMPANIES": "Acme Gold Ltd, Zinc Co", "OPERATING_STATUS": "Mining", "LONG_GDA94": "1", "LAT_GDA94": "1", "DEPOSIT_MODEL": "Type: T, Group: G"}
    deposits = spark.createDataFrame([(*[values.get(p) for p in PROPERTIES], 1.0, 1.0, 0)], ", ".join(f"{p} string" for p in PROPERTIES) + ", longitude double, latitude double, ord int")
    majors = spark.createDataFrame([("10", "Late", "WA", "5", "5", "Other", "Zn", "Nobody"), ("9", "Beta", "Queensland ", "3", "3", "scoping", "Zn (Pb)", "Zinc Company")], "ENO string, PROJECT_NAME string, STATE string, LONG_GDA94 string, LAT_GDA94 string, PROJECT_TYPE string, COMMODITY_PRIMARY string, PRINCIPAL_COMPANY string")
    views = spark.createDataFrame([("11", "Gamma", "", "", "closed", "Gold (Silver, Unknown)", "Acme Gold"), ("", "None", "1", "1", "x", "Gold", "y")], "ENO string, name string, LONG_GDA94 string, LAT_GDA94 string, status string, commodity string, owner string")
    symbols = spark.createDataFrame([("Au", "Gold"), ("Ag", "Silver"), ("Cu", "Copper")], "symbol string, name string")
    return C.unified_projects(deposits, majors, views, symbols, symbols.select("name", "symbol"))


def test_projects(projects):
    got = {r["ENO"]: r for r in projects.collect()}
    assert set(got) == {"10", "9", "11"} and projects.columns == list(V.PROJECT_COLUMNS)
    assert got["10"]["DEPOSIT_NAME"] == "Alpha" and got["10"]["COMMODITY_NAMES"] == "Gold, Copper, (Silver)" and got["10"]["DEPOSIT_MODEL_TYPE"] == "T"
    assert got["9"]["OPERATING_STATUS"] == "Feasibility Studies" and got["9"]["COMMODITY_NAMES"] == "Zn, (Pb)"
    assert (got["11"]["COMMODITY_PRIMARY"], got["11"]["COMMODITY_SECONDARY"]) == ("Au", "Ag, Unknown")


@pytest.fixture(scope="module")
def enriched(spark, projects):
    box = lambda a, b: [[{"x": float(x), "y": float(y)} for x, y in ((a, a), (b, a), (b, b), (a, b))]]
    areas = spark.createDataFrame([(0, "Victoria", "North", box(0, 1)), (1, "Tasmania", "South", box(1, 4))], "ord int, STE_NAME21 string, LGA_NAME25 string, rings array<array<struct<x: double, y: double>>>")
    provinces = spark.createDataFrame([("P1", " Igneous", box(0, 2)), ("P2", "igneous", box(0, 4)), ("P3", "other", box(0, 4))], "NAME string, TYPE string, rings array<array<struct<x: double, y: double>>>")
    return C.enriched_projects(projects, areas, provinces)


def test_enrichment(enriched):
    got = {r["ENO"]: r for r in enriched.collect()}
    assert set(got) == {"10", "9"} and enriched.columns == list(V.ENRICHED_COLUMNS)
    assert (got["10"]["LGA"], got["10"]["STATE"], got["10"]["IGNEOUS"]) == ("North", "VIC", "P1,P2")
    assert (got["9"]["LGA"], got["9"]["STATE"], got["9"]["IGNEOUS"], got["9"]["TECTONIC"]) == ("South", "QLD", "P2", None)


@pytest.fixture(scope="module")
def master(spark, enriched):
    market = spark.createDataFrame([(1, "Acme Gold Limited", "ACM", None, None, "Mining", "Gold Mining"), (2, "Far Group", "FAR", 7.0, "d", "Mining", None)], "ord long, name string, Ticker string, revenue double, description string, `ICB Sector` string, `ICB Subsector` string")
    profiles = spark.createDataFrame([(1, "ACME GOLD", "digs", 12, 3), (2, "Minerals", "x", 1, 1), (3, "Zinc Co", "smelts", 5, 2)], "ord long, name string, description string, employees int, followers int")
    statements = spark.createDataFrame([(1, "Acme Gold Pty Ltd", 99.0), (2, "Lone Statement", 5.0)], "ord long, name string, revenue double")
    return C.merged_companies(market, profiles, statements)


def test_companies(spark, master, enriched, tmp_path):
    got = {r["name"]: r for r in master.collect()}
    assert set(got) == {"Acme Gold Limited", "Far Group", "Lone Statement", "Zinc Co"}
    assert got["Acme Gold Limited"]["revenue"] == 99.0 and got["Acme Gold Limited"]["linkedinEmployees"] == 12 and got["Acme Gold Limited"]["description"] == "digs"
    assert [got[n]["companyID"] for n in ("Acme Gold Limited", "Far Group", "Lone Statement", "Zinc Co")] == ["comp_1", "comp_2", "comp_3", "comp_4"]

    matches = C.cascaded_matches(enriched, master)
    found = {r["name"]: (r["matched_name"], r["matched_source"]) for r in matches.collect()}
    assert found["Acme Gold Ltd"] == ("Acme Gold Limited", "market") and found["Zinc Company"] == ("Zinc Co", "profiles")

    register = spark.createDataFrame([(0, "OLD ACME", "77", "", 14), (1, "ACME GOLD LTD", "77", "", 14), (2, "SHORT", "1", "", 3)], "ord long, name string, acn string, previous string, n_columns int")
    former = C.former_names(register, master)
    assert [tuple(r) for r in former.collect()] == [("comp_1", "77", ["Old Acme", "Acme Gold Ltd"])]
    manual = spark.createDataFrame([("comp_2", "zinc co, Far Away, far group")], "companyID string, alias string")
    kept, log = C.company_master(master, matches, former, manual)
    rows = {r["companyID"]: r for r in kept.collect()}
    # the alias of comp_2 is a name of comp_4, which has no number and is absorbed
    assert set(rows) == {"comp_1", "comp_2", "comp_3"} and [r["dropped"] for r in log.collect()] == [4]
    assert rows["comp_1"]["acn"] == "77" and rows["comp_1"]["synonyms"] == "Acme Gold Ltd, Old Acme"
    assert rows["comp_2"]["synonyms"] == "zinc co, Far Away, Zinc Company" and rows["comp_2"]["linkedinEmployees"] == 5

    graph = C.project_graph(G.PropertyGraph(), enriched)
    ids = graph.label("Project").select(F.col("eno").alias("ENO"), F.col("id").alias("projectID"))
    owners = C.project_owners(enriched, ids, kept)
    named = {(r["companyID"], r["projectID"]) for r in owners.collect()}
    assert named == {("comp_1", "project_1"), ("comp_2", "project_1"), ("comp_2", "project_2")}
    graph = C.company_graph(graph, kept, owners)
    graph, lone = C.commodity_groups(graph, spark.createDataFrame([("Au", "Extraction"), ("Au", "Extraction"), ("Xx", "Other")], "Commodity string, `Group` string"))
    count = lambda kind: graph.edge(kind).count()
    assert {k: count(k) for k in graph.edges} == {"REFERS_TO_PROJECT": 4, "LOCATED_IN": 4, "HAS_COMMODITY": 5, "REFERS_TO_COMPANY": 8, "PART_OF": 1, "CLASSIFIED_AS": 2, "OWNS": 3, "GROUPED_AS": 1}
    assert {r["symbol"] for r in lone.collect()} == {"Cu", "Ag", "Zn", "Pb"}
    for nodes in graph.nodes.values():
        assert G.duplicate_ids(nodes, "id").count() == 0
    similar = C.project_similarity(graph, spark.createDataFrame([("10", "9"), ("10", "10")], "a string, b string"))
    assert {(r["a"], r["b"]): r["similarity"] for r in similar.collect()} == {("10", "9"): 0.0, ("10", "10"): 1.0}
    report = C.name_report(graph, spark.createDataFrame([("acme",), ("zzz",)], "term string"))
    assert {r["term"]: r["match_count"] for r in report.collect()} == {"acme": 3, "zzz": 0}


def test_market(spark):
    header = ["Ticker", "Short Name", "Cntry Terrtry Of Dom", "Company Type", "Market Cap", "Revenue:Y", "Tot Assets:Y", "Number of Employees LF", *[f"c{i}" for i in range(8)]]
    row = lambda t, c, cap, assets, rank: (t, "s", c, "--", cap, "", assets, "1k", *[" "] * 8, rank)
    files = spark.createDataFrame([row("A", "us", "5M", "", 0), row("B", "AU", "0", "3K", 0), row("C", "FR", "--", "0", 0), row("D", "AU", "2M", "", 1), row("A", "AU", "9B", "", 1), row("B", "AU", "", "7K", 0)], ", ".join(f"`{h}` string" for h in header) + ", file_rank int")
    countries = spark.createDataFrame([("AU", "Australia"), ("US", "United States"), ("FR", "France")], "code string, name string")
    text = spark.createDataFrame([("A", "Alpha Inc", "Australia")], "Ticker string, LONG_COMP_NAME string, `Company Type` string")
    out = C.market_companies(files, countries, text)
    got = [(r["Ticker"], r["LONG_COMP_NAME"], r["Market Cap"], r["Tot Assets:Y"], r["Company Type"]) for r in out.orderBy("__place").collect()]
    assert got == [("D", None, 2e6, None, None), ("A", "Alpha Inc", 5e6, None, None), ("B", None, None, 7000.0, None), ("B", None, None, 3000.0, None)]
    assert "Short Name" not in out.columns and out.columns[1] == "LONG_COMP_NAME"


def test_stream(spark, tmp_path):
    spark.createDataFrame([("Acme Gold Ltd",), ("Nothing",)], "name string").write.parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([(1, "ACME GOLD")], "ord int, name string")
    names = spark.readStream.schema("name string").parquet(str(tmp_path / "in"))
    match_stream(names, known, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = {r["l"]: r["status"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"acme gold": "no_space_exact_match", "nothing": "no_candidate_found"}
