"""Readers of large files: records over blocks, folders of many files, ranges of shapes."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.countries import country_names
from tessera.plans import pipelines as C
from tessera.plans.config import INPUTS, OUTPUTS, EngineConfig
from tessera.sources import readers
from tessera.sources.lines import ends_quoted, numbered_lines, quoted_records
from tessera.sources.shapefiles import polygons, shapefile_bytes, write_shapefiles


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quote_state_of_a_line():
    for line, ends in (('a\t"b', True), ('"a""b"\tc', False), ('"a"b"\tc', False), ('a"b\tc', False), ('a\t"b""', True), ('"', True), ("", False), ('x\t""\t"y', True)):
        assert ends_quoted(line, False, "\t") is ends
    for line, ends in (('b"\tc', False), ('b""c', True), ("", True), ('b"\t"c', True), ('"', False), ('""', True), ('"""', False)):
        assert ends_quoted(line, True, "\t") is ends


def test_records_over_lines_and_blocks(spark, tmp_path, small_blocks):
    r = random.Random(6)
    cell = lambda: "".join(r.choice(['a', 'b', '"', '\t', '\n', ' ', 'c', "é"]) for _ in range(r.choice([0, 1, 3, 8, 90])))
    rows = [[cell() for _ in range(r.randrange(1, 6))] for _ in range(150)]
    out = io.StringIO()
    csv.writer(out, delimiter="\t", lineterminator="\n").writerows(rows)
    (tmp_path / "a.tsv").write_text(out.getvalue(), newline="")
    (tmp_path / "b.tsv").write_text('plain "x"\ty\n"open\nto the end\t', newline="")
    got = quoted_records(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")]).orderBy("ord").collect()
    want = list(csv.reader(io.StringIO(out.getvalue(), newline=""), delimiter="\t")) + [['plain "x"', "y"], ["open\nto the end\t"]]
    assert [x["cells"] for x in got] == want and len({x["ord"] for x in got}) == len(want)


def test_lines_are_numbered_in_order(spark, tmp_path, small_blocks):
    lines = {n: [f"{n}{i} " + "x" * (i * 7 % 50) for i in range(100)] for n in "ba"}
    for n, held in lines.items():
        (tmp_path / f"{n}.txt").write_text("\n".join(held))
    got = numbered_lines(spark, [str(tmp_path)])
    assert got.rdd.getNumPartitions() > 4
    assert [(x["ord"], x["value"]) for x in got.orderBy("ord").collect()] == list(enumerate([*lines["a"], *lines["b"]]))


def test_register_with_quotes(spark, tmp_path):
    (tmp_path / "r.tsv").write_text('"A ""B"" CO"\t11\n"tab\there"\t 12 ' + "\t" * 12 + '"OLD\nCO"\nragged\n"multi\nline"\t13\n')
    got = readers.register_tsv(spark, str(tmp_path / "r.tsv")).orderBy("ord").collect()
    assert [(x["name"], x["acn"], x["previous"], x["n_columns"]) for x in got] == [('A "B" CO', "11", "", 2), ("tab\there", "12", "OLD\nCO", 14), ("multi\nline", "13", "", 2)]


def test_folders_of_many_files_are_one_plan(spark, tmp_path):
    for i in range(200):
        folder = tmp_path / f"f {i % 2}"
        folder.mkdir(exist_ok=True)
        (folder / f"{i:04d}.csv").write_text(("﻿" if i % 3 else "") + ("Ticker,x\n" if i % 5 else "x,Ticker,y\n") + "\n".join(f"T{i},{j}" if i % 5 else f"{j},T{i},z" for j in range(3)))
    (tmp_path / "f 0" / "9.csv").write_text("Other\n1\n")
    out = readers.csv_folders(spark, [str(tmp_path / "f 1"), str(tmp_path / "f 0"), str(tmp_path / "absent")], "Ticker")
    order = [*range(1, 200, 2), *range(0, 200, 2)]
    got = out.orderBy("file_rank", "file_row").select("Ticker", "x", "file_rank").collect()
    assert [tuple(x) for x in got] == [(f"T{i}", str(j), rank) for rank, i in enumerate(order) for j in range(3)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 3
    assert readers.csv_folders(spark, [str(tmp_path / "absent")], "Ticker") is None


def test_market_list_keeps_the_order_of_files(spark, tmp_path):
    names = ["Ticker", "Short Name", "Cntry Terrtry Of Dom", "Company Type", "Market Cap", "Revenue:Y", "Tot Assets:Y", "Number of Employees LF", *[f"c{i}" for i in range(8)]]
    for f in range(2):
        (tmp_path / f"{f}.csv").write_text("\n".join([",".join(names), *[",".join([f"T{f}{i}", f"n{i}", "kr" if i % 2 else "AU", "--", "5k" if i < 10 else "", "", "", "1", *["x"] * 8]) for i in range(20)]]))
    got = C.market_companies(readers.csv_folders(spark, [str(tmp_path)], "Ticker")).orderBy("__place").collect()
    rank = lambda f, i: (i >= 10, i % 2, f, i)
    want = sorted((rank(f, i), f"T{f}{i}") for f in range(2) for i in range(20) if not (i % 2 and i >= 10))
    assert [x["Ticker"] for x in got] == [t for _, t in want] and {x["Country of Domicile"] for x in got} == {"Australia", "Korea, Republic of"}


def test_country_names(spark):
    names = country_names(spark)
    assert len(names) >= 249 and names["GB"] == "United Kingdom" and names["US"] == "United States" and names["CN"] == "China" and names["SA"] == "Saudi Arabia"


def test_features_by_line(spark, tmp_path):
    lines = ['{"type": "FeatureCollection", "features": [', *['{"type": "Feature", "properties": {"ENO": "%d"}, "geometry": {"coordinates": [%d, 2]}},' % (i, i) for i in range(5)], '{"type": "Feature", "properties": null, "geometry": null}', "]}"]
    (tmp_path / "p.json").write_text("﻿" + "\n".join(lines), encoding="utf-8")
    got = readers.geojson_points(spark, str(tmp_path / "p.json"), ["ENO"], by_line=True).orderBy("ord").collect()
    whole = readers.geojson_points(spark, str(tmp_path / "p.json"), ["ENO"]).orderBy("ord").collect()
    assert [(x["ENO"], x["longitude"]) for x in got] == [(x["ENO"], x["longitude"]) for x in whole] and len(got) == 6


def test_shapes_by_ranges_and_boxes(spark, tmp_path):
    r = random.Random(1)
    records = []
    for i in range(300):
        x, y = r.uniform(-50, 50), r.uniform(-50, 50)
        ring = [(x, y), (x + 1, y), (x + 1, y + 1 + i % 3)]
        records.append(({"NAME": f"n{i} é", "TYPE": "" if i % 4 else "Igneous"}, [ring, [(x + 0.1, y), (x + 0.2, y), (x + 0.2, y + 0.1)]] if i % 5 == 0 else [ring]))
    for kind, data in shapefile_bytes(records, {"NAME": 12, "TYPE": 8}).items():
        (tmp_path / f"s.{kind}").write_bytes(data)
    path = str(tmp_path / "s.shp")
    df = polygons(spark, [path], ["NAME"], range_bytes=2000)
    assert df.rdd.getNumPartitions() > 10
    got = df.orderBy("ord").collect()
    assert [(x["ord"], x["NAME"], [[tuple(p) for p in ring] for ring in x["rings"]]) for x in got] == [(i, a["NAME"], rings) for i, (a, rings) in enumerate(records)]
    near = df.filter("x0 >= 10.0D and y1 < 20.0D and NAME like 'n%'").select("NAME")
    want = {a["NAME"] for a, rings in records if min(p[0] for p in rings[0]) >= 10 and max(p[1] for p in rings[0]) < 20}
    assert {x["NAME"] for x in near.collect()} == want and 0 < len(want) < 200
    (tmp_path / "s.shx").unlink()  # the places are then found in the file itself
    assert polygons(spark, [path], ["TYPE"], range_bytes=2000).filter("TYPE is not null").count() == 75
    (tmp_path / "s.prj").write_text('PROJCS["somewhere"]')
    with pytest.raises(ValueError, match="projected"):
        polygons(spark, [path], ["NAME"])
    assert polygons(spark, [path], ["NAME"], any_system=True).count() == 300


def test_shapes_written_by_tasks(spark, tmp_path):
    square = F.array(*[F.struct((F.col("id") + dx).cast("double").alias("x"), F.lit(dy).cast("double").alias("y")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))])
    df = spark.range(40).select(F.concat(F.lit("n"), "id").alias("N"), F.array(square).alias("rings")).repartition(3)
    files = write_shapefiles(df, str(tmp_path / "out"), {"N": 5})
    assert len(files) == 3 and sorted((x["N"], x["x0"], x["x1"]) for x in polygons(spark, files, ["N"]).collect()) == sorted((f"n{i}", i, i + 1) for i in range(40))


def test_paths_by_name(spark, tmp_path, monkeypatch):
    config = EngineConfig(raw=str(tmp_path / "raw"), out=str(tmp_path / "out"))
    assert set(config.missing(spark)) == set(INPUTS)
    assert config.source("areas").endswith("raw/shp/LGA_2025_AUST_GDA94/LGA_2025_AUST_GDA94.shp") and config.source("x/y.csv") == f"{tmp_path}/raw/x/y.csv"
    monkeypatch.setenv("TESSERA_IN_REGISTER", str(tmp_path / "r.tsv"))
    (tmp_path / "r.tsv").write_text("A\t1\n")
    assert "register" not in config.missing(spark) and readers.register_tsv(spark, config.source("register")).count() == 1
    path = config.ready(spark, "companies")
    spark.range(3).write.csv(path)
    assert spark.read.csv(path).count() == 3 and path.startswith(str(tmp_path / "out/master"))
    assert len(set(OUTPUTS.values())) == len(OUTPUTS)
