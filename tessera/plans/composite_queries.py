"""Queries of sources, sinks and composite operators, each with its SQL; files go to the session's shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.operators import graph as G
from tessera.operators import relational as R
from tessera.operators.stages import fresh_path
from tessera.plans import pipelines as C
from tessera.plans.pattern_query import run_query
from tessera.plans.queries import _PIP, _POLYGONS, _REGISTER_NAMES, _case, _points, _polygons, query, register, table, trade_graph
from tessera.sources import readers, writers
from tessera.sources.shapefiles import polygons, write_shapefiles


# -- files -------------------------------------------------------------------------
@query("select n_nationkey::varchar as n_nationkey, n_name, n_regionkey::double as region from nation")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with a byte-order mark, read back by chosen columns as strings; numbers cast later."""
    path = fresh_path(spark, "csv")
    writers.write_csv(table(spark, sf_dir, "nation"), path, bom=True)
    back = readers.csv_strings(spark, path, ["n_nationkey", "n_name", "n_regionkey"])
    return back.select("n_nationkey", "n_name", F.col("n_regionkey").try_cast("double").alias("region"))


@query("""select n_nationkey::varchar as s_suppkey, n_name as s_name, 0 as file_rank from nation
  union all select s_suppkey::varchar, s_name, 1 from supplier""")
def csv_folder_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files of several folders in order; a file without the needed column is left out but keeps its rank."""
    path = fresh_path(spark, "folders")
    parts = (table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_suppkey"), F.col("n_name").alias("s_name")), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), table(spark, sf_dir, "region"))
    for i, part in enumerate(parts):
        writers.write_csv(part.coalesce(1), f"{path}/{i}")
    return readers.csv_folders(spark, [f"{path}/{i}" for i in range(len(parts))], "s_suppkey").select("s_suppkey", "s_name", "file_rank")


_REGISTER = """select 'COMPANY ' || (o_orderkey * 7 % 3001) as name, (o_custkey + 1000)::varchar as acn,
  CASE WHEN o_orderkey % 5 = 0 THEN 'COMPANY ' || ((o_orderkey * 11 + 3) % 3001) ELSE '' END as prev, CASE WHEN o_orderkey % 13 = 0 THEN 3 ELSE 14 END as n from orders"""


_ODD_NAME = """CASE WHEN acn::bigint % 17 = 0 THEN name || ' "Q"' || chr(9) || 'x' WHEN acn::bigint % 19 = 0 THEN name || chr(10) || 'second, "line"' ELSE name END"""


@query(f"select {_ODD_NAME} as name, acn, CASE WHEN n = 14 THEN prev ELSE '' END as previous, n as n_columns from ({_REGISTER})")
def register_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ragged register without a header, some names of which are quoted for the quotes, tabs and line breaks that they hold."""
    path = fresh_path(spark, "register")
    k, name = F.col("acn").cast("long"), F.col("name")
    odd = F.when(k % 17 == 0, F.concat(name, F.lit(' "Q"\tx'))).when(k % 19 == 0, F.concat(name, F.lit('\nsecond, "line"')))
    rows = register(spark, sf_dir).withColumn("name", F.coalesce(F.concat(F.lit('"'), F.replace(odd, F.lit('"'), F.lit('""')), F.lit('"')), name))
    cells = F.when(F.col("n_columns") == 14, F.array(*["name", "acn", *[F.lit("")] * 11, "previous"])).otherwise(F.array("name", "acn", F.lit("x")))
    rows.select(F.array_join(cells, "\t").alias("value")).write.text(path)
    return readers.register_tsv(spark, path).select("name", "acn", "previous", "n_columns")


@query("""select vec_id::varchar as name, round(embedding[1]::double * 64) / 8 - (1 + label) / 4 as x0, round(embedding[2]::double * 64) / 8 + (1 + label) / 4 as y1, 4 as corners from embeddings
  where round(embedding[1]::double * 64) / 8 - (1 + label) / 4 >= -1""")
def polygon_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapefiles of a square around each vector's place, read back by ranges of records, those on the left left out by their boxes."""
    path = fresh_path(spark, "shapes")
    x, y = (F.round(F.element_at("embedding", i).cast("double") * 64) / 8 for i in (1, 2))
    half = (1 + F.col("label")) / 4
    corner = lambda a, b: F.struct((x + a * half).alias("x"), (y + b * half).alias("y"))
    squares = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("NAME"), F.array(F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1))).alias("rings"))
    files = write_shapefiles(squares.repartition(4, "NAME"), path, {"NAME": 20})
    found = polygons(spark, files, ["NAME"], range_bytes=1 << 12).filter("x0 >= -1.0D")
    return found.select(F.col("NAME").alias("name"), "x0", "y1", F.size(F.element_at("rings", 1)).alias("corners"))


@query("""select 'node' as kind, 'r' || r_regionkey as a, r_name as b from region union all select 'PART_OF', 'n' || n_nationkey, 'r' || n_regionkey from nation
  union all select 'header', ':START_ID|:END_ID|:TYPE|role:string', '0'""")
def graph_load_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node and edge files with typed headers, and the header of an empty edge table."""
    g, path = trade_graph(spark, sf_dir), fresh_path(spark, "load")
    writers.write_nodes(g.label("Region"), f"{path}/nodes", "id", {"text": "string"})
    writers.write_edges(g.edge("PART_OF"), f"{path}/edges", "PART_OF")
    writers.write_edges(g.edge("PART_OF").withColumn("role", F.lit("x")).limit(0), f"{path}/none", "NONE", ["role"])
    nodes = readers.csv_strings(spark, f"{path}/nodes", ["id:ID", "text:string"]).toDF("a", "b").withColumn("kind", F.lit("node"))
    edges = readers.csv_strings(spark, f"{path}/edges", [":TYPE", ":START_ID", ":END_ID"]).toDF("kind", "a", "b")
    none = readers.csv_strings(spark, f"{path}/none")
    head = none.agg(F.lit("header").alias("kind"), F.lit("|".join(none.columns)).alias("a"), F.count(F.lit(1)).cast("string").alias("b"))
    return nodes.select("kind", "a", "b").unionByName(edges).unionByName(head)


@query("select c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END as c_name, c_acctbal from customer")
def json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON report that keeps nulls."""
    path = fresh_path(spark, "json")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 > 0, F.col("c_name")).alias("c_name"), "c_acctbal")
    writers.write_json(rows, path)
    raw = spark.read.text(path)
    kept = raw.filter(F.col("value").contains('"c_name":'))  # also where it is null
    return kept.select(F.from_json("value", rows.schema).alias("j")).select("j.*")


@query("""select 'Region' as name, 'r' || r_regionkey as a, r_name as b from region union all select 'Nation', 'n' || n_nationkey, n_name from nation union all select 'Customer', 'c' || c_custkey, c_name from customer
  union all select 'Order', 'o' || o_orderkey, o_orderstatus from orders union all select 'PART_OF', 'n' || n_nationkey, 'r' || n_regionkey from nation union all select 'LOCATED_IN', 'c' || c_custkey, 'n' || c_nationkey from customer
  union all select 'PLACED', 'c' || o_custkey, 'o' || o_orderkey from orders where o_custkey in (select c_custkey from customer)
  union all select 'label', unnest(['Customer', 'Nation', 'Order', 'Region']), null union all select 'PLACED ends', 'Customer', 'Order'""")
def graph_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph saved over an older one with labels of its own, and read back whole."""
    g, path = trade_graph(spark, sf_dir), fresh_path(spark, "graph")
    G.PropertyGraph(nodes={"Customer": g.label("Region"), "Old": g.label("Region")}, edges={"OLD": g.edge("PART_OF")}).save(path)
    g.save(path)
    held = G.PropertyGraph.load(spark, path)
    out = spark.createDataFrame([*[("label", x, None) for x in held.nodes], *[("PLACED ends", *x) for x in held.ends["PLACED"]]], "name string, a string, b string")
    for label, df in held.nodes.items():
        out = out.unionByName(df.select(F.lit(label).alias("name"), F.col("id").alias("a"), F.col("status" if label == "Order" else "text").alias("b")))
    for kind, df in held.edges.items():
        out = out.unionByName(df.select(F.lit(kind).alias("name"), F.col("src").alias("a"), F.col("dst").alias("b")))
    return out


@query("""with recursive e as (select 'n' || n_nationkey as a, 'r' || n_regionkey as b, 'p' || n_nationkey as e from nation union all select 'c' || c_custkey, 'n' || c_nationkey, 'l' || c_custkey from customer),
  s as (select a, b, e from e union all select b, a, e from e),
  w(a, b, es) as (select 'n' || n_nationkey, 'n' || n_nationkey, []::varchar[] from nation union all select w.a, s.b, list_append(es, e) from w join s on s.a = w.b where len(es) < 3 and not list_contains(es, e))
  select a, b, len(es)::int as length from w where len(es) between 2 and 3""")
def graph_walks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks of two or three edges from every nation, in either direction, that use no edge twice."""
    g = trade_graph(spark, sf_dir)
    kinds = [("PART_OF", "Nation", "Region"), ("LOCATED_IN", "Customer", "Nation")]
    return g.paths(g.label("Nation"), kinds, 2, 3, "both").select("a", "b", "length")


@query("""with o as (select o_custkey as c, 'o' || o_orderkey as id, o_totalprice as total, o_orderstatus as status from orders)
  select c_name as buyer, a.id as first, b.id as other from customer left join (o a join o b on a.c = b.c and a.id <> b.id and a.status = 'P' and b.total > 150000) on a.c = c_custkey where c_mktsegment = 'BUILDING'
  union all select n_name, r_name, null from nation join region on n_regionkey = r_regionkey""")
def pattern_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers with pairs of their orders, those without a pair kept; and edges asked for without a direction."""
    text = """MATCH (c:Customer {segment: 'BUILDING'}) OPTIONAL MATCH (c)-[:PLACED]->(a:Order)-[:PLACED*2..2]-(b:Order) WHERE a.status = 'P' AND b.total > 150000
      RETURN c.text AS buyer, a.id AS first, b.id AS other UNION ALL MATCH (r:Region)-[:PART_OF]-(n:Nation) RETURN n.text AS buyer, r.text AS first, NULL AS other"""
    return run_query(trade_graph(spark, sf_dir), text)


@query("select distinct c_mktsegment as term from customer")
def search_term_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search terms of all files of a folder."""
    path = fresh_path(spark, "terms")
    terms = table(spark, sf_dir, "customer").select(F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("t"), F.lit("other").alias("o")).distinct()
    terms.repartition(2).write.csv(path)
    return readers.search_terms(spark, path).select("term")


@query("""select s_suppkey::varchar as eno, CASE WHEN s_nationkey % 2 = 0 THEN s_name END as state, s_suppkey / 8 as longitude, -s_nationkey / 4 as latitude,
  (row_number() over (order by s_suppkey) - 1)::bigint as ord from supplier""")
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of GeoJSON files with a line for each, read by many tasks and numbered in the order of the files."""
    path = fresh_path(spark, "geojson")
    s = table(spark, sf_dir, "supplier")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("s_suppkey").cast("string").alias("ENO"), F.when(F.col("s_nationkey") % 2 == 0, F.col("s_name")).alias("STATE")).alias("properties"),
        F.struct(F.array(F.col("s_suppkey") / 8, -F.col("s_nationkey") / 4).alias("coordinates")).alias("geometry"),
    )
    s.repartitionByRange(4, "s_suppkey").sortWithinPartitions("s_suppkey").select(F.concat(F.to_json(feature), F.lit(",")).alias("value")).write.text(path)
    return readers.geojson_points(spark, path, ["ENO", "STATE"], by_line=True).select(F.col("ENO").alias("eno"), F.col("STATE").alias("state"), "longitude", "latitude", "ord")


_SIDES = "select trim(p_type) as x, 'T' || length(p_brand) || p_size as y, p_partkey as o from part"


@query(f"""with p as ({_SIDES}), s as (select CASE WHEN length(x) <= length(y) THEN x ELSE y END as symbol, CASE WHEN length(x) <= length(y) THEN y ELSE x END as name, o from p)
  select 'symbol' as key, symbol as a, max_by(name, o) as b from s group by symbol union all select 'name', name, max_by(symbol, o) from s group by name""")
def lookup_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol to name and name to symbol, the last row of a key winning."""
    p = table(spark, sf_dir, "part").select(F.concat(F.lit(" "), "p_type").alias("x"), F.concat(F.lit("T"), F.length("p_brand").cast("string"), F.col("p_size").cast("string")).alias("y"), "p_partkey")
    names, symbols = readers.lookup_pairs(p, "x", "y", "p_partkey")
    return names.select(F.lit("symbol").alias("key"), F.col("symbol").alias("a"), F.col("name").alias("b")).unionByName(symbols.select(F.lit("name").alias("key"), F.col("name").alias("a"), F.col("symbol").alias("b")))


@query(f"""with m as ({_REGISTER_NAMES}), a as (select string_agg(replace(name, 'COMPANY', 'Company'), ',' order by k) as names, acn from ({_REGISTER.replace(' as n from', ' as n, o_orderkey as k from')}) group by acn)
  select 'comp_' || c_custkey as id, m.acn as acn, names from customer join m on m.name = 'COMPANY ' || c_custkey join a on a.acn = m.acn""")
def former_names_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies looked up in a register, with all names of their number, written as a file of its own form."""
    path = fresh_path(spark, "former")
    companies = table(spark, sf_dir, "customer").select(F.concat(F.lit("comp_"), F.col("c_custkey").cast("string")).alias("companyID"), F.concat(F.lit("Company "), F.col("c_custkey").cast("string")).alias("name"))
    writers.write_former_names(C.former_names(register(spark, sf_dir), companies), path)
    return readers.csv_strings(spark, path, ["ID", "ACN", "MatchedNames"]).toDF("id", "acn", "names")


# -- rows and columns ---------------------------------------------------------------
@query("""select c_custkey as "KEY", coalesce(nullif(CASE c_custkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN c_mktsegment END, ' '), c_name) as "NOTE", c_custkey as "NUMBER", c_name as "CLEAN", null::varchar as "EXTRA"
  from customer where c_mktsegment <> 'BUILDING' and c_custkey % 3 <> 2""")
def edited_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and equal rows dropped; columns filled, cleaned, renamed by count, moved, ensured and upper-cased."""
    c = table(spark, sf_dir, "customer")
    note = F.when(F.col("c_custkey") % 3 == 0, " ").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment"))
    rows = c.select("c_custkey", note.alias("note"), F.concat("c_name", F.lit("\r\n")).alias("raw"), "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("").alias("kept"))
    rows = R.differing(R.non_blank(rows, "kept"), "note", "kept").unionByName(R.non_blank(rows, "kept").filter(F.col("note") == F.col("kept")))
    rows = rows.select("c_custkey", R.fill_from("note", "c_name", blank=True).alias("note"), X.clean_breaks("raw").alias("clean"), X.id_number("c_name").alias("number"))
    rows = R.rename_if_count(R.move_column(rows, "number", "clean"), ["key", "note", "number", "clean"])
    return R.upper_columns(R.ensure_columns(rows, ["key", "note", "number", "clean", "extra"]))


# -- composites ------------------------------------------------------------------------
_SYMBOLS = {"Au": "Gold", "Ag": "Silver", "Cu": "Copper", "Pb": "Lead"}
_KINDS = {0: ("scoping", "Feasibility Studies"), 1: (" Mining", "Mine Projects"), 2: ("processing", "Processing Projects"), 3: ("weird", "weird")}
_NTH = {i: s for i, s in enumerate([*_SYMBOLS, "Xx"])}


def _nth(n, names: dict[int, str]):  # noqa: ANN001, ANN202
    return F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])[F.pmod(n, F.lit(len(names))).cast("int")]


def _nth_sql(n: str, names: dict[int, str]) -> str:
    return f"CASE {n} % {len(names)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items()) + " END"


def _name_sql(symbol: str) -> str:
    return _case(symbol, _SYMBOLS, symbol)


_MAJORS = f"""select p_partkey::varchar as eno, p_name as name, 'Queensland ' as state, {_nth_sql('p_size', {k: v[1] for k, v in _KINDS.items()})} as kind,
  {_nth_sql('p_partkey', _NTH)} as a, CASE WHEN p_partkey % 4 > 0 THEN {_nth_sql('(p_partkey // 3)', _NTH)} ELSE '' END as b, p_brand as company from part"""
_VIEWS = f"""select s_suppkey::varchar as eno, s_name as name, '' as state, 'Mine Projects' as kind, {_nth_sql('s_suppkey', _NTH)} as a, {_nth_sql('(s_suppkey + 1)', _NTH)} as b, 'owner' as company from supplier"""
_DEPOSITS = f"""select n_nationkey::varchar as eno, n_name as name, '' as state, 'Mine Projects' as kind, {_nth_sql('n_nationkey', _NTH)} as a, {_nth_sql('(n_nationkey + 2)', _NTH)} as b, 'digger' as company from nation"""
_PROJECTS = f"""with d as ({_DEPOSITS}), m as ({_MAJORS}), v as ({_VIEWS}),
  u as (select * from d union all select * from m where eno not in (select eno from d) union all select * from v where eno not in (select eno from d) and eno not in (select eno from m))"""


def _projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    second = _nth(F.floor(F.col("p_partkey") / 3), _NTH)
    commodity = F.concat(_nth(F.col("p_partkey"), _NTH), F.when(F.col("p_partkey") % 4 > 0, F.concat(F.lit(" ("), second, F.lit(")"))).otherwise(""))
    majors = part.select(F.col("p_partkey").cast("string").alias("ENO"), F.col("p_name").alias("PROJECT_NAME"), F.lit("Queensland ").alias("STATE"), _nth(F.col("p_size"), {k: v[0] for k, v in _KINDS.items()}).alias("PROJECT_TYPE"), commodity.alias("COMMODITY_PRIMARY"), F.col("p_brand").alias("PRINCIPAL_COMPANY"), F.col("p_partkey").alias("ord"))
    full = {i: _SYMBOLS.get(s, s) for i, s in _NTH.items()}
    views = supplier.select(F.col("s_suppkey").cast("string").alias("ENO"), F.col("s_name").alias("name"), F.lit("closed").alias("status"), F.concat(_nth(F.col("s_suppkey"), full), F.lit(" ("), _nth(F.col("s_suppkey") + 1, full), F.lit(")")).alias("commodity"), F.lit("owner").alias("owner"), F.col("s_suppkey").alias("ord"))
    n, path = F.col("n_nationkey"), fresh_path(spark, "deposits")
    codes = F.concat(_nth(n, _NTH), F.lit(" ("), _nth(n + 2, _NTH), F.lit(")"))
    properties = {"ENO": n.cast("string"), "DEPOSIT_NAME": F.concat("n_name", F.lit("\n")), "STATE": F.lit(""), "OPERATING_STATUS": F.lit("Operating mine"), "COMMODITY_CODES": codes, "COMPANIES": F.lit("digger")}
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"), F.struct(F.array(n / 2, -n / 4).alias("coordinates")).alias("geometry"))
    table(spark, sf_dir, "nation").select(F.to_json(feature).alias("value")).write.text(path)
    symbols = spark.createDataFrame(list(_SYMBOLS.items()), "symbol string, name string")
    return C.unified_projects(readers.geojson_points(spark, path, by_line=True), majors, views, symbols, symbols.select("name", "symbol"))


@query(f"""{_PROJECTS} select eno, name, state, kind, a as first, b as second, {_name_sql('a')} || CASE WHEN b <> '' THEN ', (' || {_name_sql('b')} || ')' ELSE '' END as names, company from u""")
def unified_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects of three sources, one of them GeoJSON, in one table: the first source of an id wins, commodities are named, statuses graded."""
    p = _projects(spark, sf_dir)
    return p.select(F.col("ENO").alias("eno"), F.col("DEPOSIT_NAME").alias("name"), F.col("STATE").alias("state"), F.col("OPERATING_STATUS").alias("kind"), F.col("COMMODITY_PRIMARY").alias("first"), F.col("COMMODITY_SECONDARY").alias("second"), F.col("COMMODITY_NAMES").alias("names"), F.col("COMPANIES").alias("company"))


_STATES = {n: ("Victoria", "VIC") if i % 2 else ("Queensland", "QLD") for i, (n, _, _) in enumerate(_POLYGONS)}


@query(f"""with {_PIP}, c as (select vec_id, min_by(name, ord) as lga from (select *, {_case('name', {n: str(i) for i, (n, _, _) in enumerate(_POLYGONS)}, "'9'")} as ord from t where on_edge or odd) group by 1),
  w as (select vec_id, string_agg(name, ',' order by name) filter (where kind = 'igneous') as igneous, string_agg(name, ',' order by name) filter (where kind = 'tectonic') as tectonic
    from (select vec_id, name, {_case('name', {n: k for n, k, _ in _POLYGONS}, 'null')} as kind from t where odd and not on_edge) group by 1)
  select p.vec_id::varchar as eno, CASE WHEN p.vec_id % 2 = 0 THEN 'WA' ELSE {_case('lga', {n: v[1] for n, v in _STATES.items()}, 'null')} END as state, lga, igneous, tectonic
  from p left join c using (vec_id) left join w using (vec_id) where p.vec_id % 7 > 0""")
def enriched_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects with the area that covers them and the provinces they are within; without a place they go."""
    p = _points(spark, sf_dir)
    place = lambda c: F.when(F.col("vec_id") % 7 > 0, F.col(c).cast("string")).otherwise("n/a").alias
    projects = p.select(F.col("vec_id").cast("string").alias("ENO"), F.when(F.col("vec_id") % 2 == 0, "Western Australia").otherwise(" ").alias("STATE"), place("x")("LONG_GDA94"), place("y")("LAT_GDA94"))
    shapes = _polygons(spark)
    state = F.create_map(*[x for n, v in _STATES.items() for x in (F.lit(n), F.lit(v[0]))])[F.col("name")]
    areas = shapes.select("ord", state.alias("STE_NAME21"), F.col("name").alias("LGA_NAME25"), "rings")
    out = C.enriched_projects(projects, areas, shapes.select(F.col("name").alias("NAME"), F.col("type").alias("TYPE"), "rings"))
    known = F.col("LGA").isNotNull() | (F.col("STATE") == "WA")
    return out.select(F.col("ENO").alias("eno"), F.when(known, F.col("STATE")).alias("state"), F.col("LGA").alias("lga"), F.col("IGNEOUS").alias("igneous"), F.col("TECTONIC").alias("tectonic"))


_USES = f"{_PROJECTS}, r as (select eno, a as symbol, 'Primary' as role from u union select eno, b, 'Secondary' from u where b <> '')"
_GROUPS = {"Au": "Extraction", "Ag": "Extraction", "Cu": "Processing", "Zz": "Other"}


def _project_graph(spark: SparkSession, sf_dir: str) -> G.PropertyGraph:
    p = _projects(spark, sf_dir).withColumnRenamed("DEPOSIT_NAME", "PROJECT_NAME").withColumns({"LGA": F.concat(F.lit("area "), F.substring("ENO", -1, 1)), "STATE": F.when(F.col("STATE") == "", "Other").otherwise(F.trim("STATE")), **{c: F.lit("") for c in ("IGNEOUS", "METALLOGENIC", "SEDIMENTARY", "TECTONIC")}})
    return C.project_graph(G.PropertyGraph(), p)


@query(f"""{_USES} select 'HAS_COMMODITY' as kind, eno as a, symbol as b, role from r union all select 'LOCATED_IN', eno, 'area ' || right(eno, 1), null from u
  union all select 'REFERS_TO_PROJECT', eno, name, null from u union all select distinct 'AREA', 'area ' || right(eno, 1), CASE WHEN trim(state) = '' THEN 'Other' ELSE trim(state) END, null from u""")
def project_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of the project graph, between what they join."""
    g = _project_graph(spark, sf_dir)
    uses = g.hop("Project", "HAS_COMMODITY", "Commodity").select(F.lit("HAS_COMMODITY").alias("kind"), F.col("a.eno").alias("a"), F.col("b.symbol").alias("b"), F.col("r.role").alias("role"))
    none = F.lit(None).cast("string").alias("role")
    placed = g.hop("Project", "LOCATED_IN", "LGA").select(F.lit("LOCATED_IN").alias("kind"), F.col("a.eno").alias("a"), F.col("b.text").alias("b"), none)
    named = g.hop("ProjectName", "REFERS_TO_PROJECT", "Project").select(F.lit("REFERS_TO_PROJECT").alias("kind"), F.col("b.eno").alias("a"), F.col("a.text").alias("b"), none)
    areas = g.hop("LGA", "LOCATED_IN", "State").select(F.lit("AREA").alias("kind"), F.col("a.text").alias("a"), F.col("b.text").alias("b"), none)
    return uses.unionByName(placed).unionByName(named).unionByName(areas)


@query(f"""{_USES}, k as (select distinct symbol from r) select symbol, {_case('symbol', _GROUPS, 'null')} as commodity_group from k""")
def commodity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commodities with their group, and those without one."""
    rows = spark.createDataFrame([*_GROUPS.items(), ("Au ", "Extraction"), (None, "x"), ("Pb", " ")], "Commodity string, `Group` string")
    g, lone = C.commodity_groups(_project_graph(spark, sf_dir), rows)
    return g.hop("Commodity", "GROUPED_AS", "CommodityGroup").select("a.symbol", F.col("b.name").alias("commodity_group")).unionByName(lone.select("symbol", F.lit(None).cast("string").alias("commodity_group")))


_MATCHED = "(select p_partkey::varchar as a, (p_partkey + 1)::varchar as b from part where p_partkey + 1 in (select p_partkey from part))"


@query(f"""{_USES}, k as (select eno, symbol, max(CASE role WHEN 'Primary' THEN 1.0 ELSE 0.5 END)::double as w from r group by 1, 2), q as {_MATCHED},
  s as (select a, b, symbol, coalesce(max(w) filter (where side = 0), 0) as x, coalesce(max(w) filter (where side = 1), 0) as y from
    (select a, b, 0 as side, symbol, w from q join k on eno = a union all select a, b, 1, symbol, w from q join k on eno = b) group by 1, 2, 3)
  select a, b, round(sum(least(x, y)) / sum(greatest(x, y)), 6) as similarity from s group by 1, 2""")
def project_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of every two neighbouring projects by their commodities, asked of the graph."""
    keys = table(spark, sf_dir, "part").select("p_partkey")
    pairs = keys.join(keys.select((F.col("p_partkey") - 1).alias("p_partkey")), "p_partkey").select(F.col("p_partkey").cast("string").alias("a"), (F.col("p_partkey") + 1).cast("string").alias("b"))
    return C.project_similarity(_project_graph(spark, sf_dir), pairs).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("""with f as (select 'T' || (p_partkey % 500) as ticker, (p_partkey % 3)::int as file_rank, p_partkey as k, CASE p_partkey % 4 WHEN 0 THEN 'AU' WHEN 1 THEN ' us' WHEN 2 THEN 'FR' ELSE '--' END as code, p_size from part),
  g as (select *, min(file_rank) over (partition by ticker) as first from f),
  r as (select ticker, file_rank, k, CASE code WHEN 'AU' THEN 'Australia' WHEN ' us' THEN 'United States' WHEN 'FR' THEN 'France' END as country, CASE WHEN p_size % 2 = 0 THEN nullif((k % 7) * 1000.0::double, 0) END as cap, CASE WHEN p_size % 3 = 0 THEN nullif((k % 5) * 1.0::double, 0) END as assets from g where file_rank = first),
  m as (select * from r where country = 'Australia' or cap is not null or assets is not null)
  select ticker, country, cap, assets, nullif(k::varchar, '0') as name, row_number() over (order by cap is null, CASE country WHEN 'Australia' THEN 0 WHEN 'United States' THEN 1 WHEN 'France' THEN 4 ELSE 13 END, coalesce(cap, assets) desc nulls last, file_rank, k) as place from m""")
def market_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market data of files in three folders, cleaned and ordered, rows of equal or no value by their place in the files; unlisted foreigners go."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    texts = {"Ticker": F.concat(F.lit("T"), (k % 500).cast("string")), "Short Name": k.cast("string"), "Cntry Terrtry Of Dom": F.element_at(F.array(F.lit("AU"), F.lit(" us"), F.lit("FR"), F.lit("--")), (k % 4 + 1).cast("int")), "Company Type": F.lit("--")}
    texts["Market Cap"] = F.when(F.col("p_size") % 2 == 0, F.concat((k % 7).cast("string"), F.lit("K"))).otherwise("--")
    texts["Revenue:Y"] = F.lit(" ")
    texts["Tot Assets:Y"] = F.when(F.col("p_size") % 3 == 0, (k % 5).cast("string")).otherwise("0")
    texts["Number of Employees LF"] = F.lit("1k")
    rows = p.select(*[v.alias(n) for n, v in texts.items()], *[F.lit("x").alias(f"c{i}") for i in range(8)], k.alias("__k"))
    path = fresh_path(spark, "market")
    for i in range(3):
        mine = rows.filter(F.col("__k") % 3 == i)
        writers.write_csv(mine.repartitionByRange(2, "__k").sortWithinPartitions("__k").drop("__k"), f"{path}/{i}")
    # two files to a folder, which count as one source here
    files = readers.csv_folders(spark, [f"{path}/{i}" for i in range(3)], "Ticker").withColumns({"file_row": F.struct("file_rank", "file_row"), "file_rank": F.floor(F.col("file_rank") / 2).cast("int")})
    out = C.market_companies(files)
    return out.select(F.col("Ticker").alias("ticker"), F.col("Country of Domicile").alias("country"), F.col("Market Cap").alias("cap"), F.col("`Tot Assets:Y`").alias("assets"), F.col("Short Name").alias("name"), F.col("__place").alias("place"))


@query("""with m as (select c_custkey, c_name, c_mktsegment, n_name, c_custkey % 3 as k from customer join nation on n_nationkey = c_nationkey)
  select 'CLASSIFIED_AS' as kind, 'comp_' || c_custkey as a, CASE WHEN k > 0 THEN n_name ELSE c_mktsegment END as b, CASE WHEN k > 0 THEN 'Subsector' ELSE 'Sector' END as detail from m
  union all select 'REFERS_TO_COMPANY', 'comp_' || c_custkey, c_name, 'Current Name' from m union all select 'REFERS_TO_COMPANY', 'comp_' || c_custkey, 'alias ' || c_custkey, 'Synonym' from m where k = 1
  union all select 'DOMICILED_IN', 'comp_' || c_custkey, n_name, null from m union all select distinct 'PART_OF', n_name, c_mktsegment, null from m where k > 0""")
def company_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of the company graph, between what they join."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    k = F.col("c_custkey")
    master = c.select(F.concat(F.lit("comp_"), k.cast("string")).alias("companyID"), F.col("c_name").alias("name"), F.when(k % 3 == 1, F.concat(F.lit("alias "), k.cast("string"), F.lit(", "))).alias("synonyms"), F.col("n_name").alias("Country of Domicile"), F.col("c_mktsegment").alias("ICB Sector"), F.when(k % 3 > 0, F.col("n_name")).otherwise(" ").alias("ICB Subsector"))
    g = C.company_graph(G.PropertyGraph(), master, master.select("companyID", F.lit("none").alias("projectID")))
    none = F.lit(None).cast("string").alias("detail")
    out = g.hop("CompanyName", "REFERS_TO_COMPANY", "Company").select(F.lit("REFERS_TO_COMPANY").alias("kind"), F.col("b.id").alias("a"), F.col("a.text").alias("b"), F.col("r.type").alias("detail"))
    for label in ("ICBSubsector", "ICBSector"):
        out = out.unionByName(g.hop("Company", "CLASSIFIED_AS", label).select(F.lit("CLASSIFIED_AS").alias("kind"), F.col("a.id").alias("a"), F.col("b.text").alias("b"), F.col("r.level").alias("detail")))
    out = out.unionByName(g.hop("Company", "DOMICILED_IN", "Country").select(F.lit("DOMICILED_IN").alias("kind"), F.col("a.id").alias("a"), F.col("b.text").alias("b"), none))
    return out.unionByName(g.hop("ICBSubsector", "PART_OF", "ICBSector").select(F.lit("PART_OF").alias("kind"), F.col("a.text").alias("a"), F.col("b.text").alias("b"), none))
