"""The composite operators: ingest, enrichment, matching, merging and graph building, each one function from tables to tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.functions import vocabulary as V
from tessera.functions.countries import countries as iso_countries
from tessera.operators import graph as G
from tessera.operators import matching as M
from tessera.operators import order as O
from tessera.operators import relational as R
from tessera.operators import sequential as Q
from tessera.operators import spatial as P
from tessera.operators.stages import settled, written


# -- projects ----------------------------------------------------------------------
def _mapped(items: Column, table: DataFrame, key: str, value: str, df: DataFrame, out: str, row: str) -> DataFrame:
    """df with out: the items of an array column looked up one by one, kept as they are where the table has none."""
    each = df.select(row, F.posexplode(items).alias("__i", "__x")).join(table.select(F.col(key).alias("__x"), F.col(value).alias("__y")), "__x", "left")
    joined = each.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("__i", F.coalesce("__y", "__x").alias("v")))).alias("__l"))
    named = joined.select(row, F.transform("__l", lambda s: s["v"]).alias(out))
    return df.join(named, row, "left").withColumn(out, F.coalesce(out, F.expr("cast(array() as array<string>)")))


def unified_projects(deposits: DataFrame | None, majors: DataFrame | None, views: DataFrame | None, symbols: DataFrame, names: DataFrame) -> DataFrame:
    """One table of projects from three sources, of each ENO the first by source and place.

    deposits are GeoJSON features (with ord), majors and views CSV rows; those with
    an ord column keep its order, others that of their rows' ids. symbols maps symbol
    to name, names maps name to symbol.
    """
    def ordered(df: DataFrame) -> DataFrame:
        clean = df.select(*[X.clean_breaks(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
        return clean if "ord" in df.columns else clean.withColumn("ord", F.monotonically_increasing_id())

    parts = []
    if deposits is not None:
        d = ordered(deposits)
        codes = X.split_primary_secondary("COMMODITY_CODES")
        model = X.parse_pairs("DEPOSIT_MODEL", ("environment", "group", "type"))
        d = d.withColumns({
            "COMMODITY_PRIMARY": codes["primary"], "COMMODITY_SECONDARY": codes["secondary"],
            "LONG_GDA94": F.coalesce("LONG_GDA94", F.col("longitude").cast("string")), "LAT_GDA94": F.coalesce("LAT_GDA94", F.col("latitude").cast("string")),
            "DEPOSIT_MODEL_ENVIRONMENT": model["environment"], "DEPOSIT_MODEL_GROUP": model["group"], "DEPOSIT_MODEL_TYPE": model["type"],
        })
        parts.append(R.fixed_columns(d, [*V.PROJECT_COLUMNS, "ord"]))
    if majors is not None:
        m = ordered(majors).withColumnsRenamed({"PROJECT_NAME": "DEPOSIT_NAME", "PROJECT_TYPE": "OPERATING_STATUS", "PRINCIPAL_COMPANY": "COMPANIES"})
        split = X.split_primary_secondary("COMMODITY_PRIMARY")
        parts.append(R.fixed_columns(m.withColumns({"COMMODITY_SECONDARY": split["secondary"], "COMMODITY_PRIMARY": split["primary"]}), [*V.PROJECT_COLUMNS, "ord"]))
    if views is not None:
        v = ordered(views).withColumnsRenamed({"name": "DEPOSIT_NAME", "status": "OPERATING_STATUS", "owner": "COMPANIES"})
        split = X.split_primary_secondary("commodity")
        for column, part in (("COMMODITY_PRIMARY", "primary"), ("COMMODITY_SECONDARY", "secondary")):
            v = _mapped(X.split_list(split[part]), names, "name", "symbol", v, column, "ord")
        v = v.withColumns({c: F.array_join(c, ", ") for c in ("COMMODITY_PRIMARY", "COMMODITY_SECONDARY")})
        parts.append(R.fixed_columns(v, [*V.PROJECT_COLUMNS, "ord"]))
    whole = O.union_keep_first([p.withColumn("ord", F.col("ord").cast("bigint")) for p in parts], "ENO", "ord")
    for column, source in (("__p", "COMMODITY_PRIMARY"), ("__s", "COMMODITY_SECONDARY")):
        whole = _mapped(X.split_list(source), symbols, "symbol", "name", whole, column, "ENO")
    second = F.when(F.size("__s") > 0, F.concat(F.lit("("), F.array_join("__s", ", "), F.lit(")")))
    named = F.array_join(F.filter(F.concat("__p", F.array(second)), lambda x: x.isNotNull()), ", ")
    return written(whole.withColumns({"COMMODITY_NAMES": named, "OPERATING_STATUS": X.status_kind("OPERATING_STATUS")}).select(*V.PROJECT_COLUMNS), "projects")


def enriched_projects(projects: DataFrame, areas: DataFrame, provinces: DataFrame) -> DataFrame:
    """Projects with state and area (boundaries included) and the provinces they lie within, by kind; those without a place go.

    areas have ord, STE_NAME21, LGA_NAME25 and rings; provinces NAME, TYPE and rings.
    """
    located = projects.withColumn("__x", F.col("LONG_GDA94").try_cast("double")).withColumn("__y", F.col("LAT_GDA94").try_cast("double")).na.drop(subset=["__x", "__y"])
    key = located.select("ENO", "__x", "__y")
    hits = P.point_in_polygon(key, areas.select(F.col("ord").alias("__ord"), "STE_NAME21", "LGA_NAME25", "rings"), "__x", "__y", "rings", "covered_by").filter("__ord is not null")
    first = hits.groupBy("ENO").agg(F.min_by("STE_NAME21", "__ord").alias("__state"), F.min_by("LGA_NAME25", "__ord").alias("LGA"))
    inside = P.point_in_polygon(key, provinces.select("NAME", "TYPE", "rings"), "__x", "__y", "rings", "within")
    kinds = R.pivot_concat(inside, "ENO", "TYPE", "NAME", V.PROVINCE_KINDS).withColumnsRenamed({k: k.upper() for k in V.PROVINCE_KINDS})
    out = located.drop("LGA").join(first, "ENO", "left").join(kinds, "ENO", "left")
    out = out.withColumn("STATE", X.state_code(R.fill_from("STATE", "__state", blank=True))).withColumnsRenamed({"DEPOSIT_NAME": "PROJECT_NAME", "OPERATING_STATUS": "PROJECT_TYPE"})
    return written(R.ensure_columns(out, V.ENRICHED_COLUMNS), "enriched")


def project_graph(graph: G.PropertyGraph, projects: DataFrame) -> G.PropertyGraph:
    """Projects, their names, states, areas and commodities, and the edges between them; adds projectID by ENO."""
    df = O.dense_ids(projects.withColumn("ENO", F.col("ENO").cast("string")), ["ENO"], "project_", "id")
    graph.add_nodes("Project", df.select(
        "id", F.col("ENO").alias("eno"), X.point_text("LONG_GDA94", "LAT_GDA94").alias("location"), F.col("GEOLOGIC_AGE").alias("geologicAge"),
        F.col("DEPOSIT_MODEL_ENVIRONMENT").alias("depositModelEnvironment"), F.col("DEPOSIT_MODEL_GROUP").alias("depositModelGroup"), F.col("DEPOSIT_MODEL_TYPE").alias("depositModelType"),
        F.col("IGNEOUS").alias("igneous"), F.col("METALLOGENIC").alias("metallogenic"), F.col("SEDIMENTARY").alias("sedimentary"), F.col("TECTONIC").alias("tectonic"),
    ))
    names = df.select("id", F.explode(F.concat(F.array(F.trim("PROJECT_NAME")), F.coalesce(X.split_list("SYNONYMS"), F.expr("cast(array() as array<string>)")))).alias("name")).filter("name <> ''")
    graph.add_nodes("ProjectName", name_nodes := G.make_nodes(names, "name", "projectName_"))
    for label, column, prefix in (("State", "STATE", "state_"), ("LGA", "LGA", "lga_")):
        graph.add_nodes(label, G.make_nodes(df, column, prefix))
    refers = G.make_edges(names, "id", "name", name_nodes).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    graph.add_edges("REFERS_TO_PROJECT", "ProjectName", "Project", refers)
    graph.add_edges("LOCATED_IN", "Project", "LGA", G.make_edges(df, "id", "LGA", graph.label("LGA")))
    places = df.select(F.trim("LGA").alias("text"), "STATE").join(graph.label("LGA"), "text")
    graph.add_edges("LOCATED_IN", "LGA", "State", G.make_edges(places, "id", "STATE", graph.label("State")))

    roles = df.select("id", F.explode(F.array(
        F.struct(F.lit("Primary").alias("role"), F.col("COMMODITY_PRIMARY").alias("symbols")), F.struct(F.lit("Secondary").alias("role"), F.col("COMMODITY_SECONDARY").alias("symbols")))).alias("r"))
    uses = roles.select("id", "r.role", F.explode(X.split_list("r.symbols")).alias("symbol"))
    strip = lambda c: F.regexp_replace(c, "^[ ,]+|[ ,]+$", "")
    parts = X.split_primary_secondary("COMMODITY_NAMES")
    pairs = [df.select(F.explode(X.zip_shorter(X.split_list(symbols), X.split_list(strip(parts[part])))).alias("z")) for symbols, part in (("COMMODITY_PRIMARY", "primary"), ("COMMODITY_SECONDARY", "secondary"))]
    named = pairs[0].unionByName(pairs[1]).select("z.symbol", "z.name").groupBy("symbol").agg(F.min("name").alias("name"))
    commodities = G.make_nodes(uses, "symbol", "commodity_", text_col="symbol").join(named, "symbol", "left").select("id", "symbol", F.coalesce("name", "symbol").alias("name"))
    graph.add_nodes("Commodity", commodities)
    return graph.add_edges("HAS_COMMODITY", "Project", "Commodity", G.make_edges(uses, "id", "symbol", commodities, {"role": F.col("role")}, text_col="symbol"))


def commodity_groups(graph: G.PropertyGraph, categories: DataFrame) -> tuple[G.PropertyGraph, DataFrame]:
    """Groups of commodities as nodes named by themselves, the edges to them, and the commodities without a group."""
    rows = categories.select(F.trim("Commodity").alias("symbol"), F.trim("Group").alias("group")).na.drop().filter("symbol <> '' and group <> ''")
    graph.add_nodes("CommodityGroup", rows.select(F.col("group").alias("id"), F.col("group").alias("name")).distinct())
    known = graph.label("Commodity")
    graph.add_edges("GROUPED_AS", "Commodity", "CommodityGroup", known.join(rows, "symbol").select(F.col("id").alias("src"), F.col("group").alias("dst")))
    return graph, known.join(rows.select("symbol").distinct(), "symbol", "left_anti")


# -- companies ---------------------------------------------------------------------
def market_companies(files: DataFrame, countries: DataFrame | None = None, descriptions: DataFrame | None = None) -> DataFrame:
    """Market data of all files, of each ticker the rows of its first file, cleaned, described, without unlisted foreigners.

    files have file_rank, file_row where they come from csv_folders (else rows count in
    the order they are read), and 16 columns; countries map a two-letter code to a
    name, those of the standard if not given. __place gives the order of the list: by
    market value, then by assets; rows of equal or no value keep the order of their files.
    """
    # the order of rows is taken before any of them moves
    numbered = files.withColumn("__row", F.col("file_row") if "file_row" in files.columns else F.monotonically_increasing_id()).drop("file_row")
    first = F.min("file_rank").over(_by("Ticker"))
    rows = numbered.withColumn("__first", first).filter("file_rank = __first")
    data = [c for c in files.columns if c not in ("file_rank", "file_row")]
    if countries is None:
        countries = iso_countries(files.sparkSession)
    numeric = ("Market Cap", "Revenue:Y", "Tot Assets:Y", "Number of Employees LF")
    code = "Cntry Terrtry Of Dom"
    if code in data:
        rows = rows.withColumn("__code", F.upper(F.trim(F.col(f"`{code}`")))).join(countries.select(F.col("code").alias("__code"), F.col("name").alias("__country")), "__code", "left").withColumn(code, F.col("__country"))
    cleaned = [X.null_zero(X.shorthand_number(F.col(f"`{c}`"))).alias(c) if c in numeric else X.null_tokens(F.col(f"`{c}`")).alias(c) for c in data]
    rows = rows.select(*cleaned, "file_rank", "__row")
    if len(data) == len(V.MARKET_COLUMNS):
        rows = rows.toDF(*V.MARKET_COLUMNS, "file_rank", "__row")
    if descriptions is not None and "Ticker" in descriptions.columns:
        rows = R.enrich(rows, descriptions, "Ticker")
    if {"Short Name", "LONG_COMP_NAME"} <= set(rows.columns):
        rows = R.move_column(rows, "LONG_COMP_NAME", "Short Name").drop("Short Name")
    if not {"Country of Domicile", "Market Cap", "Revenue:Y", "Tot Assets:Y"} <= set(rows.columns):
        return rows.drop("file_rank")
    kept = R.without_unlisted(rows, "Country of Domicile", "Australia", ["Market Cap", "Revenue:Y", "Tot Assets:Y"])
    has = F.col("Market Cap").isNotNull() & (F.col("Market Cap") != 0)
    rank = F.coalesce(O.list_rank("Country of Domicile", V.COUNTRY_ORDER), F.lit(len(V.COUNTRY_ORDER)))
    value = F.when(has, F.col("Market Cap")).otherwise(F.col("`Tot Assets:Y`"))
    order = [F.when(has, 0).otherwise(1), rank, F.coalesce(-value, F.lit(float("inf"))), "file_rank", "__row"]
    return O.dense_ids(kept, order, "", "__place").drop("file_rank", "__row")


def _by(*columns: str):  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def merged_companies(market: DataFrame, profiles: DataFrame, statements: DataFrame) -> DataFrame:
    """The master table: market companies with statement revenue and profile data where they match, then the unmatched of each, with ids.

    Every source has name and ord; statements revenue, profiles description, employees
    and followers. Names too general to match are left out of profiles.
    """
    base = market.withColumn("Source", F.lit("market")).withColumn("__source_rank", F.lit(0))
    with_revenue = M.enrich_append(base, statements.withColumnRenamed("revenue", "__revenue").withColumn("__source_rank", F.lit(1)), "name", "ord", ["__revenue"], "statements")
    if "revenue" not in with_revenue.columns:
        with_revenue = with_revenue.withColumn("revenue", F.lit(None).cast("double"))
    with_revenue = with_revenue.withColumn("revenue", F.coalesce("revenue", F.col("__revenue").cast("double"))).drop("__revenue", "norm")
    # names are normalised and deduplicated anew: a statement that equals a market company goes
    again = M.prepared(with_revenue.withColumn("__order", F.struct("__source_rank", "ord")), "name", "__order").drop("norm", "__order")
    clean = profiles.filter(~X.is_dirty("name")).withColumnsRenamed({"employees": "linkedinEmployees", "followers": "linkedinFollowers", "description": "__description"}).withColumn("__source_rank", F.lit(2))
    whole = M.enrich_append(again, clean, "name", "ord", ["__description", "linkedinEmployees", "linkedinFollowers"], "profiles")
    if "description" not in whole.columns:
        whole = whole.withColumn("description", F.lit(None).cast("string"))
    whole = whole.withColumn("description", F.coalesce("description", "__description")).drop("__description", "norm")
    return M.with_company_ids(whole, ["__source_rank", "ord"]).drop("__source_rank")


def cascaded_matches(projects: DataFrame, master: DataFrame, column: str = "COMPANIES") -> DataFrame:
    """Company names of projects matched against the master's sources, market first, then profiles, then statements.

    One row for each name: its match, source, rule and scores; the market's vector
    gate begins at 90, the others' is open above.
    """
    names = projects.select(F.explode(X.split_list(column)).alias("name")).distinct().withColumn("l", X.normalize_name("name")).filter("l <> ''")
    names = written(names, "names")
    rest, out = names.select("l").distinct(), None
    for source, gate in (("market", (90.0, 100.0)), ("profiles", (90.0, 101.0)), ("statements", (90.0, 101.0))):
        right = written(M.prepared(master.filter(F.col("Source") == source), "name", "ord"), "source")
        def found() -> DataFrame:
            good = M.confident(rest, right, "l", "norm", vector_gate=gate).withColumn("matched_source", F.lit(source))  # noqa: B023
            return good.join(right.select(F.col("norm").alias("r"), F.col("name").alias("matched_name")), "r")  # noqa: B023

        got = settled(found, "cascade")
        out = got if out is None else out.unionByName(got)
        rest = written(rest.join(got.select("l"), "l", "left_anti"), "cascade")
    return names.join(out, "l", "left").withColumn("status", F.coalesce("status", F.lit("no_candidate_found")))


def former_names(register: DataFrame, companies: DataFrame) -> DataFrame:
    """companyID, ACN and all registered names of the companies found in the register, in its order, in title case."""
    numbers = Q.register_names(register)
    variants = companies.select("companyID", F.posexplode(X.name_variants("name")).alias("prio", "name"))
    found = written(R.first_hit(variants, numbers, "companyID", "name", "prio", "acn"), "found")
    named = register.filter("trim(name) <> '' and trim(acn) <> ''").select(F.trim("acn").alias("acn"), X.title_case(F.trim("name")).alias("n"), "ord")
    lists = named.join(found.select("acn").distinct(), "acn", "left_semi").groupBy("acn").agg(R.ordered_list("n", "ord").alias("names"))
    return found.join(lists, "acn").select("companyID", F.col("acn").alias("ACN"), "names")


def company_master(merged: DataFrame, matches: DataFrame, former: DataFrame | None, manual: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The merged table with synonyms and numbers, rows that share a name absorbed by the earliest; and the log of that.

    Synonyms are the names that projects use for a company, then former names, then
    manual aliases, none twice in any case.
    """
    used = R.differing(matches.filter("matched_name is not null"), "name", "matched_name").groupBy(F.col("matched_name").alias("name"), F.col("matched_source").alias("Source")).agg(R.sorted_concat("name").alias("__used"))
    df = merged.join(used, ["name", "Source"], "left").withColumn("__syn", F.coalesce(X.split_list("__used"), F.expr("cast(array() as array<string>)")))
    if former is None:
        df = df.withColumn("acn", F.lit(None).cast("string"))
    else:
        df = df.join(former.select("companyID", F.col("ACN").alias("acn"), F.col("names").alias("__former")), "companyID", "left")
        df = _more_names(df, "__former")
    if manual is not None:
        df = df.join(manual.groupBy("companyID").agg(F.flatten(F.collect_list(X.split_list("alias"))).alias("__manual")), "companyID", "left")
        df = _more_names(df, "__manual")
    ready = df.withColumn("synonyms", F.nullif(F.array_join("__syn", ", "), F.lit(""))).withColumn("ord", X.id_number("companyID")).drop("__syn", "__used", "__former", "__manual")
    fill = tuple(c for c in ("revenue", "linkedinEmployees", "linkedinFollowers") if c in ready.columns)
    return Q.consolidate(written(ready, "master"), "ord", "name", "synonyms", "acn", fill)


def _more_names(df: DataFrame, column: str) -> DataFrame:
    known = F.concat(F.array(F.col("name")), F.col("__syn"))
    merged = X.merge_names(known, F.coalesce(F.col(column), F.expr("cast(array() as array<string>)")))
    return df.withColumn("__syn", F.slice(merged, 2, F.size(merged)))


def project_owners(projects: DataFrame, project_ids: DataFrame, master: DataFrame, column: str = "COMPANIES") -> DataFrame:
    """companyID, projectID: the projects of each company one of whose names a project names with high confidence."""
    named = projects.select("ENO", F.explode(X.split_list(column)).alias("name")).withColumn("l", X.normalize_name("name")).filter("l <> ''")
    every = F.concat(F.array("name"), F.coalesce(X.split_list("synonyms"), F.expr("cast(array() as array<string>)")))
    known = master.select("companyID", X.id_number("companyID").alias("o"), F.explode(every).alias("n")).withColumn("norm", X.normalize_name("n")).filter("norm <> ''")
    owner = written(O.last_wins(known, ["norm"], "companyID", "o", "companyID"), "owner")
    named = written(named, "named")
    good = settled(lambda: M.confident(named, owner, "l", "norm").select("l", F.col("r").alias("norm")), "owners")
    return named.join(good, "l").join(owner, "norm").join(project_ids.select("ENO", "projectID"), "ENO").select("companyID", "projectID").distinct()


#: Label, column, id prefix and scheme of company classes, from coarse to fine within a scheme.
CLASSES = (
    ("ICBSector", "ICB Sector", "icb_sec_", "ICB"), ("ICBSubsector", "ICB Subsector", "icb_sub_", "ICB"),
    ("GICSIndustry", "GICS Industry", "gics_ind_", "GICS"), ("GICSSubIndustry", "GICS SubIndustry", "gics_sub_", "GICS"),
    ("BICSL3", "BICS L3 Industry", "bics_l3_", "BICS"), ("BICSL4", "BICS L4 Sub Industry", "bics_l4_", "BICS"),
    ("BICSL5", "BICS L5 Segment", "bics_l5_", "BICS"), ("BICSL6", "BICS L6 Segment", "bics_l6_", "BICS"),
)


def company_graph(graph: G.PropertyGraph, master: DataFrame, owners: DataFrame) -> G.PropertyGraph:
    """Companies, their names, countries and classes, and the edges between them; owners are (companyID, projectID)."""
    have = set(master.columns)
    numbers = {"marketCap": "Market Cap", "totalAssets": "Tot Assets:Y", "revenue": "revenue", "employees": "Number of Employees:LF", "linkedinEmployees": "linkedinEmployees", "linkedinFollowers": "linkedinFollowers"}
    props = [F.col(f"`{c}`").try_cast("double").alias(k) for k, c in numbers.items() if c in have]
    texts = [F.col(f"`{c}`").alias(k) for k, c in (("ticker", "Ticker"), ("acn", "acn"), ("description", "description")) if c in have]
    graph.add_nodes("Company", master.select(F.col("companyID").alias("id"), *texts, *props))
    current = master.select("companyID", F.trim("name").alias("name"), F.lit("Current Name").alias("type"))
    other = master.select("companyID", F.explode(X.split_list("synonyms")).alias("name"), F.lit("Synonym").alias("type"))
    names = current.unionByName(other)
    graph.add_nodes("CompanyName", nodes := G.make_nodes(names, "name", "compname_"))
    refers = G.make_edges(names, "companyID", "name", nodes, {"type": F.col("type")})
    graph.add_edges("REFERS_TO_COMPANY", "CompanyName", "Company", refers.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type"))
    if "Country of Domicile" in have:
        graph.add_nodes("Country", G.make_nodes(master, "Country of Domicile", "country_"))
        graph.add_edges("DOMICILED_IN", "Company", "Country", G.make_edges(master, "companyID", "Country of Domicile", graph.label("Country")))
    present = [c for c in CLASSES if c[1] in have]
    for label, column, prefix, _ in present:
        graph.add_nodes(label, G.make_nodes(master, column, prefix))
    for coarse, fine in zip(present, present[1:], strict=False):
        if coarse[3] == fine[3]:
            levels = G.hierarchy_edges(master, fine[1], coarse[1])
            child = levels.join(graph.label(fine[0]).select(F.col("id").alias("c"), F.col("text").alias("src")), "src").join(graph.label(coarse[0]).select(F.col("id").alias("p"), F.col("text").alias("dst")), "dst")
            graph.add_edges("PART_OF", fine[0], coarse[0], child.select(F.col("c").alias("src"), F.col("p").alias("dst")))
    for scheme in dict.fromkeys(c[3] for c in present):
        levels = [c for c in present if c[3] == scheme][::-1]  # a company is classified at its finest level only
        taken = F.lit(False)
        for label, column, _, _ in levels:
            filled = F.coalesce(F.trim(F.col(f"`{column}`")) != "", F.lit(False))
            rows = master.filter(filled & ~taken)
            edges = G.make_edges(rows, "companyID", column, graph.label(label)).withColumns({"scheme": F.lit(scheme), "level": F.lit(label.removeprefix(scheme))})
            graph.add_edges("CLASSIFIED_AS", "Company", label, edges)
            taken = taken | filled
    if "Project" in graph.nodes:
        graph.add_edges("OWNS", "Company", "Project", owners.select(F.col("companyID").alias("src"), F.col("projectID").alias("dst")))
    return graph


# -- questions ------------------------------------------------------------------------
def project_similarity(graph: G.PropertyGraph, pairs: DataFrame) -> DataFrame:
    """a, b, similarity of projects by their commodities, primary ones weighing twice secondary ones; a and b are ENO."""
    uses = graph.hop("Project", "HAS_COMMODITY", "Commodity").select(F.col("a.eno").alias("e"), F.col("b.symbol").alias("i"), F.col("r.role").alias("role"))
    return R.weighted_jaccard(uses, "e", "i", "role", {"Primary": 1.0, "Secondary": 0.5}, 0.1, pairs)


def name_report(graph: G.PropertyGraph, terms: DataFrame, labels: Sequence[str] = ("ProjectName", "CompanyName")) -> DataFrame:
    """Each term with the names of any of the labels that contain it."""
    names = None
    for label in labels:
        part = graph.label(label).select("text")
        names = part if names is None else names.unionByName(part)
    return G.search_report(names, "text", terms)


Translator = Callable[[str, str], str]
