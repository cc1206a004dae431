"""The companies end to end: market data, statements and profiles merged, matched with projects, given synonyms and numbers, consolidated, and joined to the projects they own.

Names are made of the driver's tables, two words to a company, so that plain SQL can say
which of them match: equal names, and names that differ by an "au" at the end of the left one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.operators.stages import written
from tessera.plans import pipelines as C
from tessera.plans.pattern_query import ask
from tessera.plans.queries import query, table, trade_graph


def _two(a: str, b: str, n: Column) -> Column:
    return F.concat(F.lit(a), n.cast("string"), F.lit(f" {b}"), n.cast("string"))


def _two_sql(a: str, b: str, n: str) -> str:
    return f"'{a}' || {n} || ' {b}' || {n}"


_KEY = "c_custkey - (c_custkey % 40 = 39)::int"
#: market, statements and profiles, then the merged table (mg) with its ids.
_MERGED = f"""mk as (select c_custkey as ord, {_two_sql('N', 'M', f'({_KEY})')} || CASE c_custkey % 5 WHEN 0 THEN ' Australia' WHEN 1 THEN ' Pty Ltd' ELSE '' END as name,
    {_two_sql('n', 'm', f'({_KEY})')} || CASE c_custkey % 5 WHEN 0 THEN ' au' ELSE '' END as norm, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END as revenue, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END as description from customer),
  mkt as (select * from mk qualify row_number() over (partition by norm order by ord) = 1),
  st as (select p_partkey as ord, CASE p_partkey % 3 WHEN 0 THEN {_two_sql('N', 'M', 'p_partkey')} WHEN 1 THEN {_two_sql('N', 'Q', 'p_partkey')} ELSE {_two_sql('N', 'R', 'p_partkey')} || ' Australia' END as name,
    CASE p_partkey % 3 WHEN 0 THEN {_two_sql('n', 'm', 'p_partkey')} WHEN 1 THEN {_two_sql('n', 'q', 'p_partkey')} ELSE {_two_sql('n', 'r', 'p_partkey')} || ' au' END as norm, p_retailprice as revenue from part),
  sm as (select a.norm, b.norm as other, b.revenue as more from mkt a join st b on b.norm = a.norm union all select a.norm, b.norm, b.revenue from mkt a join st b on a.norm = b.norm || ' au'),
  again as (select 0 as rank, ord, name, norm, 'market' as source, coalesce(revenue, more) as revenue, description from mkt left join sm using (norm)
    union all select 1, ord, name, norm, 'statements', revenue, null from st where norm not in (select other from sm)),
  pf as (select s_suppkey as ord, CASE s_suppkey % 4 WHEN 0 THEN {_two_sql('N', 'M', 's_suppkey')} || ' Ltd' WHEN 2 THEN {_two_sql('N', 'Q', 's_suppkey')} ELSE {_two_sql('Z', 'Y', 's_suppkey')} END as name,
    CASE s_suppkey % 4 WHEN 0 THEN {_two_sql('n', 'm', 's_suppkey')} WHEN 2 THEN {_two_sql('n', 'q', 's_suppkey')} ELSE {_two_sql('z', 'y', 's_suppkey')} END as norm,
    'about ' || s_suppkey as about, (s_suppkey * 10)::int as employees, s_nationkey as followers from supplier where s_suppkey % 4 <> 1),
  pm as (select a.norm, b.norm as other, about, employees, followers from again a join pf b on b.norm = a.norm union all select a.norm, b.norm, about, employees, followers from again a join pf b on a.norm = b.norm || ' au'),
  mg as (select *, 'comp_' || row_number() over (order by rank, ord) as id, row_number() over (order by rank, ord) as num from
    (select rank, ord, name, norm, source, revenue, coalesce(description, about) as description, employees, followers from again left join pm using (norm)
    union all select 2, ord, name, norm, 'profiles', null, about, employees, followers from pf where norm not in (select other from pm)))"""


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, part, supplier = (table(spark, sf_dir, t) for t in ("customer", "part", "supplier"))
    c, p, s = F.col("c_custkey"), F.col("p_partkey"), F.col("s_suppkey")
    key = c - (c % 40 == 39).cast("int")
    market = customer.select(c.alias("ord"), F.concat(_two("N", "M", key), F.when(c % 5 == 0, " Australia").when(c % 5 == 1, " Pty Ltd").otherwise("")).alias("name"), F.when(c % 3 == 0, F.col("c_acctbal")).alias("revenue"), F.when(c % 4 == 0, F.col("c_mktsegment")).alias("description"))
    statements = part.select(p.alias("ord"), F.when(p % 3 == 0, _two("N", "M", p)).when(p % 3 == 1, _two("N", "Q", p)).otherwise(F.concat(_two("N", "R", p), F.lit(" Australia"))).alias("name"), F.col("p_retailprice").alias("revenue"))
    name = F.when(s % 4 == 0, F.concat(_two("N", "M", s), F.lit(" Ltd"))).when(s % 4 == 1, " Minerals").when(s % 4 == 2, _two("N", "Q", s)).otherwise(_two("Z", "Y", s))
    profiles = supplier.select(s.alias("ord"), name.alias("name"), F.concat(F.lit("about "), s.cast("string")).alias("description"), (s * 10).cast("int").alias("employees"), F.col("s_nationkey").alias("followers"))
    return written(C.merged_companies(market, profiles, statements), "merged")


@query(f"with {_MERGED} select id, name, source, revenue, description, employees, followers from mg")
def merged_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market companies with what statements and profiles say of them, then the rest of both, with ids."""
    m = _merged(spark, sf_dir)
    return m.select(F.col("companyID").alias("id"), "name", F.col("Source").alias("source"), "revenue", "description", F.col("linkedinEmployees").alias("employees"), F.col("linkedinFollowers").alias("followers"))


_J, _I = "((p_partkey * 7) % 1600)", "(p_partkey % 120)"
#: Projects with the companies that they name, and what each name is matched with.
_MATCHES = f"""{_MERGED},
  pj as (select p_partkey::varchar as eno, {_two_sql('N', 'M', _J)} || CASE WHEN p_partkey % 11 = 0 THEN ' Australia' ELSE ' Limited' END as name, {_two_sql('n', 'm', _J)} || CASE WHEN p_partkey % 11 = 0 THEN ' au' ELSE '' END as l from part
    union all select p_partkey::varchar, {_two_sql('Z', 'Y', _I)}, {_two_sql('z', 'y', _I)} from part),
  nm as (select distinct name, l from pj),
  hits as (select l, source, name as matched, CASE source WHEN 'market' THEN 0 WHEN 'profiles' THEN 1 ELSE 2 END as prio, 0 as far from nm n join (select norm as l, source, name as matched from mg) m using (l)
    union all select n.l, source, m.name, CASE source WHEN 'market' THEN 0 WHEN 'profiles' THEN 1 ELSE 2 END, 1 from nm n join mg m on n.l = m.norm || ' au')"""
_MATCHES = _MATCHES.replace("select l, source, name as matched, CASE", "select l, source, matched, CASE") + """,
  ms as (select name, l, source, matched from nm left join (select l, source, matched from hits qualify row_number() over (partition by l order by prio, far) = 1) using (l))"""


def _projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    first = F.concat(_two("N", "M", (p * 7) % 1600), F.when(p % 11 == 0, " Australia").otherwise(" Limited"))
    return table(spark, sf_dir, "part").select(p.cast("string").alias("ENO"), F.concat(first, F.lit(", "), _two("Z", "Y", p % 120)).alias("COMPANIES"))


@query(f"with {_MATCHES} select name, source, matched from ms")
def cascaded_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each company name of a project with its match among market companies, else profiles, else statements."""
    found = C.cascaded_matches(_projects(spark, sf_dir), _merged(spark, sf_dir))
    return found.select("name", F.col("matched_source").alias("source"), F.col("matched_name").alias("matched"))


_TITLE = "CASE ord % 5 WHEN 0 THEN ' Australia' WHEN 1 THEN ' Pty Limited' ELSE '' END"
_COMPANIES = f"""with {_MATCHES},
  us as (select matched as name, source, list(distinct name order by name) as used from ms where matched is not null and name <> matched group by 1, 2),
  sy as (select mg.*, coalesce(used, []) as used, CASE WHEN source = 'market' and ord % 4 = 0 THEN (1000 + ord)::varchar END as acn,
    CASE WHEN source = 'market' and ord % 4 = 0 THEN ['Old' || ord || ' Co', {_two_sql('N', 'M', 'ord')} || {_TITLE}] ELSE [] END as former, CASE WHEN source = 'market' and ord % 10 = 7 THEN [{_two_sql('Z', 'Y', 'ord')}, 'Fresh' || ord] ELSE [] END as manual from mg left join us using (name, source)),
  s2 as (select *, list_concat(used, list_filter(former, lambda f: lower(f) <> lower(name) and not list_contains(list_transform(used, lambda u: lower(u)), lower(f)))) as grown from sy),
  s3 as (select *, list_concat(grown, list_filter(manual, lambda f: lower(f) <> lower(name) and not list_contains(list_transform(grown, lambda u: lower(u)), lower(f)))) as synonyms from s2),
  gone as (select p.id, p.num, p.name, p.employees, p.followers, t.id as target, t.num as target_num from s3 p join s3 t on t.source = 'market' and t.ord % 10 = 7 and p.source = 'profiles' and p.name = {_two_sql('Z', 'Y', 't.ord')}),
  kept as (select s3.id, s3.num, s3.name, s3.source, array_to_string(synonyms, ', ') as synonyms, acn, revenue, coalesce(s3.employees, gone.employees) as employees, list_concat([s3.name], synonyms) as every from s3 left join gone on gone.target = s3.id where s3.id not in (select id from gone)),
  owner as (select {{norm}} as norm, max_by(id, num) as id from (select id, num, unnest(every) as n from kept) group by 1),
  owns as (select distinct o.id, eno from pj join owner o on o.norm = l union select distinct o.id, eno from pj join owner o on l = o.norm || ' au' where l not in (select norm from owner))
  select 'company' as kind, id, name as a, source as b, nullif(synonyms, '') as c, acn as d, revenue as x, employees as y from kept
  union all select 'log', 'comp_' || num, name, 'comp_' || target_num, name, 'linkedinEmployees, linkedinFollowers', null, null from gone union all select 'owns', id, eno, null, null, null, null, null from owns"""


def _with_norm() -> str:
    from tessera.plans.queries import normalised_sql

    return _COMPANIES.replace("{norm}", normalised_sql("n"))


@query(_with_norm())
def company_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: the consolidated companies, what was absorbed into which, and the OWNS edges of the graph."""
    merged, projects = _merged(spark, sf_dir), _projects(spark, sf_dir)
    matches = written(C.cascaded_matches(projects, merged), "matches")
    # a register in which each company stands under a former name and its own, few rows of which are wide enough to count
    customer, c = table(spark, sf_dir, "customer"), F.col("c_custkey")
    own = F.concat(_two("N", "M", c), F.when(c % 5 == 0, " AUSTRALIA").when(c % 5 == 1, " PTY LIMITED").otherwise(""))
    width, acn = F.when(c % 4 == 0, 14).otherwise(3), (c + 1000).cast("string")
    entries = F.explode(F.array(F.struct((2 * c).alias("ord"), F.concat(F.lit("OLD"), c.cast("string"), F.lit(" CO")).alias("name")), F.struct((2 * c + 1).alias("ord"), own.alias("name"))))
    register = customer.select(entries.alias("e"), acn.alias("acn"), width.alias("n_columns")).select("e.ord", "e.name", "acn", F.lit("").alias("previous"), "n_columns")
    former = C.former_names(register, merged)
    chosen = merged.filter((F.col("Source") == "market") & (F.col("ord") % 10 == 7))
    manual = chosen.select("companyID", F.concat(_two("Z", "Y", F.col("ord")), F.lit(", Fresh"), F.col("ord").cast("string")).alias("alias"))
    kept, log = C.company_master(merged, matches, former, manual)
    kept = written(kept, "kept")
    ids = projects.select("ENO", F.concat(F.lit("project_"), "ENO").alias("projectID"))
    owners = C.project_owners(projects, ids, kept)
    graph = G.PropertyGraph(nodes={"Project": ids.select(F.col("projectID").alias("id"), F.col("ENO").alias("eno"))})
    owns = C.company_graph(graph, kept, owners).hop("Company", "OWNS", "Project")
    none = lambda name, kind="string": F.lit(None).cast(kind).alias(name)
    companies = kept.select(F.lit("company").alias("kind"), F.col("companyID").alias("id"), F.col("name").alias("a"), F.col("Source").alias("b"), F.col("synonyms").alias("c"), F.col("acn").alias("d"), F.col("revenue").alias("x"), F.col("linkedinEmployees").alias("y"))
    number = lambda col: F.concat(F.lit("comp_"), F.col(col).cast("string"))
    absorbed = log.select(F.lit("log").alias("kind"), number("dropped").alias("id"), F.col("matched_name").alias("a"), number("target").alias("b"), F.col("merged_names").alias("c"), F.col("updated_columns").alias("d"), none("x", "double"), none("y", "int"))
    edges = owns.select(F.lit("owns").alias("kind"), F.col("a.id").alias("id"), F.col("b.eno").alias("a"), none("b"), none("c"), none("d"), none("x", "double"), none("y", "int"))
    return companies.unionByName(absorbed).unionByName(edges)


@query("""select n_name as nation, count(*) as buyers from customer join nation on n_nationkey = c_nationkey where contains(lower(c_mktsegment), 'build') group by 1""")
def asked_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in words, turned into a query by a translator that reads the graph's schema and fences its answer."""
    def translate(question: str, schema: str) -> str:
        place = next(line for line in schema.splitlines() if "LOCATED_IN" in line and "Customer" in line)
        kind = place.split("[:")[1].split(" ")[0].rstrip("]{")
        word = question.split("'")[1]
        return f"```cypher\nMATCH (c:Customer)-[:{kind}]->(n:Nation) WHERE toLower(c.segment) CONTAINS '{word}' RETURN n.text AS nation, count(*) AS buyers\n```"

    return ask(trade_graph(spark, sf_dir), "How many buyers in 'build' segments has each nation?", translate)
