"""Property graphs as one node table for each label and one edge table for each type."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.order import dense_ids
from tessera.operators.stages import folders, release, remove, replace_text
from tessera.operators.stages import written as cut
from tessera.operators.substring import containing

MANIFEST = "graph.json"


def make_nodes(df: DataFrame, value: str, prefix: str, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """id, text: distinct non-blank trimmed values, numbered in their order."""
    values = df.select(F.trim(F.col(value).cast("string")).alias(text_col)).filter(f"{text_col} <> ''").distinct()
    return dense_ids(values, [text_col], prefix, id_col).select(id_col, text_col)


def make_edges(df: DataFrame, src: str, value: str, nodes: DataFrame, props: Mapping[str, Column] | None = None, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """src, dst and properties: each row's trimmed value looked up among nodes; values without a node give no edge."""
    rows = df.select(F.col(src).alias("src"), F.trim(F.col(value).cast("string")).alias(text_col), *[c.alias(k) for k, c in (props or {}).items()])
    return rows.join(nodes, text_col).select("src", F.col(id_col).alias("dst"), *(props or {})).distinct()


def upsert_nodes(df: DataFrame, id_col: str, order: str) -> DataFrame:
    """One row for each id: every property's value in its last row."""
    rest = [c for c in df.columns if c not in (id_col, order)]
    return df.groupBy(id_col).agg(*[F.max_by(c, order).alias(c) for c in rest])


def merge_edges(edges: DataFrame, sources: DataFrame, targets: DataFrame, source_id: str = "id", target_id: str = "id") -> DataFrame:
    """Distinct edges, properties included, both of whose ends exist."""
    kept = edges.join(sources.select(F.col(source_id).alias("src")), "src", "left_semi").join(targets.select(F.col(target_id).alias("dst")), "dst", "left_semi")
    return kept.select(*edges.columns).dropDuplicates()


def duplicate_ids(nodes: DataFrame, id_col: str) -> DataFrame:
    """Ids that break uniqueness, with how often they occur; empty for a good table."""
    return nodes.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(id_col).isNull())


def hierarchy_edges(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct (child, parent) pairs of neighbouring levels, blanks left out."""
    clean = lambda c: F.trim(F.col(c).cast("string"))
    return df.select(clean(child).alias("src"), clean(parent).alias("dst")).filter("src <> '' and dst <> ''").distinct()


def closure(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """src, dst, depth for all pairs joined by directed edges, with the least depth, in as many rounds as the logarithm of the greatest.

    With the pairs up to depth d known, those of up to 2d are a pair of depth d and one
    of up to d after it. Each round's new pairs are a table of their own, and tables
    of earlier rounds are read, not written again. With max_depth, pairs up to that depth only.
    """
    found = [cut(edges.select("src", "dst").distinct().withColumn("depth", F.lit(1)), "closure")]
    reach = 1
    while max_depth is None or reach < max_depth:
        known = reduce(DataFrame.unionByName, found)
        ahead = found[-1].filter(F.col("depth") == reach).select("src", F.col("dst").alias("via"))
        further = ahead.join(known.select(F.col("src").alias("via"), "dst", (F.col("depth") + reach).alias("depth")), "via").groupBy("src", "dst").agg(F.min("depth").alias("depth"))
        held = known.select(F.col("src").alias("a"), F.col("dst").alias("b"))
        fresh = further.join(held, F.col("src").eqNullSafe(F.col("a")) & F.col("dst").eqNullSafe(F.col("b")), "left_anti")
        new = cut(fresh if max_depth is None else fresh.filter(F.col("depth") <= max_depth), "closure")
        if new.isEmpty():
            release(new)
            break
        found.append(new)
        reach *= 2
    return reduce(DataFrame.unionByName, found)


@dataclass
class PropertyGraph:
    """Nodes by label, each with the column ``id``; edges by type, each with ``src`` and ``dst``.

    ends maps an edge type to the (source label, target label) pairs that it may join.
    """

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[str, DataFrame] = field(default_factory=dict)
    ends: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    def label(self, name: str) -> DataFrame:
        return self.nodes[self.aliases.get(name, name)]

    def edge(self, name: str) -> DataFrame:
        return self.edges[self.aliases.get(name, name)]

    def add_nodes(self, label: str, df: DataFrame) -> PropertyGraph:
        self.nodes[label] = df
        return self

    def add_edges(self, kind: str, source: str, target: str, df: DataFrame) -> PropertyGraph:
        """Edges whose ends exist; a second call with one type adds to it."""
        merged = merge_edges(df, self.label(source), self.label(target)).withColumn("src_label", F.lit(source)).withColumn("dst_label", F.lit(target))
        self.edges[kind] = self.edges[kind].unionByName(merged, allowMissingColumns=True) if kind in self.edges else merged
        self.ends.setdefault(kind, []).append((source, target))
        return self

    def hop(self, source: str, kind: str, target: str, where: Column | None = None) -> DataFrame:
        """(a, r, b) as structs for source -[kind]-> target; where speaks of a, r and b."""
        struct = lambda df, name: df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
        a, r, b = struct(self.label(source), "a"), struct(self.edge(kind), "r"), struct(self.label(target), "b")
        out = a.join(r, F.col("a.id") == F.col("r.src")).join(b, F.col("b.id") == F.col("r.dst"))
        return out.filter(where) if where is not None else out

    def steps(self, kinds: Sequence[tuple[str, str, str]], direction: str = "out") -> DataFrame:
        """src, dst, type and edge (all that tells an edge from others, as JSON) of the edges of (type, source label, target label), as they are walked: out, in or both ways."""
        every = []
        for kind, source, target in kinds:
            e = self.edges[kind].filter((F.col("src_label") == source) & (F.col("dst_label") == target))
            every.append(e.select("src", "dst", F.lit(kind).alias("type"), F.to_json(F.struct(F.lit(kind).alias("type"), *[F.col(f"`{c}`") for c in sorted(e.columns)])).alias("edge")))
        ahead = reduce(DataFrame.unionByName, every)
        back = ahead.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type", "edge")
        return ahead if direction == "out" else back if direction == "in" else ahead.unionByName(back.filter("src <> dst"))  # a loop is one way, not two

    def paths(self, starts: DataFrame, kinds: Sequence[tuple[str, str, str]], least: int = 1, most: int = 3, direction: str = "both") -> DataFrame:
        """a, b, length and edges of the walks of least to most steps from each id of starts (column id) that use no edge twice.

        One join a step. The number of walks grows with the degrees of the nodes they pass,
        so the bound is part of the question; each step's walks are written, and
        an end that very many of them reach is a skewed key of the next join, which may be split.
        """
        if not 0 <= least <= most:
            raise ValueError(f"{least} to {most} steps")
        edges = cut(self.steps(kinds, direction).select(F.col("src").alias("b"), F.col("dst").alias("next"), "edge"), "steps")
        now = starts.select(F.col("id").alias("a")).distinct().select("a", F.col("a").alias("b"), F.expr("cast(array() as array<string>)").alias("edges"))
        found = [now] if least == 0 else []
        for step in range(1, most + 1):
            walks = now.join(edges, "b").filter(~F.array_contains("edges", F.col("edge")))
            now = walks.select("a", F.col("next").alias("b"), F.concat("edges", F.array("edge")).alias("edges"))
            now = cut(now, "walks") if step < most else now
            if step >= least:
                found.append(now)
        return reduce(DataFrame.unionByName, found).select("a", "b", F.size("edges").alias("length"), "edges")

    def common_targets(self, kind: str, keep_self: bool = False) -> DataFrame:
        """a, x, b: pairs of nodes with an edge to the same node."""
        e = self.edge(kind)
        out = e.select(F.col("src").alias("a"), F.col("dst").alias("x")).join(e.select(F.col("src").alias("b"), F.col("dst").alias("x")), "x")
        return out.select("a", "x", "b") if keep_self else out.filter("a < b").select("a", "x", "b")

    def search(self, label: str, column: str, terms: DataFrame, term: str = "term") -> DataFrame:
        """term with the nodes whose column contains it in any case."""
        nodes = self.label(label)
        found = containing(nodes, column, terms, term).withColumnRenamed("text", "__text")
        return nodes.join(found, F.col(column) == F.col("__text")).drop("__text")

    def register(self) -> None:
        """Temporary views node_<label> and edge_<type>, for SQL."""
        for name, df in self.nodes.items():
            df.createOrReplaceTempView(f"node_{name}")
        for name, df in self.edges.items():
            df.createOrReplaceTempView(f"edge_{name}")

    def save(self, path: str) -> None:
        """Replace the graph that the path holds, whole.

        Tables go to a folder of this save's own. A manifest that names them then takes
        the place of the one before by a rename, so readers see one graph or the other, and
        a save that fails leaves the old one. Folders that the manifest does not name
        are deleted at the end.
        """
        tables = {f"{kind}/{name}": df for kind, held in (("nodes", self.nodes), ("edges", self.edges)) for name, df in held.items()}
        if not tables:
            raise ValueError("an empty graph has no session to be written by")
        version = uuid.uuid4().hex[:12]
        for name, df in tables.items():
            df.write.parquet(f"{path}/{version}/{name}")
        spark = next(iter(tables.values())).sparkSession
        whole = {"version": version, "tables": {name: df.schema.json() for name, df in tables.items()}, "ends": self.ends, "aliases": self.aliases}
        replace_text(spark, f"{path}/{MANIFEST}", json.dumps(whole))
        for name in folders(spark, path):
            if name != version:
                remove(spark, f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PropertyGraph:
        """The graph that save() has written last."""
        held = json.loads(spark.read.text(f"{path}/{MANIFEST}", wholetext=True).first()[0])
        out = cls(ends={k: [tuple(x) for x in v] for k, v in held["ends"].items()}, aliases=held["aliases"])
        for name, schema in held["tables"].items():
            kind, label = name.split("/", 1)
            getattr(out, kind)[label] = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{path}/{held['version']}/{name}")
        return out


def search_report(nodes: DataFrame, text: str, terms: DataFrame, term: str = "term") -> DataFrame:
    """term, match_count and the matched texts, sorted; terms without a match have 0."""
    wanted = terms.select(F.col(term).alias("term")).distinct()
    found = containing(nodes, text, terms, term).groupBy("term").agg(F.count(F.lit(1)).alias("match_count"), F.array_sort(F.collect_set("text")).alias("matches"))
    return wanted.join(found, "term", "left").select("term", F.coalesce("match_count", F.lit(0).cast("long")).alias("match_count"), F.coalesce("matches", F.expr("cast(array() as array<string>)")).alias("matches"))


def serialised(df: DataFrame, columns: Sequence[str] | None = None, alias: str = "record") -> DataFrame:
    """Each row as a JSON text, nested values included."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias(alias))
