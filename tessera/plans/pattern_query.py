"""A read-only subset of Cypher over a PropertyGraph, turned into joins, and questions turned into it by a pluggable translator.

Accepted: UNWIND $list AS x; MATCH and OPTIONAL MATCH with labels, {property: value},
edges of one or any type, in one direction or either, of one hop, several, or a
range of lengths (*1..3, walks that use no edge twice), comma-separated patterns; WHERE with =, <>,
<, <=, >, >=, CONTAINS, toLower, AND, OR, NOT, IS NULL; RETURN [DISTINCT] with
aliases and count(*); ORDER BY; LIMIT; UNION [ALL]. Anything that writes is refused.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph import PropertyGraph

_TOKEN = re.compile(r"\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<range>\.\.)|(?P<number>\d+(?:\.\d+)?)|(?P<word>[A-Za-z_$][A-Za-z0-9_]*)|(?P<sign>->|<-|<>|<=|>=|[-\[\](){}.,:=<>*|]))")
_WRITES = {"CREATE", "MERGE", "DELETE", "DETACH", "SET", "REMOVE", "DROP", "LOAD", "CALL", "FOREACH"}
_CLAUSES = {"MATCH", "WHERE", "RETURN", "ORDER", "LIMIT", "UNION", "UNWIND"}


class QueryError(ValueError):
    """The text is not in the accepted subset."""


def tokens(text: str) -> list[str]:
    out, at = [], 0
    text = text.strip().rstrip(";").rstrip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise QueryError(f"unexpected text: {text[at : at + 30]!r}")
        out.append(m[0].strip())
        at = m.end()
    if bad := {t.upper() for t in out if t.upper() in _WRITES}:
        raise QueryError(f"read-only: {', '.join(sorted(bad))} is refused")
    return out


class _Reader:
    def __init__(self, items: list[str]):
        self.items, self.at = items, 0

    def peek(self, ahead: int = 0) -> str:
        return self.items[self.at + ahead] if self.at + ahead < len(self.items) else ""

    def next(self) -> str:
        self.at += 1
        return self.items[self.at - 1] if self.at <= len(self.items) else ""

    def word(self, *words: str) -> bool:
        if self.peek().upper() == words[0] and all(self.peek(i).upper() == w for i, w in enumerate(words)):
            self.at += len(words)
            return True
        return False

    def need(self, sign: str) -> None:
        if self.next().upper() != sign:
            raise QueryError(f"{sign} expected near {' '.join(self.items[max(0, self.at - 4) : self.at + 1])}")


class _Query:
    """One part between UNIONs."""

    def __init__(self, graph: PropertyGraph, reader: _Reader, params: dict[str, Any]):
        self.graph, self.r, self.params = graph, reader, params
        self.frame: DataFrame | None = None
        self.bound: dict[str, str] = {}  # variable -> label, "" for an edge, "*" for a value
        self.known: dict[str, str] = {}  # variables of the query around this one
        self.names = 0

    # values and conditions
    def value(self) -> Column:
        t = self.r.next()
        if not t:
            raise QueryError("a value is expected")
        if t[:1] in "'\"":
            return F.lit(re.sub(r"\\(.)", r"\1", t[1:-1]))
        if t[:1].isdigit():
            return F.lit(float(t) if "." in t else int(t))
        if t[:1] == "$":
            if t[1:] not in self.params:
                raise QueryError(f"no parameter {t}")
            return F.lit(self.params[t[1:]])
        if t.upper() in ("TRUE", "FALSE", "NULL"):
            return F.lit({"TRUE": True, "FALSE": False, "NULL": None}[t.upper()])
        if self.r.peek() == "(":
            self.r.next()
            if t.lower() == "count":
                distinct = self.r.word("DISTINCT")
                inner = F.lit(1) if self.r.peek() == "*" and self.r.next() else self.expression()
                self.r.need(")")
                return F.count_distinct(inner) if distinct else F.count(inner)
            inner = self.expression()
            self.r.need(")")
            known = {"tolower": F.lower, "toupper": F.upper, "trim": F.trim, "tostring": lambda c: c.cast("string"), "tointeger": lambda c: c.try_cast("bigint"), "tofloat": lambda c: c.try_cast("double"), "size": F.length}
            if t.lower() not in known:
                raise QueryError(f"unknown function {t}")
            return known[t.lower()](inner)
        if t not in self.bound:
            raise QueryError(f"unknown name {t}")
        if self.r.peek() == ".":
            self.r.next()
            return F.col(f"`{t}`").getField(self.r.next())
        return F.col(f"`{t}`")

    def expression(self) -> Column:
        left = self.value()
        if self.r.word("CONTAINS"):
            return left.contains(self.value())
        if self.r.word("STARTS", "WITH"):
            return left.startswith(self.value())
        if self.r.word("IS", "NOT", "NULL"):
            return left.isNotNull()
        if self.r.word("IS", "NULL"):
            return left.isNull()
        sign = self.r.peek()
        compare: dict[str, Callable[[Column, Column], Column]] = {"=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}
        if sign in compare:
            self.r.next()
            return compare[sign](left, self.value())
        return left

    def condition(self) -> Column:
        left = self.conjunction()
        while self.r.word("OR"):
            left = left | self.conjunction()
        return left

    def conjunction(self) -> Column:
        left = self.negation()
        while self.r.word("AND"):
            left = left & self.negation()
        return left

    def negation(self) -> Column:
        if self.r.word("NOT"):
            return ~self.negation()
        if self.r.peek() == "(":
            self.r.next()
            inner = self.condition()
            self.r.need(")")
            return inner
        return self.expression()

    # patterns
    def properties(self) -> list[tuple[str, Column]]:
        out = []
        if self.r.peek() == "{":
            self.r.next()
            while True:
                name = self.r.next()
                self.r.need(":")
                out.append((name, self.value()))
                if self.r.next() != ",":
                    break
        return out

    def fresh(self) -> str:
        self.names += 1
        return f"__v{self.names}"

    def node(self) -> tuple[str, str, list[tuple[str, Column]]]:
        self.r.need("(")
        name = self.r.next() if self.r.peek() not in (":", ")", "{") else self.fresh()
        label = ""
        if self.r.peek() == ":":
            self.r.next()
            label = self.r.next()
        props = self.properties()
        self.r.need(")")
        return name, label or self.bound.get(name, "") or self.known.get(name, ""), props

    def edge(self) -> tuple[str, str, str, list[tuple[str, Column]], tuple[int, int] | None]:
        """Name, type, direction (out, in or both), properties and, for a walk, its least and greatest length."""
        back = self.r.peek() == "<-"
        if self.r.next() not in ("-", "<-", "->"):
            raise QueryError("an edge is expected")
        name, kind, props, lengths = self.fresh(), "", [], None
        if self.r.items[self.r.at - 1] == "->":
            return name, kind, "out", props, lengths
        if self.r.peek() == "[":
            self.r.next()
            if self.r.peek() not in (":", "]", "{"):
                name = self.r.next()
            if self.r.peek() == ":":
                self.r.next()
                kind = self.r.next()
            if self.r.peek() == "*":
                lengths = self.lengths()
            props = self.properties()
            self.r.need("]")
        closing = self.r.next()
        if closing not in (("-",) if back else ("-", "->")):
            raise QueryError("edges have one direction")
        if lengths is not None and props:
            raise QueryError("walks have no properties")
        return name, kind, "in" if back else "out" if closing == "->" else "both", props, lengths

    def lengths(self) -> tuple[int, int]:
        """*n, *a..b or *..b: a walk needs a greatest length."""
        self.r.need("*")
        least = int(self.r.next()) if self.r.peek().isdigit() else 1
        if self.r.peek() != "..":
            if not self.r.items[self.r.at - 1].isdigit():
                raise QueryError("a walk needs a greatest length")
            return least, least
        self.r.next()
        if not self.r.peek().isdigit():
            raise QueryError("a walk needs a greatest length")
        return least, int(self.r.next())

    def struct(self, df: DataFrame, name: str, props: list[tuple[str, Column]]) -> DataFrame:
        for p, v in props:
            df = df.filter(F.col(f"`{p}`") == v)
        return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))

    def join(self, df: DataFrame, on: Column | None) -> None:
        self.frame = df if self.frame is None else self.frame.join(df, on) if on is not None else self.frame.crossJoin(df)

    def bind_node(self, name: str, label: str, props: list[tuple[str, Column]], on: Callable[[str], Column] | None) -> None:
        if name in self.bound:
            if on is not None:
                self.frame = self.frame.filter(on(name))
            for p, v in props:
                self.frame = self.frame.filter(F.col(f"`{name}`").getField(p) == v)
            return
        self.join(self.struct(self.graph.label(label), name, props), on(name) if on is not None else None)
        self.bound[name] = label

    def kinds(self, kind: str, left: str, right: str) -> list[tuple[str, str, str]]:
        """(type, source label, target label) that the pattern may mean."""
        name = lambda x: self.graph.aliases.get(x, x)
        wanted = [name(kind)] if kind else list(self.graph.edges)
        ends = [(k, a, b) for k in wanted for a, b in self.graph.ends.get(k, [])]
        return [(k, a, b) for k, a, b in ends if (not left or name(left) == a) and (not right or name(right) == b)]

    def match(self) -> None:
        while True:
            name, label, props = self.node()
            pending = (name, label, props)
            while self.r.peek() in ("-", "<-", "->"):
                edge, kind, way, edge_props, lengths = self.edge()
                other, other_label, other_props = self.node()
                ends = {"out": (pending[1], other_label), "in": (other_label, pending[1])}
                found = [f for d in (("out", "in") if way == "both" else (way,)) for f in self.kinds(kind, *(ends[d] if lengths is None else ("", "")))]
                found = list(dict.fromkeys(found))
                if not found:
                    raise QueryError(f"no edge {kind or 'of any type'} between {pending[1] or 'any'} and {other_label or 'any'}")
                near = {f[1 if d == "out" else 2] for f in found for d in (("out", "in") if way == "both" else (way,))}
                far = {f[2 if d == "out" else 1] for f in found for d in (("out", "in") if way == "both" else (way,))}
                if not pending[1] and len(near) > 1 or not other_label and len(far) > 1:
                    raise QueryError("give the labels of the nodes: several would fit")
                self.bind_node(pending[0], pending[1] or near.pop(), pending[2], None)
                self.walk(edge, edge_props, found, way, lengths, pending[0])
                there = other_label or far.pop()
                self.bind_node(other, there, other_props, lambda n, e=edge: F.col(f"`__to_{e}`") == F.col(f"`{n}`.id"))
                pending = (other, there, [])
            if pending[0] not in self.bound:
                if not pending[1]:
                    raise QueryError("a node needs a label")
                self.bind_node(*pending, None)
            if self.r.peek() != ",":
                return
            self.r.next()

    def walk(self, edge: str, props: list[tuple[str, Column]], kinds: list[tuple[str, str, str]], way: str, lengths: tuple[int, int] | None, at: str) -> None:
        """Bind an edge, or a walk (whose length it has), that leaves a bound node; columns of their own hold its ends as it is walked."""
        if lengths is not None:
            starts = self.frame.select(F.col(f"`{at}`.id").alias("id"))
            df = self.graph.paths(starts, kinds, *lengths, direction=way).select(F.col("a").alias("__from"), F.col("b").alias("__to"), "length")
        else:
            whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.graph.edges[k].filter((F.col("src_label") == a) & (F.col("dst_label") == b)).withColumn("type", F.lit(k)) for k, a, b in kinds])
            out, back = (whole.withColumns({"__from": F.col(x), "__to": F.col(y)}) for x, y in (("src", "dst"), ("dst", "src")))
            df = out if way == "out" else back if way == "in" else out.unionByName(back.filter("src <> dst"))
        for p, v in props:
            df = df.filter(F.col(f"`{p}`") == v)
        df = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("__from", "__to")]).alias(edge), F.col("__from").alias(f"__from_{edge}"), F.col("__to").alias(f"__to_{edge}"))
        self.join(df, F.col(f"`{at}`.id") == F.col(f"`__from_{edge}`"))
        self.bound[edge] = ""

    def optional(self) -> None:
        """Keep every row, with what the pattern finds for its nodes, or nulls; a WHERE after it is part of the pattern."""
        inner = _Query(self.graph, self.r, self.params)
        inner.names = self.names
        before, self.names = dict(self.bound), self.names + 1000
        inner.bound = {}
        inner.known = before
        inner.match()
        if self.r.word("WHERE"):
            inner.frame = inner.frame.filter(inner.condition())
        shared = [n for n in inner.bound if n in before]
        if not shared:
            raise QueryError("OPTIONAL MATCH begins at a node that is known")
        right = inner.frame.select(*[F.col(f"`{n}`").alias(f"__o_{n}") if n in shared else F.col(f"`{n}`") for n in inner.bound])
        on = reduce(lambda x, y: x & y, [F.col(f"`{n}`.id") == F.col(f"`__o_{n}`.id") for n in shared])
        self.frame = self.frame.join(right, on, "left").drop(*[f"__o_{n}" for n in shared])
        self.bound |= {n: v for n, v in inner.bound.items() if n not in shared}

    def unwind(self) -> None:
        given = self.r.next()
        self.r.need("AS")
        name = self.r.next()
        if given[:1] != "$" or given[1:] not in self.params:
            raise QueryError("UNWIND takes a parameter")
        df = self.graph_session().createDataFrame([(x,) for x in self.params[given[1:]]], f"`{name}` string")
        self.join(df, None)
        self.bound[name] = "*"

    def graph_session(self):  # noqa: ANN201
        return next(iter(self.graph.nodes.values())).sparkSession

    def run(self) -> DataFrame:
        while True:
            if self.r.word("UNWIND"):
                self.unwind()
            elif self.frame is not None and self.r.word("OPTIONAL", "MATCH"):
                self.optional()
            elif self.r.word("MATCH"):
                self.match()
            elif self.frame is not None and self.r.word("WHERE"):
                self.frame = self.frame.filter(self.condition())
            elif self.r.word("RETURN"):
                return self.returned()
            else:
                raise QueryError(f"unexpected {self.r.peek() or 'end'}")

    def returned(self) -> DataFrame:
        if self.frame is None:
            raise QueryError("RETURN without MATCH")
        distinct = self.r.word("DISTINCT")
        items: list[tuple[Column, str, bool]] = []
        while True:
            start = self.r.at
            c = self.expression()
            text = "".join(self.r.items[start : self.r.at])
            name = self.r.next() if self.r.word("AS") else text
            items.append((c, name, text.lower().startswith("count(")))
            if self.r.peek() != ",":
                break
            self.r.next()
        if any(agg for *_, agg in items):
            out = self.frame.groupBy(*[c.alias(n) for c, n, agg in items if not agg]).agg(*[c.alias(n) for c, n, agg in items if agg]).select(*[f"`{n}`" for _, n, _ in items])
        else:
            out = self.frame.select(*[c.alias(n) for c, n, _ in items])
        out = out.distinct() if distinct else out
        if self.r.word("ORDER", "BY"):
            by = []
            while True:
                start = self.r.at
                name = self.r.next()
                while self.r.peek() == ".":
                    name += self.r.next() + self.r.next()
                if name not in out.columns:
                    raise QueryError(f"ORDER BY {name}: not returned ({' '.join(self.r.items[start : self.r.at])})")
                c = F.col(f"`{name}`")
                by.append(c.desc_nulls_first() if self.r.word("DESC") else c.asc_nulls_last())
                self.r.word("ASC")
                if self.r.peek() != ",":
                    break
                self.r.next()
            out = out.orderBy(*by)
        if self.r.word("LIMIT"):
            out = out.limit(int(self.r.next()))
        return out


def run_query(graph: PropertyGraph, text: str, params: dict[str, Any] | None = None) -> DataFrame:
    """The result of a read-only query over the graph."""
    reader = _Reader(tokens(text))
    out = None
    every = True
    while True:
        part = _Query(graph, reader, params or {}).run()
        out = part if out is None else out.unionByName(part)
        if not every:
            out = out.distinct()
        if not reader.peek():
            return out
        reader.need("UNION")
        every = reader.word("ALL")


def strip_fence(text: str) -> str:
    """A translator's answer without the Markdown fence around it."""
    m = re.fullmatch(r"\s*```[A-Za-z]*\s*\n?(.*?)```\s*", text, re.S)
    return (m[1] if m else text).strip()


def ask(graph: PropertyGraph, question: str, translate: Callable[[str, str], str], params: dict[str, Any] | None = None) -> DataFrame:
    """Answer a question: translate(question, schema) gives a query, which is run if it only reads."""
    return run_query(graph, strip_fence(translate(question, describe(graph))), params)


def describe(graph: PropertyGraph) -> str:
    """Labels with their properties, and edge types with their ends."""
    lines = [f"({label} {{{', '.join(df.columns)}}})" for label, df in graph.nodes.items()]
    lines += [f"({a})-[:{kind} {{{', '.join(c for c in graph.edges[kind].columns if c not in ('src', 'dst', 'src_label', 'dst_label'))}}}]->({b})" for kind, ends in graph.ends.items() for a, b in ends]
    return "\n".join(lines)
