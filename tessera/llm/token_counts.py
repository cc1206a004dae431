"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A leaf holds consecutive pre-tokens with the code points and the tokens they
have; inner nodes hold sums. An edit (a place, how many code points to remove,
what to insert) descends by code points to the leaves it touches, takes
BOUNDARY pre-tokens more to the left, and as many code points as a special token
may have, and cuts the changed text anew from there, until a cut falls on an old
boundary past the edit: from such a place on the pattern, which looks ahead only,
cuts as before. Only that region is encoded again. Its pre-tokens go to its first
leaf, the others become empty, and the sums above them are brought up to date.

Special tokens that occur in a text, or that an edit makes, are cut out first and
count as one pre-token and one token each, as the tokenizers library has them.
Trees are kept between batches of edits as tables: ``trees`` makes them, ``edited``
applies edits to them without encoding what they leave alone.

Defined cases: a vocabulary whose pre-tokens do not tile the text (one that drops
white space or changes characters) is refused; a null text is an empty one; an edit's place and length are held
within the text as the edits before it have left it; a document without edits
counts as it is; a null in an edit is 0 or an empty text; edits of no document
are ignored; repeated documents are rows of their own and each gets the edits of
its id; a text of any length is one row of pre-tokens; empty tables give no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import Bpe, load
from tessera.llm.words import chunks, text_buffer

#: Pre-tokens before an edit that are cut again; the pattern looks ahead less far than two of them.
BOUNDARY = 4
#: Edits by their order, as an array column of docs.
EDITS = "array<struct<at:bigint,removed:bigint,inserted:string>>"
STATE = "text string, chars binary, tokens binary, n_tokens long, n_reencoded long"
RESULT = "n_pretokens long, n_tokens long, n_tokens_after long, n_chars_after long, n_reencoded long"


class TokenTree:
    """Token counts of one text that is being edited."""

    def __init__(self, bpe: Bpe, pieces: list[str], counts: list[int] | None = None):
        """counts are the tokens of each piece, where they are known."""
        self.bpe = bpe
        self.reach = max(map(len, bpe.special), default=0)
        self.reencoded = 0
        self.pieces = pieces
        self.changed: dict[int, list[str]] = {}
        self.n_leaves = max(1, len(pieces))
        self.width = w = 1 << max(0, self.n_leaves - 1).bit_length()
        self.chars = self._sums(list(map(len, pieces)), w)
        self.tokens = self._sums(self._counts(pieces) if counts is None else counts, w)

    def _counts(self, pieces: list[str]) -> list[int]:
        memo, special = self.bpe.memo, self.bpe.special
        try:
            return [len(memo[p]) >> 2 for p in pieces] if special.keys().isdisjoint(pieces) else [1 if p in special else len(memo[p]) >> 2 for p in pieces]
        except KeyError:
            plain = set(pieces).difference(special)
            self.bpe.learn(plain.difference(memo))
            if missing := plain.difference(memo):  # the memo was full and has begun anew
                self.bpe.learn(missing)
            return [1 if p in special else len(memo[p]) >> 2 for p in pieces]

    def state(self) -> tuple[str, bytes, bytes]:
        """The text, and the code points and tokens of each pre-token as 32-bit integers."""
        pieces = [p for i in range(self.n_leaves) for p in self.leaf(i)]
        counts = [n for i in range(self.n_leaves) for n in ([self.tokens[i + self.width]] if i not in self.changed else self._counts(self.changed[i]))][: len(pieces)]
        return "".join(pieces), np.array(list(map(len, pieces)), "<u4").tobytes(), np.array(counts, "<u4").tobytes()

    @classmethod
    def of_state(cls, bpe: Bpe, text: str, chars: bytes, tokens: bytes) -> TokenTree:
        ends = np.cumsum(np.frombuffer(chars, "<u4").astype(np.int64)).tolist()
        return cls(bpe, [text[a:b] for a, b in zip([0, *ends], ends, strict=False)], np.frombuffer(tokens, "<u4").tolist())

    @staticmethod
    def _sums(leaves: list[int], width: int) -> list[int]:
        """The nodes of a tree over the leaves: the root at 1, the children of i at 2i and 2i + 1."""
        nodes = np.zeros(2 * width, np.int64)
        nodes[width : width + len(leaves)] = leaves
        while width > 1:
            half = width // 2
            np.add(nodes[width : 2 * width : 2], nodes[width + 1 : 2 * width : 2], out=nodes[half:width])
            width = half
        return nodes.tolist()

    def leaf(self, i: int) -> list[str]:
        """The pre-tokens of a leaf: one at first, any number after an edit."""
        if i in self.changed:
            return self.changed[i]
        return self.pieces[i : i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(p for i in range(self.n_leaves) for p in self.leaf(i))

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a code point, and where it starts; the last leaf for the text's end."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return min(node - self.width, self.n_leaves - 1), start

    def _put(self, leaf: int, pieces: list[str]) -> None:
        self.changed[leaf] = pieces
        node = leaf + self.width
        more_chars = sum(map(len, pieces)) - self.chars[node]
        more_tokens = sum(self._counts(pieces)) - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node >>= 1

    def edit(self, at: int, removed: int, inserted: str) -> None:
        at = min(max(at, 0), self.n_chars)
        removed = min(max(removed, 0), self.n_chars - at)
        if not removed and not inserted:
            return
        lo, start = self.find(at)
        more = BOUNDARY
        while lo > 0 and (more > 0 or at - start < self.reach):  # whole leaves, until enough stands before the edit
            lo -= 1
            start -= self.chars[lo + self.width]
            more -= len(self.leaf(lo))
        hi, _ = self.find(at + removed)
        while True:
            # the region up to leaf hi, as it was and as it is now
            old = [p for i in range(lo, hi + 1) for p in self.leaf(i)]
            was = "".join(old)
            now = was[: at - start] + inserted + was[at - start + removed :]
            to_end = hi == self.n_leaves - 1
            if to_end:
                new = self.bpe.pieces(now)
                break
            # old boundaries past the edit, counted from the region's end
            ends, left = {0}, len(was)
            for p in reversed(old):
                left -= len(p)
                if left < at - start + removed:
                    break
                ends.add(len(was) - left)
            tail: list[str] = []  # what the pattern may look ahead at; leaves may be empty
            for i in range(hi + 1, self.n_leaves):
                if len(tail) >= 2 * BOUNDARY and sum(map(len, tail)) >= self.reach:
                    break
                tail += self.leaf(i)
            whole, new, sync = now + "".join(tail), [], None
            for end, piece in self.bpe.pretokens(whole):
                if end > len(now):
                    break
                new.append(piece)
                if end >= at - start + len(inserted) and len(now) - end in ends:
                    sync = len(now) - end
                    break
            if sync is not None:
                kept, left = [], sync
                for p in reversed(old):
                    if left <= 0:
                        break
                    kept.append(p)
                    left -= len(p)
                self.reencoded += len(new)
                new += kept[::-1]
                self._replace(lo, hi, new)
                return
            hi = min(self.n_leaves - 1, hi + 1 + BOUNDARY)
        self.reencoded += len(new)
        self._replace(lo, hi, new)

    def _replace(self, lo: int, hi: int, pieces: list[str]) -> None:
        self._put(lo, pieces)
        for leaf in range(lo + 1, hi + 1):
            if self.leaf(leaf):
                self._put(leaf, [])


def _checked(spec: str) -> None:
    if not load(spec).tiles:
        raise ValueError("the pre-tokens of this vocabulary do not make up the text")


def _cut(bpe: Bpe, texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text, all of them in the memo: the trees of many pre-tokens share an array."""
    cut = list(map(bpe.pieces, texts))
    if new := set().union(*cut).difference(bpe.memo, bpe.special):
        bpe.learn(new)
    return cut


def _edit_all(tree: TokenTree, edits: list[dict] | None) -> None:
    for e in edits or ():
        if e is not None:
            tree.edit(e["at"] or 0, e["removed"] or 0, e["inserted"] or "")


def counts(docs: DataFrame, spec: str, edits: str = "edits", key: str = "doc_id", text: str = "text") -> DataFrame:
    """key with the counts before and after the edits, and how many pre-tokens were encoded again."""
    _checked(spec)
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    source = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), F.col(f"`{edits}`").cast(EDITS).alias("__edits"))
    schema = T.StructType([T.StructField("__key", docs.schema[key].dataType), *T.StructType.fromDDL(RESULT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        for batch in batches:
            out: list[tuple] = []
            _, offsets = text_buffer(batch.column("__text"))
            for lo, hi in chunks(offsets):
                cut = _cut(bpe, [t.as_py() or "" for t in batch.column("__text")[lo:hi]])
                for pieces, es in zip(cut, batch.column("__edits")[lo:hi], strict=True):
                    tree = TokenTree(bpe, pieces)
                    before = (len(pieces), tree.n_tokens)
                    _edit_all(tree, es.as_py())
                    out.append((*before, tree.n_tokens, tree.n_chars, tree.reencoded))
            cols = [pa.array([r[j] for r in out], pa.int64()) for j in range(5)]
            yield pa.RecordBatch.from_arrays([batch.column("__key"), *cols], names=["__key", "n_pretokens", "n_tokens", "n_tokens_after", "n_chars_after", "n_reencoded"])

    return source.mapInArrow(run, schema).withColumnRenamed("__key", key)


def trees(docs: DataFrame, spec: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the tree of each document: text, chars and tokens (packed, of each pre-token), and n_tokens."""
    _checked(spec)
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    source = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([T.StructField("__key", docs.schema[key].dataType), *T.StructType.fromDDL(STATE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        for batch in batches:
            _, offsets = text_buffer(batch.column("__text"))
            for lo, hi in chunks(offsets):
                made = [TokenTree(bpe, pieces) for pieces in _cut(bpe, [t.as_py() or "" for t in batch.column("__text")[lo:hi]])]
                yield _packed(batch.column("__key")[lo:hi], made)

    return source.mapInArrow(run, schema).withColumnRenamed("__key", key)


def edited(kept: DataFrame, spec: str, edits: str = "edits", key: str = "doc_id") -> DataFrame:
    """The trees of ``trees`` after the edits in a column of theirs, in the same form, and n_reencoded; what no edit touches is not encoded."""
    _checked(spec)
    shared = kept.sparkSession.sparkContext.broadcast(spec)
    source = kept.select(F.col(f"`{key}`").alias("__key"), F.col("text").alias("__text"), "chars", "tokens", F.col(f"`{edits}`").cast(EDITS).alias("__edits"))
    schema = T.StructType([T.StructField("__key", kept.schema[key].dataType), *T.StructType.fromDDL(STATE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        for batch in batches:
            _, offsets = text_buffer(batch.column("__text"))
            for lo, hi in chunks(offsets):
                made = []
                for t, c, n, es in zip(*(batch.column(x)[lo:hi].to_pylist() for x in ("__text", "chars", "tokens", "__edits")), strict=True):
                    made.append(tree := TokenTree.of_state(bpe, t or "", c or b"", n or b""))
                    _edit_all(tree, es)
                yield _packed(batch.column("__key")[lo:hi], made)

    return source.mapInArrow(run, schema).withColumnRenamed("__key", key)


def _packed(keys: pa.Array, made: list[TokenTree]) -> pa.RecordBatch:
    states = [t.state() for t in made]
    cols = [pa.array([s[j] for s in states], k) for j, k in enumerate((pa.string(), pa.binary(), pa.binary()))]
    return pa.RecordBatch.from_arrays([keys, *cols, pa.array([t.n_tokens for t in made], pa.int64()), pa.array([t.reencoded for t in made], pa.int64())], names=["__key", "text", "chars", "tokens", "n_tokens", "n_reencoded"])


def revisions(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with an edits column as a redaction pass makes it: a notice put first, a stretch removed, a word replaced, a line added."""
    size = F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long")

    def edit(at, removed: int, inserted: str):  # noqa: ANN001, ANN202
        return F.struct(at.cast("long").alias("at"), F.lit(removed).cast("long").alias("removed"), F.lit(inserted).alias("inserted"))

    return docs.withColumn("edits", F.array(edit(F.lit(0), 0, "Revised copy. "), edit(F.floor(size / 4), 24, ""), edit(F.floor(size / 2), 7, " it's [redacted]  "), edit(size, 0, "\nEnd of file")))


def document_counts(docs: DataFrame, spec: str) -> DataFrame:
    """Counts of every document before and after its revisions."""
    return counts(revisions(docs.select("doc_id", "text")), spec)
