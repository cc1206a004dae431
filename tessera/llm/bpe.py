"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree hold the rank of the merge that joins a symbol with
its right neighbour, next to the symbol's position, and every inner node the
smaller of its children, so the root is the leftmost merge of lowest rank. A
merge changes three leaves, each updated up to the root in logarithmic time,
until the root holds none. Words of like length are worked on together: their
trees are the rows of one array. A long word has a tree of its own.

Texts are cut as the file's normaliser and pre-tokeniser say. Supported are
files of kind BPE whose normaliser is absent or NFC, white space to a space and
lower case, and whose pre-tokeniser cuts by one regular expression and maps
bytes to the printable alphabet.

Nulls: a null text is an empty one. Empty texts have no ids. Rows are worked on
one by one, so repeated rows and ties need no rule; a text of any length is one
row, encoded whole; an empty table gives an empty result. Other columns are
untouched, but for those that have the name of a result (n_tokens, ids_sha256, ...): the result takes their place.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that a worker keeps the ids of; beyond that it forgets all and starts anew.
MEMO_WORDS = 400_000
#: Leaves up to which the trees of many words share an array, and cells of such an array.
SHARED_LEAVES, SHARED_CELLS = 256, 1 << 20
#: Pieces below which sharing an array is not worth its set-up.
FEW = 48
_NONE = np.iinfo(np.int64).max
#: Control characters that Python's split() takes for white space and the pattern's \s does not.
_NOT_SPACE = regex.compile("[\x1c-\x1f]")
#: How byte-level files without a pattern of their own cut a text (fixed value).
_BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """A vocabulary with its merges, and the ids of words met so far."""

    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("not a vocabulary of the supported kind")
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = byte_alphabet()
        self.first_id = np.array([vocab[c] for c in letters], np.int64)
        self.last_id = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.tokens = [""] * (max([*vocab.values(), *(t["id"] for t in d["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        self.size = len(self.tokens)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.rank_of = {int(k): (r, int(m)) for r, (k, m) in enumerate(zip(keys, made, strict=True))}
        kinds = [n["type"] for n in (d["normalizer"] or {}).get("normalizers", [d["normalizer"]] if d["normalizer"] else [])]
        self.compose, self.lower = "NFC" in kinds, "Lowercase" in kinds
        split = [p for p in (d["pre_tokenizer"] or {}).get("pretokenizers", [d["pre_tokenizer"]]) if p["type"] == "Split"]
        #: White space never reaches a pre-token, so texts can be cut at it first.
        self.by_space = bool(split)
        self.pattern = regex.compile(split[0]["pattern"]["Regex"] if split else _BYTE_LEVEL_PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.byte_level_decoder = (d.get("decoder") or {}).get("type") == "ByteLevel"
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.memo: dict[str, bytes] = {}

    # -- merging ---------------------------------------------------------
    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and outcome of each pair; _NONE where there is no such merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.made[at]

    def _merge_rows(self, symbols: np.ndarray, lengths: np.ndarray, leaves: int) -> list[np.ndarray]:
        """Ids of each row's first ``lengths`` symbols; one tree of ``leaves`` leaves a row."""
        n = len(symbols)
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        places = np.arange(leaves)
        after = np.broadcast_to(places + 1, (n, leaves)).copy()
        before = np.broadcast_to(places - 1, (n, leaves)).copy()

        def leaf(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
            return np.where(rank == _NONE, _NONE, np.where(rank == _NONE, 0, rank) * leaves + place)

        rank, _ = self._lookup(symbols[:, :-1], symbols[:, 1:])
        rank[places[1:] >= lengths[:, None]] = _NONE
        tree[:, leaves : 2 * leaves - 1] = leaf(rank, places[:-1])
        width = leaves
        while width > 1:
            half = width // 2
            tree[:, half:width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
            width = half

        def put(rows: np.ndarray, place: np.ndarray, value: np.ndarray | int) -> None:
            node = place + leaves
            tree[rows, node] = value
            for _ in range(leaves.bit_length() - 1):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            at = tree[rows, 1] % leaves
            right = after[rows, at]
            _, made = self._lookup(symbols[rows, at], symbols[rows, right])
            symbols[rows, at] = made
            beyond = after[rows, right]
            after[rows, at] = beyond
            symbols[rows, right] = -1
            put(rows, right, _NONE)
            inside = beyond < lengths[rows]
            reach = np.where(inside, beyond, 0)
            r, b = rows[inside], beyond[inside]
            before[r, b] = at[inside]
            rank, _ = self._lookup(made, symbols[rows, reach])
            put(rows, at, leaf(np.where(inside, rank, _NONE), at))
            left = before[rows, at]
            inside = left >= 0
            r, p = rows[inside], left[inside]
            rank, _ = self._lookup(symbols[r, p], made[inside])
            put(r, p, leaf(rank, p))
            rows = rows[tree[rows, 1] != _NONE]
        valid = (symbols >= 0) & (places < lengths[:, None])
        counts = valid.sum(axis=1)
        return np.split(symbols[valid], np.cumsum(counts)[:-1]) if n else []

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """Ids of one long sequence of symbols, by a tree of its own."""
        n = len(symbols)
        leaves = 1 << max(0, n - 1).bit_length()
        none = (1 << 62, 0)
        rank_of, size = self.rank_of, self.size
        tree = [none] * (2 * leaves)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        for i in range(n - 1):
            hit = rank_of.get(symbols[i] * size + symbols[i + 1])
            if hit:
                tree[leaves + i] = (hit[0], i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            node = i + leaves
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while tree[1] is not none and tree[1] != none:
            i = tree[1][1]
            j = after[i]
            symbols[i] = rank_of[symbols[i] * size + symbols[j]][1]
            symbols[j] = -1
            k = after[i] = after[j]
            put(j, none)
            hit = None
            if k < n:
                before[k] = i
                hit = rank_of.get(symbols[i] * size + symbols[k])
            put(i, (hit[0], i) if hit else none)
            h = before[i]
            if h >= 0:
                hit = rank_of.get(symbols[h] * size + symbols[i])
                put(h, (hit[0], h) if hit else none)
        return [s for s in symbols if s >= 0]

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece of bytes, as 64-bit integers."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        done = lengths == 0
        leaves = 2
        while leaves <= SHARED_LEAVES and len(pieces) >= FEW and not done.all():
            which = np.flatnonzero(~done & (lengths <= leaves))
            done[which] = True
            step = max(1, SHARED_CELLS // leaves)
            for lo in range(0, len(which), step):
                some = which[lo : lo + step]
                size = lengths[some]
                symbols = np.full((len(some), leaves), -1, np.int64)
                flat = np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)
                symbols[np.arange(leaves) < size[:, None]] = self.first_id[flat]
                symbols[np.arange(len(some)), size - 1] = self.last_id[flat[np.cumsum(size) - 1]]
                for i, ids in zip(some, self._merge_rows(symbols, size, leaves), strict=True):
                    out[i] = ids
            leaves *= 2
        for i in np.flatnonzero(~done):
            raw = np.frombuffer(pieces[i], np.uint8)
            out[i] = np.array(self._merge_one([*self.first_id[raw[:-1]].tolist(), int(self.last_id[raw[-1]])]), np.int64)
        return out

    # -- texts -----------------------------------------------------------
    @property
    def tiles(self) -> bool:
        """Whether the pre-tokens of a text, put together, are the text."""
        return not (self.by_space or self.compose or self.lower)

    def pretokens(self, text: str) -> Iterator[tuple[int, str]]:
        """(end, pre-token) for a vocabulary that tiles; special tokens are pre-tokens of their own."""
        at = 0
        for hit in self.specials.finditer(text) if self.specials else ():
            yield from ((m.end(), m[0]) for m in self.pattern.finditer(text, at, hit.start()))
            yield hit.end(), hit[0]
            at = hit.end()
        yield from ((m.end(), m[0]) for m in self.pattern.finditer(text, at))

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of pretokens(), all at once."""
        out, at = [], 0
        for hit in self.specials.finditer(text) if self.specials else ():
            out += self.pattern.findall(text, at, hit.start())
            out.append(hit[0])
            at = hit.end()
        return out + self.pattern.findall(text, at) if at else self.pattern.findall(text)

    def normal(self, text: str) -> str:
        """The text as the file's normaliser leaves it, up to the kind of white space."""
        if self.compose and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # each character by itself: a final capital sigma has no form of its own here
            text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        return text

    def cut(self, text: str) -> list[str]:
        """Stretches of the text that are encoded apart; each may hold several pre-tokens."""
        if self.by_space and not _NOT_SPACE.search(text):
            return text.split()
        return self.pattern.findall(self.normal(text))

    def learn(self, stretches: set[str]) -> None:
        """Put the ids of stretches, as bytes of 32-bit integers, into the memo."""
        if len(self.memo) + len(stretches) > MEMO_WORDS:
            self.memo.clear()
        names, pieces, where = list(stretches), [], []
        for s in names:
            found = self.pattern.findall(self.normal(s))
            where.append(len(found))
            pieces += [x.encode() for x in found]
        ids = self.merge(pieces)
        flat = np.concatenate(ids).astype("<u4").tobytes() if ids else b""
        ends = np.cumsum([0, *(len(x) for x in ids)]) * 4
        at = 0
        for s, k in zip(names, where, strict=True):
            self.memo[s] = flat[ends[at] : ends[at + k]]
            at += k

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        plans: list[list] = []
        for text in texts:
            plan: list = []
            at = 0
            for hit in self.specials.finditer(text) if self.specials and "<" in text else ():
                plan += [self.cut(text[at : hit.start()]), np.array([self.special[hit[0]]], "<u4").tobytes()]
                at = hit.end()
            plans.append([*plan, self.cut(text[at:] if at else text)])
        out, lo = [], 0
        while lo < len(plans):
            hi, wanted = lo, set()
            while hi < len(plans) and len(wanted) < MEMO_WORDS // 4:
                wanted.update(*(p for p in plans[hi] if isinstance(p, list)))
                hi += 1
            missing = wanted.difference(self.memo)
            if len(self.memo) + len(missing) > MEMO_WORDS:
                self.memo.clear()
                missing = wanted
            if missing:
                self.learn(missing)
            get = self.memo.__getitem__
            out += [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in plan]) for plan in plans[lo:hi]]
            lo = hi
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included: pieces with a space between, or the bytes of a byte-level file."""
        pieces = map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())
        if not self.byte_level_decoder:
            return " ".join(pieces)
        return b"".join(t.encode() if t in self.special else bytes(map(self.byte_of.__getitem__, t)) for t in pieces).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load(spec: str) -> Bpe:
    """The vocabulary of a JSON text, kept by the Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """The JSON text of a vocabulary file; the driver reads it, executors get it broadcast (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _map_texts(df: DataFrame, text: str, spec: str, fields: list[T.StructField], work: Callable[[Bpe, list[str]], list[list]]) -> DataFrame:
    """df with the fields that work gives for each text; columns of df with a field's name are replaced."""
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    source_text = "__text"
    while source_text in kept:
        source_text += "_"
    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(source_text))
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    shared = df.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shared.value)
        for whole in batches:
            lo = 0
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(whole.column(source_text)), 0), np.int64)
            total = np.cumsum(size)
            while lo < whole.num_rows:
                hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 22), "right")))
                batch = whole.slice(lo, hi - lo)
                columns = work(bpe, [t or "" for t in batch.column(source_text).to_pylist()])
                made = [pa.array(c, _arrow_type(f.dataType)) for c, f in zip(columns, fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *(f.name for f in fields)])
                lo = hi

    return source.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary()}[kind.simpleString()]


def encode(df: DataFrame, spec: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with a column of token ids of ``text``; a column of that name is replaced."""
    def work(bpe: Bpe, texts: list[str]) -> list[list]:
        return [[np.frombuffer(x, "<u4").astype(np.int64) for x in bpe.encode_batch(texts)]]

    return _map_texts(df, text, spec, [T.StructField(ids, T.ArrayType(T.LongType()))], work)


def decode(df: DataFrame, spec: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the text of the token ids in ``ids``; null ids have a null text."""
    shared = df.sparkSession.sparkContext.broadcast(spec)

    @F.pandas_udf("string")
    def text_of(column):  # noqa: ANN001, ANN202
        bpe = load(shared.value)
        return column.map(lambda x: None if x is None else bpe.decode(np.asarray(x, "<u4").tobytes()))

    return df.withColumn(text, text_of(F.col(f"`{ids}`")))


def digest(df: DataFrame, spec: str, text: str = "text", packed: str | None = None) -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256 of a round trip.

    packed names a further column, of the ids as little-endian unsigned 32-bit integers.
    """
    def work(bpe: Bpe, texts: list[str]) -> list[list]:
        ids = bpe.encode_batch(texts)
        return [
            [len(x) // 4 for x in ids],
            [hashlib.sha256(x).hexdigest() for x in ids],
            [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
            *([ids] if packed else []),
        ]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField(packed, T.BinaryType())] if packed else []
    return _map_texts(df, text, spec, fields, work)


def documents_round_trip(spark: SparkSession, documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return digest(documents.select("doc_id", "text"), read_spec(tokenizer_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
