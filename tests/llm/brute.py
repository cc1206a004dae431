"""Plain-Python versions of what the operators return, for small inputs only."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"


def words(text: str | None) -> list[str]:
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, k: int = 5) -> frozenset:
    ws = [ascii_lower(w) for w in words(text)]
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1)))


def components(links: list[tuple], nodes: list) -> dict:
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def jaccard_components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest linked doc_id), by an inverted index of every shingle."""
    sets = {d: shingles(t) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    common: Counter = Counter()
    links = []
    same = defaultdict(list)
    for d, s in sets.items():
        if s:
            same[s].append(d)
    first = {s: min(ds) for s, ds in same.items()}
    for ds in same.values():
        links += [(ds[0], d) for d in ds]
    leads = set(first.values())
    for ds in by.values():
        ds = [d for d in ds if d in leads]
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    links += [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    top = components(links, list(sets))
    return {d: (len(s), top[d]) for d, s in sets.items()}


ASSIGN = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
USER = re.compile(r"(?:[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt](?:_?[Ii][Dd])?)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@+-]{3,}")


def secrets(text: str | None, scope: int = 200) -> dict:
    t = text or ""
    base = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 6]
    base += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    base += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    weak = [("user", m.start(), m.end()) for m in USER.finditer(t)]
    weak += [("blob", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/]{40,}", t) if all(re.search(p, m[0]) for p in ("[0-9]", "[A-Z]", "[a-z]"))]
    weak += [("endpoint", m.start(), m.end()) for m in re.finditer(r"https?://[A-Za-z0-9.-]+[A-Za-z0-9/_.:-]*", t)]
    role = {"assign": "s", "hex": "s", "blob": "s", "access": "i", "user": "i", "endpoint": "e"}
    parts = base + weak

    def near(x, r):
        return any(role[k] == r and abs(s - x[1]) <= scope for k, s, _ in parts)

    def nearest(at, r):
        return min((s for k, s, _ in parts if role[k] == r), key=lambda s: (abs(s - at), s))

    needs = {"s": "i", "i": "s", "e": "is"}
    linked = [x for x in weak if all(near(x, r) for r in needs[role[x[0]]])]
    kinds = list(role)
    order = {k: i for i, k in enumerate(("assign", "access", "hex", "user", "blob", "endpoint"))}
    assert set(kinds) == set(order)
    shown = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(xs, key=lambda x: (x[1], order[x[0]])))
    n = Counter(k for k, _, _ in base)
    return {"n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"], "base_sha256": hashlib.sha256(shown(base).encode()).hexdigest(), "spans": shown(base + linked), "n_linked": len(linked), "links": ",".join(f"{k}:{s}:{nearest(s, 'i')}:{nearest(s, 's')}" for k, s, _ in sorted(linked, key=lambda x: (x[1], order[x[0]])))}


def warc(pages: list[tuple], min_bytes: int = 0) -> list[tuple]:
    largest: dict[bytes, int] = {}
    for page, _, html in pages:
        b = (html or "").encode()
        if page is not None:
            largest[b] = max(largest.get(b, page), page)
    out = []
    for page, _, html in pages:
        b = (html or "").encode()
        keep = largest.get(b) if len(b) >= min_bytes else None
        revisit = keep is not None and page != keep
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", keep if revisit else None))
    return out


def quality_counts(text: str | None, k: int = 5) -> dict:
    t, ws = text or "", words(text)
    grams = [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(k)}
    lines = [x for x in t.split("\n") if x.strip(SPACE)]
    out = {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    return out | {"base_failed": len(ws) < 10 or 100 * len(covered) > 20 * len(ws)}


def quality(docs: list[tuple], reach: float = 3.0, least: int = 20) -> list[dict]:
    """(text, lang, source) rows -> counts and verdicts, by exact quartiles."""
    floors = {"symbols": 0.1, "dup_lines": 0.1, "repeats": 0.05, "word_length": 2.0}
    rows = [quality_counts(t) | {"lang": g, "source": s} for t, g, s in docs]
    for r in rows:
        n = r["n_words"]
        r["m"] = {"symbols": r["n_symbols"] / n, "dup_lines": r["n_dup_lines"] / n, "repeats": r["n_repeat_words"] / n, "word_length": r["word_chars"] / n} if n else {}

    def quartile(xs, q):
        xs = sorted(xs)
        return xs[max(1, math.ceil(q * len(xs))) - 1]

    for r in rows:
        group = [x for x in rows if (x["lang"], x["source"]) == (r["lang"], r["source"])]
        if len(group) < least:
            group = [x for x in rows if x["lang"] == r["lang"]]
        if len(group) < least:
            group = rows
        ok = not r["base_failed"]
        for m, v in r["m"].items():
            xs = [x["m"][m] for x in group if x["m"]]
            q1, q3 = quartile(xs, 0.25), quartile(xs, 0.75)
            spread = max(q3 - q1, floors[m]) * reach
            ok &= q1 - spread <= v <= q3 + spread
        r["kept"] = ok
    return rows


def line_tokens(line: str) -> frozenset:
    return frozenset(words(line.lower()))


def line_removals(docs: list[tuple], percent: int = 80) -> list[set[int]]:
    """Places of removed lines of each (doc_id, text), ids distinct and in order."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    out: list[set[int]] = [set() for _ in docs]
    by: dict = defaultdict(list)
    seen: set[str] = set()
    sets: list[frozenset] = []
    for i in order:
        if docs[i][1] is None:
            continue
        for p, line in enumerate(docs[i][1].split("\n")):
            if not words(line):
                continue
            if line in seen:
                out[i].add(p)
                continue
            seen.add(line)
            s = line_tokens(line)
            common = Counter(j for t in s for j in by[t])
            if any(100 * n >= percent * (len(s) + len(sets[j]) - n) for j, n in common.items()):
                out[i].add(p)
            for t in s:
                by[t].append(len(sets))
            sets.append(s)
    return out


def repeats(docs: list[tuple], least: int = 50) -> list[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
    """Repeated spans, and those that an earlier text has, of each (doc_id, text) with distinct ids in order."""
    seqs = [[ascii_lower(w) for w in words(t)] for _, t in docs]
    where = defaultdict(set)
    for i, s in enumerate(seqs):
        for p in range(len(s) - least + 1):
            where[tuple(s[p : p + least])].add(i)
    out = []
    for i, s in enumerate(seqs):
        got: tuple[list, list] = ([], [])
        for p in range(len(s) - least + 1):
            w = where[tuple(s[p : p + least])]
            for k, hit in enumerate((len(w) > 1, min(w) < i)):
                if hit:
                    if got[k] and p <= got[k][-1][1]:
                        got[k][-1] = (got[k][-1][0], p + least)
                    else:
                        got[k].append((p, p + least))
        out.append(got)
    return out


def distance(a: str, b: str) -> int:
    """Edits between two texts."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def audit(docs: list[tuple], labels: list[tuple]) -> dict[tuple, tuple]:
    """(part, order, step) -> kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, by applying every order to every document."""
    from itertools import permutations

    good, toxic = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    rows = defaultdict(list)
    for d, t, _, source, *_ in docs:
        t = t or ""
        w = words(t)
        fails = {c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t),
            d is not None and any(e is not None and e < d and (u or "") == t for e, u, *_ in docs),
        ), strict=True) if bad}
        rows[source or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, held in rows.items():
        whole: Counter = Counter()
        for order in permutations("ABCDE"):
            left = held
            for k, c in enumerate(order, 1):
                here = [x for x in left if c in x[0]]
                left = [x for x in left if c not in x[0]]
                whole[c] += len(here)
                fails = sum(c in x[0] for x in held)
                out[part, "".join(order), k] = (len(left), len(here), fails - len(here), sum(x[0] == {c} for x in held), sum(x[1] for x in here), sum(x[2] for x in here))
        for key, v in list(out.items()):
            if key[0] == part:
                out[key] = (*v, whole[key[1][key[2] - 1]])
    return out


def terms(text: str | None) -> list[str]:
    return re.findall("[0-9A-Za-z\x80-\U0010ffff]+", ascii_lower(text or ""))


def ranked(docs: list[tuple], items: list[tuple], k: int = 20) -> set[tuple]:
    """(item_id, rank, doc_id, score) of the best documents, each document scored by itself."""
    held = [(d, Counter(terms(t))) for d, t, *_ in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total, df = len(held), sum(x[2] for x in held), Counter(t for _, c, _ in held for t in c)
    out = set()
    for i, text in items:
        scored = []
        for d, c, size in held:
            m = 75 + 25 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out |= {(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)}
    return out


def simhash(text: str | None) -> int:
    import xxhash

    ws = [ascii_lower(w) for w in words(text)]
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 3]).encode(), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) by comparing all pairs of fingerprints."""
    fps = [simhash(t) for _, t, *_ in docs]
    kinds = sorted(set(fps))
    top = components([(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :] if (a ^ b).bit_count() <= 3], kinds)
    least: dict = {}
    for (d, *_), fp in zip(docs, fps, strict=True):
        if d is not None:
            least[top[fp]] = min(least.get(top[fp], d), d)
    return [(d, f"{fp:016x}", least.get(top[fp])) for (d, *_), fp in zip(docs, fps, strict=True)]
