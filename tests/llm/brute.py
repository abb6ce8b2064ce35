"""Plain single-machine versions of the operators, for small tables."""

import hashlib
import re

import xxhash

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def contamination(docs, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256)}"""
    phrases = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(p) for p in phrases}
    out = {}
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                got = phrases.get(tuple(w[i : i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        names = sorted(str(x) for x in found if x is not None)
        out[doc] = (len(w), len(hit), len(names), sha(",".join(names)))
    return out


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def repeated(docs, length=50):
    """[(doc_id, n_bytes, n_removed, n_spans, sha of the rest)], sorted; docs are (id, text)."""
    last = (1 << 63) - 1
    raw = [((last if d is None else d), d, (t or "").encode()) for d, t in docs]
    least = {}
    for key, _, b in raw:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            least[s] = min(least.get(s, last), key)
    out = []
    for key, d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return sorted(out, key=str)


def simhash(text, n=4):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + n]), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def components(fps, bits=4):
    """Smallest index reachable from each index."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def kept_lines(docs, most=2, least_length=20):
    """Texts after line de-duplication; docs are (id, text) without equal rows."""
    order = sorted((d for d in docs if d[1] is not None), key=lambda d: ((1 << 63) - 1 if d[0] is None else d[0], hashlib.md5(d[1].encode()).digest()))
    seen, out = [], {}
    for row, text in ((r, r[1]) for r in order):
        kept = []
        for line in text.split("\n"):
            if not line.strip(" \t\r\v\f"):
                kept.append(line)
                continue
            if line in seen:
                continue
            near = len(line) >= least_length and any(len(s) >= least_length and abs(len(s) - len(line)) <= most and edits(s, line) <= most for s in seen)
            seen.append(line)
            if not near:
                kept.append(line)
        out[row] = "\n".join(kept)
    return [None if t is None else out[i, t] for i, t in docs]


WORDS = "the of and stream over night river stone cold light paper glass winter summer green token years found".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ñ"]) for _ in range(n))


def shingles(text, n=5):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def similar_components(texts, n=5, tenths=8):
    """Smallest index reachable from each index by Jaccard similarity of at least ``tenths`` / 10; empty sets are equal."""
    sets = [shingles(t, n) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= tenths * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]
