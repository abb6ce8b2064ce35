"""Collocations, source divergence and embedding near duplicates against brute force."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from brightloom.llm import collocations, divergence, flatgraph, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations ----------------------------------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        several = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        for p, a in several.items():
            inside = [q for q in several if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * several[q] >= 100 * a]
            if not inside:
                best = min((1000 * a * total[lang] // (f[p[:j]] * f[p[j:]]), j) for j in range(1, len(p)))
                found.append((best[0], a, " ".join(p), f[p[: best[1]]], f[p[best[1] :]]))
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, l, r, total[lang], s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def _phrases(seed, n=400):
    rng = random.Random(seed)
    stock = ["New York City", "as well as", "is", "a a a", "the END", "état-major", "x", "of", "to. be", "long; run", "snow\tball", "\u0085odd", "ſ K", "日本 語"]
    return [(rng.choice(["en", "de", None]), rng.choice([None, "", " "]) if rng.random() < 0.05 else " ".join(rng.choices(stock, k=rng.randint(0, 12)))) for _ in range(n)]


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_collocations_equal_brute_force(spark, most):
    rows = _phrases(3)
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, n long, phrase string")
    got = sorted(tuple(r) for r in collocations.collocations(docs, min_count=20, top=12, max_phrases=most).collect())
    assert got == brute_collocations(rows, 20, 12) and len(got) > 20


def test_collocations_of_little_text(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    alone = spark.createDataFrame([("en", "word " * 300), ("en", None)], "lang string, text string")
    rows = {r.phrase: r for r in collocations.collocations(alone).collect()}
    assert set(rows) == {"word word", "word word word", "word word word word", "word word word word word"}
    assert rows["word word"].a == 299 and rows["word word"].n == 300


def test_long_texts_are_cut_between_words(spark):
    text = ("alpha beta, gamma " * 80_000) + "x" * 1_500_000 + " alpha beta"
    got = {r.phrase: r.a for r in collocations.collocations(spark.createDataFrame([("en", text)], "lang string, text string")).collect()}
    assert got == {"alpha beta": 80_001, "gamma alpha beta": 79_999}


def test_scores_pass_64_bits(spark):
    frequent = spark.createDataFrame([("en", 1, "a", 9 * 10**12), ("en", 1, "b", 8 * 10**12), ("en", 2, "a b", 7 * 10**12)], "lang string, k int, phrase string, n long")
    totals = spark.createDataFrame([("en", 10**17 + 7)], "lang string, n long")
    row = collocations.score(frequent, totals).first()
    assert row.score == 1000 * 7 * 10**12 * (10**17 + 7) // (72 * 10**24)


def test_trie_holds_its_phrases_and_no_others():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    phrases = sorted({(rng.choice(["en", "fr"]), " ".join(rng.choices(words, k=3))) for _ in range(3000)})
    trie = collocations.PhraseTrie(*(pa.chunked_array([list(x)]) for x in zip(*phrases)))
    text = rng.choices([*words, "other", "\xff"], k=20_000)
    for lang in ("en", "fr", "de"):
        number = {p: i for i, (name, p) in enumerate(phrases) if name == lang}
        codes = trie.encode([[w.encode("latin1") for w in text]])
        want = [number.get(" ".join(text[i : i + 3]), -1) for i in range(len(text))]
        assert trie.accepted(codes, lang).tolist() == want


# --- divergence ------------------------------------------------------------------------------------


def brute_divergence(rows, min_docs, top):
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        count[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        names = sorted(s for name, s in groups if name == lang)
        whole = Counter()
        for s in names:
            whole.update(count[lang, s])

        def price(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: price(count[lang, s]) for s in names}, price(whole)
        away = lambda x, y: (x - y) ** 2 // (x + y)
        for s in names:
            pairs = sorted(((-sum(away(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in names if o != s))
            terms = sorted((-away(p[s][t], q[t]), t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, name, -v, i + 1) for i, (v, _, name) in enumerate(found)]
    return sorted(out)


def _sourced(seed, n=300, sources=7):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "cé", "日本", "zz") for b in "abcdefgh"]
    rows = []
    for _ in range(n):
        source = rng.choice([None, "", *[f"s{i}" for i in range(sources)]])
        mine = words[: 8 + 3 * len(source or "")] if rng.random() < 0.6 else words[int((source or "s0")[-1]) % 8 :: 3] if source else words
        rows.append((rng.choice(["en", "en", "de", None]), source, None if rng.random() < 0.05 else "1 ".join(rng.choices(mine, k=rng.randint(0, 30)))))
    return rows + [("xx", "a", "1 2 3"), ("xx", "b", None), ("yy", None, "alone")]


@pytest.mark.parametrize("tile, block", [(256, 4096), (2, 5)])
def test_divergence_equals_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    rows = _sourced(4)
    docs = spark.createDataFrame([(*r, 1, "z", 3) for r in rows], "lang string, source string, text string, n long, term string, value long")
    got = sorted(tuple(r) for r in divergence.audit(docs, min_docs=10, top=4).collect())
    assert got == brute_divergence(rows, 10, 4) and {r[0] for r in got} >= {"", "en", "de", "xx"}


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_scaled_counts_are_exact():
    rng = random.Random(1)
    for _ in range(200):
        total = rng.randrange(10 ** rng.randint(1, 15))
        count, v = rng.randrange(total + 1), rng.randrange(1, 10 ** rng.randint(1, 9))
        assert divergence.scaled(np.array([count]), total, v)[0] == 1 + 10**9 * (count + 2) // (total + 2 * v)


def test_tree_prices_empty_quadrants():
    rng = np.random.default_rng(2)
    for rows, other, terms in ((1, 1, 1), (5, 3, 40), (17, 9, 130), (4, 4, 1)):
        tiles, dense = [], []
        for n in (rows, other):
            there = rng.random((n, terms)) < 0.1
            there[:, terms // 2 : terms // 2 + terms // 4] = False
            zero = rng.integers(1, 50, n)
            p = np.where(there, rng.integers(1, 10**6, (n, terms)), zero[:, None])
            r, c = np.nonzero(there)
            tiles.append((r, c, p[r, c], zero))
            dense.append(p)
        want = divergence.distance(dense[0][:, None, :], dense[1][None, :, :]).sum(axis=2)
        assert (divergence.compare_tiles(*tiles, terms) == want).all()


# --- embeddings ------------------------------------------------------------------------------------


def brute_links(rows, least=0.9):
    n = len(rows)
    good = [v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.linalg.norm(v) if g else None for (_, v), g in zip(rows, good)]
    label, links = list(range(n)), [0] * n
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((name, links[i], component, name is not None and name == component))
    return sorted(out, key=str)


def _vectors(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v = rng.normal(size=dim)
        for _ in range(rng.choice([1, 1, 1, 2, 5, 40])):
            rows.append((len(rows), (v + rng.normal(size=dim) * rng.choice([0, 0.05, 0.3])).tolist()))
    same = rows[3][1]
    odd = [(None, same), (7, same), (7, (-np.array(same)).tolist()), (901, None), (902, []), (903, [0.0] * dim), (904, [float("nan")] * dim), (905, [None] * dim),
           (906, [float("inf")] + same[1:]), (907, same[:5]), (908, same[:5]), (909, [x * 4 for x in same]), (None, None)]
    return rows + odd


@pytest.mark.parametrize("most", [8192, 60])
def test_embedding_links_equal_brute_force(spark, most):
    rows = _vectors(6)
    plan = flatgraph.Plan(shard_rows=most, fan_out=4, overlap=3 if most < 100 else 2, degree=12, recall=1.0)
    df = spark.createDataFrame([(i, v, 1, True) for i, v in rows], "vec_id long, embedding array<double>, node int, kept boolean")
    got = sorted((tuple(r) for r in flatgraph.near_duplicates(df, plan=plan).collect()), key=str)
    want = brute_links(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and found <= there and found >= 0.99 * there
    if most > 100:
        assert got == want


def test_near_copies_that_no_medoid_parts(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=16)
    rows = [(i, (v + rng.normal(size=16) * 0.001).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = flatgraph.near_duplicates(df, plan=flatgraph.Plan(shard_rows=40, fan_out=4)).collect()
    assert all(r.component_id == 0 for r in got) and sum(r.n_links for r in got) >= 0.99 * 150 * 149


def test_no_embeddings(spark):
    assert flatgraph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_registered_embedding_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_embedding_dedup"](spark, SF)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_links(rows)
