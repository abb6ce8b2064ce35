import hashlib
import os
import re
import zlib

import brute
import corpus_pipeline
import pytest

from brightloom.llm import merkle, queries
from compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, SF, queries.QUERIES[name], queries.SQL[name], duck(SF)) is None


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows_of(spark, name, *columns):
    got = queries.QUERIES[name](spark, SF)
    assert got.columns[: len(columns)] == list(columns) or set(columns) <= set(got.columns)
    return sorted((tuple(r) for r in got.select(*columns).collect()), key=str)


def test_op2_query_equals_brute_force(spark, texts):
    order = sorted(texts, key=lambda r: (r[0], hashlib.md5((r[1] or "").encode()).hexdigest()), reverse=True)
    want = []
    for i, (d, t) in enumerate(order):
        n = order[(i + 1) % len(order)][1] or ""
        new = merkle.edited(t or "", n)
        k = len(t or "") // 3
        assert new == (t or "")[: len(t or "") - k] + n[:k]
        fp, new_fp = merkle.fingerprint(t or ""), merkle.fingerprint(new)
        want.append((d, len(t or ""), brute.sha(new), fp, new_fp, merkle.likeness(fp, new_fp), merkle.likeness(fp, merkle.fingerprint(n))))
    assert rows_of(spark, "op2_fingerprints", "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next") == sorted(want, key=str)


def test_op3_query_equals_brute_force(spark, texts):
    want = []
    for d, t in texts:
        found = brute.secrets(t)
        n = [sum(1 for k, _, _ in found if k == kind) for kind in ("assign", "access", "hex")]
        want.append((d, *n, brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in found))))
    assert rows_of(spark, "op3_secret_scan", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=str)
    spans = dict(rows_of(spark, "op3_secret_scan", "doc_id", "spans"))
    for d, t in texts:
        assert {f"{k}:{s}:{e}" for k, s, e in brute.secrets(t)} <= set(spans[d].split(",")) or not brute.secrets(t)


def test_op4_query_equals_brute_force(spark, texts):
    assert rows_of(spark, "op4_substring_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeated(texts)


def test_op5_query_follows_its_rules(spark):
    got = {r.page_id: r for r in queries.QUERIES["op5_url_filter"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert set(got) == {p.page_id for p in pages}
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    for p in pages:
        rest = p.url.partition("://")[2] if p.url and "://" in p.url else ""
        host = re.split("[/?#]", rest)[0]
        path, host = re.split("[?#]", rest[len(host) :])[0], brute.lower(host)
        fits = [(len(h + x), h + x, v) for h, x, v in rules if (host == h or host.endswith("." + h)) and path.startswith(x)]
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else "block" if r.score > 0.5 else "allow")


def test_op6_query_equals_brute_force(spark, texts):
    kept = brute.kept_lines(texts)
    want = [(d, len(t.split("\n")) if t is not None else 0, len(k.split("\n")) if k else 0) for (d, t), k in zip(texts, kept)]
    got = rows_of(spark, "op6_line_dedup", "doc_id", "n_lines", "n_kept")
    # a text that loses all lines, and one that keeps an empty one, are both empty
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=str)]
    assert all(g[2] == w[2] or (w[2] == 0 and g[2] <= 1) for g, w in zip(got, sorted(want, key=str)))


def test_op8_query_counts_every_document(spark, texts):
    assert [r[0] for r in rows_of(spark, "op8_token_counts", "doc_id")] == sorted((d for d, _ in texts), key=str) or len(rows_of(spark, "op8_token_counts", "doc_id")) == len(texts)


def test_op9_query_is_right_on_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op9_language"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert {d.doc_id for d in held} == {i for i, r in got.items() if r.held_out} and set(got) == {d.doc_id for d in docs}
    known = [d for d in held if d.lang is not None and any(c.isalpha() for c in d.text or "")]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in known) >= 0.97 * len(known)
    assert all(0 <= r.score <= 1 for r in got.values()) and all(got[d.doc_id].lang_pred == "und" for d in docs if not any(c.isalpha() for c in d.text or ""))


def test_op10_query_equals_brute_force(spark, texts):
    fps = [brute.simhash(t) for _, t in texts]
    labels = brute.components(fps)
    least = {}
    for (d, _), label in zip(texts, labels):
        least[label] = min(least.get(label, d), d)
    want = [(d, f"{fp:016x}", least[label]) for (d, _), fp, label in zip(texts, fps, labels)]
    assert rows_of(spark, "op10_simhash", "doc_id", "fingerprint", "component_id") == sorted(want, key=str)


def test_pipeline_stages_keep_their_contract(spark, docs, tmp_path):
    """Each stage against plain rules on its own input: language, lines, one of each group, no phrase left, the mix."""
    bench = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(12)))], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    more = spark.createDataFrame([(500, "Before. " + " ".join(f"word{i}" for i in range(12)) + " after it all ends.", "en", "s1", 0, 1, 0.5, "x"), (501, "123", "en", "s1", 0, 1, 0.5, "x")], docs.schema)
    now = docs.unionByName(more)
    seen = []
    for name, step in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()]
        step(spark, now, str(tmp_path)).write.parquet(str(tmp_path / name.replace(" ", "_")))
        now = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        after = [(r.doc_id, r.text) for r in now.collect()]
        seen.append((before, after))
        if name != "source mix":
            assert now.columns == docs.columns
    (a, b), (_, c), (_, d), (_, e), (_, f) = seen
    assert {i for i, t in a if not any(ch.isalpha() for ch in t or "")} == {60, 61, 62, 501} and len(a) - len(b) >= 4
    assert sorted(c, key=str) == sorted(zip([i for i, _ in b], brute.kept_lines(b)), key=str)
    groups = brute.similar_components([t for _, t in c])
    assert len(d) == len(set(groups)) and set(d) <= set(c)
    assert sum(r[1] for r in brute.contamination(e, [(1, " ".join(f"word{i}" for i in range(12)))]).values()) == 0
    assert dict(e)[500] == "Before.   after it all ends." and len(e) == len(d)
    assert {i for i, _ in f} <= {i for i, _ in e} and {"copy", "position"} <= set(now.columns)
