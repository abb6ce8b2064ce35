import corpus_pipeline
from pyspark.sql import functions as F

from brightloom.llm import language
from test_training_operators import language_rows


def test_language_stage_keeps_clean_mixed_documents(spark, tmp_path):
    vocab, rows = language_rows()
    thirds = " ".join(vocab["aa"] * 8) + " " + " ".join(vocab["bb"] * 6) + " " + " ".join(vocab["ru"] * 8)
    docs = rows + [(900, thirds, None), (901, "漢字" * 200 + " " + vocab["aa"][0], None), (902, "123", None), (903, None, None)]
    stage = dict(corpus_pipeline.STAGES)["language"]
    got = {r.doc_id for r in stage(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string"), str(tmp_path)).collect()}
    letters = {lang: sum(map(len, words)) * n for (lang, words), n in zip(vocab.items(), (8, 6, 8))}
    assert max(letters.values()) < sum(letters.values()) / 2
    assert got == {r[0] for r in rows} | {900}


def test_more_than_256_languages(spark):
    """Each language has a word of its own; no label may wrap around."""
    word = lambda i: "".join(chr(97 + int(d)) * 2 for d in f"{i:03d}") + chr(97 + i % 26) * 3
    rows = [(i, f"{word(i)} " * 30, f"l{i:03d}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict(docs.withColumns({"spans": F.lit(1), "lang_pred": F.lit("x"), "score": F.lit(7)}), language.fit(docs))
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "spans"]
    got = [(r.lang, r.lang_pred, r.spans[0].lang) for r in found.collect()]
    assert len(got) == 300 and all(a == b == c for a, b, c in got)
