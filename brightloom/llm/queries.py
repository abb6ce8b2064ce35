"""Registered queries of this folder: each applies one operator to its whole table and derives the asked columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom.fixtures import table
from brightloom.llm import collocations, decontaminate, divergence, flatgraph, language, lines, merkle, mixing, oracle, secrets, simhash, substrings, tokens, urls


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_phrases(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.with_edits(table(spark, sf, "documents"))


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents"))
    named = lambda keep: F.concat_ws(",", F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
    )


def op4_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substrings.repeated_strings(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf, "pages"))


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return lines.count_lines(table(spark, sf, "documents").select("doc_id", "text"))


def op7_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    planned = mixing.plan_mix(mixing.with_size(table(spark, sf, "documents")).select("doc_id", "source", "size"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", F.when(F.col("copies") > 0, F.round(mixing.position(0), 9)).alias("first_position"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf, "documents"))


def op9_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter(~F.col("held_out")))
    found = language.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf, "embeddings"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_fingerprints": op2_fingerprints,
    "op3_secret_scan": op3_secret_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_url_filter": op5_url_filter,
    "op6_line_dedup": op6_line_dedup,
    "op7_source_mix": op7_source_mix,
    "op8_token_counts": op8_token_counts,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_divergence": op12_divergence,
    "op13_embedding_dedup": op13_embedding_dedup,
}
SQL: dict[str, str] = dict(oracle.SQL)
