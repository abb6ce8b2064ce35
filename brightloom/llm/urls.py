"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

The regression learns from a small labelled URL table: URLs that a rule judges, at most ``max_train`` of them, chosen by the
smallest hash of (host, path). It judges the URLs that no rule fits. With labels of one kind only, that kind is the verdict;
with none, ``default`` is. A null URL or one without ``://`` has an empty host and path and is judged by the intercept.
Equal URLs get equal verdicts; rows are kept as they are, repeated ones too. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import ascii_lower

#: the given rules: verdict and host/path prefix
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. ``rules`` is a short list and becomes one expression."""
    fits = []
    for verdict, rule in rules:
        name, _, prefix = rule.partition("/")
        on_host = (host == name) | host.endswith(f".{name}")
        found = F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits.append(F.when(on_host & path.startswith(f"/{prefix}"), found))
    best = F.array_max(F.array(*fits))
    return best["rule"], best["verdict"]


def grams(host: Column, path: Column, sizes: Sequence[int] = (3, 4)) -> Column:
    """Character n-grams of host and path, marked by where they come from."""
    def every(mark: str, c: Column, n: int) -> Column:
        framed = F.concat(F.lit("^"), c, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(framed) - (n - 1)))
        return F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{n}"), framed.substr(i, F.lit(n))))

    return F.concat(*[every(mark, c, n) for mark, c in (("h", host), ("p", path)) for n in sizes])


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES,
    max_train: int = 4000, buckets: int = 1 << 14, default: str = "allow",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): score is the regression's probability of ``block`` (0 to 1)."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    ruled = parsed.withColumns({"rule": rule, "_ruled": verdict})
    labelled = ruled.filter("_ruled is not null").select("host", "path", (F.col("_ruled") == "block").cast("double").alias("label")).distinct()
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}  # two rows
    # about max_train / 2 of each verdict, by a hash of the URL: a rare verdict is learned from as well as a common one
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, max_train / 2 / n))]) if counts else F.lit(None)
    labelled = labelled.filter(F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30)) < share[F.col("label")] * float(1 << 30)) if counts else labelled
    hasher = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=buckets, binary=True)
    # about max_train short rows at most: one sorted partition keeps the order of sums, and so the model, the same
    train = hasher.transform(labelled.withColumn("_grams", grams(F.col("host"), F.col("path")))).coalesce(1).sortWithinPartitions("host", "path").select("_features", "label").cache()
    kinds = sorted(counts)
    if len(kinds) == 2:
        model = LogisticRegression(featuresCol="_features", labelCol="label", probabilityCol="_prob", predictionCol="_pred", rawPredictionCol="_raw", maxIter=30, regParam=0.01).fit(train)
        scored = model.transform(hasher.transform(ruled.withColumn("_grams", grams(F.col("host"), F.col("path")))))
        scored = scored.withColumn("score", vector_to_array("_prob")[1])
    else:
        scored = ruled.withColumn("score", F.lit(kinds[0] if kinds else float(default == "block")))
    train.unpersist()
    by_model = F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_ruled", by_model).alias("verdict"), "score")
