import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from brightloom.operators import joins, selection

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


def small(monkeypatch):
    monkeypatch.setattr(selection.order_statistics, "__defaults__", (40, 80))


@pytest.mark.parametrize("kind", ["spread", "hot", "integers", "two"])
def test_quantiles_through_brackets(spark, monkeypatch, kind):
    small(monkeypatch)
    rng = np.random.default_rng(1)
    x = {
        "spread": rng.normal(0, 10, 3000),
        "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.normal(7, 3, 3000)),
        "integers": rng.integers(-5, 6, 3000).astype(float),
        "two": np.array([1.0, 2.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 5, "x double").repartition(4)
    got = selection.exact_quantiles(df, ["x"], QS)[0]
    np.testing.assert_allclose(got, np.quantile(x, QS), rtol=1e-12, atol=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_quantiles_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    np.testing.assert_allclose(selection.exact_quantiles(df, ["x"], [0.1, 0.5])[0], np.quantile(values, [0.1, 0.5]), rtol=1e-9, atol=1e-9)


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert selection.exact_quantiles(df, ["x"], [0.5]) == [[None]]


def test_hot_keys_are_dealt_over_salts(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    rows = spark.range(300).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"))
    stats = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
    got = joins.lookup_join(rows, stats, ["k"], weight="n", spread_by=["id"])
    want = rows.join(stats, ["k"], "left")
    assert sorted(map(tuple, got.select("id", "k", "n", "s").collect()), key=str) == sorted(map(tuple, want.select("id", "k", "n", "s").collect()), key=str)
    assert "_salt" not in got.columns


def test_null_keys_are_spread_over_all_tasks(spark):
    from pyspark.sql import functions as F

    from brightloom.staging import stage

    rows = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, (F.col("id") % 500).cast("string")).alias("k"))
    stats = stage(rows.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")), "stats")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.lookup_join(rows, stats, ["k"], weight="n", spread_by=["id"])
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.count() == 40_000 and out.filter("k is null and n is null").count() == 20_000
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert max(sizes) < 1.5 * sum(sizes) / len(sizes)
