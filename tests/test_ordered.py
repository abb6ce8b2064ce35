import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import joins, ordered, rolling
from brightloom.staging import stage


def numbers(n=400, seed=3, gaps=True):
    rng = np.random.default_rng(seed)
    x = np.round(rng.lognormal(3, 1, n), 2)
    if gaps:
        x[rng.random(n) < 0.15] = np.nan
    x[50:70] = 5.0  # a constant stretch
    return pd.DataFrame({"k": rng.permutation(n), "g": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]), "x": x})


def frame(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).repartition(5)


def test_row_index_counts_from_zero_without_gaps(many_parts):
    df = frame(many_parts, numbers())
    got = ordered.row_index(df, ["k"]).orderBy("k").toPandas()
    assert got["_rn"].tolist() == list(range(400))
    assert got["_part"].nunique() > 1


def test_row_index_keeps_groups_together(many_parts):
    pdf = numbers()
    got = ordered.row_index(frame(many_parts, pdf), ["k"], ["g"]).toPandas().sort_values("_rn")
    assert got[["g", "k"]].values.tolist() == pdf.sort_values(["g", "k"])[["g", "k"]].values.tolist()


def test_row_index_of_nothing(spark):
    assert ordered.row_index(frame(spark, numbers()).limit(0), ["k"]).count() == 0


def test_prefix_sum(many_parts):
    pdf = pd.DataFrame({"k": range(100), "n": [i % 7 for i in range(100)]})
    got = ordered.prefix_sum(many_parts.createDataFrame(pdf), ["k"], "n", "before").orderBy("k").toPandas()
    assert got["before"].tolist() == (pdf["n"].cumsum() - pdf["n"]).tolist()


def test_forward_fill_crosses_partitions(many_parts):
    pdf = numbers()
    pdf.loc[pdf["k"].between(20, 330), "x"] = np.nan  # longer than any range partition
    indexed = ordered.row_index(frame(many_parts, pdf), ["k"])
    got = ordered.forward_fill(indexed, ["x"]).orderBy("k").toPandas()["_filled_x"]
    want = pdf.sort_values("k")["x"].ffill().reset_index(drop=True)
    pd.testing.assert_series_equal(got, want, check_names=False)


def test_forward_fill_stops_at_groups(many_parts):
    pdf = numbers()
    pdf.loc[pdf["k"] > 30, "x"] = np.nan
    indexed = ordered.row_index(frame(many_parts, pdf), ["k"], ["g"])
    got = ordered.forward_fill(indexed, ["x"], ["g"]).orderBy("g", "k").toPandas()["_filled_x"]
    s = pdf.sort_values(["g", "k"])
    pd.testing.assert_series_equal(got, s.groupby("g")["x"].ffill().reset_index(drop=True), check_names=False)


@pytest.mark.parametrize("chunk", [90, 8192])
def test_rolling_equals_pandas(many_parts, chunk):
    pdf = numbers().sort_values("k", ignore_index=True)
    got = rolling.rolling_stats(frame(many_parts, pdf), ["x"], ["k"], chunk_rows=chunk).orderBy("k").toPandas()
    for w in (7, 30, 90):
        r = pdf["x"].rolling(w, min_periods=1)
        want = {"mean": r.mean(), "std": r.std(), "min": r.min(), "max": r.max(), "median": r.median(),
                "skew": pdf["x"].rolling(w, min_periods=3).skew(), "kurt": pdf["x"].rolling(w, min_periods=4).kurt()}
        for s, v in want.items():
            np.testing.assert_allclose(got[f"x_rolling_{w}_{s}"].astype(float), v, rtol=1e-6, atol=1e-6, err_msg=f"{s} {w}")


def test_rolling_inside_groups(many_parts):
    pdf = numbers().sort_values(["g", "k"], ignore_index=True)
    got = rolling.rolling_stats(frame(many_parts, pdf), ["x"], ["k"], windows=[7], stats=["mean", "median"], partition_by=["g"], chunk_rows=16)
    got = got.orderBy("g", "k").toPandas()
    for s in ("mean", "median"):
        want = getattr(pdf.groupby("g")["x"].rolling(7, min_periods=1), s)().reset_index(drop=True)
        np.testing.assert_allclose(got[f"x_rolling_7_{s}"].astype(float), want, rtol=1e-9)


def test_lag_and_change_equal_pandas(many_parts):
    pdf = numbers().sort_values("k", ignore_index=True)
    got = rolling.lag_and_change(frame(many_parts, pdf), ["x"], ["k"], chunk_rows=30).orderBy("k").toPandas()
    for k in (1, 7, 30):
        np.testing.assert_allclose(got[f"x_lag_{k}"].astype(float), pdf["x"].shift(k))
        filled = pdf["x"].ffill()
        np.testing.assert_allclose(got[f"x_pct_change_{k}"].astype(float), filled / filled.shift(k) - 1, rtol=1e-9)


def test_lags_longer_than_the_windows_are_left_out(spark):
    out = rolling.lag_and_change(frame(spark, numbers()), ["x"], ["k"], windows=[7])
    assert "x_lag_7" in out.columns and "x_lag_30" not in out.columns


def test_change_from_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0)], "k long, x double")
    got = rolling.lag_and_change(df, ["x"], ["k"], lags=[1]).orderBy("k").collect()
    assert got[1]["x_pct_change_1"] is None and got[1]["x_lag_1"] == 0.0


def test_percentile_rank_equals_pandas(many_parts):
    pdf = numbers()
    pdf["x"] = pdf["x"].round(0)  # ties
    got = rolling.percentile_rank(frame(many_parts, pdf), ["x"]).orderBy("k").toPandas()["x_percentile"]
    want = pdf.sort_values("k")["x"].rank(pct=True).reset_index(drop=True)
    np.testing.assert_allclose(got.astype(float), want)


def test_zscore_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "k long, x double")
    assert rolling.zscore(df, ["x"]).filter("x_zscore IS NOT NULL").count() == 0


def test_statistical_features_have_all_columns(spark):
    pdf = numbers()
    out = rolling.statistical_features(frame(spark, pdf).select("k", "x"), ["x"], ["k"])
    assert len(out.columns) == 2 + 21 + 6 + 2
    assert out.count() == len(pdf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1  # lags and moving statistics share the chunks


def test_chunks_stay_small_when_one_key_holds_most_rows(many_parts):
    df = many_parts.range(3000).select("id", F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    chunked = ordered.with_halo(ordered.row_index(df, ["id"], ["g"]), reach=20, chunk_rows=100)
    sizes = chunked.groupBy("_chunk").count().agg(F.max("count")).first()[0]
    assert sizes <= 120 and chunked.filter("_own").count() == 3000


def test_long_lookup_tables_are_not_built_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 5)
    rows = spark.createDataFrame([(i % 8, i) for i in range(40)] + [(None, 40)], "k long, x long")
    for n, small in ((8, False), (5, True)):
        stats = stage(spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"), F.lit(5).cast("long").alias("n")), "stats")
        for how in ("left", "inner"):
            out = joins.lookup_join(rows, stats, ["k"], weight="n", how=how)
            assert ("BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()) == small
            want = [(r.k, r.x, r.k * 10 if r.k is not None and r.k < n else None) for r in rows.collect()]
            assert sorted(map(str, out.select("k", "x", "y").collect())) == sorted(f"Row(k={k}, x={x}, y={y})" for k, x, y in want if how == "left" or y is not None)
