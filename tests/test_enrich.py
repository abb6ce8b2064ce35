import datetime
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from brightloom import staging
from brightloom.operators.selection import _array, counts
from brightloom.plans import enrich

MEASURES = ["sales_amount", "quantity", "profit"]


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "stage_root", lambda spark: f"file://{tmp_path}")
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(3)
    rows = [
        (datetime.datetime(2020, 1, 1) + datetime.timedelta(days=i // 3), i, rng.randrange(12), rng.choice("abc"), rng.uniform(1, 99) if i % 13 else None, float(rng.randrange(1, 9)), rng.uniform(-9, 9))
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "order_date timestamp, order_id long, customer_id long, region string, sales_amount double, quantity double, profit double").repartition(3)


def test_a_kept_stage_belongs_to_the_block_around(spark, folder):
    with staging.passing_stages(spark):
        with staging.passing_stages(spark):
            staging.stage(spark.range(1), "gone")
            staging.stage(spark.range(2), "kept", keep=True)
        assert folder() == ["kept"]
    assert folder() == []


@pytest.mark.parametrize("forest, left", [(False, ["features"]), (True, ["scored"])])
def test_the_sales_job_leaves_its_wide_table_only(spark, sales, folder, forest, left):
    done = enrich.enrich_sales(sales, ["order_date", "order_id"], numeric=MEASURES, config=enrich.FeatureConfig(forest=forest, windows=(3, 7)))
    assert folder() == left
    got = done.rows.agg(F.count("sales_amount_percentile"), F.sum("profit_outlier"), F.count("region_avg_sales")).first()
    assert got[0] == got[2] == 200 and got[1] is not None


def test_the_customer_job_writes_wide_rows_once(spark, sales, folder):
    on = ["sales_amount_sum", "recency", "frequency"]
    config = enrich.FeatureConfig(windows=(3, 7), n_clusters=2, kmeans_restarts=2, pca_components=2)
    early = enrich.enrich_customers(sales, ["order_date", "order_id"], MEASURES, on, config=config)
    assert folder() == ["clusters", "features"]
    names = early.rows.columns
    made = ["sales_amount_sum", "purchase_frequency", "recency", "customer_segment", "value_segment", "sales_amount_sum_outlier", "distance_to_cluster_0", "is_outlier", "pca_component_2"]
    assert [c for c in names if c in made] == made and early.n_features == len(names) - 7
    rows = early.rows.select("order_id", "customer_id", *made).collect()
    own = {r.customer_id: r for r in sales.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(rows) == 200 and all(None not in (r.recency, r.is_outlier, r.pca_component_2) for r in rows)
    assert dict(early.rows.select("customer_id", "frequency").distinct().collect()) == {c: r.n for c, r in own.items()}


def test_profile_has_a_row_per_task_and_column(spark):
    rows = [(1, 2.0, None), (None, float("nan"), None), (-3, -1e-9, None), (2**62, float("-inf"), None)]
    df = spark.createDataFrame(rows, "i long, x double, e int").repartition(3)
    out = enrich.profile_columns(df)
    assert "Generate" not in out._jdf.queryExecution().toString()
    got = {r["column"]: r for r in out.collect()}
    assert (got["i"].n_values, got["i"].low, got["i"].high) == (3, -3.0, float(2**62)) and got["i"]["mean"] == (2**62 - 2) / 3
    assert (got["x"].n_values, got["x"].low) == (4, -math.inf) and math.isnan(got["x"].high) and math.isnan(got["x"]["mean"])
    assert tuple(got["e"])[1:] == (0, None, None, None)
    assert counts(df, [F.col(c) for c in df.columns]) == [3, 4, 0]


def test_arrays_of_literals(spark):
    doubles, longs, ints = [1.5, None, -1e-300, 1e22, 5e-324, -0.1], [None, -(2**62), 2**63 - 1, -(2**63)], [1, -2, 2**31 - 1, -(2**31)]
    got = spark.range(1).select(_array(doubles, DoubleType()), _array(longs, LongType()), _array(ints, IntegerType()), _array([math.inf, 1.0], DoubleType())).first()
    assert [list(g) for g in got] == [doubles, longs, ints, [math.inf, 1.0]]
