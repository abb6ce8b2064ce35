"""Queries that run a stream to its end and compare it with its batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom import fixtures as fx
from brightloom.operators.outliers import fit_outliers
from brightloom.plans.rounding import r
from brightloom.plans.sqltext import rnd
from brightloom.staging import stage_path
from brightloom.streaming import events as ev
from brightloom.unions import union_all

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.run_to_files(ev.tumbling(ev.event_stream(spark, sf)), "tumbling")
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "event_type", "n_events", r("sum_value").alias("sum_value"),
    )


SQL["stream_tumbling"] = f"""WITH w AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS s, event_type, count(*) AS n_events, sum(value) AS v FROM events GROUP BY 1, 2)
 SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, n_events, {rnd('v')} AS sum_value
 FROM w WHERE s + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Events replayed with a copy of every 50th row."""
    e = fx.events(spark, sf)
    folder = stage_path(spark, "replay")
    union_all(e, e.filter("event_id % 50 = 0")).write.parquet(folder)
    once = ev.run_to_files(ev.dedup(ev.event_stream(spark, folder, "*.parquet")), "dedup")
    return once.select("event_id", "user_id", "event_type", "value")


SQL["stream_dedup"] = "SELECT event_id, user_id, event_type, value FROM events"


@query
def stream_outliers(spark: SparkSession, sf: str) -> DataFrame:
    rules = fit_outliers(fx.events(spark, sf), ["value"])
    out = ev.run_to_files(ev.live_outliers(ev.event_stream(spark, sf), rules), "flags")
    return out.select("event_id", "value_outlier")


SQL["stream_outliers"] = """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
 SELECT event_id, CAST(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS INTEGER) AS value_outlier FROM events, q"""


@query
def stream_quality(spark: SparkSession, sf: str) -> DataFrame:
    q = ev.run_quality(ev.event_stream(spark, sf))
    return q.select("batch_id", "rows", "null_cells", r("overall_score", 6).alias("overall_score"), F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"))


SQL["stream_quality"] = """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS rows, CAST(0 AS BIGINT) AS null_cells, 1.0::DOUBLE AS overall_score,
 strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest FROM events"""
