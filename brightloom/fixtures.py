"""Canonical views over the given tables: the inputs the analytics jobs expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: unique total order of the sales rows
SALES_ORDER = [
    "order_date", "order_id", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "quantity",
]
SALES_MEASURES = ["sales_amount", "quantity", "profit"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order line with region, product, amount and profit."""
    line = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    # the geography tables hold a fixed, small number of rows; Spark broadcasts them by their size
    place = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    buyers = customer.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    bought = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        line.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_orderdate").alias("date"),
            F.col("o_orderdate").alias("order_date"),
            F.col("r_name").alias("region"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
            amount.alias("sales_amount"),
            F.col("l_quantity").alias("quantity"),
            (amount - F.col("l_quantity") * F.col("p_retailprice")).alias("profit"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_orderkey").alias("order_id"),
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        )
    )


def sales_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """``sales`` with deterministic gaps and unparsable dates, for cleaning and validation."""
    s = sales(spark, sf)

    def gap(name: str, n: int):
        return F.when(F.col("order_id") % n != 0, F.col(name)).alias(name)

    return s.select(
        "order_id", "l_linenumber", "l_partkey", "l_suppkey", "customer_id",
        gap("sales_amount", 7), gap("quantity", 11), "profit", gap("region", 13), "product", "category",
        F.when(F.col("order_id") % 17 == 0, F.lit("not-a-date"))
        .otherwise(F.date_format("date", "yyyy-MM-dd HH:mm:ss")).alias("date_text"),
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sales per region: (series_id, ds, y)."""
    return (
        sales(spark, sf)
        .groupBy(F.col("region").alias("series_id"), F.to_date("date").alias("ds"))
        .agg(F.sum("sales_amount").alias("y"))
    )


def customer_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Wide numeric frame, one row per customer: totals, means, counts and spreads of the order lines."""
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    per = (
        line.join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(
            F.sum("l_extendedprice").alias("amount_sum"),
            F.avg("l_extendedprice").alias("amount_mean"),
            F.stddev_samp("l_extendedprice").alias("amount_std"),
            F.count(F.lit(1)).cast("double").alias("n_lines"),
            F.sum("l_quantity").alias("quantity_sum"),
            F.avg("l_quantity").alias("quantity_mean"),
            F.stddev_samp("l_quantity").alias("quantity_std"),
            F.avg("l_discount").alias("discount_mean"),
            F.stddev_samp("l_discount").alias("discount_std"),
            F.avg("l_tax").alias("tax_mean"),
            F.stddev_samp("l_tax").alias("tax_std"),
        )
    )
    return (
        table(spark, sf, "customer")
        .select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
        .join(per, F.col("customer_id") == F.col("o_custkey"), "left")
        .drop("o_custkey")
    )


CUSTOMER_FRAME_COLUMNS = [
    "c_acctbal", "amount_sum", "amount_mean", "amount_std", "n_lines", "quantity_sum", "quantity_mean",
    "quantity_std", "discount_mean", "discount_std", "tax_mean", "tax_std",
]


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def usage(spark: SparkSession, sf: str) -> DataFrame:
    """Dashboard views: one row per view event."""
    return events(spark, sf).filter("event_type = 'view'").select(
        (F.col("user_id") % 10).alias("workbook_id"), "user_id", "ts"
    )


def host_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Host metric samples read out of the event values."""
    v = F.col("value")
    return events(spark, sf).select(
        "event_id", "ts",
        (v % 100).alias("cpu_percent"),
        ((v * 3) % 100).alias("memory_percent"),
        (v * 16).alias("memory_used_mb"),
        ((v * 7) % 100).alias("disk_percent"),
    )
