"""Datasets behind dashboard tiles. Every result is small or bounded by its bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightloom.functions.expressions import time_literal


def region_totals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(F.sum("sales_amount").alias("sales_amount"))


def top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    """Products with the largest totals; equal totals are ordered by name."""
    totals = sales.groupBy("product").agg(F.sum("sales_amount").alias("sales_amount"))
    return totals.orderBy(F.desc("sales_amount"), "product").limit(n)


def month_histogram(sales: DataFrame) -> DataFrame:
    return sales.filter("date IS NOT NULL").groupBy(F.month("date").alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


def kpi_total(sales: DataFrame, reference_share: float = 0.9) -> DataFrame:
    """Total sales, the reference value and the relative difference."""
    total = F.coalesce(F.sum("sales_amount"), F.lit(0.0)).alias("total_sales")
    reference = (F.col("total_sales") * reference_share).alias("reference_sales")
    return sales.agg(total).select(
        "total_sales", reference,
        F.try_divide(F.col("total_sales") - F.col("total_sales") * reference_share, F.col("total_sales") * reference_share).alias("relative_delta"),
    )


def margin_gauge(sales: DataFrame) -> DataFrame:
    """Profit margin in percent, measured from the rows."""
    return sales.agg((F.try_divide(F.sum("profit"), F.sum("sales_amount")) * 100).alias("profit_margin_pct"))


def segment_counts(customers: DataFrame, column: str = "customer_segment") -> DataFrame:
    return customers.groupBy(column).agg(F.count(F.lit(1)).alias("n_customers")).orderBy(F.desc("n_customers"), column)


def _limits(df: DataFrame, *columns: str) -> list[tuple[float, float] | None]:
    row = df.agg(*[f(c).alias(f"{c}_{i}") for c in columns for i, f in enumerate((F.min, F.max))]).first()
    return [(float(a), float(b)) if a is not None else None for a, b in zip(row[0::2], row[1::2])]


def _bin(column: str, limits: tuple[float, float], bins: int):
    low, high = limits
    width = (high - low) / bins
    if width == 0:
        return F.when(F.col(column).isNotNull(), F.lit(1))
    place = F.floor((F.col(column) - F.lit(low)) / F.lit(width)) + 1
    return F.least(place, F.lit(bins)).cast("int")  # the maximum belongs to the last bin


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, lower_edge, n_rows): equal bins between the minimum and the maximum; empty bins are absent."""
    (limits,) = _limits(df, column)
    limits = limits or (0.0, 0.0)
    low, width = limits[0], (limits[1] - limits[0]) / bins
    counted = df.filter(F.col(column).isNotNull()).groupBy(_bin(column, limits, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select("bin", (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower_edge"), "n_rows")


def scatter_bins(df: DataFrame, x: str = "sales_amount", y: str = "profit", bins: int = 40) -> DataFrame:
    """Two-dimensional bins with counts and mean ``y``, in place of one mark per row."""
    lx, ly = _limits(df, x, y)
    if lx is None or ly is None:
        return df.limit(0).select(F.lit(0).alias("x_bin"), F.lit(0).alias("y_bin"), F.lit(0).cast("long").alias("n_rows"), F.lit(0.0).alias("mean_y"))
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(_bin(x, lx, bins).alias("x_bin"), _bin(y, ly, bins).alias("y_bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(y).alias("mean_y"))
    )


def rfm_points(customers: DataFrame) -> DataFrame:
    """Customers counted per segment with mean recency, frequency and monetary."""
    return customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg("recency").alias("mean_recency"), F.avg("frequency").alias("mean_frequency"), F.avg("monetary").alias("mean_monetary"),
    )


def usage_analytics(views: DataFrame, days: int = 7) -> DataFrame:
    """Per workbook: views, distinct users, views in the last days before the newest view, last access."""
    newest = views.agg(F.max("ts").alias("ts")).first()[0]
    start = time_literal(newest, views.schema["ts"].dataType) - F.expr(f"INTERVAL {days} DAYS")
    # users are counted once per (workbook, user), so a busy workbook is pre-aggregated by user
    per_user = views.groupBy("workbook_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ts") > start).alias("recent"), F.max("ts").alias("last")
    )
    return per_user.groupBy("workbook_id").agg(
        F.sum("n").alias("total_views"), F.count("user_id").alias("unique_users"),
        F.sum("recent").alias("views_last_week"), F.max("last").alias("last_accessed"),
    )
