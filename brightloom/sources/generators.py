"""Synthetic rows for given ids.

Every value is a function of (id, salt) through a hash, so rows do not depend on partitioning, a lost task
rewrites the same rows, and any engine with MD5 can reproduce them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Categories of the sample data.
REGIONS = ["North America", "Europe", "Asia Pacific", "Latin America", "Middle East & Africa"]
PRODUCTS = ["Product A", "Product B", "Product C", "Product D", "Product E", "Product F"]
CATEGORIES = ["Electronics", "Clothing", "Home & Garden", "Sports", "Books", "Health"]
CUSTOMER_SEGMENTS = [
    "Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "At Risk", "Cannot Lose Them", "Others",
]
CHANNELS = ["Online", "Social Media", "Email", "Direct", "Referral", "Paid Ads"]
COUNTRIES = ["USA", "Canada", "UK", "Germany", "France", "Australia", "Japan", "Brazil"]
DAYS = 1461  # 2020-01-01 .. 2023-12-31


def digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))


def uniform(hashed: Column, place: int) -> Column:
    """Uniform in [0, 1) from one of the four 32-bit words of a digest."""
    word = F.substring(hashed, 1 + 8 * place, 8)
    return F.conv(word, 16, 10).cast("double") / F.lit(4294967296.0)


def normal(u: Column, v: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - u)) * F.cos(F.lit(2.0) * F.pi() * v)


def pick(u: Column, options: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.floor(u * len(options)) + 1).cast("int"))


def poisson_steps(mean: float, tail: float = 1e-12) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... until the rest is below ``tail``."""
    steps, p, total, k = [], math.exp(-mean), 0.0, 0
    while 1.0 - total > tail and k < 200:
        total += p
        steps.append(total)
        k += 1
        p *= mean / k
    return steps


def poisson(u: Column, mean: float) -> Column:
    """Inverse of the cumulative distribution."""
    steps = poisson_steps(mean)
    out = F.lit(len(steps))
    for k in range(len(steps) - 1, -1, -1):
        out = F.when(u < F.lit(steps[k]), F.lit(k)).otherwise(out)
    return out.cast("long")


def synthetic_sales(ids: DataFrame, key: str) -> DataFrame:
    """One sales row per id: lognormal(6, 1) amounts with a yearly season, 15-25 % profit, Poisson(5)+1 pieces."""
    h = ids.select(F.col(key).cast("long").alias("order_id"), *[digest(F.col(key), s).alias(s) for s in ("sa", "sb", "sc")])
    u = [uniform(F.col(s), i) for s in ("sa", "sb", "sc") for i in range(4)]
    date = F.date_add(F.lit("2020-01-01").cast("date"), F.floor(u[0] * DAYS).cast("int"))
    base = h.select(
        date.alias("date"),
        pick(u[1], REGIONS).alias("region"), pick(u[2], PRODUCTS).alias("product"), pick(u[3], CATEGORIES).alias("category"),
        F.exp(F.lit(6.0) + normal(u[4], u[5])).alias("amount"),
        (poisson(u[6], 5.0) + 1).alias("quantity"),
        (F.floor(u[7] * 9999) + 1).cast("long").alias("customer_id"),
        "order_id",
        (F.lit(0.15) + u[8] * 0.1).alias("margin"),
    ).withColumn("month", F.month("date"))
    season = F.lit(1.0) + F.lit(0.3) * F.sin(F.lit(2.0) * F.pi() * (F.col("month") - 1) / 12)
    return base.select(
        "date", "region", "product", "category", (F.col("amount") * season).alias("sales_amount"), "quantity",
        "customer_id", "order_id", (F.col("amount") * F.col("margin") * season).alias("profit"), "month",
    )


def synthetic_customers(ids: DataFrame, key: str, n: int) -> DataFrame:
    """One customer row per id 0..n-1; dates are spread evenly over the ids."""
    salts = ("ca", "cb", "cc", "cd", "ce")
    h = ids.select(F.col(key).cast("long").alias("customer_id"), *[digest(F.col(key), s).alias(s) for s in salts])
    u = [uniform(F.col(s), i) for s in salts for i in range(4)]
    share = F.col("customer_id") / F.lit(float(max(n - 1, 1)))

    def spread(start: str, days: int) -> Column:
        return F.date_add(F.lit(start).cast("date"), F.floor(share * days).cast("int"))

    base = h.select(
        "customer_id",
        pick(u[0], CUSTOMER_SEGMENTS).alias("customer_segment"), pick(u[1], CHANNELS).alias("acquisition_channel"),
        pick(u[2], COUNTRIES).alias("country"),
        spread("2020-01-01", DAYS - 1).alias("registration_date"), spread("2023-01-01", 364).alias("last_purchase_date"),
        (poisson(u[3], 8.0) + 1).alias("total_orders"),
        F.exp(F.lit(7.0) + normal(u[4], u[5])).alias("total_spent"),
        F.exp(F.lit(4.0) + F.lit(0.5) * normal(u[6], u[7])).alias("avg_order_value"),
        F.exp(F.lit(8.0) + normal(u[8], u[9])).alias("customer_lifetime_value"),
        F.least(F.greatest(F.lit(7.5) + F.lit(1.5) * normal(u[10], u[11]), F.lit(1.0)), F.lit(10.0)).alias("satisfaction_score"),
        # the second smallest of six uniforms is Beta(2, 5)
        F.element_at(F.array_sort(F.array(*u[12:18])), 2).alias("churn_probability"),
    )
    age = F.datediff("last_purchase_date", "registration_date") / F.lit(365.0)
    last = F.lit("2023-12-31").cast("date")
    return base.withColumns(
        {
            "recency": F.datediff(last, F.col("last_purchase_date")).cast("long"),
            "frequency": F.col("total_orders") / (age + F.lit(0.1)),
            "monetary": F.col("total_spent"),
        }
    )


def synthetic_series(ids: DataFrame, key: str, noise: float = 50.0) -> DataFrame:
    """For each id a daily series 2020-2023: trend 1000 to 1500, a yearly wave of 200 and normal noise.

    A short list of ids makes very many rows, so the ids are dealt over a given number of tasks, which are not put together again.
    """
    days = F.sequence(F.lit("2020-01-01").cast("date"), F.lit("2023-12-31").cast("date"))
    dealt = ids.repartition(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    rows = dealt.select(F.col(key).cast("string").alias("series_id"), F.posexplode(days).alias("i", "ds"))
    h = digest(F.concat(F.col("series_id"), F.lit(":"), F.col("i").cast("string")), "ds")
    wave = F.lit(200.0) * F.sin(F.lit(2.0) * F.pi() * F.col("i") / 365)
    trend = F.lit(1000.0) + F.lit(500.0) * F.col("i") / F.lit(float(DAYS - 1))
    shaken = normal(uniform(F.col("h"), 0), uniform(F.col("h"), 1)) * F.lit(noise)
    return rows.withColumn("h", h).select("series_id", "ds", (trend + wave + shaken).alias("y"))
