"""Queries for features, joins, RFM, outliers and dashboards, each with its comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom import fixtures as fx
from brightloom.functions.calendar import calendar_columns, time_features as add_time_features
from brightloom.functions.expressions import interactions as add_interactions
from brightloom.operators import business, dashboards, outliers, rfm, rolling
from brightloom.operators.cleaning import clean_sales
from brightloom.plans.rounding import r
from brightloom.plans.sqltext import DIRTY, SALES, rnd
from brightloom.staging import stage

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "orders")


_BY = ["o_orderdate", "o_orderkey"]


# --- calendar, interactions ------------------------------------------------------------------------


@query
def time_features(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.sales_dirty(spark, sf).select("order_id", "date_text").distinct()
    t = add_time_features(d.withColumn("date", F.col("date_text").try_cast("timestamp_ntz")), ["date"])
    waves = {f"date_{p}_{f}": r(f"date_{p}_{f}", 9) for p in ("month", "day") for f in ("sin", "cos")}
    return t.withColumns(waves).select("order_id", *calendar_columns("date"))


SQL["time_features"] = f"""{DIRTY}, d AS (SELECT DISTINCT order_id, TRY_CAST(date_text AS TIMESTAMP) AS d FROM dirty)
 SELECT order_id, CAST(year(d) AS INTEGER) AS date_year, CAST(month(d) AS INTEGER) AS date_month, CAST(quarter(d) AS INTEGER) AS date_quarter,
 CAST(day(d) AS INTEGER) AS date_day, CAST(isodow(d) - 1 AS INTEGER) AS date_dayofweek, CAST(dayofyear(d) AS INTEGER) AS date_dayofyear,
 CAST(weekofyear(d) AS INTEGER) AS date_week, CAST(coalesce(isodow(d) >= 6, false) AS INTEGER) AS date_is_weekend,
 CAST(coalesce(day(d) = 1, false) AS INTEGER) AS date_is_month_start,
 CAST(coalesce(last_day(d) = CAST(d AS DATE), false) AS INTEGER) AS date_is_month_end,
 CAST(coalesce(day(d) = 1 AND month(d) IN (1, 4, 7, 10), false) AS INTEGER) AS date_is_quarter_start,
 CAST(coalesce(last_day(d) = CAST(d AS DATE) AND month(d) IN (3, 6, 9, 12), false) AS INTEGER) AS date_is_quarter_end,
 {rnd('sin(2 * pi() * month(d) / 12)', 9)} AS date_month_sin, {rnd('cos(2 * pi() * month(d) / 12)', 9)} AS date_month_cos,
 {rnd('sin(2 * pi() * day(d) / 31)', 9)} AS date_day_sin, {rnd('cos(2 * pi() * day(d) / 31)', 9)} AS date_day_cos FROM d"""


@query
def interactions(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("q"), F.col("l_extendedprice").alias("p"),
        F.col("l_discount").alias("d"), F.col("l_tax").alias("t"), (F.col("l_extendedprice") * F.col("l_tax")).alias("x"),
    )
    made = add_interactions(p, ["q", "p", "d", "t", "x"])
    new = [c for c in made.columns if c not in p.columns]
    return made.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *new)


_pairs = [("q", "p"), ("q", "d"), ("q", "t"), ("q", "x"), ("p", "d"), ("p", "t"), ("p", "x")]
SQL["interactions"] = f"""WITH b AS (SELECT *, l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t,
 l_extendedprice * l_tax AS x FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, """ + ", ".join(
    f"{a} * {b} AS {a}_x_{b}, {a} / ({b} + 1e-8::DOUBLE) AS {a}_div_{b}, {a} - {b} AS {a}_diff_{b}" for a, b in _pairs
) + " FROM b"


# --- moving windows --------------------------------------------------------------------------------


def _rolled(spark: SparkSession, sf: str, stats: list[str], digits: int) -> DataFrame:
    d = _orders(spark, sf).select("o_orderkey", "o_orderdate", F.sqrt("o_totalprice").alias("root_price"))
    out = rolling.rolling_stats(d, ["root_price"], _BY, stats=stats)
    new = [c for c in out.columns if "_rolling_" in c]
    return out.select("o_orderkey", *[r(c, digits).alias(c) for c in new])


def _over(fn: str, w: int, least: int = 1) -> str:
    frame = f"OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    value = f"{fn}(sqrt(o_totalprice)) {frame}"
    return value if least == 1 else f"CASE WHEN count(*) {frame} >= {least} THEN {value} END"


@query
def roll_basic(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled(spark, sf, ["mean", "std", "min", "max"], 6)


SQL["roll_basic"] = "SELECT o_orderkey, " + ", ".join(
    f"{rnd(_over(fn, w), 6)} AS root_price_rolling_{w}_{s}"
    for w in (7, 30, 90) for s, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
) + " FROM orders"


@query
def roll_median(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled(spark, sf, ["median"], 6)


SQL["roll_median"] = "SELECT o_orderkey, " + ", ".join(
    f"{rnd(_over('median', w), 6)} AS root_price_rolling_{w}_median" for w in (7, 30, 90)
) + " FROM orders"


@query
def roll_skew_kurt(spark: SparkSession, sf: str) -> DataFrame:
    return _rolled(spark, sf, ["skew", "kurt"], 5)


SQL["roll_skew_kurt"] = "SELECT o_orderkey, " + ", ".join(
    f"{rnd(_over(fn, w, n), 5)} AS root_price_rolling_{w}_{s}" for w in (7, 30, 90) for s, fn, n in (("skew", "skewness", 3), ("kurt", "kurtosis", 4))
) + " FROM orders"


@query
def roll_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """Moving statistics inside each customer."""
    d = _orders(spark, sf).select("o_custkey", "o_orderkey", "o_orderdate", F.sqrt("o_totalprice").alias("root_price"))
    out = rolling.rolling_stats(d, ["root_price"], _BY, windows=[7], stats=["mean", "median", "max"], partition_by=["o_custkey"])
    return out.select("o_custkey", "o_orderkey", *[r(c, 5).alias(c) for c in out.columns if "_rolling_" in c])


SQL["roll_by_group"] = "SELECT o_custkey, o_orderkey, " + ", ".join(
    f"{rnd(_over(fn, 7).replace('(ORDER', '(PARTITION BY o_custkey ORDER'), 5)} AS root_price_rolling_7_{s}" for s, fn in (("mean", "avg"), ("median", "median"), ("max", "max"))
) + " FROM orders"


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with missing and zero prices."""
    k = F.col("o_orderkey")
    price = F.when(k % 97 == 0, 0.0).when(k % 5 != 0, F.col("o_totalprice"))
    return _orders(spark, sf).select("o_orderkey", "o_orderdate", price.alias("price"))


_GAPPY = """WITH g AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE
 WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders)"""


@query
def roll_lag(spark: SparkSession, sf: str) -> DataFrame:
    out = rolling.lag_and_change(_gappy(spark, sf), ["price"], _BY)
    return out.select("o_orderkey", "price_lag_1", "price_lag_7", "price_lag_30")


SQL["roll_lag"] = f"{_GAPPY} SELECT o_orderkey, " + ", ".join(
    f"lag(price, {k}) OVER (ORDER BY o_orderdate, o_orderkey) AS price_lag_{k}" for k in (1, 7, 30)
) + " FROM g"


@query
def roll_pct_change(spark: SparkSession, sf: str) -> DataFrame:
    out = rolling.lag_and_change(_gappy(spark, sf), ["price"], _BY)
    return out.select("o_orderkey", *[r(f"price_pct_change_{k}", 6).alias(f"price_pct_change_{k}") for k in (1, 7, 30)])


SQL["roll_pct_change"] = f"""{_GAPPY}, f AS (SELECT o_orderkey, o_orderdate, last_value(price IGNORE NULLS) OVER
 (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM g) SELECT o_orderkey, """ + ", ".join(
    f"{rnd(f'p / nullif(lag(p, {k}) OVER (ORDER BY o_orderdate, o_orderkey), 0) - 1', 6)} AS price_pct_change_{k}" for k in (1, 7, 30)
) + " FROM f"


@query
def stat_zscore(spark: SparkSession, sf: str) -> DataFrame:
    out = rolling.zscore(_dirty_measures(spark, sf), ["sales_amount", "quantity"])
    return out.select("order_id", "l_linenumber", "l_partkey", r("sales_amount_zscore", 6).alias("sales_amount_zscore"), r("quantity_zscore", 6).alias("quantity_zscore"))


def _z(c: str) -> str:
    m = f"(SELECT avg({c}) FROM dirty)"
    return f"(coalesce({c}, {m}) - {m}) / (SELECT stddev_pop(coalesce({c}, {m})) FROM dirty)"


SQL["stat_zscore"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey, {rnd(_z('sales_amount'), 6)} AS sales_amount_zscore,
 {rnd(_z('quantity'), 6)} AS quantity_zscore FROM dirty"""


@query
def stat_percentile(spark: SparkSession, sf: str) -> DataFrame:
    d = stage(fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", "sales_amount", "quantity"), "dirty")
    out = rolling.percentile_rank(d, ["sales_amount", "quantity"])
    return out.select("order_id", "l_linenumber", "l_partkey", r("sales_amount_percentile", 9).alias("sales_amount_percentile"), r("quantity_percentile", 9).alias("quantity_percentile"))


def _pr(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER (ORDER BY {c} NULLS LAST) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / (SELECT count({c}) FROM dirty) END"


SQL["stat_percentile"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey, {rnd(_pr('sales_amount'), 9)} AS sales_amount_percentile,
 {rnd(_pr('quantity'), 9)} AS quantity_percentile FROM dirty"""


# --- business features -----------------------------------------------------------------------------


@query
def sales_business(spark: SparkSession, sf: str) -> DataFrame:
    out = business.sales_ratios(_dirty_measures(spark, sf))
    return out.select("order_id", "l_linenumber", "l_partkey", r("unit_price").alias("unit_price"), "high_value_sale", r("profit_margin", 6).alias("profit_margin"), "profitable")


SQL["sales_business"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey, {rnd('sales_amount / (quantity + 1e-8::DOUBLE)')} AS unit_price,
 CAST(coalesce(sales_amount > (SELECT quantile_cont(sales_amount, 0.9) FROM dirty), false) AS INTEGER) AS high_value_sale,
 {rnd('profit / (sales_amount + 1e-8::DOUBLE)', 6)} AS profit_margin, CAST(profit > 0 AS INTEGER) AS profitable FROM dirty"""


@query
def sales_region_stats(spark: SparkSession, sf: str) -> DataFrame:
    d = stage(fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", "region", "sales_amount"), "dirty")
    out = business.with_region_stats(d)
    return out.select("order_id", "l_linenumber", "l_partkey", "region", r("region_avg_sales").alias("region_avg_sales"), r("region_sales_std").alias("region_sales_std"), "region_sales_count")


SQL["sales_region_stats"] = f"""{DIRTY}, s AS (SELECT region, avg(sales_amount) AS a, stddev_samp(sales_amount) AS s, count(sales_amount) AS n
 FROM dirty WHERE region IS NOT NULL GROUP BY 1) SELECT order_id, l_linenumber, l_partkey, dirty.region, {rnd('a')} AS region_avg_sales,
 {rnd('s')} AS region_sales_std, n AS region_sales_count FROM dirty LEFT JOIN s ON dirty.region = s.region"""


def _money(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), 2) AS DOUBLE)"


_CUSTOMER_STATS = f"""SELECT customer_id, {_money('sum(sales_amount)')} AS sales_amount_sum, {_money('avg(sales_amount)')} AS sales_amount_mean,
 count(sales_amount) AS sales_amount_count, {_money('stddev_samp(sales_amount)')} AS sales_amount_std, {_money('sum(quantity)')} AS quantity_sum,
 {_money('avg(quantity)')} AS quantity_mean, {_money('sum(profit)')} AS profit_sum, {_money('avg(profit)')} AS profit_mean FROM sales GROUP BY 1"""


@query
def customer_stats(spark: SparkSession, sf: str) -> DataFrame:
    return business.customer_stats(fx.sales(spark, sf))


SQL["customer_stats"] = f"""{SALES}, c AS ({_CUSTOMER_STATS}) SELECT *, sales_amount_sum AS customer_lifetime_value,
 sales_amount_mean AS avg_order_value, sales_amount_count AS purchase_frequency FROM c"""


@query
def customer_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Customer statistics joined back to the sales rows."""
    s = stage(fx.sales(spark, sf).select("customer_id", "order_id", "l_linenumber", "l_partkey", "sales_amount", "quantity", "profit"), "sales")
    out = business.with_customer_stats(s)
    return out.select("customer_id", "order_id", "l_linenumber", "l_partkey", "customer_lifetime_value", "avg_order_value", "purchase_frequency")


SQL["customer_rows"] = f"""{SALES}, c AS ({_CUSTOMER_STATS}) SELECT s.customer_id, order_id, l_linenumber, l_partkey, sales_amount_sum AS customer_lifetime_value,
 sales_amount_mean AS avg_order_value, sales_amount_count AS purchase_frequency FROM sales s LEFT JOIN c ON s.customer_id = c.customer_id"""


@query
def value_segment(spark: SparkSession, sf: str) -> DataFrame:
    s = stage(fx.sales(spark, sf).select("customer_id", "order_id", "l_linenumber", "l_partkey", "sales_amount", "quantity", "profit"), "sales")
    return business.value_segment(business.with_customer_stats(s)).select("order_id", "l_linenumber", "l_partkey", "value_segment")


SQL["value_segment"] = f"""{SALES}, c AS ({_CUSTOMER_STATS}), v AS (SELECT order_id, l_linenumber, l_partkey, coalesce(sales_amount_sum, 0) AS v
 FROM sales s LEFT JOIN c ON s.customer_id = c.customer_id), q AS (SELECT quantile_cont(v, [0.25, 0.5, 0.75]) AS q FROM v)
 SELECT order_id, l_linenumber, l_partkey, CASE WHEN v <= q[1] THEN 'Low' WHEN v <= q[2] THEN 'Medium' WHEN v <= q[3] THEN 'High' ELSE 'Premium' END AS value_segment
 FROM v, q"""


# --- RFM -------------------------------------------------------------------------------------------

_RFM = f"""{SALES}, base AS (SELECT customer_id, CAST(floor((epoch_us((SELECT max(order_date) FROM sales)) - epoch_us(max(order_date))) / 86400000000) AS BIGINT) AS recency,
 count(*) AS frequency, {_money('sum(sales_amount)')} AS monetary FROM sales GROUP BY 1),
 ranked AS (SELECT *, row_number() OVER (ORDER BY recency, customer_id) - 1 AS rr, row_number() OVER (ORDER BY frequency, customer_id) - 1 AS fr,
 row_number() OVER (ORDER BY monetary, customer_id) - 1 AS mr, count(*) OVER () - 1 AS m FROM base),
 scores AS (SELECT customer_id, recency, frequency, monetary, CAST(6 - greatest(1, (5 * rr + m - 1) // m) AS INTEGER) AS r_score,
 CAST(greatest(1, (5 * fr + m - 1) // m) AS INTEGER) AS f_score, CAST(greatest(1, (5 * mr + m - 1) // m) AS INTEGER) AS m_score FROM ranked),
 labelled AS (SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score FROM scores),
 segments AS (SELECT *, CASE WHEN rfm_score IN ('555', '554', '544', '545', '454', '455', '445') THEN 'Champions'
 WHEN rfm_score IN ('543', '444', '435', '355', '354', '345', '344', '335') THEN 'Loyal Customers'
 WHEN rfm_score IN ('512', '511', '422', '421', '412', '411', '311') THEN 'Potential Loyalists'
 WHEN rfm_score IN ('522', '521', '431', '432', '441', '531') THEN 'New Customers'
 WHEN rfm_score IN ('155', '154', '144', '214', '215', '115', '114') THEN 'At Risk'
 WHEN rfm_score IN ('254') THEN 'Cannot Lose Them' ELSE 'Others' END AS customer_segment FROM labelled)"""


@query
def rfm_base(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.rfm_base(fx.sales(spark, sf))


SQL["rfm_base"] = f"{_RFM} SELECT * FROM base"


@query
def rfm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.rfm_scores(rfm.rfm_base(fx.sales(spark, sf)))


SQL["rfm_scores"] = f"{_RFM} SELECT * FROM labelled"


@query
def rfm_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rfm.rfm_segments(fx.sales(spark, sf))


SQL["rfm_segments"] = f"{_RFM} SELECT * FROM segments"


@query
def rfm_rows(spark: SparkSession, sf: str) -> DataFrame:
    s = stage(fx.sales(spark, sf).select("customer_id", "order_id", "l_linenumber", "l_partkey", "order_date", "sales_amount"), "sales")
    return rfm.with_rfm(s).select("customer_id", "order_id", "l_linenumber", "l_partkey", *rfm.RFM_COLUMNS)


SQL["rfm_rows"] = f"""{_RFM} SELECT s.customer_id, order_id, l_linenumber, l_partkey, recency, frequency, monetary, customer_segment
 FROM sales s LEFT JOIN segments g ON s.customer_id = g.customer_id"""


# --- outliers --------------------------------------------------------------------------------------

_OUT = ["sales_amount", "quantity", "profit"]


def _dirty_measures(spark: SparkSession, sf: str) -> DataFrame:
    # the rules read the measures several times: join once, then scan the narrow table
    return stage(fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", *_OUT), "measures")


def _flags(df: DataFrame) -> DataFrame:
    return df.select("order_id", "l_linenumber", "l_partkey", *[f"{c}_outlier" for c in _OUT])


@query
def outlier_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(outliers.flag_outliers(_dirty_measures(spark, sf), _OUT))


def _q(c: str, p: float) -> str:
    return f"(SELECT quantile_cont({c}, {p}) FROM dirty)"


def _iqr(c: str) -> str:
    width = f"1.5 * ({_q(c, 0.75)} - {_q(c, 0.25)})"
    return f"CAST(coalesce({c} < {_q(c, 0.25)} - {width} OR {c} > {_q(c, 0.75)} + {width}, false) AS INTEGER)"


SQL["outlier_iqr"] = f"{DIRTY} SELECT order_id, l_linenumber, l_partkey, " + ", ".join(f"{_iqr(c)} AS {c}_outlier" for c in _OUT) + " FROM dirty"


@query
def outlier_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(outliers.flag_outliers(_dirty_measures(spark, sf), _OUT, "zscore", 2.0))


SQL["outlier_zscore"] = f"{DIRTY} SELECT order_id, l_linenumber, l_partkey, " + ", ".join(f"CAST(abs({_z(c)}) > 2 AS INTEGER) AS {c}_outlier" for c in _OUT) + " FROM dirty"


@query
def outlier_modified_z(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(outliers.flag_outliers(_dirty_measures(spark, sf), _OUT, "modified_zscore", 2.5))


def _mz(c: str) -> str:
    m = f"(SELECT median({c}) FROM dirty)"
    return f"CAST(coalesce(abs(0.6745::DOUBLE * ({c} - {m}) / (SELECT mad({c}) FROM dirty)) > 2.5, false) AS INTEGER)"


SQL["outlier_modified_z"] = f"{DIRTY} SELECT order_id, l_linenumber, l_partkey, " + ", ".join(f"{_mz(c)} AS {c}_outlier" for c in _OUT) + " FROM dirty"


@query
def outlier_totals(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.outlier_totals(outliers.flag_outliers(_dirty_measures(spark, sf), _OUT))


SQL["outlier_totals"] = f"{DIRTY} " + " UNION ALL ".join(f"SELECT '{c}_outlier' AS flag, CAST(sum({_iqr(c)}) AS BIGINT) AS total FROM dirty" for c in _OUT)


# --- aggregates and dashboards ---------------------------------------------------------------------


@query
def daily_sales(spark: SparkSession, sf: str) -> DataFrame:
    return business.daily_sales(fx.sales(spark, sf)).select(F.date_format("date", "yyyy-MM-dd").alias("date"), r("sales_amount").alias("sales_amount"))


SQL["daily_sales"] = f"{SALES} SELECT strftime(date, '%Y-%m-%d') AS date, {rnd('sum(sales_amount)')} AS sales_amount FROM sales GROUP BY 1 ORDER BY 1"


@query
def agg_time_windows(spark: SparkSession, sf: str) -> DataFrame:
    t = business.time_windows(fx.sales(spark, sf))
    return t.select("unit", F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), r("sales_amount").alias("sales_amount"), "quantity", "n_rows")


SQL["agg_time_windows"] = f"{SALES} " + " UNION ALL ".join(
    f"SELECT '{u}' AS unit, strftime(date_trunc('{u}', date), '%Y-%m-%d') AS window_start, {rnd('sum(sales_amount)')} AS sales_amount, sum(quantity) AS quantity, count(*) AS n_rows FROM sales GROUP BY 2"
    for u in ("day", "week", "month")
)


@query
def dash_region(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.region_totals(fx.sales(spark, sf)).select("region", r("sales_amount").alias("sales_amount"))


SQL["dash_region"] = f"{SALES} SELECT region, {rnd('sum(sales_amount)')} AS sales_amount FROM sales GROUP BY 1"


@query
def dash_top_products(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.top_products(fx.sales(spark, sf)).select("product", r("sales_amount").alias("sales_amount"))


SQL["dash_top_products"] = f"{SALES} SELECT product, {rnd('sum(sales_amount)')} AS sales_amount FROM sales GROUP BY 1 ORDER BY sum(sales_amount) DESC, product LIMIT 10"


@query
def dash_months(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.month_histogram(fx.sales(spark, sf))


SQL["dash_months"] = f"{SALES} SELECT CAST(month(date) AS INTEGER) AS month, count(*) AS n_rows FROM sales GROUP BY 1"


@query
def dash_kpi(spark: SparkSession, sf: str) -> DataFrame:
    k = dashboards.kpi_total(fx.sales(spark, sf))
    return k.select(r("total_sales", 3).alias("total_sales"), r("reference_sales", 3).alias("reference_sales"), r("relative_delta", 6).alias("relative_delta"))


SQL["dash_kpi"] = f"{SALES}, t AS (SELECT sum(sales_amount) AS t FROM sales) SELECT {rnd('t', 3)} AS total_sales, {rnd('t * 0.9', 3)} AS reference_sales, {rnd('(t - t * 0.9) / (t * 0.9)', 6)} AS relative_delta FROM t"


@query
def dash_margin(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.margin_gauge(fx.sales(spark, sf)).select(r("profit_margin_pct", 6).alias("profit_margin_pct"))


SQL["dash_margin"] = f"{SALES} SELECT {rnd('sum(profit) / sum(sales_amount) * 100', 6)} AS profit_margin_pct FROM sales"


@query
def dash_segments(spark: SparkSession, sf: str) -> DataFrame:
    return dashboards.segment_counts(rfm.rfm_segments(fx.sales(spark, sf)))


SQL["dash_segments"] = f"{_RFM} SELECT customer_segment, count(*) AS n_customers FROM segments GROUP BY 1"


@query
def dash_rfm_points(spark: SparkSession, sf: str) -> DataFrame:
    p = dashboards.rfm_points(rfm.rfm_segments(fx.sales(spark, sf)))
    return p.select("customer_segment", "n_customers", *[r(c, 5).alias(c) for c in ("mean_recency", "mean_frequency", "mean_monetary")])


SQL["dash_rfm_points"] = f"""{_RFM} SELECT customer_segment, count(*) AS n_customers, {rnd('avg(recency)', 5)} AS mean_recency,
 {rnd('avg(frequency)', 5)} AS mean_frequency, {rnd('avg(monetary)', 5)} AS mean_monetary FROM segments GROUP BY 1"""


@query
def dash_clv_hist(spark: SparkSession, sf: str) -> DataFrame:
    c = stage(business.customer_stats(fx.sales(spark, sf)).select("customer_lifetime_value"), "clv")
    h = dashboards.histogram(c, "customer_lifetime_value")
    return h.select("bin", r("lower_edge").alias("lower_edge"), "n_rows")


SQL["dash_clv_hist"] = f"""{SALES}, c AS ({_CUSTOMER_STATS}), v AS (SELECT sales_amount_sum AS v FROM c),
 l AS (SELECT min(v) AS lo, max(v) AS hi FROM v), b AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 30)) + 1, 30) AS INTEGER) AS bin, lo, (hi - lo) / 30 AS w FROM v, l)
 SELECT bin, {rnd('lo + (bin - 1) * w')} AS lower_edge, count(*) AS n_rows FROM b GROUP BY bin, lo, w"""


@query
def dash_scatter_bins(spark: SparkSession, sf: str) -> DataFrame:
    s = stage(fx.sales(spark, sf).select("sales_amount", "profit"), "scatter")
    return dashboards.scatter_bins(s).select("x_bin", "y_bin", "n_rows", r(F.col("mean_y") * F.col("n_rows")).alias("sum_y"))


SQL["dash_scatter_bins"] = f"""{SALES}, l AS (SELECT min(sales_amount) AS x0, max(sales_amount) AS x1, min(profit) AS y0, max(profit) AS y1 FROM sales),
 b AS (SELECT CAST(least(floor((sales_amount - x0) / ((x1 - x0) / 40)) + 1, 40) AS INTEGER) AS x_bin,
 CAST(least(floor((profit - y0) / ((y1 - y0) / 40)) + 1, 40) AS INTEGER) AS y_bin, profit FROM sales, l)
 SELECT x_bin, y_bin, count(*) AS n_rows, {rnd('sum(profit)')} AS sum_y FROM b GROUP BY 1, 2"""


@query
def usage_analytics(spark: SparkSession, sf: str) -> DataFrame:
    u = dashboards.usage_analytics(fx.usage(spark, sf))
    return u.withColumn("last_accessed", F.date_format("last_accessed", "yyyy-MM-dd HH:mm:ss"))


SQL["usage_analytics"] = """WITH u AS (SELECT user_id % 10 AS workbook_id, user_id, ts FROM events WHERE event_type = 'view')
 SELECT workbook_id, count(*) AS total_views, count(DISTINCT user_id) AS unique_users,
 count(*) FILTER (ts > (SELECT max(ts) FROM u) - INTERVAL 7 DAY) AS views_last_week, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_accessed FROM u GROUP BY 1"""


@query
def sales_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sales cleaning chain on rows with gaps."""
    d = fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", "sales_amount", "quantity", "region", "date_text")
    out = clean_sales(stage(d, "dirty"))
    return out.select("order_id", "l_linenumber", "l_partkey", r("sales_amount").alias("sales_amount"), "quantity", "region", F.date_format("date_text", "yyyy-MM-dd").alias("date_text"))


SQL["sales_cleaned"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey, {rnd('coalesce(sales_amount, (SELECT median(sales_amount) FROM dirty))')} AS sales_amount,
 coalesce(quantity, (SELECT median(quantity) FROM dirty)) AS quantity,
 coalesce(region, (SELECT region FROM dirty WHERE region IS NOT NULL GROUP BY region ORDER BY count(*) DESC, region LIMIT 1)) AS region,
 strftime(TRY_CAST(date_text AS TIMESTAMP), '%Y-%m-%d') AS date_text FROM dirty"""
