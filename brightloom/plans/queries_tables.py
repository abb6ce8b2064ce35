"""Queries for sources, sinks, cleaning, quality and reports, each with its comparison SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom import fixtures as fx
from brightloom.functions.expressions import mask_pii, source_key
from brightloom.operators import cleaning, quality, reports
from brightloom.plans.rounding import r
from brightloom.plans.sqltext import DIRTY, SALES, rnd
from brightloom.sources import generators, readers, sinks
from brightloom.staging import stage, stage_path
from brightloom.unions import union_all

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- sources ---------------------------------------------------------------------------------------


@query
def src_csv_union(spark: SparkSession, sf: str) -> DataFrame:
    folder = stage_path(spark, "csv")
    for name, keep in (("supplier", ["s_suppkey", "s_name", "s_acctbal"]), ("customer", ["c_custkey", "c_name", "c_acctbal"])):
        t = fx.table(spark, sf, name).select(*keep).toDF("id", "name", f"{name}_balance")
        t.write.mode("append").option("header", True).csv(folder)
    df = readers.read_csv_dir(spark, folder)
    return df.select(
        F.col("id").cast("long").alias("id"), "name", "supplier_balance", "customer_balance",
        F.col("source_file").endswith(".csv").cast("int").alias("has_file"),
        F.col("extraction_timestamp").isNotNull().cast("int").alias("has_time"),
    )


SQL["src_csv_union"] = """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS supplier_balance,
 NULL::DOUBLE AS customer_balance, 1 AS has_file, 1 AS has_time FROM supplier
 UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal, 1, 1 FROM customer"""


@query
def src_table_query(spark: SparkSession, sf: str) -> DataFrame:
    fx.table(spark, sf, "orders").createOrReplaceTempView("brightloom_orders")
    df = readers.read_table(
        spark,
        query="SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM brightloom_orders WHERE o_orderstatus = 'F'",
    )
    return df.drop("extraction_timestamp")


SQL["src_table_query"] = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'"


@query
def src_blob_formats(spark: SparkSession, sf: str) -> DataFrame:
    part = fx.table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    found = []
    for kind in readers.FORMATS:
        path = stage_path(spark, f"blob-{kind}")
        writer = part.write.option("header", True) if kind == "csv" else part.write
        writer.format(kind).save(path)
        df = readers.read_blob(spark, path, kind.upper())
        found.append(df.select(
            F.lit(kind).alias("format"), F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_retailprice",
            F.col("source_blob").contains(f"blob-{kind}").cast("int").alias("from_blob"),
        ))
    return union_all(*found)


SQL["src_blob_formats"] = """SELECT f.format, p_partkey, p_name, p_retailprice, 1 AS from_blob
 FROM part CROSS JOIN (VALUES ('parquet'), ('csv'), ('json')) f(format)"""


@query
def src_extract_all(spark: SparkSession, sf: str) -> DataFrame:
    def opener(name: str):
        return lambda s: fx.table(s, sf, name)

    names = ["orders", "customer", "lineitem", "events", "no_such_table"]
    _, status = readers.extract_all(spark, {n: opener(n) for n in names})
    return status.select("source", "status", "records", F.col("error").isNotNull().cast("int").alias("has_error"))


SQL["src_extract_all"] = """SELECT 'orders' AS source, 'ok' AS status, (SELECT count(*) FROM orders) AS records, 0 AS has_error
 UNION ALL SELECT 'customer', 'ok', (SELECT count(*) FROM customer), 0
 UNION ALL SELECT 'lineitem', 'ok', (SELECT count(*) FROM lineitem), 0
 UNION ALL SELECT 'events', 'ok', (SELECT count(*) FROM events), 0
 UNION ALL SELECT 'no_such_table', 'failed', 0, 1"""


def _u(key: str, salt: str, place: int) -> str:
    return f"(CAST(('0x' || substr(md5({key} || ':{salt}'), {1 + 8 * place}, 8)) AS BIGINT) / 4294967296::DOUBLE)"


def _normal(u: str, v: str) -> str:
    return f"(sqrt(-2 * ln(1 - {u})) * cos(2 * pi() * {v}))"


def _pick(u: str, options: list[str]) -> str:
    items = ", ".join("'" + o + "'" for o in options)
    return f"([{items}])[CAST(floor({u} * {len(options)}) AS INTEGER) + 1]"


def _poisson(u: str, mean: float) -> str:
    steps = generators.poisson_steps(mean)
    return "CASE " + " ".join(f"WHEN {u} < {s!r}::DOUBLE THEN {k}" for k, s in enumerate(steps)) + f" ELSE {len(steps)} END"


@query
def gen_sales(spark: SparkSession, sf: str) -> DataFrame:
    ids = fx.table(spark, sf, "orders").select("o_orderkey")
    g = generators.synthetic_sales(ids, "o_orderkey")
    return g.withColumns(
        {"date": F.date_format("date", "yyyy-MM-dd"), "sales_amount": r("sales_amount"), "profit": r("profit")}
    )


_s = [_u("CAST(o_orderkey AS VARCHAR)", salt, i) for salt in ("sa", "sb", "sc") for i in range(4)]
SQL["gen_sales"] = f"""WITH b AS (SELECT DATE '2020-01-01' + CAST(floor({_s[0]} * 1461) AS INTEGER) AS date,
 {_pick(_s[1], generators.REGIONS)} AS region, {_pick(_s[2], generators.PRODUCTS)} AS product,
 {_pick(_s[3], generators.CATEGORIES)} AS category, exp(6 + {_normal(_s[4], _s[5])}) AS amount,
 CAST({_poisson(_s[6], 5.0)} AS BIGINT) + 1 AS quantity, CAST(floor({_s[7]} * 9999) AS BIGINT) + 1 AS customer_id,
 o_orderkey AS order_id, 0.15::DOUBLE + {_s[8]} * 0.1::DOUBLE AS margin FROM orders),
 c AS (SELECT *, CAST(month(date) AS INTEGER) AS m, 1 + 0.3::DOUBLE * sin(2 * pi() * (month(date) - 1) / 12) AS season FROM b)
 SELECT strftime(date, '%Y-%m-%d') AS date, region, product, category, {rnd('amount * season')} AS sales_amount, quantity,
 customer_id, order_id, {rnd('amount * margin * season')} AS profit, m AS month FROM c"""


@query
def gen_customers(spark: SparkSession, sf: str) -> DataFrame:
    ids = fx.table(spark, sf, "customer").select("c_custkey")
    g = generators.synthetic_customers(ids, "c_custkey", ids.count())
    texts = {c: F.date_format(c, "yyyy-MM-dd") for c in ("registration_date", "last_purchase_date")}
    numbers = ["total_spent", "avg_order_value", "customer_lifetime_value", "satisfaction_score", "churn_probability", "frequency", "monetary"]
    return g.withColumns({**texts, **{c: r(c) for c in numbers}})


_c = [_u("CAST(c_custkey AS VARCHAR)", salt, i) for salt in ("ca", "cb", "cc", "cd", "ce") for i in range(4)]
_share = "(c_custkey / CAST(greatest((SELECT count(*) FROM customer) - 1, 1) AS DOUBLE))"
SQL["gen_customers"] = f"""WITH b AS (SELECT c_custkey AS customer_id, {_pick(_c[0], generators.CUSTOMER_SEGMENTS)} AS customer_segment,
 {_pick(_c[1], generators.CHANNELS)} AS acquisition_channel, {_pick(_c[2], generators.COUNTRIES)} AS country,
 DATE '2020-01-01' + CAST(floor({_share} * 1460) AS INTEGER) AS registration_date,
 DATE '2023-01-01' + CAST(floor({_share} * 364) AS INTEGER) AS last_purchase_date,
 CAST({_poisson(_c[3], 8.0)} AS BIGINT) + 1 AS total_orders, exp(7 + {_normal(_c[4], _c[5])}) AS total_spent,
 exp(4 + 0.5::DOUBLE * {_normal(_c[6], _c[7])}) AS avg_order_value, exp(8 + {_normal(_c[8], _c[9])}) AS customer_lifetime_value,
 least(greatest(7.5::DOUBLE + 1.5::DOUBLE * {_normal(_c[10], _c[11])}, 1), 10) AS satisfaction_score,
 list_sort([{', '.join(_c[12:18])}])[2] AS churn_probability FROM customer)
 SELECT customer_id, customer_segment, acquisition_channel, country, strftime(registration_date, '%Y-%m-%d') AS registration_date,
 strftime(last_purchase_date, '%Y-%m-%d') AS last_purchase_date, total_orders, {rnd('total_spent')} AS total_spent,
 {rnd('avg_order_value')} AS avg_order_value, {rnd('customer_lifetime_value')} AS customer_lifetime_value,
 {rnd('satisfaction_score')} AS satisfaction_score, {rnd('churn_probability')} AS churn_probability,
 CAST(DATE '2023-12-31' - last_purchase_date AS BIGINT) AS recency,
 {rnd("total_orders / ((last_purchase_date - registration_date) / 365::DOUBLE + 0.1::DOUBLE)")} AS frequency,
 {rnd('total_spent')} AS monetary FROM b"""


@query
def gen_series(spark: SparkSession, sf: str) -> DataFrame:
    g = generators.synthetic_series(fx.table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    return g.select("series_id", F.col("ds").cast("string").alias("ds"), r("y").alias("y"))


_k = "(CAST(s_suppkey AS VARCHAR) || ':' || CAST(i AS VARCHAR))"
SQL["gen_series"] = f"""SELECT CAST(s_suppkey AS VARCHAR) AS series_id,
 strftime(DATE '2020-01-01' + CAST(i AS INTEGER), '%Y-%m-%d') AS ds,
 {rnd(f"1000 + 500::DOUBLE * i / 1460 + 200 * sin(2 * pi() * i / 365) + 50 * {_normal(_u(_k, 'ds', 0), _u(_k, 'ds', 1))}")} AS y
 FROM supplier CROSS JOIN range(1461) d(i)"""


# --- sinks -----------------------------------------------------------------------------------------


@query
def sink_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sink-parquet")
    sinks.write_parquet(fx.table(spark, sf, "lineitem"), path, partition_by=["l_returnflag"])
    back = spark.read.parquet(path)
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), r(F.sum("l_quantity")).alias("quantity"), r(F.sum("l_extendedprice"), 2).alias("price")
    )


SQL["sink_parquet_roundtrip"] = f"""SELECT l_returnflag, l_linestatus, count(*) AS n_rows, {rnd('sum(l_quantity)')} AS quantity,
 {rnd('sum(l_extendedprice)', 2)} AS price FROM lineitem GROUP BY 1, 2"""


@query
def sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sink-csv")
    customer = fx.table(spark, sf, "customer")
    sinks.write_csv(customer, path)
    return spark.read.option("header", True).schema(customer.schema).csv(path)


SQL["sink_csv_roundtrip"] = "SELECT * FROM customer"


@query
def sink_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sink-json")
    dirty = fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "quantity", "region", "date_text")
    sinks.write_json(dirty, path)
    return spark.read.schema(dirty.schema).json(path)


SQL["sink_json_roundtrip"] = f"{DIRTY} SELECT order_id, l_linenumber, quantity, region, date_text FROM dirty"


@query
def bi_schema(spark: SparkSession, sf: str) -> DataFrame:
    sales = fx.sales(spark, sf)
    counts = quality.column_counts(sales).withColumnRenamed("column", "name")
    return sinks.bi_schema(sales).join(counts, "name")


_types = [
    ("date", "DateTime"), ("order_date", "DateTime"), ("region", "String"), ("product", "String"), ("category", "String"),
    ("sales_amount", "Double"), ("quantity", "Double"), ("profit", "Double"), ("customer_id", "Int64"), ("order_id", "Int64"),
    ("l_linenumber", "Int64"), ("l_partkey", "Int64"), ("l_suppkey", "Int64"), ("l_shipdate", "DateTime"), ("l_extendedprice", "Double"),
]
SQL["bi_schema"] = f"{SALES} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS name, '{t}' AS data_type, (SELECT count({n}) FROM sales) AS n_values" for i, (n, t) in enumerate(_types)
)


@query
def bi_push_batches(spark: SparkSession, sf: str) -> DataFrame:
    sales = fx.sales(spark, sf)
    batches = sinks.push_batches(sales, fx.SALES_ORDER)
    order_id = F.get_json_object("payload", "$.order_id").cast("long")
    return batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(order_id).alias("min_order"), F.max(order_id).alias("max_order"),
        F.sum(order_id).alias("sum_order"), F.count_if(F.get_json_object("payload", "$.date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T")).alias("iso_dates"),
    )


_order = ", ".join(fx.SALES_ORDER)
SQL["bi_push_batches"] = f"""{SALES}, n AS (SELECT order_id, row_number() OVER (ORDER BY {_order}) - 1 AS rn FROM sales)
 SELECT CAST(rn // 10000 AS BIGINT) AS batch_id, count(*) AS n_rows, min(order_id) AS min_order, max(order_id) AS max_order,
 CAST(sum(order_id) AS BIGINT) AS sum_order, count(*) AS iso_dates FROM n GROUP BY 1"""


@query
def bi_extract_head(spark: SparkSession, sf: str) -> DataFrame:
    head = sinks.extract_head(fx.sales(spark, sf), fx.SALES_ORDER)
    return head.select("order_id", "l_linenumber", "region", "product", r("sales_amount").alias("sales_amount"))


SQL["bi_extract_head"] = f"""{SALES} SELECT order_id, l_linenumber, region, product, {rnd('sales_amount')} AS sales_amount
 FROM (SELECT * FROM sales ORDER BY {_order} LIMIT 10000)"""


# --- cleaning --------------------------------------------------------------------------------------


@query
def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias("Full-Name"), F.col("c_acctbal").alias("Account Balance-USD")
    )
    return cleaning.clean_names(t)


SQL["clean_names"] = "SELECT c_custkey AS customer_id, c_name AS full_name, c_acctbal AS account_balance_usd FROM customer"


@query
def clean_median_impute(spark: SparkSession, sf: str) -> DataFrame:
    d = stage(fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", "sales_amount", "quantity", "profit"), "dirty")
    out = cleaning.impute_median(d, ["sales_amount", "quantity", "profit"])
    return out.select("order_id", "l_linenumber", "l_partkey", r("sales_amount").alias("sales_amount"), r("quantity").alias("quantity"), r("profit").alias("profit"))


SQL["clean_median_impute"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey,
 {rnd('coalesce(sales_amount, (SELECT median(sales_amount) FROM dirty))')} AS sales_amount,
 {rnd('coalesce(quantity, (SELECT median(quantity) FROM dirty))')} AS quantity, {rnd('profit')} AS profit FROM dirty"""


def _skewed(d: DataFrame) -> DataFrame:
    """A right-skewed column (median fill), a left-skewed one and a symmetric one (mean fill)."""
    x = F.col("sales_amount") / 10000
    return d.select("order_id", "l_linenumber", "l_partkey", (x * x * x).alias("right_tail"), (-x * x * x).alias("left_tail"), "quantity", "profit")


@query
def clean_skew_impute(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["right_tail", "left_tail", "quantity", "profit"]
    out = cleaning.impute_by_skew(stage(_skewed(fx.sales_dirty(spark, sf)), "dirty"), cols)
    return out.select("order_id", "l_linenumber", "l_partkey", *[r(c).alias(c) for c in cols])


def _skew_fill(c: str) -> str:
    g1 = f"(SELECT avg(power({c} - (SELECT avg({c}) FROM s), 3)) / power(var_pop({c}), 1.5) FROM s)"
    return f"coalesce({c}, CASE WHEN {g1} > 1 THEN (SELECT median({c}) FROM s) ELSE (SELECT avg({c}) FROM s) END)"


SQL["clean_skew_impute"] = f"""{DIRTY}, s AS (SELECT order_id, l_linenumber, l_partkey, (sales_amount / 10000) * (sales_amount / 10000) * (sales_amount / 10000) AS right_tail,
 -(sales_amount / 10000) * (sales_amount / 10000) * (sales_amount / 10000) AS left_tail, quantity, profit FROM dirty)
 SELECT order_id, l_linenumber, l_partkey, {', '.join(f"{rnd(_skew_fill(c))} AS {c}" for c in ('right_tail', 'left_tail', 'quantity', 'profit'))} FROM s"""


@query
def clean_mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.sales_dirty(spark, sf).select("order_id", "l_linenumber", "l_partkey", "region", "product")
    d = stage(d.withColumn("channel", F.lit(None).cast("string")), "dirty")
    out = cleaning.impute_mode(d, ["region", "product", "channel"])
    return out.select("order_id", "l_linenumber", "l_partkey", "region", "product", "channel")


SQL["clean_mode_impute"] = f"""{DIRTY}, m AS (SELECT region FROM dirty WHERE region IS NOT NULL GROUP BY region ORDER BY count(*) DESC, region LIMIT 1)
 SELECT order_id, l_linenumber, l_partkey, coalesce(region, (SELECT region FROM m)) AS region, product, 'Unknown' AS channel FROM dirty"""


@query
def clean_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates in five written forms, and text that is none."""
    d = fx.sales_dirty(spark, sf)
    at = F.col("date_text").try_cast("timestamp_ntz")
    forms = ["yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "yyyyMMdd", "MMM d, yyyy", "d MMMM yyyy"]
    written = F.coalesce(*[F.when(F.col("order_id") % 5 == i, F.date_format(at, f)) for i, f in enumerate(forms)], F.col("date_text"))
    out = cleaning.parse_dates(d.withColumn("date_text", written))
    return out.select("order_id", "l_linenumber", "l_partkey", F.date_format("date_text", "yyyy-MM-dd HH:mm:ss").alias("date_text"))


SQL["clean_parse_dates"] = f"""{DIRTY} SELECT order_id, l_linenumber, l_partkey,
 strftime(TRY_CAST(date_text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date_text FROM dirty"""


@query
def clean_date_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Three columns of the same dates: the day first, the month first, and the day first but for every ninth order."""
    d = fx.sales(spark, sf).select("order_id", "l_linenumber", "l_partkey", F.col("date").cast("timestamp_ntz").alias("at"))
    form = lambda f: F.date_format("at", f)
    mixed = F.when((F.col("order_id") % 9 == 0) & (F.dayofmonth("at") > 12), form("MM-dd-yyyy")).otherwise(form("dd-MM-yyyy"))
    out = cleaning.parse_dates(d.select("order_id", "l_linenumber", "l_partkey", form("d/M/yyyy").alias("date_day"), form("M/d/yyyy").alias("date_month"), mixed.alias("date_mixed")))
    return out.select("order_id", "l_linenumber", "l_partkey", *[F.to_date(c).cast("string").alias(c) for c in ("date_day", "date_month", "date_mixed")])


SQL["clean_date_orders"] = f"""{SALES}, t AS (SELECT order_id, l_linenumber, l_partkey, strftime(CAST(date AS DATE), '%Y-%m-%d') AS d FROM sales)
 SELECT order_id, l_linenumber, l_partkey, d AS date_day, d AS date_month, d AS date_mixed FROM t"""


@query
def mask_pii_documents(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select("doc_id", mask_pii(F.col("text")).alias("masked"))


def _masked(c: str) -> str:
    patterns = (
        ("credit_card", r"\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b"), ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
        ("phone", r"\+?[0-9]{0,3}[-. ]?\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}\b"), ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    )
    for kind, pattern in patterns:
        c = f"regexp_replace({c}, '{pattern}', '[{kind.upper()}]', 'g')"
    return c


QUERIES["mask_pii"] = QUERIES.pop("mask_pii_documents")
SQL["mask_pii"] = f"SELECT doc_id, {_masked('text')} AS masked FROM documents"


@query
def source_key_lineage(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "documents")
    key = source_key(F.col("source"), [("lang", F.col("lang")), ("doc", F.col("doc_id"))])
    return d.select("doc_id", key.alias("source_key"))


QUERIES["source_key"] = QUERIES.pop("source_key_lineage")
SQL["source_key"] = """SELECT doc_id, md5(source || ':{"doc":' || doc_id || ',"lang":"' || lang || '"}') AS source_key FROM documents"""


# --- quality ---------------------------------------------------------------------------------------

_Q_COLS = ["sales_amount", "quantity", "profit", "region", "product", "category"]


@query
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    q = quality.quality_score(fx.sales_dirty(spark, sf).select(*_Q_COLS))
    return q.select("rows", "cells", "null_cells", *[r(c, 8).alias(c) for c in ("completeness", "source_score", "overall_score")])


_NULLS = " + ".join(f"count(*) - count({c})" for c in _Q_COLS)
SQL["quality_score"] = f"""{DIRTY}, n AS (SELECT count(*) AS rows, count(*) * 6 AS cells, {_NULLS} AS null_cells FROM dirty)
 SELECT rows, cells, null_cells, {rnd('1 - null_cells / cells', 8)} AS completeness,
 {rnd('(1 - null_cells / cells) * 0.5 + 0.5', 8)} AS source_score, {rnd('(1 - null_cells / cells) * 0.4 + 0.6', 8)} AS overall_score FROM n"""


@query
def nulls_handled(spark: SparkSession, sf: str) -> DataFrame:
    d = stage(fx.sales_dirty(spark, sf).select(*_Q_COLS), "dirty")
    return cleaning.nulls_handled(d, cleaning.clean_sales(d))


SQL["nulls_handled"] = f"{DIRTY} SELECT {_NULLS} AS nulls_before, CAST(0 AS BIGINT) AS nulls_after, {_NULLS} AS nulls_handled FROM dirty"


@query
def quality_alert(spark: SparkSession, sf: str) -> DataFrame:
    q = quality.quality_alert(fx.sales(spark, sf).select(*_Q_COLS), fx.sales_dirty(spark, sf).select(*_Q_COLS))
    return q.select(*[r(c, 8).alias(c) for c in ("baseline_score", "current_score", "score_drop")], "degraded", "below_minimum")


SQL["quality_alert"] = f"""{DIRTY}, n AS (SELECT ({_NULLS}) / (count(*) * 6) AS gone FROM dirty)
 SELECT 1.0::DOUBLE AS baseline_score, {rnd('(1 - gone) * 0.4 + 0.6', 8)} AS current_score, {rnd('gone * 0.4', 8)} AS score_drop,
 CAST(gone * 0.4 > 0.05 AS INTEGER) AS degraded, CAST((1 - gone) * 0.4 + 0.6 < 0.95 AS INTEGER) AS below_minimum FROM n"""


@query
def expect_fit(spark: SparkSession, sf: str) -> DataFrame:
    e = quality.fit_expectations(stage(fx.sales_dirty(spark, sf).select(*_Q_COLS), "dirty"))
    return e.select("column", "kind", r("lo").alias("lo"), r("hi").alias("hi"), F.array_join("value_set", "|").alias("value_set"), "mostly")


def _fit_sql(table: str) -> str:
    parts = []
    for c in ("sales_amount", "quantity", "profit"):
        parts.append(f"SELECT '{c}' AS \"column\", 'between' AS kind, {rnd(f'quantile_cont({c}, 0.01)')} AS lo, {rnd(f'quantile_cont({c}, 0.99)')} AS hi, NULL::VARCHAR AS value_set, 0.95::DOUBLE AS mostly FROM {table}")
        parts.append(f"SELECT '{c}', 'not_null', NULL, NULL, NULL, 0.8::DOUBLE")
    for c in ("region", "product", "category"):
        parts.append(f"SELECT '{c}', 'not_null', NULL, NULL, NULL, 0.7::DOUBLE")
        parts.append(f"SELECT '{c}', 'in_set', NULL, NULL, string_agg(DISTINCT {c}, '|' ORDER BY {c}), NULL FROM {table} HAVING count(DISTINCT {c}) < 50")
    return " UNION ALL ".join(parts)


SQL["expect_fit"] = f"{DIRTY} {_fit_sql('dirty')}"


def _drifted(d: DataFrame) -> DataFrame:
    """Later data: amounts doubled and one region renamed, on top of the gaps."""
    return d.withColumns(
        {"sales_amount": F.col("sales_amount") * 2, "region": F.when(F.col("region") == "ASIA", "APAC").otherwise(F.col("region"))}
    )


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    learned = quality.fit_expectations(stage(fx.sales(spark, sf).select(*_Q_COLS), "sales"))
    return quality.validate(_drifted(fx.sales_dirty(spark, sf).select(*_Q_COLS)), learned)


@query
def expect_validate(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf)


def _validate_sql() -> str:
    parts = []
    for c in ("sales_amount", "quantity", "profit"):
        lo, hi = f"(SELECT quantile_cont({c}, 0.01) FROM sales)", f"(SELECT quantile_cont({c}, 0.99) FROM sales)"
        parts.append(f"SELECT '{c}' AS \"column\", 'between' AS kind, count({c}) AS checked, count(*) FILTER ({c} BETWEEN {lo} AND {hi}) AS passed_rows, 0.95 AS mostly FROM later")
        parts.append(f"SELECT '{c}', 'not_null', count(*), count({c}), 0.8 FROM later")
    for c in ("region", "product", "category"):
        parts.append(f"SELECT '{c}', 'not_null', count(*), count({c}), 0.7 FROM later")
        parts.append(f"SELECT '{c}', 'in_set', count({c}), count(*) FILTER ({c} IN (SELECT {c} FROM sales)), 1.0 FROM later HAVING (SELECT count(DISTINCT {c}) FROM sales) < 50")
    return f"""{DIRTY}, later AS (SELECT sales_amount * 2 AS sales_amount, quantity, profit,
 CASE WHEN region = 'ASIA' THEN 'APAC' ELSE region END AS region, product, category FROM dirty), v AS ({' UNION ALL '.join(parts)})"""


SQL["expect_validate"] = f"""{_validate_sql()} SELECT "column", kind, checked, passed_rows,
 CAST(checked = 0 OR passed_rows / checked >= mostly AS INTEGER) AS success FROM v"""


@query
def expect_score(spark: SparkSession, sf: str) -> DataFrame:
    s = quality.validation_score(_validated(spark, sf))
    return s.withColumn("validation_score", r("validation_score", 8))


SQL["expect_score"] = f"""{_validate_sql()}, s AS (SELECT CAST(checked = 0 OR passed_rows / checked >= mostly AS INTEGER) AS success FROM v)
 SELECT CAST(sum(success) AS BIGINT) AS success_count, count(*) AS total_expectations, {rnd('sum(success) / count(*)', 8)} AS validation_score FROM s"""


@query
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    old = fx.table(spark, sf, "orders")
    new = old.withColumn("o_custkey", F.col("o_custkey").cast("string")).drop("o_orderpriority").withColumn("o_channel", F.lit("web"))
    return quality.schema_drift(old, new).join(quality.column_counts(new), "column", "left").withColumn("n_values", F.coalesce("n_values", F.lit(0)))


SQL["schema_drift"] = """SELECT * FROM (VALUES ('o_orderkey', 'bigint', 'bigint', 'same'), ('o_custkey', 'bigint', 'string', 'retyped'),
 ('o_orderstatus', 'string', 'string', 'same'), ('o_totalprice', 'double', 'double', 'same'),
 ('o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same')) a("column", old_type, new_type, change), (SELECT count(*) AS n_values FROM orders) n
 UNION ALL SELECT 'o_orderpriority', 'string', NULL, 'removed', 0
 UNION ALL SELECT 'o_channel', NULL, 'string', 'added', count(*) FROM orders"""


@query
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    f = quality.freshness(fx.events(spark, sf), "ts", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), 24 * 60, ["event_type"])
    return f.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


SQL["freshness"] = """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest,
 CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 60000000) AS BIGINT) AS age_minutes,
 CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 60000000) > 1440 AS INTEGER) AS stale FROM events GROUP BY 1"""


# --- reports ---------------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Metric rows per (event type, day): the run records the reports read."""
    e = fx.events(spark, sf)
    return e.groupBy(F.concat_ws("-", "event_type", F.date_format("ts", "yyyyMMdd")).alias("source")).agg(
        F.count(F.lit(1)).alias("records"), (F.sum("value") / 1024).alias("size_mb"), (F.count(F.lit(1)) * 0.25).alias("seconds"),
        F.try_divide(F.count_if(F.col("value") > 20), F.count(F.lit(1))).alias("quality"),
    )


_RUNS = """WITH runs AS (SELECT event_type || '-' || strftime(ts, '%Y%m%d') AS source, count(*) AS records, sum(value) / 1024 AS size_mb,
 count(*) * 0.25::DOUBLE AS seconds, count(*) FILTER (value > 20) / count(*) AS quality FROM events GROUP BY 1)"""


@query
def report_extraction(spark: SparkSession, sf: str) -> DataFrame:
    rep = reports.extraction_report(_runs(spark, sf))
    return rep.select("total_sources", "total_records", *[r(c, 6).alias(c) for c in ("total_size_mb", "average_quality_score", "total_extraction_time")])


SQL["report_extraction"] = f"""{_RUNS} SELECT count(*) AS total_sources, CAST(sum(records) AS BIGINT) AS total_records, {rnd('sum(size_mb)', 6)} AS total_size_mb,
 {rnd('avg(quality)', 6)} AS average_quality_score, {rnd('sum(seconds)', 6)} AS total_extraction_time FROM runs"""


@query
def report_transform(spark: SparkSession, sf: str) -> DataFrame:
    m = _runs(spark, sf).select(
        F.col("source").alias("operation"), F.col("records").alias("input_records"), F.col("records").alias("output_records"),
        "seconds", (F.col("records") % 7).alias("features_created"), (F.col("quality") / 8).alias("improvement"),
    )
    return reports.transform_report(m).withColumn("total_processing_time", r("total_processing_time", 6))


SQL["report_transform"] = f"""{_RUNS} SELECT count(*) AS total_operations, CAST(sum(records) AS BIGINT) AS total_input_records,
 CAST(sum(records) AS BIGINT) AS total_output_records, {rnd('sum(seconds)', 6)} AS total_processing_time,
 CAST(sum(records % 7) AS BIGINT) AS total_features_created, round(sum(records) / sum(seconds), 0) AS average_processing_speed,
 round(avg(quality / 8), 3) AS data_quality_improvement FROM runs"""


@query
def report_publish(spark: SparkSession, sf: str) -> DataFrame:
    results = fx.events(spark, sf).groupBy(F.col("user_id").alias("platform")).agg(
        F.count_if(F.col("event_type") == "view").alias("dashboards"),
        F.max(F.when((F.col("event_type") == "error") & (F.col("value") > 100), F.lit("upload failed"))).alias("error"),
    )
    return reports.publish_report(results)


SQL["report_publish"] = """WITH p AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS d,
 max(CASE WHEN event_type = 'error' AND value > 100 THEN 'x' END) AS e FROM events GROUP BY 1),
 s AS (SELECT count(*) FILTER (e IS NULL) AS platforms_used, CAST(coalesce(sum(d) FILTER (e IS NULL), 0) AS BIGINT) AS n FROM p)
 SELECT platforms_used, n AS dashboards_created, n * 4.5::DOUBLE AS time_saved_hours,
 CASE WHEN n > 0 THEN '90.0%' ELSE '0%' END AS productivity_improvement FROM s"""


@query
def report_workflow(spark: SparkSession, sf: str) -> DataFrame:
    stages = fx.events(spark, sf).select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("stage"), F.col("value").alias("seconds"),
        F.when(F.col("event_id") % 10 == 0, "failed").when(F.col("event_id") % 10 == 1, "skipped").otherwise("completed").alias("status"),
    )
    rep = reports.workflow_report(stages)
    return rep.withColumns({"success_rate": r("success_rate", 8), "duration_seconds": r("duration_seconds")})


SQL["report_workflow"] = f"""SELECT user_id AS run_id, count(*) AS stages_enabled, count(*) FILTER (event_id % 10 > 1) AS stages_completed,
 {rnd('count(*) FILTER (event_id % 10 > 1) / count(*)', 8)} AS success_rate, {rnd('sum(value)')} AS duration_seconds,
 count(*) FILTER (event_id % 10 = 0) AS error_count FROM events GROUP BY 1"""


@query
def metric_summary(spark: SparkSession, sf: str) -> DataFrame:
    m = reports.metric_summary(fx.host_samples(spark, sf))
    return m.select(*[r(c, 6).alias(c) for c in m.columns[:4]], "total_monitoring_points")


SQL["metric_summary"] = f"""SELECT {rnd('avg(value % 100)', 6)} AS avg_cpu_percent, {rnd('max(value % 100)', 6)} AS max_cpu_percent,
 {rnd('avg(value * 16)', 6)} AS avg_memory_mb, {rnd('max(value * 16)', 6)} AS peak_memory_mb, count(*) AS total_monitoring_points FROM events"""


@query
def health_rule(spark: SparkSession, sf: str) -> DataFrame:
    return reports.health(fx.host_samples(spark, sf)).select("event_id", "cpu_healthy", "memory_healthy", "disk_healthy", "overall_healthy")


SQL["health_rule"] = """WITH h AS (SELECT event_id, value % 100 < 80 AS c, (value * 3) % 100 < 85 AS m, (value * 7) % 100 < 90 AS d FROM events)
 SELECT event_id, CAST(c AS INTEGER) AS cpu_healthy, CAST(m AS INTEGER) AS memory_healthy, CAST(d AS INTEGER) AS disk_healthy,
 CAST(c AND m AND d AS INTEGER) AS overall_healthy FROM h"""


@query
def perf_alert(spark: SparkSession, sf: str) -> DataFrame:
    runs = fx.events(spark, sf).select(F.col("event_type").alias("job"), "event_id", F.col("value").alias("seconds"))
    a = reports.performance_alert(runs, "job", ["event_id"], "seconds")
    return a.select("job", "event_id", r("normal_seconds", 6).alias("normal_seconds"), r("ratio", 6).alias("ratio"), "slow")


SQL["perf_alert"] = f"""WITH w AS (SELECT event_type AS job, event_id, value,
 avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS normal FROM events)
 SELECT job, event_id, {rnd('normal', 6)} AS normal_seconds, {rnd('value / nullif(normal, 0)', 6)} AS ratio,
 CAST(coalesce(value / nullif(normal, 0) > 2, false) AS INTEGER) AS slow FROM w"""
