"""Pieces of the comparison SQL: the fixture views written out over the raw tables."""

SALES_SELECT = """SELECT o_orderdate AS date, o_orderdate AS order_date, r_name AS region, p_name AS product,
 p_type AS category, l_extendedprice * (1 - l_discount) AS sales_amount, l_quantity AS quantity,
 l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS profit, o_custkey AS customer_id,
 l_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 JOIN part ON l_partkey = p_partkey"""

SALES = f"WITH sales AS ({SALES_SELECT})"

DIRTY = f"""{SALES}, dirty AS (SELECT order_id, l_linenumber, l_partkey, l_suppkey, customer_id,
 CASE WHEN order_id % 7 <> 0 THEN sales_amount END AS sales_amount,
 CASE WHEN order_id % 11 <> 0 THEN quantity END AS quantity, profit,
 CASE WHEN order_id % 13 <> 0 THEN region END AS region, product, category,
 CASE WHEN order_id % 17 = 0 THEN 'not-a-date' ELSE strftime(date, '%Y-%m-%d %H:%M:%S') END AS date_text
 FROM sales)"""

DAILY = f"""{SALES}, daily AS (SELECT region AS series_id, CAST(date AS DATE) AS ds, sum(sales_amount) AS y
 FROM sales GROUP BY 1, 2)"""

FRAME = """WITH per AS (SELECT o_custkey, sum(l_extendedprice) AS amount_sum, avg(l_extendedprice) AS amount_mean,
 stddev_samp(l_extendedprice) AS amount_std, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS quantity_sum,
 avg(l_quantity) AS quantity_mean, stddev_samp(l_quantity) AS quantity_std, avg(l_discount) AS discount_mean,
 stddev_samp(l_discount) AS discount_std, avg(l_tax) AS tax_mean, stddev_samp(l_tax) AS tax_std
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
 frame AS (SELECT c_custkey AS customer_id, c_acctbal, per.* EXCLUDE (o_custkey)
 FROM customer LEFT JOIN per ON c_custkey = o_custkey)"""


def rnd(expr: str, digits: int = 4) -> str:
    """Rounded, with negative zero turned into zero."""
    return f"(CASE WHEN round({expr}, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({expr}, {digits}) END)"


def scaled(column: str) -> str:
    """Mean-filled and divided by the population deviation of the filled column (1 when it is zero)."""
    mean = f"(SELECT avg({column}) FROM frame)"
    filled = f"coalesce({column}, {mean})"
    spread = f"(SELECT stddev_pop(coalesce({column}, {mean})) FROM frame)"
    return f"(({filled} - {mean}) / coalesce(nullif({spread}, 0), 1))"
