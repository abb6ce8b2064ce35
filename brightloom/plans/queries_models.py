"""Queries for clustering, components, forests, forecasting and the full jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom import fixtures as fx
from brightloom.operators import backtest as bt, boosting as bo, forecast_frames as ff, forecast_models as fm, forecast_search as fs, mlfeatures as ml
from brightloom.operators.dbscan import dbscan
from brightloom.operators.iforest import fit_forest, with_forest
from brightloom.plans import enrich
from brightloom.plans.rounding import r
from brightloom.plans.sqltext import DAILY, FRAME, SALES, rnd, scaled
from brightloom.staging import stage, stage_path
from brightloom.unions import union_all

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    return stage(fx.customer_frame(spark, sf), "frame")


_COLS = fx.CUSTOMER_FRAME_COLUMNS


# --- clusters and components -----------------------------------------------------------------------


@query
def ml_standardise(spark: SparkSession, sf: str) -> DataFrame:
    out = ml.standardise(_frame(spark, sf), _COLS)
    return out.select("customer_id", *[r(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in _COLS])


SQL["ml_standardise"] = f"{FRAME} SELECT customer_id, " + ", ".join(f"{rnd(scaled(c), 6)} AS {c}_scaled" for c in _COLS) + " FROM frame"


@query
def ml_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    d = _frame(spark, sf)
    out = ml.with_kmeans(d, ml.fit_kmeans(d, _COLS))
    away = F.array(*[F.col(f"distance_to_cluster_{i}") for i in range(8)])
    own = F.element_at(away, F.col("kmeans_cluster") + 1)
    return out.select("customer_id", (own == F.array_min(away)).cast("int").alias("is_nearest"), F.size(away).alias("n_centres"))


SQL["ml_kmeans"] = f"{FRAME} SELECT customer_id, CAST(1 AS INTEGER) AS is_nearest, CAST(8 AS INTEGER) AS n_centres FROM frame"


_NEAR = ["c_acctbal", "amount_sum", "n_lines"]
_CENTRES = [(0.0, 0.0, 0.0), (1.0, -0.5, 0.25), (-1.25, 0.75, 1.5)]


@query
def ml_centre_dist(spark: SparkSession, sf: str) -> DataFrame:
    d = _frame(spark, sf)
    model = ml.Centres(ml.fit_scaler(d, _NEAR), tuple(_CENTRES), 0.0)
    out = ml.with_kmeans(d, model)
    return out.select("customer_id", "kmeans_cluster", *[r(f"distance_to_cluster_{i}", 6).alias(f"distance_to_cluster_{i}") for i in range(3)])


def _centre_sql() -> str:
    parts = ["sqrt(" + " + ".join(f"power({scaled(c)} - ({v}), 2)" for c, v in zip(_NEAR, centre)) + f") AS d{i}" for i, centre in enumerate(_CENTRES)]
    return f"""{FRAME}, d AS (SELECT customer_id, {', '.join(parts)} FROM frame)
 SELECT customer_id, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS kmeans_cluster,
 {', '.join(f"{rnd(f'd{i}', 6)} AS distance_to_cluster_{i}" for i in range(3))} FROM d"""


SQL["ml_centre_dist"] = _centre_sql()

_DB = ["c_acctbal", "amount_sum"]
_EPS = 0.2


@query
def ml_dbscan(spark: SparkSession, sf: str) -> DataFrame:
    d = _frame(spark, sf)
    out = dbscan(d, "customer_id", ml.fit_scaler(d, _DB).scaled(), eps=_EPS, min_samples=5)
    return out.select("customer_id", "dbscan_core", "is_outlier")


_NEAR_SQL = f"""WITH RECURSIVE {FRAME.removeprefix('WITH ')}, p AS MATERIALIZED (SELECT customer_id, {scaled('c_acctbal')} AS x, {scaled('amount_sum')} AS y FROM frame),
 near AS MATERIALIZED (SELECT a.customer_id AS a, b.customer_id AS b FROM p a JOIN p b
 ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {_EPS}::DOUBLE * {_EPS}::DOUBLE),
 core AS MATERIALIZED (SELECT a FROM near GROUP BY a HAVING count(*) >= 5)"""

SQL["ml_dbscan"] = f"""{_NEAR_SQL}, touched AS (SELECT DISTINCT a FROM near WHERE b IN (SELECT a FROM core))
 SELECT customer_id, CAST(customer_id IN (SELECT a FROM core) AS INTEGER) AS dbscan_core,
 CAST(customer_id NOT IN (SELECT a FROM touched) AS INTEGER) AS is_outlier FROM p"""


@query
def ml_dbscan_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Cluster numbers, which need connected components."""
    d = _frame(spark, sf)
    out = dbscan(d, "customer_id", ml.fit_scaler(d, _DB).scaled(), eps=_EPS, min_samples=5)
    return out.select("customer_id", "dbscan_cluster")


SQL["ml_dbscan_labels"] = f"""{_NEAR_SQL}, link AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT a FROM core) AND b IN (SELECT a FROM core)),
 reach(root, a) AS (SELECT a, a FROM core UNION SELECT r.root, l.b FROM reach r JOIN link l ON r.a = l.a),
 label AS (SELECT a, min(root) AS root FROM reach GROUP BY a),
 numbered AS (SELECT a, dense_rank() OVER (ORDER BY root) - 1 AS c FROM label),
 own AS (SELECT n.a, min(l.c) AS c FROM near n JOIN numbered l ON n.b = l.a GROUP BY n.a)
 SELECT customer_id, CAST(coalesce(k.c, o.c, -1) AS INTEGER) AS dbscan_cluster FROM p LEFT JOIN numbered k ON k.a = customer_id
 LEFT JOIN own o ON o.a = customer_id"""


@query
def ml_pca(spark: SparkSession, sf: str) -> DataFrame:
    """All components turn the scaled columns without changing a row's length."""
    d = _frame(spark, sf)
    out = ml.with_pca(d, ml.fit_pca(d, _COLS, len(_COLS)))
    length = sum((F.pow(F.col(f"pca_component_{i}"), 2) for i in range(1, len(_COLS) + 1)), F.lit(0.0))
    return out.select("customer_id", r(length, 5).alias("squared_length"))


SQL["ml_pca"] = f"{FRAME} SELECT customer_id, {rnd(' + '.join(f'power({scaled(c)}, 2)' for c in _COLS), 5)} AS squared_length FROM frame"


@query
def ml_iforest(spark: SparkSession, sf: str) -> DataFrame:
    line = fx.table(spark, sf, "lineitem")
    keyed = line.withColumn("row_key", F.xxhash64(*line.columns))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = with_forest(keyed, fit_forest(keyed, "row_key", cols))
    score, strange = F.col("isolation_forest_score"), F.col("isolation_forest_anomaly")
    found = out.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum((~score.between(-1, 0)).cast("long")).alias("n_outside"), F.sum(strange).alias("n"),
        F.max(F.when(strange == 1, score)).alias("a"), F.min(F.when(strange == 0, score)).alias("b"),
    )
    near_tenth = (F.col("n") <= 0.1 * F.col("n_rows") + 1) & (F.col("n") >= 0.09 * F.col("n_rows"))
    return found.select("n_rows", "n_outside", (F.col("a") < F.col("b")).cast("int").alias("cut_holds"), near_tenth.cast("int").alias("a_tenth_is_strange"))


SQL["ml_iforest"] = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside, CAST(1 AS INTEGER) AS cut_holds, CAST(1 AS INTEGER) AS a_tenth_is_strange FROM lineitem"


# --- forecasting frames ----------------------------------------------------------------------------


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return stage(fx.daily(spark, sf), "daily")


def _ds():
    return F.date_format("ds", "yyyy-MM-dd").alias("ds")


_DS_SQL = "strftime(ds, '%Y-%m-%d') AS ds"


@query
def fc_series(spark: SparkSession, sf: str) -> DataFrame:
    s = ff.daily_series(fx.sales(spark, sf), F.col("region"), F.col("date"), F.col("sales_amount"), fill=0.0, fill_gaps=True)
    return s.select("series_id", _ds(), r("y").alias("y"))


SQL["fc_series"] = f"""{DAILY}, span AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM daily GROUP BY 1),
 cal AS (SELECT series_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds FROM span)
 SELECT cal.series_id, strftime(cal.ds, '%Y-%m-%d') AS ds, {rnd('coalesce(y, 0)')} AS y FROM cal LEFT JOIN daily d ON d.series_id = cal.series_id AND d.ds = cal.ds"""


@query
def fc_split(spark: SparkSession, sf: str) -> DataFrame:
    return ff.split_by_time(_daily(spark, sf)).select("series_id", _ds(), "position", "size", "part")


SQL["fc_split"] = f"""{DAILY}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS position, count(*) OVER (PARTITION BY series_id) AS size FROM daily)
 SELECT series_id, {_DS_SQL}, position, size, CASE WHEN position <= floor(size * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM n"""


@query
def fc_sequences(spark: SparkSession, sf: str) -> DataFrame:
    q = ff.sequences(_daily(spark, sf))
    total = F.aggregate("history", F.lit(0.0), lambda a, v: a + v)
    return q.select("series_id", _ds(), F.size("history").alias("length"), r(F.element_at("history", 1)).alias("first_value"), r(F.element_at("history", -1)).alias("last_value"), r(total).alias("total"), r("y").alias("y"))


SQL["fc_sequences"] = f"""{DAILY}, q AS (SELECT series_id, ds, y, list(y) OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING) AS h FROM daily)
 SELECT series_id, {_DS_SQL}, CAST(len(h) AS INTEGER) AS length, {rnd('h[1]')} AS first_value, {rnd('h[60]')} AS last_value, {rnd('list_sum(h)')} AS total, {rnd('y')} AS y FROM q WHERE len(h) = 60"""

_FEATURES = [f"lag_{k}" for k in ff.LAGS] + [f"rolling_{s}_{w}" for w in ff.WINDOWS for s in ("mean", "std", "min", "max")]


def _features(spark: SparkSession, sf: str) -> DataFrame:
    root = _daily(spark, sf).withColumn("y", F.sqrt("y"))
    f = ff.forecast_features(root)
    waves = ["month_sin", "month_cos", "day_sin", "day_cos"]
    return f.select("series_id", _ds(), *[r(c, 6).alias(c) for c in _FEATURES + waves], "day_of_week", "month", "quarter", "year", "day_of_year")


def _features_sql() -> str:
    parts = [f"{rnd(f'lag(y, {k}) OVER (PARTITION BY series_id ORDER BY ds)', 6)} AS lag_{k}" for k in ff.LAGS]
    for w in ff.WINDOWS:
        over = f"OVER (PARTITION BY series_id ORDER BY ds ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for s, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            value = f"CASE WHEN count(*) {over} = {w} THEN {fn}(y) {over} END"
            parts.append(f"{rnd(value, 6)} AS rolling_{s}_{w}")
    for name, expr in (("month", "month(ds) / 12"), ("day", "(isodow(ds) - 1) / 7")):
        parts += [f"{rnd(f'{t}(2 * pi() * {expr})', 6)} AS {name}_{t}" for t in ("sin", "cos")]
    ints = {"day_of_week": "isodow(ds) - 1", "month": "month(ds)", "quarter": "quarter(ds)", "year": "year(ds)", "day_of_year": "dayofyear(ds)"}
    parts += [f"CAST({e} AS INTEGER) AS {n}" for n, e in ints.items()]
    return f"{DAILY}, root AS (SELECT series_id, ds, sqrt(y) AS y FROM daily) SELECT series_id, {_DS_SQL}, {', '.join(parts)} FROM root"


@query
def fc_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf)


SQL["fc_features"] = _features_sql()


@query
def feat_dropna(spark: SparkSession, sf: str) -> DataFrame:
    f = ff.complete_rows(_features(spark, sf))
    return f.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


SQL["feat_dropna"] = f"""SELECT series_id, count(*) AS n_rows, min(ds) AS first_ds, max(ds) AS last_ds FROM ({_features_sql()}) t
 WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _FEATURES)} GROUP BY 1"""


@query
def fc_minmax(spark: SparkSession, sf: str) -> DataFrame:
    s = ff.scaled_series(_daily(spark, sf))
    back = ff.unscale(F.col("y_scaled"), F.col("y_low"), F.col("y_high"))
    return s.select("series_id", _ds(), r("y_scaled", 8).alias("y_scaled"), r(back).alias("y_back"))


SQL["fc_minmax"] = f"""{DAILY}, b AS (SELECT *, min(y) OVER (PARTITION BY series_id) AS lo, max(y) OVER (PARTITION BY series_id) AS hi FROM daily)
 SELECT series_id, {_DS_SQL}, {rnd('(y - lo) / coalesce(nullif(hi - lo, 0), 1)', 8)} AS y_scaled, {rnd('y')} AS y_back FROM b"""


@query
def fc_tail(spark: SparkSession, sf: str) -> DataFrame:
    return ff.tail(_daily(spark, sf), 60).select("series_id", _ds(), r("y").alias("y"))


SQL["fc_tail"] = f"""{DAILY}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS k FROM daily)
 SELECT series_id, {_DS_SQL}, {rnd('y')} AS y FROM n WHERE k <= 60"""


@query
def fc_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return ff.future_days(_daily(spark, sf)).select("series_id", "step", _ds())


SQL["fc_calendar"] = f"""{DAILY}, l AS (SELECT series_id, max(ds) AS d FROM daily GROUP BY 1)
 SELECT series_id, CAST(i AS INTEGER) AS step, strftime(d + CAST(i AS INTEGER), '%Y-%m-%d') AS ds FROM l CROSS JOIN range(1, 91) t(i)"""


@query
def fc_fourier(spark: SparkSession, sf: str) -> DataFrame:
    d = _daily(spark, sf)
    terms = [t for name, period, order in fm.SEASONS for t in fm.fourier(F.col("ds"), period, order, name)]
    wide = d.select("series_id", "ds", *terms)
    return wide.select("series_id", _ds(), *[r(c, 6).alias(c) for c in wide.columns[2:]])


SQL["fc_fourier"] = f"{DAILY}, e AS (SELECT series_id, ds, CAST(ds - DATE '1970-01-01' AS DOUBLE) AS day FROM daily) SELECT series_id, {_DS_SQL}, " + ", ".join(
    f"{rnd(f'{t}(2 * pi() * {k} * day / {period}::DOUBLE)', 6)} AS {name}_{t}_{k}" for name, period, order in (("weekly", 7.0, 3), ("yearly", 365.25, 10), ("monthly", 30.5, 5), ("quarterly", 91.25, 8)) for k in range(1, order + 1) for t in ("sin", "cos")
) + " FROM e"

# --- accuracy, weights, blending: on two naive forecasters, which SQL can follow --------------------


def _naive(series: DataFrame) -> DataFrame:
    return union_all(ff.naive_forecast(series, 7, "week_ago"), ff.naive_forecast(series, 1, "yesterday"))


def _judged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    s = _daily(spark, sf)
    test = ff.split_by_time(s).filter("part = 'test'").select("series_id", "ds", "y")
    return _naive(s), ff.accuracy(test, _naive(s))


_JUDGED = f"""{DAILY}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS position, count(*) OVER (PARTITION BY series_id) AS size,
 lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS y7, lag(y, 1) OVER (PARTITION BY series_id ORDER BY ds) AS y1 FROM daily),
 f AS (SELECT series_id, 'week_ago' AS model, ds, y, y7 AS yhat, position, size FROM n WHERE y7 IS NOT NULL
 UNION ALL SELECT series_id, 'yesterday', ds, y, y1, position, size FROM n WHERE y1 IS NOT NULL),
 m AS (SELECT series_id, model, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs((y - yhat) / nullif(y, 0))) * 100 AS mape,
 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)) AS r2, avg(CASE WHEN y BETWEEN yhat * 0.95::DOUBLE AND yhat * 1.05::DOUBLE THEN 1.0 ELSE 0.0 END) AS coverage,
 count(*) AS n_days FROM f WHERE position > floor(size * 0.8::DOUBLE) GROUP BY 1, 2),
 w AS (SELECT series_id, model, (1 / rmse) / sum(1 / rmse) OVER (PARTITION BY series_id) AS weight FROM m)"""


@query
def fc_metrics(spark: SparkSession, sf: str) -> DataFrame:
    m = _judged(spark, sf)[1]
    return m.select("series_id", "model", *[r(c).alias(c) for c in ("mae", "rmse", "mape")], r("r2", 6).alias("r2"), r("coverage", 6).alias("coverage"), "n_days")


SQL["fc_metrics"] = f"""{_JUDGED} SELECT series_id, model, {rnd('mae')} AS mae, {rnd('rmse')} AS rmse, {rnd('mape')} AS mape, {rnd('r2', 6)} AS r2,
 {rnd('coverage', 6)} AS coverage, n_days FROM m"""


@query
def fc_weights(spark: SparkSession, sf: str) -> DataFrame:
    return ff.inverse_rmse_weights(_judged(spark, sf)[1]).withColumn("weight", r("weight", 8))


SQL["fc_weights"] = f"{_JUDGED} SELECT series_id, model, {rnd('weight', 8)} AS weight FROM w"


@query
def fc_blend(spark: SparkSession, sf: str) -> DataFrame:
    forecasts, metrics = _judged(spark, sf)
    b = ff.blend(forecasts, ff.inverse_rmse_weights(metrics))
    return b.select("series_id", _ds(), *[r(c).alias(c) for c in ("yhat", "lower", "upper")], "n_models")


SQL["fc_blend"] = f"""{_JUDGED} SELECT f.series_id, strftime(ds, '%Y-%m-%d') AS ds, {rnd('sum(weight * yhat)')} AS yhat, {rnd('sum(weight * yhat * 0.95::DOUBLE)')} AS lower,
 {rnd('sum(weight * yhat * 1.05::DOUBLE)')} AS upper, count(*) AS n_models FROM f JOIN w ON f.series_id = w.series_id AND f.model = w.model GROUP BY 1, 2"""


@query
def fc_history_plus(spark: SparkSession, sf: str) -> DataFrame:
    """History followed by a repeat of the last value for 90 days."""
    s = _daily(spark, sf)
    last = ff.tail(s, 1).select("series_id", F.col("y").alias("yhat"))
    future = ff.future_days(s).join(last, "series_id")
    return ff.history_plus(s, future).select("series_id", _ds(), r("y").alias("y"), "is_forecast")


SQL["fc_history_plus"] = f"""{DAILY}, l AS (SELECT series_id, max(ds) AS d, arg_max(y, ds) AS y FROM daily GROUP BY 1)
 SELECT series_id, {_DS_SQL}, {rnd('y')} AS y, 0 AS is_forecast FROM daily
 UNION ALL SELECT series_id, strftime(d + CAST(i AS INTEGER), '%Y-%m-%d'), {rnd('y')}, 1 FROM l CROSS JOIN range(1, 91) t(i)"""

# --- fitted forecasters ----------------------------------------------------------------------------


def _days(df: DataFrame, bounds: tuple[str, str] = ("lower", "upper"), value: str = "yhat", day: str = "ds") -> DataFrame:
    """Days of each series' forecast, and those on which the value lies between its bounds."""
    inside = (F.col(bounds[0]) <= F.col(value)) & (F.col(value) <= F.col(bounds[1]))
    return df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.date_format(F.min(day), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max(day), "yyyy-MM-dd").alias("last_day"),
        F.sum(inside.cast("long")).alias("n_inside"),
    )


_DAYS_SQL = f"""{DAILY} SELECT series_id, CAST(90 AS BIGINT) AS n_days, strftime(max(ds) + 1, '%Y-%m-%d') AS first_day, strftime(max(ds) + 90, '%Y-%m-%d') AS last_day,
 CAST(90 AS BIGINT) AS n_inside FROM daily GROUP BY 1"""


@query
def fc_ar(spark: SparkSession, sf: str) -> DataFrame:
    return _days(fm.forecast_ar(fm.fit_ar(_daily(spark, sf))))


SQL["fc_ar"] = _DAYS_SQL


@query
def fc_ar_one_day(spark: SparkSession, sf: str) -> DataFrame:
    """The autoregressive model with one day of memory, which has a closed form."""
    made = fm.forecast_ar(fm.fit_ar(_daily(spark, sf), lookback=1, alpha=1.0))
    return made.select("series_id", _ds(), *[r(c, 3).alias(c) for c in ("yhat", "lower", "upper")])


SQL["fc_ar_one_day"] = f"""{DAILY}, b AS (SELECT series_id, ds, min(y) OVER s AS low, max(y) OVER s - min(y) OVER s AS width, (y - min(y) OVER s) / (max(y) OVER s - min(y) OVER s) AS v
 FROM daily WINDOW s AS (PARTITION BY series_id)),
 q AS (SELECT *, lag(v) OVER (PARTITION BY series_id ORDER BY ds) AS u FROM b), m AS (SELECT series_id, avg(u) AS mu, avg(v) AS mv,
 (count(*) * covar_pop(u, v)) / (count(*) * var_pop(u) + 1) AS beta FROM q WHERE u IS NOT NULL GROUP BY 1),
 f AS (SELECT q.series_id, any_value(low) AS low, any_value(width) AS width, any_value(beta) AS beta, any_value(mv - beta * mu) AS alpha,
 stddev_pop(v - (mv - beta * mu) - beta * u) * any_value(width) AS sigma, max(ds) AS d, arg_max(v, ds) AS last FROM q JOIN m ON q.series_id = m.series_id WHERE u IS NOT NULL GROUP BY 1),
 p AS (SELECT series_id, d + CAST(i AS INTEGER) AS ds, low + width * (alpha * (1 - power(beta, i)) / (1 - beta) + power(beta, i) * last) AS yhat, sigma FROM f CROSS JOIN range(1, 91) t(i))
 SELECT series_id, {_DS_SQL}, {rnd('yhat', 3)} AS yhat, {rnd('yhat - 1.96::DOUBLE * sigma', 3)} AS lower, {rnd('yhat + 1.96::DOUBLE * sigma', 3)} AS upper FROM p"""


@query
def fc_seasonal(spark: SparkSession, sf: str) -> DataFrame:
    return _days(fm.forecast_seasonal(fm.fit_seasonal(_daily(spark, sf))))


SQL["fc_seasonal"] = _DAYS_SQL


@query
def fc_seasonal_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """The seasonal forecast from given coefficients: 100, trend 10, and 1, 2, 3, ... on the seasonal terms."""
    terms = 2 * sum(order for _, _, order in fm.SEASONS)
    coef = F.array(F.lit(100.0), F.lit(10.0), *[F.lit(float(i)) for i in range(1, terms + 1)])
    models = _daily(spark, sf).groupBy("series_id").agg(F.min("ds").alias("start_ds"), F.max("ds").alias("last_ds")).select(
        "series_id", "start_ds", F.datediff("last_ds", "start_ds").alias("span"), coef.alias("coef"), F.lit(2.0).alias("sigma"), "last_ds")
    made = fm.forecast_seasonal(models)
    return made.select("series_id", _ds(), *[r(c, 5).alias(c) for c in ("yhat", "lower", "upper")])


def _seasonal_sql() -> str:
    terms, i = ["100", "10 * (ds - a) / greatest(b - a, 1)"], 0
    for period, order in (("7", 3), ("365.25", 10), ("30.5", 5), ("91.25", 8)):
        for k in range(1, order + 1):
            for fn in ("sin", "cos"):
                i += 1
                terms.append(f"{i} * {fn}(2 * pi() * {k} * CAST(ds - DATE '1970-01-01' AS DOUBLE) / {period}::DOUBLE)")
    return f"""{DAILY}, l AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM daily GROUP BY 1),
 f AS (SELECT series_id, a, b, b + CAST(i AS INTEGER) AS ds FROM l CROSS JOIN range(1, 91) t(i)), p AS (SELECT series_id, ds, {' + '.join(terms)} AS yhat FROM f)
 SELECT series_id, {_DS_SQL}, {rnd('yhat', 5)} AS yhat, {rnd('yhat - 3.92::DOUBLE', 5)} AS lower, {rnd('yhat + 3.92::DOUBLE', 5)} AS upper FROM p"""


SQL["fc_seasonal_fixed"] = _seasonal_sql()

@query
def fc_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _days(bo.forecast_gbt(bo.fit_gbt(_daily(spark, sf))))


SQL["fc_gbt"] = _DAYS_SQL


@query
def fc_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """Days on which each model of the ensemble is judged: the whole holdout; the weights of a series add up to 1."""
    fitted = fm.fit_ensemble(_daily(spark, sf))
    return fitted.metrics.join(fitted.weights, ["series_id", "model"]).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_models"), F.min("n_days").alias("least_days"), F.max("n_days").alias("most_days"), r(F.sum("weight"), 6).alias("weights"))


SQL["fc_holdout"] = f"""{DAILY}, n AS (SELECT series_id, count(*) - CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS k FROM daily GROUP BY 1)
 SELECT series_id, CAST(3 AS BIGINT) AS n_models, k AS least_days, k AS most_days, 1.0::DOUBLE AS weights FROM n"""


@query
def fc_table(spark: SparkSession, sf: str) -> DataFrame:
    """The 90-day ensemble forecast: days, and how often the bounds of three levels lie around each other in order."""
    blended, _, _ = fm.ensemble(_daily(spark, sf))
    both = ff.forecast_table(ff.with_levels(blended, (0.8, 0.9))).withColumnRenamed("date", "ds").join(
        ff.with_levels(blended, (0.8, 0.9)).select("series_id", "ds", "lower_80", "upper_80", "lower_90", "upper_90"), ["series_id", "ds"])
    nested = F.lit(True)
    steps = ["lower_bound", "lower_90", "lower_80", "predicted_sales", "upper_80", "upper_90", "upper_bound"]
    for a, b in zip(steps, steps[1:]):
        nested = nested & (F.col(a) <= F.col(b))
    return both.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.date_format(F.min("ds"), "yyyy-MM-dd").alias("first_day"), F.date_format(F.max("ds"), "yyyy-MM-dd").alias("last_day"),
        F.sum(nested.cast("long")).alias("n_inside"))


SQL["fc_table"] = _DAYS_SQL


@query
def fc_tune(spark: SparkSession, sf: str) -> DataFrame:
    """Two races of nine trials for each series and model: trials of each rung, those that went on, and whether the winner has the least error."""
    done = stage(fs.search(_daily(spark, sf), trials=9), "search")
    top = done.filter("rung = 2").groupBy("series_id", "model").agg(
        F.sum("best").cast("long").alias("n_winners"), (F.max(F.when(F.col("best") == 1, F.col("rmse"))) == F.min("rmse")).cast("int").alias("winner_is_least"))
    # of the trials of a rung, none that stayed behind is better than one that went on
    fair = F.max(F.when(F.col("kept") == 1, F.col("rmse"))) <= F.coalesce(F.min(F.when(F.col("kept") == 0, F.col("rmse"))), F.lit(float("inf")))
    rungs = done.groupBy("series_id", "model", "round", "rung").agg(
        F.count_distinct("trial").alias("n_trials"), F.sum("kept").cast("long").alias("n_kept"), fair.cast("int").alias("is_fair"),
        F.max(F.when(F.col("rmse") < float("inf"), 1).otherwise(0)).alias("has_error"))
    return rungs.join(top, ["series_id", "model"])


SQL["fc_tune"] = f"""{DAILY} SELECT DISTINCT series_id, model, CAST(round AS INTEGER) AS round, CAST(rung AS INTEGER) AS rung, CAST(9 // (3 ** rung) AS BIGINT) AS n_trials, CAST(greatest(1, 3 // (3 ** rung)) AS BIGINT) AS n_kept,
 CAST(1 AS INTEGER) AS is_fair, CAST(1 AS INTEGER) AS has_error, CAST(1 AS BIGINT) AS n_winners, CAST(1 AS INTEGER) AS winner_is_least
 FROM daily, (VALUES ('ar'), ('seasonal'), ('gbt')) m(model), range(0, 2) a(round), range(0, 3) b(rung)"""


@query
def fc_tune_repeat(spark: SparkSession, sf: str) -> DataFrame:
    """The race of a model whose errors have a closed form: repeating the last 1 to 27 days."""
    done = fs.search(_daily(spark, sf), models=["repeat"], rounds=1, given={"repeat": [{"period": p} for p in range(1, 28)]})
    return done.select("series_id", F.col("setting")["period"].cast("int").alias("period"), "rung", r("budget", 6).alias("budget"), r("rmse").alias("rmse"), "kept", "best")


SQL["fc_tune_repeat"] = f"""{DAILY}, o AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM daily),
 c AS (SELECT *, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS k FROM o), t AS (SELECT * FROM c WHERE i > k),
 e AS (SELECT t.series_id, p, sqrt(avg((t.y - u.y) * (t.y - u.y))) AS rmse FROM t CROSS JOIN range(1, 28) a(p) JOIN o u ON u.series_id = t.series_id AND u.i = t.k - p + 1 + (t.i - t.k - 1) % p GROUP BY 1, 2),
 f AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY rmse, p) AS place FROM e)
 SELECT series_id, CAST(p AS INTEGER) AS period, CAST(rung AS INTEGER) AS rung, {rnd('power(3::DOUBLE, rung - 3)', 6)} AS budget, {rnd('rmse')} AS rmse,
 CAST(rung = 3 OR place <= 9 // (3 ** rung) AS INTEGER) AS kept, CAST(rung = 3 AND place = 1 AS INTEGER) AS best
 FROM f CROSS JOIN range(0, 4) b(rung) WHERE place <= 27 // (3 ** rung)"""


@query
def fc_backtest(spark: SparkSession, sf: str) -> DataFrame:
    """Widths of the bounds at every band of steps, and how many of the latest cut's days lie between them, for the repeated week."""
    widths, judged = bt.backtest(_daily(spark, sf), [bt.repeat_forecast(7)])
    sums = judged.select("series_id", "level", "n_days", r("coverage", 6).alias("coverage"), r("r2", 6).alias("r2"))
    return widths.select("series_id", "band", "level", "n", r("width").alias("width")).join(sums, ["series_id", "level"])


SQL["fc_backtest"] = f"""{DAILY}, l AS (SELECT series_id, max(ds) AS d FROM daily GROUP BY 1),
 cuts AS (SELECT series_id, CAST(c AS INTEGER) AS cut, d - CAST((c + 1) * 90 AS INTEGER) AS cut_ds FROM l CROSS JOIN range(0, 6) t(c)),
 known AS (SELECT c.*, ds, y, row_number() OVER (PARTITION BY c.series_id, cut ORDER BY ds DESC) AS back, max(ds) OVER (PARTITION BY c.series_id, cut) AS last FROM cuts c JOIN daily USING (series_id) WHERE ds <= cut_ds),
 made AS (SELECT series_id, cut, cut_ds, last + CAST(8 - back + 7 * w AS INTEGER) AS ds, y AS yhat FROM known CROSS JOIN range(0, 60) t(w) WHERE back <= 7 AND last + CAST(8 - back + 7 * w AS INTEGER) <= cut_ds + 90),
 e AS (SELECT m.series_id, cut, m.ds - cut_ds AS step, y, yhat FROM made m JOIN daily d ON d.series_id = m.series_id AND d.ds = m.ds WHERE m.ds - cut_ds BETWEEN 1 AND 90),
 q AS (SELECT series_id, (step - 1) // 15 AS band, list_sort(list(abs(y - yhat))) AS off FROM e WHERE cut > 0 GROUP BY 1, 2),
 w AS (SELECT series_id, band, level, len(off) AS n, off[CAST(least(ceil(round((len(off) + 1) * level, 9)), len(off)) AS BIGINT)] AS width FROM q CROSS JOIN (VALUES (0.8::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE)) v(level)),
 j AS (SELECT e.series_id, level, count(*) AS n_days, avg(CAST(y BETWEEN yhat - width AND yhat + width AS INTEGER)) AS coverage, 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y)) AS r2
 FROM e JOIN (SELECT series_id, max(band) AS top FROM q GROUP BY 1) t ON t.series_id = e.series_id JOIN w ON w.series_id = e.series_id AND w.band = least((e.step - 1) // 15, top) WHERE cut = 0 GROUP BY 1, 2)
 SELECT w.series_id, CAST(band AS INTEGER) AS band, w.level, CAST(n AS BIGINT) AS n, {rnd('width')} AS width, n_days, {rnd('coverage', 6)} AS coverage, {rnd('r2', 6)} AS r2 FROM w JOIN j ON j.series_id = w.series_id AND j.level = w.level"""


@query
def fc_conformal(spark: SparkSession, sf: str) -> DataFrame:
    """Conformal bounds of the fitted models: days judged, and whether the share between the bounds is near each level and grows with it."""
    days = _daily(spark, sf)
    made = [lambda s, h: fm.forecast_ar(fm.fit_ar(s), h), lambda s, h: fm.forecast_seasonal(fm.fit_seasonal(s), h), lambda s, h: bo.forecast_gbt(bo.fit_gbt(s, trees=200), h)]
    _, judged = bt.backtest(days, made)
    # three deviations of a share of so many independent days, doubled because days in a row are alike
    near = F.abs(F.col("coverage") - F.col("level")) <= 6 * F.sqrt(F.col("level") * (1 - F.col("level")) / F.col("n_days"))
    return judged.select("series_id", "model", "level", "n_days", near.cast("int").alias("is_near"))


SQL["fc_conformal"] = f"""{DAILY}, n AS (SELECT series_id, count(*) FILTER (ds > last - 90) AS n_days FROM (SELECT *, max(ds) OVER (PARTITION BY series_id) AS last FROM daily) GROUP BY 1)
 SELECT series_id, model, level, n_days, CAST(1 AS INTEGER) AS is_near FROM n, (VALUES ('ar'), ('seasonal'), ('gbt')) m(model), (VALUES (0.8::DOUBLE), (0.9::DOUBLE), (0.95::DOUBLE)) v(level)"""


@query
def fc_breaks_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """The seasonal forecast from given coefficients and given breaks of the trend: 100 more a span after day 200, 250 less after day 900."""
    zeros = F.array_repeat(F.lit(0.0), 2 * sum(order for _, _, order in fm.SEASONS))
    models = _daily(spark, sf).groupBy("series_id").agg(F.min("ds").alias("start_ds"), F.max("ds").alias("last_ds")).select(
        "series_id", "start_ds", F.datediff("last_ds", "start_ds").alias("span"), F.concat(F.array(F.lit(50.0), F.lit(10.0)), zeros).alias("coef"), F.lit(1.0).alias("sigma"), "last_ds",
        F.array(F.lit(200), F.lit(900)).alias("breaks"), F.array(F.lit(100.0), F.lit(-250.0)).alias("slopes"))
    return fm.forecast_seasonal(models).select("series_id", _ds(), r("yhat", 5).alias("yhat"))


SQL["fc_breaks_fixed"] = f"""{DAILY}, l AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM daily GROUP BY 1),
 p AS (SELECT series_id, b + CAST(i AS INTEGER) AS ds, 50 + (10.0::DOUBLE * (b + CAST(i AS INTEGER) - a) + 100.0::DOUBLE * greatest(0, b + CAST(i AS INTEGER) - a - 200) - 250.0::DOUBLE * greatest(0, b + CAST(i AS INTEGER) - a - 900)) / (b - a) AS yhat
 FROM l CROSS JOIN range(1, 91) t(i)) SELECT series_id, {_DS_SQL}, {rnd('yhat', 5)} AS yhat FROM p"""


@query
def fc_persist(spark: SparkSession, sf: str) -> DataFrame:
    """Largest difference between an ensemble's forecasts before saving and after loading it again."""
    fitted = fm.fit_ensemble(_daily(spark, sf))
    path = stage_path(spark, "saved-ensemble")
    fitted.save(path)
    before = fitted.forecast().select("series_id", "ds", F.col("yhat").alias("a"))
    after = fm.load_ensemble(spark, path).forecast().select("series_id", "ds", F.col("yhat").alias("b"))
    return before.join(after, ["series_id", "ds"]).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_days"), r(F.max(F.abs(F.col("a") - F.col("b"))), 6).alias("largest_difference"))


SQL["fc_persist"] = f"{DAILY} SELECT DISTINCT series_id, CAST(90 AS BIGINT) AS n_days, 0.0::DOUBLE AS largest_difference FROM daily"


# --- full jobs -------------------------------------------------------------------------------------


@query
def sales_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sales job over all rows, summarised per column."""
    done = enrich.enrich_sales(fx.sales(spark, sf), fx.SALES_ORDER, numeric=fx.SALES_MEASURES)
    return enrich.profile_columns(done.rows)


@query
def sales_features(spark: SparkSession, sf: str) -> DataFrame:
    """The sales job without the forest, summarised per column, which SQL can follow."""
    config = enrich.FeatureConfig(forest=False)
    done = enrich.enrich_sales(fx.sales(spark, sf), fx.SALES_ORDER, numeric=fx.SALES_MEASURES, config=config)
    p = enrich.profile_columns(done.rows)
    return p.select("column", "n_values", r("mean", 3).alias("mean"), r("low", 3).alias("low"), r("high", 3).alias("high"))


def _sales_features_sql() -> str:
    order = ", ".join(fx.SALES_ORDER)
    base, wide, flags = {}, {}, {}
    for c in ("sales_amount", "quantity", "profit", "customer_id", "order_id", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"):
        base[c] = c
    for c in fx.SALES_MEASURES:
        for k in (1, 7, 30):
            wide[f"{c}_lag_{k}"] = f"lag({c}, {k}) OVER o"
            wide[f"{c}_pct_change_{k}"] = f"{c} / nullif(lag({c}, {k}) OVER o, 0) - 1"
        for w in (7, 30, 90):
            for name, fn, least in (("mean", "avg", 1), ("std", "stddev_samp", 1), ("min", "min", 1), ("max", "max", 1), ("median", "median", 1),
                                    ("skew", "skewness", 3), ("kurt", "kurtosis", 4)):
                value = f"{fn}({c}) OVER w{w}"
                wide[f"{c}_rolling_{w}_{name}"] = value if least == 1 else f"CASE WHEN count(*) OVER w{w} >= {least} THEN {value} END"
        wide[f"{c}_zscore"] = f"({c} - (SELECT avg({c}) FROM sales)) / (SELECT stddev_pop({c}) FROM sales)"
        wide[f"{c}_percentile"] = f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / (SELECT count({c}) FROM sales)"
    for n in ("date", "order_date", "l_shipdate"):
        d = f"CAST({n} AS DATE)"
        wide |= {
            f"{n}_year": f"year({d})", f"{n}_month": f"month({d})", f"{n}_quarter": f"quarter({d})", f"{n}_day": f"day({d})",
            f"{n}_dayofweek": f"isodow({d}) - 1", f"{n}_dayofyear": f"dayofyear({d})", f"{n}_week": f"weekofyear({d})",
            f"{n}_is_weekend": f"CAST(isodow({d}) >= 6 AS INTEGER)", f"{n}_is_month_start": f"CAST(day({d}) = 1 AS INTEGER)",
            f"{n}_is_month_end": f"CAST(last_day({d}) = {d} AS INTEGER)",
            f"{n}_is_quarter_start": f"CAST(day({d}) = 1 AND month({d}) % 3 = 1 AS INTEGER)",
            f"{n}_is_quarter_end": f"CAST(last_day({d}) = {d} AND month({d}) % 3 = 0 AS INTEGER)",
            f"{n}_month_sin": f"sin(2 * pi() * month({d}) / 12)", f"{n}_month_cos": f"cos(2 * pi() * month({d}) / 12)",
            f"{n}_day_sin": f"sin(2 * pi() * day({d}) / 31)", f"{n}_day_cos": f"cos(2 * pi() * day({d}) / 31)",
        }
    wide |= {
        "unit_price": "sales_amount / (quantity + 1e-8::DOUBLE)",
        "high_value_sale": "CAST(sales_amount > (SELECT quantile_cont(sales_amount, 0.9) FROM sales) AS INTEGER)",
        "profit_margin": "profit / (sales_amount + 1e-8::DOUBLE)", "profitable": "CAST(profit > 0 AS INTEGER)",
        "region_avg_sales": "avg(sales_amount) OVER (PARTITION BY region)", "region_sales_std": "stddev_samp(sales_amount) OVER (PARTITION BY region)",
        "region_sales_count": "count(sales_amount) OVER (PARTITION BY region)",
    }
    # whole numbers of 32 bits (calendar parts, 0/1 columns) are not judged, as in the operator
    small = ("_year", "_month", "_quarter", "_day", "_dayofweek", "_dayofyear", "_week", "_is_weekend", "_start", "_end")
    for c in (*fx.SALES_MEASURES, *(c for c in wide if not c.endswith(small) and c not in ("high_value_sale", "profitable"))):
        a, b = f"(SELECT quantile_cont({c}, 0.25) FROM wide)", f"(SELECT quantile_cont({c}, 0.75) FROM wide)"
        flags[f"{c}_outlier"] = f"coalesce(CAST({c} < {a} - 1.5 * ({b} - {a}) OR {c} > {b} + 1.5 * ({b} - {a}) AS INTEGER), 0)"
    frames = ", ".join(f"w{w} AS (ORDER BY {order} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)" for w in (7, 30, 90))
    every = [*base, *wide, *flags]
    profile = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n_values, {rnd(f'avg({c})', 3)} AS mean, {rnd(f'CAST(min({c}) AS DOUBLE)', 3)} AS low, {rnd(f'CAST(max({c}) AS DOUBLE)', 3)} AS high FROM done" for c in every
    )
    return f"""{SALES.replace('sales AS', 'sales AS MATERIALIZED', 1)}, wide AS MATERIALIZED (SELECT {', '.join(base)}, {', '.join(f'{e} AS {c}' for c, e in wide.items())}
 FROM sales WINDOW o AS (ORDER BY {order}), {frames}), done AS MATERIALIZED (SELECT *, {', '.join(f'{e} AS {c}' for c, e in flags.items())} FROM wide) {profile}"""


SQL["sales_features"] = _sales_features_sql()


@query
def customers_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The whole customer job over all sales rows, summarised per column."""
    s = fx.sales(spark, sf).groupBy("customer_id", "order_id", "order_date", "date", "region").agg(
        F.sum("sales_amount").alias("sales_amount"), F.sum("quantity").alias("quantity"), F.sum("profit").alias("profit")
    )
    on = ["sales_amount_sum", "sales_amount_mean", "sales_amount_std", "purchase_frequency", "quantity_sum", "quantity_mean", "profit_sum",
          "profit_mean", "recency", "frequency", "monetary"]
    done = enrich.enrich_customers(s, ["order_date", "order_id"], fx.SALES_MEASURES, on)
    return enrich.profile_columns(done.rows)


