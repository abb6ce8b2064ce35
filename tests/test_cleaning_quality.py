import pytest
from pyspark.sql import functions as F

from brightloom.functions import expressions as ex
from brightloom.functions.calendar import time_features
from brightloom.operators import business, cleaning, outliers, quality


def test_names_fold_and_collide(spark):
    df = spark.createDataFrame([(1, 2)], ["Sales Amount", "unit-price"])
    assert cleaning.clean_names(df).columns == ["sales_amount", "unit_price"]
    with pytest.raises(ValueError):
        cleaning.clean_names(spark.createDataFrame([(1, 2)], ["A b", "a-b"]))


def test_median_and_mode_fill(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, None), (3.0, "a"), (10.0, None)], "x double, s string")
    out = cleaning.impute_mode(cleaning.impute_median(df))
    assert sorted(map(tuple, out.collect())) == [(1.0, "b"), (3.0, "a"), (3.0, "a"), (10.0, "a")]


def test_whole_number_columns_take_half_medians(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n long")
    assert sorted(r[0] for r in cleaning.impute_median(df).collect()) == [1.0, 1.5, 2.0]


def test_empty_text_column_becomes_unknown(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    assert {r[0] for r in cleaning.impute_mode(df).collect()} == {"Unknown"}


def test_skew_decides_the_fill(spark):
    df = spark.createDataFrame([(1.0, -1.0), (1.0, -1.0), (1.0, -1.0), (50.0, -50.0), (None, None)], "right double, left double")
    filled = cleaning.impute_by_skew(df).filter("right <> -left OR right < 50").collect()
    row = [r for r in filled if r["left"] not in (-1.0, -50.0)][0]
    assert row["right"] == 1.0 and row["left"] == -13.25  # median, mean


def test_dates_only_in_text_columns(spark):
    df = spark.createDataFrame([("2024-02-30", 4.5), ("2024-02-29 10:00:00", 1.0)], "order_date string, lifetime_value double")
    out = cleaning.parse_dates(df)
    assert [str(r[0]) for r in out.select("order_date").collect()] == ["None", "2024-02-29 10:00:00"]
    assert dict(out.dtypes)["lifetime_value"] == "double"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,)], "x double")
    assert cleaning.nan_to_null(df).filter("x IS NULL").count() == 1


def test_missing_date_gives_null_parts_and_zero_flags(spark):
    df = spark.createDataFrame([("2024-03-31",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    have, gone = time_features(df, ["d"]).orderBy(F.col("d").isNull()).collect()
    assert (have["d_quarter"], have["d_dayofweek"], have["d_is_weekend"], have["d_is_quarter_end"]) == (1, 6, 1, 1)
    assert gone["d_year"] is None and gone["d_is_weekend"] == 0


def test_interactions_stop_after_seven_pairs(spark):
    df = spark.createDataFrame([tuple(float(i) for i in range(6))], [f"c{i}" for i in range(6)])
    assert len(ex.interactions(df).columns) == 6 + 21


def test_masking(spark):
    text = "a.b@c.org, 4111 1111 1111 1111, 123-45-6789, (555) 123-4567"
    got = spark.createDataFrame([(text,)], "t string").select(ex.mask_pii(F.col("t"))).first()[0]
    assert "[EMAIL]" in got and "[CREDIT_CARD]" in got and "[SSN]" in got and "[PHONE]" in got


def test_whole_days_are_floored(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-03 00:00:00' a, timestamp_ntz'2024-01-01 12:00:00' b")
    assert df.select(ex.whole_days(F.col("a"), F.col("b"))).first()[0] == 1


def test_outlier_rules(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in [1, 2, 2, 3, 3, 3, 4, 4, 5, 100]] + [(None, 4.0)], "x double, flat double")
    iqr = outliers.flag_outliers(df, ["x", "flat"])
    assert iqr.filter("x_outlier = 1").select("x").collect()[0][0] == 100.0 and iqr.filter("x IS NULL AND x_outlier = 0").count() == 1
    z = outliers.flag_outliers(df, ["flat"], "zscore", 3.0)
    assert z.agg(F.sum("flat_outlier")).first()[0] == 1
    mad = outliers.flag_outliers(df, ["flat"], "modified_zscore", 3.5)  # deviation 0: anything else stands out
    assert mad.filter("flat_outlier = 1").select("flat").first()[0] == 4.0
    with pytest.raises(ValueError):
        outliers.flag_outliers(df, ["x"], "other")


def test_quality_of_an_empty_table_is_zero(spark):
    row = quality.quality_score(spark.createDataFrame([], "a int, b string")).first()
    assert row["overall_score"] == 0.0 and row["source_score"] == 0.0


def test_fit_and_validate(spark):
    good = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(100)], "x double, s string")
    rules = quality.fit_expectations(good)
    assert quality.validation_score(quality.validate(good, rules)).first()["validation_score"] == 1.0
    bad = spark.createDataFrame([(float(i * 100), "z") for i in range(100)], "x double, s string")
    failed = {(r["column"], r["kind"]) for r in quality.validate(bad, rules).filter("success = 0").collect()}
    assert failed == {("x", "between"), ("s", "in_set")}
    gone = quality.validate(bad.drop("s"), rules).filter("success = 0 AND column = 's'").count()
    assert gone == 2


def test_many_values_make_no_set(spark):
    df = spark.range(60).select(F.col("id").cast("string").alias("s"))
    assert quality.fit_expectations(df).filter("kind = 'in_set'").count() == 0


def test_value_segment_with_equal_edges(spark):
    df = spark.createDataFrame([(5.0,)] * 8 + [(9.0,)], "customer_lifetime_value double")
    got = dict(business.value_segment(df).groupBy("value_segment").count().collect())
    assert got == {"Low": 8, "Premium": 1}


def test_customer_stats_need_their_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "customer_id long, sales_amount double")
    with pytest.raises(ValueError):
        business.customer_stats(df)
    assert business.with_customer_stats(df).columns == df.columns


def test_forms_are_tried_only_where_they_may_succeed(spark):
    forms = [*cleaning.DATE_FORMS, *cleaning.DAY_FIRST.values()]
    assert set(forms) == set(cleaning.MUST_MATCH)
    numbers, ends = ["1", "009", "12", "13", "31", "32", "0", "-1", "+1", "2020", "+2021"], ["", " 1:02", " 01:02:03", " 25:00", "x"]
    texts = {f"{a}{s}{b}{s}{c}{e}" for s in "/- " for a in numbers for b in numbers for c in ("5", "31", "2020") for e in ends}
    texts |= {f"{m} {d}{s}2020{e}" for m in ("Jan", "may", "DECEMBER", "13") for d in numbers for s in (", ", ",", " ") for e in ends}
    texts |= {f"{d} {m} 2020{e}" for m in ("Jan", "may", "DECEMBER", "13") for d in numbers for e in ends} | {"20200131", "20201331", "+20200131", "020200131", "2020013", ""}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    for f in forms:
        plain, guarded = F.try_to_timestamp("t", F.lit(f)), cleaning._read(F.col("t"), f)
        got = df.agg(F.count(plain).alias("read"), F.count_if(~plain.eqNullSafe(guarded)).alias("off"), F.count_if(F.col("t").rlike(cleaning.MUST_MATCH[f])).alias("tried")).first()
        assert got.read and not got.off and got.tried < len(texts) / 2, f
