"""Column names, missing values and dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.functions.expressions import numeric_columns, string_columns
from brightloom.operators.selection import approx_quantiles, exact_quantiles


def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case names; spaces and dashes become underscores. Two names folding to one is an error."""
    names = [c.lower().replace(" ", "_").replace("-", "_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after folding: {sorted(names)}")
    return df.toDF(*names)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing, once, at the edge."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def _fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    fills = {
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items() if v is not None
    }
    return df.withColumns(fills) if fills else df


def medians(df: DataFrame, columns: Sequence[str], approx: bool = False) -> dict[str, float | None]:
    found = (approx_quantiles if approx else exact_quantiles)(df, columns, [0.5])
    return {c: q[0] for c, q in zip(columns, found)}


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Fill numeric gaps with the median. A whole-number column takes the median as a double."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first() if cols else {}
    holes = [c for c in cols if nulls[c]]
    return fill_numeric(df, medians(df, holes, approx)) if holes else df


def fill_numeric(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Fill with a double; the column becomes a double unless the fill is a whole number."""
    out = {}
    for c, v in values.items():
        if v is None:
            continue
        kind = df.schema[c].dataType.simpleString()
        whole = kind in ("bigint", "int", "smallint", "tinyint") and float(v).is_integer()
        out[c] = F.coalesce(F.col(c), F.lit(v).cast(kind)) if whole else F.coalesce(F.col(c).cast("double"), F.lit(v))
    return df.withColumns(out) if out else df


def impute_by_skew(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Fill gaps with the median where the population skewness is above 1, else with the mean."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    if not cols:
        return df
    facts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.skewness(c).alias(f"s_{i}") for i, c in enumerate(cols)],
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
    ).first()
    holes = [i for i in range(len(cols)) if facts[f"n_{i}"]]
    skewed = [cols[i] for i in holes if (facts[f"s_{i}"] or 0.0) > 1]
    fills = {cols[i]: facts[f"m_{i}"] for i in holes}
    fills.update(medians(df, skewed, approx) if skewed else {})
    return fill_numeric(df, fills)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several string columns in one scan; nulls are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p"))
        .select("p.column", "p.value")
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on a tie. Columns without values are absent."""
    if not columns:
        return {}
    best = value_counts(df, columns).groupBy("column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("b"))
    return {r["column"]: r["value"] for r in best.select("column", "b.value").collect()}  # one row per column


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill string gaps with the mode, or 'Unknown' when a column has no value at all."""
    cols = list(columns) if columns is not None else string_columns(df)
    if not cols:
        return df
    # values are counted in the columns that have gaps, and in no other
    gaps = df.agg(*[F.max(F.col(c).isNull()).alias(f"g{i}") for i, c in enumerate(cols)]).first()
    cols = [c for i, c in enumerate(cols) if gaps[f"g{i}"]]
    found = modes(df, cols)
    return _fill(df, {c: found.get(c, "Unknown") for c in cols})


#: fixed values: forms tried after ISO text, in this order
DATE_FORMS = ("yyyyMMdd", "M/d/yyyy[ H:mm[:ss]]", "M-d-yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]", "MMMM d, yyyy[ H:mm[:ss]]", "d MMM yyyy[ H:mm[:ss]]", "d MMMM yyyy[ H:mm[:ss]]")


#: fixed values: forms with the day first, each beside the form that reads the same text with the month first
DAY_FIRST = {"M/d/yyyy[ H:mm[:ss]]": "d/M/yyyy[ H:mm[:ss]]", "M-d-yyyy[ H:mm[:ss]]": "d-M-yyyy[ H:mm[:ss]]"}


_MONTH, _DAY = "0*(1[0-2]|[1-9])", "0*([12][0-9]|3[01]|[1-9])"
#: fixed values: what a text must match to be read in a form. Text that cannot be parsed costs Spark an exception per value and form,
#: many times a parsed one, so forms are only tried where they may succeed; forms that are not listed are tried on every text
MUST_MATCH = {
    "yyyyMMdd": r"^[+-]?[0-9]{8,}$", "yyyy/M/d[ H:mm[:ss]]": rf"^[+-]?[0-9]+/{_MONTH}/{_DAY}",
    "M/d/yyyy[ H:mm[:ss]]": f"^{_MONTH}/{_DAY}/", "M-d-yyyy[ H:mm[:ss]]": f"^{_MONTH}-{_DAY}-",
    "d/M/yyyy[ H:mm[:ss]]": f"^{_DAY}/{_MONTH}/", "d-M-yyyy[ H:mm[:ss]]": f"^{_DAY}-{_MONTH}-",
    **{f"{m} d, yyyy[ H:mm[:ss]]": rf"^[^0-9].* {_DAY}, " for m in ("MMM", "MMMM")}, **{f"d {m} yyyy[ H:mm[:ss]]": f"^{_DAY} [^0-9]" for m in ("MMM", "MMMM")},
}


_LATE = "0*(1[3-9]|2[0-9]|3[01])"
#: fixed values: the same for text that can only be read in this order of day and month, as its day is not a month
MUST_DECIDE = {
    "M/d/yyyy[ H:mm[:ss]]": f"^{_MONTH}/{_LATE}/", "M-d-yyyy[ H:mm[:ss]]": f"^{_MONTH}-{_LATE}-",
    "d/M/yyyy[ H:mm[:ss]]": f"^{_LATE}/{_MONTH}/", "d-M-yyyy[ H:mm[:ss]]": f"^{_LATE}-{_MONTH}-",
}


def _read(text: Column, form: str, where: dict[str, str] = MUST_MATCH) -> Column:
    """``text`` as a timestamp written in ``form``, else null."""
    read = F.try_to_timestamp(text, F.lit(form))
    return F.when(text.rlike(where[form]), read) if form in where else read


def date_votes(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Whether a column writes the day first: whether more of its values can be read so than with the month first.

    One scan for all columns. Text that can be read both ways counts on both sides, so only text that cannot is parsed. 25/12/2023 so decides how 03/04/2023 is read; where all values can be read both ways the month comes first.
    """
    reads = lambda c, forms: F.count(F.coalesce(*[_read(F.trim(F.col(c)), f, MUST_DECIDE) for f in forms]))
    votes = df.agg(*[reads(c, forms).alias(f"{side}{i}") for i, c in enumerate(columns) for side, forms in (("m", DAY_FIRST), ("d", DAY_FIRST.values()))]).first()
    return {c: votes[f"d{i}"] > votes[f"m{i}"] for i, c in enumerate(columns)}


def tolerant_date(c: Column, forms: Sequence[str] = DATE_FORMS) -> Column:
    """A date or time from ISO text or one of ``forms``, else null. Eight digits are a date, not a year."""
    text = F.trim(c)
    tried = [_read(text, f).cast("timestamp_ntz") for f in forms]
    iso = F.when(~text.rlike("^[0-9]+$") | (F.length(text) <= 4), text.try_cast("timestamp_ntz"))
    return F.coalesce(iso, *tried)


def parse_dates(df: DataFrame, columns: Sequence[str] | None = None, forms: Sequence[str] = DATE_FORMS) -> DataFrame:
    """Parse text columns whose name holds 'date' or 'time', see ``tolerant_date``; text that is no date becomes null.

    Each column votes on the order of day and month, see ``date_votes``; a value that can only be read in the other order is read so.
    Numeric columns are never parsed (``lifetime_value`` contains 'time').
    """
    cols = columns
    if cols is None:
        cols = [c for c in string_columns(df) if "date" in c.lower() or "time" in c.lower()]
    if not cols:
        return df
    first = date_votes(df, cols)
    made = {}
    for c in cols:
        made[c] = tolerant_date(F.col(c), _ordered(forms, first[c]))
    return df.withColumns(made)


def _ordered(forms: Sequence[str], day_first: bool) -> list[str]:
    """``forms`` with the day-first forms before or after those that read the same text with the month first."""
    out = []
    for f in forms:
        both = (f, DAY_FIRST[f]) if f in DAY_FIRST else (f,)
        out += reversed(both) if day_first else both
    return out


def clean_sales(df: DataFrame, approx: bool = False) -> DataFrame:
    """Names, median fill, mode fill, dates, in this order."""
    return parse_dates(impute_mode(impute_median(nan_to_null(clean_names(df)), approx=approx)))


def clean_customers(df: DataFrame, approx: bool = False) -> DataFrame:
    """Names, skew-aware fill, mode fill."""
    return impute_mode(impute_by_skew(nan_to_null(clean_names(df)), approx=approx))


def null_cells(df: DataFrame) -> DataFrame:
    """One row: (rows, cells, null_cells)."""
    missing = [F.coalesce(F.sum(F.col(f"`{c}`").isNull().cast("long")), F.lit(0)) for c in df.columns]
    total = missing[0]
    for m in missing[1:]:
        total = total + m
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows"), (rows * len(df.columns)).alias("cells"), total.alias("null_cells"))


def nulls_handled(before: DataFrame, after: DataFrame) -> DataFrame:
    """Null cells before, after and the difference, as one row."""
    b = null_cells(before).select(F.col("null_cells").alias("nulls_before"), F.lit(1).alias("_k"))
    a = null_cells(after).select(F.col("null_cells").alias("nulls_after"), F.lit(1).alias("_k"))
    return b.join(a, "_k").select(
        "nulls_before", "nulls_after", (F.col("nulls_before") - F.col("nulls_after")).alias("nulls_handled")
    )
