"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

EPSILON = 1e-8  # fixed value: keeps ratios defined when the denominator is 0

DOUBLE_LIKE = (T.DoubleType, T.LongType)  # what counts as a measure in feature operators
NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType)
DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)


def measures(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns (of ``columns``, or all) that are 64-bit integers or doubles."""
    wanted = columns if columns is not None else df.columns
    have = {f.name: f.dataType for f in df.schema}
    return [c for c in wanted if c in have and isinstance(have[c], DOUBLE_LIKE)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def round_money(c: Column, digits: int = 2) -> Column:
    """Half-up rounding on the decimal value, so the order of summation cannot flip a tie."""
    return F.round(c.cast("decimal(28,8)"), digits).cast("double")


def per(a: Column, b: Column) -> Column:
    """Ratio with the small constant added to the denominator."""
    return a / (b + F.lit(EPSILON))


def _clock(c: Column) -> Column:
    """Seconds since midnight, with the fraction."""
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds between two naive times; the session's time zone plays no part."""
    return F.datediff(later, earlier).cast("long") * 86_400 + (_clock(later) - _clock(earlier))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two times (floor of the exact difference, not of calendar days)."""
    return F.floor(seconds_between(later, earlier) / F.lit(86_400)).cast("long")


def time_literal(value, kind: T.DataType) -> Column:
    """A collected date or time as a literal of its column's type; naive times are not shifted by a zone."""
    return F.lit(str(value) if isinstance(kind, T.TimestampNTZType) and value is not None else value).cast(kind)


def source_key(source: Column, params: Sequence[tuple[str, Column]]) -> Column:
    """MD5 of the source name and its parameters as key-sorted JSON."""
    fields = [c.alias(name) for name, c in sorted(params, key=lambda p: p[0])]
    return F.md5(F.concat_ws(":", source, F.to_json(F.struct(*fields))))


# Masking patterns in the order in which they are applied (no look-around, so that RE2
# engines read them the same way).
PII_PATTERNS = [
    ("credit_card", r"\b[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}[- ]?[0-9]{4}\b"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("phone", r"\+?[0-9]{0,3}[-. ]?\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}\b"),
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
]


def mask_pii(text: Column, kinds: Sequence[str] = ("credit_card", "ssn", "phone", "email")) -> Column:
    for kind, pattern in PII_PATTERNS:
        if kind in kinds:
            text = F.regexp_replace(text, pattern, f"[{kind.upper()}]")
    return text


def interactions(df: DataFrame, columns: Sequence[str] | None = None, max_interactions: int = 20) -> DataFrame:
    """Product, ratio and difference of column pairs, in column order.

    The limit is looked at before each pair, and each pair adds three columns: 20 gives 7 pairs.
    """
    cols = measures(df, columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    made: dict[str, Column] = {}
    for a, b in pairs[: max(0, -(-max_interactions // 3))]:
        made[f"{a}_x_{b}"] = F.col(a) * F.col(b)
        made[f"{a}_div_{b}"] = per(F.col(a), F.col(b))
        made[f"{a}_diff_{b}"] = F.col(a) - F.col(b)
    return df.withColumns(made) if made else df

