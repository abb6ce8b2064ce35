"""Exact order statistics and quantiles in four scans, without sorting the table.

The built-in exact ``percentile`` keeps every distinct value of a column in one task. Here two pivots around each wanted rank
come from a small sample, one scan counts what lies below and at them, and the next one writes only the values between the
pivots to a narrow table. Pivots need not be good, as they are counted: a bracket that still holds many values is cut again,
but in the narrow table. A hot value ends the search as soon as it is a pivot. All columns and ranks share the scans.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from fractions import Fraction
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType

from brightloom.functions.expressions import time_literal
from brightloom.staging import stage

#: values of a bracket that are sorted in one group, and values of a sample from which pivots are taken
PICK_ROWS = 10_000
SAMPLE_ROWS = 4_000


@dataclass
class Ask:
    """Ranks (0-based, ascending) wanted from the non-null values of ``expr``; ``n`` is their number."""

    expr: Column
    n: int
    ranks: Sequence[int]
    found: dict[int, Any] = field(default_factory=dict)


@dataclass
class _Bracket:
    """The values strictly between ``low`` and ``high`` (None: open) of the ask numbered ``k`` that still hold the wanted rank."""

    ask: Ask
    k: int
    rank: int
    inside: int
    below: int = 0
    low: Any = None
    high: Any = None


def _long(df: DataFrame, exprs: Sequence[Column]) -> DataFrame:
    """(k, x): the non-null values of expressions of one type, each with the number of its expression.

    Plans over it are as narrow for hundreds of columns as for one, which keeps them small on the driver.
    """
    return df.select(F.posexplode(F.array(*exprs)).alias("k", "x")).filter("x is not null")


def _array(values: Sequence[Any], kind: DataType) -> Column:
    """An array of literals. Numbers are written as text, as every literal that is made alone costs several calls to the driver's JVM."""
    suffix = {DoubleType(): "D", LongType(): "L", IntegerType(): ""}.get(kind)
    # whole numbers at the end of their range and strange doubles have no literal of their own
    plain = suffix is not None and all(v is None or (math.isfinite(v) and abs(v) < 1 << 31 if suffix == "" else math.isfinite(v) and (suffix == "D" or abs(v) < 1 << 63)) for v in values)
    if not plain:
        return F.array(*[time_literal(v, kind) for v in values])
    texts = [f"CAST(NULL AS {kind.simpleString()})" if v is None else f"{float(v)!r}D" if suffix == "D" else f"{v}{suffix}" for v in values]
    return F.expr(f"array({', '.join(texts)})")


def _at(values: Sequence[Any], kind: DataType) -> Column:
    """The value for the ``k`` of a row."""
    return F.get(_array(values, kind), F.col("k"))


def _by_key(brackets: list[_Bracket]) -> tuple[list[list[_Bracket]], int]:
    """The brackets of each ``k``, and the most of one."""
    held: list[list[_Bracket]] = [[] for _ in range(max(b.k for b in brackets) + 1)]
    for b in brackets:
        held[b.k].append(b)
    return held, max(map(len, held))


def _pivots(sampled: DataFrame, held: list[list[_Bracket]], width: int) -> list[list[tuple[Any, Any]]]:
    """For each bracket two values of a sample that very likely lie around its rank; None where the sample ends."""
    m = F.size("v")

    def around(p: Column) -> Column:
        reach = 3.0 * F.sqrt(m * p * (1.0 - p)) + 2.0
        lo, hi = F.floor(p * m - reach).cast("int"), F.ceil(p * m + reach).cast("int")
        only = F.when((lo < 0) & (hi >= m), F.get("v", F.floor(m / 2).cast("int")))  # a sample too small for two pivots still gives one
        return F.struct(F.coalesce(only, F.get("v", lo)).alias("lo"), F.coalesce(only, F.get("v", hi)).alias("hi"))

    shares = [[(b.rank + 0.5) / b.inside for b in row] + [None] * (width - len(row)) for row in held]
    share = F.get(F.array(*[_array(row, DoubleType()) for row in shares]), F.col("k"))
    ordered = sampled.groupBy("k").agg(F.sort_array(F.collect_list("x")).alias("v"))  # about SAMPLE_ROWS values each
    out: list[list[tuple[Any, Any]]] = [[(None, None)] * width for _ in held]
    for r in ordered.select("k", F.transform(share, around).alias("p")).collect():  # one row per ask
        out[r["k"]] = [(p["lo"], p["hi"]) for p in r["p"]]
    return out


def _cut(values: DataFrame, sampled: DataFrame, brackets: list[_Bracket], kind: DataType) -> None:
    """Narrow each bracket by counted pivots."""
    held, width = _by_key(brackets)
    cuts = _pivots(sampled.filter(F.col("k").isin([k for k, row in enumerate(held) if row])), held, width)
    tallies = []
    for j in range(width):
        for side in (0, 1):
            pivot = _at([row[j][side] for row in cuts], kind)
            tallies += [F.count_if(F.col("x") < pivot), F.count_if(F.col("x") <= pivot)]
    rows = values.groupBy("k").agg(*[t.alias(f"a{i}") for i, t in enumerate(tallies)]).collect()  # one row per ask
    got = {r["k"]: r[1:] for r in rows}
    for k, row in enumerate(held):
        for j, b in enumerate(row):
            (lo, hi), (under_lo, to_lo, under_hi, to_hi) = cuts[k][j], got[k][4 * j : 4 * j + 4]
            if lo is not None and b.rank < under_lo:
                b.high, b.inside = lo, under_lo
            elif lo is not None and b.rank < to_lo:
                b.ask.found[b.rank] = lo
            elif hi is None or b.rank < under_hi:
                b.low, b.below = lo, to_lo if lo is not None else 0
                b.high, b.inside = hi, (under_hi if hi is not None else b.inside) - b.below
            elif b.rank < to_hi:
                b.ask.found[b.rank] = hi
            else:
                b.low, b.below, b.inside = hi, to_hi, b.inside - to_hi


def _inside(values: DataFrame, groups: list[list[_Bracket]], kind: DataType) -> DataFrame:
    """(k, x): the values of each distinct bracket, with the number of its group."""
    of: list[list[int]] = [[] for _ in range(max(g[0].k for g in groups) + 1)]
    for i, g in enumerate(groups):
        of[g[0].k].append(i)
    x, marks = F.col("x"), []
    for j in range(max(map(len, of))):
        place = [row[j] if j < len(row) else None for row in of]
        low, high = (_at([None if i is None else getattr(groups[i][0], side) for i in place], kind) for side in ("low", "high"))
        within = F.coalesce(x > low, F.lit(True)) & F.coalesce(x < high, F.lit(True))
        marks.append(F.when(within, _at(place, IntegerType())))
    narrow = values.filter(F.coalesce(*marks).isNotNull()).select(F.explode(F.array(*marks)).alias("k"), "x")
    return stage(narrow.filter("k is not null"), "inside")


def order_statistics(df: DataFrame, asks: Sequence[Ask], pick_rows: int = PICK_ROWS, sample_rows: int = SAMPLE_ROWS) -> None:
    """Fill ``ask.found[rank]`` for every ask. The table is scanned for a sample, for counts, and for the values between; asks of one type
    share the scans."""
    wanted = [a for a in asks if any(0 <= r < a.n for r in a.ranks)]
    by_kind: dict[DataType, list[Ask]] = {}
    for a, f in zip(wanted, df.select(*[a.expr.alias(f"x{i}") for i, a in enumerate(wanted)]).schema):
        by_kind.setdefault(f.dataType, []).append(a)
    for kind, some in by_kind.items():
        work = [_Bracket(a, k, r, a.n) for k, a in enumerate(some) for r in sorted(set(a.ranks)) if 0 <= r < a.n]
        exprs, most = [a.expr for a in some], max(a.n for a in some)
        values = _long(df, exprs)
        if most > pick_rows:
            _cut(values, _long(df.sample(min(1.0, sample_rows / most), seed=7), exprs), work, kind)
        _settle(values, [b for b in work if b.rank not in b.ask.found], kind, pick_rows, sample_rows)


def _settle(values: DataFrame, work: list[_Bracket], kind: DataType, pick_rows: int, sample_rows: int) -> None:
    """Write the values of the brackets, sort the short ones and search the others in what was written."""
    if not work:
        return
    shared: dict[tuple, list[_Bracket]] = {}
    for b in work:
        shared.setdefault((b.k, b.low, b.high), []).append(b)
    groups = list(shared.values())
    narrow = _inside(values, groups, kind)
    short = [i for i, g in enumerate(groups) if g[0].inside <= pick_rows]
    if short:
        places = F.array(*[_array([b.rank - b.below for b in (g if i in short else ())], IntegerType()).cast("array<int>") for i, g in enumerate(groups)])
        ordered = narrow.filter(F.col("k").isin(short)).groupBy("k").agg(F.sort_array(F.collect_list("x")).alias("v"))
        for r in ordered.select("k", F.transform(F.get(places, F.col("k")), lambda p: F.get("v", p)).alias("f")).collect():
            for b, v in zip(groups[r["k"]], r["f"]):
                b.ask.found[b.rank] = v
    long = [i for i in range(len(groups)) if i not in short]
    if not long:
        return
    inner = {i: Ask(F.col("x"), groups[i][0].inside, [b.rank - b.below for b in groups[i]]) for i in long}
    again = [_Bracket(a, i, r, a.n) for i, a in inner.items() for r in sorted(set(a.ranks))]
    rest = narrow.filter(F.col("k").isin(long))
    # a sample of each bracket of its own size, so that every bracket is cut
    _cut(rest, rest.sampleBy("k", {i: min(1.0, sample_rows / a.n) for i, a in inner.items()}, seed=7), again, kind)
    _settle(rest, [b for b in again if b.rank not in b.ask.found], kind, pick_rows, sample_rows)
    for i, a in inner.items():
        for b in groups[i]:
            b.ask.found[b.rank] = a.found[b.rank - b.below]


def counts(df: DataFrame, exprs: Sequence[Column]) -> list[int]:
    """The number of non-null values of each expression."""
    if not exprs:
        return []
    many = len(exprs)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(many, np.int64)
        for b in batches:
            n += [b.num_rows - c.null_count for c in b.columns]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(many, dtype=np.int32)), pa.array(n)], ["k", "n"])

    given = df.select(*[F.when(e.isNotNull(), F.lit(True)).alias(f"x{i}") for i, e in enumerate(exprs)])
    got = dict(map(tuple, given.mapInArrow(tally, "k int, n long").groupBy("k").agg(F.sum("n")).collect()))
    return [got.get(k, 0) for k in range(len(exprs))]


def _place(q: float, n: int) -> tuple[int, Fraction]:
    """Rank at or below the quantile and the share of the way to the next rank."""
    h = Fraction(q).limit_denominator(1_000_000) * (n - 1)
    return int(h), h - int(h)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str | Column], probabilities: Sequence[float], known: Sequence[int] | None = None
) -> list[list[float | None]]:
    """Linear-interpolated quantiles of each column, as pandas and SQL ``quantile_cont`` define them."""
    exprs = [F.col(c) if isinstance(c, str) else c for c in columns]
    asks = []
    for e, n in zip(exprs, known if known is not None else counts(df, exprs)):
        ranks = []
        for q in probabilities:
            k, rest = _place(q, n) if n else (0, Fraction(0))
            ranks += [k, k + 1] if rest else [k]
        asks.append(Ask(e, n, ranks))
    order_statistics(df, asks)
    out: list[list[float | None]] = []
    for a in asks:
        row: list[float | None] = []
        for q in probabilities:
            if not a.n:
                row.append(None)
                continue
            k, rest = _place(q, a.n)
            low = float(a.found[k])
            row.append(low + (float(a.found[k + 1]) - low) * float(rest) if rest else low)
        out.append(row)
    return out


def approx_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> list[list[Any]]:
    """One-scan approximate variant with the same result shape."""
    got = df.agg(
        *[F.percentile_approx(F.col(c), list(probabilities), 10_000).alias(f"a{i}") for i, c in enumerate(columns)]
    ).first()
    return [list(g) if g is not None else [None] * len(probabilities) for g in got]
