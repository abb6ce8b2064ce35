"""Mix sources to target weights along a curriculum (DataFrame functions only).

Every source has a weight schedule ``w(t) = share * (1 + ramp * (2t - 1))`` over training time t in [0, 1]. Its integral,
times all words, is the words demanded of the source up to t; the whole integral is the target. A document is a stretch of
its source's word stream, and the inverse of the integrated schedule at the middle of the stretch is its training position.

* Sources in code point order, null last, weigh ``weights`` in turn. A target stops at ``max_repeats`` times the source's
  size; the excess is shared by weight among the others until no target is above (water filling by one sort of sources).
* A source is read in the order of a hash of the document id. Whole passes come first. The last pass goes once through the source and
  takes every document that still fits into the rest of the target; documents of at least 1/64 of that rest come first, the
  largest powers of two before the others, so that small ones can fill what they leave. At the end the rest is smaller than every
  document that was not taken, and the smallest of those is taken too if that is nearer to the target.
* Null text has size 0. Repeated rows count as rows, also in the last pass: every row has a number of its own, which decides between
  rows that are equal in all that is read. An empty table gives an empty result. Null ids hash as the empty text, with the size.
* A document's place is its stretch in a whole pass; the last pass is squeezed into the rest of the target.
* Cumulative sizes are taken in two levels, over hash ranges and inside each range, so that a source with a third of all
  rows is spread over many tasks. Only counts per source and per range meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brightloom.llm.common import NOT_SPACE
from brightloom.staging import stage

#: rows of a hash range, on average
RANGE_ROWS = 4096
#: share of the last pass's target from which a document is placed by its size
LARGE = 64
#: change of a source's weight from the start (1 - ramp) to the end (1 + ramp), in turn over the sources
RAMPS = (-0.5, 0.0, 0.5)


def with_size(docs: DataFrame, text_col: str = "text", name: str = "size") -> DataFrame:
    """Words (runs without white space) of a text; null has none."""
    return docs.withColumn(name, F.coalesce(F.regexp_count(F.col(text_col), F.lit(NOT_SPACE)), F.lit(0)).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3, ramps: Sequence[float] = RAMPS) -> DataFrame:
    """(_null, _src, source_size, target, _ramp) from rows with (_null, _src, size): one row per source."""
    per = sizes.groupBy("_null", "_src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy("_null", "_src")
    rank = F.row_number().over(order) - 1
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(rank, F.lit(len(values))) + 1)
    ranked = per.withColumn("_w", pick([int(w) for w in weights]).cast("decimal(20,0)")).withColumn("_ramp", pick([float(r) for r in ramps]))
    ranked = ranked.withColumn("_cap", (F.col("source_size") * max_repeats).cast("decimal(20,0)"))
    everything = Window.partitionBy(F.lit(1))
    # smallest cap per weight first: each source is capped if its share of what is left would exceed its cap
    before = Window.orderBy(F.col("_cap").cast("double") / F.col("_w").cast("double"), "_null", "_src").rowsBetween(Window.unboundedPreceding, -1)
    asked = ranked.select(
        "*",
        F.sum("source_size").over(everything).cast("decimal(20,0)").alias("_all"),
        F.sum("_w").over(everything).cast("decimal(20,0)").alias("_weights"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0)).cast("decimal(20,0)").alias("_cap_before"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).cast("decimal(20,0)").alias("_w_before"),
    )
    left = lambda a, b: (F.col(a) - F.col(b)).cast("decimal(19,0)")
    capped = F.col("_cap").cast("decimal(19,0)") * left("_weights", "_w_before") <= F.col("_w").cast("decimal(19,0)") * left("_all", "_cap_before")
    flagged = asked.withColumn("_capped", capped)
    zero = F.lit(0).cast("decimal(20,0)")
    held = lambda c: F.sum(F.when(F.col("_capped"), F.col(c)).otherwise(zero)).over(everything)
    share = (F.col("_all") - held("_cap")).cast("double") / (F.col("_weights") - held("_w")).cast("double")
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(F.col("_w").cast("double") * share)
    return flagged.select("_null", "_src", "source_size", target.alias("target"), "_ramp")


def _sourced(rows: DataFrame, source_col: str) -> DataFrame:
    """``rows`` with the source as two columns without nulls."""
    return rows.withColumns({"_null": F.col(source_col).isNull(), "_src": F.coalesce(F.col(source_col).cast("string"), F.lit(""))})


def _keyed(rows: DataFrame, id_col: str, size_col: str, tie: Sequence[str], ranges: int) -> DataFrame:
    """``rows`` (with ``_large``, the size from which a document is large) with the order inside a source and its range in it."""
    size = F.col(size_col).cast("long")
    large = F.when((size > 0) & (size >= F.col("_large")), F.length(F.bin(size)) - 1).otherwise(F.lit(0)).cast("int")
    # rows of one id, null among them, are spread by their sizes and ties
    spread = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), *[c.cast("string") for c in (size, *map(F.col, tie))]))
    one = F.when(F.col(id_col).isNull(), spread).otherwise(F.md5(F.col(id_col).cast("string")))
    key = F.struct((-large).alias("c"), one.alias("h"), F.col(id_col).cast("string").alias("i"), size.alias("n"), *[F.col(t).alias(t) for t in tie], F.col("_deal").alias("d"))
    at = F.floor(F.conv(F.substring(one, 1, 8), 16, 10).cast("double") / 4294967296.0 * ranges)
    return rows.withColumns({"_key": key, "_range": (at + (F.lit(64) - large) * ranges).cast("long")}).drop("_large")


def _range_offsets(rows: DataFrame) -> DataFrame:
    """(_null, _src, _range, _offset): words of a source before each of its ranges."""
    before = Window.partitionBy("_null", "_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.groupBy("_null", "_src", "_range").agg(F.sum("size").alias("_words"))
    return cut.select("_null", "_src", "_range", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"))


def _ends(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_end``: words of the source up to and with the row, in two levels."""
    inside = Window.partitionBy("_null", "_src", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_inside", F.sum("size").over(inside)).join(_range_offsets(rows), ["_null", "_src", "_range"]).withColumn(
        "_end", F.col("_inside") + F.col("_offset")
    ).drop("_inside", "_offset")


def with_passes(targets: DataFrame) -> DataFrame:
    """``targets`` with the whole passes, the rest ``_r1`` for the last one, and the size from which a document is large."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = targets.withColumn("_passes", passes).withColumn("_r1", F.col("target") - F.col("_passes") * F.col("source_size"))
    return state.withColumn("_large", F.col("_r1") / LARGE)


def last_pass(narrow: DataFrame, state: DataFrame) -> tuple[DataFrame, int]:
    """(``state`` with rest ``_r`` and last key ``_k`` of each round and the document ``_more``, number of rounds), a row per source.

    A round takes the documents that fit, from the last key on, until the first that does not; so the rounds together are one walk
    through the source that skips what does not fit. Rests shrink by about half in a round.
    """
    state, k = stage(state, "targets"), 0
    while True:
        k += 1
        here = state.select("_null", "_src", F.col(f"_r{k}").alias("_r"), *([F.col(f"_k{k - 1}").alias("_last")] if k > 1 else []))
        fits = narrow.join(here, ["_null", "_src"]).filter("size > 0 and size <= _r" + (" and _key > _last" if k > 1 else ""))
        taken = _ends(fits.drop("_last")).filter("_end <= _r").groupBy("_null", "_src").agg(F.max("_key").alias(f"_k{k}"), F.sum("size").alias("_used"))
        taken = stage(taken, "round")
        if taken.isEmpty():
            break
        state = state.join(taken, ["_null", "_src"], "left").withColumn(f"_r{k + 1}", F.col(f"_r{k}") - F.coalesce("_used", F.lit(0))).drop("_used")
        state = stage(state, "targets")
    rest = F.col(f"_r{k}")
    left = narrow.join(state, ["_null", "_src"]).filter((F.col("size") > 0) & (rest > 0) & ~_taken("size", k - 1)).groupBy("_null", "_src", rest.alias("_rest")).agg(F.min(F.struct("size", "_key")).alias("_least"))
    nearer = left.filter(F.col("_least")["size"] - F.col("_rest") < F.col("_rest")).select("_null", "_src", F.col("_least")["_key"].alias("_more"))
    return stage(state.join(nearer, ["_null", "_src"], "left"), "targets"), k - 1


def _taken(size: str, rounds: int) -> Column:
    """Whether one of the rounds took the row."""
    found = F.lit(False)
    for k in range(1, rounds + 1):
        now = (F.col(size) <= F.col(f"_r{k}")) & (F.col("_key") <= F.col(f"_k{k}"))
        found = found | F.coalesce(now & (F.col("_key") > F.col(f"_k{k - 1}")) if k > 1 else now, F.lit(False))
    return found


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
    weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3, ramps: Sequence[float] = RAMPS, tie: Sequence[str] = (),
) -> DataFrame:
    """``docs`` (with a size per row) with ``source_size``, ``target``, ``copies``, ``taken`` and the parts of the position.

    ``docs`` is written once with a number for each row. Columns of the input must not use the added names. ``tie`` names columns that
    tell rows of equal id and size apart. ``_start`` is the first word of the row in a pass over its source, ``_passes`` the number of
    whole passes.
    """
    rows = stage(_sourced(docs, source_col).withColumn("_deal", F.monotonically_increasing_id()), "mix-rows", "zstd")
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    narrow = rows.select("_null", "_src", "_deal", F.col(id_col).alias("_id"), F.col(size_col).alias("size"), *tie)
    first = stage(with_passes(source_targets(narrow, weights, max_repeats, ramps)), "targets")
    limits = first.select("_null", "_src", "_large")
    narrow = stage(_keyed(narrow.join(limits, ["_null", "_src"]), "_id", "size", tie, ranges).select("_null", "_src", "_range", "_key", "size"), "keys")
    state, rounds = last_pass(narrow, first.drop("_large"))
    rows = _keyed(rows.join(limits, ["_null", "_src"]), id_col, size_col, tie, ranges)
    inside = Window.partitionBy("_null", "_src", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum(size_col).over(inside), F.lit(0)))
    rows = rows.join(_range_offsets(narrow).join(state, ["_null", "_src"]), ["_null", "_src", "_range"]).withColumn("_start", F.col("_start") + F.col("_offset"))
    last = _taken(size_col, rounds) | F.coalesce(F.col("_key") == F.col("_more"), F.lit(False))
    copies = F.when(F.col(size_col) == 0, F.lit(0)).otherwise(F.least(F.lit(max_repeats), F.col("_passes") + last.cast("long")))
    rows = rows.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col(size_col))
    return rows.drop("_key", "_range", "_offset", "_null", "_src", "_deal", "_more", *[f"_{c}{k}" for c in "rk" for k in range(1, rounds + 2)])


def position(copy: Column | int) -> Column:
    """Training position in [0, 1] of a copy of a planned row: when the integrated schedule reaches the copy's middle.

    Solves ``t + ramp * (t * t - t) = u`` for the share u of the target that is demanded before.
    """
    middle, size, target, ramp = F.col("_start") + F.col("size") / 2.0, F.col("source_size"), F.col("target"), F.col("_ramp")
    passes = F.col("_passes")
    before = F.when(F.lit(copy) < passes, F.lit(copy) * size + middle).otherwise(passes * size + middle * ((target - passes * size) / size))
    u = F.least(F.lit(1.0), before / target)
    b = 1.0 - ramp
    root = (F.sqrt(F.greatest(F.lit(0.0), b * b + 4.0 * ramp * u)) - b) / (2.0 * ramp)
    return F.when(F.abs(ramp) < 1e-9, u).otherwise(root)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3, ramps: Sequence[float] = RAMPS,
) -> DataFrame:
    """Training order: one row per taken copy of a document, range-sorted by ``position``.

    Keeps all columns of ``docs`` (packed meanwhile, so that none can clash) and adds ``copy`` (from 0) and ``position``;
    an input column of such a name is replaced. Documents that the mix does not take are not in it.
    """
    packed = with_size(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    ), "_text").withColumn("_digest", F.xxhash64("_text")).drop("_text")
    planned = plan_mix(packed, "_id", "_source", "size", weights, max_repeats, ramps, tie=["_digest"]).filter("copies > 0")
    copies = planned.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    placed = copies.withColumn("_position", position(F.col("_copy")))
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("copy", "position")]
    return placed.orderBy("_position", "_id", "_copy").select(*kept, F.col("_copy").alias("copy"), F.col("_position").alias("position"))
