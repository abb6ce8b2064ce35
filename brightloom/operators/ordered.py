"""Order-dependent computation over whole tables without a single-task window.

``Window.orderBy`` without ``partitionBy`` moves the table to one task, and a window partitioned by a key
that holds a third of the rows moves a third of it. Here rows are range partitioned on the full ordering
(partition keys first), numbered, and cut into equal chunks; every chunk also receives the last rows of
the chunk before it, so a trailing frame never needs a row outside its own chunk. No group in any of
these plans depends on how many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from brightloom.staging import stage
from brightloom.unions import union_all

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition number above these bits


def _range_sorted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage ``df`` sorted over range partitions with ``_part`` and the position ``_pos`` inside it."""
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
    ranged = ranged.sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
    mid = F.monotonically_increasing_id()
    numbered = ranged.withColumn("_mid", mid)
    numbered = numbered.select(
        *df.columns,
        F.shiftrightunsigned("_mid", _LOCAL_BITS).cast("int").alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_pos"),
    )
    return stage(numbered, "sorted")


def _before_part(per_part: DataFrame, amount: str, out: str) -> DataFrame:
    """Total of ``amount`` in earlier range partitions. One row per range partition, so one task is enough."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return per_part.select("_part", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias(out))


def row_index(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Add ``_rn``: the 0-based position under (partition_by, order_by). The keys must be unique per row."""
    staged = _range_sorted(df, [*partition_by, *order_by])
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _before_part(sizes, "_n", "_offset")
    return (
        staged.join(F.broadcast(offsets), "_part")  # one row per range partition
        .withColumn("_rn", F.col("_offset") + F.col("_pos"))
        .drop("_offset", "_pos")
    )


def prefix_sum(df: DataFrame, order_by: Sequence[str], amount: str, out: str) -> DataFrame:
    """Add the total of ``amount`` over all rows that sort before this one (0 for the first)."""
    staged = _range_sorted(df, order_by)
    sums = staged.groupBy("_part").agg(F.sum(amount).alias("_s"))
    offsets = _before_part(sums, "_s", "_offset")
    inside = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_part", "_pos", "_offset")
    )


def with_halo(indexed: DataFrame, reach: int, chunk_rows: int = 8192) -> DataFrame:
    """Assign rows to ``_chunk`` and copy each chunk's last ``reach`` rows into the next one.

    ``_own`` is false on the copies. A chunk is at least ``reach`` rows, so one copy is enough.
    """
    size = max(chunk_rows, reach)
    chunk = F.expr(f"_rn div {size}")
    near_end = (F.col("_rn") % size) >= size - reach
    homes = F.when(near_end & F.lit(reach > 0), F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    return (
        indexed.withColumn("_home", chunk)
        .withColumn("_chunk", F.explode(homes))
        .withColumn("_own", F.col("_chunk") == F.col("_home"))
        .drop("_home")
    )


def spread_chunks(chunked: DataFrame) -> DataFrame:
    """Shuffle whole chunks over the configured number of tasks (windows over chunks are CPU bound)."""
    tasks = int(chunked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunked.repartition(tasks, "_chunk")


def forward_fill(indexed: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Carry the last non-null value forward, inside ``partition_by``, across range partitions.

    Fills inside each range partition with a running window, then carries the last value over the
    partition borders from a table with two rows per range partition. Adds ``_filled_<column>``.
    """
    key = F.struct(*[F.col(c) for c in partition_by]) if partition_by else F.lit(0)
    rows = indexed.withColumn("_key", key)
    inside = W.partitionBy("_part", "_key").orderBy("_rn").rowsBetween(W.unboundedPreceding, 0)
    for c in columns:
        rows = rows.withColumn(f"_filled_{c}", F.last(c, ignorenulls=True).over(inside))

    # for every range partition: its first key, and its last key with the values standing at its end
    edges = rows.groupBy("_part").agg(
        F.min_by("_key", "_rn").alias("_head"),
        F.max_by("_key", "_rn").alias("_tail"),
        *[F.max_by(f"_filled_{c}", "_rn").alias(f"_tail_{c}") for c in columns],
    )
    heads = edges.select(
        "_part", F.lit(0).alias("_side"), F.col("_head").alias("_edge_key"),
        *[F.lit(None).cast(indexed.schema[c].dataType).alias(f"_carry_{c}") for c in columns],
    )
    tails = edges.select(
        "_part", F.lit(1).alias("_side"), F.col("_tail").alias("_edge_key"),
        *[F.col(f"_tail_{c}").alias(f"_carry_{c}") for c in columns],
    )
    run = W.partitionBy("_edge_key").orderBy("_part", "_side").rowsBetween(W.unboundedPreceding, -1)
    carried = union_all(heads, tails)
    for c in columns:
        carried = carried.withColumn(f"_carry_{c}", F.last(f"_carry_{c}", ignorenulls=True).over(run))
    carried = carried.filter("_side = 0").drop("_side")

    out = rows.join(F.broadcast(carried), "_part", "left")  # one row per range partition
    for c in columns:
        take = F.col("_edge_key").eqNullSafe(F.col("_key"))
        out = out.withColumn(
            f"_filled_{c}", F.coalesce(F.col(f"_filled_{c}"), F.when(take, F.col(f"_carry_{c}")))
        )
    return out.drop("_key", "_edge_key", *[f"_carry_{c}" for c in columns])
