"""Joining per-key results back to rows when a key may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: rows of one key from which it is dealt over several tasks, whatever the size of the table
HOT_ROWS = 2_000_000
#: bytes of the list of hot keys up to which it is sent to every task; a longer list is joined by a shuffle
HOT_LIST_BYTES = 8 << 20
#: rows of per-key results up to which Spark may broadcast them; a broadcast table is built on the driver, and a written table
#: takes many times its file size there
BROADCAST_ROWS = 1 << 16


def lookup_join(
    rows: DataFrame, stats: DataFrame, keys: Sequence[str], weight: str, how: str = "left",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``stats`` (a staged table, one row per key) to ``rows``, left unless told otherwise.

    ``weight`` is the number of rows of each key. A small ``stats`` is broadcast by Spark from its written size, but for one of
    more than BROADCAST_ROWS rows. Otherwise the rows of a key above HOT_ROWS are dealt over several salts and its stats row is repeated once per salt. Rows with a null in
    the key match nothing; a left join deals them over all tasks. Rows are dealt by a hash of ``spread_by`` (columns that
    tell rows apart; all columns by default), so a repeated task deals them the same way.
    """
    keys = list(keys)
    top, found = stats.agg(F.max(weight), F.count(F.lit(1))).first()
    hot_rows = HOT_ROWS
    if found > BROADCAST_ROWS:
        stats = stats.hint("merge")
    if not top:
        return rows.join(stats, keys, how)

    by = F.xxhash64(*(spread_by or rows.columns))
    salts = F.ceil(F.col(weight) / F.lit(hot_rows)).cast("int")
    is_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # a null key gets a salt of its own that no stats row has, so that its rows go to all tasks
    apart = F.when(is_null, -1 - F.pmod(by, F.lit(1 << 20)))
    if top <= hot_rows:
        if how != "left":
            return rows.join(stats, keys, how)
        # 0, but not a constant, which would be taken out of the join keys
        none = stats.withColumn("_salt", F.least(F.col(weight), F.lit(0)).cast("long"))
        return rows.withColumn("_salt", F.coalesce(apart, F.lit(0))).join(none, [*keys, "_salt"], how).drop("_salt")
    hot = stats.filter(F.col(weight) > hot_rows).select(*keys, salts.alias("_salts"))
    if stats.filter(F.col(weight) > hot_rows).agg(F.sum(F.lit(16) + sum((F.octet_length(F.col(k).cast("string")) for k in keys), F.lit(0)))).first()[0] <= HOT_LIST_BYTES:
        hot = F.broadcast(hot)
    dealt = rows.join(hot, keys, "left").withColumn("_salt", F.coalesce(apart, F.pmod(by, F.col("_salts")), F.lit(0)))
    copies = F.sequence(F.lit(0), F.when(F.col(weight) > hot_rows, salts - 1).otherwise(F.lit(0)))
    spread = stats.withColumn("_salt", F.explode(copies.cast("array<long>")))
    return dealt.drop("_salts").join(spread, [*keys, "_salt"], how).drop("_salt")
