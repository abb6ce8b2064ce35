"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: XML-style white space of the word rules: space and the ASCII controls 9 to 13
SPACE = "[\\x20\\x09-\\x0D]"
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(c, _UPPER, _UPPER.lower())


def ascii_lower_table() -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that an operator reads, under fixed names; all other columns stay behind."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session: the cluster's own measure of how wide a stage should be."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(rows: Iterable, weight, most: int) -> Iterator[list]:
    """Cut a stream of rows into lists of a bounded total weight (one heavier row is a list of its own)."""
    held, total = [], 0
    for row in rows:
        w = weight(row)
        if held and total + w > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += w
    if held:
        yield held


def batch_slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut by the bytes of a string column, before anything of it is decoded. A longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            until = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, until - at)
            at = until


def release_memory() -> None:
    """At the end of a task: its worker stays, and what Arrow and numpy held goes back to the machine."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()
