"""Writers and the shapes that business-intelligence tools take in."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, functions as F, types as T

from brightloom.functions.expressions import time_literal
from brightloom.operators.ordered import row_index
from brightloom.operators.selection import Ask, order_statistics

BATCH_ROWS = 10_000
HEAD_ROWS = 10_000


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def bi_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "Int64"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "Double"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "DateTime"
    return "String"


def bi_schema(df: DataFrame) -> DataFrame:
    """(position, name, data_type) in the types a BI dataset knows."""
    rows = [(i, f.name, bi_type(f.dataType)) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, data_type string")


def push_batches(df: DataFrame, order_by: Sequence[str], batch_rows: int = BATCH_ROWS) -> DataFrame:
    """(batch_id, row_number, payload): rows as JSON objects, nulls kept, times in ISO form."""
    payload = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    indexed = row_index(df, order_by)
    return indexed.select(
        F.expr(f"_rn div {int(batch_rows)}").alias("batch_id"), F.col("_rn").alias("row_number"), payload.alias("payload")
    )


def deliver(batches: DataFrame, send: Callable[[int, list[str]], None]) -> None:
    """Hand every batch (bounded by its size) to ``send`` on the executors."""

    def run(rows: Iterator[Row]) -> None:
        now, held = None, []
        for r in rows:
            if r["batch_id"] != now and held:
                send(now, held)
                held = []
            now = r["batch_id"]
            held.append(r["payload"])
        if held:
            send(now, held)

    batches.repartition("batch_id").sortWithinPartitions("batch_id", "row_number").foreachPartition(run)


def counted_head(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """Rows among which the first ``n`` by the keys are: at most about 2 ``n`` of them, if the keys tell rows apart.

    Key after key, the value at the wanted rank is found by counting (nulls come first); only the rows that tie with it go on to the next key.
    """
    before, ties, rest = F.lit(False), F.lit(True), n
    for key in order_by:
        k, here = F.col(key), df.filter(ties)
        total, nulls = here.agg(F.count(F.lit(1)), F.count_if(k.isNull())).first()
        if total <= 2 * rest:
            break
        if rest <= nulls:
            ties = ties & k.isNull()
            continue
        ask = Ask(k, total - nulls, [rest - nulls - 1])
        order_statistics(here, [ask])
        value = time_literal(ask.found[rest - nulls - 1], df.schema[key].dataType)
        less = k.isNull() | (k < value)
        rest -= here.filter(less).count()
        before, ties = before | (ties & less), ties & (k == value)
    return df.filter(before | ties)


def extract_head(df: DataFrame, order_by: Sequence[str], n: int = HEAD_ROWS) -> DataFrame:
    """First ``n`` rows by explicit keys. A top-n alone would send n rows of every task to one place, so the rows are cut by counting first.

    ``df`` is read several times; stage an expensive one.
    """
    return counted_head(df, order_by, n).orderBy(*order_by).limit(n)
