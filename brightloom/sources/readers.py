"""Readers: CSV folders, tables, object stores and several sources at once."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from brightloom.unions import union_all

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv", "json")
FETCH_ROWS = 10_000


def _align(frames: list[DataFrame]) -> list[DataFrame]:
    """Cast a column that differs between files to double (all numeric) or text."""
    kinds: dict[str, set[str]] = {}
    numeric: dict[str, bool] = {}
    for df in frames:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
            numeric[f.name] = numeric.get(f.name, True) and isinstance(f.dataType, T.NumericType)
    common = {c: "double" if numeric[c] else "string" for c, k in kinds.items() if len(k) > 1}
    return [df.withColumns({c: F.col(c).cast(t) for c, t in common.items() if c in df.columns}) for df in frames]


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union of tables by column name; a column absent from one is null there."""
    return union_all(*_align(frames), missing=True)


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> files, found in one job over all files."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    first = (
        lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id())
        .groupBy("file").agg(F.min_by("value", "at").alias("header"))
    )
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():  # a file listing
        groups.setdefault(r["header"], []).append(r["file"])
    return groups


def read_csv_dir(spark: SparkSession, path: str, infer: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """All ``*.csv`` files of a folder, with ``source_file`` and ``extraction_timestamp``.

    Files with the same header are one scan. Pass a schema for large inputs with one header: finding
    headers and inferring types read the text once more each.
    """
    groups = {"": [path]} if schema is not None else _headers(spark, path)
    if not groups:
        raise FileNotFoundError(f"no CSV files in {path}")
    frames = []
    for files in groups.values():
        reader = spark.read.option("header", True).option("pathGlobFilter", "*.csv")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
        # one header for all: scan the folder itself instead of a long list of files
        scan = reader.csv(path if len(groups) == 1 else files)
        frames.append(scan.select("*", F.col("_metadata.file_name").alias("source_file")))
    return union_by_name(frames).withColumn("extraction_timestamp", F.current_timestamp())


def read_table(
    spark: SparkSession, table: str | None = None, query: str | None = None, jdbc: Mapping[str, str] | None = None,
    partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8,
) -> DataFrame:
    """A catalog table or query; with ``jdbc`` options, the same from a database.

    A database read is split by ``partition_column`` so that no single task fetches the whole table.
    """
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    if jdbc is None:
        df = spark.sql(query) if query else spark.table(table)
    else:
        reader = spark.read.format("jdbc").options(**jdbc).option("fetchsize", FETCH_ROWS)
        reader = reader.option("dbtable", f"({query}) q" if query else table)
        if partition_column and bounds:
            reader = reader.options(
                partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
            )
        df = reader.load()
    return df.withColumn("extraction_timestamp", F.current_timestamp())


def read_blob(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Parquet, CSV or JSON from any file system Spark reaches, with ``source_blob``."""
    kind = file_format.lower()
    if kind not in FORMATS:
        raise ValueError(f"unsupported format {file_format!r}; use one of {FORMATS}")
    reader = spark.read
    if kind == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return (
        reader.format(kind).load(path)
        .select("*", F.col("_metadata.file_path").alias("source_blob"))
        .withColumn("extraction_timestamp", F.current_timestamp())
    )


def extract_all(
    spark: SparkSession, sources: Mapping[str, Callable[[SparkSession], DataFrame]]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Open every source; keep the good ones, note the others.

    Returns the tables and a status table (source, status, records, error).
    """
    frames: dict[str, DataFrame] = {}
    rows = []
    for name, opener in sources.items():
        try:
            df = opener(spark)
            records = df.count()
            frames[name] = df
            rows.append((name, "ok", records, None))
        except Exception as problem:  # any source may fail on its own
            log.warning("source %s failed: %s", name, problem)
            rows.append((name, "failed", 0, type(problem).__name__))
    return frames, spark.createDataFrame(rows, "source string, status string, records long, error string")
