"""Stage tables: cut lineage by writing to the shared checkpoint folder.

A stage table is ordinary Parquet, so later passes prune columns, read only what they need, know the
real size of the table (which lets Spark choose broadcast joins by measured size) and survive the loss
of executors, since nothing lives in executor memory.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from brightloom.unions import guard


#: folders of local sessions that name none, by application; the setting itself cannot be changed once a session runs
_local: dict[str, str] = {}
#: paths written inside each open ``passing_stages``
_passing: list[list[str]] = []


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="brightloom-")
        root = _local[app]
    return root.rstrip("/")


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """Remove the stage tables written inside at the end, but for those with ``keep``: nothing that lives on may read another.

    Blocks may be nested: a table that is kept belongs to the block around.
    """
    _passing.append([])
    try:
        yield
    finally:
        for name in _passing.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str = "stage", compression: str = "snappy", keep: bool = False) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    guard(spark)
    path = stage_path(spark, label)
    owners = _passing[:-1] if keep else _passing
    if owners:
        owners[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
