"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hhlens.session import cut_lineage, scratch_path

__all__ = ["arrow_batches", "cut_lineage", "fresh", "global_rank", "is_empty", "scratch_path", "shared_fs", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(prefix: str, taken) -> str:
    """A column name that no caller column has (extra columns may clash with ours)."""
    low = {c.lower() for c in taken}
    name = prefix
    while name.lower() in low:
        name = f"{prefix}_{uuid.uuid4().hex[:6]}"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that every executor reaches (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside hand rows to Python in Arrow batches of about ``size`` bytes, so that the
    copies of a batch (JVM, socket, Python) stay small for long texts; the session's own limit is
    back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def global_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` (one row per value of ``column``) with its 0-based rank, nulls last.

    Range partitions are sorted locally; only one count per partition reaches the driver."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(column).asc_nulls_last()
    pid, pos = fresh("_pid", df.columns), fresh("_pos", df.columns)
    parts = cut_lineage(df.repartitionByRange(n, key).withColumn(pid, F.spark_partition_id()))
    offsets, total = [], 0
    for r in parts.groupBy(pid).count().orderBy(pid).collect():
        offsets.append((r[0], total))
        total += r["count"]
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("long"))
    off = fresh("_off", df.columns)
    small = df.sparkSession.createDataFrame(offsets, f"{pid} int, {off} long")
    from pyspark.sql import Window
    w = Window.partitionBy(pid).orderBy(key)
    return (parts.withColumn(pos, F.row_number().over(w)).join(F.broadcast(small), pid)
            .withColumn(name, F.col(off) + F.col(pos) - 1).drop(pid, pos, off))
