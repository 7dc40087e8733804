"""Readers, writers and the prediction sink.

Files go to cluster-shared storage: callers pass paths on it, and helpers that need a
scratch location use ``session.scratch_path`` (under ``spark.checkpoint.dir``), never a
machine-local temporary folder.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hhlens.session import scratch_path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", header: bool = True) -> DataFrame:
    """``read.csv(file, header=TRUE, sep=",")``.  Give the schema: inference costs an extra
    pass over the files and guesses types per file; it is allowed only for exploration."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "FAILFAST")
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def write_store(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Fast store (``saveRDS``) -> Parquet; the writer creates missing folders."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``readRDS`` -> Parquet scan (column pruning and filter pushdown apply)."""
    return spark.read.parquet(path)


# Aimed size of a bucket, and how far over the mean bucket (and over this many rows) a table's
# largest one may be: a bucket is read by one task.
BUCKET_BYTES = 256 << 20
BUCKET_SKEW = 8
BUCKET_ROWS = 1_000_000


def bucket_count(spark: SparkSession, *tables: DataFrame) -> int:
    """One number of buckets for tables that join: the bytes of the largest source they scan
    over ``BUCKET_BYTES``, at least one per core, at most what Spark allows.  (A join's own
    planned size is the product of its sides, far too much.)"""
    size = 0
    for t in tables:
        leaves = t._jdf.queryExecution().optimizedPlan().collectLeaves()
        size = max([size, *[int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]])
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return max(1, min(most, max(spark.sparkContext.defaultParallelism, math.ceil(size / BUCKET_BYTES))))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> bool:
    """Store whose files are bucketed and sorted by ``key``: group-bys and joins on it need no
    exchange, each file a task reads is in key order.  One exchange deals the rows, so a bucket is one file.

    A bucket is read by one task, so a key that holds much of the table must not be bucketed:
    where the largest bucket (counted first; at most ``buckets`` rows leave the count) has
    over ``BUCKET_ROWS`` rows and ``BUCKET_SKEW`` mean buckets, or there is no row (and so no
    bucket file to hold the schema), the plain store is written and False returned.  A NULL
    key has a bucket like any other."""
    spark = df.sparkSession
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count("*").alias("n"))
    top, total = sizes.agg(F.max("n"), F.sum("n")).first()
    if top is None or (top > BUCKET_ROWS and top > BUCKET_SKEW * total / buckets):
        write_store(df, path)
        return False
    name = f"store_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")                    # external: the files stay
    return True


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A store of ``write_bucketed`` (of any application) with its buckets known to the planner.
    The table entry lives in the session's catalog under a name made from the path."""
    name = f"store_{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}|{key}|{buckets}').hex}"
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def write_predictions(df: DataFrame, path: str, key: str = "id", pred: str = "pobre",
                      mode: str = "overwrite") -> str:
    """``write.csv(data.frame(id, pobre), row.names = FALSE)``: two columns with a header.
    Written in parallel part files (no single-file coalesce, which would funnel every row
    through one task)."""
    (df.select(F.col(key).alias("id"), F.col(pred).cast("int").alias("pobre"))
     .write.mode(mode).option("header", True).csv(path))
    return path


PREDICTION_SCHEMA = "id BIGINT, pobre INT"


def read_predictions(spark: SparkSession, path: str, schema: str = PREDICTION_SCHEMA) -> DataFrame:
    return read_csv(spark, path, schema)


def confirm_sink(spark: SparkSession, path: str, expected: DataFrame, schema: str = PREDICTION_SCHEMA
                 ) -> bool:
    """``file.exists(path)``, strengthened: the files read back with the expected schema
    and the same row count."""
    want = [c.split()[0] for c in schema.split(", ")]
    if spark.read.option("header", True).csv(path).columns != want or expected.columns != want:
        return False
    back = spark.read.schema(schema).option("header", True).csv(path)
    known = [F.count(c) for c in want]  # a value that does not fit its type reads as NULL
    return back.agg(F.count("*"), *known).first() == expected.agg(F.count("*"), *known).first()


def fmt_param(x: Column, decimals: int = 4) -> Column:
    """A parameter below 1e5 as R prints ``round(x, 4)``: 4 decimals, trailing zeros dropped, and
    ``1e-04`` to ``9e-04`` where that is shorter."""
    s = F.format_string(f"%.{decimals}f", x.cast("double"))
    s = F.regexp_replace(F.regexp_replace(s, r"0+$", ""), r"\.$", "")
    return F.regexp_replace(s, r"^(-?)0\.000([1-9])$", "$1$2e-04")


def output_name(model: str, reg: Column, alpha: Column) -> Column:
    """``paste0(model, "_lambda_", l, "_alpha_", a, ".csv")`` with ``.`` -> ``_``."""
    return F.concat(F.lit(f"{model}_lambda_"), F.regexp_replace(fmt_param(reg), r"\.", "_"),
                    F.lit("_alpha_"), F.regexp_replace(fmt_param(alpha), r"\.", "_"), F.lit(".csv"))


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Inline dimension table (a literal, e.g. department codes and names)."""
    return spark.createDataFrame(list(rows), schema)


def preview(df: DataFrame, key: str = "id", n: int = 6) -> DataFrame:
    """``head(df)`` with a defined order: the first ``n`` rows by key (a top-k, so each
    task keeps only ``n`` rows before the final merge)."""
    return df.orderBy(key).limit(n)


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
