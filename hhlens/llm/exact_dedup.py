"""Exact dedup as a stateful stream.

The documents arrive as a file stream.  Each row is reduced to (SHA-256 digest, stable
identifier, content locator); a streaming aggregation keeps, per digest and without expiry,
the identifier that stays, its locator and the number of rows seen, in RocksDB state under
the shared checkpoint folder.  Spark pre-aggregates each micro-batch per task, so a group
that holds a third of all rows is one row per task and batch at the state store.  Every
micro-batch appends its changed keys to a log table; the last entry of a key is its state.

Hits (digests seen more than once) are checked in full: the bytes of every row of the group
are compared with the bytes found at the locator.  Rows that differ although their digests
agree (a collision) form groups of their own, by their bytes.

A restarted stream continues from its checkpoint; nothing is read twice.

Defined cases: null text counts as empty; a null doc_id ranks below every other; of rows
with equal doc_id and text the one with the largest locator stays; an empty folder gives an
empty result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, scratch_path

# State on disk; files are not preallocated (a few MB for each of many small stores otherwise).
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 1000
HOT_GROUP = 10_000


def _located(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.coalesce("_metadata.row_index", F.lit(-1)).alias("row")).alias("locator"))


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_log(spark: SparkSession, path: str, base: str,
              files_per_batch: int = FILES_PER_BATCH) -> DataFrame | None:
    """Runs the stream over all files now at ``path``, continuing under ``base`` (a shared
    folder), and returns the state of every digest ever seen: digest, keep (id, locator), n."""
    schema = spark.read.parquet(path).schema
    log = f"{base}/log"
    source = f"{path[:-1]}[{path[-1]}]"  # as a pattern, so that it may also name a single file

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    rows = _located(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                    .parquet(source))
    state = rows.groupBy(_digest().alias("digest")).agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("n"))
    with _settings(spark, STATE_SETTINGS):
        (state.writeStream.outputMode("update").foreachBatch(append)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
         .start().awaitTermination())
    if not spark.read.parquet(path).take(1):
        return None
    # ``n`` only grows, so the entry with the largest n is the latest of its key.
    return (spark.read.parquet(log).groupBy("digest")
            .agg(F.max(F.struct("n", "keep")).alias("s"))
            .select("digest", F.col("s.keep").alias("keep"), F.col("s.n").alias("n")))


def exact_dedup(spark: SparkSession, path: str, base: str | None = None,
                files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per document at ``path``: doc_id, keep_id, group_size, kept, text_sha256."""
    base = base or scratch_path(spark, "exact-dedup")
    state = state_log(spark, path, base, files_per_batch)
    docs = _located(spark.read.parquet(path))
    if state is None:
        return docs.select("doc_id", F.col("doc_id").alias("keep_id"),
                           F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                           _digest().alias("text_sha256"))
    state = cut_lineage(state)
    light = docs.select("doc_id", "locator", _digest().alias("digest"))
    out = light.join(state, "digest").select(
        "doc_id", "locator", "digest", "keep", "n",
        (F.col("keep.locator") == F.col("locator")).alias("kept"))
    odd = cut_lineage(_collisions(docs, state))
    if odd.take(1):
        out = _regroup(out, odd)
    return out.select("doc_id", F.col("keep.doc_id").alias("keep_id"),
                      F.col("n").alias("group_size"), "kept",
                      F.col("digest").alias("text_sha256"))


def _collisions(docs: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of repeated digests whose bytes differ from those at the locator (none expected).

    Texts move once, to their digest's state; only hits are written and compared.  Copies are
    dealt over ceil(n / HOT_GROUP) salts, the located row to each of them, so a hot group
    never meets in one task."""
    salts = F.ceil(F.col("n") / F.lit(HOT_GROUP)).cast("int")
    hits = cut_lineage(docs.withColumn("digest", _digest()).join(state.where("n > 1"), "digest"))
    kept = F.col("keep.locator") == F.col("locator")
    copies = hits.where(~kept).withColumn("salt", F.pmod(F.xxhash64("locator"), salts).cast("int"))
    held = hits.where(kept).select("digest", F.col("text").alias("ref"), F.explode(
        F.sequence(F.lit(0), salts - 1)).alias("salt"))
    return (copies.join(held, ["digest", "salt"]).where(F.col("text") != F.col("ref"))
            .select("doc_id", "locator", "digest", "text"))


def _regroup(out: DataFrame, odd: DataFrame) -> DataFrame:
    groups = odd.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep2"), F.count("*").alias("n2"))
    moved = odd.join(groups, ["digest", "text"]).select("locator", "keep2", "n2")
    less = odd.groupBy("digest").agg(F.count("*").alias("gone"))
    return (out.join(moved, "locator", "left").join(less, "digest", "left").select(
        "doc_id", "locator", "digest", F.coalesce("keep2", "keep").alias("keep"),
        F.coalesce("n2", F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"))
        .withColumn("kept", F.col("keep.locator") == F.col("locator")))
