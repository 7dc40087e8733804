"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprint: per bit, 1 if set in over half the XXH64 values (seed 42) of the text's word
shingles.  Links: fingerprints that differ in at most ``RADIUS`` bits.

Covering masks: position i carries the vector phi(i) in F2^(r+1) without zero, dealt round
robin; mask v (v in F2^(r+1), not zero) keeps the positions with <phi(i), v> = 1.  The
positions where a pair differs span at most r dimensions, so some v is orthogonal to all of
them: under that mask the pair agrees.  Every pair within the radius therefore meets in one
of 2^(r+1) - 1 tables, each keyed by about half the bits.  A bucket of over ``HOT_BUCKET``
distinct fingerprints is dealt again by covering masks over the positions its key left out,
which leaves at most 2^16 or so fingerprints in a bucket.

Buckets report a spanning forest of their links, never all pairs; the components are found
by star contraction over distinct fingerprints.  Copies share a fingerprint, so a group
of copies of any size is one node.

Defined cases: a null or blank text has fingerprint zero, linked like any other; fewer words
than a shingle: the whole sequence is the shingle; null ids take part but never name a
component that has another id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import cut_lineage, fresh
from .components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
HOT_BUCKET = 2_000
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint of the whole text."""
    buf = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not buf:
        return 0
    gaps = np.flatnonzero(np.frombuffer(buf, np.uint8) == 32).tolist()
    starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(buf)]
    n = max(1, len(starts) - shingle + 1)
    ends = ends[min(shingle, len(ends)) - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, n, HASHES_AT_ONCE):
        h = np.array([digest(buf[a:b], seed) for a, b in
                      zip(starts[i:min(n, i + HASHES_AT_ONCE)], ends[i:i + HASHES_AT_ONCE])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp",
                 shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with its text column replaced by the fingerprint (a signed long)."""
    keep = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*keep).schema.fields, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(text)], np.uint64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep],
                                              pa.array(fp.view(np.int64))], names=[*keep, name])

    return docs.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS, positions: list[int] | None = None) -> list[int]:
    """2^(radius+1) - 1 masks over the given bit positions (default: all 64)."""
    positions = list(range(BITS)) if positions is None else positions
    n = (1 << (radius + 1)) - 1
    phi = {p: 1 + k % n for k, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (phi[p] & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("long")


def _buckets(fps: DataFrame, radius: int, hot: int) -> DataFrame:
    masks = covering_masks(radius)
    rows = fps.withColumn("m", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("key"))
        for t, m in enumerate(masks)]))).select("fp", "m.t", "m.key")
    full = cut_lineage(rows.groupBy("t", "key").count().where(F.col("count") > hot)
                       .select("t", "key", F.lit(True).alias("hot")))
    if not full.take(1):
        return rows
    rows = rows.join(full, ["t", "key"], "left")
    again = None
    for t, m in enumerate(masks):
        rest = [p for p in range(BITS) if not m >> p & 1]
        more = F.array(*[F.struct(F.lit((t + 1) * len(masks) + k).alias("t"),
                                  F.col("fp").bitwiseAND(_signed(m | x)).alias("key"))
                         for k, x in enumerate(covering_masks(radius, rest))])
        again = more if again is None else F.when(F.col("t") == t, more).otherwise(again)
    split = rows.where("hot").select("fp", F.explode(again).alias("m")).select("fp", "m.t", "m.key")
    return rows.where("hot is null").select("fp", "t", "key").union(split)


def _forest(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, root row) that span the linked rows of each run of equal ``group``."""
    parent = np.arange(len(fp))
    last = np.searchsorted(group, group, side="right")
    live = np.arange(len(fp))
    for d in range(1, len(fp)):
        live = live[live + d < last[live]]
        if not len(live):
            break
        i = live[np.bitwise_count(fp[live] ^ fp[live + d]) <= radius]
        j = i + d
        while len(i):
            a, b = parent[i], parent[j]
            odd = a != b
            if not odd.any():
                break
            i, j, a, b = i[odd], j[odd], a[odd], b[odd]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    rows = np.flatnonzero(parent != np.arange(len(fp)))
    return rows, parent[rows]


def links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all pairs within the radius."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _buckets(fps, radius, hot).repartition(n, "t", "key").sortWithinPartitions("t", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in _and_end(batches):
            part = None if b is None else np.stack([b.column(c).to_numpy().astype(np.int64)
                                                    for c in ("fp", "t", "key")])
            held = part if held is None else held if part is None else np.hstack([held, part])
            if held is None or not held.shape[1]:
                continue
            new = np.flatnonzero((held[1, 1:] != held[1, :-1]) | (held[2, 1:] != held[2, :-1])) + 1
            cut = held.shape[1] if b is None else (new[-1] if len(new) else 0)
            done, held = held[:, :cut], held[:, cut:]
            if cut:
                group = np.zeros(cut, np.int64)
                group[new[new < cut]] = 1
                rows, roots = _forest(done[0].view(np.uint64), np.cumsum(group), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(done[0][rows]), pa.array(done[0][roots])], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _components(light: DataFrame, low: Column, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, root) of every fingerprint, and (root, low) with the least ``low`` per component."""
    nodes = light.groupBy("fp").agg(F.min(low).alias("low"))
    roots = connected_components(links(nodes.select("fp"), radius))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    return nodes.select("fp", "root"), nodes.groupBy("root").agg(F.min("low").alias("low"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) -> doc_id, fp (signed long), component_id (smallest doc_id reachable)."""
    light = cut_lineage(fingerprints(docs.select("doc_id", "text"), shingle=shingle))
    nodes, least = _components(light, F.col("doc_id"), radius)
    named = nodes.join(least, "root").select("fp", F.col("low").alias("component_id"))
    return light.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component stays: the one with the smallest id (rows without an id
    come last; of rows that share the id the one with the least text hash; of rows that share
    both one).  An id may thus stay more than once if its rows differ.  Columns as given."""
    digest = F.xxhash64(F.col("doc_id").isNull(), "text")
    light = cut_lineage(fingerprints(docs.select("doc_id", digest.alias("digest"), "text"), shingle=shingle))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    least = _components(light, order, radius)[1]
    key = [fresh("_id", docs.columns), fresh("_digest", docs.columns)]
    first = cut_lineage(least.select(F.coalesce("low.doc_id", F.lit(0)).alias(key[0]),
                                     F.col("low.digest").alias(key[1])))
    rows = docs.withColumns({key[0]: F.coalesce("doc_id", F.lit(0)), key[1]: digest})
    return rows.join(first, key, "left_semi").dropDuplicates(key).select(*docs.columns)
