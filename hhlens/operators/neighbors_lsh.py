"""Approximate k nearest neighbours: random-projection tables with exact re-ranking.

1. Equal rows collapse as in ``neighbors`` (a hot vector is one vector).
2. A table hashes a vector to a leaf of a tree grown over random projections of a sample of
   vectors; keys break ties, so a table's leaves stay small however the data cluster.
3. The number of tables comes from the recall target: the true neighbours of at most
   ``PROBES`` vectors (chosen by hash, compared with all rows in blocks) are hashed by one
   table after the other until the share that meets its vector in some table, less two
   standard errors, reaches the target.  Where ``MAX_TABLES`` tables don't, the exact operator answers.
4. Each (table, leaf) group is one bounded NumPy search; a vector's candidates of all tables
   are ranked by exact distance, ties by key.

The exact operator stays the default (SMOTE uses it); this one is for tables on which its visits to
other leaves grow too many.  Rows with a NULL or NaN feature neither ask nor answer.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hhlens.operators.neighbors import (
    _lists, _matrix, _nearest, _refs, distinct_vectors, grow, knn_exact, ranked_answers, route)

# Task code of this module travels by value, so executors need no installed package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

LEAF_ROWS = 256
MAX_LEAVES = 32_768
SAMPLE_PER_LEAF = 16
DIRECTIONS = 12
MAX_TABLES = 48
PROBES = 512
_PAIR = "array<struct<d2: double, id: bigint>>"


def _chosen(df: DataFrame, share: float, salt: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64("vid", F.lit(salt)), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30))))


def _truth(uniq: DataFrame, probes: pa.Table, d: int, kk: int):
    """Per probe the ``kk`` nearest distinct vectors as (probe, vector key, vector)."""
    sent = uniq.sparkSession.sparkContext.broadcast(_matrix(probes.column("x"), d))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            q, at, d2 = _nearest(sent.value, np.arange(len(x)), x, kk)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), b.column("vid").take(pa.array(at)), pa.array(d2),
                 b.column("x").take(pa.array(at))], names=["q", "vid", "d2", "x"])

    near = uniq.select("vid", "x").mapInArrow(search, "q int, vid bigint, d2 double, x array<double>")
    # Every batch reports kk rows per probe; a map-side group limit keeps the kk nearest of a task.
    w = Window.partitionBy("q").orderBy("d2", "vid")
    return near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= kk).select("q", "vid", "x").toArrow()


def _table(x: np.ndarray, ids: np.ndarray, leaves: int, seed: int):
    """One table: its projection and its tree."""
    turn = np.random.default_rng(seed).standard_normal((x.shape[1], DIRECTIONS))
    return turn, grow(x @ turn, ids, leaves)


def knn_lsh(df: DataFrame, key: str, features: Sequence[str], k: int = 5, recall: float = 0.9, seed: int = 1,
            leaf_rows: int = LEAF_ROWS, report: dict | None = None) -> DataFrame:
    """(key, nn_key, d2, nn_rank) as ``knn_exact``, but a share of at least ``recall`` of the
    true neighbours is expected instead of all (distances are exact, and every row has k
    neighbours if its leaves hold that many others).  ``report`` receives the tables used and
    the recall among the probes.  An empty table gives no row."""
    from hhlens.session import cut_lineage

    spark, d, kk = df.sparkSession, len(features), k + 1
    pts, uniq = distinct_vectors(df, key, features, kk)
    n = uniq.count()
    leaves = min(MAX_LEAVES, math.ceil(n / max(leaf_rows, 2 * kk))) or 1
    if leaves == 1:                                      # one bounded leaf: the exact search is the table
        if report is not None:
            report.update(tables=0, recall=1.0)
        return knn_exact(df, key, features, k)

    # At most about SAMPLE_PER_LEAF vectors per leaf and PROBES probes reach the driver.
    got = _chosen(uniq, min(1.0, SAMPLE_PER_LEAF * leaves / n), seed).select("x", "vid").toArrow()
    order = np.argsort(got.column("vid").to_numpy())
    sx, sid = _matrix(got.column("x"), d)[order], got.column("vid").to_numpy()[order]
    probes = _chosen(uniq, min(1.0, PROBES / n), seed + 1).select("vid", "x").toArrow()
    tables, reached, share = [], None, 0.0
    if probes.num_rows and len(sid) > 1:
        truth = _truth(uniq, probes, d, kk)
        qx, qid = _matrix(probes.column("x"), d), probes.column("vid").to_numpy()
        at, tx, tid = truth.column("q").to_numpy(), _matrix(truth.column("x"), d), truth.column("vid").to_numpy()
        other = tid != qid[at]
        at, tx, tid = at[other], tx[other], tid[other]
        met = np.zeros(len(at), bool)
        for i in range(MAX_TABLES):
            turn, tree = _table(sx, sid, leaves, seed * 1_000 + i)
            tables.append((turn, tree))
            met |= route(tree, qx @ turn, qid)[at] == route(tree, tx @ turn, tid)
            per = np.bincount(at, met, len(qid)) / np.maximum(np.bincount(at, minlength=len(qid)), 1)
            share, error = per.mean(), per.std() / math.sqrt(len(per))
            if share - 2 * error >= recall:
                reached = i + 1
                break
    if report is not None:
        report.update(tables=reached or 0, recall=float(share) if reached else 1.0)
    if not reached:
        return knn_exact(df, key, features, k)
    sent = spark.sparkContext.broadcast(tables)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, ids = _matrix(b.column("x"), d), b.column("vid").to_numpy()
            for i, (turn, tree) in enumerate(sent.value):
                leaf = pa.array(route(tree, x @ turn, ids).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(x), i, np.int32)), leaf],
                                                 names=[*b.schema.names, "t", "leaf"])

    def local(t: pa.Table) -> pa.Table:
        x = _matrix(t.column("x"), d)
        r_ids, rx = _refs(t, x)
        q, near, d2 = _nearest(x, r_ids, rx, kk)
        return pa.table({"vid": t.column("vid"), "near": _lists(q, near, d2, len(x))})

    placed = uniq.select("x", "ids", "vid").mapInArrow(place, "x array<double>, ids array<bigint>, vid bigint, t int, leaf int")
    found = placed.groupBy("t", "leaf").applyInArrow(local, f"vid bigint, near {_PAIR}")
    # A vector's candidates: k + 1 per table.
    lists = cut_lineage(found.groupBy("vid").agg(F.slice(F.array_sort(F.array_distinct(
        F.flatten(F.collect_list("near")))), 1, kk).alias("near")))
    return ranked_answers(pts, uniq, lists, key, k)
