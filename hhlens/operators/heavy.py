"""Most frequent levels of factors with very many levels, without shuffling every level.

1. Every task keeps a frequency summary per column: at most ``CAPACITY`` levels; when there are
   more, the (CAPACITY + 1)-th largest count is taken off all of them and noted as ``missed``.
   Summaries merge the same way, in two levels.  A kept count is at most the true one and at
   least the true one less ``missed``; a level that is not kept occurs at most ``missed`` times.
2. The levels that can still be among the first are counted again, exactly, in one pass.
3. A column is decided if its last reported level occurs more than ``missed`` times (or
   nothing was missed).  Any other column, such as one without frequent levels, is counted in
   full, so the answer is always exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hhlens.operators.reduction import combine, parts_for, task_part

CAPACITY = 1_024
_SUMMARY = "variable string, part int, levels array<string>, counts array<bigint>, missed bigint"


def _merge(levels: pa.Array, counts: np.ndarray, capacity: int) -> tuple[pa.Array, np.ndarray, int]:
    """Counts of equal levels added up, cut to ``capacity`` levels, and what the cut took off."""
    t = pa.table({"level": levels, "n": pa.array(counts, pa.int64())}).group_by("level").aggregate([("n", "sum")])
    levels, counts = t.column("level").combine_chunks(), t.column("n_sum").to_numpy()
    if len(counts) <= capacity:
        return levels, counts, 0
    off = int(-np.partition(-counts, capacity)[capacity])
    keep = counts > off
    return levels.filter(pa.array(keep)), counts[keep] - off, off


def summaries(df: DataFrame, cols: Sequence[str], capacity: int) -> DataFrame:
    """One summary per column (``_SUMMARY`` columns); NULL is no level."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    parts, names = parts_for(wide), list(cols)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {c: (pa.array([], pa.string()), np.zeros(0, np.int64), 0) for c in names}
        for b in batches:
            for i, c in enumerate(names):
                vc = b.column(i).drop_null().cast(pa.string()).value_counts()
                levels, counts, missed = state[c]
                both = pa.concat_arrays([levels, vc.field("values")])
                levels, counts, off = _merge(both, np.concatenate([counts, vc.field("counts").to_numpy()]), capacity)
                state[c] = levels, counts, missed + off
        yield _rows([(c, task_part(parts), *state[c]) for c in names])

    def add(t: pa.Table) -> pa.Table:
        levels = pa.concat_arrays([pa.array([], pa.string()), *[x.flatten() for x in t.column("levels").chunks]])
        counts = np.concatenate([np.zeros(0, np.int64), *[x.flatten().to_numpy() for x in t.column("counts").chunks]])
        levels, counts, off = _merge(levels, counts, capacity)
        missed = off + sum(t.column("missed").to_pylist())
        return pa.Table.from_batches([_rows([(t.column("variable")[0].as_py(), t.column("part")[0].as_py(),
                                              levels, counts, missed)])])

    return combine(wide.mapInArrow(summarise, _SUMMARY), ["variable"], add, parts)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    v, p, lv, n, m = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.string()), pa.array(p, pa.int32()), pa.array([x.to_pylist() for x in lv], pa.list_(pa.string())),
         pa.array([x.tolist() for x in n], pa.list_(pa.int64())), pa.array(m, pa.int64())],
        names=["variable", "part", "levels", "counts", "missed"])


def _counted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "variable", "level")
    return long.where(F.col("level").isNotNull())


def top_levels(df: DataFrame, cols: Sequence[str], top: int = 4, capacity: int = CAPACITY,
               report: dict | None = None) -> DataFrame:
    """(variable, rank, level, n): the ``top`` most frequent levels of every column, exact
    counts, ties by level.  NULL is no level; a column without levels has no row.  ``report``
    receives the columns that had to be counted in full."""
    if top > capacity:
        raise ValueError("capacity must be at least top")
    spark, cols = df.sparkSession, list(cols)
    # One row per column reaches the driver, with at most ``capacity`` levels.
    got = {r["variable"]: r for r in summaries(df, cols, capacity).collect()} if cols else {}
    found, missed = [], {}
    for c, r in got.items():
        counts, missed[c] = np.array(r["counts"], np.int64), r["missed"]
        floor = int(np.sort(counts)[-top]) if len(counts) >= top else 0
        found += [(c, lv) for lv, n in zip(r["levels"], counts) if n + r["missed"] >= floor]
    cand = F.broadcast(spark.createDataFrame(found, "variable string, level string"))
    w = Window.partitionBy("variable").orderBy(F.desc("n"), "level")

    def first(counts: DataFrame) -> DataFrame:
        return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
                .select("variable", "rank", "level", "n"))

    exact = first(_counted(df, cols).join(cand, ["variable", "level"]).groupBy("variable", "level")
                  .agg(F.count(F.lit(1)).alias("n"))).collect() if found else []
    last = {r["variable"]: r["n"] for r in exact if r["rank"] == top}
    unsure = [c for c in got if missed[c] and last.get(c, 0) <= missed[c]]
    if report is not None:
        report["counted_in_full"] = unsure
    schema = "variable string, rank int, level string, n bigint"
    out = spark.createDataFrame([tuple(r) for r in exact if r["variable"] not in unsure], schema)
    if unsure:
        out = out.unionByName(first(_counted(df, unsure).groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))))
    return out
