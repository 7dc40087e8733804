"""Order statistics without funnelling a column through one task.

``percentile`` (exact) buffers every distinct value of the group in one final task, and an
un-partitioned ``Window`` sorts the whole input in one task.  Both break when one column
holds billions of distinct values.  The helpers below keep every step partitioned:

1. ``value_counts``   unpivot the columns and count each (part, value) pair; duplicates
                      (a hot value holding a third of the rows) collapse map-side.
2. ``prefix_counts``  cumulative counts in value order inside each part.  One range exchange
                      deals the values into buckets, each bucket is sorted by its own window,
                      and bucket offsets come from a table of (part, bucket) totals.
3. ``exact_quantiles`` type-7 quantiles (linear interpolation, as R ``quantile`` and SQL
                      ``quantile_cont``) from the two order statistics around (n-1)p: a sketch
                      brackets them, one wide pass counts and keeps what lies inside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from hhlens.operators.reduction import combine, parts_for, task_part

# Rows one window task may sort; buckets are sized to stay below it.
BUCKET_ROWS = 2_000_000
BROADCAST_ROWS = 1_000_000
# Points of a sketch (each merge moves a rank by at most 1 / (2 POINTS)), half width of a
# bracket, and the groups whose brackets are held at once.
POINTS = 4_096
DELTA = 1e-3
MAX_GROUPS = 2_000


def unpivot_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                 name: str = "variable", value: str = "value") -> DataFrame:
    """Wide numeric columns -> (keep..., column, value) as DOUBLE; NULL values dropped."""
    casted = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    long = casted.unpivot(list(keep) if keep else [], list(cols), name, value) if keep else \
        casted.unpivot([], list(cols), name, value)
    return long.where(F.col(value).isNotNull())


def value_counts(long: DataFrame, parts: Sequence[str], value: str = "value") -> DataFrame:
    """(parts..., value, cnt): one row per distinct value of each part."""
    return long.groupBy(*parts, value).agg(F.count(F.lit(1)).alias("cnt"))


def null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where NULL meets NULL; the left side's key columns stay."""
    names = {c: f"_ns_{i}" for i, c in enumerate(on)}
    right = right.withColumnsRenamed(names)
    cond = reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[n]) for c, n in names.items()])
    return left.join(right, cond, how).drop(*names.values())


def prefix_counts(vc: DataFrame, parts: Sequence[str], value: str = "value",
                  weight="cnt", bucket_rows: int = BUCKET_ROWS,
                  descending: bool = False) -> DataFrame:
    """Running sums in value order within each part.

    For every weight column ``w`` (``weight`` is a name or a list of names) adds ``cum_w``
    = the inclusive running sum over ascending ``value`` (descending with ``descending``)
    and ``total_w`` = the part's sum.  With a single weight the columns are called ``cum``
    and ``total``.  ``value`` must be unique within a part (pre-aggregate first); a NULL part
    is a part of its own, a NULL value sorts first.

    One range exchange on (parts, value) deals the rows into buckets (at least the session's
    shuffle partitions; more, so that none is expected to pass ``bucket_rows``).  It is
    written once with its bucket number; a table of (part, bucket) totals, with at most one
    row per part and bucket boundary, gives the offsets, and each bucket is summed alone."""
    from hhlens.session import cut_lineage

    weights = [weight] if isinstance(weight, str) else list(weight)
    single = isinstance(weight, str)
    cum_name = {w: ("cum" if single else f"cum_{w}") for w in weights}
    tot_name = {w: ("total" if single else f"total_{w}") for w in weights}
    parts = list(parts)
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    vc = cut_lineage(vc)
    n = max(int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            2 * math.ceil(vc.count() / bucket_rows))
    keyed = cut_lineage(vc.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in parts], order)
                        .withColumn("_b", F.spark_partition_id()))
    totals = keyed.groupBy(*parts, "_b").agg(*[F.sum(w).alias(f"_bt_{w}") for w in weights])
    before = Window.partitionBy(*parts).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parts)
    offsets = totals.select(
        *parts, "_b",
        *[F.coalesce(F.sum(f"_bt_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_bt_{w}").over(whole).alias(tot_name[w]) for w in weights])
    run = Window.partitionBy(*parts, "_b").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = null_safe(keyed, offsets, [*parts, "_b"])
    for w in weights:
        out = out.withColumn(cum_name[w], F.col(f"_off_{w}") + F.sum(w).over(run))
    return out.drop("_b", *[f"_off_{w}" for w in weights])


def thin(v: np.ndarray, w: np.ndarray, points: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Weighted values as at most ``points`` sorted values of one weight; a rank moves by at
    most half that weight."""
    points = points or POINTS
    order = np.argsort(v, kind="stable")
    v, w = v[order], w[order]
    if len(v) <= points:
        return v, w
    cum = np.cumsum(w)
    at = np.searchsorted(cum, (np.arange(points) + 0.5) * (cum[-1] / points))
    return v[np.minimum(at, len(v) - 1)], np.full(points, cum[-1] / points)


def _columns_of(b: pa.RecordBatch, n_cols: int):
    """(group, column number, its known values) of a batch; NaN counts as the largest value."""
    g = b.column("g").to_numpy()
    own = np.unique(g)
    for i in range(n_cols):
        col = b.column(f"c{i}")
        known = col.is_valid().to_numpy(zero_copy_only=False)
        x = col.to_numpy(zero_copy_only=False)[known]
        x = np.where(np.isnan(x), np.inf, x)
        for k in own:
            yield int(k), i, x if len(own) == 1 else x[g[known] == k]


def _brackets(rows: DataFrame, n_cols: int, probs: Sequence[float], delta: float) -> dict:
    """(group, column) -> (exact count, [(lower, upper) value per probability]) from sketches
    that tasks make of their columns and that are merged in two levels."""
    parts = parts_for(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for b in batches:
            for k, i, x in _columns_of(b, n_cols):
                if not len(x):
                    continue
                n, held, vs, ws = seen.get((k, i), (0, 0, [], []))
                vs.append(x)
                ws.append(np.ones(len(x)))
                held += len(x)
                if held > 16 * POINTS:
                    v, w = thin(np.concatenate(vs), np.concatenate(ws))
                    held, vs, ws = len(v), [v], [w]
                seen[k, i] = n + len(x), held, vs, ws
        if seen:
            got = [thin(np.concatenate(vs), np.concatenate(ws)) for _, _, vs, ws in seen.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in seen], pa.int32()), pa.array([i for _, i in seen], pa.int32()),
                 pa.array([task_part(parts)] * len(seen), pa.int32()), pa.array([x[0] for x in seen.values()], pa.int64()),
                 pa.array([v for v, _ in got], pa.list_(pa.float64())), pa.array([w for _, w in got], pa.list_(pa.float64()))],
                names=["g", "col", "part", "n", "v", "w"])

    def merged(t: pa.Table):
        return thin(*[t.column(c).combine_chunks().flatten().to_numpy() for c in ("v", "w")])

    def add(t: pa.Table) -> pa.Table:
        v, w = merged(t)
        return pa.table({"g": t.column("g")[:1], "col": t.column("col")[:1], "part": t.column("part")[:1],
                         "n": pa.array([t.column("n").to_numpy().sum()], pa.int64()),
                         "v": pa.array([v], pa.list_(pa.float64())), "w": pa.array([w], pa.list_(pa.float64()))})

    def ends(t: pa.Table) -> pa.Table:
        v, w = merged(t)
        cum = np.cumsum(w)
        at = [np.searchsorted(cum, min(max(p + s * delta, 0.0), 1.0) * cum[-1]) for p in probs for s in (-1, 1)]
        return pa.table({"g": t.column("g")[:1], "col": t.column("col")[:1],
                         "n": pa.array([t.column("n").to_numpy().sum()], pa.int64()),
                         "ends": pa.array([v[np.minimum(at, len(v) - 1)]], pa.list_(pa.float64()))})

    sketch = rows.mapInArrow(run, "g int, col int, part int, n bigint, v array<double>, w array<double>")
    out = {}
    for r in combine(sketch, ["g", "col"], add, parts, ends, "g int, col int, n bigint, ends array<double>").collect():
        out[r.g, r.col] = r.n, [(-np.inf if p - delta <= 0 else r.ends[2 * j], np.inf if p + delta >= 1 else r.ends[2 * j + 1])
                                for j, p in enumerate(probs)]
    return out


def _count_and_keep(rows: DataFrame, brackets: dict, n_cols: int) -> DataFrame:
    """One wide pass: per (g, col, p) how many values lie below, at or below either bracket
    end (one row per task), and the values strictly inside (one row each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for b in batches:
            cells, inside = [], []
            for k, i, x in _columns_of(b, n_cols):
                if not len(x):
                    continue
                v = np.sort(x)
                for p, (lo, hi) in enumerate(brackets[k, i][1]):
                    at = [np.searchsorted(v, lo, "left"), np.searchsorted(v, lo, "right"),
                          np.searchsorted(v, hi, "left"), np.searchsorted(v, hi, "right")]
                    seen[k, i, p] = seen.get((k, i, p), 0) + np.array(at, np.int64)
                    if at[1] < at[2]:
                        inside.append(v[at[1]:at[2]])
                        cells.append((k, i, p))
            if inside:
                size = [len(x) for x in inside]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.repeat([c[j] for c in cells], size).astype(np.int32)) for j in range(3)],
                     pa.array(np.concatenate(inside)), pa.nulls(sum(size), pa.list_(pa.int64()))],
                    names=["g", "col", "p", "value", "at"])
        if seen:
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([c[j] for c in seen], pa.int32()) for j in range(3)], pa.nulls(len(seen), pa.float64()),
                 pa.array([a.tolist() for a in seen.values()], pa.list_(pa.int64()))], names=["g", "col", "p", "value", "at"])

    return rows.mapInArrow(run, "g int, col int, p int, value double, at array<bigint>")


def _pick(kept: DataFrame, wanted: dict, n_kept: int) -> dict:
    """The kept values at the 0-based ranks ``wanted[(g, col, p)]``."""
    vc = kept.groupBy("g", "col", "p", "value").agg(F.count(F.lit(1)).alias("cnt"))
    out = {}
    if n_kept <= BROADCAST_ROWS:
        t = vc.toArrow().to_pandas().sort_values(["g", "col", "p", "value"])
        for key, part in t.groupby(["g", "col", "p"]):
            key = tuple(map(int, key))
            cum = part["cnt"].to_numpy().cumsum()
            for r in wanted.get(key, ()):
                out[key, r] = float(part["value"].to_numpy()[np.searchsorted(cum, r, "right")])
        return out
    spark = kept.sparkSession
    t = spark.createDataFrame([(*k, r) for k, rs in wanted.items() for r in rs], "g int, col int, p int, rank long")
    pc = prefix_counts(vc, ["g", "col", "p"]).join(F.broadcast(t), ["g", "col", "p"])   # groups x columns x probs rows
    hit = pc.where((F.col("cum") - F.col("cnt") <= F.col("rank")) & (F.col("rank") < F.col("cum")))
    return {((r.g, r.col, r.p), r["rank"]): r.value for r in hit.collect()}


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    groups: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS, delta: float = DELTA) -> DataFrame:
    """(groups..., variable, p, q, n): type-7 quantiles of every column (NULLs ignored; NaN
    counts as the largest value).

    Mergeable sketches bracket every quantile.  One wide pass then counts exactly what lies
    below either end and keeps the few values inside.  A rank that falls on an end is known
    at once (heavy ties do); the others are picked from what was kept.  A bracket that missed
    its rank is widened and the pass repeated.  No column is unpivoted and no value outside a
    bracket is shuffled.  Over ``MAX_GROUPS`` groups (the brackets would no longer be small)
    the distinct values are counted and ranked instead."""
    from hhlens.session import cut_lineage

    spark, cols, probs, groups = df.sparkSession, list(cols), [float(p) for p in probs], list(groups)
    names, own = [f"c{i}" for i in range(len(cols))], [f"_k{j}" for j in range(len(groups))]
    wide = df.select(*[F.col(c).alias(k) for c, k in zip(groups, own)], *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    keys: list = [()]
    if groups:
        keys = [tuple(r) for r in wide.select(*own).distinct().limit(MAX_GROUPS + 1).collect()]
        if len(keys) > MAX_GROUPS:
            parts = [*groups, "variable"]
            return quantiles_from_counts(cut_lineage(value_counts(unpivot_long(df, cols, keep=groups), parts)), parts,
                                         probs, bucket_rows)
    kind = [StructField(c, wide.schema[k].dataType) for c, k in zip(groups, own)]
    rows = wide.select(F.lit(0).alias("g"), *names)
    if groups:
        ids = spark.createDataFrame([(*k, g) for g, k in enumerate(keys)], StructType(
            [*[StructField(k, f.dataType) for k, f in zip(own, kind)], StructField("g", IntegerType())]))
        rows = null_safe(wide, F.broadcast(ids), own).select("g", *names)               # at most MAX_GROUPS rows
    while True:
        brackets = _brackets(rows, len(cols), probs, delta)
        found = cut_lineage(_count_and_keep(rows, brackets, len(cols)))
        counts = found.where(F.col("value").isNull()).groupBy("g", "col", "p").agg(
            *[F.sum(F.col("at")[j]).alias(f"a{j}") for j in range(4)]).collect()
        answers, wanted, missed, n_kept = {}, {}, False, 0
        for r in counts:
            key, (m, ends) = (r.g, r.col, r.p), brackets[r.g, r.col]
            low, (lo, hi) = math.floor((m - 1) * probs[r.p]), ends[r.p]
            for rank in {low, min(low + 1, m - 1)}:
                if r.a0 <= rank < r.a1:
                    answers[key, rank] = lo
                elif r.a2 <= rank < r.a3:
                    answers[key, rank] = hi
                elif r.a1 <= rank < r.a2:
                    wanted.setdefault(key, []).append(rank - r.a1)
                    answers[key, rank] = (rank - r.a1,)
                else:
                    missed = True
            n_kept += r.a2 - r.a1 if key in wanted else 0
        if not missed:
            break
        delta = min(1.0, delta * 10)
    if wanted:
        picked = _pick(found.where(F.col("value").isNotNull()), wanted, n_kept)
        answers = {k: picked[k[0], v[0]] if isinstance(v, tuple) else v for k, v in answers.items()}
    out = []
    for (g, i), (m, _) in sorted(brackets.items()):
        for j, p in enumerate(probs):
            h = (m - 1) * p
            low = math.floor(h)
            a, b = answers[(g, i, j), low], answers[(g, i, j), min(low + 1, m - 1)]
            out.append((*keys[g], cols[i], p, a + (h - low) * (b - a) if h > low else a, m))
    return spark.createDataFrame(out, StructType(
        [*kind, StructField("variable", StringType()), StructField("p", DoubleType()),
         StructField("q", DoubleType()), StructField("n", LongType())]))


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """column -> (known values, mean, sum of squared deviations, min, max), one wide pass;
    tasks merge their batches, the partial moments meet in two levels."""
    rows = df.select(F.lit(0).alias("g"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    parts = parts_for(rows)
    fields = ("n", "mean", "m2", "lo", "hi")

    def merge(t: np.ndarray) -> np.ndarray:
        n, mean = t[:, 0].sum(), (t[:, 0] @ t[:, 1]) / t[:, 0].sum()
        return np.array([n, mean, (t[:, 2] + t[:, 0] * (t[:, 1] - mean) ** 2).sum(), t[:, 3].min(), t[:, 4].max()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for b in batches:
            for _, i, x in _columns_of(b, len(cols)):
                if len(x):
                    own = np.array([[len(x), x.mean(), ((x - x.mean()) ** 2).sum(), x.min(), x.max()]])
                    seen[i] = merge(np.vstack([seen[i], own])) if i in seen else own[0]
        if seen:
            t = np.array(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int32()), pa.array([task_part(parts)] * len(seen), pa.int32()),
                 *[pa.array(t[:, j]) for j in range(5)]], names=["col", "part", *fields])

    def add(t: pa.Table) -> pa.Table:
        got = merge(np.column_stack([t.column(f).to_numpy() for f in fields]))
        return pa.table({"col": t.column("col")[:1], "part": t.column("part")[:1],
                         **{f: pa.array([v]) for f, v in zip(fields, got.tolist())}})

    partial = rows.mapInArrow(run, "col int, part int, " + ", ".join(f"{f} double" for f in fields))
    return {cols[r.col]: (int(r.n), r.mean, r.m2, r.lo, r.hi) for r in combine(partial, ["col"], add, parts).collect()}


def histograms(df: DataFrame, ranges: dict[str, tuple[float, float]], bins: int) -> dict[tuple[str, int], int]:
    """(column, bin) -> rows, ``bins`` of equal width between the given ends; one wide pass."""
    cols = list(ranges)
    rows = df.select(F.lit(0).alias("g"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(cols), bins), np.int64)
        for b in batches:
            for _, i, x in _columns_of(b, len(cols)):
                lo, hi = ranges[cols[i]]
                width = (hi - lo) / bins
                at = np.floor((x - lo) / width).astype(np.int64) if width else np.zeros(len(x), np.int64)
                seen[i] += np.bincount(np.minimum(at, bins - 1), minlength=bins)
        i, k = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(seen[i, k])],
                                         names=["col", "bin", "n"])

    got = rows.mapInArrow(run, "col int, bin int, n bigint").groupBy("col", "bin").agg(F.sum("n").alias("n")).collect()
    return {(cols[r.col], r.bin): r.n for r in got}


def quantiles_from_counts(vc: DataFrame, parts: Sequence[str], probs: Sequence[float],
                          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Type-7 quantiles from a (parts..., value, cnt) table of distinct values."""
    parts = list(parts)
    stats = vc.groupBy(*parts).agg(F.sum("cnt").alias("n"))
    n_parts = stats.count()
    pc = prefix_counts(vc, parts, bucket_rows=bucket_rows)
    pc = pc.withColumn("_prev", F.col("cum") - F.col("cnt"))
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (stats.select(*[F.col(c).alias(f"_t_{c}") for c in parts], "n",
                            F.explode(p_arr).alias("p"))
               .withColumn("h", (F.col("n") - 1).cast("double") * F.col("p"))
               .withColumn("lo", F.floor("h").cast("bigint"))
               .withColumn("hi", F.least(F.col("lo") + 1, F.col("n") - 1)))
    t_side = F.broadcast(targets) if n_parts * len(probs) <= BROADCAST_ROWS else targets
    hit_lo = (F.col("_prev") <= F.col("lo")) & (F.col("lo") < F.col("cum"))
    hit_hi = (F.col("_prev") <= F.col("hi")) & (F.col("hi") < F.col("cum"))
    cond = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in parts]
    hits = (pc.join(t_side, on=reduce(lambda a, b: a & b, cond) & (hit_lo | hit_hi))
            .select(*parts, "p", "h", "lo", "n", F.when(hit_lo, F.col("value")).alias("v_lo"),
                    F.when(hit_hi, F.col("value")).alias("v_hi")))
    agg = hits.groupBy(*parts, "p").agg(F.max("v_lo").alias("v_lo"), F.max("v_hi").alias("v_hi"),
                                        F.first("h").alias("h"), F.first("lo").alias("lo"),
                                        F.first("n").alias("n"))
    d = F.col("h") - F.col("lo")
    return agg.select(*parts, "p", (F.col("v_lo") + d * (F.col("v_hi") - F.col("v_lo"))).alias("q"),
                      "n")
