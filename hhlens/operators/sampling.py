"""Splits, folds, class weights and minority oversampling, all reproducible.

Every random choice is ``portable_hash(key, seed)`` (see ``functions.randomness``), never
``rand()``: a re-run, a retried task or a different partitioning gives the same rows, and
an SQL engine with md5 can reproduce the split.  A class may hold most of the rows, so none
is sorted in one task: a split selects its cut-off hash digit by digit, ranks are made in
two levels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hhlens.functions.randomness import portable_hash
from hhlens.operators.ordered import BROADCAST_ROWS, null_safe

# Rows a rank's window is to hold; digits of the split's selection; rows sorted on the driver.
RANK_ROWS = 50_000
DIGIT_BITS, DIGIT = 12, 1 << 12
SORT_ROWS = 100_000
MAX_CLASSES = 200


def _hash(key: str, seed) -> Column:
    """The row's hash; a NULL key has -1, so it comes first."""
    return F.coalesce(portable_hash(key, seed), F.lit(-1).cast("bigint"))


def rank_within(df: DataFrame, parts: Sequence[str], key: str, seed,
                bucket_rows: int = RANK_ROWS) -> DataFrame:
    """Adds ``_h`` (the row's hash), ``rank`` (1-based position in (hash, key) order within
    ``parts``) and ``n_part`` (rows of the part).

    Two levels: the hash's leading bits deal a part into buckets of about ``bucket_rows``
    rows, each ranked by its own window (the only exchange of rows); the buckets' offsets are
    a small table of counts.  A NULL part is a part of its own."""
    from hhlens.session import cut_lineage

    parts = list(parts)
    bits = min(20, max(0, math.ceil(math.log2(max(1, df.count() / bucket_rows)))))
    h = df.withColumn("_h", _hash(key, seed)).withColumn("_b", F.shiftright("_h", 32 - bits))
    counts = h.groupBy(*parts, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*parts).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select(
        *parts, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*parts)).alias("n_part")))
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    ranked = h.withColumn("_r", F.row_number().over(Window.partitionBy(*parts, "_b").orderBy("_h", key)))
    return (null_safe(ranked, offsets, [*parts, "_b"]).withColumn("rank", F.col("_before") + F.col("_r"))
            .drop("_before", "_r", "_b"))


def _digits(df: DataFrame, shift: int) -> list:
    """(part, digit, rows) of the hash's digit above ``shift``; one row per class and digit."""
    digit = F.when(F.col("h") < 0, -1).otherwise(F.shiftright("h", shift).bitwiseAND(F.lit(DIGIT - 1)))
    return df.groupBy("part", digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()


def _cutoffs(rows: DataFrame, share: float) -> dict:
    """part -> (hash, key, rows taken of those that equal both, how many equal both): the last
    of the ceil(share * n) least (hash, key) pairs of every part.

    Digits of the hash are counted from the top; only the rows that share the cut-off's
    digits are kept for the next count, until they are few enough to sort."""
    from hhlens.session import cut_lineage

    shift, need, out = 32 - DIGIT_BITS, None, {}
    while True:
        got: dict = {}
        for r in _digits(rows, shift):
            got.setdefault(r.part, {})[r.digit] = r.n
        if need is None:
            need = {p: math.ceil(share * sum(c.values())) for p, c in got.items()}
            out = {p: None for p, k in need.items() if not k}
            need = {p: k for p, k in need.items() if k}
        at, left = {}, 0
        for p, k in need.items():
            for digit in sorted(got[p]):
                if k <= got[p][digit]:
                    at[p], need[p] = digit, k
                    left += got[p][digit]
                    break
                k -= got[p][digit]
        hit = F.lit(False)
        for p, digit in at.items():
            same = (F.col("h") < 0) if digit < 0 else (F.col("h") >= 0) & (
                F.shiftright("h", shift).bitwiseAND(F.lit(DIGIT - 1)) == F.lit(digit))
            hit = hit | (F.col("part").eqNullSafe(F.lit(p)) & same)
        rows = rows.where(hit)
        if left <= SORT_ROWS or shift == 0:
            break
        rows, shift = cut_lineage(rows), max(0, shift - DIGIT_BITS)
    last: dict = {}
    pairs = rows.groupBy("part", "h", "key").agg(F.count(F.lit(1)).alias("n")).collect()
    for r in sorted(pairs, key=lambda r: (r.h, r.key is not None, r.key)):
        if r.part in need and r.part not in last:
            if need[r.part] <= r.n:
                last[r.part] = (r.h, r.key, need[r.part], r.n)
            else:
                need[r.part] -= r.n
    return out | last


def partition_split(df: DataFrame, label: str | None, p: float = 0.7, seed=123,
                    key: str = "id", out: str = "is_train", stratify: bool = True) -> DataFrame:
    """``createDataPartition(y, p)``: within each class the ceil(p * n_class) rows with the
    smallest (hash, key) go to the training part (one class = the whole table with
    ``stratify=False``).  ``out`` is 1 for training rows, 0 for the hold-out.

    The exact cut-off of every class is selected first (``_cutoffs``); the split itself is
    then a projection: no row is sorted, shuffled or joined.  Only where rows with one and the
    same key stand on both sides of a cut-off are those rows numbered.  Over ``MAX_CLASSES``
    classes the rows are ranked instead."""
    part = F.col(label) if stratify and label else F.lit(0)
    rows = df.select(part.alias("part"), _hash(key, seed).alias("h"), F.col(key).alias("key"))
    if rows.select("part").distinct().limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        r = rank_within(df, [label], key, seed)
        flag = (F.col("rank") <= F.ceil(F.lit(float(p)) * F.col("n_part"))).cast("int")
        return r.withColumn(out, flag).drop("_h", "rank", "n_part")
    h, flag, torn, take = _hash(key, seed), F.lit(0), F.lit(False), F.lit(0)
    for c, cut in _cutoffs(rows, p).items():
        if cut is None:
            continue
        last_h, last_key, taken, equal = cut
        mine = part.eqNullSafe(F.lit(c))
        same = (h == F.lit(last_h)) & F.col(key).eqNullSafe(F.lit(last_key))
        before = (h < F.lit(last_h)) | ((h == F.lit(last_h)) & F.coalesce(F.col(key) < F.lit(last_key), F.lit(last_key is not None)
                                                                         & F.col(key).isNull()))
        flag = F.when(mine, (before | same).cast("int")).otherwise(flag)
        if taken < equal:
            torn, take = torn | (mine & same), F.when(mine, F.lit(taken)).otherwise(take)
    if torn._jc.toString() == F.lit(False)._jc.toString():
        return df.withColumn(out, flag)
    mark, order = df.where(torn), Window.partitionBy(part).orderBy(F.lit(0))
    mark = mark.withColumn(out, (F.row_number().over(order) <= take).cast("int"))
    return df.where(~torn).withColumn(out, flag).unionByName(mark)


def kfold(df: DataFrame, label: str | None, k: int = 10, seed=123, key: str = "id",
          out: str = "fold", stratify: bool = True) -> DataFrame:
    """Fold 0..k-1 for every row: (rank - 1) mod k within each class, so every fold gets
    the class balance of the whole table and fold sizes differ by at most one per class."""
    parts = [label] if (stratify and label) else []
    r = rank_within(df, parts, key, seed)
    return r.withColumn(out, ((F.col("rank") - 1) % F.lit(k)).cast("int")).drop("_h", "rank", "n_part")


def class_weights(df: DataFrame, label: str, fixed: dict | None = None,
                  out: str = "w_inverse") -> DataFrame:
    """Inverse class frequency 1/n_class per row (class counts by one aggregate, joined
    back as a broadcast table of one row per class), and optionally fixed weights."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_class"))
    n_classes = counts.count()
    side = F.broadcast(counts) if n_classes <= BROADCAST_ROWS else counts
    res = (df.join(side, on=label, how="left")
           .withColumn(out, F.lit(1.0) / F.col("_n_class")).drop("_n_class"))
    if fixed:
        w = None
        for k, v in fixed.items():
            w = F.when(F.col(label) == F.lit(k), F.lit(float(v))) if w is None else \
                w.when(F.col(label) == F.lit(k), F.lit(float(v)))
        res = res.withColumn("w_fixed", w)
    return res


def smote(df: DataFrame, label: str, features: Sequence[str], key: str = "id", minority=1,
          k: int = 5, over_ratio: float = 1.0, seed=123,
          bucket_rows: int | None = None, neighbours: DataFrame | None = None) -> DataFrame:
    """Synthetic minority rows (SMOTE), deterministic.

    ``N = ceil(over_ratio * n_majority) - n_minority`` new rows (none if already balanced).
    Row j = 1..N takes the minority row of rank ((j - 1) mod n_min) + 1 (ranks by the
    portable hash), one of its k exact nearest minority neighbours chosen by
    ``portable_hash(j, seed || '|nn') mod k`` (rank 1..k by distance, ties by key) and
    ``u = portable_hash(j, seed || '|u') / 2^32``; every feature is x + u (x_nn - x).
    Returns the synthetic rows (key = -j, label = minority); union them with ``df``.
    ``neighbours``: the minority rows' ``knn_exact`` where it is made already."""
    from hhlens.operators.neighbors import LEAF_ROWS as KNN_ROWS
    from hhlens.operators.neighbors import knn_exact

    feats = list(features)
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_min = counts.get(minority, 0)
    n_maj = max([v for c, v in counts.items() if c != minority], default=0)
    n_new = max(0, math.ceil(over_ratio * n_maj) - n_min)
    spark = df.sparkSession
    out_schema = ", ".join([f"{key} bigint", f"{label} int"] + [f"{c} double" for c in feats])
    if n_new == 0 or n_min < 2:
        return spark.createDataFrame([], out_schema)
    from hhlens.session import cut_lineage

    mino = cut_lineage(df.where(F.col(label) == F.lit(minority)).select(key, *feats))
    nn = neighbours
    if nn is None:
        nn = cut_lineage(knn_exact(mino, key, feats, k, bucket_rows or KNN_ROWS))
    # Features travel as ONE array column through the joins below: aliasing every feature
    # on both sides would multiply the NOT NULL constraints Catalyst infers over them.
    vec = mino.select(key, F.array(*[F.col(c) for c in feats]).alias("_v"))
    ranked = cut_lineage(rank_within(vec, [], key, seed).select(key, "rank", "_v"))
    reps = math.ceil(n_new / n_min)
    # A base row meets its vector and its neighbours' keys before it is copied: these joins move
    # one row per minority row, and only the join with the neighbours' vectors moves the copies.
    near = nn.groupBy(key).agg(F.collect_list(F.struct("nn_rank", "nn_key")).alias("_nn"), F.max("nn_rank").alias("_kmax"))
    base = ranked.select(key, "rank").join(ranked.select(key, F.col("_v").alias("_xv")), on=key).join(near, on=key)
    # copies of each base row: j = c * n_min + rank, c = 0..reps-1, j <= n_new
    jobs = (base.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
            .withColumn("j", F.col("_c") * F.lit(n_min) + F.col("rank"))
            .where(F.col("j") <= F.lit(n_new)))
    jobs = (jobs.withColumn("nn_rank", (portable_hash("j", f"{seed}|nn") % F.lit(k) + 1).cast("int"))
            .withColumn("u", portable_hash("j", f"{seed}|u").cast("double") / F.lit(4294967296.0))
            .withColumn("nn_rank", ((F.col("nn_rank") - 1) % F.col("_kmax") + 1).cast("int")))
    pick = jobs.select("j", "u", "_xv", F.explode(F.filter("_nn", lambda c: c["nn_rank"] == F.col("nn_rank"))).alias("_c"))
    pick = pick.select("j", "u", "_xv", F.col("_c.nn_key").alias("nn_key"))
    nbr = ranked.select(F.col(key).alias("nn_key"), F.col("_v").alias("_yv"))
    syn = pick.join(nbr, on="nn_key")
    x, y = F.col("_xv"), F.col("_yv")
    return syn.select((-F.col("j")).cast("bigint").alias(key), F.lit(minority).cast("int").alias(label),
                      *[(x[i] + F.col("u") * (y[i] - x[i])).alias(c) for i, c in enumerate(feats)])
