"""Exact k nearest neighbours (Euclidean) on a partition tree, without an all-pairs join.

1. Equal rows collapse: of every distinct vector only the k + 1 smallest keys can ever be an
   answer (a map-side group limit keeps a hot vector small), and all its rows share one query.
2. A sample of the distinct vectors, chosen by hash, grows a binary tree that splits its
   widest column at the middle; keys break ties, so equal values never fill one leaf.  Leaves
   are sized so that there is work for every core, at most ``LEAF_ROWS`` vectors each.
3. Neighbouring leaves (a subtree, at most ``GROUP_LEAVES``) meet in one task.  A vector is
   searched for in its own leaf (NumPy, one bounded group), then in the group's other leaves,
   nearest boxes first, as long as a box lies within its k-th distance so far.
4. With that radius, which the whole group made small, the other groups are found that have a
   leaf within it.  Only these (vector, group) visits are exchanged, in parts of at most about
   ``VISITS`` queries; leaves within the group are chosen where the group is.  Groups grow with
   the table up to their bound, so visits hardly outgrow the vectors.
5. The best candidates of all visited groups win (ties by neighbour key).

Nothing outside the visited boxes can be closer than the k-th candidate, so the result is
exact for any sample.  The tree and the boxes (one row per leaf, at most ``MAX_LEAVES``) are
the only things sent to all tasks.  A vector in a leaf with too few rows takes its radius from
the farthest corners of the nearest boxes that together hold enough rows.

Rows with a NULL or NaN feature have no distance: they neither ask nor answer.

``knn_folds`` answers the same question for every training part of a k-fold split in one search:
keys carry their fold, a search goes on until ``k`` answers lie outside of any one fold, and the
answers of a part are a filter of the list.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Task code of this module travels by value, so executors need no installed package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

LEAF_ROWS = 500
MAX_LEAVES = 32_768
SAMPLE_PER_LEAF = 16
GROUP_LEAVES = 128
VISITS = 100_000
_CHUNK = 512
SLACK = 1e-9                            # relative slack of box distances (rounding)


# --------------------------------------------------------------------------- tree
def grow(x: np.ndarray, ids: np.ndarray, leaves: int) -> dict[str, np.ndarray]:
    """A tree over sampled rows: per node its column, the (value, key) that goes right, and
    its children (a negative child -1 - i is leaf i)."""
    axis, cut, cut_id, child = [], [], [], []
    todo, n_leaves = [(np.arange(len(x)), leaves, None)], 0
    while todo:
        rows, want, parent = todo.pop()
        if want <= 1 or len(rows) < 2:
            if parent is not None:
                child[parent[0]][parent[1]] = -1 - n_leaves
            n_leaves += 1
            continue
        a = int(np.ptp(x[rows], axis=0).argmax())
        order = rows[np.lexsort((ids[rows], x[rows, a]))]
        half = want // 2
        at = min(max(1, len(rows) * half // want), len(rows) - 1)
        node = len(axis)
        axis.append(a)
        cut.append(x[order[at], a])
        cut_id.append(ids[order[at]])
        child.append([0, 0])
        if parent is not None:
            child[parent[0]][parent[1]] = node
        todo += [(order[:at], half, (node, 0)), (order[at:], want - half, (node, 1))]
    return {"axis": np.array(axis, np.int64), "cut": np.array(cut, float), "cut_id": np.array(cut_id, np.int64),
            "child": np.array(child, np.int64).reshape(-1, 2)}


def route(tree: dict[str, np.ndarray], x: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Leaf of every row."""
    at = np.zeros(len(x), np.int64)
    if not len(tree["axis"]):
        return at
    live = np.arange(len(x))
    while len(live):
        node = at[live]
        v, c = x[live, tree["axis"][node]], tree["cut"][node]
        right = ~((v < c) | ((v == c) & (ids[live] < tree["cut_id"][node])))
        at[live] = tree["child"][node, right.astype(int)]
        live = live[at[live] >= 0]
    return -1 - at


def box_distance(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, far: bool = False) -> np.ndarray:
    """Squared distance of every row to every box (to its farthest corner with ``far``)."""
    d2 = np.zeros((len(x), len(lo)))
    for f in range(x.shape[1]):
        below, above = lo[:, f][None, :] - x[:, f][:, None], x[:, f][:, None] - hi[:, f][None, :]
        gap = np.maximum(np.abs(below), np.abs(above)) if far else np.maximum(np.maximum(below, above), 0)
        d2 += gap * gap
    return d2


def _nearest(qx: np.ndarray, r_ids: np.ndarray, rx: np.ndarray, k: int):
    """The k nearest refs of every query as (query, ref key, d2), by distance, then key.
    Squared distances accumulate feature by feature (the operation order of an SQL sum)."""
    out_q, out_n, out_d = [], [], []
    for s in range(0, len(qx), _CHUNK):
        q = qx[s:s + _CHUNK]
        d2 = np.zeros((len(q), len(r_ids)))
        for f in range(qx.shape[1]):
            diff = q[:, f][:, None] - rx[:, f][None, :]
            d2 += diff * diff
        tied = np.arange(len(q))
        if d2.shape[1] > k:
            near = np.argpartition(d2, k - 1, axis=1)[:, :k]
            dn = np.take_along_axis(d2, near, axis=1)
            full = (d2 <= dn.max(axis=1)[:, None]).sum(axis=1) > k      # a tie at the k-th distance: by key below
            tied, rows = np.flatnonzero(full), np.flatnonzero(~full)
            near, dn = near[rows], dn[rows]
            order = np.lexsort((r_ids[near], dn), axis=1)
            out_q.append(np.repeat(rows + s, k))
            out_n.append(np.take_along_axis(r_ids[near], order, axis=1).ravel())
            out_d.append(np.take_along_axis(dn, order, axis=1).ravel())
        kk = min(k, d2.shape[1])
        for row in tied if kk else ():
            dr = d2[row]
            near = np.flatnonzero(dr <= np.partition(dr, kk - 1)[kk - 1])
            near = near[np.lexsort((r_ids[near], dr[near]))[:kk]]
            out_q.append(np.full(kk, row + s))
            out_n.append(r_ids[near])
            out_d.append(dr[near])
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    q, n, d = np.concatenate(out_q), np.concatenate(out_n), np.concatenate(out_d)
    order = np.argsort(q, kind="stable")
    return q[order], n[order], d[order]


def _within(qx: np.ndarray, r_ids: np.ndarray, rx: np.ndarray, limit: np.ndarray, k: int):
    """As ``_nearest``, of the refs within each query's ``limit`` (squared).  One matrix product
    about the refs' mean, with room for its rounding, leaves few pairs; these are computed as there."""
    out_q, out_n, out_d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    mean, f = rx.mean(axis=0), qx.shape[1]
    b = rx - mean
    bb = (b * b).sum(axis=1)
    for s in range(0, len(qx), _CHUNK):
        q, bound = qx[s:s + _CHUNK], limit[s:s + _CHUNK]
        a = q - mean
        aa = (a * a).sum(axis=1)
        room = 1e-13 * (f + 8) * (aa.max() + bb.max())
        qi, ri = np.nonzero(~(bb[None, :] - 2 * (a @ b.T) > (bound - aa + room)[:, None]))
        d2 = np.zeros(len(qi))
        for c in range(f):
            diff = q[qi, c] - rx[ri, c]
            d2 += diff * diff
        keep = np.flatnonzero(d2 <= bound[qi])
        keep = keep[np.lexsort((r_ids[ri[keep]], d2[keep], qi[keep]))]
        qi = qi[keep]
        first = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
        out_q.append(qi[first] + s)
        out_n.append(r_ids[ri[keep[first]]])
        out_d.append(d2[keep[first]])
    return np.concatenate(out_q), np.concatenate(out_n), np.concatenate(out_d)


# --------------------------------------------------------------------------- Arrow helpers
def _matrix(column, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _refs(t: pa.Table, *columns: np.ndarray):
    """Keys of the rows that distinct vectors stand for, and what ``columns`` hold for them."""
    ids = t.column("ids").combine_chunks()
    size = ids.value_lengths().to_numpy(zero_copy_only=False)
    return ids.flatten().to_numpy(), *[np.repeat(c, size, axis=0) for c in columns]


_NEAR = pa.list_(pa.struct([("d2", pa.float64()), ("id", pa.int64())]))


def _lists(q: np.ndarray, n: np.ndarray, d: np.ndarray, rows: int) -> pa.Array:
    """One list of (d2, id) per query; ``q`` is sorted."""
    ends = np.searchsorted(q, np.arange(rows + 1)).astype(np.int32)
    cells = pa.StructArray.from_arrays([pa.array(d, pa.float64()), pa.array(n, pa.int64())], names=["d2", "id"])
    return pa.ListArray.from_arrays(pa.array(ends), cells)


NOBODY = np.iinfo(np.int64).max


def _dense(q: np.ndarray, n: np.ndarray, d: np.ndarray, rows: int, kk: int):
    """(d2, id) of the candidates of ``_nearest``, ``kk`` places per query; free places hold (NaN, NOBODY)."""
    d2, ids = np.full((rows, kk), np.nan), np.full((rows, kk), NOBODY)
    at = np.arange(len(q)) - np.searchsorted(q, q)
    d2[q, at], ids[q, at] = d, n
    return d2, ids


def _put(best, rows: np.ndarray, q: np.ndarray, n: np.ndarray, d: np.ndarray, kk: int) -> None:
    """Puts the candidates that ``rows[q]`` found among their best ones, by distance, then key."""
    some, q = np.unique(q, return_inverse=True)
    rows, found = rows[some], _dense(q, n, d, len(some), kk)
    d2, ids = np.hstack([best[0][rows], found[0]]), np.hstack([best[1][rows], found[1]])
    order = np.lexsort((ids, d2), axis=1)[:, :kk]
    best[0][rows], best[1][rows] = np.take_along_axis(d2, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _flat(best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    q, at = np.nonzero(best[1] != NOBODY)
    return q, best[1][q, at], best[0][q, at]


def _radius(best, kk: int = 0, folds: int = 0) -> np.ndarray:
    """The last place's distance; without limit where a place is free.  With ``folds`` (keys carry
    their fold) that of the first place up to which every fold leaves out ``kk`` rows or more."""
    last = np.where(best[1][:, -1] == NOBODY, np.inf, best[0][:, -1])
    if not folds:
        return last
    there = best[1] != NOBODY
    fold = np.where(there, best[1] % folds, -1)
    most = np.max([np.cumsum(fold == f, axis=1) for f in range(folds)], axis=0)
    enough = np.cumsum(there, axis=1) - most >= kk
    return np.where(enough.any(axis=1), best[0][np.arange(len(fold)), enough.argmax(axis=1)], last)


def _by_leaf(leaf: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(leaf, kind="stable")
    names, first = np.unique(leaf[order], return_index=True)
    return dict(zip(names.tolist(), np.split(order, first[1:])))


def _box_gap(lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared gap of every box to the box around ``x``: it bounds the gaps of all its rows."""
    gap = np.maximum(np.maximum(lo - x.max(axis=0), x.min(axis=0) - hi), 0)
    return (gap * gap).sum(axis=1)


def _reach(r2: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(r2), r2 * (1 + SLACK) + 1e-12, np.inf)


def _search_group(x: np.ndarray, r_ids: np.ndarray, rx: np.ndarray, leaf: np.ndarray, r_leaf: np.ndarray, boxes, kk: int,
                  radius=_radius):
    """The best candidates of a group's vectors among all rows of the group."""
    best = np.full((len(x), kk), np.nan), np.full((len(x), kk), NOBODY)
    mine, refs = _by_leaf(leaf), _by_leaf(r_leaf)
    names = np.array(list(mine))
    place = np.searchsorted(boxes[0], names)
    lo, hi = boxes[1][place], boxes[2][place]
    for own, rows in mine.items():
        qx = x[rows]
        got = _dense(*_nearest(qx, r_ids[refs[own]], rx[refs[own]], kk), len(rows), kk)
        gap = _box_gap(lo, hi, qx)
        for j in np.argsort(gap, kind="stable"):
            reach = _reach(radius(got))
            if gap[j] > reach.max():
                break
            there = refs[int(names[j])]
            if names[j] == own:
                continue
            hit = np.flatnonzero(box_distance(qx, lo[j:j + 1], hi[j:j + 1])[:, 0] <= reach)
            if len(hit):
                _put(got, hit, *_within(qx[hit], r_ids[there], rx[there], reach[hit], kk), kk)
        best[0][rows], best[1][rows] = got
    return best


def _visits(x: np.ndarray, r2: np.ndarray, own: int, per: int, boxes, need: int) -> list[np.ndarray]:
    """Per query the other groups (of ``per`` leaves) that have a leaf within its radius."""
    leaf, lo, hi, size = boxes
    lost = np.flatnonzero(~np.isfinite(r2))
    for s in range(0, len(lost), _CHUNK):
        rows = lost[s:s + _CHUNK]
        far = box_distance(x[rows], lo, hi, far=True)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(size[order], axis=1) >= need
        at = np.where(enough.any(axis=1), enough.argmax(axis=1), len(leaf) - 1)
        r2[rows] = np.take_along_axis(far, order, axis=1)[np.arange(len(rows)), at]
        r2[rows[~enough.any(axis=1)]] = np.inf
    reach = r2 * (1 + SLACK) + 1e-12
    out: list[np.ndarray] = []
    # Boxes out of everyone's reach go first.
    group = leaf // per
    some = np.flatnonzero((_box_gap(lo, hi, x) <= reach.max()) & (group != own))
    for s in range(0, len(x), _CHUNK):
        near = box_distance(x[s:s + _CHUNK], lo[some], hi[some]) <= reach[s:s + _CHUNK][:, None]
        out += [np.unique(group[some[row]]) for row in near]
    return out


# --------------------------------------------------------------------------- the operator
def distinct_vectors(df: DataFrame, key: str, features: Sequence[str], kk: int, folds: int = 0) -> tuple[DataFrame, DataFrame]:
    """Stored points (_id, x) and distinct vectors (x, the ``kk`` smallest keys ``ids``, of each
    fold with ``folds``, the smallest of them ``vid``); rows with a NULL or NaN feature are in
    neither."""
    from hhlens.session import cut_lineage

    cols = [F.col(c).cast("double") + F.lit(0.0) for c in features]         # -0.0 becomes 0.0
    fine = F.lit(True)
    for c in cols:
        fine = fine & c.isNotNull() & ~F.isnan(c)
    pts = cut_lineage(df.where(fine).select(F.col(key).cast("bigint").alias("_id"), F.array(*cols).alias("x")))
    first = Window.partitionBy("x", *([F.pmod("_id", F.lit(folds))] if folds else [])).orderBy("_id")
    uniq = cut_lineage(pts.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= kk)
                       .groupBy("x").agg(F.array_sort(F.collect_list("_id")).alias("ids"))
                       .withColumn("vid", F.col("ids")[0]))
    return pts, uniq


def ranked_answers(pts: DataFrame, uniq: DataFrame, lists: DataFrame, key: str, k: int) -> DataFrame:
    """Every row's first ``k`` candidates but itself, from the lists (vid, near) of its vector."""
    answers = lists.join(uniq.select("vid", "x"), "vid").select("x", "near")
    others = F.slice(F.filter("near", lambda c: c["id"] != F.col("_id")), 1, k)
    return (pts.join(answers, "x").select("_id", F.posexplode(others).alias("_p", "_c"))
            .select(F.col("_id").alias(key), F.col("_c.id").alias("nn_key"), F.col("_c.d2").alias("d2"),
                    (F.col("_p") + 1).alias("nn_rank")))


def knn_exact(df: DataFrame, key: str, features: Sequence[str], k: int = 5,
              bucket_rows: int = LEAF_ROWS, report: dict | None = None) -> DataFrame:
    """(key, nn_key, d2, nn_rank): the k nearest other rows of every row by Euclidean distance
    over ``features`` (squared distance ``d2``, rank 1..k, ties by nn_key; keys are unique).
    ``report`` receives the number of distinct vectors, leaves and visits."""
    return ranked_answers(*_candidates(df, key, features, k + 1, bucket_rows, report), key, k)


FOLD_PLACES = 4                         # places kept per answer where folds are left out
MAX_FOLDS = 64


def knn_folds(df: DataFrame, key: str, features: Sequence[str], fold: str, folds: Sequence[int], k: int = 5,
              bucket_rows: int = LEAF_ROWS) -> dict | None:
    """left-out fold (None: none) -> what ``knn_exact`` returns (key, nn_key, d2, nn_rank) for the
    rows of the other folds, all from one search.

    None where it can't be made so: very large keys, many folds, keys or folds that are NULL, or a
    row whose nearest rows are nearly all of one fold (the places kept don't hold enough others)."""
    from hhlens.session import cut_lineage

    m = len(folds)
    if not 2 <= m <= MAX_FOLDS:
        return None
    number = F.lit(None).cast("bigint")
    for i, f in enumerate(folds):
        number = F.when(F.col(fold) == F.lit(f), F.lit(i)).otherwise(number)
    own = F.col(key).cast("bigint")
    odd = own.isNull() | ~own.between(-(1 << 55), 1 << 55) | number.isNull()
    if df.where(odd).limit(1).count():
        return None
    coded = df.select((own * F.lit(m) + number.cast("bigint")).alias("_coded"), *features)
    pts, uniq, lists = _candidates(coded, "_coded", features, k + 1, bucket_rows, None, m)
    answers = lists.join(uniq.select("vid", "x"), "vid").select("x", "near")
    near = cut_lineage(pts.join(answers, "x").select("_id", "near"))

    def nearest(i):                             # as the search of the part alone lists them
        return F.slice(F.filter("near", lambda c: F.pmod(c["id"], F.lit(m)) != F.lit(i)), 1, k + 1)

    def others(i):                              # a key that is there twice is no neighbour of itself
        return F.slice(F.filter(nearest(i), lambda c: _uncoded(c["id"], m) != _uncoded(F.col("_id"), m)), 1, k)

    # Every list must have k + 1 rows of every part, or all rows of the part.
    sizes = {r[0]: r[1] for r in pts.groupBy(F.pmod("_id", F.lit(m))).agg(F.count("*")).collect()}
    short = F.lit(False)
    for i in range(-1, m):
        least = min(k + 1, sum(n for f, n in sizes.items() if f != i))
        short = short | ((F.pmod("_id", F.lit(m)) != F.lit(i)) & (F.size(nearest(i)) < F.lit(least)))
    if near.where(short).limit(1).count():
        return None

    def part(i):
        rows = near.where(F.pmod("_id", F.lit(m)) != F.lit(i)).select("_id", F.posexplode(others(i)).alias("_p", "_c"))
        return rows.select(_uncoded(F.col("_id"), m).alias(key), _uncoded(F.col("_c.id"), m).alias("nn_key"), F.col("_c.d2").alias("d2"), (F.col("_p") + 1).alias("nn_rank"))

    return {None: part(-1), **{f: part(i) for i, f in enumerate(folds)}}


def _uncoded(c: Column, folds: int) -> Column:
    """The key of a key that carries its fold (whole numbers only)."""
    return F.call_function("div", c - F.pmod(c, F.lit(folds)), F.lit(folds))


def _candidates(df: DataFrame, key: str, features: Sequence[str], need: int, bucket_rows: int, report: dict | None,
                folds: int = 0):
    """Points, distinct vectors and every vector's nearest rows (vid, near), itself among them: the
    first ``need``, or with ``folds`` as many as leave ``need`` outside of any one fold."""
    from hhlens.session import cut_lineage

    spark, d, kk = df.sparkSession, len(features), need * FOLD_PLACES if folds else need
    pts, uniq = distinct_vectors(df, key, features, need, folds)
    n = uniq.count()
    cores = spark.sparkContext.defaultParallelism
    leaf_rows = min(bucket_rows, max(64, math.ceil(n / (4 * cores))))
    leaves = min(MAX_LEAVES, math.ceil(n / leaf_rows)) or 1
    # Groups are subtrees of ``per`` leaves; there are some for every core.
    groups = 1 << max(0, math.ceil(math.log2(max(leaves / GROUP_LEAVES, min(leaves, 8 * cores)))))
    per = max(1, leaves // groups)
    leaves = min(MAX_LEAVES, per * groups) if leaves > 1 else 1

    # The tree: at most about SAMPLE_PER_LEAF rows per leaf reach the driver, chosen by hash.
    share = min(1.0, SAMPLE_PER_LEAF * leaves / max(n, 1))
    tree = {"axis": np.zeros(0, np.int64)}
    if leaves > 1:
        got = uniq.where(F.pmod(F.xxhash64("vid"), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30)))).select("x", "vid").toArrow()
        if got.num_rows > 1:
            ids = got.column("vid").to_numpy()
            order = np.argsort(ids)
            tree = grow(_matrix(got.column("x"), d)[order], ids[order], leaves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = route(tree, _matrix(b.column("x"), d), b.column("vid").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32)), pa.array((at // per).astype(np.int32))],
                                             names=[*b.schema.names, "leaf", "part_of"])

    schema = "x array<double>, ids array<bigint>, vid bigint, leaf int, part_of int"
    placed = cut_lineage(uniq.select("x", "ids", "vid").mapInArrow(place, schema))
    box = placed.groupBy("leaf").agg(
        F.count("*").alias("n"), F.array(*[F.min(F.col("x")[i]) for i in range(d)]).alias("lo"),
        F.array(*[F.max(F.col("x")[i]) for i in range(d)]).alias("hi")).toArrow()
    box = box.sort_by("leaf")
    sent = spark.sparkContext.broadcast((
        box.column("leaf").to_numpy().astype(np.int64), _matrix(box.column("lo"), d), _matrix(box.column("hi"), d),
        box.column("n").to_numpy()))

    def radius(best):
        return _radius(best, need, folds)

    def local(t: pa.Table) -> pa.Table:
        x, leaf = _matrix(t.column("x"), d), t.column("leaf").to_numpy()
        r_ids, rx, r_leaf = _refs(t, x, leaf)
        best = _search_group(x, r_ids, rx, leaf, r_leaf, sent.value, kk, radius)
        r2, own = radius(best), t.column("part_of")[0].as_py()
        if folds:                               # what lies beyond the radius answers nobody
            best[1][best[0] > r2[:, None]] = NOBODY
        visits: list = [None] * len(x)
        for rows in _by_leaf(leaf).values():
            mine = r2[rows]
            for row, groups_there in zip(rows.tolist(), _visits(x[rows], mine, own, per, sent.value, NOBODY if folds else kk)):
                visits[row] = groups_there
            r2[rows] = mine
        return pa.table({"vid": t.column("vid"), "x": t.column("x"), "near": _lists(*_flat(best), len(x)), "r2": pa.array(r2),
                         "visits": pa.array(visits, pa.list_(pa.int32()))})

    pair = "array<struct<d2: double, id: bigint>>"
    own = cut_lineage(placed.groupBy("part_of").applyInArrow(
        local, f"vid bigint, x array<double>, near {pair}, r2 double, visits array<int>"))
    asks = own.where(F.size("visits") > 0).select(F.explode("visits").alias("part_of"), "vid", "x", "r2")
    # One row per visited group (at most MAX_LEAVES): into how many parts its queries are dealt.
    deal = cut_lineage(asks.groupBy("part_of").agg(F.count("*").alias("n"))
                       .withColumn("m", F.ceil(F.col("n") / F.lit(VISITS)).cast("int")))
    n_visits = deal.agg(F.sum("n")).first()[0] or 0
    if report is not None:
        report.update(vectors=n, leaves=box.num_rows, visits=n_visits)
    lists = own.select("vid", "near")
    if n_visits:
        side = F.broadcast(deal.select("part_of", "m"))
        empty = F.array().cast("array<bigint>")
        q = asks.join(side, "part_of").select(
            "part_of", F.pmod(F.xxhash64("vid"), F.col("m")).cast("int").alias("part"), "vid", "x", "r2",
            F.lit(-1).alias("leaf"), empty.alias("ids"))
        refs = placed.join(side, "part_of").select(
            "part_of", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"), "vid", "x",
            F.lit(None).cast("double").alias("r2"), "leaf", "ids")

        def cross(t: pa.Table) -> pa.Table:
            x, r2 = _matrix(t.column("x"), d), t.column("r2").combine_chunks()
            asked = r2.is_valid().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(~asked)
            leaf = t.column("leaf").to_numpy()[rows]
            r_ids, rx, r_leaf = _refs(t.take(pa.array(rows)), x[rows], leaf)
            qx, limit = x[asked], r2.to_numpy(zero_copy_only=False)[asked] * (1 + SLACK) + 1e-12
            best = np.full((len(qx), kk), np.nan), np.full((len(qx), kk), NOBODY)
            boxes = sent.value
            for name, there in _by_leaf(r_leaf).items():
                j = np.searchsorted(boxes[0], name)
                hit = np.flatnonzero(box_distance(qx, boxes[1][j:j + 1], boxes[2][j:j + 1])[:, 0] <= limit)
                _put(best, hit, *_within(qx[hit], r_ids[there], rx[there], limit[hit], kk), kk)
            # Most visits find nothing nearer: only the others answer.
            some = np.flatnonzero(best[1][:, 0] != NOBODY)
            return pa.table({"vid": t.column("vid").combine_chunks().filter(pa.array(asked)).take(pa.array(some)),
                             "near": _lists(*_flat((best[0][some], best[1][some])), len(some))})

        more = q.unionByName(refs).groupBy("part_of", "part").applyInArrow(cross, f"vid bigint, near {pair}")
        both = own.where(F.size("visits") > 0).select("vid", "near").unionByName(more)
        # A vector's candidates: at most k + 1 per visited group.
        best = both.groupBy("vid").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, kk).alias("near"))
        lists = own.where(F.size("visits") == 0).select("vid", "near").unionByName(best)
    return pts, uniq, lists
