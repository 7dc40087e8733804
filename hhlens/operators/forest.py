"""Random forest of binary probability trees (gini), grown in a few passes over the rows.

Level-wise growing passes over the rows once a level, and every task reports the statistics of
all nodes of the level, also of those that hold a handful of rows.  Here only nodes of more than
``UNIT_ROWS`` rows are split so:

1. Split points are quantiles of a sample (all values where the sample has few); the rows are
   stored once as blocks of their bins, one byte a feature.
2. A tree's row counts are Poisson(1) draws (a bootstrap sample), made again from (seed, tree,
   block) wherever they are needed.  Nodes of more than ``UNIT_ROWS`` rows are split by
   histograms that the tasks sum, one pass a level for all trees (a table holds at most
   rows / ``UNIT_ROWS`` such nodes a tree).
3. The rows of every node below meet in one task (at most ``UNIT_ROWS`` rows of one byte a
   feature), which grows its whole subtree level by level, all nodes of a level at once.

A node draws its ``mtry`` features from (seed, tree, node), histograms are sums of whole
numbers: the forest depends on the blocks alone, not on tasks or their order.  Leaves are as in
Spark ML's forest: pure, at ``max_depth``, without a split of positive gain that leaves both
children ``min_node_size`` rows; sibling leaves of one predicted class are joined.

A model holds about 15 bytes a node; it is what the driver and the scoring tasks keep.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hhlens.operators.reduction import combine, parts_for, task_part

# Task code of this module travels by value, so executors need no installed package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

UNIT_ROWS = 1 << 20                     # bootstrap rows of a node whose subtree is grown in one task
BLOCK_ROWS = 1 << 15
SPLIT_ROWS = 100_000                    # rows that the split points are taken from
CHUNK = 1 << 14                         # rows whose histograms are summed at once
_ONE = float(1 << 26)                   # a cell holds rows + _ONE * positive rows
GAIN = 1e-12                            # a gain up to this is rounding


# --------------------------------------------------------------------------- bins
def split_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Ascending thresholds (at most ``max_bins`` - 1) of one feature, as Spark ML takes them:
    midpoints of all distinct values, or one wherever the rows so far come nearest to the next
    of equally spaced ranks (after a hot value the next values catch up)."""
    v, n = np.unique(values, return_counts=True)
    mid = (v[:-1] + v[1:]) / 2
    if len(mid) <= max_bins - 1:
        return mid
    upto, stride = np.cumsum(n).tolist(), len(values) / max_bins
    out, want = [], stride
    for i, (before, now) in enumerate(zip(upto, upto[1:])):
        if abs(before - want) < abs(now - want):
            out.append(mid[i])
            want += stride
    return np.array(out[:max_bins - 1])


def _binned(columns: Sequence[np.ndarray], points: Sequence[np.ndarray]) -> np.ndarray:
    """Rows x features of bins: the number of thresholds below a value."""
    out = np.empty((len(columns[0]), len(points)), np.uint8)
    for j, (c, p) in enumerate(zip(columns, points)):
        out[:, j] = np.searchsorted(p, c, side="left")
    return out


def _doubles(column) -> np.ndarray:
    v = column.cast(pa.float64())
    if v.null_count:
        raise ValueError("a model column has missing values")
    v = v.to_numpy(zero_copy_only=False)
    if np.isnan(v).any():
        raise ValueError("a model column has missing values")
    return v


class Binned:
    """Training rows as stored blocks of bins (``blocks``), with their split points."""

    def __init__(self, blocks: DataFrame, points: list, features: list, n: int):
        self.blocks, self.points, self.features, self.n = blocks, points, features, n
        self.bins = np.array([len(p) + 1 for p in points], np.int64)


def prepare(df: DataFrame, features: Sequence[str], label: str, seed=123, max_bins: int = 32) -> Binned | None:
    """The rows' bins, stored under the shared folder; missing values fail.  None where a label
    is neither 0 nor 1 or a byte can't hold the bins."""
    from hhlens.session import cut_lineage

    features = list(features)
    d = df.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)])
    n, binary = d.agg(F.count("*"), F.count_if(F.col("y").isin(0.0, 1.0))).first()
    if not n:
        raise ValueError("no training rows")
    if binary < n or max_bins > 256:
        return None
    sample = d if n <= SPLIT_ROWS else d.sample(SPLIT_ROWS / n, _number(seed))
    got = sample.select(*[f"x{i}" for i in range(len(features))]).toArrow()
    points = [split_points(_doubles(got.column(i).combine_chunks()), max_bins) for i in range(len(features))]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, count, at = [], 0, 0

        def out():
            x, y = (np.concatenate(v) for v in zip(*held))
            return pa.RecordBatch.from_pydict({
                "task": pa.array([TaskContext.get().partitionId()], pa.int32()), "block": pa.array([at], pa.int32()),
                "x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())})

        for b in batches:
            for s in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(s, BLOCK_ROWS)
                y = _doubles(part.column(0))
                held.append((_binned([_doubles(c) for c in part.columns[1:]], points), y.astype(np.uint8)))
                count += part.num_rows
                if count >= BLOCK_ROWS:
                    yield out()
                    held, count, at = [], 0, at + 1
        if held:
            yield out()

    blocks = cut_lineage(d.mapInArrow(pack, "task int, block int, x binary, y binary"))
    return Binned(blocks, points, features, n)


def _number(*parts) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def _counts(seed: int, tree: int, task: int, block: int, n: int) -> np.ndarray:
    """How often the bootstrap sample of a tree holds each row of a block."""
    return np.random.default_rng([seed, tree, task, block]).poisson(1.0, n).astype(np.uint8)


# --------------------------------------------------------------------------- splits
def draw_features(rng, nodes: int, features: int, mtry: int) -> np.ndarray:
    """nodes x mtry distinct features."""
    if mtry >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return np.argpartition(rng.random((nodes, features), dtype=np.float32), mtry - 1, axis=1)[:, :mtry]


def best_splits(left_pos, left_all, first, widths, pos, tot, min_node: int):
    """Best split of every node from the running sums of its cells: (cell, gain, positive rows
    and rows that go left); cell -1: none.  ``first`` is the first cell of each (node, feature),
    ``widths`` their number of bins."""
    m = len(pos)
    node_first = first[:, 0]
    cells = widths.sum(axis=1)
    p, t = np.repeat(pos, cells), np.repeat(tot, cells)
    rt = t - left_all
    fine = (left_all >= min_node) & (rt >= min_node)
    at = np.flatnonzero(fine)
    score = np.full(len(left_all), -1.0)
    lp, lt, rp, r = left_pos[at], left_all[at], p[at] - left_pos[at], rt[at]
    ln, rn = lt - lp, r - rp
    score[at] = (lp * lp + ln * ln) / lt + (rp * rp + rn * rn) / r
    top = np.maximum.reduceat(score, node_first)
    hit = np.flatnonzero(score == np.repeat(top, cells))
    cell = np.full(m, -1, np.int64)
    cell[(np.searchsorted(node_first, hit, side="right") - 1)[::-1]] = hit[::-1]
    neg = tot - pos
    gain = (top - (pos * pos + neg * neg) / tot) / tot
    return np.where((top >= 0) & (gain > GAIN), cell, -1), gain, left_pos[cell], left_all[cell]


def _layout(bins: np.ndarray, drawn: np.ndarray):
    """(first cell, bins) of every (node, drawn feature), and the number of cells."""
    widths = bins[drawn]
    ends = np.cumsum(widths.ravel())
    return (ends - widths.ravel()).reshape(drawn.shape), widths, int(ends[-1])


def _running(cells, first, widths):
    """Running sums within each (node, feature)."""
    total = np.cumsum(cells)
    at = first.ravel()
    return total - np.repeat(total[at] - cells[at], widths.ravel())


def _cells(x, rows, node, drawn, first, weight, n_cells: int) -> np.ndarray:
    """Sums of ``weight`` per cell, of rows whose drawn features are those of their node."""
    at = drawn[node]
    at += (rows.astype(np.int64) * x.shape[1])[:, None]
    key = x.ravel().take(at) + first[node]
    return np.bincount(key.ravel(), weights=np.repeat(weight, drawn.shape[1]), minlength=n_cells)


def grow_unit(x, y, w, bins, mtry: int, min_node: int, depth: int, rng):
    """The whole subtree over some rows (bins ``x``, labels, counts), ``depth`` levels at most:
    its nodes, see ``Tree``."""
    features = x.shape[1]
    weight = w + _ONE * (w * y)
    rows = np.arange(len(x), dtype=np.int32)
    ids, start = np.zeros(1, np.int64), np.array([0, len(x)])
    pos, tot = np.array([float((w.astype(np.int64) * y).sum())]), np.array([float(w.sum(dtype=np.int64))])
    feat, cut, left = [np.array([-1], np.int16)], [np.zeros(1, np.uint8)], [np.array([-1], np.int32)]
    all_pos, all_tot, all_gain, levels = [pos], [tot], [np.zeros(1)], [0, 1]
    if not (depth > 0 and 0 < pos[0] < tot[0] and tot[0] >= 2 * min_node):
        ids = ids[:0]
    while len(ids):
        m = len(ids)
        size = np.diff(start)
        cell_feat, cell_cut = np.full(m, -1, np.int64), np.zeros(m, np.int64)
        gain, lp, lt = np.zeros(m), np.zeros(m), np.zeros(m)
        goes = np.zeros(len(rows), bool)
        drawn = draw_features(rng, m, features, mtry)
        a = 0
        while a < m:                                    # nodes whose rows fill about a chunk
            b = max(a + 1, int(np.searchsorted(start, start[a] + CHUNK, side="right")) - 1)
            own, mine = drawn[a:b], slice(start[a], start[b])
            first, widths, n_cells = _layout(bins, own)
            node = np.repeat(np.arange(b - a), size[a:b])
            if start[b] - start[a] <= 2 * CHUNK:
                got = _cells(x, rows[mine], node, own, first, weight[rows[mine]], n_cells)
                total = _running(got, first, widths)
                sum_pos = np.floor(total / _ONE)
                sum_all = total - sum_pos * _ONE
            else:
                sum_pos, sum_all = np.zeros(n_cells), np.zeros(n_cells)
                for s in range(start[a], start[b], CHUNK):
                    e = min(s + CHUNK, start[b])
                    got = _cells(x, rows[s:e], node[s - start[a]:e - start[a]], own, first, weight[rows[s:e]], n_cells)
                    high = np.floor(got / _ONE)
                    sum_pos += high
                    sum_all += got - high * _ONE
                sum_pos, sum_all = _running(sum_pos, first, widths), _running(sum_all, first, widths)
            cell, gain[a:b], lp[a:b], lt[a:b] = best_splits(sum_pos, sum_all, first, widths, pos[a:b], tot[a:b], min_node)
            some = np.flatnonzero(cell >= 0)
            flat = np.searchsorted(first.ravel(), cell[some], side="right") - 1
            cell_feat[a + some], cell_cut[a + some] = own.ravel()[flat], cell[some] - first.ravel()[flat]
            goes[mine] = x[rows[mine], cell_feat[a:b][node]] <= cell_cut[a:b][node]
            a = b
        split = np.flatnonzero(cell_feat >= 0)
        for to, v in ((feat, cell_feat), (cut, cell_cut)):
            to[-1][ids[split] - levels[-2]] = v[split]
        all_gain[-1][ids[split] - levels[-2]] = gain[split]
        left[-1][ids[split] - levels[-2]] = levels[-1] + 2 * np.arange(len(split))
        if not len(split):
            break
        depth -= 1
        kid_pos = np.stack([lp[split], pos[split] - lp[split]], axis=1).ravel()
        kid_tot = np.stack([lt[split], tot[split] - lt[split]], axis=1).ravel()
        k = len(kid_pos)
        feat.append(np.full(k, -1, np.int16))
        cut.append(np.zeros(k, np.uint8))
        left.append(np.full(k, -1, np.int32))
        all_pos.append(kid_pos)
        all_tot.append(kid_tot)
        all_gain.append(np.zeros(k))
        levels.append(levels[-1] + k)
        on = (kid_pos > 0) & (kid_pos < kid_tot) & (kid_tot >= 2 * min_node) & (depth > 0)
        # Rows of the children that grow on, the left child's before the right one's: both sides are
        # in order already, so a row moves up by the other side's rows in the children before its own.
        child = np.full(2 * m, -1, np.int64)
        live = np.flatnonzero(on)
        child[(2 * split[:, None] + [0, 1]).ravel()[live]] = np.arange(len(live))
        to = child[2 * np.repeat(np.arange(m), size) + ~goes]
        count = np.bincount(to[to >= 0], minlength=len(live))
        moved = np.empty(count.sum(), np.int32)
        for right in (0, 1):
            mine = np.flatnonzero((to >= 0) & (goes != right))
            other = np.cumsum(count * (live % 2 != right)) - count * (live % 2 != right)
            moved[np.arange(len(mine)) + other[to[mine]]] = rows[mine]
        rows, start = moved, np.r_[0, np.cumsum(count)]
        if len(levels) % 3 == 0:                        # a node's rows lie together again
            x, weight, rows = x[rows], weight[rows], np.arange(len(rows), dtype=np.int32)
        ids, pos, tot = levels[-2] + live, kid_pos[live], kid_tot[live]
    tree = [np.concatenate(v) for v in (feat, cut, left, all_pos, all_tot, all_gain)]
    return _joined(tree, levels)


def _joined(tree, levels):
    """The subtree with sibling leaves of one class joined, level by level from the deepest, and
    its nodes numbered again (children stay next to each other)."""
    feat, cut, left, pos, tot, gain = tree
    leaf, yes = left < 0, pos > tot - pos
    for a, b in list(zip(levels, levels[1:]))[::-1]:
        inner = a + np.flatnonzero(~leaf[a:b])
        kid = left[inner]
        same = leaf[kid] & leaf[kid + 1] & (yes[kid] == yes[kid + 1])
        leaf[inner[same]] = True
    keep = np.zeros(len(feat), bool)
    keep[0] = True
    for a, b in zip(levels, levels[1:]):
        inner = a + np.flatnonzero(keep[a:b] & ~leaf[a:b])
        keep[left[inner]] = keep[left[inner] + 1] = True
    number = np.cumsum(keep) - 1
    left = np.where(leaf, -1, number[left])[keep].astype(np.int32)
    feat = np.where(leaf, -1, feat)[keep].astype(np.int16)
    return feat, cut[keep], left, pos[keep], tot[keep], gain[keep]


# --------------------------------------------------------------------------- trees
class Tree:
    """Nodes of a tree: feature (-1: a leaf), last bin that goes left, left child (the right one
    follows it) and the share of positive rows."""

    def __init__(self, feat, cut, left, prob):
        self.feat, self.cut, self.left, self.prob = feat, cut, left, prob

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at = np.zeros(len(x), np.int32)
        live = np.arange(len(x), dtype=np.int32) if self.left[0] >= 0 else np.zeros(0, np.int32)
        node = at[live]
        while len(live):
            node = self.left[node] + (x[live, self.feat[node]] > self.cut[node])
            done = self.left[node] < 0
            if done.any():
                at[live[done]] = node[done]
                live, node = live[~done], node[~done]
        return at


class _Upper:
    """A tree while its large nodes are split: lists of nodes, children next to each other."""

    def __init__(self, n: int):
        self.feat, self.cut, self.left, self.depth = [-1], [0], [-1], [0]
        self.pos, self.tot, self.gain = [None], [float(n)], [0.0]
        self.large, self.units = ([0], []) if n > UNIT_ROWS else ([], [0])

    def tree(self) -> Tree:
        return Tree(np.array(self.feat, np.int16), np.array(self.cut, np.uint8), np.array(self.left, np.int32), None)

    def split(self, node, feature, bin_, gain, children, min_node, max_depth):
        self.feat[node], self.cut[node], self.left[node], self.gain[node] = feature, bin_, len(self.feat), gain
        for pos, tot in children:
            at, depth = len(self.feat), self.depth[node] + 1
            for to, v in ((self.feat, -1), (self.cut, 0), (self.left, -1), (self.depth, depth), (self.pos, pos),
                          (self.tot, tot), (self.gain, 0.0)):
                to.append(v)
            if 0 < pos < tot and tot >= 2 * min_node and depth < max_depth:
                (self.large if tot > UNIT_ROWS else self.units).append(at)


def _read(b: pa.RecordBatch, features: int):
    for task, block, x, y in zip(*[b.column(i) for i in range(4)]):
        y = np.frombuffer(y.as_buffer(), np.uint8)
        yield task.as_py(), block.as_py(), np.frombuffer(x.as_buffer(), np.uint8).reshape(len(y), features), y


_CELLS = "tree int, part int, sums array<double>"


def _add(t: pa.Table) -> pa.Table:
    sums = t.column("sums").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1).sum(axis=0)
    return pa.table({"tree": t.column("tree")[:1], "part": t.column("part")[:1], "sums": pa.array([sums], pa.list_(pa.float64()))})


def _split_large(data: Binned, uppers: dict, drawn: dict, seed: int) -> dict:
    """tree -> (positive rows, rows) per cell of its large nodes' drawn features."""
    features, bins = len(data.features), data.bins
    work = {}
    for t, up in uppers.items():
        first, _, n_cells = _layout(bins, drawn[t])
        work[t] = up.tree(), np.array(up.large), drawn[t], first, n_cells
    sent = data.blocks.sparkSession.sparkContext.broadcast(work)
    parts = parts_for(data.blocks)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {t: np.zeros(2 * v[4]) for t, v in sent.value.items()}
        for b in batches:
            for task, block, x, y in _read(b, features):
                for t, (tree, large, own, first, n_cells) in sent.value.items():
                    w = _counts(seed, t, task, block, len(y))
                    place = np.full(len(tree.feat), -1)
                    place[large] = np.arange(len(large))
                    node = place[tree.route(x)]
                    rows = np.flatnonzero((w > 0) & (node >= 0))
                    for s in range(0, len(rows), CHUNK):
                        r = rows[s:s + CHUNK]
                        got = _cells(x, r, node[r], own, first, w[r] + _ONE * (w[r] * y[r]), n_cells)
                        high = np.floor(got / _ONE)
                        total[t][:n_cells] += high
                        total[t][n_cells:] += got - high * _ONE
        ts = list(total)
        yield pa.RecordBatch.from_pydict({"tree": pa.array(ts, pa.int32()), "part": pa.array([task_part(parts)] * len(ts), pa.int32()),
                                          "sums": pa.array(list(total.values()), pa.list_(pa.float64()))})

    got = combine(data.blocks.mapInArrow(part, _CELLS), ["tree"], _add, parts).collect()
    return {r.tree: np.array(r.sums).reshape(2, -1) for r in got}


def _grow_units(data: Binned, uppers: dict, seed: int, mtry: int, min_node: int, max_depth: int):
    """(tree, node, its subtree's nodes, importances per feature) of every unit."""
    features, bins = len(data.features), data.bins
    work = {t: (up.tree(), np.array(up.units, np.int32), np.array(up.depth)) for t, up in uppers.items() if up.units}
    if not work:
        return []
    sent = data.blocks.sparkSession.sparkContext.broadcast(work)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for task, block, x, y in _read(b, features):
                out = []
                for t, (tree, units, _) in sent.value.items():
                    w = _counts(seed, t, task, block, len(y))
                    place = np.full(len(tree.feat), -1, np.int32)
                    place[units] = np.arange(len(units))
                    node = place[tree.route(x)]
                    rows = np.flatnonzero((w > 0) & (node >= 0))
                    rows = rows[np.argsort(node[rows], kind="stable")]
                    names, at = np.unique(node[rows], return_index=True)
                    for u, r in zip(names, np.split(rows, at[1:])):
                        out.append((t, int(units[u]), x[r].tobytes(), ((w[r] << 1) | y[r]).tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(
                        zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["tree", "node", "x", "wy"])

    def unit(got: pa.Table) -> pa.Table:
        t, node = got.column("tree")[0].as_py(), got.column("node")[0].as_py()
        wy = np.frombuffer(b"".join(v.as_buffer() for v in got.column("wy")), np.uint8)
        x = np.frombuffer(b"".join(v.as_buffer() for v in got.column("x")), np.uint8).reshape(len(wy), features)
        tree = grow_unit(x, wy & 1, wy >> 1, bins, mtry, min_node, max_depth - int(sent.value[t][2][node]),
                         np.random.default_rng([seed, t, node, 1]))
        feat, cut, left, pos, tot, gain = tree
        inner = left >= 0
        worth = np.bincount(feat[inner], weights=(gain * tot)[inner], minlength=features)
        nodes = [a.astype(k).tobytes() for a, k in ((feat, np.int16), (cut, np.uint8), (left, np.int32), (pos / tot, float))]
        return pa.table({"tree": got.column("tree")[:1], "node": got.column("node")[:1],
                         **{f"b{i}": pa.array([v], pa.binary()) for i, v in enumerate(nodes)},
                         "worth": pa.array([worth], pa.list_(pa.float64())), "yes": pa.array([bool(pos[0] > tot[0] - pos[0])])})

    rows = data.blocks.mapInArrow(deal, "tree int, node int, x binary, wy binary")
    return rows.groupBy("tree", "node").applyInArrow(
        unit, "tree int, node int, b0 binary, b1 binary, b2 binary, b3 binary, worth array<double>, yes boolean").collect()


def _whole(up: _Upper, units: list, features: int):
    """A tree and its importances from its large nodes and its units."""
    n = len(up.feat)
    worth, yes = np.zeros(features), [None if p is None else p > t - p for p, t in zip(up.pos, up.tot)]
    parts = [[np.array(up.feat, np.int16), np.array(up.cut, np.uint8), np.array(up.left, np.int32),
              np.array([0.0 if p is None else p / t for p, t in zip(up.pos, up.tot)])]]
    base = n
    for u in sorted(units, key=lambda u: u.node):
        own = [np.frombuffer(b, k).copy() for b, k in zip((u.b0, u.b1, u.b2, u.b3), (np.int16, np.uint8, np.int32, float))]
        own[2] = np.where(own[2] >= 0, own[2] + (base - 1), -1).astype(np.int32)
        for to, v in zip(parts[0], own):
            to[u.node] = v[0]
        parts.append([v[1:] for v in own])
        worth += np.array(u.worth)
        yes[u.node] = u.yes
        base += len(own[0]) - 1
    feat, cut, left, prob = parts[0]
    for i in range(n - 1, -1, -1):              # the large nodes, children before their parents
        if up.left[i] < 0:
            continue
        k = left[i]
        if left[k] < 0 and left[k + 1] < 0 and yes[k] == yes[k + 1]:
            left[i] = feat[i] = -1
        else:
            worth[feat[i]] += up.gain[i] * up.tot[i]
    return Tree(*[np.concatenate(v) for v in zip(*parts)]), worth


class ForestModel:
    """A fitted forest.  ``transform`` adds Spark ML's columns (``rawPrediction``,
    ``probability``, ``prediction``); ``stages`` makes it look like a fitted pipeline."""

    def __init__(self, features: list, points: list, trees: list, importances: np.ndarray):
        from pyspark.ml.linalg import Vectors

        self.features, self.points, self.trees = features, points, trees
        self.featureImportances = Vectors.dense(importances)

    @property
    def stages(self) -> list:
        return [self]

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def totalNumNodes(self) -> int:
        return sum(len(t.feat) for t in self.trees)

    def scores(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Sum over the trees of their leaves' shares of positive rows."""
        out = np.zeros(len(columns[0]))
        for s in range(0, len(out), BLOCK_ROWS):
            x = _binned([c[s:s + BLOCK_ROWS] for c in columns], self.points)
            for t in self.trees:
                out[s:s + BLOCK_ROWS] += t.prob[t.route(x)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        from pyspark.sql.functions import arrow_udf

        if not hasattr(self, "_sent"):
            self._sent = df.sparkSession.sparkContext.broadcast((self.points, self.trees))
        sent, k = self._sent, float(len(self.trees))

        @arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            m = ForestModel.__new__(ForestModel)
            m.points, m.trees = sent.value
            return pa.array(m.scores([_doubles(c) for c in columns]), pa.float64())

        s = score(*[F.col(c).cast("double") for c in self.features])
        out = df.withColumn("_score", s).withColumn("_prob", F.col("_score") / F.lit(k))
        return (out.withColumn("rawPrediction", array_to_vector(F.array(F.lit(k) - F.col("_score"), F.col("_score"))))
                .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_prob"), F.col("_prob"))))
                .withColumn("prediction", (F.col("_prob") > F.lit(0.5)).cast("double")).drop("_score", "_prob"))


def grow_forest(data: Binned, mtry: int, min_node_size: int, num_trees: int = 300, max_depth: int = 20,
                seed=123) -> ForestModel:
    """The forest over prepared rows; see the module's description."""
    features, seed = len(data.features), _number(seed)
    uppers = {t: _Upper(data.n) for t in range(num_trees)}
    while any(up.large for up in uppers.values()):
        todo = {t: up for t, up in uppers.items() if up.large}
        drawn = {t: np.concatenate([draw_features(np.random.default_rng([seed, t, node]), 1, features, mtry) for node in up.large])
                 for t, up in todo.items()}
        for t, (pos_cells, all_cells) in _split_large(data, todo, drawn, seed).items():
            up, own = uppers[t], drawn[t]
            first, widths, _ = _layout(data.bins, own)
            left_pos, left_all = _running(pos_cells, first, widths), _running(all_cells, first, widths)
            end = first[:, 0] + widths[:, 0] - 1                # any feature's last running sums are the node's
            pos, tot = left_pos[end], left_all[end]
            large, up.large = up.large, []
            cell, gain, lp, lt = best_splits(left_pos, left_all, first, widths, pos, tot, min_node_size)
            for i, node in enumerate(large):
                up.pos[node], up.tot[node] = pos[i], tot[i]
                if cell[i] >= 0:
                    flat = int(np.searchsorted(first.ravel(), cell[i], side="right")) - 1
                    up.split(node, int(own.ravel()[flat]), int(cell[i] - first.ravel()[flat]), float(gain[i]),
                             ((lp[i], lt[i]), (pos[i] - lp[i], tot[i] - lt[i])), min_node_size, max_depth)
    got: dict = {}
    for u in _grow_units(data, uppers, seed, mtry, min_node_size, max_depth):
        got.setdefault(u.tree, []).append(u)
    trees, total = [], np.zeros(features)
    for t, up in uppers.items():
        tree, worth = _whole(up, got.get(t, []), features)
        trees.append(tree)
        total += worth / worth.sum() if worth.sum() > 0 else 0
    return ForestModel(data.features, data.points, trees, total / total.sum() if total.sum() > 0 else total)
