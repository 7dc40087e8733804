"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items are word sequences (letters and digits, lower case).  A document leaks an
item of n words if some stretch of it is within ``floor((1 - SIMILARITY) * n)`` word edits.

* The CGK walk reads a sequence with one pointer; step j emits the word under the pointer and
  moves on by a random bit of (j, word).  Sequences that are close in edit distance emit
  strings that are close in Hamming distance.  All window starts of a batch walk together.
* Bit-sampling: a table takes ``COORDS`` steps of the walk as its key.  Items are indexed and
  windows looked up in tables of their length class, whose steps stay inside an item-sized
  window.  Tables are added until at least ``RECALL`` of simulated copies (items with all
  allowed edits spread evenly, bounded sample) collide with their item in some table, or there are
  ``MAX_TABLES``; what they miss then is left to the pieces.
* Pieces: copies whose edits lie bunched, as at the opening, can miss every table.  So an item
  with k allowed edits is also cut into k + 1 pieces.  An edit spoils at most one of them, so
  every copy holds a piece word by word: looking up all pieces finds every copy.
* Windows that cannot match are skipped without loss: n words with k edits share n - 1 - 2k
  word pairs with the item, so a window with fewer pairs of the benchmark is out.  A place
  found by a piece also needs n - k words of its item.
* Every candidate is verified by the exact edit distance (bit-parallel, free ends) over the
  stretch that its windows cover.

The benchmark is read in blocks of ``BLOCK_ITEMS`` items or ``BLOCK_CHARS`` characters; each block is broadcast and scans
all documents, so its size is bounded whatever the benchmark's.

Defined cases: null and empty texts leak nothing; items without a word match nothing; items
of under 1 / (1 - SIMILARITY) words match only verbatim; repeated items are each reported;
an empty benchmark leaves all documents.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

SIMILARITY = 0.8
RECALL = 0.99
COORDS = 3
WALKS = 16
MAX_TABLES = 512
SIMULATED = 150
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16 << 20
WALK_BYTES = 64 << 20
_WORD = re.compile(r"[^\W_]+")
LEAK = ArrayType(StructType([StructField("item_id", LongType()), StructField("at", IntegerType()),
                             StructField("distance", IntegerType()),
                             StructField("similarity", DoubleType())]))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


def nearest(masks: dict[int, int], n: int, stretch: list[int]) -> tuple[int, int]:
    """The least edit distance of an item (bit mask per word id, n words) to any part of the
    stretch, and the position after the first best part."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best, end = full, 0, n, n, 0
    for i, c in enumerate(stretch):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, i + 1
    return best, end


class Index:
    """Items of one block with their LSH tables; small enough to be broadcast."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float = SIMILARITY,
                 recall: float = RECALL, seed: int = 1):
        rng = random.Random(seed)
        split = [(i, words_of(t)) for i, t in items]
        split = [(i, w) for i, w in split if w]
        self.similarity = similarity
        self.ids = {w: k + 1 for k, w in enumerate(sorted({w for _, s in split for w in s}))}
        self.items = [(i, [self.ids[w] for w in s]) for i, s in split]
        make = np.random.default_rng(seed)
        self.hash = make.integers(1, 1 << 63, len(self.ids) + 1, dtype=np.uint64)
        most = max((len(s) for _, s in self.items), default=1)
        self.steps = int(1.6 * most) + 1
        odd = make.integers(1, 1 << 63, (WALKS, self.steps), dtype=np.uint64)
        self.mult = odd * np.uint64(2) + np.uint64(1)
        self.mix = make.integers(1, 1 << 63, MAX_TABLES * COORDS, dtype=np.uint64).reshape(
            MAX_TABLES, COORDS) | np.uint64(1)
        n_ids = np.uint64(len(self.ids) + 1)
        pairs = [np.array(s[:-1], np.uint64) * n_ids + np.array(s[1:], np.uint64)
                 for _, s in self.items if len(s) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.pieces = self._pieces(make)
        own = [np.array(s, np.uint64) + np.uint64(k) * n_ids for k, (_, s) in enumerate(self.items)]
        self.own_words = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
        self.classes = []
        by: dict[int, list[int]] = {}
        for k, (_, s) in enumerate(self.items):
            by.setdefault(len(s).bit_length(), []).append(k)
        for group in by.values():
            self.classes.append(self._length_class(group, recall, rng))

    # -- pieces

    def _pieces(self, make: np.random.Generator) -> list[tuple]:
        """Per length of a piece: its multipliers, and the sorted keys with item and offset."""
        by: dict[int, list[tuple[int, int]]] = {}
        for k, (_, s) in enumerate(self.items):
            parts = allowed(len(s), self.similarity) + 1
            cuts = [len(s) * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                by.setdefault(b - a, []).append((k, a))
        out = []
        for n, places in sorted(by.items()):
            mult = make.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
            owner, offset = np.array(places, np.int64).T
            ids = np.array([self.items[k][1][a:a + n] for k, a in places], np.int64)
            key = self._piece_keys(ids.ravel(), np.arange(len(places)) * n, mult)
            order = np.argsort(key, kind="stable")
            out.append((mult, key[order], owner[order], offset[order]))
        return out

    def _piece_keys(self, ids: np.ndarray, starts: np.ndarray, mult: np.ndarray) -> np.ndarray:
        key = np.zeros(len(starts), np.uint64)
        with np.errstate(over="ignore"):
            for j, m in enumerate(mult):
                h = self.hash[ids[starts + j]]
                key += (h ^ (h >> np.uint64(31))) * m
        return key

    def _piece_places(self, ids: np.ndarray, shared: np.ndarray, total: np.ndarray,
                      begins: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, start) of all places that hold a piece and may hold its item."""
        sizes = np.array([len(s) for _, s in self.items], np.int64)
        edits = np.array([allowed(n, self.similarity) for n in sizes.tolist()], np.int64)
        for mult, keys, owners, offsets in self.pieces:
            # All pairs of a piece are pairs of the benchmark.
            at = np.flatnonzero(shared if len(mult) > 1 else ids > 0)
            for j in range(1, len(mult) - 1):
                at = at[shared[at + j]]
            for lo in range(0, len(at), 1 << 16):
                some = at[lo:lo + (1 << 16)]
                key = self._piece_keys(ids, some, mult)
                a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                hit = np.flatnonzero(b > a)
                some, a, upto = some[hit], a[hit], np.cumsum((b - a)[hit])
                for first in range(0, int(upto[-1]) if len(hit) else 0, 1 << 14):
                    nth = np.arange(first, min(first + (1 << 14), int(upto[-1])))
                    h = np.searchsorted(upto, nth, "right")
                    entry = a[h] + nth - np.r_[0, upto][h]
                    yield from self._may_hold(owners[entry], some[h], offsets[entry], ids, total,
                                              begins, sizes, edits)

    def _may_hold(self, items, at, offsets, ids, total, begins, sizes, edits) -> Iterator[tuple[int, int]]:
        n, e = sizes[items], edits[items]
        start = np.maximum(at - offsets, begins[np.searchsorted(begins, at, "right") - 1])
        low, high = np.maximum(start - e, 0), np.minimum(start + n + 2 * e, len(ids) - 1)
        fine = total[np.maximum(high - 1, low)] - total[low] >= n - 1 - 2 * e
        items, start, low, high, n, e = (x[fine] for x in (items, start, low, high, n, e))
        found = np.zeros(len(items), np.int64)
        n_ids = np.uint64(len(self.ids) + 1)
        for j in range(int((high - low).max(initial=0))):
            word = ids[np.minimum(low + j, high)]
            code = word.astype(np.uint64) + items.astype(np.uint64) * n_ids
            spot = np.minimum(np.searchsorted(self.own_words, code), len(self.own_words) - 1)
            found += (self.own_words[spot] == code) & (low + j < high) & (word > 0)
        fine = found >= n - e
        return zip(items[fine].tolist(), start[fine].tolist())

    # -- embedding

    def walk(self, ids: np.ndarray, starts: np.ndarray, walk: int, steps: int) -> np.ndarray:
        """(steps, windows): the word id emitted at each step.  ``ids`` ends in padding."""
        out = np.empty((steps, len(starts)), np.int64)
        at, last = starts.copy(), len(ids) - 1
        with np.errstate(over="ignore"):
            for j in range(steps):
                out[j] = ids[at]
                at += ((self.hash[out[j]] * self.mult[walk, j]) >> np.uint64(63)).astype(np.int64)
                np.minimum(at, last, out=at)
        return out

    def keys(self, emitted: np.ndarray, table: int, coords: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """A table's keys, and which of them hold benchmark words only."""
        with np.errstate(over="ignore"):
            key = np.zeros(emitted.shape[1], np.uint64)
            for c, m in zip(coords, self.mix[table]):
                key += (self.hash[emitted[c]] ^ (self.hash[emitted[c]] >> np.uint64(31))) * m
        return key, (emitted[coords] > 0).all(axis=0)

    def _embed(self, sequences: list[list[int]], steps: int) -> list[np.ndarray]:
        pad = steps + 1
        flat = np.concatenate([np.r_[np.array(s, np.int64), np.zeros(pad, np.int64)] for s in sequences])
        starts = np.cumsum([0, *[len(s) + pad for s in sequences[:-1]]])
        return [self.walk(flat, starts, w, steps) for w in range(WALKS)]

    def _length_class(self, group: list[int], recall: float, rng: random.Random) -> dict:
        sizes = [len(self.items[k][1]) for k in group]
        steps = max(1, int(1.6 * min(sizes)))
        own = self._embed([self.items[k][1] for k in group], steps)
        sample = rng.sample(range(len(group)), min(SIMULATED, len(group)))
        trials = [(x, self._edited(self.items[group[x]][1], rng)) for x in sample for _ in range(3)]
        copies = self._embed([t[1] for t in trials], steps)
        of = np.array([t[0] for t in trials])
        missed = np.ones(len(trials), bool)
        tables = []
        while len(tables) < MAX_TABLES and (len(tables) < WALKS or missed.mean() > 1 - recall):
            t = len(tables)
            coords = sorted(rng.sample(range(steps), min(COORDS, steps)))
            key, _ = self.keys(own[t % WALKS], t, coords)
            other, sound = self.keys(copies[t % WALKS], t, coords)
            missed &= ~((other == key[of]) & sound)
            order = np.argsort(key, kind="stable")
            tables.append((coords, key[order], np.array(group)[order]))
        k = [allowed(n, self.similarity) for n in sizes]
        return {"steps": steps, "tables": tables,
                "least": min(n - 1 - 2 * e for n, e in zip(sizes, k)),
                "reach": max(n + e for n, e in zip(sizes, k)), "shortest": min(sizes)}

    def _edited(self, seq: list[int], rng: random.Random) -> list[int]:
        """A copy with all allowed edits at random places."""
        seq = list(seq)
        for _ in range(allowed(len(seq), self.similarity)):
            kind, at = rng.randrange(3), rng.randrange(len(seq))
            word = rng.choice((0, rng.randint(1, len(self.ids))))
            if kind == 0:
                seq[at] = word
            elif kind == 1:
                seq.insert(at, word)
            else:
                del seq[at]
        return seq

    # -- search

    def pad(self) -> int:
        """Words of padding behind every text."""
        return max((c["reach"] for c in self.classes), default=0) + self.steps + 1

    def scan(self, texts: list[str | None]) -> list[list[tuple[int | None, int, int, float]]]:
        """Per text its leaks: (item id, word position, edit distance, similarity), the best
        place of each item."""
        found: list[list] = [[] for _ in texts]
        if not self.items:
            return found
        pad = self.pad()
        get, parts, begins, at = self.ids.get, [], [], 0
        for t in texts:
            s = np.array([get(w, 0) for w in words_of(t)], np.int64)
            begins.append(at)
            parts += [s, np.zeros(pad, np.int64)]
            at += len(s) + pad
        ids = np.concatenate(parts) if parts else np.zeros(pad, np.int64)
        begins = np.array(begins, np.int64)
        n_ids = np.uint64(len(self.ids) + 1)
        code = ids[:-1].astype(np.uint64) * n_ids + ids[1:].astype(np.uint64)
        near = np.searchsorted(self.pairs, code)
        shared = np.zeros(len(code), bool)
        if len(self.pairs):
            shared = self.pairs[np.minimum(near, len(self.pairs) - 1)] == code
        total = np.r_[0, np.cumsum(shared)]
        spots: dict[tuple[int, int], list[int]] = {}
        for c in self.classes:
            end = np.minimum(np.arange(len(code)) + c["reach"], len(code))
            # Pairs inside the window: its last word starts none.
            live = np.flatnonzero((total[np.maximum(end - 1, 0)] - total[:-1] >= max(0, c["least"]))
                                  & (ids[:-1] > 0)) if c["least"] > 0 else np.flatnonzero(ids > 0)
            # One walk at a time, of as many windows as WALK_BYTES hold.
            many = max(256, WALK_BYTES // (8 * c["steps"]))
            for lo in range(0, len(live), many):
                some = live[lo:lo + many]
                for w in range(min(WALKS, len(c["tables"]))):
                    walked = self.walk(ids, some, w, c["steps"])
                    for t in range(w, len(c["tables"]), WALKS):
                        coords, keys, owners = c["tables"][t]
                        key, sound = self.keys(walked, t, coords)
                        a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                        hit = np.flatnonzero((b > a) & sound)
                        for p, i, j in zip(some[hit].tolist(), a[hit].tolist(), b[hit].tolist()):
                            for k in owners[i:j].tolist():
                                spots.setdefault((k, p), [])
        for k, p in self._piece_places(ids, shared, total, begins):
            spots.setdefault((k, p), [])
        return self._verify(spots, ids, begins, found)

    def _verify(self, spots, ids, begins, found):
        of = {}
        for k, p in sorted(spots):
            doc = int(np.searchsorted(begins, p, side="right")) - 1
            of.setdefault((doc, k), []).append(p)
        for (doc, k), places in of.items():
            item, seq = self.items[k]
            n, e = len(seq), allowed(len(seq), self.similarity)
            masks: dict[int, int] = {}
            for i, w in enumerate(seq):
                masks[w] = masks.get(w, 0) | 1 << i
            best, where, begin = n + 1, 0, int(begins[doc])
            i = 0
            while i < len(places):
                j = i
                while j + 1 < len(places) and places[j + 1] <= places[j] + n:
                    j += 1
                low, high = max(begin, places[i] - e), places[j] + n + 2 * e
                d, end = nearest(masks, n, ids[low:high].tolist())
                if d < best:
                    best, where = d, max(0, low + end - n - begin)
                i = j + 1
            if best <= e:
                found[doc].append((item, where, best, 1 - best / n))
        return found


def blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS, chars: int = BLOCK_CHARS
           ) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark's items in blocks bounded by items and by characters (one item at least)."""
    held, long = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        if held and (len(held) == size or long + len(r[1] or "") > chars):
            yield held
            held, long = [], 0
        held.append((r[0], r[1]))
        long += len(r[1] or "")
    if held:
        yield held


#: Words and padding that are scanned at once (a word counts as four characters).
AT_ONCE = 1 << 20


def _scan(docs: DataFrame, items, text: str, keep: list[str], only_clean: bool,
          similarity: float, recall: float) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(Index(items, similarity, recall))
    fields = docs.select(*keep).schema.fields
    schema = StructType(fields if only_clean else [*fields, StructField("_leaks", LEAK)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("item_id", "at", "distance", "similarity")
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("at", pa.int32()),
                                   ("distance", pa.int32()), ("similarity", pa.float64())]))
        for b in batches:
            leaks, some, size, pad = [], [], 0, index.value.pad()
            for t in b.column(text):
                some.append(t.as_py())
                size += len(some[-1] or "") // 4 + pad
                if size > AT_ONCE:
                    leaks += index.value.scan(some)
                    some, size = [], 0
            leaks += index.value.scan(some)
            out = b.select(keep)
            if only_clean:
                yield out.filter(pa.array([not x for x in leaks], pa.bool_()))
            else:
                col = pa.array([[dict(zip(names, x)) for x in own] for own in leaks], kind)
                yield pa.RecordBatch.from_arrays([*out.columns, col], names=[*keep, "_leaks"])

    return docs.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
               recall: float = RECALL) -> DataFrame:
    """doc_id, item_id, at (word position), distance (word edits), similarity: one row per
    document row and item that it leaks."""
    out = None
    for items in blocks(benchmark):
        rows = _scan(docs.select("doc_id", "text"), items, "text", ["doc_id"], False, similarity, recall)
        rows = rows.select("doc_id", F.explode("_leaks").alias("l")).select("doc_id", "l.*")
        out = rows if out is None else out.union(rows)
    if out is None:
        out = docs.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("at"),
                                   F.lit(0).alias("distance"), F.lit(0.0).alias("similarity"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                  recall: float = RECALL) -> DataFrame:
    """The documents that leak no item; columns as given."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    out = docs.toDF(*names)
    for items in blocks(benchmark):
        out = _scan(out, items, text, names, True, similarity, recall)
    return out.toDF(*docs.columns)
