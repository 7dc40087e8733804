"""Removal of repeated byte strings with suffix arrays (two-stage sorting).

A byte is removed if it is covered by a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus (judged on the input; strings never cross documents).

Distribution.  Equal windows of ``LENGTH`` bytes must meet, whatever documents they are in:

* each window is keyed by its least ``GRAM``-byte gram (hash order, leftmost on ties), which
  depends on the window's bytes alone.  Neighbouring windows share their gram, so a document
  becomes runs of window starts, about one per ``(LENGTH - GRAM) / 2`` bytes;
* a run whose gram occurs once in the corpus holds no repeat and is dropped;
* equal runs (by a 128-bit digest) are kept once with their count, so groups of copies of any
  size shrink before any text moves;
* the runs of one gram meet in one task.  A gram with over ``HOT`` different runs is dealt
  again by the bytes that windows at nearly the same distance from the gram have in common,
  down to single windows, so that no task holds an unbounded group.

In a task, whole grams are taken together in blocks of about ``BLOCK`` bytes.  A block's
suffix array is made in two stages: suffixes smaller than their successors are sorted
directly (to ``LENGTH`` bytes), all others are induced by one scan over the buckets of first
bytes; then common prefixes of neighbours are computed.  A window is repeated if a neighbour
shares ``LENGTH`` bytes.  (A run seen twice or more enters a block once; its windows are
repeated in any case.)

Memory.  A task holds some 130 bytes per byte of a ``CHUNK`` of text while it looks for runs,
one block and its suffix array while it searches, and one Arrow batch: of about ``BATCH`` bytes
in the scan of all texts, of the session's size in the steps that run when the caller asks.

Defined cases: null text is empty; texts shorter than ``LENGTH`` keep all bytes; rows with
equal texts have equal results; no id is used, so null or repeated ids do no harm; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, cut_lineage

LENGTH = 400
GRAM = 128
HOT = 20_000
HOT_BYTES = 2 << 20                     # bytes of one gram's runs that are sorted together
BLOCK = 1 << 18
CHUNK = 1 << 18
BATCH = 1 << 22
POSITION_BITS = 22
BASE = 0x9E3779B97F4A7C15 | 1
SPLITS = (34, 1)


# ---------------------------------------------------------------- runs of window starts

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Finds runs in a block of concatenated texts."""

    def __init__(self, length: int, gram: int, most: int):
        self.length, self.gram, self.most = length, gram, most
        with np.errstate(over="ignore"):
            self.up = _powers(BASE, most + 1)
            self.down = _powers(pow(BASE, -1, 1 << 64), most + 1)

    def grams(self, b: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the gram at every position."""
        n = len(b) - self.gram + 1
        with np.errstate(over="ignore"):
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:len(b)], out=total[1:])
            h = (total[self.gram:] - total[:-self.gram]) * self.down[:n]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return h

    def find(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Texts [starts, ends) in ``b`` -> (key, first window, number of windows, gram)."""
        h, w = self.grams(b), self.length - self.gram + 1
        low = np.uint64((1 << POSITION_BITS) - 1)
        v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(v) // w)
        grid = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
        grid[:len(v)] = v
        grid = grid.reshape(rows, w)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(b) - self.length + 1
        at = (np.minimum(right[:n], left[w - 1:w - 1 + n]) & low).astype(np.int64)
        ok = np.zeros(n + 1, np.int64)
        np.add.at(ok, starts, 1)
        np.add.at(ok, ends - self.length + 1, -1)
        first = np.flatnonzero(np.cumsum(ok)[:n] > 0)
        at = at[first]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)])
        # A new text starts a new run, even where it follows without a gap.
        border = np.searchsorted(first, starts)
        new = np.union1d(new, border[border < len(first)])
        count = np.diff(np.r_[new, len(first)])
        return h[at[new]], first[new], count, at[new]


RUN = "key long, digest binary, tid binary, start long, n int, gram int"


def runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(tid, body) -> one row per run: its gram key, digest of its bytes, place, number of
    windows and the gram's offset in it."""

    def chunks(batches):
        """Blocks of up to CHUNK bytes; longer texts in pieces that overlap by length - 1."""
        held, size = [], 0
        for b in batches:
            for tid, body in zip(b.column(0), b.column(1)):
                body = body.as_py()
                for at in range(0, max(1, len(body) - length + 1), CHUNK):
                    piece = body[at:at + CHUNK + length - 1]
                    if len(piece) < length:
                        continue
                    if size and size + len(piece) > CHUNK + length:
                        yield held
                        held, size = [], 0
                    held.append((tid.as_py(), at, piece))
                    size += len(piece)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = None
        for held in chunks(batches):
            finder = finder or Runs(length, gram, CHUNK + 2 * length)
            buf = b"".join(x[2] for x in held)
            ends = np.cumsum([len(x[2]) for x in held])
            starts = np.r_[0, ends[:-1]]
            key, first, count, at = finder.find(np.frombuffer(buf, np.uint8), starts, ends)
            own = np.searchsorted(ends, first, side="right")
            digests = [hashlib.blake2b(buf[a:b], digest_size=16).digest()
                       for a, b in zip(first.tolist(), (first + count + length - 1).tolist())]
            place = first - starts[own] + np.array([x[1] for x in held])[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(digests, pa.binary()),
                 pa.array([held[i][0] for i in own.tolist()], pa.binary()), pa.array(place),
                 pa.array(count.astype(np.int32)), pa.array((at - first).astype(np.int32))],
                names=["key", "digest", "tid", "start", "n", "gram"])

    return texts.mapInArrow(run, RUN)


# ---------------------------------------------------------------- two-stage suffix sorting

def sort_suffixes(text: bytes, at: np.ndarray, depth: int) -> np.ndarray:
    """The positions ``at`` in the order of their suffixes' first ``depth`` bytes: by eight bytes
    at once, then ties by slices, which exist for one group of ties at a time."""
    padded = np.frombuffer(text + bytes(8), np.uint8)
    words = np.lib.stride_tricks.as_strided(padded[:8].view(">u8"), (len(text) + 1,), (1,))
    head = words[at].astype(np.uint64)
    by = np.argsort(head, kind="stable")
    at, head = at[by], head[by]
    cut = np.flatnonzero(np.r_[True, head[1:] != head[:-1], True])
    tied = np.flatnonzero(np.diff(cut) > 1)
    for a, z in zip(cut[tied].tolist(), cut[tied + 1].tolist()):
        at[a:z] = sorted(at[a:z].tolist(), key=lambda p: text[p:p + depth])
    return at


def suffix_order(text: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The positions in ``wanted`` (sorted) in the order of their suffixes, exact to ``depth``
    bytes.  Two stages: direct sort of suffixes smaller than their successors, induction of
    the others."""
    n = len(text)
    t = np.empty(n + 1, np.int16)
    t[:n] = np.frombuffer(text, np.uint8)
    t[n] = -1
    # smaller[p]: suffix p < suffix p + 1; equal bytes take the kind of the next change.
    change = np.flatnonzero(t[1:] != t[:-1])
    up = t[change] < t[change + 1]
    smaller = np.ones(n + 1, bool)
    smaller[:n] = up[np.searchsorted(change, np.arange(n))]
    # Besides the wanted ones, successors are needed up to the next directly sorted suffix.
    anchors = np.flatnonzero(smaller)
    needed = np.zeros(n + 2, np.int64)
    np.add.at(needed, wanted, 1)
    np.add.at(needed, anchors[np.searchsorted(anchors, wanted)] + 1, -1)
    used = np.cumsum(needed)[:n + 1] > 0
    direct = sort_suffixes(text, np.flatnonzero(used & smaller), depth)

    # One bucket per first byte: first the induced suffixes, then the directly sorted ones.
    own = t[direct]
    bounds = np.searchsorted(own, np.arange(-1, 257))
    waiting: dict[int, list[np.ndarray]] = {}
    order = []
    induced = used & ~smaller
    for c in range(-1, 256):
        low, fresh = [], np.concatenate(waiting.pop(c)) if c in waiting else None
        while fresh is not None and len(fresh):
            low.append(fresh)
            back = fresh[fresh > 0] - 1
            fresh = back[induced[back] & (t[back] == c)]
        full = np.concatenate([*low, direct[bounds[c + 1]:bounds[c + 2]]])
        if not len(full):
            continue
        order.append(full)
        back = full[full > 0] - 1
        back = back[induced[back] & (t[back] > c)]
        if len(back):
            byte = t[back]
            by = np.argsort(byte, kind="stable")
            back, byte = back[by], byte[by]
            cut = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]])
            for part, first in zip(np.split(back, cut[1:]), byte[cut].tolist()):
                waiting.setdefault(first, []).append(part)
    out = np.concatenate(order) if order else np.zeros(0, np.int64)
    is_wanted = np.zeros(n + 1, bool)
    is_wanted[wanted] = True
    return out[is_wanted[out]]


def common_prefixes(text: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it, up to ``depth``."""
    lcp = np.zeros(len(order), np.int64)
    padded = np.frombuffer(text + bytes(depth + 8), np.uint8)
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(text) + depth + 1,), (1,))
    live = np.arange(1, len(order))
    for at in range(0, depth, 8):
        a, b = order[live] + at, order[live - 1] + at
        same = words[a] == words[b]
        diff = words[a[~same]] ^ words[b[~same]]  # little-endian: the lowest byte comes first
        below = (diff & (~diff + np.uint64(1))) - np.uint64(1)
        lcp[live[~same]] = at + np.bitwise_count(below).astype(np.int64) // 8
        live = live[same]
    lcp[live] = depth
    return np.minimum(lcp, depth)


def repeated_windows(strings: list[tuple[bytes, int, bool]], length: int) -> list[np.ndarray]:
    """For each (bytes, number of windows, seen twice or more): which windows are repeated."""
    text = b"".join(s for s, _, _ in strings)
    at, starts, wanted = 0, [], []
    for s, n, _ in strings:
        starts.append(at)
        wanted.append(np.arange(at, at + n))
        at += len(s)
    order = suffix_order(text, np.concatenate(wanted), length)
    same = common_prefixes(text, order, length) >= length
    hit = np.zeros(len(text), bool)
    hit[order[same]] = True
    hit[order[np.flatnonzero(same) - 1]] = True
    return [hit[a:a + n] | twice for a, (_, n, twice) in zip(starts, strings)]


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


PIECE = "key long, digest binary, n int, twice boolean, gram int, skip int, body binary"
_FOUND = "digest binary, low int, high int"


def search(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with bytes -> (digest, low, high): ranges of repeated windows of a run."""
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(n, "key").sortWithinPartitions("key", "digest", "skip")

    def solve(block):
        hits = repeated_windows([(x[6], x[2], x[3]) for x in block], length)
        out = ([], [], [])
        for x, hit in zip(block, hits):
            a, b = _spans(hit)
            out[0].extend([x[1]] * len(a))
            out[1].extend((a + x[5]).tolist())
            out[2].extend((b + x[5]).tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
            names=["digest", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, last = [], 0, None
        for b in batches:
            for x in zip(*[c.to_pylist() for c in b.columns]):
                if last and x[:2] == last[:2] and x[5] == last[5]:
                    continue  # the same run, fetched from another copy of its text
                if size >= BLOCK and x[0] != last[0]:
                    yield solve(block)
                    block, size = [], 0
                block.append(x)
                size += len(x[6])
                last = x
        if block:
            yield solve(block)

    return dealt.mapInArrow(run, _FOUND)


def split(pieces: DataFrame, width: int, length: int = LENGTH) -> DataFrame:
    """Deals pieces again: windows whose distances to the gram lie in one range of ``width``
    have a string in common, which becomes part of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, digest, n, twice, gram, skip, body in zip(*[c.to_pylist() for c in b.columns]):
                # Window i (of the piece) is gram - i bytes before the gram.
                i = 0
                while i < n:
                    zone = (gram - i) // width
                    stop = min(n, gram - zone * width + 1)
                    low, high = gram - (zone + 1) * width + 1, gram - zone * width
                    common = body[max(high, 0):low + length] if width > 1 else body[i:i + length]
                    sub = hashlib.blake2b(b"%d %d " % (key, zone) + common, digest_size=8).digest()
                    out.append((int.from_bytes(sub, "little", signed=True), digest, stop - i, twice,
                                gram - i, skip + i, body[i:stop + length - 1]))
                    i = stop
                    if len(out) >= 2000:
                        yield _pieces(out)
                        out = []
            if out:
                yield _pieces(out)

    return pieces.mapInArrow(run, PIECE)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


# ---------------------------------------------------------------- the job

def _texts(docs: DataFrame, text: str) -> DataFrame:
    """(tid, body): the text's bytes, named by 128 bits of their SHA-256."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(text_id(body).alias("tid"), body.alias("body"))


def text_id(body: Column) -> Column:
    return F.substring(F.unhex(F.sha2(body, 256)), 1, 16)


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(spans, bodies) of the distinct texts that hold repeats: spans is (tid, spans) with
    unmerged byte ranges, bodies (tid, body, ...) has every text with a shared gram."""
    texts = _texts(docs, text)
    spark = docs.sparkSession
    with arrow_batches(spark, BATCH):
        found = cut_lineage(runs(texts.where(F.octet_length("body") >= length), length, gram))
    # Written, so that the join sees two plain exchanges and can split a hot gram's rows.
    shared = cut_lineage(found.groupBy("key").count().where("count > 1").select("key"))
    kept = cut_lineage(found.join(shared, "key"))
    one = kept.groupBy("digest").agg(F.count("*").alias("seen"), F.min(
        F.struct("tid", "start", "n", "gram", "key")).alias("r")).select("digest", "seen", "r.*")
    one = cut_lineage(one)
    hot = one.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.col("n") + F.lit(length - 1)).alias("b")).where(
        (F.col("c") > HOT) | (F.col("b") > HOT_BYTES)).select("key", F.lit(True).alias("hot"))
    lists = one.join(hot, "key", "left").groupBy("tid").agg(F.collect_list(F.struct(
        "start", "n", "gram", "key", "digest", (F.col("seen") > 1).alias("twice"),
        F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))
    owners = kept.select("tid").distinct().join(lists, "tid", "left")
    bodies = cut_lineage(texts.join(owners, "tid"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            out = []
            for tid, body, own in zip(b.column(0), b.column(1), b.column(2)):
                if (tid := tid.as_py()) == last:
                    continue
                last, body = tid, body.as_py()
                for r in own.as_py() or []:
                    a = r["start"]
                    out.append((r["key"], r["digest"], r["n"], r["twice"], r["gram"], 0,
                                body[a:a + r["n"] + length - 1]))
                    if len(out) >= 5000:
                        yield _pieces(out)
                        out = []
            if out:
                yield _pieces(out)

    def fetched(is_hot: bool) -> DataFrame:
        part = bodies.select("tid", "body", F.filter(
            "runs", lambda r: r["hot"] == F.lit(is_hot)).alias("runs"))
        return part.where(F.size("runs") > 0).mapInArrow(fetch, PIECE)

    ranges = search(fetched(False), length)
    if hot.take(1):
        again = fetched(True)
        for width in SPLITS:
            with arrow_batches(spark, BATCH):
                again = cut_lineage(split(again, width, length))
            own = again.groupBy("key", "digest", "skip").agg(F.max(F.octet_length("body")).alias("b"))
            full = cut_lineage(own.groupBy("key").agg(F.count("*").alias("c"), F.sum("b").alias("b"))
                               .where((F.col("c") > HOT) | (F.col("b") > HOT_BYTES)).select("key"))
            if width > 1:
                ranges = ranges.union(search(again.join(full, "key", "left_anti").select(*again.columns), length))
                again = again.join(full, "key").select(*again.columns)
            else:  # equal single windows: two of each suffice
                few = again.groupBy("key").agg(F.count("*").alias("c"), F.max("twice").alias("m"))
                many = again.join(few.where("c > 1 or m").select("key"), "key")
                ranges = ranges.union(many.select("digest", F.col("skip").alias("low"),
                                                  (F.col("skip") + 1).alias("high")))
    places = kept.select("tid", "start", "digest").distinct()
    spans = places.join(ranges, "digest").groupBy("tid").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("low")).alias("a"),
        (F.col("start") + F.col("high") + length - 1).alias("b"))).alias("spans"))
    return spans, bodies


def merge(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   with_body: bool = True) -> DataFrame:
    """The distinct texts from which bytes go: tid, spans (maximal removed runs), n_removed,
    kept_sha256 and, if wanted, the remaining bytes as ``kept``.  All other texts stay as they
    are; ``text_id`` names a text."""
    spans, bodies = repeated_spans(docs, text, length, gram)
    joined = bodies.select("tid", "body").join(spans, "tid")
    schema = ("tid binary, spans array<struct<a: long, b: long>>, n_removed long, "
              "kept_sha256 string, kept binary")
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            out = []
            for tid, body, own in zip(*[b.column(i) for i in range(3)]):
                if (tid := tid.as_py()) == last:
                    continue
                last, body, gone = tid, body.as_py(), merge(own.as_py())
                cuts = [0, *[x for s in gone for x in s], len(body)]
                kept = b"".join(body[a:z] for a, z in zip(cuts[::2], cuts[1::2]))
                out.append((tid, [{"a": a, "b": z} for a, z in gone], len(body) - len(kept),
                            hashlib.sha256(kept).hexdigest(), kept if with_body else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (
                        pa.binary(), kind, pa.int64(), pa.string(), pa.binary()))],
                    names=["tid", "spans", "n_removed", "kept_sha256", "kept"])

    # Copies of a text may meet in several tasks where a hot one was split.
    return joined.mapInArrow(run, schema).dropDuplicates(["tid"])
