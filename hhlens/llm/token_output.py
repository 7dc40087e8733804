"""Token-ID output: packed sequences in training order, written as fixed-stride shards.

1. Every input partition is tokenised once, as one stream (each document ends with ``eos``)
   that is cut into sequences of ``seq_len`` ids, the last one padded with ``eos``.  They are
   staged as one file per partition; a small table lists them.  Counts per partition (one
   number each) give every sequence a dense index.
2. A keyed Feistel permutation with cycle-walking over [0, n) maps the index to its global
   slot: the training order.  It is a bijection that needs no table and can be inverted.
3. Only the list is shuffled: slots are range-partitioned (shard = slot // shard_seqs) and a
   task gathers up to ``WRITE_BYTES`` of whole shards at a time, reading each staged file once
   per gathering in file order, and writes them in slot order.  A sequence is at byte
   (slot % shard_seqs) * stride of its shard, so a reader streams files in order and resumes
   at any slot by arithmetic.  The staged files go when the manifest is written.

Files carry a name that is unique to the task attempt and count only through the manifest
(written by Spark's committer), so lost executors and repeated attempts leave no wrong data.

Defined cases: a null or empty text is one ``eos``; a null doc_id is listed as null; an empty
table writes no shard and an empty manifest.  A text of any length gets the ids of the whole
text; only runs of more than ``PIECE`` white-space characters, on which the look-ahead can
overflow the tokenizer's stack, are tokenised apart, at places where the split pattern cuts too.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import cut_lineage, scratch_path, shared_fs

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EOS = 50_256
SEQ_LEN = 2_048
SHARD_SEQS = 4_096
KEY = "order-1"
PIECE = 20_000
ROUNDS = 6
WRITE_BYTES = 64 << 20
STAGED = ("part", "idx", "file", "n_tokens", "doc_ids")
_STAGED = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()))
MANIFEST = ("slot long, shard long, file string, offset long, n_tokens int, "
            "doc_ids array<long>, sha256 string")


def round_keys(key: str) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{key}:{i}".encode()).digest()[:8], "little")
            for i in range(ROUNDS)]


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mix of x and a round key (shifts and odd multipliers)."""
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, keys: list[int], inverse: bool = False) -> np.ndarray:
    """The slots of ``index`` in [0, n): Feistel over the next even power of two, repeated on
    values outside the range until they fall inside."""
    half = max(1, math.ceil(max(1, (n - 1).bit_length()) / 2))
    low = np.uint64((1 << half) - 1)

    def once(v: np.ndarray) -> np.ndarray:
        a, b = v >> np.uint64(half), v & low
        for k in (reversed(keys) if inverse else keys):
            if inverse:
                a, b = b ^ (_scramble(a, k) & low), a
            else:
                a, b = b, a ^ (_scramble(b, k) & low)
        return (a << np.uint64(half)) | b

    with np.errstate(over="ignore"):
        out = once(np.asarray(index, np.uint64))
        while (outside := np.flatnonzero(out >= n)).size:
            out[outside] = once(out[outside])
    return out.astype(np.int64)


class Encoder:
    """Texts to token ids.

    The look-ahead of the split pattern matters only where white space follows white space;
    texts without such a place take the same pattern without it, which scans faster."""

    def __init__(self, vocabulary: bytes):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.full, self.brief = (tiktoken.Encoding(
            "ids", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            for p in (PATTERN, PATTERN.replace(LOOK_AHEAD, "")))

    def __call__(self, text: str) -> list[int]:
        out, at = [], 0
        for gap in _LONG.finditer(text) if len(text) > PIECE else ():
            # The pattern's run ends before the last white space, unless the text ends first.
            end = gap.end() - (gap.end() < len(text))
            out += self._run(text[at:gap.start()]) + self.brief(text[gap.start():end])
            at = end
        return out + self._run(text[at:])

    def _run(self, text: str) -> list[int]:
        return (self.full if _DOUBLE.search(text) else self.brief)(text)


LOOK_AHEAD = r"|\s+(?!\S)"
_DOUBLE = re.compile(r"\s\s")
#: Unicode's White_Space, as in the split pattern (Python's own class has more).
_LONG = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % (PIECE + 1))


def _sequences(batches, encode: Encoder, seq_len: int, eos: int, dtype):
    """The packed sequences of one partition: (payload, n_tokens, doc ids in order)."""
    buf = np.empty(seq_len, dtype)
    at, ids = 0, []
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
            new = np.array([*encode(text.as_py() or ""), eos], dtype)
            done = 0
            while done < len(new):
                k = min(seq_len - at, len(new) - done)
                buf[at:at + k] = new[done:done + k]
                if not ids or ids[-1] != doc:
                    ids.append(doc)
                at, done = at + k, done + k
                if at == seq_len:
                    yield buf.tobytes(), seq_len, ids
                    at, ids = 0, []
    if at:
        buf[at:] = eos
        yield buf.tobytes(), at, ids


def write_shards(docs: DataFrame, out: str | None = None, tokenizer: str = TOKENIZER,
                 seq_len: int = SEQ_LEN, shard_seqs: int = SHARD_SEQS, key: str = KEY,
                 eos: int = EOS) -> DataFrame:
    """Writes doc_id/text as shards under the shared folder ``out``; returns the manifest, one
    row per sequence."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "shards")
    with open(tokenizer, "rb") as f:  # the driver's; a vocabulary is a few MB
        vocabulary = spark.sparkContext.broadcast(f.read())
    dtype = "<u2" if eos < 1 << 16 else "<u4"
    stride = seq_len * np.dtype(dtype).itemsize
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    staging = f"{out}/parts"

    def stage(batches):
        """The sequences of one partition, written as one file; a row for each."""
        encode, p = Encoder(vocabulary.value), TaskContext.get().partitionId()
        name, sink, rows, index = f"part-{p:08d}-{uuid.uuid4().hex[:8]}.bin", None, [], 0

        def flush():
            cols = [[p] * len(rows), [r[0] for r in rows], [name] * len(rows), [r[1] for r in rows], [r[2] for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _STAGED)], names=list(STAGED))

        for payload, n, ids in _sequences(batches, encode, seq_len, eos, dtype):
            if sink is None:
                fs, base = shared_fs(staging)
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{base}/{name}", compression=None)
            sink.write(payload)
            rows.append((index, n, ids))
            index += 1
            if len(rows) == 2_048:
                yield flush()
                rows = []
        if sink:
            sink.close()
        if rows:
            yield flush()

    staged = cut_lineage(text.mapInArrow(stage, "part long, idx long, file string, n_tokens int, doc_ids array<long>"))
    starts, total = {}, 0
    for part, n in sorted(tuple(r) for r in staged.groupBy("part").count().collect()):
        starts[part], total = total, total + n
    if not total:
        return spark.createDataFrame([], MANIFEST + ", folder string")
    keys = round_keys(key)
    first = spark.sparkContext.broadcast(starts)            # one number per input partition

    def place(batches):
        for b in batches:
            at = first.value
            index = np.array([at[p] for p in b.column("part").to_pylist()], np.int64) + b.column("idx").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(permute(index, total, keys)), *b.columns[1:]],
                                             names=["slot", *STAGED[1:]])

    n_shards = -(-total // shard_seqs)
    tasks = max(1, min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    each = -(-n_shards // tasks) * shard_seqs  # slots of one range
    placed = staged.mapInArrow(place, "slot long, idx long, file string, n_tokens int, doc_ids array<long>")
    ranged = placed.repartitionById(tasks, F.floor(F.col("slot") / each).cast("int")) \
        .sortWithinPartitions("slot")

    def write(batches):
        fs, base = shared_fs(out)
        _, parts = shared_fs(staging)
        held: list[tuple] = []

        def flush():
            """The held sequences (whole shards): read in the order of the staged files, written
            in slot order."""
            data = bytearray(len(held) * stride)
            name = src = None
            for i in sorted(range(len(held)), key=lambda i: held[i][1:3]):
                if held[i][1] != name:
                    if src:
                        src.close()
                    name = held[i][1]
                    src = fs.open_input_file(f"{parts}/{name}")
                data[i * stride:(i + 1) * stride] = src.read_at(stride, held[i][2] * stride)
            src.close()
            rows = {c: [] for c in ("slot", "shard", "file", "offset", "n_tokens", "doc_ids", "sha256")}
            view = memoryview(data)
            for lo in range(0, len(held), shard_seqs):
                shard = held[lo][0] // shard_seqs
                file = f"shard-{shard:08d}-{uuid.uuid4().hex[:8]}.bin"
                hi = min(lo + shard_seqs, len(held))
                if [h[0] for h in held[lo:hi]] != list(range(shard * shard_seqs, shard * shard_seqs + hi - lo)):
                    raise RuntimeError(f"shard {shard} lacks a slot")
                with fs.open_output_stream(f"{base}/{file}", compression=None) as sink:
                    sink.write(view[lo * stride:hi * stride])
                for i in range(lo, hi):
                    slot, _, _, n, ids = held[i]
                    for c, v in zip(rows, (slot, shard, file, (i - lo) * stride, n, ids,
                                           hashlib.sha256(view[i * stride:(i + 1) * stride]).hexdigest())):
                        rows[c].append(v)
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("slot", pa.int64()), ("shard", pa.int64()), ("file", pa.string()),
                ("offset", pa.int64()), ("n_tokens", pa.int32()),
                ("doc_ids", pa.list_(pa.int64())), ("sha256", pa.string())]))

        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("slot", "file", "idx", "n_tokens", "doc_ids")]):
                if row[0] % shard_seqs == 0 and (len(held) + shard_seqs) * stride > WRITE_BYTES:
                    yield flush()
                    held = []
                held.append(row)
        if held:
            yield flush()

    manifest = cut_lineage(ranged.mapInArrow(write, MANIFEST))
    folder = spark._jvm.org.apache.hadoop.fs.Path(staging)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return manifest.withColumn("folder", F.lit(out))


def checked(manifest: DataFrame, seq_len: int = SEQ_LEN, eos: int = EOS) -> DataFrame:
    """The manifest's sequences with the digest of what their files hold now; a sequence that
    differs from what was written is an error."""
    got = read_shards(manifest, seq_len, eos, decode=False)
    now = F.sha2("tokens", 256)
    same = F.when(now == F.col("sha256"), now).otherwise(
        F.raise_error(F.concat(F.lit("damaged sequence "), F.col("slot").cast("string"))))
    return got.select(
        "slot", "shard", "offset", "n_tokens", "doc_ids", same.alias("tokens_sha256"))


def read_shards(manifest: DataFrame, seq_len: int = SEQ_LEN, eos: int = EOS,
                start: int = 0, decode: bool = True) -> DataFrame:
    """The sequences from slot ``start`` on, read back from the files: the manifest's columns
    and ``tokens`` (array of ids, padding included; the raw bytes if not decoded)."""
    dtype = "<u2" if eos < 1 << 16 else "<u4"
    stride = seq_len * np.dtype(dtype).itemsize
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = manifest.where(F.col("slot") >= start).repartitionByRange(n, "slot") \
        .sortWithinPartitions("slot")
    kind = ArrayType(IntegerType()) if decode else BinaryType()
    schema = StructType([*manifest.schema.fields, StructField("tokens", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, src = None, None
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                out = []
                for folder, file, at in zip(*[b.column(c).to_pylist() for c in
                                              ("folder", "file", "offset")]):
                    if file != name:
                        fs, base = shared_fs(folder)
                        name, src = file, fs.open_input_file(f"{base}/{file}")
                    raw = src.read_at(stride, at)
                    out.append(np.frombuffer(raw, dtype).astype(np.int32) if decode else raw)
                tokens = pa.array(out, pa.list_(pa.int32()) if decode else pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, tokens],
                                                 names=[*b.schema.names, "tokens"])

    return rows.mapInArrow(run, schema)
