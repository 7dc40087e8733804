"""WARC archives with a two-level capture index.

Writing: each task writes one WARC/1.0 file (a record per page, payload the html in UTF-8,
each record a gzip member of its own, so that it can be read by its range).
Of the records with equal payloads the one with the largest page_id is the response, the
others are revisits that refer to it.

Index: capture lines (reversed-host URL key, page id, file, offset, length, ...) are sorted by
key over range partitions and packed into compressed blocks of ``BLOCK_LINES`` lines; a sparse
directory keeps one row per block (its first and last key, file, offset, length).

Lookup: keys are sorted into ranges; a task loads only the slice of the directory that its
keys span, binary-searches it, range-reads the block, binary-searches its lines, and
range-reads the record.

Archives, blocks and directory lie in the shared folder.  File names are unique to a task
attempt and count only through tables written by Spark's committer.

Defined cases: null html is an empty payload; a null url has an empty key; a null page_id is
written as ``-`` and sorts first; pages that repeat (same id and payload) are each written,
one of them as the response; no pages: no archive, empty index.  Columns beyond page_id, url
and html are not read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, scratch_path, shared_fs

BLOCK_LINES = 3_000
GZIP_LEVEL = 3
CAPTURE = ("key string, page_id long, file string, offset long, length long")
DIRECTORY = ("first string, last string, file string, offset long, length long, n_lines int")
DATE = "2000-01-01T00:00:00Z"
HIGH = 1 << 63


def url_key(url: str | None) -> str:
    """Reversed-host key, e.g. ``com,example,www)/path?q``; blanks and controls escaped."""
    rest = (url or "").partition("://")[2] or (url or "")
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, path = rest[:end].lower(), rest[end:]
    key = ",".join(reversed(host.split("."))) + ")" + path if url else ""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in key)


def capture_key(url: str | None, page_id: int | None) -> str:
    """Index order: URL key, then page id (null first)."""
    return f"{url_key(url)} {'-' if page_id is None else f'{page_id + HIGH:020d}'}"


def sha1_32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record; the payload of a revisit is left out, its digest and the record that
    it refers to are named."""
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'-' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", "WARC-Target-URI: " + url_line(url),
            f"WARC-Payload-Digest: sha1:{sha1_32(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def url_line(url: str | None) -> str:
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in url or "")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length does not fit")
    return fields, rest[:n]


def _located(pages: DataFrame) -> DataFrame:
    p = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"),
                     F.struct("_metadata.file_path", "_metadata.row_index").alias("at"))
    p.schema  # resolves the hidden column now
    return p


def judged(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to, revisit.  Groups are found on digest and length of light
    rows; a hot group's rows are spread by the join's skew handling."""
    try:
        p = _located(pages)
    except AnalysisException:  # not a file scan: written once, so that rows have a place
        p = _located(cut_lineage(pages.select("page_id", "url", "html")))
    p = p.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    first = p.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(
        F.max(F.struct("page_id", "at")).alias("keep"))
    # Written, so that the join sees two plain exchanges and can split a hot group's rows.
    out = p.join(cut_lineage(first), "digest", "left")
    revisit = F.coalesce(F.col("keep.at") != F.col("at"), F.lit(False))
    return out.select("page_id", "url", "html", F.when(revisit, F.col("keep.page_id")).alias("refers_to"),
                      revisit.alias("revisit"))


def write_archives(pages: DataFrame, out: str, min_bytes: int = 0) -> DataFrame:
    """Writes the archives under ``out``; returns the capture lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = shared_fs(out)
        fs.create_dir(base, recursive=True)
        name, sink, at = f"pages-{uuid.uuid4().hex}.warc.gz", None, 0
        for b in batches:
            rows = {c: [] for c in ("key", "page_id", "file", "offset", "length")}
            for i in range(b.num_rows):
                page, url, html, ref, again = (b.column(c)[i].as_py() for c in range(5))
                raw = record(page, url, html.encode("utf-8", "surrogatepass"), ref, again)
                sink = sink or fs.open_output_stream(f"{base}/{name}", compression=None)
                raw = gzip.compress(raw, GZIP_LEVEL, mtime=0)
                sink.write(raw)
                for c, v in zip(rows, (capture_key(url, page), page, name, at, len(raw))):
                    rows[c].append(v)
                at += len(raw)
            yield pa.RecordBatch.from_pydict(rows, schema=_arrow(CAPTURE))
        if sink:
            sink.close()

    return cut_lineage(judged(pages, min_bytes).mapInArrow(run, CAPTURE))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def write_index(captures: DataFrame, out: str, block_lines: int = BLOCK_LINES) -> str:
    """Writes the compressed blocks under ``out`` and the directory table, whose path it returns."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = shared_fs(out)
        fs.create_dir(base, recursive=True)
        name, sink, at, lines = f"index-{uuid.uuid4().hex}.cdx", None, 0, []

        def pack():
            nonlocal sink, at
            sink = sink or fs.open_output_stream(f"{base}/{name}", compression=None)
            block = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode(
                "utf-8", "surrogatepass"))
            sink.write(block)
            row = (lines[0][0], lines[-1][0], name, at, len(block), len(lines))
            at += len(block)
            return pa.RecordBatch.from_pylist(
                [dict(zip(_arrow(DIRECTORY).names, row))], schema=_arrow(DIRECTORY))

        for b in batches:
            for x in zip(*[c.to_pylist() for c in b.columns]):
                lines.append(x)
                if len(lines) == block_lines:
                    yield pack()
                    lines = []
        if lines:
            yield pack()
        if sink:
            sink.close()

    directory = captures.repartitionByRange(n, "key").sortWithinPartitions("key", "file", "offset")
    path = f"{out}/directory"
    directory.mapInArrow(run, DIRECTORY).write.mode("overwrite").parquet(path)
    return path


def lookup(keys: DataFrame, archive: str, index: str, payload: bool = True) -> DataFrame:
    """``keys`` (column ``key``: full capture keys) -> one row per found record: key, page_id,
    record_type, refers_to, payload_digest (as in the header), n_bytes and sha1 (of the bytes
    that were read) and, if wanted, the payload."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = keys.select("key").distinct().repartitionByRange(n, "key").sortWithinPartitions("key")
    out_schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                            ("n_bytes", pa.int64()), ("sha1", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, index_base = shared_fs(index)
        archives = shared_fs(archive)[1]
        files: dict[str, pa.NativeFile] = {}
        held, lines, names = None, [], []

        def read(path: str, at: int, length: int) -> bytes:
            if path not in files:
                if len(files) >= 64:
                    files.clear()
                files[path] = fs.open_input_file(path)
            return files[path].read_at(length, at)

        for b in batches:
            asked_keys = b.column(0).to_pylist()
            if not asked_keys:
                continue
            span = ds.dataset(f"{index_base}/directory", filesystem=fs, format="parquet").to_table(
                filter=(ds.field("last") >= asked_keys[0]) & (ds.field("first") <= asked_keys[-1]))
            span = sorted(span.to_pylist(), key=lambda r: (r["first"], r["last"], r["offset"]))
            lasts = [r["last"] for r in span]
            out = []
            for k in asked_keys:
                i = bisect.bisect_left(lasts, k)
                while i < len(span) and span[i]["first"] <= k:
                    block = span[i]
                    if block is not held:
                        held = block
                        raw = zlib.decompress(read(f"{index_base}/{block['file']}", block["offset"],
                                                   block["length"])).decode("utf-8", "surrogatepass")
                        lines = [x.split("\t") for x in raw.split("\n")]
                        names = [x[0] for x in lines]
                    for j in range(bisect.bisect_left(names, k), bisect.bisect_right(names, k)):
                        _, page, file, at, length = lines[j]
                        head, body = parse(gzip.decompress(
                            read(f"{archives}/{file}", int(at), int(length))))
                        out.append((k, None if page == "None" else int(page), head["WARC-Type"],
                                    _page(head.get("WARC-Refers-To")),
                                    head["WARC-Payload-Digest"].removeprefix("sha1:"),
                                    len(body), sha1_32(body), body if payload else None))
                        if len(out) >= 200:
                            yield _rows(out, out_schema)
                            out = []
                    i += 1
            if out:
                yield _rows(out, out_schema)

    return asked.mapInArrow(run, "key string, page_id long, record_type string, refers_to long, "
                                 "payload_digest string, n_bytes long, sha1 string, payload binary")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)],
                                      schema=schema)


def _page(ref: str | None) -> int | None:
    page = (ref or "").removeprefix("<urn:page:").removesuffix(">")
    return int(page) if page not in ("", "None") else None


def prefix_range(key: Column, url_prefix: str) -> Column:
    """The captures of a URL prefix as a key range."""
    low = url_key(url_prefix)
    return (key >= low) & (key < low + "\U0010ffff")


def archive_pages(pages: DataFrame, out: str | None = None, min_bytes: int = 0,
                  block_lines: int = BLOCK_LINES) -> tuple[str, str, DataFrame]:
    """Archives and index of ``pages``: (archive folder, index folder, capture lines)."""
    out = out or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{out}/archive", min_bytes)
    write_index(captures, f"{out}/index", block_lines)
    return f"{out}/archive", f"{out}/index", captures


def read_back(captures: DataFrame, archive: str, index: str) -> DataFrame:
    """Every capture through the index: page_id, payload_bytes, payload_digest, record_type,
    refers_to.  Bytes and digest are of the full payload; a revisit gets its response's."""
    got = cut_lineage(lookup(captures, archive, index, payload=False).drop("key", "payload"))
    full = got.where("record_type = 'response'").select(
        F.lit("revisit").alias("as_type"), F.col("payload_digest").alias("of"),
        F.col("page_id").alias("ref"), F.col("n_bytes").alias("full_bytes"), F.col("sha1").alias("full_sha1"))
    out = got.join(full, (F.col("record_type") == F.col("as_type"))
                   & (F.col("payload_digest") == F.col("of"))
                   & F.col("refers_to").eqNullSafe(F.col("ref")), "left")
    return out.select("page_id", F.coalesce("full_bytes", "n_bytes").alias("payload_bytes"),
                      F.coalesce("full_sha1", "sha1").alias("payload_digest"),
                      "record_type", "refers_to")
