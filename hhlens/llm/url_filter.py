"""URL filter: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A list entry is a canonical (host, path) with a verdict; it fits its host, all subdomains,
and every path that starts with its path.  Each distinct (host, path) of the pages expands
to its probes (host suffixes x path prefixes of the lengths that occur in the list).  Probes
that pass the filter go to an exact join with the list, which removes false positives; the
longest fitting entry wins (ties: more specific host, then path, then ``allow``).

The filter is a table (block, eight 64-bit words): one block per ``KEYS_PER_BLOCK`` keys, each
key sets one bit in every word of its one block.  It is joined to the probes by block, so it
may grow with the list; Spark broadcasts it only when its measured size allows.

Defined cases: a null url, or one without ``://``, has empty host and path and fits nothing;
pages that no entry fits get ``default``; an empty list gives ``default`` everywhere; repeated
entries count once, and of entries with both verdicts ``allow`` wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, fresh

KEYS_PER_BLOCK = 24
WORDS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_list(spark: SparkSession, entries: Iterable[tuple[str, str]]) -> DataFrame:
    """[(rule like 'host/path', verdict)] -> host, path, rule, verdict."""
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2] if "/" in r else "", r, v)
            for r, v in entries]
    return spark.createDataFrame(rows, "host string, path string, rule string, verdict string")


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, path)


def _blocks(n_keys: int) -> int:
    return max(1, -(-n_keys // KEYS_PER_BLOCK))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"),
                           F.pmod(F.xxhash64(key, F.lit(word)), F.lit(64)).cast("int"))


def bloom(listed: DataFrame, n_keys: int) -> DataFrame:
    """(block, w0..w7) of the listed keys."""
    key, blocks = F.col("key"), _blocks(n_keys)
    return listed.groupBy(_block(key, blocks).alias("block")).agg(
        *[F.bit_or(_bit(key, i)).alias(f"w{i}") for i in range(WORDS)])


def probes(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct (host, path) -> plus one row per probe key with its host and path."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    u = urls.where(F.col("host") != "").withColumn("probe_host", F.explode(suffixes))
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    u = u.withColumn("cut", F.explode(cuts))
    return (u.withColumn("probe_path", F.expr("substring(path, 1, cut)")).drop("cut")
            .withColumn("key", _key(F.col("probe_host"), F.col("probe_path"))))


def verdicts(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """Distinct (host, path) that some entry fits -> host, path, rule, verdict."""
    listed = listed.groupBy("host", "path").agg(
        F.min(F.struct("verdict", "rule")).alias("v")).select(
        F.col("host").alias("probe_host"), F.col("path").alias("probe_path"), "v.*",
        _key(F.col("host"), F.col("path")).alias("key"))
    # Path prefixes are only cut at lengths that occur in the list (bounded by the longest url).
    n_keys, lengths = listed.agg(F.count("*"), F.collect_set(F.length("probe_path"))).first()
    if not n_keys:
        return urls.limit(0).withColumns({"rule": F.lit(""), "verdict": F.lit("")})
    p = probes(urls, sorted(lengths))
    filt = bloom(listed, n_keys)
    p = p.withColumn("block", _block(F.col("key"), _blocks(n_keys)))
    passed = F.lit(True)
    for i in range(WORDS):
        passed = passed & (F.col(f"w{i}").bitwiseAND(_bit(F.col("key"), i)) != 0)
    maybe = p.join(filt, "block").where(passed).select("host", "path", "probe_host", "probe_path")
    hits = maybe.join(listed.drop("key"), ["probe_host", "probe_path"])
    best = F.struct(F.length("probe_host") + F.length("probe_path"), F.length("probe_host"),
                    "rule", "verdict")
    return hits.groupBy("host", "path").agg(F.max(best).alias("b")).select(
        "host", "path", "b.rule", "b.verdict")


def filter_urls(pages: DataFrame, listed: DataFrame, url: str = "url",
                default: str = "allow") -> DataFrame:
    """``pages`` (all columns) plus host, path, rule and verdict; clashing names of the input
    are replaced by these."""
    keep = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")
            or c == url]
    names = {c: fresh(f"_in{i}", pages.columns) for i, c in enumerate(keep)}
    p = pages.select(*[F.col(f"`{c}`").alias(names[c]) for c in keep],
                     host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    v = verdicts(p.select("host", "path").distinct(), listed)
    # Written, so that the join sees two plain exchanges and can split a hot url's rows.
    # The hits grow with the pages, so they are never broadcast.
    out = p.join(cut_lineage(v).hint("merge"), ["host", "path"], "left")
    return out.select(*[F.col(names[c]).alias(c) for c in keep if c.lower() not in
                        ("host", "path", "rule", "verdict")],
                      "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
