"""Mixing sources to target weights.

Sizes (words) are aggregated per source, each source gets a target by water-filling, its
repetition rate is target / size, and each document is emitted floor(rate) times plus one
hash-seeded Bernoulli copy with probability equal to the fraction.

Only three sums per round reach the driver, however many sources there are.  Nulls: a null
text has size 0, a null source is a source of its own (last in the order), a null doc_id is
hashed as ``null``.  Repeated rows draw alike.  A source of size 0 has rate 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, global_rank

WORD = r"[^\x20\x09-\x0D]+"
CYCLE = (5.0, 2.0, 1.0)
CAP = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(key: Column, seed: str = SEED) -> Column:
    """A portable number in [0, 1) from md5(seed:key)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(2.0 ** 52)


def source_targets(sizes: DataFrame, weights: Sequence[float] = CYCLE, cap: int = CAP,
                   total: float | None = None) -> DataFrame:
    """(source, source_size) -> plus weight and target.

    Targets share ``total`` (default: all sizes) by weight, none above ``cap`` times its
    source; the excess is shared again by weight until none is above."""
    ranked = global_rank(sizes, "source", "_rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("weight", w).drop("_rank"))
    if total is None:
        total = ranked.agg(F.sum("source_size")).first()[0] or 0
    top = F.col("source_size") * cap
    level, n_capped = 0.0, -1
    while True:
        capped = top <= F.col("weight") * level if n_capped >= 0 else F.lit(False)
        held, free, n = ranked.agg(F.sum(F.when(capped, top)), F.sum(F.when(~capped, F.col("weight"))),
                                   F.count(F.when(capped, 1))).first()
        if n == n_capped or not free:
            break
        n_capped, level = n, (total - (held or 0)) / free
    return ranked.withColumn("target", F.when(top <= F.col("weight") * level, top.cast("double"))
                             .otherwise(F.col("weight") * level))


def mix_plan(docs: DataFrame, weights: Sequence[float] = CYCLE, cap: int = CAP,
             total: float | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and n_copies (names must be free in docs)."""
    sized = docs.withColumn("size", n_words(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(sizes, weights, cap, total).select(
        F.col("source").alias("_src"), "source_size", "target")
    out = sized.join(t, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    draw = unit(F.col("doc_id"), seed) < rate - F.floor(rate)
    return out.withColumn("n_copies", F.floor(rate) + draw.cast("long"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: every document as often as the plan takes it, columns as given."""
    own = ["size", "source_size", "target", "n_copies", "_src"]
    clash = {c: fresh(f"_keep_{i}", docs.columns) for i, c in enumerate(docs.columns)
             if c.lower() in own}
    plan = mix_plan(docs.withColumnsRenamed(clash), **kw).where("n_copies > 0")
    copies = plan.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    back = {v: k for k, v in clash.items()}
    return copies.select(*[F.col(clash.get(c, c)).alias(back.get(c, c)) for c in docs.columns])
