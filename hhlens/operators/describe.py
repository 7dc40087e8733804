"""Descriptive tables behind the survey's charts (class shares, fill bars, ordered group
shares, kernel densities).  Every table is a fixed number of aggregations; nothing is
collected except scalar statistics (bandwidth, range)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hhlens.functions.recode import decode  # noqa: F401  (re-exported)
from hhlens.operators.ordered import BROADCAST_ROWS, exact_quantiles, null_safe, prefix_counts
from hhlens.session import cut_lineage

# Groups that one window may rank.
RANK_GROUPS = 100_000


def class_share(df: DataFrame, label: str, labels: Mapping | None = None) -> DataFrame:
    """Count and percentage of each class (``mean(y == k) * 100``); NULL labels are an
    error, as ``mean`` without ``na.rm`` would give NA."""
    tot = F.sum("n").over(Window.partitionBy())
    known = F.when(F.col(label).isNotNull(), F.col(label)).otherwise(
        F.raise_error(F.lit(f"{label} has missing values")))
    out = (df.groupBy(known.alias(label)).agg(F.count(F.lit(1)).alias("n"))
           .withColumn("pct", F.col("n") * F.lit(100.0) / tot))
    if labels:
        out = out.withColumn("class_label", decode(label, labels))
    return out


def share_within(counts: DataFrame, within: Sequence[str], n_col: str = "n",
                 out: str = "share", scale: float = 1.0) -> DataFrame:
    """``mutate(Prop = n / sum(n))`` inside each ``within`` group (a window over the
    already-aggregated counts, so its partitions hold one group's few rows)."""
    w = Window.partitionBy(*within)
    return counts.withColumn(out, F.col(n_col) * F.lit(float(scale)) / F.sum(n_col).over(w))


def fill_shares(df: DataFrame, x: str, fill: str, x_range: tuple | None = None) -> DataFrame:
    """Table behind ``geom_bar(position = "fill")``: for every ``x`` value the share of each
    ``fill`` value.  ``x_range`` drops x outside ``[lo, hi]`` first (axis limits remove them)."""
    src = df
    if x_range is not None:
        src = src.where(F.col(x).between(x_range[0], x_range[1]))
    counts = src.groupBy(x, fill).agg(F.count(F.lit(1)).alias("n"))
    return share_within(counts, [x])


def ordered_group_shares(df: DataFrame, group: str, label: str, positive=1,
                         lookup: DataFrame | None = None, lookup_key: str | None = None,
                         name_col: str = "name", lookup_max_rows: int = 100_000) -> DataFrame:
    """Counts and percentage of each label within each group, the group name from a
    lookup, and the group's rank by the percentage of ``positive`` (descending, ties by
    group key).  Groups without a positive row get a NULL rank (sorted last).

    The counts are written once, so the rows are read once.  Up to ``RANK_GROUPS`` groups are
    ranked by one window; more are ranked in range buckets.  A NULL group is a group of its
    own.  The lookup is a dimension table; it is broadcast only after its size is checked."""
    counts = cut_lineage(df.groupBy(group, label).agg(F.count(F.lit(1)).alias("Conteo")))
    shares = share_within(counts, [group], "Conteo", "Prop", 100.0)
    pos = shares.where(F.col(label) == F.lit(positive))
    if counts.where(F.col(label) == F.lit(positive)).count() <= RANK_GROUPS:
        pos = pos.select(group, F.row_number().over(Window.orderBy(F.desc("Prop"), F.asc(group))).alias("ord"))
    else:
        place = F.struct((-F.col("Prop")).alias("share"), F.col(group).alias("key"))
        pos = prefix_counts(pos.select(place.alias("value"), F.lit(1).alias("cnt")), []).select(
            F.col("value.key").alias(group), F.col("cum").cast("int").alias("ord"))
    out = null_safe(shares, pos, [group], "left")
    if lookup is not None:
        key = lookup_key or group
        dim = lookup.select(F.col(key).alias(group), F.col(name_col))
        n_dim = dim.count()
        if n_dim <= lookup_max_rows:
            dim = F.broadcast(dim)
        out = out.join(dim, on=group, how="left")
    label_txt = F.regexp_replace(F.round("Prop", 1).cast("string"), r"\.0$", "")
    return out.withColumn("Prop_label", F.concat(label_txt, F.lit("%")))



def _bw_nrd0(sd: Column, q1: Column, q3: Column, n: Column) -> Column:
    """Silverman's rule of thumb 0.9 * min(sd, IQR/1.34) * n^(-1/5), falling back to sd and
    then 1 when the spread is 0."""
    lo = F.least(sd, (q3 - q1) / F.lit(1.34))
    lo = F.when(lo > 0, lo).when(sd > 0, sd).otherwise(F.lit(1.0))
    return F.lit(0.9) * lo * F.pow(n.cast("double"), F.lit(-0.2))


def kde(df: DataFrame, x: str, groups: Sequence[str] = (), n_grid: int = 512,
        log10: bool = False) -> DataFrame:
    """Gaussian kernel density (``geom_density``) evaluated at ``n_grid`` points spanning
    the range of ``x`` over all groups; one curve per group with its own bandwidth.

    Rows are reduced to ``n_grid`` linearly binned masses per group over
    [min - 4 bw, max + 4 bw] (a partitioned aggregation), and each grid value sums the
    kernel over those masses (``n_grid`` x ``n_grid`` terms per group, independent of the
    row count).  With ``log10`` the density is of log10(x), positive x only.  A NULL group is
    a group of its own.  The groups' bandwidths are written and counted first; they are
    broadcast up to ``BROADCAST_ROWS`` groups and joined by a shuffle beyond."""
    groups = list(groups)
    src = df.select(*groups, F.col(x).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if log10:
        src = src.where(F.col("_x") > 0).withColumn("_x", F.log10("_x"))
    q = exact_quantiles(src, ["_x"], [0.25, 0.75], groups)
    qw = q.groupBy(*groups).agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("_q1"),
                                F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("_q3"))
    mom = src.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"))
    rng = src.agg(F.min("_x").alias("_from"), F.max("_x").alias("_to")).first()
    lo_all, hi_all = rng["_from"], rng["_to"]
    stats = (null_safe(mom, qw, groups) if groups else
             mom.withColumn("_k", F.lit(1)).join(qw.withColumn("_k", F.lit(1)), "_k").drop("_k"))
    stats = (stats.withColumn("_bw", _bw_nrd0(F.col("_sd"), F.col("_q1"), F.col("_q3"), F.col("_n")))
             .withColumn("_lo", F.lit(lo_all) - F.lit(4.0) * F.col("_bw"))
             .withColumn("_delta", ((F.lit(hi_all) + F.lit(4.0) * F.col("_bw")) - F.col("_lo"))
                         / F.lit(float(n_grid - 1))))
    st = cut_lineage(stats.select(*groups, "_n", "_bw", "_lo", "_delta"))   # one row per group
    if st.count() <= BROADCAST_ROWS:
        st = F.broadcast(st)
    pos = (F.col("_x") - F.col("_lo")) / F.col("_delta")
    if groups:
        binned = null_safe(src, st, groups)
    else:
        binned = src.withColumn("_k", F.lit(1)).join(st.withColumn("_k", F.lit(1)), "_k").drop("_k")
    binned = (binned.withColumn("_ix", F.floor(pos).cast("int"))
              .withColumn("_fx", pos - F.floor(pos))
              .select(*groups, "_n", "_bw", "_lo", "_delta",
                      F.explode(F.array(
                          F.struct(F.col("_ix").alias("j"), (F.lit(1.0) - F.col("_fx")).alias("w")),
                          F.struct((F.col("_ix") + 1).alias("j"), F.col("_fx").alias("w")))).alias("m"))
              .groupBy(*groups, "_n", "_bw", "_lo", "_delta", F.col("m.j").alias("j"))
              .agg(F.sum("m.w").alias("_mass")))
    step = (hi_all - lo_all) / (n_grid - 1) if n_grid > 1 else 0.0
    grid_x = F.lit(lo_all) + F.col("i").cast("double") * F.lit(step)
    centre = F.col("_lo") + F.col("j").cast("double") * F.col("_delta")
    u = (grid_x - centre) / F.col("_bw")
    term = (F.col("_mass") / F.col("_n").cast("double")) * F.exp(F.lit(-0.5) * u * u) / \
        (F.col("_bw") * F.lit(2.5066282746310002))
    return (binned.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))).alias("i"))
            .groupBy(*groups, "i").agg(F.sum(term).alias("density"))
            .select(*groups, "i", grid_x.alias("x"), "density"))
