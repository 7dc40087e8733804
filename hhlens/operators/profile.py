"""Column profiling: missing counts, column summaries, IQR outliers, correlations.

Each report is a fixed number of passes over the data however many columns it covers
(one wide aggregate, then ``unpivot`` to a long table), never one job per column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hhlens.functions.recode import is_missing
from hhlens.operators.ordered import column_moments, exact_quantiles, histograms


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """``sapply(df, is.numeric)``: the numeric columns, schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """``grep(pattern, names(df), value = TRUE)``: the columns whose name the regular
    expression finds, schema order."""
    found = re.compile(pattern)
    return [c for c in df.columns if found.search(c)]


def factor_profile(df: DataFrame, cols: Sequence[str], top: int = 4) -> DataFrame:
    """``skim``-like summary of factor and character columns: variable, n_missing,
    complete_rate, n_unique and the ``top`` most frequent levels with their counts (ties by
    level).  The columns are counted per level in one pass; only levels are ranked."""
    from hhlens.session import cut_lineage

    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "variable", "level")
    lv = cut_lineage(long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n")))
    known = lv.where(F.col("level").isNotNull())
    w = Window.partitionBy("variable").orderBy(F.desc("n"), "level")
    best = (known.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
            .groupBy("variable").agg(F.array_sort(F.collect_list(F.struct("_r", "level", "n"))).alias("_t"))
            .select("variable", F.array_join(F.transform("_t", lambda x: F.concat(
                x["level"], F.lit(": "), x["n"].cast("string"))), ", ").alias("top_counts")))
    sums = lv.groupBy("variable").agg(
        F.sum(F.when(F.col("level").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum("n").alias("_n"), F.count("level").alias("n_unique"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return (names.join(sums, "variable", "left").join(best, "variable", "left").select(
        "variable", F.coalesce("n_missing", F.lit(0)).cast("bigint").alias("n_missing"),
        (F.lit(1.0) - F.try_divide(F.col("n_missing").cast("double"), F.col("_n"))).alias("complete_rate"),
        F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"), "top_counts"))


def _long(wide: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    return wide.unpivot([], list(cols), name, value)


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """``colSums(is.na(df))`` as (variable, n), one aggregate; ``only_positive`` keeps the
    columns with at least one missing value, largest first."""
    wide = df.agg(*[F.count_if(is_missing(f.name, f.dataType)).alias(f.name)
                    for f in df.schema.fields])
    out = _long(wide, df.columns, "variable", "n")
    if only_positive:
        out = out.where(F.col("n") > 0)
    return out.orderBy(F.desc("n"), "variable")


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """(variable, q1, q3, lower, upper) with exact type-7 quartiles."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    piv = q.groupBy("variable").agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                                  F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return piv.select("variable", "q1", "q3", (F.col("q1") - F.lit(k) * iqr).alias("lower"),
                      (F.col("q3") + F.lit(k) * iqr).alias("upper"))


def iqr_outliers(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """Per numeric column, rows below Q1 - k*IQR or above Q3 + k*IQR (NULL skipped),
    sorted by count descending.  Pass 1 computes all quartiles; the bounds (two numbers
    per column) are collected and pass 2 counts every column in one aggregate."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    b = {r["variable"]: (r["lower"], r["upper"]) for r in iqr_bounds(df, cols, k).collect()}
    counts = []
    for c in cols:
        lo, hi = b.get(c, (None, None))
        x = F.col(c).cast("double")
        if lo is None:
            counts.append(F.lit(0).cast("bigint").alias(c))
        else:
            counts.append(F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(c))
    wide = df.agg(*counts)
    return _long(wide, cols, "variable", "n_outliers").orderBy(F.desc("n_outliers"), "variable")


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 5) -> DataFrame:
    """``skim``-like summary per numeric column: missing count, complete rate, mean, sd,
    p0/p25/p50/p75/p100 and a ``bins``-bin fixed-width histogram between min and max.

    A few wide passes (rows; moments; the two of the exact quartiles; bins between the
    ranges), none of which moves a value."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    n = df.count()
    m = column_moments(df, cols)
    q = {(r["variable"], r["p"]): r["q"] for r in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).collect()}
    h = histograms(df, {c: m[c][3:] for c in cols if c in m}, bins) if m else {}
    rows = []
    for c in cols:
        nn, mean, m2, lo, hi = m.get(c, (0, None, None, None, None))
        rows.append((c, n - nn, nn / n if n else None, mean, math.sqrt(m2 / (nn - 1)) if nn > 1 else None, lo, hi,
                     *[h.get((c, k), 0) for k in range(bins)], *[q.get((c, p)) for p in (0.25, 0.5, 0.75)]))
    return df.sparkSession.createDataFrame(
        rows, "variable string, n_missing bigint, complete_rate double, mean double, sd double, p0 double, p100 double, "
        + "".join(f"h{k} bigint, " for k in range(bins)) + "p25 double, p50 double, p75 double")


def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlations on complete cases (``use = "complete.obs"``), upper triangle
    without the diagonal, as (var1, var2, r).  Spark ML ``Correlation.corr`` runs one
    tree-aggregate of the p x p moment matrix; a constant column gives NULL, not NaN."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    cols = list(cols) if cols is not None else numeric_columns(df)
    cc = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna(how="any")
    vec = VectorAssembler(inputCols=cols, outputCol="__v").transform(cc).select("__v")
    mat = Correlation.corr(vec, "__v", "pearson").first()[0].toArray()
    rows = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            r = float(mat[i, j])
            rows.append((cols[i], cols[j], None if r != r else r))
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, r double")
