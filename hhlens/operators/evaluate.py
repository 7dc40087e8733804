"""Classifier evaluation over a scored DataFrame (label, score, prediction columns).

Confusion counts and the threshold metrics are one aggregate; ROC and AUC pre-aggregate
by distinct score (ties collapse map-side) and take running sums with the bucketed prefix
sums of ``ordered.prefix_counts``, so no step sorts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hhlens.operators.ordered import BUCKET_ROWS, prefix_counts

# Metric names of the comparison tables.
METRICS = ("Accuracy", "Sensitivity", "Specificity", "Precision", "F1")


def _cells(pred: Column, ref: Column, positive) -> dict[str, Column]:
    pp, rp = pred == F.lit(positive), ref == F.lit(positive)
    return {"tp": F.count_if(pp & rp), "fp": F.count_if(pp & ~rp),
            "fn": F.count_if(~pp & rp), "tn": F.count_if(~pp & ~rp)}


def confusion(df: DataFrame, prediction: str, label: str, positive=1,
              groups: Sequence[str] = (), negative=None) -> DataFrame:
    """2 x 2 table as (groups..., prediction, reference, n); cells that never occur are 0.
    ``negative`` names the other label (known for 0/1, required for any other).
    One aggregate of four conditional counts, then unpivot (no join to a domain table)."""
    c = _cells(F.col(prediction), F.col(label), positive)
    if negative is None and positive not in (0, 1):
        raise ValueError("name the negative label")
    neg = 1 - positive if negative is None else negative
    wide = df.groupBy(*groups).agg(*[v.alias(k) for k, v in c.items()])
    stacked = F.explode(F.array(
        F.struct(F.lit(positive).alias("prediction"), F.lit(positive).alias("reference"), F.col("tp").alias("n")),
        F.struct(F.lit(positive).alias("prediction"), F.lit(neg).alias("reference"), F.col("fp").alias("n")),
        F.struct(F.lit(neg).alias("prediction"), F.lit(positive).alias("reference"), F.col("fn").alias("n")),
        F.struct(F.lit(neg).alias("prediction"), F.lit(neg).alias("reference"), F.col("tn").alias("n"))))
    return wide.select(*groups, stacked.alias("cell")).select(*groups, "cell.*")


def metric_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Accuracy, Sensitivity, Specificity, Precision, F1 and Kappa from the four cells; a
    rate whose denominator is 0 is NULL (no predicted positives -> Precision NULL)."""
    d = lambda x: x.cast("double")
    n = d(tp + fp + fn + tn)
    acc = F.try_divide(d(tp + tn), n)
    sens = F.try_divide(d(tp), d(tp + fn))
    spec = F.try_divide(d(tn), d(tn + fp))
    prec = F.try_divide(d(tp), d(tp + fp))
    f1 = F.try_divide(F.lit(2.0) * prec * sens, prec + sens)
    pe = F.try_divide(d(tp + fp) * d(tp + fn) + d(fn + tn) * d(fp + tn), n * n)
    kappa = F.try_divide(acc - pe, F.lit(1.0) - pe)
    return {"Accuracy": acc, "Sensitivity": sens, "Specificity": spec, "Precision": prec,
            "F1": f1, "Kappa": kappa}


def binary_metrics(df: DataFrame, prediction: str, label: str, positive=1,
                   groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., tp, fp, fn, tn, Accuracy, Sensitivity, Specificity, Precision, F1, Kappa)."""
    c = _cells(F.col(prediction), F.col(label), positive)
    wide = df.groupBy(*groups).agg(*[v.alias(k) for k, v in c.items()])
    m = metric_columns(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return wide.select(*groups, "tp", "fp", "fn", "tn", *[v.alias(k) for k, v in m.items()])


def score_counts(df: DataFrame, score: str, label: str, positive=1,
                 groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., score, pos, neg): one row per distinct score."""
    is_pos = F.col(label) == F.lit(positive)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*groups, F.col(score).alias("score"))
            .agg(F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg")))


def roc_curve(df: DataFrame, score: str, label: str, positive=1, groups: Sequence[str] = (),
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One point per distinct score s (descending): predicting positive when score >= s
    gives (fpr, tpr); before them the end point (0, 0) of a threshold that no score reaches
    (score = infinity).  Columns: groups..., score, tp, fp, tpr, fpr, specificity."""
    sc = score_counts(df, score, label, positive, groups)
    pc = prefix_counts(sc, list(groups), "score", ["pos", "neg"], bucket_rows, descending=True)
    keep = [*groups, "total_pos", "total_neg"]
    zero = F.lit(0).cast("bigint")
    ends = pc.select(*keep).distinct().select(*keep, F.lit(float("inf")).alias("score"),
                                              zero.alias("cum_pos"), zero.alias("cum_neg"))
    pc = pc.select(*keep, "score", "cum_pos", "cum_neg").unionByName(ends)
    return pc.select(*groups, "score", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                     F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos")).alias("tpr"),
                     F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg")).alias("fpr"),
                     (F.lit(1.0) - F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg")))
                     .alias("specificity"))


def auc(df: DataFrame, score: str, label: str, positive=1, groups: Sequence[str] = (),
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Area under the ROC curve = P(score_pos > score_neg) + P(tie) / 2 (Mann-Whitney),
    from per-score counts and the number of negatives below each score."""
    sc = score_counts(df, score, label, positive, groups)
    pc = prefix_counts(sc, list(groups), "score", ["neg", "pos"], bucket_rows)
    below = F.col("cum_neg") - F.col("neg")
    contrib = F.col("pos").cast("double") * (below.cast("double") + F.lit(0.5) * F.col("neg"))
    return (pc.groupBy(*groups)
            .agg(F.sum(contrib).alias("_u"), F.first("total_pos").alias("n_pos"),
                 F.first("total_neg").alias("n_neg"))
            .select(*groups, F.try_divide(F.col("_u"), F.col("n_pos").cast("double") * F.col("n_neg"))
                    .alias("auc"), "n_pos", "n_neg"))


def five_stats(df: DataFrame, score: str, prediction: str, label: str, positive=1,
               groups: Sequence[str] = ()) -> DataFrame:
    """The cross-validation summary: ROC (AUC), Sens, Spec, Accuracy, Kappa per group."""
    m = binary_metrics(df, prediction, label, positive, groups)
    a = auc(df, score, label, positive, groups)
    if groups:
        out = m.join(a, on=list(groups), how="left")
    else:   # two one-row aggregates: join on a constant key
        out = m.withColumn("_one", F.lit(1)).join(a.withColumn("_one", F.lit(1)), on="_one")
    return out.select(*groups, F.col("auc").alias("ROC"), F.col("Sensitivity").alias("Sens"),
                      F.col("Specificity").alias("Spec"), "Accuracy", "Kappa")


def comparison_table(metric_frames: dict[str, DataFrame], extra: dict | None = None) -> DataFrame:
    """Long (model, metric, value) table from several ``binary_metrics`` results, plus
    optional literal rows such as an externally reported score."""
    long = None
    for name, m in metric_frames.items():
        part = (m.select(*METRICS).unpivot([], list(METRICS), "metric", "value")
                .select(F.lit(name).alias("model"), "metric", "value"))
        long = part if long is None else long.unionByName(part)
    if extra:
        spark = long.sparkSession
        rows = [(mdl, met, float(v)) for (mdl, met), v in extra.items()]
        long = long.unionByName(spark.createDataFrame(rows, "model string, metric string, value double"))
    return long
