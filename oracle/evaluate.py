"""Oracle SQL for scoring, thresholds, confusion, metrics, ROC, AUC, splits and folds."""

from hhlens.operators.models import linear_score_sql
from hhlens.plans.registry import SCORER_A, SCORER_B
from hhlens.sources.fixtures import cte
from oracle.households import full_cte


def _hash(seed) -> str:
    return f"('0x' || substr(md5(concat(CAST(id AS VARCHAR), '|', '{seed}')), 1, 8))::BIGINT"


def scored_cte(scorer=SCORER_A, name="scored") -> str:
    s = linear_score_sql(*scorer)
    return (f",\n{name} AS (SELECT id, Pobre, {s} AS score, CASE WHEN {s} > 0.5 THEN 1 ELSE 0 END AS pred "
            "FROM hogares_full)")


def _metrics(src: str) -> str:
    return f"""SELECT tp, fp, fn, tn,
  round((tp + tn) / nullif(CAST(n AS DOUBLE), 0), 6) AS Accuracy,
  round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS Sensitivity,
  round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS Specificity,
  round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 6) AS Precision,
  round(2.0 * (tp / nullif(CAST(tp + fp AS DOUBLE), 0)) * (tp / nullif(CAST(tp + fn AS DOUBLE), 0)) /
        nullif((tp / nullif(CAST(tp + fp AS DOUBLE), 0)) + (tp / nullif(CAST(tp + fn AS DOUBLE), 0)), 0), 6) AS F1,
  round(((tp + tn) / CAST(n AS DOUBLE) - pe) / nullif(1.0 - pe, 0), 6) AS Kappa
FROM (SELECT *, tp + fp + fn + tn AS n,
        ((tp + fp) * CAST(tp + fn AS DOUBLE) + (fn + tn) * CAST(fp + tn AS DOUBLE)) /
        (CAST(tp + fp + fn + tn AS DOUBLE) * (tp + fp + fn + tn)) AS pe
      FROM (SELECT count(*) FILTER (WHERE pred = 1 AND Pobre = 1) AS tp,
                   count(*) FILTER (WHERE pred = 1 AND Pobre <> 1) AS fp,
                   count(*) FILTER (WHERE pred <> 1 AND Pobre = 1) AS fn,
                   count(*) FILTER (WHERE pred <> 1 AND Pobre <> 1) AS tn FROM {src}) c) m"""


LINEAR_SCORE = full_cte("train") + scored_cte() + "\nSELECT id, Pobre, round(score, 6) AS score FROM scored"
THRESHOLD_PREDICTIONS = full_cte("train") + scored_cte() + \
    "\nSELECT id, Pobre, round(score, 6) AS score, pred FROM scored"
CONFUSION = full_cte("train") + scored_cte() + """
SELECT p.prediction, r.reference, count(s.id) AS n
FROM (VALUES (0), (1)) p(prediction) JOIN (VALUES (0), (1)) r(reference) ON true
LEFT JOIN scored s ON s.pred = p.prediction AND s.Pobre = r.reference
GROUP BY p.prediction, r.reference"""
BINARY_METRICS = full_cte("train") + scored_cte() + "\n" + _metrics("scored")
ROC_CURVE = full_cte("train") + scored_cte() + """,
c AS (SELECT score, count(*) FILTER (WHERE Pobre = 1) AS pos, count(*) FILTER (WHERE Pobre <> 1) AS neg
      FROM scored GROUP BY score),
r AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c
      UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, sum(pos), sum(neg) FROM c)
SELECT round(score, 6) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / CAST(P AS DOUBLE), 6) AS tpr, round(fp / CAST(N AS DOUBLE), 6) AS fpr,
       round(1.0 - fp / CAST(N AS DOUBLE), 6) AS specificity FROM r"""
AUC = full_cte("train") + scored_cte() + """,
pn AS (SELECT a.score AS sa, b.score AS sb FROM scored a JOIN scored b ON a.Pobre = 1 AND b.Pobre <> 1)
SELECT round(avg(CASE WHEN sa > sb THEN 1.0 WHEN sa = sb THEN 0.5 ELSE 0.0 END), 6) AS auc,
       (SELECT count(*) FROM scored WHERE Pobre = 1) AS n_pos,
       (SELECT count(*) FROM scored WHERE Pobre <> 1) AS n_neg FROM pn"""


def _rank_cte(src: str, seed, strat: bool = True) -> str:
    part = "PARTITION BY Pobre " if strat else ""
    return (f"SELECT *, row_number() OVER ({part}ORDER BY h, id) AS rk, count(*) OVER ({part.strip()}) AS n_part "
            f"FROM (SELECT *, {_hash(seed)} AS h FROM {src}) t")


STRATIFIED_SPLIT = cte("hogares_train") + f"""
SELECT id, Pobre, CAST(rk <= ceil(0.7 * n_part) AS INT) AS is_train
FROM ({_rank_cte('hogares_train', 123)}) x"""
RANDOM_SPLIT = cte("hogares_train") + f"""
SELECT id, Pobre, CAST(rk <= ceil(0.7 * n_part) AS INT) AS is_train
FROM ({_rank_cte('hogares_train', 123, strat=False)}) x"""
KFOLD = cte("hogares_train") + f"""
SELECT id, Pobre, CAST((rk - 1) % 10 AS INT) AS fold FROM ({_rank_cte('hogares_train', 123)}) x"""
CLASS_WEIGHTS = cte("hogares_train") + """
SELECT id, Pobre, round(1.0 / count(*) OVER (PARTITION BY Pobre), 6) AS w_inverse,
       CASE WHEN Pobre = 1 THEN 0.79 WHEN Pobre = 0 THEN 0.21 END::DOUBLE AS w_fixed
FROM hogares_train"""

METRICS_BY_FOLD = full_cte("train") + scored_cte() + f""",
folded AS (SELECT id, Pobre, score, pred, CAST((rk - 1) % 5 AS INT) AS fold FROM ({_rank_cte('scored', 123)}) x),
cells AS (SELECT fold, count(*) FILTER (WHERE pred = 1 AND Pobre = 1) AS tp,
                 count(*) FILTER (WHERE pred = 1 AND Pobre <> 1) AS fp,
                 count(*) FILTER (WHERE pred <> 1 AND Pobre = 1) AS fn,
                 count(*) FILTER (WHERE pred <> 1 AND Pobre <> 1) AS tn FROM folded GROUP BY fold),
aucs AS (SELECT a.fold, avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS auc
         FROM folded a JOIN folded b ON a.fold = b.fold AND a.Pobre = 1 AND b.Pobre <> 1 GROUP BY a.fold)
SELECT c.fold, round(aucs.auc, 6) AS ROC, round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 6) AS Sens,
       round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 6) AS Spec,
       round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS Accuracy,
       round(((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) -
              ((tp + fp) * CAST(tp + fn AS DOUBLE) + (fn + tn) * CAST(fp + tn AS DOUBLE)) /
              (CAST(tp + fp + fn + tn AS DOUBLE) * (tp + fp + fn + tn))) /
             nullif(1.0 - ((tp + fp) * CAST(tp + fn AS DOUBLE) + (fn + tn) * CAST(fp + tn AS DOUBLE)) /
              (CAST(tp + fp + fn + tn AS DOUBLE) * (tp + fp + fn + tn)), 0), 6) AS Kappa
FROM cells c JOIN aucs USING (fold)"""


def _metric_long(model: str, src: str) -> str:
    m = _metrics(src)
    return (f"SELECT '{model}' AS model, metric, value FROM ({m}) UNPIVOT INCLUDE NULLS (value FOR metric IN "
            "(Accuracy, Sensitivity, Specificity, Precision, F1))")


MODEL_COMPARISON = (full_cte("train") + scored_cte(SCORER_A, "scored_a") + scored_cte(SCORER_B, "scored_b") +
                    "\nSELECT * FROM (" + _metric_long("scorer_a", "scored_a") + "\nUNION ALL " +
                    _metric_long("scorer_b", "scored_b") +
                    "\nUNION ALL SELECT 'reported', 'Kaggle', 0.6703::DOUBLE) t")
