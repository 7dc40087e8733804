"""Oracle SQL for model-side queries that SQL can express (gradients, lambda_max, scaling,
grids, names) and the expected term lists of the KKT checks."""

from hhlens.plans import specs
from hhlens.plans.registry import SCORER_A
from hhlens.operators.models import linear_score_sql
from oracle.households import full_cte

X = specs.LINEAR_PREDICTORS


ALL = sorted({*specs.LINEAR_PREDICTORS, *specs.FOREST_TRIAL_PREDICTORS, *specs.FOREST_FINAL_PREDICTORS})


def _input() -> str:
    """The whole household table with the medians of its predictors in place of NULLs."""
    med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in ALL)
    rep = ", ".join(f"coalesce(CAST(h.{c} AS DOUBLE), med.{c}, 0.0) AS {c}" for c in ALL)
    return (full_cte("train") + f",\nmed AS (SELECT {med} FROM hogares_full)"
            f",\nmi AS (SELECT h.* REPLACE ({rep}) FROM hogares_full h, med)")


def kkt_terms() -> str:
    vals = ", ".join(f"('{t}')" for t in ["(Intercept)"] + X)
    return _input() + f"\nSELECT term, true AS ok, (SELECT count(*) FROM mi) AS n_rows FROM (VALUES {vals}) v(term)"


def _folds(k: int) -> str:
    return (_input() + f",\nhashed AS (SELECT *, ('0x' || substr(md5(concat(CAST(id AS VARCHAR), '|', "
            f"'{specs.SEED}')), 1, 8))::BIGINT AS h FROM mi),\nfolded AS (SELECT *, CAST((row_number() OVER "
            f"(PARTITION BY Pobre ORDER BY h, id) - 1) % {k} AS INT) AS fold FROM hashed),\nfs AS (SELECT DISTINCT fold FROM folded)")


def _fold_gmax() -> str:
    """Per fold the largest null gradient of the rows outside it."""
    g = ", ".join(f"coalesce(abs(covar_pop(r.{c}, CAST(r.Pobre AS DOUBLE))) / nullif(stddev_samp(r.{c}), 0), 0)"
                  for c in X)
    return (_folds(specs.LINEAR_FOLDS) + f",\ngm AS (SELECT fs.fold, greatest({g}) AS gmax FROM fs JOIN folded r "
            "ON r.fold <> fs.fold GROUP BY fs.fold)")


_GRIDS = {
    "ridge": "SELECT 0.0::DOUBLE AS alpha, 10.0 ** (-4 + 8 * range / 99.0) AS reg FROM range(100)",
    "lasso": "SELECT 1.0::DOUBLE AS alpha, range / 100.0 AS reg FROM range(1001)",
    "elastic_net": "SELECT a.range / 10.0 AS alpha, l.range / 10.0 AS reg FROM range(11) a, range(101) l",
}


def tuning(name: str) -> str:
    return (_fold_gmax() + f",\ngrid AS ({_GRIDS[name]})\nSELECT round(alpha, 6) AS alpha, round(reg, 6) AS reg, "
            "count(*) AS n_folds, count(*) FILTER (WHERE alpha > 0 AND reg > 0 AND reg >= gmax / alpha) AS n_null, "
            "true AS ok FROM grid, gm GROUP BY ALL")


def best_candidate() -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS model, count(*) AS n_candidates, true AS ok FROM ({q})"
                              for n, q in _GRIDS.items())
    return f"SELECT * FROM ({rows})"


def oof_metrics() -> str:
    return (_fold_gmax() + f",\ngrid AS ({_GRIDS['lasso']}),\nm AS (SELECT fold, count(*) FILTER (WHERE reg = 0 OR reg < gmax) "
            "+ CAST(max(CASE WHEN reg > 0 AND reg >= gmax THEN 1 ELSE 0 END) AS BIGINT) AS n_models FROM grid, gm GROUP BY fold)\n"
            "SELECT f.fold, count(*) AS n_rows, any_value(m.n_models) AS n_models, true AS ok "
            "FROM folded f JOIN m ON m.fold = f.fold GROUP BY f.fold")


def fitted_models() -> str:
    return (_input() + "\nSELECT model, (SELECT count(*) FROM mi) AS n_rows, (SELECT count(*) FROM mi WHERE Pobre = 1) AS n_pos, "
            "true AS ok FROM (VALUES ('logit'), ('ridge'), ('lasso'), ('elastic_net')) v(model)")


def _split() -> str:
    return (_folds(1) + f",\nsplit AS (SELECT *, row_number() OVER (PARTITION BY Pobre ORDER BY h, id) <= "
            f"ceil({specs.TRAIN_SHARE} * count(*) OVER (PARTITION BY Pobre)) AS train FROM hashed)")


def forest_importance() -> str:
    vals = ", ".join(f"('{c}')" for c in specs.FOREST_TRIAL_PREDICTORS)
    return f"SELECT variable, true AS ok FROM (VALUES {vals}) v(variable)"


def forest_holdout_metrics() -> str:
    return _split() + ("\nSELECT count(*) AS n_rows, count(*) FILTER (WHERE Pobre = 1) AS n_pos, true AS ok "
                       "FROM split WHERE NOT train")


def forest_top_predictors() -> str:
    return "SELECT range AS rank, true AS ok FROM range(1, 21)"


def forest_predictions() -> str:
    return full_cte("test") + "\nSELECT id, true AS ok FROM hogares_full"


def forest_trial_tuning() -> str:
    k = specs.FOREST_FOLDS
    return _split() + (f""",
tf AS (SELECT Pobre, (row_number() OVER (PARTITION BY Pobre ORDER BY h, id) - 1) % {k} AS f FROM split WHERE train),
seen AS (SELECT sum(2 * greatest(pos, neg))::BIGINT AS n FROM (
  SELECT r.range AS fold, count(*) FILTER (WHERE Pobre = 1) AS pos, count(*) FILTER (WHERE Pobre <> 1) AS neg
  FROM range({k}) r JOIN tf ON tf.f <> r.range GROUP BY r.range))
SELECT mtry, node AS min_node_size, (SELECT count(*) FROM split WHERE train) AS n_rows,
       CAST({k} AS BIGINT) AS n_folds, (SELECT n FROM seen) AS n_train, true AS ok
FROM (VALUES {', '.join(f'({m})' for m in specs.FOREST_TRIAL_GRID['mtry'])}) a(mtry),
     (VALUES {', '.join(f'({m})' for m in specs.FOREST_TRIAL_GRID['min_node_size'])}) b(node)""")


def null_gradients() -> str:
    parts = [f"SELECT '{c}' AS term, round(abs(covar_pop(CAST({c} AS DOUBLE), CAST(Pobre AS DOUBLE))) / "
             f"nullif(stddev_samp(CAST({c} AS DOUBLE)), 0), 6) AS gradient FROM mi" for c in X]
    return _input() + "\nSELECT * FROM (" + "\nUNION ALL ".join(parts) + ") t"


def _gmax() -> str:
    parts = [f"abs(covar_pop(CAST({c} AS DOUBLE), CAST(Pobre AS DOUBLE))) / nullif(stddev_samp(CAST({c} AS DOUBLE)), 0)"
             for c in X]
    return f"(SELECT greatest({', '.join(parts)}) FROM mi)"


ALPHAS = ", ".join(f"({a})" for a in specs.ENET_ALPHAS if a > 0)


def lambda_max() -> str:
    return (_input() + f",\ng AS (SELECT {_gmax()} AS gmax)\n"
            f"SELECT CAST(a AS DOUBLE) AS alpha, round(gmax / a, 6) AS lambda_max FROM g, (VALUES {ALPHAS}) v(a)")


def pruned_grid() -> str:
    return (_input() + f",\ng AS (SELECT {_gmax()} AS gmax)\n"
            "SELECT round(a.i / 10.0, 6) AS alpha, round(l.j / 10.0, 6) AS reg, "
            "coalesce(l.j / 10.0 >= gmax / (a.i / 10.0), false) AS null_model "
            "FROM g, (SELECT range AS i FROM range(11)) a, (SELECT range AS j FROM range(101)) l")


def output_name() -> str:
    def fmt(x):
        short = f"regexp_replace(regexp_replace(printf('%.4f', {x}), '0+$', ''), '\\.$', '')"
        return f"replace(regexp_replace({short}, '^(-?)0\\.000([1-9])$', '\\1\\2e-04'), '.', '_')"
    return (_input() + f",\ng AS (SELECT {_gmax()} AS gmax)\n"
            f"SELECT CAST(a AS DOUBLE) AS alpha, 'Ridge_lambda_' || {fmt('gmax / a')} || '_alpha_' || "
            f"{fmt('CAST(a AS DOUBLE)')} || '.csv' AS name FROM g, (VALUES {ALPHAS}) v(a)")


def scaled_features() -> str:
    sel = ", ".join(f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
                    f"stddev_samp(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}" for c in X)
    return _input() + f"\nSELECT id, {sel} FROM mi"


def prediction_sink() -> str:
    s = linear_score_sql(*SCORER_A)
    return full_cte("test") + f"\nSELECT id, CASE WHEN {s} > 0.5 THEN 1 ELSE 0 END AS pobre FROM hogares_full"


def sink_confirmation() -> str:
    s = linear_score_sql(*SCORER_A)
    return full_cte("test") + (f"\nSELECT count(*) AS n_rows, CAST(sum(CASE WHEN {s} > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_poor, "
                               "true AS confirmed, true AS refused FROM hogares_full")


def preview_predictions() -> str:
    return prediction_sink() + " ORDER BY id LIMIT 6"
