"""End-to-end flows of the survey analysis, as Spark jobs.

T1 ``build_household_tables``  persons + households -> household tables (Parquet store)
T4 ``describe_households``     shares, fill-bar tables, department ranking, densities
T2 ``linear_models``           logit / ridge / lasso / elastic net: k-fold tuning with
                               lambda_max pruning, refit, train metrics, test predictions
T3 ``random_forest``           70/30 split, trial and final forests tuned with SMOTE inside
                               the folds, importances, hold-out metrics, ROC/AUC, predictions

Run over the adapter views of the test tables:
    python -m hhlens.plans.pipelines --sf-dir /root/testdata/sf0.01 --out <shared dir> [--quick]
``--quick`` shrinks the grids and tree counts for a smoke run; without it the grids are the
survey's (ridge 100, lasso 1001, elastic net 11 x 101 candidates x 10 folds; forest 4 and
64 candidates x 5 folds).
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hhlens.functions.recode import threshold
from hhlens.operators import describe, evaluate, linear_tuning, models, sampling
from hhlens.plans import households as hh
from hhlens.plans import specs
from hhlens.sources import io


# ----------------------------------------------------------------------------- T1
def build_household_tables(persons_train: DataFrame, hogares_train: DataFrame,
                           persons_test: DataFrame, hogares_test: DataFrame, out: str,
                           member_order: Sequence[str]) -> dict[str, str]:
    """Both household tables written once to the store; later steps read them back."""
    paths = {}
    for side, p, h in (("train", persons_train, hogares_train), ("test", persons_test, hogares_test)):
        paths[side] = io.write_store(hh.household_table(p, h, member_order=member_order), f"{out}/{side}_hogares_full")
    return paths


# ----------------------------------------------------------------------------- T4
def describe_households(full: DataFrame, lookup: DataFrame | None = None, lookup_key: str = "Depto",
                        name_col: str = "Nombre_Depto") -> dict[str, DataFrame]:
    full = full.withColumn(specs.LABEL, F.col(specs.LABEL).cast("int"))
    return {
        "class_share": describe.class_share(full, specs.LABEL, specs.POBRE_LABELS),
        "share_by_head_sex": describe.fill_shares(full, specs.LABEL, "JH_Mujer"),
        "share_by_children": describe.fill_shares(full, "Hijos", specs.LABEL, (0, 10)),
        "share_by_size": describe.fill_shares(full, "Nper", specs.LABEL, (0, 10)),
        "poverty_by_department": describe.ordered_group_shares(
            full, "Depto", specs.LABEL, 1, lookup, lookup_key, name_col),
        "density_ingpcug_non_poor": describe.kde(full.where("Pobre = 0"), "Ingpcug"),
        "density_ingtotug_poor": describe.kde(full.where("Pobre = 1"), "Ingtotug"),
        "density_log10_non_poor": describe.kde(full.where("Pobre = 0"), "Ingpcug", log10=True),
        "density_log10_by_class": describe.kde(full, "Ingpcug", [specs.LABEL], log10=True),
    }


def department_lookup(spark: SparkSession) -> DataFrame:
    return io.lookup_table(spark, specs.DEPARTAMENTOS, "Depto int, Nombre_Depto string")


# ----------------------------------------------------------------------------- T2
def linear_grids(quick: bool = False) -> dict[str, list[dict]]:
    if quick:
        return {"logit": [{"alpha": 0.0, "reg": 0.0}],
                "ridge": models.expand_grid(alpha=[0.0], reg=specs.RIDGE_LAMBDAS[::25]),
                "lasso": models.expand_grid(alpha=[1.0], reg=specs.LASSO_LAMBDAS[:30:5]),
                "elastic_net": models.expand_grid(alpha=[0.5, 1.0], reg=specs.ENET_LAMBDAS[:4])}
    return {"logit": [{"alpha": 0.0, "reg": 0.0}],
            "ridge": models.expand_grid(alpha=[0.0], reg=specs.RIDGE_LAMBDAS),
            "lasso": models.expand_grid(alpha=[1.0], reg=specs.LASSO_LAMBDAS),
            "elastic_net": models.expand_grid(alpha=specs.ENET_ALPHAS, reg=specs.ENET_LAMBDAS)}


def linear_models(train: DataFrame, test: DataFrame, out: str, folds: int = specs.LINEAR_FOLDS,
                  quick: bool = False) -> dict:
    """Tune each linear model by k-fold accuracy, refit the best on all training rows,
    report train-set metrics (class 1 positive) and write the ridge test predictions."""
    X, y = specs.LINEAR_PREDICTORS, specs.LABEL
    spark = train.sparkSession
    values = models.median_values(train, X)
    data = sampling.kfold(models.impute(train, values), y, folds, specs.SEED)
    report, metrics, fitted = {}, {}, {}
    for name, cands in linear_grids(quick).items():
        cv = linear_tuning.cross_validate_linear(data, X, y, "fold", cands)
        res = models.tuning_results(cv, cands)
        io.write_store(res, f"{out}/tuning_{name}")
        best = models.best_candidate(res)
        model = models.fit_logistic(data, X, y, best["reg"], best["alpha"])
        cv.release()
        fitted[name] = model
        scored = models.prob_of_positive(model.transform(data.withColumn(y, F.col(y).cast("double"))))
        scored = scored.withColumn("pred", threshold("prob", specs.THRESHOLD)).withColumn(y, F.col(y).cast("int"))
        metrics[name] = evaluate.binary_metrics(scored, "pred", y, 1)
        report[name] = {"best": {k: best[k] for k in ("alpha", "reg", "Accuracy")}, "fits": cv.n_fits,
                        "coefficients": models.coefficient_table(model, X)}
    io.write_store(evaluate.comparison_table(metrics), f"{out}/linear_comparison")
    ridge = fitted["ridge"]
    t = models.impute(test, values)
    pred = models.prob_of_positive(ridge.transform(t)).select("id", threshold("prob", specs.THRESHOLD).alias("pobre"))
    b = report["ridge"]["best"]
    name = spark.range(1).select(io.output_name("Ridge", F.lit(b["reg"]), F.lit(b["alpha"]))).first()[0]
    io.write_predictions(pred, f"{out}/{name}")
    report["ridge"]["predictions"] = f"{out}/{name}"
    return report


# ----------------------------------------------------------------------------- T3
def random_forest(train: DataFrame, test: DataFrame, out: str, quick: bool = False,
                  parallelism: int = 2, run: object = None) -> dict:
    """Trial forest (35 predictors) for importances, final forest (20 predictors) tuned
    with 5-fold CV and SMOTE applied to each fold's training rows only.  Both keep a ledger
    under ``out``: the same call on the same ``out`` goes on where a stopped one ended (``run``
    names the input)."""
    y = specs.LABEL
    report = {}
    for stage, X, grid, trees in (
            ("trial", specs.FOREST_TRIAL_PREDICTORS, specs.FOREST_TRIAL_GRID, specs.FOREST_TRIAL_TREES),
            ("final", specs.FOREST_FINAL_PREDICTORS, specs.FOREST_FINAL_GRID, specs.FOREST_FINAL_TREES)):
        if quick:
            grid = {k: v[:2] for k, v in grid.items()}
            trees = min(trees, 10)
        values = models.median_values(train, X)
        d = sampling.partition_split(models.impute(train, values), y, specs.TRAIN_SHARE, specs.SEED)
        tr, hold = d.where("is_train = 1"), d.where("is_train = 0")
        tr = sampling.kfold(tr, y, specs.FOREST_FOLDS, specs.SEED)
        cv, res, best, model = models.tune_forest(
            tr, X, y, grid, trees, seed=specs.SEED, parallelism=parallelism, ledger=f"{out}/forest_{stage}_ledger", run=run)
        io.write_store(res, f"{out}/forest_{stage}_tuning")
        io.write_store(models.importance_table(model, X, train.sparkSession, top=20), f"{out}/forest_{stage}_importance")
        ph = models.prob_of_positive(model.transform(hold.withColumn(y, F.col(y).cast("double"))))
        ph = ph.withColumn("pred", F.col("prediction").cast("int")).withColumn(y, F.col(y).cast("int"))
        m = evaluate.binary_metrics(ph, "pred", y, 1).first().asDict()
        m["auc"] = evaluate.auc(ph, "prob", y, 1).first()["auc"]
        io.write_store(evaluate.roc_curve(ph, "prob", y, 1), f"{out}/forest_{stage}_roc")
        report[stage] = {"best": {k: best[k] for k in ("mtry", "min_node_size", "Accuracy")},
                         "holdout": m}
        if stage == "final":
            t = models.impute(test, values)
            pred = model.transform(t).select("id", F.col("prediction").cast("int").alias("pobre"))
            io.write_predictions(pred, f"{out}/predicciones_test")
            report["final"]["external_score"] = specs.EXTERNAL_SCORE
    return report


# ----------------------------------------------------------------------------- CLI
def main(argv=None) -> None:
    from hhlens.session import build_session, shared_dir
    from hhlens.sources import fixtures as fx

    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None, help="shared output folder (default: under spark.checkpoint.dir)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--quick", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    out = a.out or f"{shared_dir(spark).rstrip('/')}/pipelines"
    persons = fx.personas(spark, a.sf_dir)
    paths = build_household_tables(persons, fx.hogares(spark, a.sf_dir, "train"), persons,
                                   fx.hogares(spark, a.sf_dir, "test"), out, fx.HEAD_ORDER)
    train, test = io.read_store(spark, paths["train"]), io.read_store(spark, paths["test"])
    for name, df in describe_households(train, department_lookup(spark), "Depto", "Nombre_Depto").items():
        io.write_store(df, f"{out}/describe_{name}")
    report = {"tables": paths, "linear": linear_models(train, test, out, quick=a.quick),
              "forest": random_forest(train, test, out, quick=a.quick, run=a.sf_dir)}
    print(json.dumps(report, default=str, indent=1))


if __name__ == "__main__":
    main()
