"""Model invariants: KKT optimality, lambda_max, tuning, forest."""

from conftest import SF001
from pyspark.sql import functions as F

from hhlens.operators import models, sampling
from hhlens.plans import registry as R
from hhlens.plans import specs


def _input(spark):
    return R.model_input(spark, SF001).cache()


def test_kkt_holds_for_penalised_fits(spark):
    d = _input(spark)
    X = specs.LINEAR_PREDICTORS
    for reg, alpha in [(0.01, 0.0), (0.02, 1.0), (0.02, 0.5)]:
        m = models.fit_logistic(d, X, "Pobre", reg, alpha)
        assert all(r["ok"] for r in models.kkt_check(d, m, X, "Pobre", reg, alpha).collect())


def test_lambda_max_gives_null_model(spark):
    d = _input(spark)
    X = specs.LINEAR_PREDICTORS
    lm = models.lambda_max(d, X, "Pobre", [1.0]).first()["lambda_max"]
    above = models.fit_logistic(d, X, "Pobre", lm * 1.01, 1.0).stages[-1].coefficients.toArray()
    below = models.fit_logistic(d, X, "Pobre", lm * 0.9, 1.0).stages[-1].coefficients.toArray()
    assert not any(above) and any(below)


def test_cross_validation_results_and_pruning(spark):
    d = sampling.kfold(_input(spark), "Pobre", 3, 123)
    X = specs.LINEAR_PREDICTORS
    cands = models.expand_grid(alpha=[1.0], reg=[0.0, 0.01, 5.0, 10.0])
    fit = lambda train, alpha, reg: models.fit_logistic(train, X, "Pobre", reg, alpha)
    cv = models.cross_validate(d, X, "Pobre", "fold", cands, fit,
                               pruned=models.lambda_max_pruner(X, "Pobre"))
    assert cv.n_fits == 6                       # 5.0 and 10.0 share the intercept-only model
    res = {r["candidate"]: r for r in models.tuning_results(cv, cands).collect()}
    assert res[2]["Accuracy"] == res[3]["Accuracy"] and res[2]["ROC"] == 0.5
    n = d.count()
    assert cv.oof.where("candidate = 0").count() == n
    best = models.best_candidate(models.tuning_results(cv, cands))
    assert best["Accuracy"] == max(r["Accuracy"] for r in res.values())


def test_forest_importance_and_determinism(spark):
    d = R.model_input(spark, SF001).cache()
    X = specs.FOREST_FINAL_PREDICTORS
    m1 = models.fit_forest(d, X, "Pobre", mtry=4, min_node_size=5, num_trees=10, seed=1)
    m2 = models.fit_forest(d, X, "Pobre", mtry=4, min_node_size=5, num_trees=10, seed=1)
    imp = models.importance_table(m1, X, spark).collect()
    assert abs(sum(r["importance"] for r in imp) - 1) < 1e-9
    assert max(r["scaled"] for r in imp) == 100.0
    assert list(m1.stages[-1].featureImportances.toArray()) == list(m2.stages[-1].featureImportances.toArray())


def test_prediction_sink_roundtrip(spark):
    from hhlens.sources import io

    df = spark.createDataFrame([(1, 1), (2, 0)], "id bigint, pobre int")
    path = io.write_predictions(df, io.scratch(spark, "pred-test"))
    assert io.confirm_sink(spark, path, df)
    assert sorted(tuple(r) for r in io.read_predictions(spark, path).collect()) == [(1, 1), (2, 0)]
    name = spark.range(1).select(io.output_name("Ridge", F.lit(0.12345), F.lit(0.0)).alias("n")).first()["n"]
    assert name == "Ridge_lambda_0_1235_alpha_0.csv"


def test_small_parameters_print_in_exponent_form(spark):
    from hhlens.sources import io

    values = {0.0: "0", 1e-4: "1e-04", 0.00094: "9e-04", 0.00099: "0.001", 0.0012: "0.0012", -2e-4: "-2e-04",
              1.0001: "1.0001", 10.0: "10", 0.5: "0.5"}
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", io.fmt_param(F.col("x")).alias("s")).collect()
    assert {r.x: r.s for r in got} == values
