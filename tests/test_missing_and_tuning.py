"""No row is lost to a NULL; tuning of a whole grid equals fits one by one."""

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from hhlens.operators import describe, evaluate, linear_tuning, models, neighbors, ordered, profile, sampling
from hhlens.plans import registry as R
from hhlens.plans import specs
from hhlens.session import cut_lineage, drop_cut
from hhlens.sources import io


def rows_with_nulls(spark, n=100):
    rows = [(None if i % 10 == 3 else i, None if i % 10 == 7 else i % 3, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, y int, x double")


def test_folds_and_splits_keep_rows_with_null_label_or_key(spark):
    df = rows_with_nulls(spark)
    folds = sampling.kfold(df, "y", 5)
    assert folds.count() == 100
    sizes = folds.where("y is null").groupBy("fold").count().collect()
    assert sorted(r["count"] for r in sizes) == [2, 2, 2, 2, 2]
    split = sampling.partition_split(df, "y", 0.7)
    assert split.count() == 100
    assert split.where("y is null and is_train = 1").count() == 7
    assert sampling.partition_split(df, None, 0.7, stratify=False).where("is_train = 1").count() == 70


def test_quantiles_keep_a_null_group(spark):
    df = rows_with_nulls(spark)
    got = {(r.y, r.p): (r.q, r.n) for r in ordered.exact_quantiles(df, ["x"], [0.5, 0.9], ["y"]).collect()}
    x = np.array([7.0 + 10 * i for i in range(10)])
    assert got[None, 0.5] == (np.quantile(x, 0.5), 10)
    assert got[None, 0.9][0] == pytest.approx(np.quantile(x, 0.9))


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_counts_do_not_depend_on_buckets(spark, descending):
    rng = np.random.default_rng(1)
    rows = sorted({(None if rng.random() < 0.3 else int(rng.integers(3)), int(v)) for v in rng.integers(0, 500, 400)},
                  key=str)
    df = spark.createDataFrame([(p, v, int(v % 4 + 1)) for p, v in rows], "p int, value int, cnt long")
    out = []
    for size in (10, 10_000):
        got = ordered.prefix_counts(df, ["p"], bucket_rows=size, descending=descending).collect()
        out.append({(r.p, r.value): (r.cum, r.total) for r in got})
    assert out[0] == out[1] and len(out[0]) == len(rows)
    for (p, v), (cum, total) in out[0].items():
        same = [w for q, w in rows if q == p]
        assert total == sum(w % 4 + 1 for w in same)
        assert cum == sum(w % 4 + 1 for w in same if (w >= v if descending else w <= v))


def test_prefix_counts_plan_has_no_list_of_cuts(spark):
    df = spark.range(5000).select(F.col("id").alias("value"), F.lit(1).alias("cnt"))
    plan = ordered.prefix_counts(df, [], bucket_rows=100)._jdf.queryExecution().toString()
    assert "array(" not in plan and "lambda" not in plan.lower()


def test_impute_uses_training_medians_on_both_sides(spark):
    train = spark.createDataFrame([(1.0, None), (3.0, None), (None, None), (8.0, None)], "a double, b double")
    values = models.median_values(train, ["a", "b"])
    filled = models.impute(train, {"a": values["a"], "b": values.get("b")}, indicators=True).collect()
    assert [r.a for r in filled] == [1.0, 3.0, 3.0, 8.0] and {r.b for r in filled} == {0.0}
    assert [r.a_missing for r in filled] == [0, 0, 1, 0] and {r.b_missing for r in filled} == {1}
    assert R.model_input(spark, SF001).count() == R.hogares_full(spark, SF001).count()
    test = R.model_input(spark, SF001, "test")
    assert test.count() == R.hogares_full(spark, SF001, "test").count()
    assert test.dropna(subset=specs.LINEAR_PREDICTORS).count() == test.count()


def test_whole_grid_equals_single_fits(spark):
    X, y = specs.LINEAR_PREDICTORS, specs.LABEL
    d = sampling.kfold(R.model_input(spark, SF001), y, 3, 123).cache()
    cands = models.expand_grid(alpha=[0.0, 0.5, 1.0], reg=[0.0, 0.003, 0.02, 50.0])
    cv = linear_tuning.cross_validate_linear(d, X, y, "fold", cands)
    assert all(gap <= linear_tuning.KKT_TOL for _, gap in cv.fits.values())
    assert cv.n_fits == 3 * (4 + 3 + 3)               # 50 with an L1 part is the null model
    for f, i in ((0, 0), (1, 2), (0, 6), (2, 9)):
        c = cands[i]
        m = models.fit_logistic(d.where(F.col("fold") != f), X, y, c["reg"], c["alpha"])
        beta = np.r_[m.stages[-1].intercept, m.stages[-1].coefficients.toArray()]
        assert np.allclose(cv.fits[f, i][0], beta, atol=2e-4)
        want = {r.id: r.p for r in d.where(F.col("fold") == f).select(
            "id", models.model_score_column(m).alias("p")).collect()}
        got = {r.id: r.prob for r in cv.oof.where((F.col("fold") == f) & (F.col("candidate") == i)).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)
    res = {r.candidate: r for r in models.tuning_results(cv, cands).collect()}
    assert len(res) == len(cands) and res[7].ROC == 0.5 and res[7].Spec == 1.0
    cv.release()


def test_smote_rows_stay_out_of_held_out_parts(spark):
    X, y = specs.FOREST_FINAL_PREDICTORS[:4], specs.LABEL
    d = sampling.kfold(R.model_input(spark, SF001), y, 2, 123)
    seen = []

    def resample(part, fold):
        syn = sampling.smote(part.select("id", y, *X), y, X, "id", 1, k=3, seed=f"1|{fold}")
        seen.append(syn.count())
        return part.select("id", y, *X).unionByName(syn).withColumn("fold", F.lit(-1))

    fit = lambda part, mtry: models.fit_forest(part, X, y, mtry=mtry, min_node_size=5, num_trees=3)
    cv = models.cross_validate(d, X, y, "fold", [{"mtry": 2}], fit, resample=resample)
    assert all(seen) and cv.oof.where("id < 0").count() == 0
    assert cv.oof.count() == d.count()


def test_reports_are_sorted_and_factors_profiled(spark):
    df = spark.createDataFrame([(1, None, "a", 1.0), (2, None, "b", 2.0), (3, 5, "b", None), (4, 6, None, 900.0)] * 3,
                               "k int, m int, s string, v double")
    n = [r.n for r in profile.null_counts(df).collect()]
    assert n == sorted(n, reverse=True) and n[0] == 6
    wide = df.withColumn("v", F.when(F.col("k") == 4, F.col("v")).otherwise(F.col("k")).cast("double")) \
        .union(df.withColumn("v", F.lit(2.0)))
    o = [r.n_outliers for r in profile.iqr_outliers(wide, ["k", "m", "v"]).collect()]
    assert o == sorted(o, reverse=True) and o[0] > 0
    f = {r.variable: r for r in profile.factor_profile(df, ["s", "k"], top=2).collect()}
    assert (f["s"].n_missing, f["s"].n_unique, f["s"].top_counts) == (3, 2, "b: 6, a: 3")
    assert f["s"].complete_rate == 0.75 and f["k"].top_counts == "1: 3, 2: 3"
    assert profile.columns_matching(df, "^[ks]$") == ["k", "s"]


def test_string_labels_null_labels_and_depth(spark):
    df = spark.createDataFrame([("Pobre", "Pobre"), ("No_Pobre", "Pobre")], "p string, y string")
    cells = {(r.prediction, r.reference): r.n for r in
             evaluate.confusion(df, "p", "y", "Pobre", negative="No_Pobre").collect()}
    assert cells == {("Pobre", "Pobre"): 1, ("Pobre", "No_Pobre"): 0, ("No_Pobre", "Pobre"): 1,
                     ("No_Pobre", "No_Pobre"): 0}
    with pytest.raises(ValueError):
        evaluate.confusion(df, "p", "y", "Pobre")
    with pytest.raises(Exception, match="missing values"):
        describe.class_share(rows_with_nulls(spark), "y").collect()
    with pytest.raises(ValueError):
        models.forest_pipeline(["a"], "y", 1, 1, max_depth=40)


def test_roc_area_with_end_points_is_the_auc(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(int(rng.random() < 0.4), round(float(rng.random()), 1)) for _ in range(300)],
                               "y int, s double")
    roc = evaluate.roc_curve(df, "s", "y").orderBy("fpr", "tpr").collect()
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(evaluate.auc(df, "s", "y").first()["auc"])


def test_sink_check_compares_schema(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "id bigint, pobre int")
    assert io.confirm_sink(spark, io.write_predictions(df, io.scratch(spark, "p1")), df)
    for k, bad in enumerate((df.withColumnRenamed("pobre", "poor"), df.withColumn("pobre", F.lit("x")))):
        path = io.scratch(spark, f"bad{k}")
        bad.write.option("header", True).csv(path)
        assert not io.confirm_sink(spark, path, df)


def test_cut_tables_can_be_dropped(spark):
    df = cut_lineage(spark.range(10))
    assert df.count() == 10
    drop_cut(df)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()


@pytest.mark.parametrize("bucket", [7, 1000])
def test_neighbours_with_copies_and_skew(spark, bucket):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 4, (120, 3)).astype(float)
    x[:50] = x[0]
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    got = {(r.id, r.nn_rank): r.nn_key for r in neighbors.knn_exact(df, "id", ["a", "b", "c"], 4, bucket).collect()}
    for i in range(120):
        d = [(float(((x[i] - x[j]) ** 2).sum()), j) for j in range(120) if j != i]
        assert [got[i, r] for r in range(1, 5)] == [j for _, j in sorted(d)[:4]]
