"""Evaluation, splits, folds, weights, kNN and SMOTE."""

import numpy as np
from pyspark.sql import functions as F

from hhlens.operators import evaluate, sampling
from hhlens.operators.neighbors import knn_exact


def _scores(spark, rows):
    return spark.createDataFrame(rows, "id bigint, y int, score double").withColumn(
        "pred", (F.col("score") > 0.5).cast("int"))


def test_threshold_is_strict(spark):
    df = _scores(spark, [(1, 1, 0.5), (2, 0, 0.50001)])
    assert [r["pred"] for r in df.orderBy("id").collect()] == [0, 1]


def test_confusion_cells_sum_to_n_and_absent_cells_zero(spark):
    df = _scores(spark, [(1, 1, 0.9), (2, 1, 0.8), (3, 1, 0.7)])
    cells = {(r["prediction"], r["reference"]): r["n"] for r in evaluate.confusion(df, "pred", "y").collect()}
    assert cells == {(1, 1): 3, (1, 0): 0, (0, 1): 0, (0, 0): 0}


def test_no_predicted_positives_gives_null_precision(spark):
    df = _scores(spark, [(1, 1, 0.1), (2, 0, 0.2)])
    m = evaluate.binary_metrics(df, "pred", "y").first()
    assert m["Precision"] is None and m["F1"] is None and m["Accuracy"] == 0.5


def test_roc_steps_once_per_score_and_auc_ties(spark):
    df = _scores(spark, [(1, 1, 0.8), (2, 0, 0.8), (3, 1, 0.3), (4, 0, 0.1)])
    roc = evaluate.roc_curve(df, "score", "y").orderBy(F.desc("score")).collect()
    assert [r["score"] for r in roc] == [float("inf"), 0.8, 0.3, 0.1]
    assert [(r["tpr"], r["fpr"]) for r in roc] == [(0.0, 0.0), (0.5, 0.5), (1.0, 0.5), (1.0, 1.0)]
    auc = evaluate.auc(df, "score", "y").first()["auc"]
    assert abs(auc - 0.625) < 1e-12          # pairs: tie 0.5 + 1 + 0 + 1 = 2.5 of 4


def test_auc_symmetry_and_buckets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for i in range(400)]
    df = _scores(spark, rows)
    a = evaluate.auc(df, "score", "y").first()["auc"]
    a_b = evaluate.auc(df, "score", "y", bucket_rows=7).first()["auc"]
    flipped = df.withColumn("score", 1 - F.col("score"))
    a_f = evaluate.auc(flipped, "score", "y").first()["auc"]
    assert abs(a - a_b) < 1e-12 and abs(a + a_f - 1) < 1e-12


def test_split_and_folds_partition_rows(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    s = sampling.partition_split(df, "y", 0.7, seed=9)
    by = {r["y"]: (r["n"], r["t"]) for r in s.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_train").alias("t")).collect()}
    assert by[1] == (200, 140) and by[0] == (800, 560)
    f = sampling.kfold(df, "y", 10, seed=9)
    assert f.count() == 1000 and f.select("id").distinct().count() == 1000
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 2
    again = sampling.kfold(df.repartition(7), "y", 10, seed=9)
    assert f.exceptAll(again.select(*f.columns)).count() == 0        # partitioning-independent


def test_class_weights(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "id bigint, y int")
    w = {r["id"]: r for r in sampling.class_weights(df, "y", fixed={1: 0.79, 0: 0.21}).collect()}
    assert w[1]["w_inverse"] == 1.0 and abs(w[2]["w_inverse"] - 1 / 3) < 1e-12 and w[1]["w_fixed"] == 0.79


def test_knn_exact_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)).round(1)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id bigint, a double, b double, c double, d double")
    got = knn_exact(df, "id", ["a", "b", "c", "d"], 3, bucket_rows=40).toPandas()
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d2, np.inf)
    ids = np.arange(len(x))
    for q, g in got.groupby("id"):
        want = list(ids[np.lexsort((ids, d2[q]))[:3]])
        assert list(g.sort_values("nn_rank").nn_key) == want


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(7)
    rows = [(i, int(i < 30), float(rng.normal()), float(rng.normal())) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, y int, a double, b double")
    syn = sampling.smote(df, "y", ["a", "b"], "id", 1, k=3, seed=1)
    assert syn.count() == 70 - 30
    lo = df.where("y = 1").agg(F.min("a"), F.max("a")).first()
    s = syn.agg(F.min("a"), F.max("a")).first()
    assert lo[0] <= s[0] and s[1] <= lo[1]
    assert syn.exceptAll(sampling.smote(df, "y", ["a", "b"], "id", 1, k=3, seed=1)).count() == 0


def test_smote_copies_meet_one_join(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0), float(i % 7), float(i % 11)) for i in range(60)],
                               "id long, y int, a double, b double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sampling.smote(df, "y", ["a", "b"], k=3)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 36
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # What stands above the explosion of the base rows moves the copies.
    assert plan[:plan.rfind("Generate explode")].count("SortMergeJoin") == 1
