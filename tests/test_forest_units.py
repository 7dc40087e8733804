"""The forest is grown in a few passes; large nodes and units give one and the same tree."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from hhlens.operators import forest, models

X = ["a", "b", "c", "d"]


def _rows(spark, n=3000):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 4))
    x[:, 3] = rng.integers(0, 2, n)
    y = (x[:, 0] * x[:, 1] + x[:, 3] + rng.normal(size=n) > 0.8).astype(int)
    return spark.createDataFrame([(i, int(v), *map(float, r)) for i, (v, r) in enumerate(zip(y, x))],
                                 "id bigint, y int, a double, b double, c double, d double").coalesce(3)


def _probs(model, df):
    return {r.id: r.prob for r in models.prob_of_positive(model.transform(df)).select("id", "prob").collect()}


def test_a_deep_forest_takes_few_jobs(spark):
    df, sc = _rows(spark).cache(), spark.sparkContext
    df.count()
    sc.setJobGroup("forest-jobs", "")
    try:
        m = models.fit_forest(df, X, "y", mtry=2, min_node_size=1, num_trees=3, max_depth=20, seed=1)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("forest-jobs")) <= 12     # not one and more a level
    assert m.totalNumNodes > 600 and m.getNumTrees == 3


def test_large_nodes_and_units_give_the_same_tree(spark, monkeypatch):
    df = _rows(spark)
    data = forest.prepare(df, X, "y", 1)
    whole = forest.grow_forest(data, 4, 3, 2, 8, 5)          # all features in every node
    monkeypatch.setattr(forest, "UNIT_ROWS", 200)
    split = forest.grow_forest(data, 4, 3, 2, 8, 5)
    assert _probs(whole, df) == _probs(split, df)
    assert np.allclose(whole.featureImportances.toArray(), split.featureImportances.toArray(), rtol=1e-12)
    monkeypatch.setattr(forest, "UNIT_ROWS", 1)              # no units at all
    assert _probs(whole, df) == _probs(forest.grow_forest(data, 4, 3, 2, 8, 5), df)


def test_a_subtree_makes_the_best_split_of_every_node():
    rng = np.random.default_rng(5)
    n, bins = 400, np.array([2, 5, 9])
    x = np.stack([rng.integers(0, b, n) for b in bins], axis=1).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.1 * x[:, 2] * (x[:, 0] > 0)).astype(np.uint8)
    w = rng.integers(1, 4, n).astype(np.uint8)

    def brute(rows, depth):
        t, p = int(w[rows].sum()), int((w[rows] * y[rows]).sum())
        best = None
        if depth and 0 < p < t:
            for f in range(3):
                for c in range(bins[f] - 1):
                    go = x[rows, f] <= c
                    lt, lp = int(w[rows][go].sum()), int((w[rows] * y[rows])[go].sum())
                    if min(lt, t - lt) >= 4:
                        gini = lambda a, b: 1 - (a / b) ** 2 - (1 - a / b) ** 2
                        gain = gini(p, t) - lt / t * gini(lp, lt) - (t - lt) / t * gini(p - lp, t - lt)
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                            best = gain, go
        if best is None:
            return {frozenset(rows.tolist()): p / t}
        left, right = brute(rows[best[1]], depth - 1), brute(rows[~best[1]], depth - 1)
        if len(left) == len(right) == 1 and (max(left.values()) > 0.5) == (max(right.values()) > 0.5):
            return {frozenset(rows.tolist()): p / t}
        return left | right

    for chunk in (64, 1 << 14):
        forest.CHUNK, own = chunk, forest.CHUNK
        try:
            feat, cut, left, pos, tot, _ = forest.grow_unit(x, y, w, bins, 3, 4, 6, np.random.default_rng(0))
        finally:
            forest.CHUNK = own
        tree = forest.Tree(feat, cut, left, pos / tot)
        at = tree.route(x)
        got = {frozenset(np.flatnonzero(at == i).tolist()): tree.prob[i] for i in np.unique(at)}
        assert got == pytest.approx(brute(np.arange(n), 6))


def test_the_forest_is_as_good_as_spark_mls_and_refuses_missing_values(spark):
    from hhlens.operators import evaluate

    df = _rows(spark, 6000)
    train, hold = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    area = []
    for m in (models.fit_forest(train, X, "y", mtry=2, min_node_size=10, num_trees=20, seed=1),
              models.forest_pipeline(X, "y", 2, 10, num_trees=20, seed=1).fit(train.withColumn("y", F.col("y").cast("double")))):
        p = models.prob_of_positive(m.transform(hold))
        assert p.where((F.col("prediction") == 1) != (F.col("prob") > 0.5)).count() == 0
        area.append(evaluate.auc(p, "prob", "y", 1).first()["auc"])
    assert abs(area[0] - area[1]) < 0.02
    with pytest.raises(Exception, match="missing values"):
        models.fit_forest(df.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), X, "y", mtry=2, min_node_size=1, num_trees=1)
    three = df.withColumn("y", F.col("id") % 3)              # other labels go to Spark ML
    assert models.fit_forest(three, X, "y", mtry=2, min_node_size=1, num_trees=1, max_depth=3).stages[-1].numClasses == 3


def test_split_points():
    assert forest.split_points(np.array([0.0, 1.0, 1.0, 0.0]), 32).tolist() == [0.5]
    assert forest.split_points(np.array([2.0, 2.0]), 32).tolist() == []
    p = forest.split_points(np.arange(1000.0), 32)
    assert len(p) == 31 and np.all(np.diff(p) > 0) and abs(p[0] - 31) < 1.5
    hot = forest.split_points(np.r_[np.zeros(10_000), np.arange(1, 100.0)], 32)
    assert hot[0] == 0.5 and len(hot) == 31


@pytest.mark.parametrize("how", ["hot", "few", "twice"])
def test_one_search_answers_for_every_training_part(spark, how):
    from hhlens.operators.neighbors import knn_exact, knn_folds

    rng = np.random.default_rng(11)
    n = {"hot": 900, "few": 9, "twice": 1500}[how]
    x = rng.normal(size=(n, 3)).round(1 if how == "twice" else 0)
    fold = rng.permutation(np.arange(n) % 3)
    data = [(int(7 * i - 50), int(f) + 4, *map(float, r)) for i, (f, r) in enumerate(zip(fold, x))]
    if how == "twice":                          # keys that are there twice, mostly in two folds
        data += [(i, (f + j) % 3 + 4, *r) for j, (i, f, *r) in enumerate(data[::4])]
    df = spark.createDataFrame(data, "id bigint, fold int, a double, b double, c double")
    got = knn_folds(df, "id", ["a", "b", "c"], "fold", [4, 5, 6], 5, 40)
    for f in (None, 4, 5, 6):
        part = df if f is None else df.where(F.col("fold") != f)
        rows = lambda d: sorted((r.id, r.nn_rank, r.nn_key, r.d2) for r in d.collect())
        assert rows(got[f]) == rows(knn_exact(part, "id", ["a", "b", "c"], 5))


def test_a_fold_that_holds_all_near_rows_is_searched_apart(spark):
    from hhlens.operators.neighbors import knn_folds

    df = spark.range(200).selectExpr("id", "if(id < 100 AND id <> 50, 0, 1) AS fold", "double(id) AS a")   # all near row 50 are of fold 0
    assert knn_folds(df, "id", ["a"], "fold", [0, 1], 5) is None
    wide = df.selectExpr("id", "id % 2 AS fold", "a")
    assert knn_folds(wide, "id", ["a"], "fold", [0, 1], 5) is not None
    assert knn_folds(wide.selectExpr("if(id = 3, NULL, id) AS id", "fold", "a"), "id", ["a"], "fold", [0, 1], 5) is None


def test_the_folds_smote_rows_come_from_one_search(spark, monkeypatch):
    from hhlens.operators import neighbors, sampling

    rng = np.random.default_rng(2)
    d = spark.createDataFrame([(i, int(rng.random() < 0.3), i % 3, *map(float, rng.normal(size=3))) for i in range(600)],
                              "id bigint, y int, fold int, a double, b double, c double")
    made, own = [], neighbors._candidates
    monkeypatch.setattr(neighbors, "_candidates", lambda *a: made.append(1) or own(*a))
    cv = models.cross_validate(d, X[:3], "y", "fold", [{"reg": 0.1}], lambda part, reg: models.fit_logistic(part, X[:3], "y", reg),
                               resample=models.smote_part(X[:3], "y", k=3, seed=9), whole=True)
    assert len(made) == 1
    rows = lambda df: sorted(map(tuple, df.select("id", "y", *X[:3]).collect()))
    for f, part in (("all", d), *[(f, d.where(F.col("fold") != f)) for f in range(3)]):
        name = "train/all" if f == "all" else f"train/fold={f}"
        part = part.select("id", "y", *X[:3])
        want = part.unionByName(sampling.smote(part, "y", X[:3], "id", 1, k=3, seed=f"9|{f}"))
        assert rows(cv.ledger.table(name, None)) == rows(want)
