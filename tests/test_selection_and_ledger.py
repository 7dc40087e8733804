"""Bracketed quantiles, digit selection, two-level ranks and sums, partition tree, counted
rates and the ledger of fits."""

import math

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from hhlens.functions.randomness import portable_hash
from hhlens.operators import evaluate, ledger, linear_tuning, models, neighbors, ordered, profile, reduction, sampling
from hhlens.plans import registry as R
from hhlens.plans import specs


# ---------------------------------------------------------------- quantiles

def skewed(n=4000):
    rng = np.random.default_rng(4)
    cols = {"hot": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 20, n)), "one": np.full(n, 3.0),
            "wide": np.exp(rng.normal(size=n) * 8), "few": np.where(rng.random(n) < 0.999, np.nan, rng.random(n))}
    return cols, rng.integers(0, 3, n)


@pytest.mark.parametrize("points, rows", [(8, 0), (4096, 10**6)])
def test_quantiles_with_ties_gaps_and_rough_sketches(spark, monkeypatch, points, rows):
    monkeypatch.setattr(ordered, "POINTS", points)          # 8 points: brackets miss and are widened
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", rows)    # 0: kept values are ranked in Spark
    cols, g = skewed()
    data = [(None if k == 2 else int(k), *[None if math.isnan(v) else float(v) for v in r]) for k, *r in zip(g, *cols.values())]
    df = spark.createDataFrame(data, "g int, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.variable, r.p): (r.q, r.n) for r in ordered.exact_quantiles(df, list(cols), probs, ["g"]).collect()}
    for c, v in cols.items():
        for k in (0, 1, None):
            x = v[(g == (2 if k is None else k)) & ~np.isnan(v)]
            for p in probs if len(x) else ():
                assert got[k, c, p] == (pytest.approx(np.quantile(x, p), rel=1e-12), len(x))
    assert {k[1] for k in got} == set(cols)
    assert ordered.exact_quantiles(df.where("false"), ["hot"], [0.5]).collect() == []


def test_many_groups_are_ranked_instead(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_GROUPS", 3)
    df = spark.range(400).select((F.col("id") % 20).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r.g: r.q for r in ordered.exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {k: float(np.quantile(np.arange(k, 400, 20), 0.5)) for k in range(20)}


def test_quantiles_shuffle_no_value(spark):
    seen = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    df = spark.range(1000).selectExpr("cast(id as double) c0", "0 g")
    found = ordered._count_and_keep(df, {(0, 0): (1000, [(100.0, 120.0)])}, 1)
    seen = found.collect()
    assert "Exchange" not in plan(found) and "Expand" not in plan(found)
    assert sum(r.value is not None for r in seen) == 19
    assert np.sum([r.at for r in seen if r.value is None], axis=0).tolist() == [100, 101, 120, 121]


def test_profile_of_nulls_and_constants(spark):
    df = spark.createDataFrame([(1.0, None, 5), (2.0, None, 5), (4.0, None, None)], "a double, b double, c int")
    got = {r.variable: r.asDict() for r in profile.column_profile(df).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["mean"], a["p50"], a["h0"], a["h4"]) == (pytest.approx(7 / 3), 2.0, 1, 1) and a["sd"] == pytest.approx(np.std([1, 2, 4], ddof=1))
    assert b["n_missing"] == 3 and b["mean"] is None and b["p50"] is None and b["h0"] == 0
    assert (c["n_missing"], c["h0"], c["sd"], c["p25"]) == (1, 2, 0.0, 5.0)
    assert profile.column_profile(df.where("false")).count() == 3


# ---------------------------------------------------------------- split and folds

def hashed(spark, keys, seed):
    return {r.k: r.h for r in spark.createDataFrame([(k,) for k in keys], "k long").select(
        "k", portable_hash("k", seed).alias("h")).collect()}


@pytest.mark.parametrize("sort_rows, bits", [(0, 4), (5, 12), (100_000, 12)])
def test_split_equals_a_full_sort(spark, monkeypatch, sort_rows, bits):
    monkeypatch.setattr(sampling, "SORT_ROWS", sort_rows)
    monkeypatch.setattr(sampling, "DIGIT_BITS", bits)
    monkeypatch.setattr(sampling, "DIGIT", 1 << bits)
    rows = [(i, [0, 1, None][i % 3 if i % 7 else 0]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, y int").repartition(3)
    h = hashed(spark, range(500), 9)
    got = {r.id: r.is_train for r in sampling.partition_split(df, "y", 0.7, 9).collect()}
    for c in (0, 1, None):
        own = sorted((h[i], i) for i, y in rows if y == c)
        cut = math.ceil(0.7 * len(own))
        assert [got[i] for _, i in own] == [1] * cut + [0] * (len(own) - cut)


def test_split_is_a_projection_and_numbers_only_torn_keys(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(60)], "id long, y int")
    plan = sampling.partition_split(df, "y", 0.7)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Join", "Sort", "Window"))
    same = spark.createDataFrame([(None if i < 30 else 5, 1, i) for i in range(60)], "id long, y int, n int")
    got = sampling.partition_split(same, "y", 0.25).collect()
    assert len(got) == 60 and sum(r.is_train for r in got) == 15 and all(r.n < 30 for r in got if r.is_train)
    assert sampling.partition_split(same.where("false"), "y", 0.5).count() == 0
    whole = sampling.partition_split(same, "y", 1.0)
    assert whole.where("is_train = 1").count() == 60 and sampling.partition_split(same, "y", 0.0).where("is_train = 1").count() == 0


def test_many_classes_are_ranked_instead(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_CLASSES", 2)
    df = spark.range(200).select("id", (F.col("id") % 10).alias("y"))
    got = sampling.partition_split(df, "y", 0.7).groupBy("y").agg(F.sum("is_train").alias("n")).collect()
    assert {r.n for r in got} == {14}


def test_two_level_ranks_do_not_depend_on_buckets(spark):
    df = spark.createDataFrame([(i if i % 9 else None, i % 2) for i in range(300)], "id long, y int")
    h = hashed(spark, range(300), 1)
    for size in (4, 50_000):
        got = sampling.rank_within(df, ["y"], "id", 1, size).collect()
        for c in (0, 1):
            mine = sorted((r["rank"], r._h, r.n_part) for r in got if r.y == c)
            assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and {m[2] for m in mine} == {len(mine)}
            assert [m[1] for m in mine] == sorted(m[1] for m in mine)
        assert all(r._h == (-1 if r.id is None else h[r.id]) for r in got)


# ---------------------------------------------------------------- two-level sums

def test_partial_rows_meet_in_two_levels(spark, monkeypatch):
    df = spark.range(0, 400, 1, 40)
    assert reduction.parts_for(df) == 1
    monkeypatch.setattr(reduction, "DIRECT", 3)
    parts = reduction.parts_for(df, 3)
    assert parts == 7
    held = spark.sparkContext.accumulator(0)

    def part(batches):
        got = [x for b in batches for x in b.column(0).to_pylist()]
        for k in (0, 1):
            yield pa.RecordBatch.from_pydict({"k": [k], "part": pa.array([reduction.task_part(parts)], pa.int32()),
                                              "n": [1], "s": [float(sum(got)) * (k + 1)]})

    def add(t):
        held.add(t.num_rows > 7)
        return pa.table({"k": t.column("k")[:1], "part": t.column("part")[:1],
                         "n": pa.array([sum(t.column("n").to_pylist())]), "s": pa.array([sum(t.column("s").to_pylist())])})

    got = reduction.combine(df.mapInArrow(part, "k long, part int, n long, s double"), ["k"], add, parts).collect()
    assert {(r.k, r.n, r.s) for r in got} == {(0, 40, 79800.0), (1, 40, 159600.0)}
    assert held.value == 0


# ---------------------------------------------------------------- counted rates

@pytest.mark.parametrize("bins", [4, 1 << 16])
def test_counted_rates_equal_the_rows(spark, monkeypatch, bins):
    monkeypatch.setattr(linear_tuning, "BINS", bins)
    monkeypatch.setattr(linear_tuning, "CELLS_HELD", 50)
    X, y = specs.LINEAR_PREDICTORS[:4], specs.LABEL
    d = sampling.kfold(R.model_input(spark, SF001), y, 3, 123)
    cands = models.expand_grid(alpha=[0.0, 1.0], reg=[0.001, 0.01, 80.0])
    cv = linear_tuning.cross_validate_linear(d, X, y, "fold", cands)
    want = {(r.fold, r.candidate): r for r in evaluate.five_stats(cv.oof, "prob", "pred", y, 1, ["candidate", "fold"]).collect()}
    assert set(cv.rates) == set(want)
    for m, r in cv.rates.items():
        n = r["tp"] + r["fp"] + r["fn"] + r["tn"]
        assert r["auc"] == pytest.approx(want[m].ROC, abs=1e-12) and (r["tp"] + r["tn"]) / n == pytest.approx(want[m].Accuracy)
    one = cv.held_out(1)
    assert one.count() == d.count() and one.select("candidate").distinct().count() == 1
    # The recheck agrees, and sees a coefficient that is off.
    assert max(linear_tuning.recheck(cv, cands).values()) < 1e-6
    key = next(iter(cv.fits))
    cv.fits[key] = cv.fits[key][0] + 1e-3, 0.0
    assert linear_tuning.recheck(cv, cands)[key] > 1e-5


def test_fitted_metrics_equal_a_plain_solver(spark):
    got = {(r.model, r.metric): r.value for r in R.fitted_model_metrics(spark, SF001).collect()}
    d = R.model_input(spark, SF001).toPandas()
    x = d[specs.LINEAR_PREDICTORS].to_numpy(float)
    y = d[specs.LABEL].to_numpy(float)
    sd = x.std(axis=0, ddof=1)
    z = np.hstack([np.ones((len(x), 1)), (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1)])
    for name in ("logit", "ridge"):
        lam, b = got[name, "lambda"], np.zeros(z.shape[1])
        pen = np.r_[0.0, np.full(z.shape[1] - 1, lam)]
        for _ in range(60):
            p = 1 / (1 + np.exp(-z @ b))
            h = (z * (p * (1 - p))[:, None]).T @ z / len(z) + np.diag(pen) + 1e-12 * np.eye(len(b))
            b -= np.linalg.solve(h, z.T @ (p - y) / len(z) + pen * b)
        p = 1 / (1 + np.exp(-z @ b))
        said = p > 0.5
        assert got[name, "Accuracy"] == pytest.approx((said == (y == 1)).mean(), abs=2e-3)
        order = np.argsort(p)
        ranks = np.empty(len(p))
        ranks[order] = np.arange(1, len(p) + 1)
        n1 = y.sum()
        auc = (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))
        assert got[name, "AUC"] == pytest.approx(auc, abs=2e-3)
    assert got["reported", "Kaggle"] == specs.EXTERNAL_SCORE and len(got) == 4 * 8 + 1


# ---------------------------------------------------------------- partition tree

def brute(ids, x, k):
    out = {}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        for r, j in enumerate([j for j in np.lexsort((ids, d)) if j != i][:k]):
            out[ids[i], r + 1] = ids[j]
    return out


@pytest.mark.parametrize("name", ["grid", "hot", "far", "few"])
def test_tree_neighbours_are_exact(spark, monkeypatch, name):
    rng = np.random.default_rng(2)
    x = {"grid": rng.integers(0, 4, (400, 3)).astype(float), "hot": np.vstack([np.zeros((250, 3)), rng.integers(0, 9, (150, 3))]),
         "far": np.r_[rng.integers(0, 99, (200, 2)), 10_000 + rng.integers(0, 9, (3, 2))].astype(float), "few": rng.random((4, 2))}[name]
    monkeypatch.setattr(neighbors, "VISITS", 30)
    ids = rng.permutation(len(x)) * 3
    cols = [f"f{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(int(i), *map(float, r)) for i, r in zip(ids, x)] + [(-1, None, *[0.0] * (len(cols) - 1)), (-2, float("nan"), *[0.0] * (len(cols) - 1))],
                               "id long, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    for rows in (9, 500):
        report = {}
        got = {(r.id, r.nn_rank): r.nn_key for r in neighbors.knn_exact(df, "id", cols, 4, rows, report).collect()}
        assert got == brute(ids, x, 4)
        assert report["vectors"] == len(np.unique(x, axis=0)) and report["leaves"] >= 1
    assert neighbors.knn_exact(df.where("false"), "id", cols, 4).count() == 0


def test_visits_grow_no_faster_than_the_vectors(spark):
    rng, cols, per_vector = np.random.default_rng(4), [f"f{j}" for j in range(6)], []
    for n in (1_500, 24_000):
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.random((n, 6)))],
                                   "id long, " + ", ".join(f"{c} double" for c in cols))
        report = {}
        assert neighbors.knn_exact(df, "id", cols, 4, 25, report).count() == 4 * n
        per_vector.append(report["visits"] / n)
    assert per_vector[1] < 1.3 * per_vector[0]


def test_refs_within_a_limit_equal_the_plain_search():
    rng = np.random.default_rng(5)
    x, ids = 20_000 + rng.integers(0, 6, (700, 4)).astype(float), rng.permutation(700)
    q, n, d = neighbors._nearest(x, ids, x, 5)
    last = d.reshape(-1, 5)[:, -1]
    for limit in (last, np.full(700, np.inf)):
        got = neighbors._within(x, ids, x, limit, 5)
        assert all(np.array_equal(a, b) for a, b in zip(got, (q, n, d)))
    assert not len(neighbors._within(x, ids, x + 100, last, 5)[0])


def test_copies_are_limited_before_the_exchange(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(50)], "id long, x double")
    first = neighbors.Window.partitionBy("x").orderBy("id")
    plan = df.withColumn("r", F.row_number().over(first)).where("r <= 6")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_the_tree_splits_equal_values_by_key():
    x, ids = np.zeros((64, 2)), np.arange(64)
    x[:, 1] = np.arange(64) // 32
    tree = neighbors.grow(x, ids, 8)
    size = np.bincount(neighbors.route(tree, x, ids))
    assert len(size) == 8 and size.min() == size.max() == 8


# ---------------------------------------------------------------- ledger

def test_a_stopped_tuning_run_goes_on(spark, tmp_path):
    X, y = specs.FOREST_FINAL_PREDICTORS[:5], specs.LABEL
    d = sampling.kfold(R.model_input(spark, SF001), y, 2, 123)
    grid = {"mtry": [2, 3], "min_node_size": [5]}
    cands = models.expand_grid(**grid)
    fitted = []

    def fit(part, mtry, min_node_size, stop=None):
        if len(fitted) == stop:
            raise KeyboardInterrupt
        fitted.append(mtry)
        return models.fit_forest(part, X, y, mtry=mtry, min_node_size=min_node_size, num_trees=2, seed=1)

    def run(folder, stop=None, run="a"):
        return models.cross_validate(d, X, y, "fold", cands, lambda part, **kw: fit(part, stop=stop, **kw),
                                     resample=models.smote_part(X, y, k=3), parallelism=1, ledger=str(tmp_path / folder), run=run)

    with pytest.raises(KeyboardInterrupt):
        run("one", stop=3)
    book = ledger.FitLedger.__new__(ledger.FitLedger)
    book.spark, book.path = spark, str(tmp_path / "one")
    assert len(book.finished()) == 3 == len(fitted)
    # A fit that died while writing has no mark and is made again.
    f, c = book.finished()[0]
    (tmp_path / "one" / "scores" / f"fold={f}" / f"candidate={c}" / "_SUCCESS").unlink()
    before = len(fitted)
    cv = run("one")
    assert len(fitted) == before + 2 and cv.ledger.fits == 2
    again = run("one")
    assert len(fitted) == before + 2 and again.ledger.fits == 0
    whole = run("two")
    rows = lambda r: sorted(map(tuple, r.oof.collect()))
    assert rows(cv) == rows(whole) and len(rows(cv)) == 2 * d.count()
    assert cv.oof.where("id < 0").count() == 0
    with pytest.raises(ValueError, match="another run"):
        run("one", run="b")


def test_tuned_forest_refits_the_best_candidate(spark):
    X, y = specs.FOREST_FINAL_PREDICTORS[:5], specs.LABEL
    d = sampling.kfold(R.model_input(spark, SF001), y, 2, 123)
    cv, res, best, model = models.tune_forest(d, X, y, {"mtry": [1, 3], "min_node_size": [5]}, 2, k=3, seed=1)
    top = max(r.Accuracy for r in res.collect())
    assert best["Accuracy"] == top and model.stages[-1].getNumTrees == 2
    seen = cv.ledger.table("train/all", None)
    counts = {r[y]: r["count"] for r in seen.groupBy(y).count().collect()}
    assert counts[0] == counts[1] and seen.where("id >= 0").count() == d.count()
