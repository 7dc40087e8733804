"""Bucketed stores, frequent levels and approximate neighbours."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hhlens.operators import heavy, neighbors, neighbors_lsh
from hhlens.plans import households as hh
from hhlens.session import scratch_path
from hhlens.sources import fixtures as fx
from hhlens.sources import io
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_over_bucketed_stores_has_no_exchange(spark):
    persons, homes = fx.personas(spark, SF001), fx.hogares(spark, SF001)
    want = {tuple(r) for r in hh.household_table(persons, homes, member_order=fx.HEAD_ORDER).collect()}
    n, back = io.bucket_count(spark, persons, homes), []
    assert n >= spark.sparkContext.defaultParallelism
    for name, df in (("p", persons), ("h", homes)):
        path = scratch_path(spark, name)
        assert io.write_bucketed(df, path, "id", n)
        back.append(io.read_bucketed(spark, path, "id", n))
        assert io.read_bucketed(spark, path, "id", n).schema.simpleString() == df.schema.simpleString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full = hh.household_table(*back, member_order=fx.HEAD_ORDER)
        assert "Exchange" not in _plan(full)
        assert "Exchange" in _plan(hh.household_table(persons, homes, member_order=fx.HEAD_ORDER))
        assert {tuple(r) for r in full.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_hot_key_is_not_bucketed(spark, monkeypatch):
    monkeypatch.setattr(io, "BUCKET_ROWS", 100)
    monkeypatch.setattr(io, "BUCKET_SKEW", 3)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"), F.lit(1).alias("v"))
    path = scratch_path(spark, "hot")
    assert not io.write_bucketed(df, path, "id", 16)
    assert io.read_store(spark, path).groupBy("id").count().where("id = 7").first()[1] == 1001


def test_bucketed_store_of_nulls_odd_names_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0, "x"), (3, None, "y"), (3, 2.0, None)], "`a key` bigint, `b.c` double, d string")
    path, none = scratch_path(spark, "odd"), scratch_path(spark, "none")
    assert io.write_bucketed(df, path, "a key", 4)
    assert sorted(map(repr, io.read_bucketed(spark, path, "a key", 4).collect())) == sorted(map(repr, df.collect()))
    assert not io.write_bucketed(df.where("false"), none, "a key", 4)
    assert io.read_store(spark, none).schema == df.schema and io.read_store(spark, none).count() == 0


def _want(values, top):
    return sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:top]


@pytest.mark.parametrize("capacity", [4, 16, 1024])
@pytest.mark.parametrize("direct", [1, 64])
def test_top_levels_equal_a_full_count(spark, monkeypatch, capacity, direct):
    from hhlens.operators import reduction

    monkeypatch.setattr(reduction, "DIRECT", direct)
    monkeypatch.setattr(heavy, "parts_for", lambda df: reduction.parts_for(df, direct))
    rng = np.random.default_rng(3)
    zipf = [f"w{x}" for x in np.minimum(rng.zipf(1.3, 4000), 900)]
    flat = [f"u{i}" for i in range(4000)]                       # no frequent level: must be counted in full
    tied = [f"t{i % 40}" for i in range(4000)]
    hot = ["h" if i % 3 == 0 else None if i % 3 == 1 else f"x{i}" for i in range(4000)]
    df = spark.createDataFrame(list(zip(zipf, flat, tied, hot, [None] * 4000)),
                               "zipf string, flat string, tied string, hot string, none string").repartition(9)
    report = {}
    got = heavy.top_levels(df, df.columns, 3, capacity, report).orderBy("variable", "rank").collect()
    for c, values in (("zipf", zipf), ("flat", flat), ("tied", tied), ("hot", hot), ("none", [])):
        assert [(r.level, r.n) for r in got if r.variable == c] == _want(values, 3), c
        assert [r.rank for r in got if r.variable == c] == list(range(1, len(_want(values, 3)) + 1))
    assert "flat" in report["counted_in_full"]
    if capacity == 1024:
        assert "zipf" not in report["counted_in_full"] and "tied" not in report["counted_in_full"]


def test_a_frequent_level_is_decided_without_counting_all(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, "a").when(F.col("id") % 5 == 0, "b")
                                    .otherwise(F.col("id").cast("string")).alias("v"))
    report = {}
    got = heavy.top_levels(df, ["v"], 2, 256, report).orderBy("rank").collect()
    assert [(r.level, r.n) for r in got] == [("a", 25_000), ("b", 5_000)] and not report["counted_in_full"]


def test_top_levels_of_no_rows(spark):
    assert heavy.top_levels(spark.createDataFrame([], "a string, b int"), ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        heavy.top_levels(spark.createDataFrame([], "a string"), ["a"], 5, 4)


@pytest.mark.parametrize("name", ["clusters", "uniform", "copies"])
def test_lsh_neighbours_reach_the_recall(spark, name):
    rng = np.random.default_rng(11)
    n, d = 3000, 8
    x = {"clusters": rng.standard_normal((n, d)) * 0.2 + rng.integers(0, 12, (n, 1)),
         "uniform": rng.random((n, d)),
         "copies": np.where(rng.random((n, 1)) < 1 / 3, 0.5, rng.integers(0, 4, (n, d)).astype(float))}[name]
    cols = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(n, None, *[0.0] * (d - 1))],
                               "id bigint, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    report = {}
    got = neighbors_lsh.knn_lsh(df, "id", cols, 4, 0.9, leaf_rows=128, report=report).collect()
    want = {(r.id, r.nn_key): r.d2 for r in neighbors.knn_exact(df, "id", cols, 4).collect()}
    assert len({(r.id, r.nn_key) for r in got}) == len(got) and n not in {r.id for r in got}
    assert Counter(r.id for r in got) == {i: 4 for i in range(n)}
    for r in got:                                               # distances are exact
        if (r.id, r.nn_key) in want:
            assert r.d2 == want[r.id, r.nn_key]
    worst = {}
    for (i, _), d2 in want.items():
        worst[i] = max(worst.get(i, 0.0), d2)
    assert sum(r.d2 <= worst[r.id] for r in got) / len(want) >= 0.9, report


def test_lsh_gives_way_to_the_exact_search(spark, monkeypatch):
    monkeypatch.setattr(neighbors_lsh, "MAX_TABLES", 1)
    x = np.random.default_rng(5).random((1500, 10))
    cols = [f"c{i}" for i in range(10)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id bigint, " + ", ".join(f"{c} double" for c in cols))
    report = {}
    got = {(r.id, r.nn_rank): r.nn_key for r in neighbors_lsh.knn_lsh(df, "id", cols, 3, 0.99, leaf_rows=64, report=report).collect()}
    assert report["tables"] == 0
    assert got == {(r.id, r.nn_rank): r.nn_key for r in neighbors.knn_exact(df, "id", cols, 3).collect()}
    assert neighbors_lsh.knn_lsh(df.where("false"), "id", cols, 3).count() == 0
