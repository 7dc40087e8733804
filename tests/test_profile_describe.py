"""Profiling and descriptive tables."""

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from hhlens.operators import describe, ordered, profile


def test_exact_quantiles_match_numpy_and_buckets(spark):
    rng = np.random.default_rng(1)
    vals = [float(v) for v in rng.integers(0, 50, 3000)] + [7.0] * 2000   # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for rows in (10_000_000, 7):
        q = {r["p"]: r["q"] for r in ordered.exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9],
                                                             bucket_rows=rows).collect()}
        for p, v in q.items():
            assert abs(v - np.quantile(vals, p)) < 1e-9


def test_prefix_counts_multi_bucket_equals_single(spark):
    df = spark.range(0, 500).select((F.col("id") % 97).cast("double").alias("value"),
                                    F.lit(1).alias("cnt"))
    vc = df.groupBy("value").agg(F.sum("cnt").alias("cnt"))
    a = ordered.prefix_counts(vc, [], "value", "cnt", bucket_rows=10).orderBy("value").collect()
    b = ordered.prefix_counts(vc, [], "value", "cnt", bucket_rows=10_000).orderBy("value").collect()
    assert [r["cum"] for r in a] == [r["cum"] for r in b]
    assert a[-1]["cum"] == 500


def test_null_counts_and_outliers(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1), (3.0, 1), (100.0, None)], "a double, b int")
    nc = {r["variable"]: r["n"] for r in profile.null_counts(df).collect()}
    assert nc == {"b": 2}
    out = {r["variable"]: r["n_outliers"] for r in profile.iqr_outliers(df, ["a", "b"]).collect()}
    assert out == {"a": 1, "b": 0}


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.3, 5.0)], "a double, b double, c double")
    r = {(x["var1"], x["var2"]): x["r"] for x in profile.correlation_pairs(df).collect()}
    assert r[("a", "c")] is None and r[("b", "c")] is None and r[("a", "b")] > 0.99


def test_fill_shares_sum_to_one(spark):
    df = spark.createDataFrame([(i % 4, i % 2) for i in range(40)] + [(11, 1)], "x int, y int")
    out = describe.fill_shares(df, "x", "y", (0, 10))
    sums = out.groupBy("x").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums)
    assert out.where("x = 11").count() == 0


def test_department_without_positives_sorted_last(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (3, 1)], "Depto int, Pobre int")
    out = {(r["Depto"], r["Pobre"]): r for r in describe.ordered_group_shares(df, "Depto", "Pobre").collect()}
    assert out[(2, 0)]["ord"] is None
    assert out[(3, 1)]["ord"] == 1 and out[(1, 1)]["ord"] == 2
    assert out[(1, 1)]["Prop_label"] == "50%" and out[(3, 1)]["Prop_label"] == "100%"


def test_many_groups_rank_like_few(spark, monkeypatch):
    rows = [(g, int(i < g % 5)) for g in range(1, 60) for i in range(6)] + [(None, 1), (None, 0)]
    df = spark.createDataFrame(rows, "Depto int, Pobre int")
    key = lambda r: (r["Depto"] is None, r["Depto"] or 0, r["Pobre"])
    one = sorted(describe.ordered_group_shares(df, "Depto", "Pobre").collect(), key=key)
    monkeypatch.setattr(describe, "RANK_GROUPS", 5)
    many = sorted(describe.ordered_group_shares(df, "Depto", "Pobre").collect(), key=key)
    assert one == many
    ranked = {r["ord"] for r in one if r["Pobre"] == 1}
    assert ranked == set(range(1, len(ranked) + 1)) and any(r["Depto"] is None and r["ord"] for r in one)


def test_density_without_broadcast_and_with_a_null_group(spark, monkeypatch):
    rows = [(g, float(10 + (7 * i) % 23)) for i in range(80) for g in ("a", "b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    get = lambda: {(r["g"], r["i"]): r["density"] for r in describe.kde(df, "x", ["g"], 16).collect()}
    small = get()
    monkeypatch.setattr(describe, "BROADCAST_ROWS", 0)
    large = get()
    assert small.keys() == large.keys() and len(small) == 48
    assert all(abs(small[k] - large[k]) < 1e-12 for k in small)
    assert all(abs(small[None, i] - small["a", i]) < 1e-12 for i in range(16))


def test_log10_density_drops_non_positive(spark):
    df = spark.createDataFrame([(0.0,), (-5.0,), (10.0,), (100.0,), (1000.0,)], "x double")
    k = describe.kde(df, "x", n_grid=16, log10=True).orderBy("i").collect()
    assert abs(k[0]["x"] - 1.0) < 1e-12 and abs(k[-1]["x"] - 3.0) < 1e-12
    area = sum(r["density"] for r in k) * (2.0 / 15)
    assert 0.3 < area < 1.2


def test_poverty_by_department_smoke(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() > 0
    shares = out.groupBy("Depto").agg(F.sum("Prop").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 1e-6 for r in shares)
    assert SF001 in E.SMOKE_DIR
