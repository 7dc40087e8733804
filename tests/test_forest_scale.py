"""The forest's fits do not walk trees again, and the folds' training parts are made together."""

import threading

import numpy as np
import pytest

from pyspark.sql import functions as F

from hhlens.operators import models


def _rows(spark, n=400):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + rng.normal(size=n) > 0.5).astype(int)
    return spark.createDataFrame([(i, int(v), i % 2, *map(float, r)) for i, (v, r) in enumerate(zip(y, x))],
                                 "id bigint, y int, fold int, a double, b double, c double, d double")


def test_rows_remember_their_node_and_the_forest_is_the_same(spark):
    X, d = ["a", "b", "c", "d"], _rows(spark).withColumnRenamed("y", "label").selectExpr("*", "double(label) AS y")
    p = models.forest_pipeline(X, "y", 2, 1, num_trees=3, max_depth=8)
    assert p.getStages()[1].getCacheNodeIds()
    got = p.fit(d).stages[-1]
    p.getStages()[1].setCacheNodeIds(False)
    assert got.toDebugString.split("\n", 1)[1] == p.fit(d).stages[-1].toDebugString.split("\n", 1)[1]


def test_training_parts_of_the_folds_are_made_together(spark):
    meet = threading.Barrier(2, timeout=60)                  # one after the other never meet

    def resample(part, fold):
        meet.wait()
        return part.select("id", "y", "a", "b")

    cv = models.cross_validate(_rows(spark), ["a", "b"], "y", "fold", [{"reg": 0.1}],
                               lambda part, reg: models.fit_logistic(part, ["a", "b"], "y", reg), resample=resample)
    assert cv.n_fits == 2 and cv.oof.count() == 400


def test_an_error_in_a_training_part_is_raised(spark):
    def resample(part, fold):
        raise ValueError("no part")

    with pytest.raises(ValueError, match="no part"):
        models.cross_validate(_rows(spark), ["a"], "y", "fold", [{"reg": 0.1}], None, resample=resample)


def test_the_refits_part_is_made_beside_those_of_the_folds(spark):
    meet = threading.Barrier(3, timeout=60)                  # two folds and all rows

    def resample(part, fold):
        meet.wait()
        own = part.select("id", "y", "a", "b")
        return own.unionByName(own.limit(5).withColumn("id", -F.col("id") - 1).coalesce(1))

    cv = models.cross_validate(_rows(spark, 4000), ["a", "b"], "y", "fold", [{"reg": 0.1}],
                               lambda part, reg: models.fit_logistic(part, ["a", "b"], "y", reg), resample=resample, whole=True)
    assert cv.whole.count() == 4005 and cv.whole.select("id").distinct().count() == 4005
