"""Generic keyed left joins and incremental scoring into the prediction sink."""

import pytest
from pyspark.sql import functions as F

from hhlens.operators.rollup import left_join_all
from hhlens.session import scratch_path
from hhlens.streaming import predictions_stream


def test_left_join_all_keeps_base_rows_and_rejects_duplicates(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    a = spark.createDataFrame([(1, 10)], "id bigint, a int")
    b = spark.createDataFrame([(2, 20), (3, 30)], "id bigint, b int")
    out = {r["id"]: (r["a"], r["b"]) for r in left_join_all(base, [a, b], "id").collect()}
    assert out == {1: (10, None), 2: (None, 20), 3: (None, 30)}
    dup = spark.createDataFrame([(1, 1), (1, 2)], "id bigint, c int")
    with pytest.raises(ValueError):
        left_join_all(base, [dup], "id")


def test_predictions_stream_scores_new_files(spark):
    src, sink, ck = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ck"))
    spark.createDataFrame([(1, 0.9), (2, 0.2)], "id bigint, s double").write.parquet(src + "/part1")
    q = predictions_stream(spark, src + "/part1", "id bigint, s double", F.col("s"), sink, ck)
    q.processAllAvailable()
    q.stop()
    got = sorted(tuple(r) for r in spark.read.schema("id bigint, pobre int").option("header", True).csv(sink).collect())
    assert got == [(1, 1), (2, 0)]
