"""The session sends the package to its workers."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from conftest import SF001
from hhlens.session import ship_package

ROOT = str(Path(__file__).resolve().parent.parent)

PROGRAM = f"""
import sys
sys.path.insert(0, {ROOT!r})
from hhlens.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
from hhlens.operators import neighbors_lsh, linear_tuning
from pyspark.sql import functions as F
rows = spark.range(60).select("id", (F.col("id") % 2).alias("label"), (F.col("id") % 3).alias("fold"), (F.col("id") * 7 % 11).alias("a"))
cv = linear_tuning.cross_validate_linear(rows, ["a"], "label", "fold", [{{"alpha": 0.0, "reg": 0.1}}])
print("models", len(cv.fits))
"""


def test_tasks_find_the_package_without_a_python_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "models 3" in got.stdout, got.stderr[-2000:]


def test_the_package_is_sent_once(spark):
    before = list(spark.sparkContext.listFiles)
    ship_package(spark.sparkContext)
    assert list(spark.sparkContext.listFiles) == before
    assert sum("hhlens-" in f.rsplit("/", 1)[-1] for f in before) == 1


def test_a_stored_tables_shuffles_grow_with_its_input(spark, monkeypatch):
    from hhlens.plans import registry

    own, seen = spark.conf.get("spark.sql.shuffle.partitions"), []

    def build():
        seen.append(int(spark.conf.get("spark.sql.shuffle.partitions")))
        if len(seen) == 2:
            raise ValueError("no table")
        return spark.range(3)

    monkeypatch.setattr(registry, "_inputs", lambda *_: (("a", 1000, 0), ("b", 501, 0)))
    monkeypatch.setattr(registry, "INPUT_BYTES", 50)
    assert registry._stored(spark, SF001, "grown", build).count() == 3
    with pytest.raises(ValueError, match="no table"):
        registry._stored(spark, SF001, "failed", build)
    monkeypatch.setattr(registry, "INPUT_BYTES", 1 << 20)
    registry._stored(spark, SF001, "small", build)
    assert seen == [31, 31, int(own)] and spark.conf.get("spark.sql.shuffle.partitions") == own
