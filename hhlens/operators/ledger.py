"""A resumable ledger of model fits.

A tuning run is a list of (fold, candidate) fits that may take days.  Each finished fit writes
its held-out scores as a partition of one table, ``scores/fold=f/candidate=c``; Spark's
committer marks the partition complete, so a fit counts as done only if all of its rows are
there.  A run that starts again on the same folder skips what is done and repeats what was
interrupted (overwriting only that partition).  The rows the fits read (the folds' table and
each fold's resampled training part) are stored the same way, so every run sees the same rows.

A manifest names what the run depends on; a folder of another run is refused.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


class FitLedger:
    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark, self.path = spark, path.rstrip("/")
        self.fits = 0                                   # fits made by this object
        text = json.dumps(manifest, sort_keys=True, default=str)
        # A text table of one line: written once, compared afterwards.
        there = f"{self.path}/manifest"
        if not self._complete(there):
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(there)
        elif spark.read.text(there).first()[0] != text:
            raise ValueError(f"{path} is the ledger of another run")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _complete(self, path: str) -> bool:
        fs, p = self._fs(f"{path}/_SUCCESS")
        return fs.exists(p)

    def has(self, name: str) -> bool:
        return self._complete(f"{self.path}/{name}")

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table made once per ledger."""
        path = f"{self.path}/{name}"
        if not self.has(name):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def tables(self, wanted: Mapping, parallelism: int = 4) -> dict:
        """``table`` of every (name, build), made on ``parallelism`` driver threads: many short
        jobs of one table leave room for those of another.  The first error is raised."""
        sc = self.spark.sparkContext

        def one(item: tuple) -> DataFrame:
            at, (name, build) = item
            sc.setLocalProperty("spark.scheduler.pool", f"fit-{at % max(1, parallelism)}")
            return self.table(name, build)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            return dict(zip(wanted, pool.map(one, enumerate(wanted.values()))))

    def _partition(self, fold, candidate) -> str:
        return f"{self.path}/scores/fold={fold}/candidate={candidate}"

    def done(self, fold, candidate) -> bool:
        return self._complete(self._partition(fold, candidate))

    def finished(self) -> list[tuple[int, int]]:
        fs, root = self._fs(f"{self.path}/scores")
        if not fs.exists(root):
            return []
        out = []
        for a in fs.listStatus(root):
            for b in fs.listStatus(a.getPath()):
                m = re.search(r"fold=(-?\d+)/candidate=(-?\d+)$", b.getPath().toString())
                if m and self.done(*m.groups()):
                    out.append((int(m[1]), int(m[2])))
        return sorted(out)

    def write(self, fold, candidate, scores: DataFrame) -> None:
        scores.write.mode("overwrite").parquet(self._partition(fold, candidate))

    def scores(self) -> DataFrame:
        """All finished fits' rows with their fold and candidate (partition columns)."""
        root = f"{self.path}/scores"
        return self.spark.read.option("basePath", root).parquet(*[self._partition(f, c) for f, c in self.finished()])

    def run(self, jobs: Sequence[tuple[int, int]], make: Callable[[int, int], DataFrame], parallelism: int = 4) -> None:
        """Makes every job that is not done: ``make(fold, candidate)`` fits a model and returns
        its held-out scores.  Jobs run on ``parallelism`` driver threads, each in a scheduler
        pool of its own (they share the executors evenly where the scheduler mode is FAIR).
        After a failure the jobs already running are finished, the first error is raised."""
        sc = self.spark.sparkContext
        failed: list[BaseException] = []

        def one(at: int) -> None:
            sc.setLocalProperty("spark.scheduler.pool", f"fit-{at % parallelism}")
            fold, candidate = jobs[at]
            if failed or self.done(fold, candidate):
                return
            try:
                self.write(fold, candidate, make(fold, candidate))
                self.fits += 1
            except BaseException as e:  # noqa: BLE001
                failed.append(e)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(one, range(len(jobs))))
        if failed:
            raise failed[0]


def run_name(*parts) -> str:
    """A folder name that depends on all that a run depends on."""
    return "ledger-" + hashlib.md5(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:16]

