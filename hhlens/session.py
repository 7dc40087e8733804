"""Session construction and the shared folder used for lineage cuts and sinks."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "hhlens",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with AQE on, ANSI on (the default in Spark 4) and the UI off.

    On a cluster ``master`` stays None and the submit configuration wins; locally the
    caller passes ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.scheduler.mode": "FAIR",         # model fits run in pools of their own
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark.sparkContext)
    return spark


def ship_package(sc: SparkContext) -> None:
    """Sends this package's code to the executors, so that task code which refers to it runs on
    workers whose Python path lacks it.  Once per application; call it for a session that
    ``build_session`` did not make."""
    home = Path(__file__).resolve().parent
    name = f"{home.name}-{sc.applicationId}.zip"
    if any(f.rsplit("/", 1)[-1] == name for f in sc.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="hhlens-code-"), name)      # read by the driver only
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    sc.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    It is read from the session.  Only when the session has none (local runs and
    tests) a fresh local folder is made and registered, so ``checkpoint()`` and the
    sinks of this package always write to a place every executor can read.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hhlens-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffle_partitions(spark: SparkSession, least: int) -> Iterator[None]:
    """Shuffles planned inside deal their rows to ``least`` partitions or the session's own
    number, whichever is larger, so that a task's share does not grow with the input; the
    session's number is back afterwards.  (AQE still joins small partitions.)"""
    name = "spark.sql.shuffle.partitions"
    own = spark.conf.get(name)
    if least > int(own):
        spark.conf.set(name, str(least))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def cut_lineage(df):
    """Cut the lineage by writing the frame as Parquet under the shared checkpoint folder
    and scanning it back (never a local checkpoint).

    A reloaded table also starts with no inherited constraints, which keeps Catalyst's
    constraint inference small in plans that alias many NOT NULL columns, and its scan
    prunes columns.  The files live as long as the folder; ``drop_cut`` deletes one early."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_cut(df) -> None:
    """Deletes the files of a frame made by ``cut_lineage`` (it must no longer be read)."""
    spark = df.sparkSession
    base = shared_dir(spark).rstrip("/")
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if f.rsplit("/", 1)[-1].startswith("cut-") and f.split(":", 1)[-1].lstrip("/").startswith(
                base.split(":", 1)[-1].lstrip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
