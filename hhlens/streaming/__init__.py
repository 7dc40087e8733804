"""Streaming.

The survey analysis has no streaming step: every input is a finished file and every
output a batch table.  Nothing here adds a streaming operator of its own; the one helper
feeds household files that arrive over time through the SAME prediction sink as the batch
flow (``sources.io.write_predictions`` semantics: ``id,pobre`` CSV parts), so a fitted
scorer can label new survey waves incrementally with exactly-once file output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def predictions_stream(spark: SparkSession, source_dir: str, schema: str, score: Column,
                       sink_dir: str, checkpoint: str, threshold: float = 0.5,
                       key: str = "id", fmt: str = "parquet"):
    """Start a query that scores each new household file and appends ``id,pobre`` rows.

    ``score`` is a Column over the household columns (e.g. ``models.linear_score`` of a
    fitted coefficient vector, or ``models.model_score_column``); ``checkpoint`` must be on
    shared storage.  Returns the ``StreamingQuery``."""
    src: DataFrame = spark.readStream.schema(schema).format(fmt).load(source_dir)
    out = src.select(F.col(key).alias("id"), (score > F.lit(float(threshold))).cast("int").alias("pobre"))
    return (out.writeStream.format("csv").option("header", True)
            .option("checkpointLocation", checkpoint).outputMode("append").start(sink_dir))
