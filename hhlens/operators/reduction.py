"""Two-level reduction of what tasks report.

Every task reports one partial row per key.  With many tasks these rows must not all meet in
one group, so they are first combined within about sqrt(tasks) parts per key, then across the
parts: no group ever holds more than about the square root of the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

#: Partial rows of one key that may meet in one group without a first level.
DIRECT = 64


def parts_for(df: DataFrame, direct: int = DIRECT) -> int:
    """Parts per key for the tasks that will read ``df`` (1: no first level is needed)."""
    tasks = df.rdd.getNumPartitions()
    return 1 if tasks <= direct else math.ceil(math.sqrt(tasks))


def task_part(parts: int) -> int:
    """The part that the running task's rows belong to."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return (ctx.partitionId() if ctx else 0) % parts


def combine(partial: DataFrame, keys: Sequence[str], add: Callable[[pa.Table], pa.Table], parts: int,
            last: Callable[[pa.Table], pa.Table] | None = None, schema: str | None = None) -> DataFrame:
    """``partial`` (keys..., ``part``, values...) combined per key by ``add``, which maps a table
    of one key's rows to one row of the same columns.  ``last`` (default ``add``) makes the
    final row, of ``schema`` where that differs."""
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in partial.schema.fields)
    if parts > 1:
        partial = partial.groupBy(*keys, "part").applyInArrow(add, own)
    return partial.groupBy(*keys).applyInArrow(last or add, schema or own)
