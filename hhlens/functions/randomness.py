"""Portable, seedable randomness.

``rand()`` depends on partitioning and task order, so a retried or re-planned task can
draw different numbers.  Every random choice here is a pure function of a row key and a
seed: the first 32 bits of ``md5(key || '|' || seed)``.  The same number is produced by
any engine that has md5 (DuckDB: ``('0x'||substr(md5(..),1,8))::BIGINT``), which is what
makes splits, folds and oversampling checkable against SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_hash(key, seed) -> Column:
    """Integer in [0, 2^32) from ``key`` and ``seed`` (both rendered as strings)."""
    k = F.col(key) if isinstance(key, str) else key
    s = F.concat(k.cast("string"), F.lit("|"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")
