"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

DECIMALS = 6


def rounded(df: DataFrame, decimals: int = DECIMALS, skip=()) -> DataFrame:
    """Round floating columns so results compare across engines (summation order differs)."""
    return df.select(*[
        F.round(F.col(f.name), decimals).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip else F.col(f.name)
        for f in df.schema.fields])
