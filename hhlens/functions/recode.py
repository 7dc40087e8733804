"""Recodes with the missing-value rules of the survey scripts.

R and Spark disagree on NULL in a few places; every helper here states the rule it keeps:

* ``inset``   - ``x %in% set`` is FALSE on NA, so the flag is 0, never NULL.
* ``flag``    - ``as.numeric(x == v)`` keeps NA, so the flag stays NULL.
* ``guard``   - ``ifelse(is.na(x), 0, x)``.
* ``null_guarded`` - ``ifelse(is.na(a), 0, expr)``: a test on one column, value of another.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def inset(x, values: Iterable) -> Column:
    """``as.numeric(x %in% values)``: 1/0, NULL counts as not in the set."""
    return F.coalesce(_c(x).isin(list(values)), F.lit(False)).cast("int")


def flag(pred: Column) -> Column:
    """``as.numeric(pred)``: 1/0, NULL stays NULL."""
    return pred.cast("int")


def guard(x, default=0) -> Column:
    """``ifelse(is.na(x), default, x)``."""
    return F.coalesce(_c(x), F.lit(default))


def null_guarded(test, value: Column, default=0) -> Column:
    """``ifelse(is.na(test), default, value)``: the guard column differs from the value."""
    return F.when(_c(test).isNull(), F.lit(default)).otherwise(value)


def is_missing(x, dtype=None) -> Column:
    """``is.na(x)``: NULL, and NaN for floating columns."""
    c = _c(x)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def square(x) -> Column:
    """``x^2`` in double precision (no integer overflow under ANSI)."""
    c = _c(x).cast("double")
    return c * c


def dummy(x, level) -> Column:
    """One indicator of ``dummy_cols(..., ignore_na=TRUE)``: 1 on the level, 0 on other
    known values, NULL where the code is NULL (as a double, like ``as.numeric``)."""
    c = _c(x)
    return F.when(c == F.lit(level), F.lit(1.0)).when(c.isNotNull(), F.lit(0.0))




def any_nonzero(x) -> Column:
    """Aggregate ``as.integer(any(x, na.rm=TRUE))``: any non-zero code, 0 when none."""
    return F.coalesce(F.bool_or(_c(x) != 0), F.lit(False)).cast("int")


def decode(x, mapping: Mapping, default=None) -> Column:
    """Code -> label with a fixed mapping (``factor(x, levels, labels)``)."""
    c = _c(x)
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default)) if default is not None else out


def threshold(p, t: float = 0.5) -> Column:
    """``ifelse(p > t, 1, 0)``: strictly greater, a score equal to ``t`` is class 0."""
    return (_c(p) > F.lit(float(t))).cast("int")


def dummy_levels(df, cols, max_levels: int = 1000) -> dict:
    """Known (non-NULL) levels of each code column, sorted, from ONE aggregate over the
    unpivoted columns.  The result is bounded by ``max_levels`` per column (a code with
    more levels is not a factor and raises)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "variable", "level").where(F.col("level").isNotNull())
    known = long.distinct()
    for r in known.groupBy("variable").count().collect():   # one row per column
        if r["count"] > max_levels:
            raise ValueError(f"{r['variable']} has {r['count']} levels (> {max_levels})")
    rows = known.groupBy("variable").agg(F.collect_list("level").alias("levels")).collect()
    out = {}
    for r in rows:
        dtype = dict(df.dtypes)[r["variable"]]
        conv = int if dtype in ("int", "bigint", "smallint", "tinyint") else \
            (float if dtype in ("double", "float") else str)
        out[r["variable"]] = sorted(conv(v) for v in r["levels"])
    return {c: out.get(c, []) for c in cols}


def add_dummies(df, levels: dict, sep: str = "_"):
    """``dummy_cols(remove_first_dummy=FALSE, ignore_na=TRUE, remove_selected_columns=FALSE)``
    with the given levels (take them from the training side so both sides share columns).
    A level absent from this table still gets its column, all 0 on known codes."""
    new = []
    for c, lv in levels.items():
        for v in lv:
            name = f"{c}{sep}{v}".replace(".", "_").replace("-", "m")
            new.append(dummy(c, v).alias(name))
    return df.select("*", *new)
