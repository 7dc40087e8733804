"""Person -> household rollup compiled to ONE aggregation and ONE left join.

The survey scripts compute each household feature in its own grouped pass and then merge
41 small tables one after another.  Here every feature is a ``Feature`` spec and the whole
catalogue compiles to a single ``groupBy(key).agg(...)``: one shuffle on the key, with
partial (map-side) aggregation before it, whatever the number of features.  All
aggregates used (count, sum, avg, bool_or, min_by) are algebraic, so a household holding a
third of all person rows is reduced to one partial row per map task before the exchange.

Scopes
  ``all``     every member row of the household
  ``member``  rows of the designated member (the household head); aggregates see only them
Kinds
  count       count(*) of the scope                         BIGINT
  count_if    count of rows where a predicate is TRUE       BIGINT (NULL predicates skipped)
  sum         sum with na.rm; NULL when the scope is empty  BIGINT/DOUBLE
  avg         mean with na.rm; NULL when nothing to average DOUBLE
  any_nonzero any non-zero code, 0 when none                INT
  ratio       sum(num) / sum(den) with NULL for 0/0         DOUBLE
  member      the value on THE designated member row        DOUBLE
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("count", "count_if", "sum", "avg", "any_nonzero", "ratio", "member")


@dataclass(frozen=True)
class Feature:
    name: str
    scope: str                      # "all" | "member"
    kind: str
    expr: Column | None = None      # value / predicate; for ratio the numerator
    den: Column | None = None       # ratio denominator (a sum of these terms)
    num_terms: tuple = field(default=())   # ratio: summed separately, like sum(a)+sum(b)
    den_terms: tuple = field(default=())
    cast: str | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown feature kind {self.kind!r}")
        if self.scope not in ("all", "member"):
            raise ValueError(f"unknown scope {self.scope!r}")


def _sum_terms(terms: Sequence, scope_pred: Column | None) -> Column:
    parts = []
    for t in terms:
        c = F.col(t) if isinstance(t, str) else t
        if scope_pred is not None:
            c = F.when(scope_pred, c)
        parts.append(F.coalesce(F.sum(c), F.lit(0)))
    return reduce(lambda a, b: a + b, parts)


def feature_columns(features: Sequence[Feature], member_pred: Column,
                    member_order: Sequence[str]) -> list[Column]:
    """Aggregate expressions for one ``agg`` call.

    Member-value features share ONE ``min_by(struct(values), struct(order))`` restricted to
    member rows: the first member row by ``member_order`` supplies every value, so a
    household always yields one row (two heads never multiply rows) and a NULL value of
    that row survives inside the struct.
    """
    n_member = F.count_if(member_pred)
    out: list[Column] = []
    member_vals = [f for f in features if f.kind == "member"]
    for f in features:
        scope = member_pred if f.scope == "member" else None

        def scoped(c: Column) -> Column:
            return F.when(scope, c) if scope is not None else c

        if f.kind == "member":
            continue
        if f.kind == "count":
            c = n_member if scope is not None else F.count(F.lit(1))
        elif f.kind == "count_if":
            c = F.count_if(scoped(f.expr))
        elif f.kind == "sum":
            c = F.coalesce(F.sum(scoped(f.expr)), F.lit(0))
            if scope is not None:   # no member row -> the feature is absent (NULL)
                c = F.when(n_member > 0, c)
        elif f.kind == "avg":
            c = F.avg(scoped(f.expr))
        elif f.kind == "any_nonzero":
            c = F.coalesce(F.bool_or(scoped(f.expr) != 0), F.lit(False)).cast("int")
            if scope is not None:
                c = F.when(n_member > 0, c)
        elif f.kind == "ratio":
            num = _sum_terms(f.num_terms or (f.expr,), scope)
            den = _sum_terms(f.den_terms or (f.den,), scope)
            c = F.try_divide(num.cast("double"), den.cast("double"))
        if f.cast:
            c = c.cast(f.cast)
        out.append(c.alias(f.name))
    if member_vals:
        vals = F.struct(*[(f.expr.cast(f.cast) if f.cast else f.expr).alias(f.name)
                          for f in member_vals])
        order = F.struct(*[F.col(c) for c in member_order])
        # min_by skips rows whose ordering is NULL: non-member rows never win.
        out.append(F.min_by(F.when(member_pred, vals), F.when(member_pred, order))
                   .alias("__member"))
    return out


def rollup(persons: DataFrame, key: str, features: Sequence[Feature], member_pred: Column,
           member_order: Sequence[str], split_member: bool = True) -> DataFrame:
    """One row per key with every feature.

    Default: ONE aggregate (one shuffle on ``key``).  The member-value struct makes Spark
    use a sort-based aggregate for the whole call; ``split_member=True`` instead runs the
    other features in a hash aggregate and the member values in a sort-based aggregate
    over member rows only, joined on the key (both sides arrive hash-partitioned on it)."""
    names = [f.name for f in features]
    has_member = any(f.kind == "member" for f in features)
    if split_member and has_member and any(f.kind != "member" for f in features):
        plain = [f for f in features if f.kind != "member"]
        mem = [f for f in features if f.kind == "member"]
        a = persons.groupBy(key).agg(*feature_columns(plain, member_pred, member_order))
        b = (persons.where(member_pred).groupBy(key)
             .agg(*feature_columns(mem, F.lit(True), member_order))
             .select(key, *[F.col(f"__member.{f.name}").alias(f.name) for f in mem]))
        return a.join(b, on=key, how="left").select(key, *names)
    cols = feature_columns(features, member_pred, member_order)
    agg = persons.groupBy(key).agg(*cols)
    sel = [F.col(key)] + [
        (F.col(f"__member.{n}") if f.kind == "member" else F.col(n)).alias(n)
        for n, f in zip(names, features)]
    return agg.select(*sel) if has_member else agg.select(key, *names)


def attach(base: DataFrame, feats: DataFrame, key: str, drop: Sequence[str] = (),
           fill_zero: Sequence[str] = ()) -> DataFrame:
    """``merge(base, feats, all.x=TRUE)`` + drop + fill of the named columns only.

    ``feats`` is unique on ``key`` by construction (it is the output of one groupBy), so the
    left join cannot multiply base rows and neither side can be skewed on the key.
    """
    out = base.drop(*drop).join(feats, on=key, how="left")
    fill = [c for c in fill_zero if c in out.columns]
    if fill:
        out = out.select(*[F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)).alias(c)
                           if c in fill else F.col(c) for c in out.columns])
    return out


def left_join_all(base: DataFrame, tables: Sequence[DataFrame], key: str,
                  check_unique: bool = True) -> DataFrame:
    """Generic ``Reduce(merge(all.x=TRUE))`` over several keyed tables.

    With ``check_unique`` every right table is first verified to hold one row per key (a
    duplicate would multiply base rows, which the survey scripts silently allow).  Prefer
    ``rollup`` + ``attach``: this form shuffles once per table.
    """
    out = base
    for t in tables:
        if check_unique:
            dup = t.groupBy(key).count().where("count > 1").limit(1).count()
            if dup:
                raise ValueError(f"right table is not unique on {key!r}")
        out = out.join(t, on=key, how="left")
    return out
