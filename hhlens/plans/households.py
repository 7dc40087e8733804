"""T1: persons + households -> household feature table (one aggregate, one join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hhlens.operators.rollup import attach, rollup
from hhlens.plans import specs


def person_features(persons: DataFrame, names: Sequence[str] | None = None,
                    *, member_order: Sequence[str],
                    key: str = specs.KEY, split_member: bool = True) -> DataFrame:
    """All (or the named) household features from the person table, one row per household
    that has at least one person."""
    feats = specs.features()
    if names is not None:
        want = set(names)
        feats = [f for f in feats if f.name in want]
    return rollup(persons, key, feats, specs.head_pred(), list(member_order), split_member)


def household_table(persons: DataFrame, households: DataFrame, *, member_order: Sequence[str],
                    joined: Sequence[str] = tuple(specs.JOINED), key: str = specs.KEY,
                    split_member: bool = True) -> DataFrame:
    """``*_hogares_full``: households minus the dropped columns, plus the merged features,
    with the named columns filled with 0 (households without persons keep NULL elsewhere)."""
    feats = person_features(persons, joined, member_order=member_order, key=key,
                            split_member=split_member).select(key, *joined)
    return attach(households, feats, key, drop=specs.DROPPED, fill_zero=specs.FILL_ZERO)
