"""Set operations by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from heatlane.operators.windows import keep_first, keep_last


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def add_new_rows(history: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History plus the fresh rows whose key it lacks."""
    new = fresh.join(history.select(*keys).distinct(), list(keys), "left_anti")
    return union_all(history, new)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def subtract_ids(df: DataFrame, key: str, *bad: DataFrame) -> DataFrame:
    """Remove every row whose id is in any of the lists."""
    ids = union_all(*[b.select(key) for b in bad]).distinct()
    return df.join(ids, key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert or replace: the last version per key stays."""
    return keep_last(union_all(old, new), keys, order)


def first_per_place(df: DataFrame, place: str, order: Sequence[str]) -> DataFrame:
    """One row per venue when a page lists it twice."""
    return keep_first(df, [place], order)
