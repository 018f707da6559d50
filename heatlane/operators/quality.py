"""Reports and checks: each is one combinable aggregate over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.functions import tokens as tk
from heatlane.operators.filters import over_group


def long_cells(df: DataFrame, cells: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(column, value, flag) rows, one per row and listed column.

    ``cells`` maps a column name to (value as text, flag).
    """
    structs = [
        F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"), flag.alias("flag"))
        for name, (value, flag) in cells.items()
    ]
    return df.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def bad_values(df: DataFrame, cells: Mapping[str, tuple[Column, Column]], top: int = 20) -> DataFrame:
    """The ``top`` most frequent values per column whose flag is set; ties by value.

    Counts are combined before the shuffle, and only ``top`` rows per column and
    task reach the ranking.
    """
    counts = (
        long_cells(df, cells)
        .where("flag")
        .groupBy("column", F.coalesce("value", F.lit("(NaN)")).alias("bad_value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), "bad_value")
    return counts.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= top).drop("__r")


def exclusion_report(*reasons: DataFrame, key: str = "race_id", reason: str = "reason") -> DataFrame:
    """All reasons per race, sorted, distinct, joined with `` / ``."""
    every = reasons[0].select(key, reason)
    for r in reasons[1:]:
        every = every.unionByName(r.select(key, reason))
    return every.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_set(reason)), " / ").alias(reason)
    )


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, rate."""
    stats = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(f"__{c}") for c in cols]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("__rows").alias("n"), (F.col("__rows") - F.col(f"__{c}")).alias("n_null"))
        for c in cols
    ]
    out = stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("null_rate", F.try_divide(F.col("n_null").cast("double"), F.col("n").cast("double")))


def null_rates_by(df: DataFrame, group: str, col: str) -> DataFrame:
    """Null rate of one column per group; the null group is kept."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) - F.count(col)).alias("n_null"),
        F.avg(F.col(col).isNull().cast("int")).alias("null_rate"),
    )


def worst_nulls(df: DataFrame, cols: Sequence[str], top: int = 10) -> DataFrame:
    return null_rates(df, cols).orderBy(F.col("null_rate").desc(), "column").limit(top)


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per category, the null category included."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def void_summary(df: DataFrame, key: str, cls: str = "rank_class") -> DataFrame:
    """One row: rows and races before, in void races, and after."""
    races = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"),
        F.bool_or(F.coalesce(F.col(cls) == "void", F.lit(False))).alias("__void"),
    )
    void = F.col("__void")

    def rows(keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col("__n"))), F.lit(0)).cast("long")

    return races.agg(
        rows(F.lit(True)).alias("rows_before"),
        F.count(key).alias("races_before"),
        rows(void).alias("rows_dropped"),
        F.count(F.when(void, F.col(key))).alias("races_dropped"),
        rows(~void).alias("rows_after"),
        F.count(F.when(~void, F.col(key))).alias("races_after"),
    )


def group_all_flag(df: DataFrame, key: str, predicate: Column, name: str) -> DataFrame:
    """1 when every row of the race satisfies the predicate; null counts as no. Rows without a key get null."""
    flag = F.bool_and(F.coalesce(predicate, F.lit(False))).over(over_group(df, key)).cast("int")
    return df.withColumn(name, F.when(F.col(key).isNotNull(), flag))


def group_checks(df: DataFrame, key: str, lane: str, not_null: Sequence[str] = (), size: int = 6) -> DataFrame:
    """Races that break an invariant: row count, distinct lanes, nulls."""
    groups = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(lane).alias("n_lanes"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"null_{c}") for c in not_null],
    )
    bad = (F.col("n_rows") != size) | (F.col("n_lanes") != size)
    for c in not_null:
        bad = bad | (F.col(f"null_{c}") > 0)
    return groups.where(bad)


def candidate_clashes(matches: DataFrame, row_id: str, value: str) -> DataFrame:
    """Rows with more than one distinct match."""
    return (
        matches.groupBy(row_id)
        .agg(F.count_distinct(value).alias("n_candidates"), F.min(value).alias("first_candidate"))
        .where("n_candidates > 1")
    )


def parse_stats(df: DataFrame, cells: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per column: rows, non-empty raw cells, cells that failed to parse, rate.

    ``cells`` maps a name to (raw text, parsed value).
    """
    structs = [
        F.struct(
            F.lit(name).alias("column"),
            F.coalesce(F.trim(raw.cast("string")) != "", F.lit(False)).alias("given"),
            parsed.isNotNull().alias("parsed"),
        )
        for name, (raw, parsed) in cells.items()
    ]
    long = df.select(F.explode(F.array(*structs)).alias("c")).select("c.*")
    failed = F.col("given") & ~F.col("parsed")
    return long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("given").cast("long")).alias("n_given"),
        F.sum(failed.cast("long")).alias("n_failed"),
        F.try_divide(F.sum(failed.cast("double")), F.sum(F.col("given").cast("double"))).alias("fail_rate"),
    )


def change_counts(df: DataFrame, file: str, old: str, new: str, fallback: str) -> DataFrame:
    """Dry run of a key migration: per file, rows, changed keys and fallbacks."""
    return df.groupBy(file).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((~F.col(old).eqNullSafe(F.col(new))).cast("long")).alias("n_changed"),
        F.sum(F.col(fallback).cast("long")).alias("n_fallback"),
    )


def run_summary(df: DataFrame, day: str, key: str) -> DataFrame:
    """One row: first and last day, rows, races."""
    races = df.groupBy(key).agg(
        F.min(day).alias("__a"), F.max(day).alias("__b"), F.count(F.lit(1)).alias("__n")
    )
    return races.agg(
        F.min("__a").alias("first_day"), F.max("__b").alias("last_day"),
        F.sum("__n").cast("long").alias("n_rows"), F.count(key).alias("n_races"),
    )


def class_counts(df: DataFrame, keys: Sequence[str], cls: str = "rank_class") -> DataFrame:
    """Rows per result class under their report names."""
    return df.groupBy(*keys).agg(
        *[F.count(F.when(F.col(cls) == c, 1)).alias(name) for c, name in tk.CLASS_COUNTERS.items()]
    )


def group_order(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """First day, venue and race number per race."""
    return df.groupBy(key).agg(*[F.min(c).alias(c) for c in cols])
