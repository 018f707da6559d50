"""Generations of a motor: zero transitions, gap rule, effective ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.operators.windows import transition_events


def accept_by_gap(days: Column, gap: int) -> Column:
    """Fold sorted distinct days: keep one only if it lies at least ``gap`` days
    after the last day kept."""
    return F.aggregate(
        F.array_sort(days),
        F.array().cast("array<date>"),
        lambda kept, d: F.when(
            (F.size(kept) == 0) | (F.datediff(d, F.try_element_at(kept, F.lit(-1))) >= gap),
            F.concat(kept, F.array(d)),
        ).otherwise(kept),
    )


def gap_filter(df: DataFrame, keys: Sequence[str], day: str, gap: int = 180) -> DataFrame:
    """Accepted days per key.

    The days of a key are collected as a set: at most one entry per calendar
    day, however many rows the key holds.
    """
    kept = df.groupBy(*keys).agg(F.collect_set(day).alias("__days"))
    return kept.select(*keys, F.explode(accept_by_gap(F.col("__days"), gap)).alias(day))


def generation_starts(snapshots: DataFrame, keys: Sequence[str], day: str, rate: str, gap: int = 180,
                      use_transition: bool = True) -> DataFrame:
    """Accepted start days of new generations.

    Candidates are days on which the rate falls to zero, or every zero day.
    """
    known = snapshots.where(F.col(rate).isNotNull())
    if use_transition:
        candidates = transition_events(known, keys, [day], rate)
    else:
        candidates = known.where(F.col(rate) == 0)
    return gap_filter(candidates, keys, day, gap)


def effective_ranges(snapshots: DataFrame, starts: DataFrame, keys: Sequence[str], day: str, rate: str) -> DataFrame:
    """First observation and accepted days as [from, to] ranges, the last open.

    Per key the starts are again a set of calendar days, so ranges come from
    array positions of one aggregated row.
    """
    first = (
        snapshots.where(F.col(rate).isNotNull()).groupBy(*keys).agg(F.min(day).alias("__first"))
    )
    known = starts.groupBy(*keys).agg(F.collect_set(day).alias("__days"))
    every = first.join(known, list(keys), "left").withColumn(
        "__starts",
        F.array_sort(
            F.array_union(F.array("__first"), F.coalesce(F.col("__days"), F.array().cast("array<date>")))
        ),
    )
    rows = every.select(*keys, "__starts", F.posexplode("__starts").alias("__i", "effective_from"))
    nxt = F.get(F.col("__starts"), F.col("__i") + 1)
    return rows.select(
        *keys,
        (F.col("__i") + 1).cast("long").alias("idx_motor"),
        "effective_from",
        F.date_sub(nxt, 1).alias("effective_to"),
    )


def motor_id(code: Column, number: Column, generation: Column) -> Column:
    """Two digits each for venue, motor number and generation."""
    return F.format_string("%02d%02d%02d", code.cast("long"), number.cast("long"), generation.cast("long"))


def motor_id_map(snapshots: DataFrame, code="code", number="motor_number", day="date",
                 rate="motor_2rentai_rate", gap: int = 180, use_transition: bool = True) -> DataFrame:
    keys = [code, number]
    starts = generation_starts(snapshots, keys, day, rate, gap, use_transition)
    ranges = effective_ranges(snapshots, starts, keys, day, rate)
    return ranges.withColumn("motor_id", motor_id(F.col(code), F.col(number), F.col("idx_motor")))
