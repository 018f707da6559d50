"""Signals that move during a day: each race sees only the races before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.operators.joins import lookup_join
from heatlane.operators.ordered import SPLIT_ROWS, median_before, totals_before

LANES = range(1, 7)
KINDS = {"win": 1, "top2": 2, "top3": 3}


def valid_result(ranks: Sequence[str], flag: str | None = None) -> Column:
    ok = F.lit(True) if flag is None else F.col(flag)
    for r in ranks:
        ok = ok & F.col(r).between(1, 6)
    return F.coalesce(ok, F.lit(False))


def _observed(races: DataFrame, keys, order, ranks, flag, split_rows) -> DataFrame:
    """Observed races and lane hits before each race, as running totals."""
    ok = valid_result(ranks, flag)

    def hits(lane: int, depth: int) -> Column:
        marks = [F.when(ok & (F.col(r) == lane), 1).otherwise(0) for r in ranks[:depth]]
        return sum(marks[1:], marks[0]).cast("long")

    sums = {"__seen": ok.cast("long")}
    for kind, depth in KINDS.items():
        sums.update({f"__{kind}_{k}": hits(k, depth) for k in LANES})
    return totals_before(races, keys, order, sums, split_rows)


def _needed(races: DataFrame, venue: str, day: str, order, ranks, flag, keep) -> DataFrame:
    """The columns that move with a race; bases, one row a venue, join it once its totals are there."""
    return races.select(*dict.fromkeys([*keep, venue, day, *order, *ranks, *([flag] if flag else [])]))


def running_posterior(
    races: DataFrame, prior: DataFrame, venue: str, day: str, order: Sequence[str], ranks: Sequence[str],
    valid: str | None = None, strength: float = 20.0, keep: Sequence[str] = (), split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Multipliers m = posterior / base per lane for win, top 2 and top 3.

    posterior = (depth * K * base + hits) / (depth * K + depth * races) over the
    valid races of the same venue and day before this one. Races of a venue
    without a prior are skipped; invalid races are reported and do not count.
    """
    base = prior.select(venue, *[f"base_{kind}_{k}" for kind in KINDS for k in LANES])
    known = lookup_join(_needed(races, venue, day, order, ranks, valid, keep), base.select(venue, F.lit(True).alias("__known")), [venue]).where("__known")
    seen = lookup_join(_observed(known.drop("__known"), [venue, day], order, ranks, valid, split_rows), base, [venue])
    k_races = F.lit(float(strength))
    out = {}
    for kind, depth in KINDS.items():
        bottom = depth * k_races + depth * F.col("__seen")
        for k in LANES:
            b = F.col(f"base_{kind}_{k}")
            out[f"post_{kind}_{k}"] = (depth * k_races * b + F.col(f"__{kind}_{k}")) / bottom
    done = seen.withColumns(out)
    multipliers = [
        (F.col(f"post_{kind}_{k}") / F.col(f"base_{kind}_{k}")).alias(f"m_{kind}_{k}")
        for kind in KINDS
        for k in LANES
    ]
    return done.select(
        *keep, F.col("__seen").alias("observed_races"), *multipliers,
        *[l1_distance(kind).alias(f"strength_{kind}") for kind in KINDS],
    )


def l1_distance(kind: str) -> Column:
    """Sum over lanes of |posterior - base|."""
    parts = [F.abs(F.col(f"post_{kind}_{k}") - F.col(f"base_{kind}_{k}")) for k in LANES]
    return sum(parts[1:], parts[0])


def share_posterior(
    races: DataFrame, shares: DataFrame, venue: str, day: str, order: Sequence[str], ranks: Sequence[str],
    valid: str | None = None, strength: float = 60.0, keep: Sequence[str] = (), split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """(K * share + hits) / (K + 3 * races) per lane over valid races only.

    ``shares`` is the long lane-share prior (venue, lane, share).
    """
    wide = shares.groupBy(venue).agg(
        *[F.max(F.when(F.col("lane") == k, F.col("share"))).alias(f"base_share_{k}") for k in LANES]
    )
    live = _needed(races.where(valid_result(ranks, valid)), venue, day, order, ranks, valid, keep)
    known = lookup_join(live, wide.select(venue, "base_share_1"), [venue]).where(F.col("base_share_1").isNotNull()).drop("base_share_1")
    seen = lookup_join(_observed(known, [venue, day], order, ranks, valid, split_rows), wide, [venue])
    cols = {
        f"p_post_{k}": (F.lit(float(strength)) * F.col(f"base_share_{k}") + F.col(f"__top3_{k}"))
        / (F.lit(float(strength)) + 3 * F.col("__seen"))
        for k in LANES
    }
    out = seen.withColumns(cols)
    gaps = [F.abs(F.col(f"p_post_{k}") - F.col(f"base_share_{k}")) for k in LANES]
    return out.select(
        *keep, F.col("__seen").alias("observed_races"), *cols,
        *[(F.col(f"p_post_{k}") / F.col(f"base_share_{k}")).alias(f"m_top3_{k}") for k in LANES],
        sum(gaps[1:], gaps[0]).alias("strength"),
    )


def market_shift(
    races: DataFrame, prior: DataFrame, venue: str, day: str, order: Sequence[str],
    popularity: str, payout: str, keep: Sequence[str] = (), split_rows=SPLIT_ROWS,
) -> DataFrame:
    """Running medians of popularity and log payout before each race against the
    venue's base, as ratio and exp difference; the base itself before the first
    valid value. The order must be unique within a venue day."""
    base = prior.select(venue, "base_popularity_median", "base_log_payout_median")
    known = lookup_join(races, base, [venue]).where(F.col("base_popularity_median").isNotNull())
    known = known.withColumns({"__pop": F.col(popularity).cast("double"), "__pay": F.log1p(F.col(payout).cast("double"))})
    keys = [venue, day]
    counts = {"pop_valid_obs": "__pop", "payout_valid_obs": "__pay"}
    out = totals_before(known, keys, order, {n: F.col(c).isNotNull().cast("long") for n, c in counts.items()}, split_rows)
    out = median_before(out, keys, order, "__pop", "__pop_median", split_rows)
    out = median_before(out, keys, order, "__pay", "__pay_median", split_rows)
    out = out.select(
        *keep, "base_popularity_median", "base_log_payout_median", *counts,
        F.coalesce("__pop_median", "base_popularity_median").alias("post_popularity_median"),
        F.coalesce("__pay_median", "base_log_payout_median").alias("post_log_payout_median"),
    )
    ratio = F.col("post_popularity_median") / F.col("base_popularity_median")
    diff = F.exp(F.col("post_log_payout_median") - F.col("base_log_payout_median"))
    out = out.withColumn("regime_popularity_shift", ratio).withColumn("regime_payout_shift", diff)
    return out.withColumn(
        "strength_market",
        F.abs(F.log("regime_popularity_shift")) + F.abs(F.log("regime_payout_shift")),
    )
