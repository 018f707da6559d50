"""Prior tables: shares with smoothing, shrunk means, lane and market signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.functions import tokens as tk
from heatlane.operators.ordered import SPLIT_ROWS, quantile_exact
from heatlane.session import durable

LANES = list(range(1, 7))


def distribution(df: DataFrame, keys: Sequence[str], classes: Mapping[str, Column], total: str) -> DataFrame:
    """Row count and one counter ``c<label>`` per class."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total),
        *[F.count(F.when(cond, 1)).alias(f"c{label}") for label, cond in classes.items()],
    )


def finish_distribution(df: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """n_finished and c1..c6 per (place, entry, season)."""
    kept = df.where(F.col(place).between(1, 6))
    return distribution(kept, keys, {str(k): F.col(place) == k for k in LANES}, "n_finished")


def smoothed_share(tbl: DataFrame, total: str, labels: Sequence[str], m: float = 0.0) -> DataFrame:
    """p = c / n, or (c + m / k) / (n + m) with prior strength m over k classes."""
    n = F.col(total).cast("double") + F.lit(float(m))
    each = F.lit(float(m) / len(labels))
    return tbl.withColumns({f"p{x}": F.try_divide(F.col(f"c{x}") + each, n) for x in labels})


def relativise(
    tbl: DataFrame, across: Sequence[str], total: str, labels: Sequence[str], m: float = 0.0
) -> DataFrame:
    """Baseline = plain mean of the share over venues, then difference and log ratio.

    The baseline table has one row per (season, entry): it is averaged apart and
    joined back, so nothing is windowed.
    """
    base = tbl.groupBy(*across).agg(*[F.avg(f"p{x}").alias(f"base_p{x}") for x in labels])
    out = tbl.join(base, list(across), "left")
    eps = 1.0 / (F.col(total) + F.lit(float(m)) + 1.0)
    cols = {}
    for x in labels:
        p, b = F.col(f"p{x}"), F.col(f"base_p{x}")
        cols[f"adv_p{x}"] = p - b
        cols[f"lr_p{x}"] = F.log((p + eps) / (b + eps))
    return out.withColumns(cols)


def course_prior(df: DataFrame, place: str, entry: str, season: str, finish: str, m: float = 0.0) -> DataFrame:
    """Season x course prior: D1, D2 and D3 in one chain."""
    kept = df.where(F.col(entry).between(1, 6))
    labels = [str(k) for k in LANES]
    tbl = finish_distribution(kept, [place, entry, season], finish)
    return relativise(smoothed_share(tbl, "n_finished", labels, m), [season, entry], "n_finished", labels, m)


def trick_prior(
    df: DataFrame, place: str, entry: str, season: str, finish: str, trick: str, m: float = 0.0
) -> DataFrame:
    """As the course prior, over winners and the six winning tricks."""
    label = tk.trick_label(F.col(trick))
    kept = df.where((F.col(finish) == 1) & F.col(entry).between(1, 6)).withColumn("__t", label)
    kept = kept.where(F.col("__t").isNotNull())
    labels = [f"_{t}" for t in tk.TRICKS.values()]
    tbl = distribution(kept, [place, entry, season], {x: F.col("__t") == x[1:] for x in labels}, "n_win")
    return relativise(smoothed_share(tbl, "n_win", labels, m), [season, entry], "n_win", labels, m)


def shrunk_mean_sd(
    df: DataFrame, keys: Sequence[str], value: str, m: float = 200.0, floor: float = 0.02,
    names=("tenji_mu", "tenji_sd", "n_tenji"),
) -> DataFrame:
    """Cell mean and sample sd pulled towards the global mean and population sd.

    Weight of the cell is n / (n + m); a cell of one row takes the global sd. The
    table is read once: the cells are written, and the globals follow from their
    counts, means and squared deviations.
    """
    mu, sd, n = names
    cells = df.groupBy(*keys).agg(
        F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"), F.var_pop(value).alias("__v"),
        F.count(value).alias("__k"), F.count(F.lit(1)).alias(n),
    )
    cells = durable(cells, "cells")
    mean = cells.agg((F.sum(F.col("__m") * F.col("__k")) / F.sum("__k")).alias("mu")).first()["mu"]
    mu_g = F.lit(mean).cast("double")
    spread = F.sum(F.col("__k") * (F.col("__v") + F.pow(F.col("__m") - mu_g, 2))) / F.sum("__k")
    sd_g = F.lit(cells.agg(F.sqrt(spread).alias("sd")).first()["sd"]).cast("double")
    w = F.col(n) / (F.col(n) + F.lit(float(m)))
    return cells.select(
        *keys,
        (w * F.col("__m") + (1 - w) * mu_g).alias(mu),
        F.greatest(w * F.coalesce(F.col("__s"), sd_g) + (1 - w) * sd_g, F.lit(float(floor))).alias(sd),
        n,
    )


def residual_z(
    df: DataFrame, value: str, mu: str, sd: str, floor: float = 0.02, null_sd: str = "null",
    resid: str = "tenji_resid", z: str = "tenji_z",
) -> DataFrame:
    """Residual and z against the prior. A missing sd gives a null z in training
    and the floor in live rows (``null_sd="floor"``)."""
    spread = F.greatest(F.col(sd), F.lit(float(floor))) if null_sd == "floor" else F.when(
        F.col(sd).isNotNull(), F.greatest(F.col(sd), F.lit(float(floor)))
    )
    out = df.withColumn(resid, F.col(value) - F.col(mu))
    return out.withColumn(z, F.col(resid) / spread)


def lane_share_prior(payouts: DataFrame, venue: str, lanes: Sequence[str], name: str = "lane") -> DataFrame:
    """Share of each lane among the first three, per venue; unseen lanes get 0."""
    whole = F.lit(True)
    for c in lanes:
        whole = whole & F.col(c).between(1, 6)
    counts = payouts.where(whole).groupBy(venue).agg(
        *[
            F.sum(sum((F.col(c) == k).cast("int") for c in lanes)).cast("long").alias(f"__{k}")
            for k in LANES
        ],
        (F.count(F.lit(1)) * len(lanes)).alias("__all"),
    )
    grid = F.array(*[F.struct(F.lit(k).cast("long").alias("lane"), F.col(f"__{k}").alias("count")) for k in LANES])
    rows = counts.select(venue, "__all", F.explode(grid).alias("g"))
    share = F.col("g.count").cast("double") / F.col("__all")
    return rows.select(venue, F.col("g.lane").alias(name), F.col("g.count").alias("count"), share.alias("share"))


def share_violations(shares: DataFrame, venue: str, tol: float = 1e-9) -> DataFrame:
    """Venues whose shares do not add up to 1: must be empty."""
    total = shares.groupBy(venue).agg(F.sum("share").alias("total"))
    return total.where(F.abs(F.col("total") - 1) > tol)


def venue_signal_prior(
    payouts: DataFrame, venue: str, race: Sequence[str], ranks: Sequence[str], popularity: str, payout: str,
    alpha: float = 0.5, split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Win / top-2 / top-3 lane shares with additive smoothing, and exact medians
    of popularity and log1p(payout), per venue.

    Popularity and payout use every row, the shares only complete results. A NaN
    counts as missing.
    """
    r1, r2, r3 = (F.col(r) for r in ranks)
    valid = r1.between(1, 6) & r2.between(1, 6) & r3.between(1, 6)
    valid = F.coalesce(valid, F.lit(False))
    pop = F.nanvl(F.col(popularity).cast("double"), F.lit(None).cast("double"))
    logp = F.log1p(F.nanvl(F.col(payout).cast("double"), F.lit(None).cast("double")))
    rows = payouts.withColumns({"__v": valid, "__pop": pop, "__pay": logp})

    def hits(lane: int, *cols: Column) -> Column:
        total = sum((F.when(valid & (c == lane), 1).otherwise(0) for c in cols), F.lit(0))
        return F.sum(total).cast("long")

    counts = rows.groupBy(venue).agg(
        F.count("__pop").alias("n_popularity_valid"),
        F.count("__pay").alias("n_payout_valid"),
        *[hits(k, r1).alias(f"__w{k}") for k in LANES],
        *[hits(k, r1, r2).alias(f"__t{k}") for k in LANES],
        *[hits(k, r1, r2, r3).alias(f"__h{k}") for k in LANES],
    )
    # distinct races apart: one row per race first, then a count
    races = rows.where("__v").select(venue, *race).distinct().groupBy(venue).agg(F.count(F.lit(1)).alias("n_races"))
    cells = F.array(*[F.struct(F.lit(c).alias("__of"), F.col(c).alias("__x")) for c in ("__pop", "__pay")])
    long = rows.select(venue, F.explode(cells).alias("c")).select(venue, "c.*")
    both = quantile_exact(long, [venue, "__of"], "__x", 0.5, "__median", split_rows)
    medians = both.groupBy(venue).agg(
        F.max(F.when(F.col("__of") == "__pop", F.col("__median"))).alias("base_popularity_median"),
        F.max(F.when(F.col("__of") == "__pay", F.col("__median"))).alias("base_log_payout_median"),
    )
    out = races.join(counts, venue).join(medians, venue, "left")
    n = F.col("n_races").cast("double")
    a = F.lit(float(alpha))
    cols = {}
    for k in LANES:
        cols[f"base_win_{k}"] = (F.col(f"__w{k}") + a) / (n + 6 * a)
        cols[f"base_top2_{k}"] = (F.col(f"__t{k}") + a) / (2 * n + 6 * a)
        cols[f"base_top3_{k}"] = (F.col(f"__h{k}") + a) / (3 * n + 6 * a)
    return out.withColumns(cols).select(
        venue, "n_races", "n_popularity_valid", "base_popularity_median", "n_payout_valid",
        "base_log_payout_median",
        *[f"base_{kind}_{k}" for kind in ("win", "top2", "top3") for k in LANES],
    )


def signal_violations(prior: DataFrame, tol: float = 1e-9) -> DataFrame:
    """Venues whose shares do not add up to 1: must be empty."""
    bad = F.lit(False)
    for kind in ("win", "top2", "top3"):
        total = sum((F.col(f"base_{kind}_{k}") for k in LANES), F.lit(0.0))
        bad = bad | (F.abs(total - 1) > tol)
    return prior.where(bad)


def section_totals(
    df: DataFrame, keys: Sequence[str], day: str, started: str, points: Mapping[str, str], prefix: str = "motor_"
) -> DataFrame:
    """Per (motor, section): races, point sums, first and last day, rates.

    Only started rows count. ``points`` maps a feature name to its column.
    """
    rows = df.where(F.col(started)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{prefix}race_ct"),
        *[F.sum(F.col(c).cast("long")).alias(f"{prefix}{name}_sum") for name, c in points.items()],
        F.min(day).alias("section_start_dt"),
        F.max(day).alias("section_end_dt"),
    )
    return rows.withColumns(
        {f"{prefix}{name}_rate": F.col(f"{prefix}{name}_sum") / F.col(f"{prefix}race_ct") for name in points}
    )


