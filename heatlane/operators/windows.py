"""Window features. History never sees its own row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.operators.ordered import SPLIT_ROWS, numbered, over_previous
from heatlane.session import durable


def history_rates(
    df: DataFrame,
    entity: str,
    axis: str,
    order: Sequence[str],
    started: str,
    flags: Mapping[str, str],
    value: str | None = None,
    n: int = 10,
    suffix: str = "",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Counts, rates and start-time statistics over the previous ``n`` rows.

    ``flags`` maps a feature name to a 0/1 column. Only rows that started enter
    the denominator; the others still take a place in the frame. ``value`` adds
    mean and sample deviation. Rows without an axis value get nulls.
    """
    live = F.col(started)
    builders = {}
    for name, flag in flags.items():
        seen = F.when(live, F.col(flag).cast("long"))
        builders[f"{name}_cnt_last{n}{suffix}"] = lambda w, s=seen: F.count(s).over(w)
        builders[f"{name}_rate_last{n}{suffix}"] = lambda w, s=seen: F.try_divide(
            F.sum(s).over(w).cast("double"), F.count(s).over(w).cast("double")
        )
    if value is not None:
        x = F.when(live, F.col(value))
        builders[f"st_mean_last{n}{suffix}"] = lambda w: F.avg(x).over(w)
        builders[f"st_std_last{n}{suffix}"] = lambda w: F.stddev_samp(x).over(w)
    return over_previous(df, [entity, axis], order, n, builders, split_rows)


def append_targets(history: DataFrame, targets: DataFrame, keys: Sequence[str], started: str) -> DataFrame:
    """Add target rows that the history lacks, marked as not started so that
    they receive features and never count themselves."""
    fresh = targets.join(history.select(*keys).distinct(), list(keys), "left_anti")
    fresh = fresh.withColumn(started, F.lit(False)).withColumn("is_target", F.lit(True))
    return history.withColumn("is_target", F.lit(False)).unionByName(fresh, allowMissingColumns=True)


def prev_features(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    rates: Sequence[str],
    totals: Sequence[str] = (),
    ns: Sequence[int] = (3, 5),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``prev1``, ``prevN_sum`` / ``prevN_mean`` and ``delta_1_N`` of a lagged table.

    Sums of ``totals`` and means of ``rates`` need all N earlier rows. One pass:
    the frame is the longest N, and each feature reads the end of its slice.
    """
    cols = [*totals, *rates]
    longest = max([1, *ns])
    builders = {f"__s_{c}": (lambda w, c=c: F.collect_list(F.struct(F.col(c).alias("v"))).over(w)) for c in cols}
    out = over_previous(df, [key], order, longest, builders, split_rows)

    def last(c: str, k: int) -> Column:
        return F.slice(F.col(f"__s_{c}"), -k, k)

    def total(c: str, k: int) -> Column:
        values = F.filter(last(c, k), lambda s: s["v"].isNotNull())
        added = F.aggregate(values, F.lit(0.0), lambda a, s: a + s["v"].cast("double"))
        return F.when((F.size(F.col(f"__s_{c}")) >= k) & (F.size(values) == k), added)

    size = {c: F.size(F.col(f"__s_{c}")) for c in cols}
    added = {f"prev1_{c}": F.when(size[c] > 0, F.element_at(F.col(f"__s_{c}"), -1)["v"]) for c in cols}
    for k in ns:
        for c in totals:
            added[f"prev{k}_sum_{c}"] = F.when(size[c] >= k, total(c, k))
        for c in rates:
            added[f"prev{k}_mean_{c}"] = F.when(size[c] >= k, total(c, k)) / F.lit(float(k))
    out = out.withColumns(added)
    deltas = {f"delta_1_{k}_{c}": F.col(f"prev1_{c}") - F.col(f"prev{k}_mean_{c}") for k in ns for c in rates}
    return out.withColumns(deltas).drop(*[f"__s_{c}" for c in cols])


def rank_in_group(
    df: DataFrame, group: str, col: str, name: str, nulls: str = "unranked", descending: bool = False
) -> DataFrame:
    """Min rank inside a race. Nulls are unranked, or ``last`` as if infinite.

    Groups are races: a handful of rows each, so a plain window is right here.
    """
    c = F.col(col)
    order = c.desc_nulls_last() if descending else c.asc_nulls_last()
    ranked = F.rank().over(Window.partitionBy(group).orderBy(order)).cast("long")
    return df.withColumn(name, ranked if nulls == "last" else F.when(c.isNotNull(), ranked))


def top_flags(df: DataFrame, rank: str, ks: Sequence[int] = (1, 2), prefix: str = "top") -> DataFrame:
    return df.withColumns(
        {f"{prefix}{k}": F.coalesce(F.col(rank) <= k, F.lit(False)).cast("int") for k in ks}
    )


def transition_events(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
                      split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Rows where the value falls from above zero to zero."""
    out = over_previous(df, keys, order, 1, {"__prev": lambda w: F.max(col).over(w)}, split_rows)
    return out.where((F.col("__prev") > 0) & (F.col(col) == 0)).drop("__prev")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order, as a combinable aggregate."""
    return _keep(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    return _keep(df, keys, order, F.max_by)


def _keep(df, keys, order, pick) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(pick(row, rank).alias("__row")).select("__row.*")


def sequence_by(df: DataFrame, order: Sequence[str], name: str = "seq", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Number all rows 1.. in the given total order, without a one-task sort."""
    return numbered(df, [], order, name, split_rows)


def split_by_first_seen(
    df: DataFrame, group: str, order: Sequence[str], ratio: float = 0.8, name: str = "part",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """``train`` for the first ``floor(ratio * groups)`` groups in order of first
    appearance, ``valid`` for the rest; a group is never divided."""
    first = df.groupBy(group).agg(F.min(F.struct(*order)).alias("__at"))
    first = first.select(group, *[F.col(f"__at.{o}").alias(f"__o{i}") for i, o in enumerate(order)])
    first = durable(first, "races")
    cut = int(first.count() * ratio)
    placed = numbered(first, [], [*[f"__o{i}" for i in range(len(order))], group], "__pos", split_rows)
    part = F.when(F.col("__pos") <= cut, "train").otherwise("valid")
    return df.join(placed.select(group, part.alias(name)), group)


def gate_to_course(df: DataFrame, race: str, gate: str, course: str, name: str = "entry_tenji") -> DataFrame:
    """Inverse permutation: rows list the gate seen at each course; give each
    gate its course, numbered inside a race (six rows)."""
    w = Window.partitionBy(race).orderBy(gate)
    return df.select("*", F.row_number().over(w).alias("wakuban"), F.col(course).alias(name))


def top_in_group(df: DataFrame, group: str, order: Sequence[Column], k) -> DataFrame:
    """First ``k`` rows per group; Spark keeps only k rows per group map-side
    when ``k`` is a number. ``k`` may also be a column."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    limit = F.lit(k) if isinstance(k, int) else k
    return df.withColumn("__rn", rn).where(F.col("__rn") <= limit).drop("__rn")


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: a per-task heap, not a full sort."""
    return df.orderBy(*order).limit(n)


def ordered_rows(df: DataFrame, *order: str) -> DataFrame:
    """Stable total order, e.g. (date, race_id, lane)."""
    return df.orderBy(*order)
