"""Joins and their contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.operators.windows import keep_first, keep_last
from heatlane.session import durable

# Most rows of a side that is broadcast; every such side is counted first.
BROADCAST_ROWS = 200_000


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(dim: DataFrame, keys: Sequence[str], name: str = "dimension") -> None:
    sample = duplicate_keys(dim, keys).limit(10).collect()
    if sample:
        raise ValueError(f"{name}: keys {list(keys)} are not unique, e.g. {sample}")


def sized_broadcast(dim: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the side is counted to be small; otherwise the
    plain side, and Spark shuffles both."""
    return F.broadcast(dim) if dim.limit(limit + 1).count() <= limit else dim


def align_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Right side with key columns cast to the left side's types."""
    types = dict(left.dtypes)
    return right.withColumns({k: F.col(k).try_cast(types[k]) for k in keys})


def lookup_join(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a dimension whose key must be unique.

    One counting job over the dimension proves the key and gives the size that
    decides about the broadcast.
    """
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = per_key.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    if seen["most"] is not None and seen["most"] > 1:
        require_unique(dim, keys)
    right = align_keys(df, dim, keys)
    if (seen["rows"] or 0) <= BROADCAST_ROWS:
        right = F.broadcast(right)
    return df.join(right, list(keys), "left")


def hit_rate(df: DataFrame, col: str, name: str = "hit_rate") -> DataFrame:
    return df.agg(F.avg(F.col(col).isNotNull().cast("int")).alias(name))


def attach_history(df: DataFrame, hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History features by key; a null axis finds nothing and stays null. Several
    history rows of one key are an error, raised where the row is made: the check
    rides on the aggregate and reads the history once."""
    names = [c for c in hist.columns if c not in keys]
    known = hist.dropna(subset=list(keys))
    one = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in names])
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    clash = F.raise_error(F.concat(F.lit("several history rows for "), shown))
    checked = [F.when(F.col("__n") > 1, clash).otherwise(F.col(c)).alias(c) for c in names]
    return df.join(one.select(*keys, *checked), list(keys), "left")


def attach_new_columns(df: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Left join that brings only columns the left lacks; the last right row per
    key (in ``order``) counts."""
    fresh = [c for c in right.columns if c not in df.columns]
    last = keep_last(right.select(*keys, *[o for o in order if o not in (*keys, *fresh)], *fresh), keys, order)
    return df.join(last.select(*keys, *fresh), list(keys), "left")


def attach_first(df: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], suffix: str) -> DataFrame:
    """Left join to the first right row per key; clashing names get a suffix."""
    first = keep_first(right, keys, order)
    clash = {c: f"{c}{suffix}" for c in right.columns if c in df.columns and c not in keys}
    return df.join(first.withColumnsRenamed(clash), list(keys), "left")


def only_left(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def marked_left_join(df: DataFrame, feats: DataFrame, keys: Sequence[str], marker: str = "matched") -> DataFrame:
    """Left join with a 0/1 column that says whether the key was found."""
    joined = df.join(feats.withColumn(marker, F.lit(1)), list(keys), "left")
    return joined.withColumn(marker, F.coalesce(F.col(marker), F.lit(0)))


def join_report(joined: DataFrame, cols: Sequence[str], marker: str = "matched") -> DataFrame:
    """One row: matched, unmatched and null rate per feature column."""
    return joined.agg(
        F.sum(marker).cast("long").alias("both_rows"),
        F.sum(1 - F.col(marker)).cast("long").alias("left_only_rows"),
        *[F.avg(F.col(c).isNull().cast("int")).alias(f"null_rate_{c}") for c in cols],
    )


def point_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Lookup in the 36-row point table; no match counts 0."""
    out = df.join(F.broadcast(table), list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in cols})


def pairs_within_group(df: DataFrame, group: str, member: str, cols: Sequence[str], size: int = 6) -> DataFrame:
    """Each unordered pair of lanes 1..``size`` of a race, once.

    Lanes become one struct each by conditional aggregation, so a race costs
    ``size`` buffers whatever it holds, there is one shuffle, and no self join.
    """
    names = [c for c in cols if c != member]
    row = F.struct(*[F.col(c) for c in names])
    lanes = df.groupBy(group).agg(
        *[F.max(F.when(F.col(member) == k, row)).alias(f"__{k}") for k in range(1, size + 1)]
    )
    pairs = [
        F.when(
            F.col(f"__{i}").isNotNull() & F.col(f"__{j}").isNotNull(),
            F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"__{i}").alias("a"), F.col(f"__{j}").alias("b")),
        )
        for i in range(1, size + 1)
        for j in range(i + 1, size + 1)
    ]
    both = lanes.select(group, F.explode(F.array_compact(F.array(*pairs))).alias("p"))
    return both.select(
        group,
        F.col("p.i").cast("long").alias(f"{member}_i"),
        F.col("p.j").cast("long").alias(f"{member}_j"),
        *[F.col(f"p.a.{c}").alias(f"{c}_i") for c in names],
        *[F.col(f"p.b.{c}").alias(f"{c}_j") for c in names],
    )


OPEN_START, OPEN_END = "1900-01-01", "2100-12-31"
# Days of a bucket of the interval join.
BUCKET_DAYS = 64


def days_asked(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """(keys, ``__d``, ``__n`` rows), written: which ranges apply depends on key and day alone, so
    each pair is looked up once, however many rows have it."""
    return durable(df.groupBy(*keys, F.col(day).alias("__d")).agg(F.count(F.lit(1)).alias("__n")), "days")


def day_matches(
    asked: DataFrame, ranges: DataFrame, keys: Sequence[str], value: str, start="effective_from", end="effective_to",
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """(keys, ``__d``, ``__n``, ``__a`` start, ``__v`` value): every range that holds a day asked for.

    Ranges are cut at fixed date buckets within the days asked for, days and pieces meet by
    (keys, bucket), and the day is checked there. A key of many ranges makes many pieces, never one row.
    """

    def bucket(c: Column) -> Column:
        return F.floor(F.unix_date(c.cast("date")) / F.lit(bucket_days))

    extent = asked.agg(F.min(F.col("__d").cast("date")).alias("low"), F.max(F.col("__d").cast("date")).alias("high")).first()
    low, high = (F.lit(extent[c]).cast("date") for c in ("low", "high"))
    whole = ranges.select(
        *keys, F.coalesce(F.col(start), F.lit(OPEN_START).cast("date")).alias("__a"),
        F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")).alias("__z"), F.col(value).alias("__v"),
    ).where((F.col("__a") <= F.col("__z")) & (F.col("__a") <= high) & (F.col("__z") >= low))
    inside = F.sequence(bucket(F.greatest("__a", low)), bucket(F.least("__z", high)))
    pieces = whole.withColumn("__b", F.explode(inside))
    met = asked.withColumn("__b", bucket(F.col("__d"))).join(pieces, [*keys, "__b"])
    return met.where((F.col("__a") <= F.col("__d")) & (F.col("__z") >= F.col("__d"))).drop("__b", "__z")


def range_matches(df, ranges, row_id, keys, day, value, start="effective_from", end="effective_to"):
    """Every (row, value) match of the range join."""
    found = day_matches(days_asked(df, keys, day), ranges, keys, value, start, end)
    back = found.select(*keys, F.col("__d").alias(day), "__v")
    return df.select(*dict.fromkeys([row_id, *keys, day])).join(back, [*keys, day]).select(row_id, F.col("__v").alias(value))


def resolved_days(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and day, written: ``__first`` (earliest start, then least value), ``__least``, ``__most``,
    whether ``__several`` different values apply, and the rows ``__n`` that ask."""
    v = F.col("__v")
    mixed = (F.count(v) > 0) & ((F.min(v) != F.max(v)) | (F.count(v) < F.count(F.lit(1))))
    out = matches.groupBy(*keys, "__d").agg(
        F.min(F.struct("__a", "__v")).alias("__first"), F.min(v).alias("__least"), F.max(v).alias("__most"),
        mixed.alias("__several"), F.max("__n").alias("__n"),
    )
    return durable(out, "resolved")


def _with_first(df: DataFrame, resolved: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """The facts move only if the days looked up are too many to broadcast."""
    first = resolved.select(*keys, F.col("__d").alias(day), F.col("__first.__v").alias("__value"))
    joined = df.join(sized_broadcast(first), [*keys, day], "left")
    return joined.select(*[f"`{c}`" for c in df.columns if c != value], F.col("__value").alias(value))


def effective_join_first(df, ranges, keys, day, value, start="effective_from", end="effective_to"):
    """Left join to the range that contains the day; earliest start wins, then the least value.

    ``df`` is read twice, the first time for its keys and days alone.
    """
    matches = day_matches(days_asked(df, keys, day), ranges, keys, value, start, end)
    return _with_first(df, resolved_days(matches, keys), keys, day, value)


def effective_join_strict(
    df, ranges, keys, day, value, max_miss_pct: float | None = None, start="effective_from", end="effective_to",
):
    """As above, but several different candidates for a row are an error, and so
    is a share of unmatched rows above ``max_miss_pct``. Both are checked on the
    days looked up, which carry the number of their rows."""
    asked = days_asked(df, keys, day)
    resolved = resolved_days(day_matches(asked, ranges, keys, value, start, end), keys)
    seen = resolved.agg(F.max(F.col("__several").cast("int")).alias("clash"), F.sum("__n").alias("hits")).first()
    if seen["clash"]:
        sample = resolved.where("__several").select(*keys, F.col("__d").alias(day), "__least", "__most").limit(10).collect()
        raise ValueError(f"several {value} apply to one row, e.g. {sample}")
    total = asked.agg(F.sum("__n").alias("n")).first()["n"]
    miss = 100 * (1 - (seen["hits"] or 0) / total) if total else 0.0
    if max_miss_pct is not None and miss > max_miss_pct:
        raise ValueError(f"{miss:.3f}% of rows have no {value}, limit {max_miss_pct}%")
    return _with_first(df, resolved, keys, day, value)


def positional_join(a: DataFrame, b: DataFrame, group: str, pos: str) -> DataFrame:
    """Row i with row i of a group, by an explicit position column."""
    return a.join(b, [group, pos], "left")


def named_join(a: DataFrame, b: DataFrame, name: str, clean) -> DataFrame:
    """Left join by a cleaned name (player, place)."""
    left = a.withColumn("__name", clean(F.col(name)))
    right = b.withColumn("__name", clean(F.col(name))).drop(name)
    return left.join(right, "__name", "left").drop("__name")


def known_only(facts: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """Facts whose key has a prior row (semi join)."""
    return facts.join(prior.select(key).distinct(), key, "left_semi")


def out_of_fold_join(base: DataFrame, section: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Second model's out-of-fold score beside the first one's; may be missing."""
    return base.join(section.select(*keys, score), list(keys), "left")


def numbered_rows(df: DataFrame, group: str, order: Column, name: str = "pos") -> DataFrame:
    """Position inside a race-sized group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(order)))
