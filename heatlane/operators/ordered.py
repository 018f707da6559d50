"""Ordered windows that survive a hot key.

A plain Spark window sends all rows of one key to one task. That is right for
most keys and fatal for a key that holds a third of the table. The functions
here count rows per key first (a map-side combined aggregate over the key
columns only) and, when some key exceeds ``split_rows``, handle those keys
apart: their rows are range-partitioned on (keys, order), each range partition
becomes a chunk, windows run per (key, chunk), and what a chunk needs from the
chunks before it - a few trailing rows, or a running total - is carried over.
The order must be total; add a unique tie-break column.

The threshold is fixed, whatever the size of the table. The list of hot keys is a
written table; it, and what is kept per key or chunk, is broadcast up to
``MAX_BROADCAST`` rows, which are counted first, and joined by a shuffle beyond.
Without a key all rows count as one hot key, so a global order is never the work
of one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatlane.session import durable

SPLIT_ROWS = 4_000_000
#: Rows of a key up to which a running median may use Spark's percentile, whose cost is quadratic.
MEDIAN_ROWS = 500
MAX_BROADCAST = 20_000
#: Chunks of a table, as long as they stay within ``SPLIT_ROWS`` rows: what the driver keeps (sampled bounds, map outputs, results
#: of tasks) grows with their number, and the blocks of a shuffle with its square.
MAX_CHUNKS = 128
#: Leading bits of a hash that name a chunk where rows are ordered by it.
HASH_BITS = 10
_CHUNK, _HALO, _SALT, _ALL = "__chunk", "__halo", "__salt", "__all"
NULL_SALTS = 4096


class Hot(NamedTuple):
    """Keys above the limit: the list (None if empty), their number and their rows."""

    keys: DataFrame | None
    count: int
    rows: int


def _limits(split_rows) -> tuple[int, int]:
    """(rows that make a key hot, rows per chunk); one number serves for both."""
    return split_rows if isinstance(split_rows, tuple) else (split_rows, split_rows)


def _always(split_rows) -> tuple[int, int]:
    """Limits for one key that holds the whole table: chunks in any case."""
    return 0, _limits(split_rows)[1]


def asc_order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def listed(df: DataFrame, n: int) -> DataFrame:
    """``df``, whose rows are counted as at most ``n``, sent to all tasks if that is few, and shuffled if not: written
    tables are compressed, so by the size of their files Spark would broadcast tables of many rows."""
    return F.broadcast(df) if n <= MAX_BROADCAST else df.hint("merge")


def hot_keys(df: DataFrame, keys: Sequence[str], split_rows: int | tuple[int, int] = SPLIT_ROWS) -> Hot:
    """Keys with more rows than the limit, counted in one map-side combined pass."""
    most, _ = _limits(split_rows)
    live = df
    for k in keys:
        live = live.where(F.col(k).isNotNull())
    counts = live.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most)
    hot = durable(counts, "hot")
    found = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("__n").alias("rows")).first()
    if not found["keys"]:
        return Hot(None, 0, 0)
    return Hot(hot.select(*keys), found["keys"], found["rows"])


def _any_null(keys: Sequence[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def _plain(df, keys, order, frame, builders) -> DataFrame:
    """One window per key. Rows with a null key belong to no group: they get
    nulls, and a salt spreads them so they do not form one big partition."""
    null_key = _any_null(keys)
    tie = F.xxhash64(*[o for o in order if isinstance(o, str)])
    salted = df.withColumn(_SALT, F.when(null_key, F.pmod(tie, F.lit(NULL_SALTS))).otherwise(F.lit(0)))
    w = Window.partitionBy(*keys, _SALT).orderBy(*asc_order(order)).rowsBetween(*frame)
    return salted.select(
        *df.columns, *[F.when(~null_key, b(w)).alias(n) for n, b in builders.items()]
    )


def _by_heat(df, keys, hot: Hot):
    """Split rows into (ordinary, hot). If the list has to be shuffled, rows move once for both."""
    if hot.count > MAX_BROADCAST:
        marked = df.join(hot.keys.withColumn(_HALO, F.lit(True)).hint("merge"), list(keys), "left").select(*df.columns, _HALO)
        marked = durable(marked, "heat")
        return marked.where(F.col(_HALO).isNull()).drop(_HALO), marked.where(_HALO).drop(_HALO)
    names = listed(hot.keys, hot.count)
    return df.join(names, list(keys), "left_anti"), df.join(names, list(keys), "left_semi")


def chunk_count(rows: int, split_rows, most: int = SPLIT_ROWS) -> int:
    size = _limits(split_rows)[1]
    return max(2, math.ceil(rows / max(size, min(most, math.ceil(rows / MAX_CHUNKS)))))


def chunked(df: DataFrame, keys, order: Sequence[str], rows: int, split_rows, most: int = SPLIT_ROWS) -> DataFrame:
    """Range-partition on (keys, order) and pin the partition number as a column.

    The partition number depends on sampled bounds, so the result is written
    once and read back: both users of the chunks then see the same ones.
    """
    ranged = df.repartitionByRange(chunk_count(rows, split_rows, most), *[F.col(k) for k in keys], *asc_order(order))
    return durable(ranged.withColumn(_CHUNK, F.spark_partition_id().cast("long")), "chunks")


def going_on(pieces: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """(chunk, keys) of each chunk whose first key has rows in earlier chunks, written, and their number: one a chunk at most, as
    chunks are ranges of the keys. No other key needs anything from another chunk."""
    key = F.struct(*keys)
    ends = pieces.groupBy(_CHUNK).agg(F.min(key).alias("__first"), F.max(key).alias("__last"))
    earlier = F.lag("__last").over(Window.orderBy(_CHUNK))  # one row a chunk
    on = ends.withColumn("__on", earlier.eqNullSafe(F.col("__first"))).where("__on")
    on = durable(on.select(_CHUNK, *[F.col("__first")[k].alias(k) for k in keys]), "going")
    return on, on.count()


def over_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    builders: Mapping[str, Callable[[WindowSpec], Column]],
    split_rows: int | tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """Add columns computed over the previous ``n`` rows of the same key.

    ``builders`` maps a new column name to a function of the window spec. Each
    row sees rows ``-n .. -1`` only, never itself.
    """
    if not keys:
        whole = df.withColumn(_ALL, F.lit(0))
        return over_previous(whole, [_ALL], order, n, builders, _always(split_rows)).drop(_ALL)
    hot = hot_keys(df, keys, split_rows)
    frame = (-n, -1)
    if hot.keys is None:
        return _plain(df, keys, order, frame, builders)
    calm, heavy = _by_heat(df, keys, hot)
    pieces = chunked(heavy, keys, order, hot.rows, split_rows)

    # Chunks of one key are contiguous and none is empty, so the n chunks before
    # a chunk hold its n previous rows. Tails are n rows per (key, chunk).
    group = [*keys, _CHUNK]
    back = Window.partitionBy(*group).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    tails = pieces.withColumn("__r", F.row_number().over(back)).where(F.col("__r") <= n).drop("__r")
    lasts = pieces.groupBy(*keys).agg(F.max(_CHUNK).alias("__last"))
    tails = tails.join(listed(lasts, hot.count), list(keys))
    halo = (
        tails.withColumn(_CHUNK, F.explode(F.sequence(F.col(_CHUNK) + 1, F.col(_CHUNK) + n)))
        .where(F.col(_CHUNK) <= F.col("__last"))
        .drop("__last")
        .withColumn(_HALO, F.lit(True))
    )
    w = Window.partitionBy(*group).orderBy(*asc_order(order)).rowsBetween(*frame)
    done = (
        pieces.withColumn(_HALO, F.lit(False))
        .unionByName(halo)
        .select("*", *[b(w).alias(name) for name, b in builders.items()])
        .where(~F.col(_HALO))
        .drop(_HALO, _CHUNK)
    )
    return _plain(calm, keys, order, frame, builders).unionByName(done)


def totals_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    split_rows: int | tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """Add, per new column, the sum over all earlier rows of the key (0 at the
    first row). Hot keys: running sums inside a chunk plus the chunk's offset."""
    if not keys:
        whole = df.withColumn(_ALL, F.lit(0))
        return totals_before(whole, [_ALL], order, sums, _always(split_rows)).drop(_ALL)
    hot = hot_keys(df, keys, split_rows)
    before = (Window.unboundedPreceding, -1)
    def running(c: Column) -> Callable[[WindowSpec], Column]:
        return lambda w: F.coalesce(F.sum(c).over(w), F.lit(0))

    if hot.keys is None:
        return _plain(df, keys, order, before, {n: running(c) for n, c in sums.items()})
    calm, heavy = _by_heat(df, keys, hot)
    pieces = chunked(heavy, keys, order, hot.rows, split_rows)
    group = [*keys, _CHUNK]
    w = Window.partitionBy(*group).orderBy(*asc_order(order)).rowsBetween(*before)
    inside = pieces.select("*", *[running(c)(w).alias(n) for n, c in sums.items()])
    # only keys of several chunks have offsets: two rows a chunk at most
    going, n = going_on(pieces, keys)
    across = pieces.join(listed(going.select(*keys).distinct(), n), list(keys), "left_semi")
    per_chunk = across.groupBy(*group).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    cw = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(*before)
    offsets = per_chunk.select(
        *group, *[F.coalesce(F.sum(f"__t_{n}").over(cw), F.lit(0)).alias(f"__o_{n}") for n in sums]
    )
    done = inside.join(listed(offsets, 2 * n), group, "left")
    done = done.select(*df.columns, *[(F.col(n) + F.coalesce(f"__o_{n}", F.lit(0))).alias(n) for n in sums])
    plain = _plain(calm, keys, order, before, {n: running(c) for n, c in sums.items()})
    return plain.unionByName(done)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str,
    split_rows: int | tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """``row_number`` that also works without a key on a large table."""
    out = totals_before(df, keys, order, {name: F.lit(1).cast("long")}, split_rows)
    return out.withColumn(name, (F.col(name) + 1).cast("long"))


def numbered_by_hash(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, bits: int = HASH_BITS) -> DataFrame:
    """As ``numbered``, for an order whose first column is a 64-bit hash of the rows.

    Its leading bits are the chunks: they are even whatever the keys hold, and need no sample and no written copy, as they
    don't depend on placement. Rows are counted per (key, chunk), then move once. Rows with a null key get no number.
    """
    split = df.withColumn(_CHUNK, F.shiftright(F.col(order[0]), 64 - bits))
    group = [*keys, _CHUNK]
    counts = durable(split.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")), "counts")
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*group).orderBy(*asc_order(order)))
    placed = split.withColumn(name, inside).join(listed(offsets, counts.count()), group, "left")
    return placed.select(*df.columns, (F.col(name) + F.col("__before")).cast("long").alias(name))


def quantile_exact(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    q: float,
    name: str,
    split_rows: int | tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """Exact interpolated quantile per key, without holding a key in one buffer.

    The table is read once, to counts per distinct value; those are written and
    ranked with :func:`totals_before`, and the one or two values around the
    position are kept.
    """
    if not keys:
        whole = df.withColumn(_ALL, F.lit(0))
        return quantile_exact(whole, [_ALL], value, q, name, _always(split_rows)).drop(_ALL)
    live = df.where(F.col(value).isNotNull())
    weights = durable(live.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c")), "weights")
    ranked = totals_before(weights, keys, [value], {"__before": F.col("__c")}, split_rows)
    totals = weights.groupBy(*keys).agg(F.sum("__c").alias("__n"))
    joined = ranked.join(totals, list(keys))
    pos = (F.col("__n") - 1) * F.lit(q)
    lo, hi = F.floor(pos), F.ceil(pos)

    def holds(p: Column) -> Column:
        return (F.col("__before") <= p) & (p < F.col("__before") + F.col("__c"))

    picked = joined.groupBy(*keys).agg(
        F.max(F.when(holds(lo), F.col(value))).alias("__lo"),
        F.max(F.when(holds(hi), F.col(value))).alias("__hi"),
        F.max(pos - lo).alias("__f"),
    )
    return picked.select(
        *keys, (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__f")).alias(name)
    )


#: Rows of a chunk and buckets of values of a running median.
MEDIAN_CHUNK, BUCKETS = 1 << 19, 1024


def medians_along(x: np.ndarray, base: np.ndarray, skipped: int, total: int) -> np.ndarray:
    """The median of ``total`` values and the first i of ``x``, for i from 0 to all; NaN where there is none.

    ``base`` holds, in order, those of the values that can be reached, ``skipped`` lie below. From the sorted list of all, the values of
    ``x`` are taken out again, last one first, and the median moves by at most one place a time.
    """
    both = np.concatenate([base, x])
    order = np.argsort(both, kind="stable")
    n, count = len(both), total + len(x)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before, after = [n, *range(n)], [*range(1, n + 1), 0]  # a ring: place n is before the first and after the last
    at = (count - 1) // 2 - skipped
    lower, upper = [n] * (len(x) + 1), [n] * (len(x) + 1)
    for i, out in zip(range(len(x), -1, -1), [*place[len(base) :][::-1].tolist(), None], strict=True):
        if not count:
            break
        lower[i], upper[i] = at, at if count % 2 else after[at]
        if out is None:
            break
        if count % 2:
            at = at if out < at else before[at]
        else:
            at = at if out > at else after[at]
        left, right = before[out], after[out]
        after[left], before[right] = right, left
        count -= 1
    values = np.append(both[order], np.nan)
    return (values[lower] + values[upper]) / 2


def _reach(rows: int) -> int:
    """Places by which the median of a set can move, either way, while ``rows`` values join it."""
    return (rows + 1) // 2 + 2


def _values_before(pieces: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """(chunk, ``__v``, ``__c``, ``__skip``, ``__total``): for each chunk whose first key goes on from earlier chunks, those values there,
    with their counts, that a median within the chunk can reach, the number of values below them and of all.

    While m values join a set, its median moves by at most m / 2 places. Values are counted per chunk and bucket; running
    totals of these counts over the chunks name the buckets a chunk asks for. Their bounds come from a sample and decide nothing but
    how many values are sent beyond the reach.
    """
    spark, (going, n) = pieces.sparkSession, going_on(pieces, keys)
    live = pieces.where(F.col("__v").isNotNull()).join(listed(going.select(*keys).distinct(), n), list(keys), "left_semi")
    live = live.select(*keys, _CHUNK, "__v")

    sample = np.array([r["__v"] for r in live.sample(min(1.0, 32 * BUCKETS / max(rows, 1)), 42).collect()], dtype=float)
    sample = sample[np.isfinite(sample)]
    cuts = np.unique(np.quantile(sample, np.linspace(0, 1, BUCKETS + 1)[1:-1], method="lower")) if len(sample) else np.zeros(1)
    bucketizer = Bucketizer(splits=[-math.inf, *(cuts + 0.0).tolist(), math.inf], inputCol="__v", outputCol="__bucket", handleInvalid="keep")
    live = bucketizer.transform(live).withColumn("__bucket", F.col("__bucket").cast("long"))
    cells = durable(live.groupBy(*keys, _CHUNK, "__bucket").agg(F.count(F.lit(1)).alias("__c")), "cells")

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(cuts) + 1).cast("long")))
    asks = going.select(*keys, _CHUNK, every.alias("__bucket"), F.lit(0).cast("long").alias("__c"), F.lit(0).alias("__kind"))
    both = asks.unionByName(cells.withColumn("__kind", F.lit(1)))
    earlier = Window.partitionBy(*keys, "__bucket").orderBy(_CHUNK, "__kind").rowsBetween(Window.unboundedPreceding, -1)
    held = both.withColumn("__c", F.coalesce(F.sum("__c").over(earlier), F.lit(0))).where("__kind = 0").drop("__kind")
    group = [*keys, _CHUNK]
    upto = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    held = held.withColumns({"__upto": F.sum("__c").over(upto), "__total": F.sum("__c").over(whole)})
    sizes = cells.groupBy(*group).agg(F.sum("__c").alias("__m"))
    held = held.join(listed(sizes, n + going.select(*keys).distinct().count()), group, "left")
    reach = F.floor((F.coalesce("__m", F.lit(0)) + 1) / 2) + 2
    half = F.floor(F.col("__total") / 2)
    skip = F.col("__upto") - F.col("__c")
    asked = held.where((F.col("__c") > 0) & (F.col("__upto") > half - reach) & (skip <= half + reach))
    asked = durable(asked.select(*keys, "__bucket", F.col(_CHUNK).alias("__for"), skip.alias("__skip"), "__total"), "asked")

    last = asked.groupBy(*keys, "__bucket").agg(F.max("__for").alias("__until"))
    n_asked = asked.count()
    few = live.join(listed(last, n_asked), [*keys, "__bucket"]).where(F.col(_CHUNK) < F.col("__until"))
    few = durable(few.groupBy(*keys, "__bucket", _CHUNK, "__v").agg(F.count(F.lit(1)).alias("__c")), "few")
    few = few.repartition(max(1, n, spark.sparkContext.defaultParallelism), *keys, "__v")  # each goes to many chunks
    sent = few.join(listed(asked.drop("__skip", "__total"), n_asked), [*keys, "__bucket"]).where(F.col(_CHUNK) < F.col("__for"))
    sent = sent.groupBy(F.col("__for").alias(_CHUNK), "__v").agg(F.sum("__c").alias("__c"))
    heads = asked.groupBy(F.col("__for").alias(_CHUNK)).agg(F.min("__skip").alias("__skip"), F.max("__total").alias("__total"))
    return sent.join(listed(heads, n), _CHUNK).select(_CHUNK, "__v", "__c", "__skip", "__total")


def median_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    split_rows: int | tuple[int, int] = SPLIT_ROWS,
) -> DataFrame:
    """Add the exact median of the non-null values of all earlier rows of the key
    (null when there are none).

    Keys of up to ``MEDIAN_ROWS`` rows use Spark's percentile over the growing
    frame, which is quadratic. The rows of all others are cut to chunks; each gets, of the values of its first key in earlier chunks,
    those that its medians can reach (about as many as it has rows) and is worked on alone. So rows move a fixed number of times.
    """
    x = F.col(value).cast("double")
    builders = {name: lambda w: F.percentile(x, F.lit(0.5)).over(w)}
    most, chunk = _limits(split_rows)
    hot = hot_keys(df, keys, (min(most, MEDIAN_ROWS), chunk))
    frame = (Window.unboundedPreceding, -1)
    if hot.keys is None:
        return _plain(df, keys, order, frame, builders)
    calm, heavy = _by_heat(durable(df, "rows"), keys, hot)
    pieces = chunked(heavy.withColumn("__v", x), keys, order, hot.rows, (most, min(chunk, MEDIAN_CHUNK)), MEDIAN_CHUNK)
    in_order = Window.partitionBy(_CHUNK).orderBy(*[F.col(k) for k in keys], *asc_order(order))
    now = F.struct(*keys)
    placed = pieces.withColumns({"__new": ~F.lag(now).over(in_order).eqNullSafe(now), "__at": F.row_number().over(in_order)})
    columns = list(df.columns)

    def run(mine: pa.Table, base: pa.Table) -> pa.Table:
        mine = mine.sort_by("__at")
        there = mine["__v"].is_valid().to_numpy()
        v = mine["__v"].to_numpy()[there]
        starts = np.flatnonzero(mine["__new"].to_numpy() | (np.arange(mine.num_rows) == 0))
        seen = np.concatenate([[0], np.cumsum(there)])  # values before each row
        out, known = np.empty(mine.num_rows), np.empty(mine.num_rows, bool)
        for a, b in zip(starts, [*starts[1:], mine.num_rows], strict=True):
            some, kept, skipped, total = v[seen[a] : seen[b]], np.zeros(0), 0, 0
            if a == 0 and base.num_rows:
                base = base.take(pa.array(np.argsort(base["__v"].to_numpy(), kind="stable")))
                total, skipped = base["__total"][0].as_py(), base["__skip"][0].as_py()
                counts = base["__c"].to_numpy()
                upto = skipped + np.cumsum(counts)
                low, high = max(skipped, total // 2 - _reach(len(some))), total // 2 + _reach(len(some)) + 1
                kept = np.repeat(base["__v"].to_numpy(), np.maximum(np.minimum(upto, high) - np.maximum(upto - counts, low), 0))
                skipped = low
            out[a:b] = medians_along(some, kept, skipped, total)[seen[a:b] - seen[a]]
            known[a:b] = total + seen[a:b] - seen[a] > 0
        return mine.select(columns).append_column(name, pa.array(out, mask=~known))

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    done = placed.groupBy(_CHUNK).cogroup(_values_before(pieces, keys, hot.rows).groupBy(_CHUNK)).applyInArrow(run, schema)
    return _plain(calm, keys, order, frame, builders).unionByName(done)
