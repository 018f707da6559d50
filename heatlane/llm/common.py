"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space of all contracts here: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def column(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns but ``without`` as one struct named ``row``."""
    kept = [column(c) for c in df.columns if c not in without]
    return F.struct(*(kept or [F.lit(None).cast("int").alias("_none")])).alias("row")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(column(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(c, UPPER, LOWER)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def squeezed(c: Column) -> Column:
    """Without any white space."""
    return F.translate(c, SPACES, "")


def words_of(c: Column) -> Column:
    """All maximal runs of characters that aren't white space."""
    return F.array_remove(F.split(c, GAP, -1), "")


def wide_hash(*cols: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; together they name a text at any table size."""
    return F.xxhash64(F.lit(1), *cols), F.xxhash64(F.lit(2), *cols)


def restored(df: DataFrame, like: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of ``like`` out of ``row``; those in ``replaced`` as given."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col("row")[c].alias(c) for c in like.columns])


def with_text(df: DataFrame, like: DataFrame, text_col: str, text: Column) -> DataFrame:
    """``restored`` with a new text; a column ``n_chars`` follows it."""
    replaced = {text_col: text}
    if "n_chars" in like.columns:
        replaced["n_chars"] = F.length(text).cast(like.schema["n_chars"].dataType)
    return restored(df, like, **replaced)


def past_shards(
    shards: DataFrame, passing: DataFrame, run: Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str, first: Callable[[dict], object] = dict
) -> DataFrame:
    """``run(first(shard), row)`` for each shard and each row of ``passing``, as a DataFrame of ``schema``.

    ``shards`` has one row per shard, its number, from 0 on, in ``shard``; numbers may be missing. One copy of a shard moves; the rows of
    ``passing`` are copied to each shard and stream past it, so a task holds one shard and one row of ``passing``.
    Without shards or rows to pass the result is empty.
    """
    last = int(shards.agg(F.max("shard")).first()[0] or 0)
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))
    held = shards.select("shard", F.struct(*shards.columns).alias("held"))
    copies = passing.select(F.explode(numbers).alias("shard"), F.struct(*passing.columns).alias("row"))
    both = held.unionByName(copies, allowMissingColumns=True).repartition("shard")

    def stream(batches):
        number, here = None, None
        for batch in batches:
            for shard, given, row in zip(batch.column("shard"), batch.column("held"), batch.column("row"), strict=True):
                if given.is_valid:
                    number, here = shard.as_py(), first(given.as_py())
                elif number == shard.as_py():
                    yield from run(here, row.as_py())

    return both.sortWithinPartitions("shard", F.col("row").isNotNull()).mapInArrow(stream, schema)
