"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import column, text_of, whole_row

SEED = 42
#: Without given weights, a source weighs its size to this power, which lifts small sources.
POWER = 0.7
#: A Poisson variable of a larger mean is the sum of equal ones below it.
MAX_MEAN = 16.0
#: Terms of the distribution: beyond 64 at a mean of 16 nothing is left of 53 bits.
TERMS = 64
#: Rate tables of up to so many sources are sent to all tasks; larger ones are joined by shuffle.
MAX_BROADCAST = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(2**52))


def _distribution(mean: Column) -> Column:
    """Cumulated probabilities of 0, 1, ... TERMS - 1."""
    none = F.exp(-mean)
    zero = F.struct(none.alias("p"), F.array(none).alias("all"))

    def step(a, k):
        p = a["p"] * mean / k
        return F.struct(p.alias("p"), F.array_append(a["all"], F.element_at(a["all"], -1) + p).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), zero, step, lambda a: a["all"])


def rates(
    docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: Mapping[str | None, float] | None = None,
    power: float = POWER, total: float | None = None,
) -> DataFrame:
    """Per source: ``source``, ``size`` in characters, and ``rate``, the mean number
    of times a document of it has to occur so that sources weigh as asked.

    ``total`` is the expected size of the result, by default that of the input.
    Sources not named in ``weights`` get none; named ones without text are left
    out of the sum. A null source is a source.
    """
    sizes = docs.groupBy(column(source_col).alias("source")).agg(F.sum(F.length(text_of(text_col))).alias("size"))
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(power))
    else:
        weight = F.coalesce(
            *[F.when(F.col("source").eqNullSafe(F.lit(k)), F.lit(float(w))) for k, w in weights.items()], F.lit(0.0)
        )
    weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    sums = weighed.agg(F.sum("weight").alias("weights"), F.sum("size").alias("sizes")).first()  # two numbers
    goal = float((sums["sizes"] or 0) if total is None else total)
    share = F.col("weight") / F.lit(float(sums["weights"] or 1.0))
    return weighed.select("source", "size", F.when(F.col("size") > 0, share * goal / F.col("size")).otherwise(0.0).alias("rate"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Mapping[str | None, float] | None = None, power: float = POWER, total: float | None = None, seed: int = SEED,
) -> DataFrame:
    """Columns ``row`` (all columns), ``copy`` (from 1) and ``rate``: each document
    as often as a Poisson variable of its source's rate says, in random order.

    The variable is the inverse of the distribution at a hash of seed and id, so
    it is the same on each run and needs no other document; rows of one id (or
    with a null id) draw alike. Rates above 16 are sums of several draws. Copies
    are dealt by a hash of id and copy and of the place they come from, so that
    rows of one id don't meet in one task, and sorted by hash there: a global
    shuffle. Null or empty texts have size 0 but are drawn like others of their
    source. An empty table gives an empty result.
    """
    table = rates(docs, source_col, text_col, weights, power, total)
    draws = F.greatest(F.ceil(F.col("rate") / MAX_MEAN), F.lit(1)).cast("int")
    table = table.select("source", "rate", draws.alias("draws")).withColumn("cdf", _distribution(F.col("rate") / F.col("draws")))
    if table.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        table = F.broadcast(table)
    rows = docs.select(whole_row(docs), column(id_col).alias("id"), column(source_col).alias("from"))
    joined = rows.join(table, F.col("from").eqNullSafe(F.col("source")))
    drawn = F.transform(
        F.sequence(F.lit(1), F.col("draws")), lambda j: F.struct(uniform(F.lit(seed), j, F.col("id")).alias("u"))
    )
    inverse = lambda d: F.size(F.filter(F.col("cdf"), lambda c: c <= d["u"]))
    counted = joined.withColumn("drawn", drawn).withColumn("times", F.aggregate("drawn", F.lit(0), lambda n, d: n + inverse(d)))
    copies = counted.filter(F.col("times") > 0).select(
        "row", "id", "rate", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    )
    order = F.xxhash64(F.lit(seed), F.col("id"), F.col("copy"))
    dealt = copies.select("row", "copy", "rate", order.alias("order"), F.xxhash64(order, F.spark_partition_id()).alias("to"))
    return dealt.repartition("to").sortWithinPartitions("order").select("row", "copy", "rate")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents, repeated or left out by the rates of their sources."""
    return mix(docs).select(*[F.col("row")[c].alias(c) for c in docs.columns])
