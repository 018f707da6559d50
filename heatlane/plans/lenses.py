"""Race-shaped views over the TPC-H-like and text tables.

Each lens keeps the shape of the domain by construction: a race has at most six
lanes because rows are first aggregated to (race, lane), and a venue day has at
most twelve races because the day number is the order number divided by twelve.
All rows of the base tables take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FULL_WIDTH = "１２３４５６"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rank_text(pick: Column, place: Column) -> Column:
    """A raw result cell: mostly the place, sometimes full-width or an event."""
    return (
        F.when(pick == 0, "F")
        .when(pick == 1, "欠")
        .when(pick == 2, "＿")
        .when(pick == 3, " Ｌ ")
        .when(pick == 4, "転")
        .when(pick == 5, "")
        .when(pick.between(6, 12), F.translate(place.cast("string"), "123456", FULL_WIDTH))
        .otherwise(place.cast("string"))
    )


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(race_id, lane) rows of lineitem; lane 1..6 from the line number."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_orderkey").alias("race_id"), ((F.col("l_linenumber") - 1) % 6 + 1).cast("long").alias("lane")
    ).agg(
        F.min("l_partkey").alias("part"),
        F.min("l_suppkey").alias("player_id"),
        F.max("l_extendedprice").alias("price"),
        F.min("l_quantity").alias("time_tenji"),
        F.max("l_discount").alias("discount"),
    )


def boats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per boat in a race."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("race_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )
    b = lanes(spark, sf_dir).join(o, "race_id")
    place = F.rank().over(Window.partitionBy("race_id").orderBy(F.col("price").desc(), "lane")).cast("long")
    m = F.month("date")
    season = (
        F.when(m.between(3, 5), "spring").when(m.between(6, 8), "summer").when(m.between(9, 11), "autumn").otherwise("winter")
    )
    return b.withColumn("finish", place).select(
        "race_id", "lane", "date", "priority", "status", "part", "player_id", "price", "time_tenji", "discount",
        "finish",
        (F.col("player_id") % 24 + 1).alias("place"),
        (F.col("part") % 60).alias("motor_number"),
        F.trunc("date", "month").alias("section"),
        season.alias("season_q"),
        rank_text(F.col("part") % 50, F.col("finish")).alias("rank_raw"),
    )


def seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rows per (user, event type) with flags and a value."""
    return seq_of(table(spark, sf_dir, "events"))


def seq_of(e: DataFrame) -> DataFrame:
    v = F.col("value")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.coalesce(v >= 20, F.lit(False)).alias("started"),
        F.coalesce(v >= 150, F.lit(False)).cast("long").alias("f1"),
        F.coalesce(v.between(80, 149.99), F.lit(False)).cast("long").alias("f2"),
        F.coalesce(v.between(50, 79.99), F.lit(False)).cast("long").alias("f3"),
    )


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section-like totals: one row per (user, day)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("race_ct"),
        F.max("value").alias("best"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("score"),
    )


def payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One race per order: 24 venues, twelve races per venue and day."""
    return payouts_of(table(spark, sf_dir, "orders"))


def payouts_of(o: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    meeting = F.floor(k / 12)
    return o.select(
        k.alias("race_id"),
        (meeting % 24 + 1).cast("long").alias("venue"),
        F.floor(meeting / 24).cast("long").alias("day"),
        (k % 12 + 1).cast("long").alias("race_no"),
        (c % 6 + 1).alias("r1"),
        (F.floor(c / 6) % 6 + 1).cast("long").alias("r2"),
        (F.floor(c / 36) % 6 + 1).cast("long").alias("r3"),
        F.col("o_totalprice").alias("payout"),
        F.when(c % 17 != 0, c % 120 + 1).alias("popularity"),
        (F.col("o_orderstatus") != "P").alias("valid"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per (user, day); it falls to zero now and then."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        (F.floor(F.max("value")).cast("long") % 4).alias("rate")
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary label with a score that has many ties, grouped by race."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_returnflag") == "R").cast("long").alias("y"),
        ((F.col("l_discount") * 100 + F.col("l_quantity")) / 64).alias("score"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    )
