"""Streaming forms, run to the end over the table files."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatlane.plans import lenses
from heatlane.plans.queries.history import DUE_SQL, FLAGS, HISTORY_SQL, HIST_COLS
from heatlane.plans.queries.priors import POSTERIOR_SQL, signal_prior
from heatlane.plans.registry import query, rounded
from heatlane.session import durable, scratch_path
from heatlane.streaming import history, live, posterior


#: The table as one file or as a folder of part files: a file stream takes a single file by a pattern only.
ORDERS = "{}/orders.parque[t]"


def order_stream(spark, sf):
    schema = lenses.table(spark, sf, "orders").schema
    return spark.readStream.schema(schema).parquet(ORDERS.format(sf))


def race_stream(spark, sf):
    """The payouts lens over a file stream, with a time inside its day."""
    races = lenses.payouts_of(order_stream(spark, sf))
    return races.withColumn("ts", F.timestamp_seconds(F.col("day") * 86400 + F.col("race_no") * 3600))


@query("posterior_stream", POSTERIOR_SQL)
def posterior_stream(spark, sf):
    """Every race, the last day's too."""
    prior = durable(signal_prior(spark, sf), "prior")
    out, _ = posterior.run_bounded(race_stream(spark, sf), prior, "1 day", scratch_path(spark, "stream"))
    return rounded(out, 6)


EVENTS = "{}/events.parque[t]"


@query("history_stream", HISTORY_SQL)
def history_stream(spark, sf):
    """The history features of every arriving start, from state alone."""
    stream = spark.readStream.schema(lenses.table(spark, sf, "events").schema).parquet(EVENTS.format(sf))
    out = history.run_history(
        lenses.seq_of(stream), "user_id", "event_type", "ts", "event_id", "started", FLAGS, "1 day",
        suffix="_entry", root=scratch_path(spark, "history"),
    )
    return rounded(out.select("event_id", "user_id", "event_type", *HIST_COLS))


@query("due_timers", DUE_SQL)
def due_timers(spark, sf):
    """The due jobs of a streamed timeline, fired by one timer each."""
    stream = spark.readStream.schema(lenses.table(spark, sf, "events").schema).parquet(EVENTS.format(sf))
    arrived = F.lit("2024-01-10 00:00:00").cast("timestamp")
    jobs = stream.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("deadline_dt"), arrived.alias("known_at"))
    out = live.replay_due(jobs, 5, "known_at", scratch_path(spark, "due"), keys=["user_id", "event_type"])
    return out.select("event_id", "user_id", "event_type", F.col("run_at").cast("timestamp_ntz").alias("run_at"))


@query(
    "daily_intake",
    "select o_orderkey, o_custkey, 'orders.parquet' as source_file from orders",
)
def daily_intake(spark, sf):
    """Incremental intake of table files; a second run takes nothing twice."""
    root = scratch_path(spark, "intake")
    schema = lenses.table(spark, sf, "orders").schema
    for _ in range(2):
        q = live.daily_intake(
            spark, ORDERS.format(sf), schema, "parquet", f"{root}/rows", f"{root}/state"
        )
        q.awaitTermination()
    table = F.regexp_extract("source_file", r"([^/]+\.parquet)(?:/[^/]*)?$", 1)
    return spark.read.parquet(f"{root}/rows").select("o_orderkey", "o_custkey", table.alias("source_file"))


@query(
    "score_stream",
    """with d as (select o_custkey, avg(o_totalprice) as mean from orders group by 1)
select o_orderkey, round(o_totalprice / mean, 6) + cast(0.0 as double) as p from orders o join d on o.o_custkey = d.o_custkey""",
)
def score_stream(spark, sf):
    """Arriving rows joined to a static prior and scored in ``foreachBatch``."""
    root = scratch_path(spark, "score")
    prior = lenses.table(spark, sf, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("mean"))

    def model(df):
        return df.select("o_orderkey", (F.round(F.col("o_totalprice") / F.col("mean"), 6) + F.lit(0.0)).alias("p"))

    def sink(df, number):
        df.write.mode("overwrite").parquet(f"{root}/rows/batch={number}")

    live.score_stream(
        order_stream(spark, sf), [lambda df: df.join(prior, "o_custkey")], model, sink, f"{root}/state"
    ).awaitTermination()
    return spark.read.parquet(f"{root}/rows").select("o_orderkey", "p")
