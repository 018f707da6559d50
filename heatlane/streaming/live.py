"""Live-side helpers: guards, due jobs, scoring of arriving races, daily intake."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heatlane.operators.filters import over_group
from heatlane.streaming.posterior import FAR, rocksdb_state, run_to_table

# Text form of times that keeps the microseconds.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
DAY_MS = 86_400_000


def guard_races(df: DataFrame, race: str, col: str) -> tuple[DataFrame, DataFrame]:
    """(races to go on with, races stopped): one missing value stops the race. Rows without a race go on."""
    stop = F.col(race).isNotNull() & F.bool_or(F.col(col).isNull()).over(over_group(df, race))
    flagged = df.withColumn("__stop", stop)
    return flagged.where(~F.col("__stop")).drop("__stop"), flagged.where("__stop").drop("__stop")


def due_stream(spark: SparkSession, timeline: DataFrame, minutes: int, deadline: str = "deadline_dt",
               rows_per_second: int = 1) -> DataFrame:
    """One tick a second of the rate source against the static timeline: each tick emits the
    jobs whose run time fell into the second before it. ``due_timers`` needs no ticks, knows each
    job once and takes a timeline that is a stream itself."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    ticks = ticks.where(F.col("value") % rows_per_second == 0)
    jobs = timeline.withColumn("run_at", F.col(deadline) - F.make_dt_interval(mins=F.lit(minutes)))
    jobs = jobs.withColumn("__tick", F.date_trunc("second", F.col("run_at")))
    now = ticks.withColumn("__tick", F.date_trunc("second", F.col("timestamp")))
    return now.join(jobs, "__tick").drop("__tick", "value")


class DueTimer(StatefulProcessor):
    """One armed timer per job key; the earliest run time asked for counts.

    A fired job is remembered for ``keep_ms``, so that its key does not fire again; then its state goes.
    """

    def __init__(self, keys: Sequence[str], keep_ms: int):
        self.keys, self.keep_ms = list(keys), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", "run_us long, rest string, fired boolean")

    @staticmethod
    def timer(run_us: int) -> int:
        """Milliseconds at which ``run_us`` has come."""
        return -(-run_us // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked = ((int(us), rest) for pdf in rows for us, rest in zip(pdf["run_us"], pdf["rest"]) if pd.notna(us))
        best = min(asked, default=None)
        held = self.job.get() if self.job.exists() else None
        if best is not None and (held is None or (not held[2] and best < (held[0], held[1]))):
            if held is not None:
                self.handle.deleteTimer(self.timer(held[0]))
            self.job.update((*best, False))
            self.handle.registerTimer(self.timer(best[0]))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run_us, rest, fired = self.job.get() if self.job.exists() else (None, None, True)
        if fired:
            self.job.clear()
            yield pd.DataFrame()
            return
        self.job.update((run_us, rest, True))
        self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.keep_ms)
        out = {name: [value] for name, value in zip(self.keys, key)}
        yield pd.DataFrame({**out, "run_us": [run_us], "rest": [rest]})

    def close(self) -> None:
        pass


def due_timers(
    jobs: DataFrame, minutes: int, deadline: str = "deadline_dt", keys: Sequence[str] = ("seq", "jcd", "rno"),
    clock: str | None = None, delay: str = "0 seconds", keep_ms: int = DAY_MS,
) -> DataFrame:
    """Streaming form of ``filters.due_jobs``: each job once, at ``deadline`` - ``minutes``, with ``run_at``.

    ``jobs`` is a stream of timeline rows. Jobs whose run time has passed when they arrive, and those
    without deadline or key, are left out. Several rows of a key are one job, the earliest run time counts (of equal ones the
    least text of the other columns); a key asked for again within ``keep_ms`` of its run is not run again.
    Armed jobs lie in state, so a restarted stream goes on with them, and one that fell due in between fires then.

    Without ``clock`` the time is that of the machine. With ``clock``, the column that says when a row
    arrived, a stored timeline is replayed: time is the watermark of that column less ``delay``.
    """
    kinds, live = dict(jobs.dtypes), clock is None
    rest = [f for f in jobs.schema.fields if f.name not in (*keys, clock)]
    run_at = F.col(deadline).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    ready = jobs if live else jobs.withWatermark(clock, delay)
    now = F.current_timestamp() if live else F.col(clock)
    texts = F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in rest]), EXACT_TIMES)
    ready = ready.where(run_at.isNull() | (run_at >= now)).select(
        *keys, *([] if live else [clock]), F.unix_micros(run_at).alias("run_us"), texts.alias("rest")
    )
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "run_us long", "rest string"])
    out = ready.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=DueTimer(keys, keep_ms), outputStructType=schema, outputMode="Append",
        timeMode="ProcessingTime" if live else "EventTime",
    )
    row = F.from_json("rest", T.StructType(rest), EXACT_TIMES)
    return out.select(*keys, F.timestamp_micros("run_us").alias("run_at"), row.alias("__row")).select(*keys, "run_at", "__row.*")


def replay_due(jobs: DataFrame, minutes: int, clock: str, root: str, **kw) -> DataFrame:
    """Replay a finite timeline to its end. The second run takes in one marker row far
    ahead, at which every armed job fires."""
    spark = jobs.sparkSession
    marker = spark.range(1).select(F.to_timestamp(F.lit(FAR)).alias(clock))
    marker.limit(0).write.mode("overwrite").parquet(f"{root}/marker")
    ends = spark.readStream.schema(marker.schema).parquet(f"{root}/marker")
    with rocksdb_state(spark):
        out = due_timers(jobs.unionByName(ends, allowMissingColumns=True), minutes, clock=clock, **kw)
        run_to_table(out, f"{root}/rows", f"{root}/state")
        marker.write.mode("append").parquet(f"{root}/marker")
        run_to_table(out, f"{root}/rows", f"{root}/state")
    return spark.read.schema(out.schema).parquet(f"{root}/rows")


def score_stream(
    races: DataFrame,
    prepare: Sequence[Callable[[DataFrame], DataFrame]],
    score: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
):
    """Score arriving races with the training features, batch by batch.

    ``prepare`` are the same DataFrame functions the training plan uses (joins to
    priors and history snapshots); ``score`` applies the fitted model.
    """

    def each(batch: DataFrame, number: int) -> None:
        ready = batch
        for step in prepare:
            ready = ready.transform(step)
        sink(score(ready), number)

    return (
        races.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_intake(spark: SparkSession, folder: str, schema, fmt: str, target: str, checkpoint: str, **options):
    """Append files that have arrived since the last run; the checkpoint knows
    which ones were taken. Stops when all present files are in."""
    rows = spark.readStream.format(fmt).schema(schema).options(**options).load(folder)
    rows = rows.withColumn("source_file", F.col("_metadata.file_path"))
    return (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
