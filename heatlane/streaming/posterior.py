"""Running posterior on a stream, keyed by day.

State per key is the races that wait and the counts so far of each venue, both packed, so that a day of some 300 races costs a few
calls to the state store. Priors don't change and are joined to the counts that come out. A race waits until
the watermark has reached its time, so that all races before it are there; then it
is emitted with the counts before it and counted. That gives the batch numbers
whatever the arrival order within the delay. When the watermark passes the end
of the day, the state is cleared. ``run_bounded`` ends a finite input: it moves the
watermark past all days, so that no race keeps waiting, and returns the races that
came later than the delay apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heatlane.operators.joins import lookup_join
from heatlane.operators.regime import KINDS, LANES, valid_result
from heatlane.session import STATE_STORE

KEYS = ["day"]
BASES = [f"base_{kind}_{k}" for kind in KINDS for k in LANES]
HITS = [f"hits_{kind}_{k}" for kind in KINDS for k in LANES]
#: A race in state, all longs: no number is the least long, no place is 0.
FIELDS = ["race_id", "venue", "race_no", "ts_ms", "r1", "r2", "r3", "ok"]
NO_NUMBER = -(1 << 63)
OUTPUT = "race_id long, venue long, day long, race_no long, observed_races long, " + ", ".join(f"{h} long" for h in HITS)
#: A venue day has twelve races; a key with far more isn't a venue day.
MAX_WAITING = 1000
DAY_MS = 86_400_000
#: Later than any race, and within the range of nanosecond times.
FAR = "2200-01-01 00:00:00"


def next_races(races: np.ndarray, counts: dict[int, np.ndarray]) -> tuple[pd.DataFrame, dict[int, np.ndarray]]:
    """Observed races and hits before each race (lines of ``FIELDS``), by venue in race order, and each venue's counts after all."""
    races = races[np.lexsort((races[:, 0], races[:, 2], races[:, 1]))]
    ok, places = races[:, 7:8], races[:, 4:7]
    hits = [(places[:, :depth, None] == np.array(list(LANES))).sum(axis=1) for depth in KINDS.values()]
    one = np.hstack([ok, *[h * ok for h in hits]]).astype(np.int64)
    venues, first, size = np.unique(races[:, 1], return_index=True, return_counts=True)
    start = np.array([counts.get(int(v), np.zeros(1 + len(HITS), np.int64)) for v in venues])
    upto = np.cumsum(one, axis=0)
    before = upto - one + np.repeat(start - (upto - one)[first], size, axis=0)
    out = pd.DataFrame(before, columns=["observed_races", *HITS])
    out.insert(0, "race_no", races[:, 2])
    out.insert(0, "venue", races[:, 1])
    out.insert(0, "race_id", races[:, 0])
    last = first + size - 1
    return out, {**counts, **dict(zip(venues.tolist(), before[last] + one[last], strict=True))}


class DayPosterior(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "races binary")
        self.counts = handle.getValueState("counts", "counts binary")

    @staticmethod
    def packed(state, width: int) -> np.ndarray:
        return np.frombuffer(bytes(state.get()[0]) if state.exists() else b"", np.int64).reshape(-1, width)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh, last = [], None
        for pdf in rows:
            pdf = pdf[pdf["race_id"].notna()]  # the rest are markers that only move the watermark
            if len(pdf):
                last = int(pdf["day_end_ms"].iloc[0])
                fresh.append(pdf[FIELDS].to_numpy(dtype=np.int64))
        if fresh:
            held = np.vstack([self.packed(self.waiting, len(FIELDS)), *fresh])
            self.waiting.update((held.tobytes(),))
            self.handle.registerTimer(min(last, *(int(f[:, 3].min()) for f in fresh)))
            self.handle.registerTimer(last)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = self.packed(self.waiting, len(FIELDS))
        if len(held) and (most := np.unique(held[:, 1], return_counts=True)[1].max()) > MAX_WAITING:
            raise ValueError(f"{most} races wait for a venue on day {key}")
        due, rest = held[held[:, 3] <= now], held[held[:, 3] > now]
        over = expiredTimerInfo.getExpiryTimeInMs() % DAY_MS == 0 and not len(rest)
        if not len(due):
            if over:
                self.counts.clear()
            yield pd.DataFrame()
            return
        lines = self.packed(self.counts, 2 + len(HITS))
        out, counts = next_races(due, {int(line[0]): line[1:] for line in lines})
        if len(rest):
            self.waiting.update((rest.tobytes(),))
            self.handle.registerTimer(int(rest[:, 3].min()))
        else:
            self.waiting.clear()
        if over:
            self.counts.clear()
        else:
            self.counts.update((np.array([[v, *c] for v, c in counts.items()], np.int64).tobytes(),))
        out.insert(2, "day", key[0])
        yield out

    def close(self) -> None:
        pass


def posterior_stream(
    races: DataFrame, prior: DataFrame, delay: str, ranks: Sequence[str] = ("r1", "r2", "r3"), strength: float = 20.0
) -> DataFrame:
    """Streaming form of ``running_posterior``.

    ``races``: streaming (race_id, venue, day, race_no, ts, r1..r3, valid); ``ts`` lies
    on the race's day and rises with its number. ``prior``: static, one row per
    venue. ``delay``: how much later than others a race may arrive, such as
    "1 day"; later ones are left out by Spark (see ``run_bounded``).
    """
    day_end = (F.unix_date(F.to_date("ts")) + 1).cast("long") * DAY_MS
    known = prior.select("venue").withColumn("__known", F.lit(True))
    ready = (
        lookup_join(races.withWatermark("ts", delay), known, ["venue"])
        .where("__known").drop("__known")
        .withColumn("ok", valid_result(ranks, "valid").cast("long"))
        .withColumns({"day_end_ms": day_end, "ts_ms": F.unix_millis("ts"), "race_no": F.coalesce("race_no", F.lit(NO_NUMBER))})
        .withColumns({to: F.coalesce(F.col(r).cast("long"), F.lit(0)) for to, r in zip(("r1", "r2", "r3"), ranks, strict=True)})
        .select("race_id", *FIELDS[1:], "day", "day_end_ms", "ts")
    )
    counted = ready.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=DayPosterior(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )
    out = lookup_join(counted, prior.select("venue", *BASES), ["venue"])
    seen, cols = F.col("observed_races"), {}
    for kind, depth in KINDS.items():
        base = {k: F.col(f"base_{kind}_{k}") for k in LANES}
        post = {k: (depth * F.lit(float(strength)) * base[k] + F.col(f"hits_{kind}_{k}")) / (depth * F.lit(float(strength)) + depth * seen) for k in LANES}
        cols.update({f"m_{kind}_{k}": post[k] / base[k] for k in LANES})
        cols[f"strength_{kind}"] = sum((F.abs(post[k] - base[k]) for k in LANES), F.lit(0.0))
    names = [*[f"m_{kind}_{k}" for kind in KINDS for k in LANES], *[f"strength_{kind}" for kind in KINDS]]
    race_no = F.nullif(F.col("race_no"), F.lit(NO_NUMBER)).alias("race_no")
    return out.select("race_id", "venue", "day", race_no, "observed_races", *[cols[n].alias(n) for n in names])


@contextmanager
def rocksdb_state(spark: SparkSession):
    """State store that ``transformWithState`` needs, for queries started inside."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Take in everything that is there, append to Parquet, stop."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_bounded(races: DataFrame, prior: DataFrame, delay: str, root: str, **kw) -> tuple[DataFrame, DataFrame]:
    """Run a finite stream of races to its end: (posterior rows, races that came too late).

    The second run takes in one marker row far ahead, which closes all days. A
    race is late if the first run left it out although its venue has a prior; it
    is found by comparing the races taken in, which are written on the way, with
    those that came out.
    """
    spark = races.sparkSession
    empty = prior.limit(1).select(F.lit(None).cast("long").alias("race_id"), "venue", F.to_timestamp(F.lit(FAR)).alias("ts"))
    empty.limit(0).write.mode("overwrite").parquet(f"{root}/marker")
    marker = spark.readStream.schema(empty.schema).parquet(f"{root}/marker")
    run_to_table(races, f"{root}/taken", f"{root}/taken-state")
    with rocksdb_state(spark):
        out = posterior_stream(races.unionByName(marker, allowMissingColumns=True), prior, delay, **kw)
        run_to_table(out, f"{root}/rows", f"{root}/state")
        empty.write.mode("append").parquet(f"{root}/marker")
        run_to_table(out, f"{root}/rows", f"{root}/state")
    rows = spark.read.schema(out.schema).parquet(f"{root}/rows")
    taken = spark.read.schema(races.schema).parquet(f"{root}/taken").join(prior.select("venue"), "venue", "left_semi")
    return rows, taken.join(rows.select("race_id"), "race_id", "left_anti")
