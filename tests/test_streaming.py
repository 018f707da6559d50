"""Streaming forms against their batch forms."""

import datetime as dt
import time

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from heatlane.ml import preprocess, store, training
from heatlane.operators import regime, windows
from heatlane.streaming import history, live, posterior
from tests.conftest import rows
from tests.test_operators import prior_row

SCHEMA = "race_id long, venue string, day long, race_no long, ts timestamp, r1 long, r2 long, r3 long, valid boolean"


def races():
    out = []
    for day in range(4):
        for no in range(1, 13):
            n = day * 12 + no
            at = dt.datetime(2026, 1, 1 + day, 9) + dt.timedelta(minutes=30 * no)
            out.append((n, "v", day, no, at, n % 6 + 1, (n + 1) % 6 + 1, (n + 2) % 6 + 1, n % 5 != 0))
    return out


def test_posterior_stream_equals_batch(spark, tmp_path):
    data = races()
    prior = prior_row(spark)
    folder = str(tmp_path / "in")
    # arrival order is not race order; a last row far ahead closes the days
    mixed = [*data[6:18], *data[:6], *data[18:]]
    for i in range(0, len(mixed), 12):
        spark.createDataFrame(mixed[i : i + 12], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    end = [(999, "v", 40, 1, dt.datetime(2026, 3, 1), 1, 2, 3, True)]
    prior = prior.withColumn("venue", F.lit("v"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    keyed = stream.withColumn("venue", F.lit(1).cast("long"))
    numeric = prior.withColumn("venue", F.lit(1).cast("long"))
    with posterior.rocksdb_state(spark):
        out = posterior.posterior_stream(keyed, numeric, "2 days")
        posterior.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "state"))
        spark.createDataFrame(end, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        posterior.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = regime.running_posterior(
        spark.createDataFrame(data, SCHEMA), prior, "venue", "day", ["race_no"], ["r1", "r2", "r3"], "valid", keep=["race_id"]
    )
    cols = ["race_id", "observed_races", *[F.round(c, 9).alias(c) for c in batch.columns if c[:2] in ("m_", "st")]]
    assert rows(got.select(*cols)) == rows(batch.select(*cols))


def test_bounded_run_closes_the_last_day_and_finds_late_races(spark, tmp_path):
    data = races()
    folder = str(tmp_path / "in")
    late = data[5]
    for part in ([*data[:5], *data[6:24]], data[24:], [late]):  # a race of day 0 arrives when day 3 is there
        spark.createDataFrame(part, SCHEMA).withColumn("venue", F.lit(1).cast("long")).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    schema = SCHEMA.replace("venue string", "venue long")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    prior = prior_row(spark).withColumn("venue", F.lit(1).cast("long"))
    out, missed = posterior.run_bounded(stream, prior, "12 hours", str(tmp_path / "run"))
    assert rows(missed, "race_id") == [(late[0],)]
    assert sorted(r["race_id"] for r in out.collect()) == [r[0] for r in data if r[0] != late[0]]
    batch = regime.running_posterior(
        spark.createDataFrame([r for r in data if r is not late], SCHEMA).withColumn("venue", F.lit(1).cast("long")), prior,
        "venue", "day", ["race_no"], ["r1", "r2", "r3"], "valid", keep=["race_id"],
    )
    cols = ["race_id", "observed_races", *[F.round(c, 9).alias(c) for c in batch.columns if c[:2] in ("m_", "st")]]
    assert rows(out.select(*cols)) == rows(batch.select(*cols))


def test_races_come_out_during_the_day(spark, tmp_path):
    """The watermark at race 7 releases the races before it, not the whole day at its end."""
    folder = str(tmp_path / "in")
    spark.createDataFrame(races()[:7], SCHEMA).withColumn("venue", F.lit(1).cast("long")).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(SCHEMA.replace("venue string", "venue long")).parquet(folder)
    prior = prior_row(spark).withColumn("venue", F.lit(1).cast("long"))
    with posterior.rocksdb_state(spark):
        posterior.run_to_table(posterior.posterior_stream(stream, prior, "0 seconds"), str(tmp_path / "out"), str(tmp_path / "state"))
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["race_id"] for r in out} >= {1, 2, 3, 4, 5, 6}


def test_streams_read_folders_of_part_files(spark, small, tmp_path):
    import __spark_entry__ as entry_points

    spark.read.parquet(f"{small}/orders.parquet").repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    for name in ("posterior_stream", "daily_intake", "score_stream"):
        query = entry_points.queries()[name]
        assert rows(query(spark, str(tmp_path))) == rows(query(spark, small))


def test_due_stream_is_a_stream_join(spark):
    now = dt.datetime.now()
    jobs = spark.createDataFrame([(i, now + dt.timedelta(minutes=5, seconds=i)) for i in range(-2, 30)], "seq int, deadline_dt timestamp")
    stream = live.due_stream(spark, jobs, 5)
    assert stream.isStreaming
    q = stream.writeStream.format("memory").queryName("due").start()
    deadline = time.time() + 40
    while time.time() < deadline and spark.table("due").count() == 0:
        time.sleep(1)
    q.stop()
    got = spark.table("due").collect()
    assert got and all(abs((r["run_at"] - r["timestamp"]).total_seconds()) < 2 for r in got)


JOBS = "seq int, jcd int, rno int, deadline_dt timestamp, title string, known_at timestamp"


def test_due_timers_replayed_over_a_restart(spark, tmp_path):
    """Two files in two runs of one checkpoint: past jobs skipped, keys once, the earliest run time, state kept in between."""
    at = lambda h, m=0, us=0: dt.datetime(2026, 5, 1, h, m, 0, us)
    first = [
        (1, 2, 1, at(9, 4), "past", at(9)), (2, 2, 2, at(9, 5), "now", at(9)), (3, 2, 3, at(10), "late", at(9)),
        (3, 2, 3, at(9, 50, 123456), "earlier", at(9)), (4, 2, 4, None, "none", at(9)), (5, 2, 5, at(11), "moved", at(9)),
    ]
    second = [(5, 2, 5, at(10, 30), "moved up", at(9, 30)), (2, 2, 2, at(12), "again", at(9, 30)), (6, 2, 6, at(9, 34), "past", at(9, 30)), (6, 2, 6, at(13), "later", at(9, 30))]
    folder, root = str(tmp_path / "jobs"), str(tmp_path / "due")
    spark.createDataFrame(first, JOBS).coalesce(1).write.parquet(folder)
    marker = spark.createDataFrame([(dt.datetime(2200, 1, 1),)], "known_at timestamp")
    marker.limit(0).write.parquet(f"{root}/marker")

    def run():
        jobs = spark.readStream.schema(JOBS).parquet(folder)
        ends = spark.readStream.schema(marker.schema).parquet(f"{root}/marker")
        with posterior.rocksdb_state(spark):
            out = live.due_timers(jobs.unionByName(ends, allowMissingColumns=True), 5, clock="known_at")
            posterior.run_to_table(out, f"{root}/rows", f"{root}/state")
        return rows(spark.read.schema(out.schema).parquet(f"{root}/rows"), "seq", "run_at", "deadline_dt", "title")

    run()
    spark.createDataFrame(second, JOBS).coalesce(1).write.mode("append").parquet(folder)
    run()
    marker.write.mode("append").parquet(f"{root}/marker")
    assert run() == [
        (2, at(9), at(9, 5), "now"), (3, at(9, 45, 123456), at(9, 50, 123456), "earlier"),
        (5, at(10, 25), at(10, 30), "moved up"), (6, at(12, 55), at(13), "later"),
    ]


def test_due_timers_of_the_clock(spark, tmp_path):
    """On the machine's time: a job fires once after its run time, one that has passed never."""
    now = dt.datetime.now()
    jobs = [(1, 2, 1, now + dt.timedelta(minutes=5, seconds=12), "soon"), (2, 2, 2, now + dt.timedelta(minutes=4), "past"), (3, 2, 3, now + dt.timedelta(hours=2), "far")]
    schema = JOBS.removesuffix(", known_at timestamp")
    spark.createDataFrame([*jobs, jobs[0]], schema).coalesce(1).write.parquet(str(tmp_path / "jobs"))
    with posterior.rocksdb_state(spark):
        out = live.due_timers(spark.readStream.schema(schema).parquet(str(tmp_path / "jobs")), 5)
        q = out.withColumn("seen", F.current_timestamp()).writeStream.format("memory").queryName("timers").outputMode("append").trigger(processingTime="1 second").start()
        until = time.time() + 60
        while time.time() < until and spark.table("timers").count() == 0:
            time.sleep(1)
        time.sleep(3)
        q.stop()
    (got,) = spark.table("timers").collect()
    assert got["seq"] == 1 and got["title"] == "soon" and got["seen"] >= got["run_at"]


def test_intake_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    schema = "a int"
    spark.createDataFrame([(1,)], schema).coalesce(1).write.parquet(src)
    live.daily_intake(spark, src, schema, "parquet", out, state).awaitTermination()
    spark.createDataFrame([(2,)], schema).coalesce(1).write.mode("append").parquet(src)
    live.daily_intake(spark, src, schema, "parquet", out, state).awaitTermination()
    assert rows(spark.read.parquet(out), "a") == [(1,), (2,)]


STARTS = "id long, who string, axis long, ts timestamp, started boolean, won long, st double"


def starts(n=240):
    """Starts of three players on two axes; some equal times, some not started, some values missing."""
    at = dt.datetime(2026, 1, 1)
    return [
        (i, None if i % 41 == 0 else f"p{i % 3}", None if i % 37 == 0 else i % 2, at + dt.timedelta(hours=i // 4), i % 7 != 0, i % 5 == 0 and 1 or 0,
         None if i % 11 == 0 else 0.01 * (i % 23))
        for i in range(n)
    ]


def history_of(spark, tmp_path, **kw):
    """The stream over files whose rows come out of order, within a day."""
    data, folder = starts(), str(tmp_path / "in")
    for i in range(0, len(data), 60):
        part = data[i : i + 60]
        spark.createDataFrame([*part[30:], *part[:30]], STARTS).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    stream = spark.readStream.schema(STARTS).option("maxFilesPerTrigger", 1).parquet(folder)
    return history.run_history(
        stream, "who", "axis", "ts", "id", "started", {"won": "won"}, "1 day", value="st", n=5, root=str(tmp_path / "run"), **kw
    )


def test_history_stream_equals_batch(spark, tmp_path):
    got = history_of(spark, tmp_path)
    batch = windows.history_rates(
        spark.createDataFrame(starts(), STARTS), "who", "axis", ["ts", "id"], "started", {"won": "won"}, value="st", n=5
    ).where("who is not null and axis is not null")
    names = history.feature_names(["won"], True, 5, "")
    near = lambda df: rows(df.select("id", "who", "axis", *[F.round(c, 9).alias(c) for c in names]))
    assert near(got) == near(batch) and got.count() > 200


@pytest.mark.parametrize("groups", [1, 2])
def test_history_stream_shares_state_between_keys(spark, tmp_path, groups):
    """Keys of one group don't see each other's rows, and the state store holds no more states than two a group."""
    got = history_of(spark, tmp_path, groups=groups)
    batch = windows.history_rates(
        spark.createDataFrame(starts(), STARTS), "who", "axis", ["ts", "id"], "started", {"won": "won"}, value="st", n=5
    ).where("who is not null and axis is not null")
    names = history.feature_names(["won"], True, 5, "")
    near = lambda df: rows(df.select("id", "who", "axis", *[F.round(c, 9).alias(c) for c in names]))
    assert near(got) == near(batch)
    held = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "run/state"))
    assert 0 < held.count() <= groups


def test_live_starts_get_the_stored_models_score(spark, tmp_path):
    """Features from state, scored by a model read from its folder, equal the batch scores."""
    names = history.feature_names(["won"], True, 5, "")
    batch = windows.history_rates(
        spark.createDataFrame(starts(), STARTS), "who", "axis", ["ts", "id"], "started", {"won": "won"}, value="st", n=5
    ).where("who is not null and axis is not null")
    prepared = preprocess.fit(batch, names)
    model = LogisticRegression(labelCol="won", regParam=0.01).fit(prepared.vector(batch))
    store.save_prepared(spark, prepared, str(tmp_path / "prepared"))
    store.save_model(model, str(tmp_path / "model"))
    ready, loaded = store.load_prepared(spark, str(tmp_path / "prepared")), store.load_model(spark, str(tmp_path / "model"))
    history_of(spark, tmp_path)
    arriving = spark.readStream.schema(spark.read.parquet(str(tmp_path / "run/rows")).schema).parquet(str(tmp_path / "run/rows"))
    live.score_stream(
        arriving, [ready.vector], lambda df: training.score(loaded, df, "p").select("id", F.round("p", 9).alias("p")),
        lambda df, number: df.write.mode("overwrite").parquet(str(tmp_path / f"scores/batch={number}")), str(tmp_path / "score-state"),
    ).awaitTermination()
    want = training.score(model, prepared.vector(batch), "p").select("id", F.round("p", 9).alias("p"))
    assert rows(spark.read.parquet(str(tmp_path / "scores")), "id", "p") == rows(want)


def test_next_races_count_by_venue():
    """Two venues of one day in one call: each race sees the valid races of its own venue before it, and what state held."""
    import numpy as np

    lines = np.array([[3, 2, 2, 0, 1, 2, 3, 1], [1, 1, 1, 0, 1, 2, 3, 1], [4, 1, 2, 0, 4, 1, 6, 0], [2, 2, 1, 0, 1, 2, 3, 1]], np.int64)
    held = np.zeros(19, np.int64)
    held[0], held[1] = 5, 5
    out, counts = posterior.next_races(lines, {2: held})
    assert out["race_id"].tolist() == [1, 4, 2, 3] and out["observed_races"].tolist() == [0, 1, 5, 6]
    assert out["hits_win_1"].tolist() == [0, 1, 5, 6] and counts[1][0] == 1 and counts[2][:2].tolist() == [7, 7]
