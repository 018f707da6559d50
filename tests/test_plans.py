"""The whole chain on generated raw rows: shape, exclusion, leak freedom."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from heatlane import schemas
from heatlane.operators import ranges
from heatlane.plans import master
from tests.conftest import rows

START = dt.date(2025, 4, 1)


def raw_rows(last_rank=None):
    rng = random.Random(7)
    out = []
    for n in range(60):
        day = START + dt.timedelta(days=n // 2)
        place, code = (("桐生", "1"), ("住之江", "12"))[n % 2]
        race = f"{day:%Y%m%d}{int(code):02d}01"
        order = rng.sample(range(1, 7), 6)
        for lane in range(1, 7):
            row = {f.name: "" for f in schemas.RAW.fields}
            row.update(
                race_id=race, date=f"{day:%Y%m%d}", place=place, code=code, R="1", wakuban=str(lane), entry=str(lane),
                entry_tenji=str(lane), player_id=str(4000 + (n * 6 + lane * 5) % 20), player="x", rank=str(order[lane - 1]),
                ST=f".{rng.randrange(5, 30):02d}", ST_tenji=f".{rng.randrange(5, 30):02d}", time_tenji=f"6.{rng.randrange(60, 95)}",
                motor_number=str(lane), N_winning_rate="5.5", weather="晴", wind_direction="wind1", temperature="15",
                wind_speed="2", water_temperature="14", wave_height="1", winning_trick="逃げ",
                race_name="優勝戦" if n % 10 == 0 else "予選", schedule="4/1-4/30", section_id=f"20250401_{int(code):02d}",
            )
            if n == 3 and lane == 6:
                row["rank"] = "Ｆ"
            if n == 5 and lane == 1:
                row["ST_tenji"] = "L"
            if n == 7 and lane == 2:
                row["temperature"] = "N/A"
            if n == 9 and lane == 4:
                row["rank"] = "＿"
            if n == 59 and last_rank is not None and lane == 1:
                row["rank"] = last_rank
            out.append(tuple(row[f.name] for f in schemas.RAW.fields))
    return out


@pytest.fixture(scope="module")
def world(spark):
    raw = spark.createDataFrame(raw_rows(), schemas.RAW)
    snap = [(code, lane, START + dt.timedelta(days=d), 0.0 if d == 15 else 30.0) for code in (1, 12) for lane in range(1, 7) for d in (0, 10, 15, 20)]
    snaps = spark.createDataFrame(snap, "code int, motor_number int, date date, motor_2rentai_rate double")
    snaps = snaps.withColumn("snapshot_id", F.concat(F.date_format("date", "yyyyMMdd"), F.lit("_"), F.col("code").cast("string")))
    ids = ranges.motor_id_map(snaps, gap=10)
    with_motor = master.raw_with_motor(raw, snaps, ids)
    features = master.section_features(with_motor)
    info = raw.select("race_id", "player_id").withColumn("score", F.lit(8.0)).withColumn("ST_previous_time", F.lit("0.12"))
    pri = master.build_priors(raw, START, "2025-12-31")
    return dict(raw=raw, snaps=snaps, ids=ids, with_motor=with_motor, features=features, info=info, pri=pri)


def build(world, raw=None, **kw):
    p = world["pri"]
    return master.build_master(
        raw if raw is not None else world["raw"], p["tenji"], p["season_course"], p["winning_trick"], world["info"],
        world["ids"], world["features"], "2025-04-01", "2025-06-30", **kw,
    )


def test_master_shape(world):
    out, excluded = build(world)
    out = out.cache()
    assert out.count() == (60 - 4) * 6
    assert out.select("race_id", "wakuban").distinct().count() == out.count()
    assert {r["rule_key"] for r in excluded.collect()} == {"rank_nonnumeric", "weather_missing_any", "sttenji_nonnumeric"}
    assert excluded.select("race_id").distinct().count() == 4
    for c in ("tenji_z_rank", "base_p1", "lr_p_nige", "finish1_rate_last10_entry", "st_std_last10_waku", "motor_id",
              "motor_prev1_motor_race_ct", "ST_previous_time_num", "race_ct_clip6", "ST_tenji_rank", "tenji_top2"):
        assert c in out.columns, c
    assert out.where("motor_id is null").count() == 0
    assert out.select("ST_previous_time_num").first()[0] == pytest.approx(0.12)
    first = out.where("date = '2025-04-01'").agg(F.max("finish1_cnt_last10_entry")).first()[0]
    assert first == 0
    out.unpersist()


def test_stage_subset(world):
    out, _ = build(world, stages="finals")
    assert out.select("race_id").distinct().count() == 6


def test_last_result_does_not_change_its_own_features(world, spark):
    other = spark.createDataFrame(raw_rows(last_rank="1"), schemas.RAW)
    cols = [f"{f}_last10_{a}" for a in ("entry", "waku") for f in ("finish1_rate", "finish1_cnt", "finish3_rate", "st_mean")]
    race = "202504301201"
    a, b = (build(world, raw)[0].where(F.col("race_id") == race) for raw in (world["raw"], other))
    assert rows(a, "wakuban", *cols) == rows(b, "wakuban", *cols)


def test_motor_tables(world):
    assert world["with_motor"].count() == 59 * 6  # the void race is gone
    assert rows(world["ids"].where("code = 1 and motor_number = 1"), "motor_id") == [("010101",), ("010102",)]
    feats = world["features"]
    assert feats.where("motor_race_ct is null").count() == 0
    one = feats.where("motor_id = '010101'").first()
    assert one["prev1_motor_score_rate"] is None and one["motor_race_ct"] > 0


def test_reports(world):
    bad = {(r["column"], r["bad_value"]): r["count"] for r in master.anomalies(world["raw"]).collect()}
    assert bad["rank", "Ｆ"] == 1 and bad["temperature", "N/A"] == 1 and bad["ST_tenji", "L"] == 1
    rep = {r["column"]: r["n_null"] for r in master.conversion_report(master.cast_and_clean(world["raw"])).collect()}
    assert rep["rank"] == 2 and rep["temperature"] == 1 and rep["wakuban"] == 0


def test_live_rows(world, spark):
    live = world["raw"].where("race_id = '202504301201'").drop("rank", "ST", "entry").withColumn("extra", F.lit(1))
    broken = live.withColumn("race_id", F.lit("x")).withColumn("ST_tenji", F.when(F.col("wakuban") == "1", "L").otherwise(F.col("ST_tenji")))
    hist = master.history_table(world["raw"].where("race_id <> '202504301201'"), "2025-04-30", "2025-04-30")
    p = world["pri"]
    out, stopped = master.prepare_live(
        live.unionByName(broken), schemas.RAW, p["tenji"], p["season_course"], p["winning_trick"], hist
    )
    assert out.count() == 6 and stopped.count() == 6
    trained, _ = build(world)
    trained = trained.where("race_id = '202504301201'")
    same = ["wakuban", "finish1_cnt_last10_entry", "finish1_rate_last10_waku", "tenji_rank"]
    assert rows(out, *same) == rows(trained, *same)
    assert out.select("score").first()[0] == 0.0


def test_scratch_is_dropped_for_this_application_only(spark, tmp_path, monkeypatch):
    from heatlane import session

    monkeypatch.setattr(session, "scratch_root", lambda _: f"file://{tmp_path}")
    (tmp_path / "heatlane" / "other").mkdir(parents=True)
    assert session.durable(spark.range(3), "x").count() == 3
    assert len(list((tmp_path / "heatlane").iterdir())) == 2
    session.drop_scratch(spark)
    assert [p.name for p in (tmp_path / "heatlane").iterdir()] == ["other"]
