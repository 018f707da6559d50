"""Token tables with values derived by hand."""

import pytest
from pyspark.sql import functions as F

from heatlane.functions import points
from heatlane.functions import text as tx
from heatlane.functions import tokens as tk

START = [
    # text, base, race, exhibition
    ("F.01", -0.01, -0.01, -0.01), ("3F.01", -0.01, -0.01, -0.01), ("Ｆ.01", -0.01, -0.01, -0.01),
    ("F01", -0.01, -0.01, -0.01), ("0.07", 0.07, 0.07, 0.07), (".07", 0.07, 0.07, 0.07), ("07", 0.07, 0.07, 0.07),
    ("L.03", 0.03, 0.03, 0.03), ("4L.03", 0.03, 0.03, 0.03), ("4  L", None, None, 0.45), ("L", None, None, None),
    ("F", None, None, None), ("", None, None, None), ("-", None, None, None), ("ー", None, None, None),
    ("0.1.2", None, None, None), ("０.０７", 0.07, 0.07, 0.07), ("０．０７", None, None, None), (None, None, None, None),
    ("3F01", None, None, None), ("f.12", -0.12, -0.12, -0.12), ("　0.11 ", 0.11, 0.11, 0.11),
]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}")


def apply(spark, values, fn, kind="string"):
    df = column(spark, values, kind).select("i", fn(F.col("t")).alias("x")).orderBy("i")
    return [r["x"] for r in df.collect()]


@pytest.mark.parametrize("kind,at", [("base", 1), ("race", 2), ("exhibition", 3)])
def test_start_time(spark, kind, at):
    got = apply(spark, [r[0] for r in START], lambda c: tk.start_time(c, kind))
    assert got == [r[at] for r in START]


def test_start_time_other_kinds(spark):
    assert apply(spark, ["０．０７", "Ｆ．０１"], lambda c: tk.start_time(c, "course")) == [0.07, -0.01]
    got = apply(spark, ["F.09", "L.05", ".07", "0.07", "07", "x", ""], lambda c: tk.start_time(c, "legacy"))
    assert got == [-0.09, 0.05, 0.07, 0.07, 7.0, None, None]
    with pytest.raises(ValueError):
        tk.start_time(F.col("t"), "none")


RANKS = [
    ("1", "finish", 1.0, True, True, True), ("１", "finish", 1.0, True, True, True),
    ("欠", "dns", None, False, False, False), ("F", "fs", None, True, False, True), (" Ｆ ", "fs", None, True, False, True),
    ("Ｌ", "ls", None, True, False, True), ("転", "dsq", None, True, False, True), ("失", "dsq", None, True, False, True),
    ("不", "dnf", None, True, False, True), ("＿", "void", None, False, False, True),
    ("7", "unknown", None, False, False, True), ("F.01", "unknown", None, False, False, True),
    ("", "unknown", None, False, False, False), ("-", "unknown", None, False, False, False),
    (None, "unknown", None, False, False, False),
]


def test_rank(spark):
    got = apply(spark, [r[0] for r in RANKS], tk.parse_rank)
    assert [(g["rank_class"], g["rank_num"], g["is_start"], g["is_finish"]) for g in got] == [r[1:5] for r in RANKS]
    assert apply(spark, [r[0] for r in RANKS], tk.is_started) == [r[5] for r in RANKS]


def test_numbers(spark):
    assert apply(spark, ["1.0", "2", " 3 ", "x", "", "nan", "1.5", None], tx.to_whole) == [1, 2, 3, None, None, None, None, None]
    assert apply(spark, ["1.5", "1e3", ".5", "nan", "inf", "1d", "-2"], tx.to_number) == [1.5, 1000.0, 0.5, None, None, None, -2.0]
    assert apply(spark, ["¥1,230", "￥980円", "特払", ""], tx.payout_amount) == [1230, 980, None, None]
    assert apply(spark, ["1", "6.0", "7", "０", "３", "x"], tx.parse_lane) == [1, 6, None, None, 3, None]
    assert apply(spark, ["True", " yes", "0", None], tx.to_flag) == [True, True, False, False]
    assert apply(spark, ["12%", "33.5 %", "-"], tx.percent) == [12.0, 33.5, None]


def test_keys(spark):
    assert apply(spark, ["1", "1.0", "12", "桐生", "", "nan"], tx.venue_code) == ["01", "01", "12", "桐生", None, None]
    assert apply(spark, ["11101", "11101.0", "12345678", ""], tx.motor_key) == ["011101", "011101", "12345678", None]
    assert apply(spark, ["20240928-3", "20240928_03", "x"], tx.section_key) == ["20240928_03", "20240928_03", "x"]
    assert apply(spark, ["2.02504E+11", " 20250401 ", "nan", ""], tx.race_key) == ["202504000000", "20250401", None, None]
    got = apply(spark, ["20250401", "20250401.0", "2025-04-01", "2025/4/1", "bad"], tx.parse_day)
    assert [str(g) if g else None for g in got] == ["2025-04-01"] * 4 + [None]


def test_meeting(spark):
    df = spark.createDataFrame(
        [("20260114", "1", "1/12-1/17"), ("20260103", "12", "12/29-1/3"), ("20260114", "1", "bad"), ("20260114", "1", None)],
        "day string, code string, schedule string",
    )
    got = df.select(
        tk.section_id(F.col("day"), F.col("code"), F.col("schedule")).alias("s"),
        tk.meeting_days(F.lit(2026), F.col("schedule")).alias("n"),
    ).collect()
    assert [g["s"] for g in got] == ["20260112_01", "20251229_12", "20260114_01", "20260114_01"]
    assert [g["n"] for g in got] == [6, 6, None, None]
    assert apply(spark, ["初日", "最終日", "３日目", "？"], lambda c: tk.meeting_day(c, F.lit(6))) == [1, 6, 3, None]


def test_season_and_labels(spark):
    days = apply(spark, ["2025-03-01", "2025-08-31", "2025-11-30", "2025-12-01", None], lambda c: tk.season(c.cast("date")))
    assert days == ["spring", "summer", "autumn", "winter", None]
    assert apply(spark, [None], lambda c: tk.season(c.cast("date"), "autumn")) == ["autumn"]
    assert apply(spark, ["逃げ", " まくり差し ", "まくり差", None], tk.trick_label) == ["nige", "makurizashi", None, None]
    assert apply(spark, ["桐生", "大村", "東京"], tk.venue_number) == [1, 24, None]
    assert tk.stage_pattern("finals") == "(優勝戦)"  # also matches 準優勝戦
    assert apply(spark, ["1", "4", "5", None], tk.prediction_mark) == [4, 1, 0, 0]
    assert apply(spark, ["山田　　太郎", "　佐藤　花子　"], tx.person_name) == ["山田 太郎", "佐藤 花子"]


def test_points(spark):
    df = spark.createDataFrame(
        [("12", "31"), ("1", "F"), ("5", "L"), ("1-3", "123"), ("123", "1"), ("", ""), (None, "1")], "e string, r string"
    )
    both = df.select(
        points.zip_points(F.col("e"), F.col("r"), "ranking").alias("a"),
        points.zip_points(F.col("e"), F.col("r"), "condition").alias("b"),
    ).collect()
    assert [r["a"] for r in both] == [[-2, 1], [0], [0], [0, 0], [0], [], []]
    assert [r["b"] for r in both] == [[-2, 1], [0], [0], [2, 1], [2], [], []]
    assert apply(spark, ["1", "6", "7", None], lambda c: F.coalesce(points.finish_score(tx.to_whole(c)), F.lit(0))) == [10, 1, 0, 0]


def test_point_table_is_complete(spark):
    t = points.point_table(spark)
    assert t.count() == 36
    # winning from lane 1 and keeping lanes 2 and 3 carry a bonus, keeping lane 6 a malus
    same = {r["entry"]: r["condition_point"] for r in t.where("entry = rank_num").collect()}
    assert same == {1: 2, 2: 1, 3: 1, 4: 0, 5: 0, 6: -1}
