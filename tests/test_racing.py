"""Page extraction, from HTML to race rows."""

import datetime as dt

import pytest

from heatlane.sources import markup, racing
from tests import race_pages as html
from tests.conftest import rows


def pages(spark, *pairs):
    return spark.createDataFrame(list(pairs), "page_id string, html string")


def test_cells_follow_spans(spark):
    got = markup.page_cells(pages(spark, ("p", html.motor_ranking())))
    head = racing.header_names(got.where("table_no = 0"))
    assert [r[1] for r in rows(head, "grid_col", "name")] == [
        "順位_順位", "モーター_番号", "モーター_2連対率", "ボート_番号", "ボート_2連対率", "前検タイム_前検タイム",
    ]


def test_racelist(spark):
    out = racing.extract_racelist(pages(spark, (f"racelist{html.RACE}", html.card())))
    assert out.count() == 6
    one = out.where("wakuban = 2").first()
    assert (one["race_id"], one["player_id"], one["entry_history"], one["rank_history"]) == (html.RACE, "4442", "35", "1F")
    assert (one["race_ct_current"], one["score"], one["score_rate"], one["boat_color"]) == (2, 10, 5.0, "35")
    assert one["ST_timing"] == "0.120F.01" and one["ST_previous_time"] == "F.01"
    assert one["ST_mean_current"] == pytest.approx(0.06) and one["ST_rank_current"] == 1
    # entry 3 won: 2 ranking points; a false start from entry 5 is neutral
    assert (one["ranking_point"], one["ranking_point_sum"], one["condition_point_rate"]) == ("2 0", 2, 1.0)


def test_motor_snapshot(spark):
    out = racing.extract_motor_snapshot(pages(spark, ("rankingmotor20260114_01", html.motor_ranking())))
    assert rows(out) == [
        ("20260114_01", dt.date(2026, 1, 14), 1, 12, 1, 6.71, 45.5), ("20260114_01", dt.date(2026, 1, 14), 1, 7, 2, None, None),
    ]


def test_plain_pages_take_the_short_way(monkeypatch):
    odd = ["<td>a", "</p><td>b</td>", '<table><tr><td class="a b" rowspan="2">x<br>y<td>z</table>t', '<p class="">a > b', "<title><p>x</title>", "a < b", ""]
    for page in [html.motor_ranking(), html.card(), html.payouts(), html.deadlines(), *odd]:
        slow = markup._cells_of("p", page + "<!-- -->"), markup._elements_of("p", page + "<!-- -->", {"p", "td", "br"})
        assert (markup._cells_of("p", page), markup._elements_of("p", page, {"p", "td", "br"})) == slow
    monkeypatch.setattr(markup._Walker, "feed", None)
    assert markup._cells_of("p", html.motor_ranking())


def test_motor_snapshot_broadcasts_no_cells(spark, capsys):
    racing.extract_motor_snapshot(pages(spark, ("rankingmotor20260114_01", html.motor_ranking()))).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_payouts(spark):
    good, bad = racing.extract_payouts(pages(spark, ("pay20260114", html.payouts()), ("nodate", html.payouts())))
    got = {(r["場名"], r["R"]): r for r in good.collect()}
    assert set(got) == {("桐生", 1), ("住之江", 1), ("桐生", 2)}
    a, b, c = got["桐生", 1], got["住之江", 1], got["桐生", 2]
    assert (a["1着"], a["2着"], a["3着"], a["払戻金"], a["人気"], a["is_valid_result_row"]) == (1, 2, 3, 1230, 4, True)
    assert (a["グレード"], a["開催タイプ"], a["日数"], a["シリーズ名"], a["race_id"]) == ("G1", "ナイター", "初日", "G1", "202601140101")
    assert (b["code"], b["シリーズ名"], b["グレード"], b["人気"]) == (12, "オールレディース", "一般", 101)
    assert c["is_valid_result_row"] is False
    assert rows(bad, "場名", "column", "value") == [("桐生", "1着", "不成立"), ("桐生", "払戻金", "特払い")]
    assert racing.extract_payouts(pages(spark, ("pay20260114", html.payouts())), start="20260115")[0].count() == 0


def test_timeline(spark):
    p = pages(spark, ("day_01", html.deadlines()), ("day_12", html.deadlines(cancelled=True)), ("day_03", "<p>none</p>"))
    out = racing.extract_timeline(p, "20260114")
    assert out.count() == 12
    first = out.orderBy("seq").first()
    assert (first["race_id"], first["jcd"], first["rno"], first["deadline"], first["title"]) == ("202601140101", "1", "1", "10:00", "新春カップ")
    assert str(first["deadline_dt"]) == "2026-01-14 10:00:00"
    assert rows(racing.missing_pages(p, markup.page_cells(p))) == [("day_03",)]


def test_race_day(spark):
    key = f"x{html.RACE}"
    raw, refund = racing.extract_race_day(
        pages(spark, (key, html.card())), pages(spark, (key, html.forecast())), pages(spark, (key, html.before())),
        pages(spark, (key, html.result())), pages(spark, ("pay20260114", html.venues())),
        pages(spark, ("index20260114", html.meetings())), pages(spark, ("raceindex2026011401", html.index())),
    )
    assert raw.count() == 6
    two = raw.where("wakuban = 2").first()
    assert (two["player_id"], two["AB_class"], two["player"], two["team"], two["origin"]) == ("4442", "A1", "山田 2郎", "東京", "大阪")
    assert (two["age"], two["weight"], two["F"], two["L"], two["ST_mean"]) == (32, 52.0, 0, 1, 0.12)
    assert (two["N_winning_rate"], two["motor_number"], two["boat_3rentai_rate"]) == (6.2, 12, 55.5)
    assert (two["run_once"], two["timetable"], two["R"], two["code"]) == (0, "13:00", 7, "01")
    assert (two["pred_mark"], two["race_name"], two["precondition_1"]) == (1, "優勝戦", "進入固定")
    assert (two["entry_tenji"], two["ST_tenji"], two["time_tenji"], two["counter_weight"]) == (3, ".33", "6.72", "2.5")
    assert (two["temperature"], two["weather"], two["wind_speed"], two["wind_direction"], two["wave_height"]) == (16.5, "晴", 3.0, "wind13", 2.0)
    assert (two["rank"], two["entry"], two["ST"], two["ST_rank"], two["winning_trick"]) == ("３", 3, 0.12, 3, "逃げ")
    assert (two["henkan_ticket"], two["remarks"], two["sex"], two["is_wakunari"]) == ("6号艇返還", "備考", "女性", 0)
    assert (two["place"], two["race_grade"], two["race_type"], two["race_attribute"]) == ("桐生", "G1b", "nighter", "分類なし")
    assert (two["title"], two["schedule"], two["day"], two["section"], two["section_id"]) == ("新春カップ", "1/12-1/17", 3, 6, "20260112_01")
    six = raw.where("wakuban = 6").first()
    assert (six["ST"], six["ST_rank"], six["ST_mean"], six["run_once"]) == (None, None, 0.19, 1)
    assert [r["cells"] for r in refund.collect()] == [["3連単", "1-3-2"]]


def test_race_days_side_by_side(spark):
    """Two days of pages give each race its own six boats and its own day's meeting."""
    days = ("20260114", "20260115")
    races = [d + html.RACE[8:] for d in days]
    of_race = lambda page: pages(spark, *[(f"x{r}", page(r) if page is html.card else page()) for r in races])
    of_day = lambda name, page, more="": pages(spark, *[(f"{name}{d}{more}", page()) for d in days])
    raw, _ = racing.extract_race_day(
        of_race(html.card), of_race(html.forecast), of_race(html.before), of_race(html.result),
        of_day("pay", html.venues), of_day("index", html.meetings), of_day("raceindex", html.index, "01"),
    )
    assert rows(raw.groupBy("race_id").count()) == [(r, 6) for r in races]
    assert raw.where("place is null or title is null or sex is null").count() == 0


def test_conditions_before_first_report(spark):
    out = racing.before_rows(pages(spark, (html.RACE, html.before(early=True)))).first()
    assert (out["temperature"], out["wind_direction"], out["weather"]) == (None, None, "晴")


def test_unclosed_markup(spark):
    p = pages(spark, ("a", "<ul><li>one<li>two</ul><p>x<p>y <b>z"), ("b", None))
    assert [r[1] for r in rows(markup.page_elements(p, ["li", "p"]), "seq", "text")] == ["one", "two", "x", "y z"]
