"""Race pages of many days, made from the orders, through the page extractors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.functions import tokens as tk
from heatlane.plans import lenses
from heatlane.plans.registry import CONDITION_SQL, RANKING_SQL, lens, query, r, rounded
from heatlane.sources import racing

FIRST_DAY = "2024-01-01"


def ymd(day: Column) -> Column:
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), day.cast("int")), "yyyyMMdd")


def two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def html(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def deadline_pages(spark, sf) -> DataFrame:
    """One page per venue and day with twelve deadlines; some days are called off."""
    g = lenses.payouts(spark, sf).groupBy("day", "venue").agg(F.min("race_id").alias("first"), F.sum("r1").alias("s"))
    cells = F.transform(
        F.sequence(F.lit(1), F.lit(12)),
        lambda i: html("<td>", (i + 9).cast("string"), ":", two((F.col("s") + i) % 60), "</td>"),
    )
    return g.select(
        F.concat_ws("_", ymd(F.col("day")), two(F.col("venue"))).alias("page_id"),
        html(
            '<h3 class="title12_title">', F.when(F.col("first") % 7 == 0, "レース中止").otherwise("開催中"), "</h3><h2>第",
            F.col("s").cast("string"), '回カップ</h2><div class="table1"><table><tbody><tr><th>レース</th></tr><tr><th>締切予定時刻</th>',
            F.array_join(cells, ""), "</tr></tbody></table></div>",
        ).alias("html"),
    )


def payout_pages(spark, sf) -> DataFrame:
    """One page per day: three cells per venue and race. A day has 24 venues of twelve races at most."""
    p = lenses.payouts(spark, sf)
    span = lambda c: html('<span class="numberSet1_number">', F.col(c).cast("string"), "</span>")
    pay = F.format_number(F.floor("payout"), 0)
    good = html(
        "<td>", span("r1"), span("r2"), span("r3"), "</td><td><span>¥", pay, "</span></td><td>",
        F.coalesce(F.col("popularity").cast("string"), F.lit("")), "</td>",
    )
    cell = F.when(F.col("valid"), good).otherwise("<td>不成立</td><td><span>特払い</span></td><td></td>")
    days = p.groupBy("day").agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("venue") * 100 + F.col("race_no")).alias("k"), cell.alias("v")))).alias("cells"),
        F.array_sort(F.collect_set("venue")).alias("venues"),
    )
    names = F.array(*[F.lit(v) for v in tk.VENUES])
    head = lambda v: html(
        '<th colspan="3" class="is-thColor6"><div class="table1_area"><p class="table1_areaName"><img src="x.png" alt="', F.get(names, v.cast("int") - 1),
        '"></p><p class="table1_areaType ', F.when(v % 3 == 0, "is-G1b").otherwise("is-ippan"), '"></p><p class="table1_areaTime"></p></div></th>',
    )
    row = lambda i: html(
        "<tr><th>", i.cast("string"), "R</th>",
        F.array_join(F.transform("venues", lambda v: F.coalesce(F.try_element_at("cells", v * 100 + i), F.lit("<td></td><td></td><td></td>"))), ""),
        "</tr>",
    )
    return days.select(
        F.concat(F.lit("pay"), ymd(F.col("day"))).alias("page_id"),
        html(
            '<table class="is-strited1 is-wAuto"><thead><tr><th>R</th>', F.array_join(F.transform("venues", head), ""), "</tr></thead><tbody>",
            F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), row), ""), "</tbody></table>",
        ).alias("html"),
    )


YMD = f"strftime(date '{FIRST_DAY}' + cast(day as int), '%Y%m%d')"
PAD = "lpad(cast({} as varchar), 2, '0')".format


@query(
    "timeline_rows",
    f"""{lens('payouts')}, g as (select day, venue, min(race_id) as first, cast(sum(r1) as bigint) as s from payouts group by 1, 2),
t as (select {YMD} as ymd, venue, s, unnest(range(1, 13)) as i from g where first % 7 <> 0),
x as (select *, cast(9 + i as varchar) || ':' || {PAD('(s + i) % 60')} as deadline, ymd || {PAD('venue')} || {PAD('i')} as race_id from t)
select race_id, cast(venue as varchar) as jcd, cast(i as varchar) as rno, '第' || cast(s as varchar) || '回カップ' as title, deadline,
 ymd || ' ' || lpad(deadline, 5, '0') as deadline_at,
 cast(row_number() over (partition by ymd order by lpad(deadline, 5, '0'), race_id) as bigint) as seq from x""",
)
def timeline_rows(spark, sf):
    """Deadlines of all days at once."""
    out = racing.extract_timeline(deadline_pages(spark, sf))
    at = F.date_format("deadline_dt", "yyyyMMdd HH:mm").alias("deadline_at")
    return out.select("race_id", "jcd", "rno", "title", "deadline", at, F.col("seq").cast("long").alias("seq"))


@query(
    "payout_rows",
    f"""{lens('payouts')} select {YMD} as ymd, cast(venue as bigint) as code, cast(race_no as bigint) as race_no,
 {YMD} || {PAD('venue')} || {PAD('race_no')} as race_id, case when venue % 3 = 0 then 'G1' else '一般' end as grade, valid,
 case when valid then cast(r1 as bigint) end as place1, case when valid then cast(r2 as bigint) end as place2,
 case when valid then cast(r3 as bigint) end as place3, case when valid then cast(floor(payout) as bigint) end as payout,
 case when valid then cast(popularity as bigint) end as popularity from payouts""",
)
def payout_rows(spark, sf):
    """Results and payouts of all races from the pages of their days."""
    out, _ = racing.extract_payouts(payout_pages(spark, sf))
    numbers = {"code": "code", "R": "race_no", "1着": "place1", "2着": "place2", "3着": "place3", "払戻金": "payout", "人気": "popularity"}
    return out.select(
        F.col("日付").alias("ymd"), "race_id", F.col("グレード").alias("grade"), F.col("is_valid_result_row").alias("valid"),
        *[F.col(f"`{c}`").cast("long").alias(name) for c, name in numbers.items()],
    )


@query(
    "payout_rejects",
    f"""{lens('payouts')}, bad as (select {YMD} as ymd, race_no from payouts where not valid)
select ymd, cast(race_no as bigint) as race_no, '1着' as col, '不成立' as value from bad union all
select ymd, cast(race_no as bigint), '払戻金', '特払い' from bad""",
)
def payout_rejects(spark, sf):
    """Cells with text that is no number."""
    _, bad = racing.extract_payouts(payout_pages(spark, sf))
    return bad.select(F.col("日付").alias("ymd"), F.col("R").cast("long").alias("race_no"), F.col("column").alias("col"), "value")


def race_key(race: Column) -> Column:
    return F.lpad(race.cast("string"), 12, "0")


def per_race(order: str, part: str) -> Column:
    """The parts of a race in a row; a race has six lanes at most."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, part))), lambda x: x[part]), "")


def card_pages(spark, sf) -> DataFrame:
    """One race card per race: a body of four rows per lane with one or two runs of the meeting."""
    part, who = F.col("part"), F.col("player_id")
    wide = F.translate((who % 6 + 1).cast("string"), "123456", "１２３４５６")
    runs = [  # race, entry, start, place
        (F.lit(True), part % 6 + 1, html(".1", (part % 10).cast("string")), wide),
        (part % 3 != 0, who % 5 + 1, html(".0", (who % 10).cast("string")), (part % 6 + 1).cast("string")),
    ]
    blank = F.lit("<td></td>")
    tops = [F.when(ok, html('<td class="is-boatColor', e.cast("string"), '">1R</td>')).otherwise(blank) for ok, e, _, _ in runs]
    rest = [[F.when(ok, html("<td>", x.cast("string"), "</td>")).otherwise(blank) for ok, *x3 in runs for x in [x3[i]]] for i in range(3)]
    tall = '<td rowspan="4"></td>'
    body = html(
        "<tbody><tr>", tall, tall, '<td rowspan="4">', F.lpad((who % 10000).cast("string"), 4, "0"), " / A1 山田 太郎</td>", tall * 6, *tops, "</tr>",
        *[x for row in rest for x in ("<tr>", *row, "</tr>")], "</tbody>",
    )
    cards = lenses.lanes(spark, sf).select("race_id", "lane", body.alias("body")).groupBy("race_id").agg(per_race("lane", "body").alias("bodies"))
    return cards.select(
        html("racelist", race_key(F.col("race_id"))).alias("page_id"),
        html('<table><tbody><tr><th>締切予定時刻</th><td>10:30</td></tr></tbody></table><table><thead><tr><th>枠</th></tr></thead>', F.col("bodies"), "</table>").alias("html"),
    )


@query(
    "race_cards",
    f"""{lens('lanes')}, b as (select lpad(cast(l.race_id as varchar), 12, '0') as race_id, row_number() over (partition by l.race_id order by lane) as wakuban,
  lpad(cast(player_id % 10000 as varchar), 4, '0') as player_id, part % 3 <> 0 as two, part % 10 as s1, player_id % 10 as s2,
  cast(part % 6 + 1 as int) as e1, cast(player_id % 6 + 1 as int) as r1, cast(player_id % 5 + 1 as int) as e2, cast(part % 6 + 1 as int) as r2 from lanes l),
p as (select *, {RANKING_SQL} as rk, {CONDITION_SQL} as cd, [10, 8, 6, 4, 2, 1] as sc from b)
select race_id, wakuban, player_id, e1 || case when two then cast(e2 as varchar) else '' end as entry_history,
 e1 || case when two then cast(e2 as varchar) else '' end as boat_color, r1 || case when two then cast(r2 as varchar) else '' end as rank_history,
 cast(case when two then 2 else 1 end as bigint) as race_ct_current, '0.1' || s1 || case when two then '0.0' || s2 else '' end as "ST_timing",
 {r("(0.1 + s1 / 100.0 + case when two then s2 / 100.0 else 0 end) / case when two then 2 else 1 end")} as "ST_mean_current",
 cast(sc[r1] + case when two then sc[r2] else 0 end as bigint) as score,
 {r("(sc[r1] + case when two then sc[r2] else 0 end) / case when two then 2.0 else 1.0 end")} as score_rate,
 cast(rk[(e1 - 1) * 6 + r1] + case when two then rk[(e2 - 1) * 6 + r2] else 0 end as bigint) as ranking_point_sum,
 cast(cd[(e1 - 1) * 6 + r1] + case when two then cd[(e2 - 1) * 6 + r2] else 0 end as bigint) as condition_point_sum from p""",
)
def race_cards(spark, sf):
    """One row per boat of every race's card, with the history of its meeting."""
    out = racing.extract_racelist(card_pages(spark, sf))
    sums = [F.col(f"{kind}_point_sum").cast("long").alias(f"{kind}_point_sum") for kind in ("ranking", "condition")]
    return rounded(out.select(
        "race_id", "wakuban", "player_id", "entry_history", "boat_color", "rank_history", "race_ct_current", "ST_timing", "ST_mean_current",
        F.col("score").cast("long").alias("score"), "score_rate", *sums,
    ))


TRICKS = ["逃げ", "差し", "まくり"]


def result_pages(spark, sf) -> DataFrame:
    """One result page per race: order, starts by course, refunds, winning trick."""
    lanes = lenses.lanes(spark, sf)
    text = F.col("lane").cast("string")
    order = html("<tr><td>", F.when(F.col("part") % 11 == 0, "Ｆ").otherwise(text), "</td><td>", text, "</td></tr>")
    start = html("<tr><td>", text, " .", two(F.col("part") % 100), "</td></tr>")
    course = F.struct("player_id", "lane")
    g = lanes.select("race_id", "lane", course.alias("course"), order.alias("order"), start.alias("start"), "part").groupBy("race_id").agg(
        per_race("lane", "order").alias("orders"), per_race("course", "start").alias("starts"), F.min("part").alias("least")
    )
    table = lambda *x: html("<table><tbody>", *x, "</tbody></table>")
    trick = F.get(F.array(*[F.lit(t) for t in TRICKS]), (F.col("least") % 3).cast("int"))
    return g.select(
        html("result", race_key(F.col("race_id"))).alias("page_id"),
        html(
            table("<tr><td>レース</td></tr>"), table(F.col("orders")), table(F.col("starts")),
            table("<tr><td>3連単</td><td>", F.col("least").cast("string"), "</td></tr>"), table("<tr><td></td></tr>"), table("<tr><td>", trick, "</td></tr>"),
            table("<tr><td>【進入固定】</td></tr>"),
        ).alias("html"),
    )


@query(
    "result_rows",
    f"""{lens('lanes')}, g as (select race_id, min(part) % 3 as t from lanes group by 1)
select lpad(cast(l.race_id as varchar), 12, '0') as race_id, lane as wakuban, case when part % 11 = 0 then 'Ｆ' else cast(lane as varchar) end as rank,
 row_number() over (partition by l.race_id order by player_id, lane) as entry, {r("part % 100 / 100.0")} as "ST",
 rank() over (partition by l.race_id order by part % 100) as "ST_rank", case t when 0 then '逃げ' when 1 then '差し' else 'まくり' end as winning_trick,
 '進入固定' as remarks from lanes l join g on l.race_id = g.race_id""",
)
def result_rows(spark, sf):
    """Order, course and start of every boat from the result pages of all races."""
    out = racing.result_rows(result_pages(spark, sf))
    return rounded(out.select("race_id", "wakuban", "rank", "entry", "ST", F.col("ST_rank").cast("long").alias("ST_rank"), "winning_trick", "remarks"))


@query("refund_rows", f"""{lens('lanes')} select lpad(cast(race_id as varchar), 12, '0') as race_id, ['3連単', cast(min(part) as varchar)] as cells from lanes group by race_id""")
def refund_rows(spark, sf):
    """The refund tables of all result pages."""
    return racing.refund_rows(result_pages(spark, sf)).select("race_id", "cells")
