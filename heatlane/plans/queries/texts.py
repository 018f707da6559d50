"""Parsers and key cleaning on cells made from the base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatlane.functions import points, scoring
from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.operators.joins import pairs_within_group
from heatlane.plans import lenses
from heatlane.plans.lenses import table
from heatlane.plans.registry import CONDITION_SQL, RANKING_SQL, lens, query, r, rnd, rounded


@query(
    "parse_rank",
    f"""{lens('boats', 'ranks')} select race_id, lane, rank_code,
 case when rank_class = 'finish' then cast(rank_code as double) end as rank_num, rank_class,
 rank_class in ('finish', 'dsq', 'dnf', 'fs', 'ls') as is_start, rank_class = 'finish' as is_finish from ranks""",
)
def parse_rank(spark, sf):
    b = lenses.boats(spark, sf).select("race_id", "lane", tk.parse_rank(F.col("rank_raw")).alias("p"))
    return b.select("race_id", "lane", "p.*")


@query(
    "is_started",
    f"""{lens('boats')}, t as (select race_id, lane, translate(trim(rank_raw), '０１２３４５６７８９ＦＬ．－', '0123456789FL.-') as t from boats)
select race_id, lane, t not in ('', '-', '—', 'ー', '―') and not starts_with(t, '欠') as started from t""",
)
def is_started(spark, sf):
    return lenses.boats(spark, sf).select("race_id", "lane", tk.is_started(F.col("rank_raw")).alias("started"))


ST_SQL = """case l_partkey % 12 when 0 then 'F.' || d when 1 then '0.' || d when 2 then '.' || d when 3 then d
 when 4 then 'L.' || d when 5 then '3F.' || d when 6 then '4  L' when 7 then 'L' when 8 then '-' when 9 then 'Ｆ.' || d
 when 10 then translate('0.' || d, '0123456789', '０１２３４５６７８９') else ' 0.' || d || ' ' end"""


def st_cells(spark, sf):
    li = table(spark, sf, "lineitem")
    d = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    k = F.col("l_partkey") % 12
    cell = (
        F.when(k == 0, F.concat(F.lit("F."), d)).when(k == 1, F.concat(F.lit("0."), d))
        .when(k == 2, F.concat(F.lit("."), d)).when(k == 3, d).when(k == 4, F.concat(F.lit("L."), d))
        .when(k == 5, F.concat(F.lit("3F."), d)).when(k == 6, F.lit("4  L")).when(k == 7, F.lit("L"))
        .when(k == 8, F.lit("-")).when(k == 9, F.concat(F.lit("Ｆ."), d))
        .when(k == 10, F.translate(F.concat(F.lit("0."), d), tx.DIGITS, tx.WIDE_DIGITS))
        .otherwise(F.concat(F.lit(" 0."), d, F.lit(" ")))
    )
    return li.select("l_orderkey", "l_linenumber", "l_partkey", cell.alias("st"))


@query(
    "parse_start_time",
    f"""with t as (select l_orderkey, l_linenumber, l_partkey, lpad(cast(cast(l_quantity as int) as varchar), 2, '0') as d from lineitem),
c as (select *, {ST_SQL} as st, cast(d as double) / 100 as x from t)
select l_orderkey, l_linenumber, l_partkey, st,
 case when l_partkey % 12 in (0, 5, 9) then -x when l_partkey % 12 in (6, 7, 8) then null else x end as st_base,
 case when l_partkey % 12 in (0, 5, 9) then -x when l_partkey % 12 = 6 then cast(0.45 as double)
   when l_partkey % 12 in (7, 8) then null else x end as st_exhibition from c""",
)
def parse_start_time(spark, sf):
    return st_cells(spark, sf).select(
        "*", tk.start_time(F.col("st")).alias("st_base"), tk.start_time(F.col("st"), "exhibition").alias("st_exhibition")
    )


@query(
    "clean_codes",
    """select l_orderkey, l_linenumber, l_partkey, lpad(cast(l_suppkey % 24 + 1 as varchar), 2, '0') as code,
 lpad(cast(l_partkey as varchar), 6, '0') as motor_id,
 '20240928_' || lpad(cast(l_linenumber as varchar), 2, '0') as section_id,
 cast(202504000000 as varchar) as race_id, cast(l_quantity as bigint) as whole, l_extendedprice as amount,
 cast(l_extendedprice as bigint) as fare from lineitem""",
)
def clean_codes(spark, sf):
    li = table(spark, sf, "lineitem")
    fare = F.concat(F.lit("¥"), F.format_number(F.floor(F.rint("l_extendedprice")), 0), F.lit("円"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        tx.venue_code(F.concat(F.lit(" "), (F.col("l_suppkey") % 24 + 1).cast("string"), F.lit(".0"))).alias("code"),
        tx.motor_key(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("motor_id"),
        tx.section_key(F.concat(F.lit("20240928-"), F.col("l_linenumber").cast("string"))).alias("section_id"),
        tx.race_key(F.concat(F.lit(" 2.0"), F.lit("2504E+11"))).alias("race_id"),
        tx.to_whole(F.col("l_quantity").cast("string")).alias("whole"),
        tx.to_number(F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"), F.lit(" "))).alias("amount"),
        tx.payout_amount(fare).alias("fare"),
    )


@query(
    "season_section",
    """with t as (select o_orderkey, cast(o_orderdate as date) as d, o_custkey % 24 + 1 as code from orders),
s as (select *, d - cast(o_orderkey % 6 as int) as s0, d - cast(o_orderkey % 6 as int) + 5 as s1 from t)
select o_orderkey, strftime(d, '%Y%m%d') || lpad(cast(code as varchar), 2, '0') || '07' as race_id,
 case when o_orderkey % 10 = 9 then strftime(d, '%Y%m%d') else strftime(s0, '%Y%m%d') end
   || '_' || lpad(cast(code as varchar), 2, '0') as section_id,
 case when month(d) between 3 and 5 then 'spring' when month(d) between 6 and 8 then 'summer'
   when month(d) between 9 and 11 then 'autumn' else 'winter' end as season_q,
 cast(case when o_orderkey % 10 = 9 then null else 6 end as bigint) as section, d as date, d as date_iso from s""",
)
def season_section(spark, sf):
    o = table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    back = (F.col("o_orderkey") % 6).cast("int")
    start, end = F.date_sub(d, back), F.date_add(F.date_sub(d, back), 5)
    t = o.select(
        "o_orderkey",
        F.date_format(d, "yyyyMMdd").alias("day"),
        (F.col("o_custkey") % 24 + 1).cast("string").alias("code"),
        F.when(F.col("o_orderkey") % 10 == 9, "?")
        .otherwise(F.concat(F.date_format(start, "M/d"), F.lit("-"), F.date_format(end, "M/d")))
        .alias("schedule"),
    )
    parsed = tx.parse_day(F.concat(F.col("day"), F.lit(".0")))
    return t.select(
        "o_orderkey",
        tk.race_id(parsed, F.col("code"), F.lit(7)).alias("race_id"),
        tk.section_id(F.col("day"), F.col("code"), F.col("schedule")).alias("section_id"),
        tk.season(parsed).alias("season_q"),
        tk.meeting_days(F.year(parsed), F.col("schedule")).alias("section"),
        parsed.alias("date"),
        tx.parse_day(tx.iso_day(parsed)).alias("date_iso"),
    )


@query(
    "text_numbers",
    """select p_partkey, p_size as first_int, p_retailprice as first_decimal, cast(p_size as double) as pct,
 case when p_size between 1 and 6 then cast(p_size as bigint) end as lane, cast(p_size as bigint) as race_no,
 p_size % 2 = 0 as flag, cast(p_size as double) as weight from part""",
)
def text_numbers(spark, sf):
    size, price = F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.first_int(F.concat(F.lit("No."), size, F.lit("号"))).cast("int").alias("first_int"),
        tx.first_decimal(F.concat(F.lit("約"), price, F.lit("秒"))).alias("first_decimal"),
        tx.percent(F.concat(size, F.lit("%"))).alias("pct"),
        tx.parse_lane(F.concat(size, F.lit(".0"))).alias("lane"),
        tx.race_number(F.concat(size, F.lit("R"))).alias("race_no"),
        tx.to_flag(F.when(F.col("p_size") % 2 == 0, " True").otherwise("no")).alias("flag"),
        tx.strip_unit(F.concat(size, F.lit("kg")), "kg").alias("weight"),
    )


@query(
    "half_width_names",
    """select c_custkey, 'Customer#' || lpad(cast(c_custkey as varchar), 9, '0') as wide, c_name || ' x' as person from customer""",
)
def half_width_names(spark, sf):
    c = table(spark, sf, "customer")
    wide = F.translate(F.col("c_name"), tx.ALL_NARROW, tx.ALL_WIDE)
    person = F.concat(F.lit("　"), F.col("c_name"), F.lit("　　x　"))
    return c.select("c_custkey", tx.half_width_all(wide).alias("wide"), tx.person_name(person).alias("person"))


@query(
    "venue_grade",
    """select c_custkey, c_nationkey, case when c_nationkey = 0 then null else c_nationkey end as code,
 case c_nationkey % 4 when 0 then 'SG' when 1 then 'G1' when 2 then 'G3' else '一般' end as grade,
 case c_nationkey % 3 when 0 then 'ナイター' when 1 then 'モーニング' else '通常' end as part,
 case when c_nationkey % 4 = 3 then '一般' else case c_nationkey % 4 when 0 then 'SG' when 1 then 'G1' else 'G3' end end as series,
 cast(case when c_nationkey % 5 between 1 and 4 then 5 - c_nationkey % 5 else 0 end as bigint) as mark from customer""",
)
def venue_grade(spark, sf):
    n = table(spark, sf, "customer")
    k = F.col("c_nationkey")
    venue = F.when(k > 0, F.element_at(F.array(*[F.lit(v) for v in tk.VENUES]), F.greatest(k, F.lit(1))))
    css = F.array(
        F.lit("table1_areaType"),
        F.when(k % 4 == 0, "is-SG").when(k % 4 == 1, "is-G1b").when(k % 4 == 2, "is-G3a").otherwise("is-ippan"),
        F.when(k % 3 == 0, "is-nighter").when(k % 3 == 1, "is-morning").otherwise("none"),
    )
    g = tk.grade(css)
    return n.select(
        "c_custkey", "c_nationkey", tk.venue_number(venue).alias("code"), g.alias("grade"), tk.day_part(css).alias("part"),
        tk.series(css, F.array_contains(css, "is-ippan"), g).alias("series"),
        tk.prediction_mark((k % 5).cast("string")).alias("mark"),
    )


TITLES = """case p_partkey % 5 when 0 then '予選　1800m' when 1 then '優勝戦 特別 進入固定' when 2 then '一般 大会 安定板使用'
 when 3 then '準優勝戦 大会 進入固定 安定板使用' else '予選' end"""


@query(
    "race_titles",
    f"""select p_partkey, case p_partkey % 5 when 0 then '予選' when 1 then '優勝戦' when 2 then '一般' when 3 then '準優勝戦' else '' end as race_name,
 case when p_partkey % 5 in (1, 3) then '進入固定' else '' end as precondition_1,
 case when p_partkey % 5 in (2, 3) then '安定板使用' else '' end as precondition_2 from (select p_partkey, {TITLES} as t from part)""",
)
def race_titles(spark, sf):
    k = F.col("p_partkey") % 5
    title = (
        F.when(k == 0, "予選　1800m").when(k == 1, "優勝戦 特別 進入固定").when(k == 2, "一般 大会 安定板使用")
        .when(k == 3, "準優勝戦 大会 進入固定 安定板使用").otherwise("予選")
    )
    return table(spark, sf, "part").select("p_partkey", tk.race_title(title).alias("t")).select("p_partkey", "t.*")


def meeting():
    return F.floor(F.col("event_id") / 14).cast("long").alias("meeting")


def history_strings_of(spark, sf):
    """Entry and rank strings per meeting of fourteen runs, in order."""
    e = table(spark, sf, "events")
    v = F.floor("value").cast("long")
    entry = F.when(v % 9 == 8, "-").otherwise((v % 6 + 1).cast("string"))
    rank = F.when(v % 7 == 6, "F").otherwise((F.floor(v / 6) % 6 + 1).cast("string"))
    cell = F.struct("event_id", entry.alias("e"), rank.alias("r"))
    # ids are unique, so a meeting holds at most fourteen cells
    return e.groupBy(meeting()).agg(F.sort_array(F.collect_list(cell)).alias("cells")).select(
        "meeting",
        F.array_join(F.col("cells.e"), "").alias("entry_history"),
        F.array_join(F.col("cells.r"), "").alias("rank_history"),
        F.size("cells").cast("long").alias("race_ct_current"),
    )


RP = RANKING_SQL
CP = CONDITION_SQL
STRINGS = """cells as (select cast(floor(event_id / 14) as bigint) as meeting, event_id, cast(floor(value) as bigint) as v from events),
parts as (select *, case when v % 9 = 8 then '-' else cast(v % 6 + 1 as varchar) end as e,
  case when v % 7 = 6 then 'F' else cast(cast(floor(v / 6) as bigint) % 6 + 1 as varchar) end as r from cells)"""


@query(
    "history_strings",
    f"""with {STRINGS} select meeting, string_agg(e, '' order by event_id) as entry_history,
 string_agg(r, '' order by event_id) as rank_history, count(*) as race_ct_current from parts group by 1""",
)
def history_strings(spark, sf):
    return history_strings_of(spark, sf)


def _points_sql(kind, table_sql):
    p = f"case when r = 'F' then 0 else {table_sql}[(cast(e as int) - 1) * 6 + cast(r as int)] end"
    s = f"coalesce(sum({p}) filter (where e <> '-'), 0)"
    return f"""coalesce(string_agg(cast({p} as varchar), ' ' order by event_id) filter (where e <> '-'), '') as {kind}_point,
 cast({s} as bigint) as {kind}_point_sum, {r(f'{s} / cast(count(*) as double)')} as {kind}_point_rate"""


@query(
    "zip_points",
    f"""with {STRINGS} select meeting, {_points_sql('ranking', RP).replace("cast(e as int)", "try_cast(e as int)").replace("cast(r as int)", "try_cast(r as int)")},
 {_points_sql('condition', CP).replace("cast(e as int)", "try_cast(e as int)").replace("cast(r as int)", "try_cast(r as int)")}
from parts group by 1""",
)
def zip_points(spark, sf):
    out = points.add_history_points(history_strings_of(spark, sf))
    return rounded(out.drop("entry_history", "rank_history", "race_ct_current"))


@query(
    "start_lists",
    f"""with c as (select cast(floor(event_id / 14) as bigint) as meeting, event_id,
  case when cast(floor(value) as bigint) % 11 = 0 then 'L' else '.' || lpad(cast(cast(floor(value) as bigint) % 100 as varchar), 2, '0') end as x,
  case when cast(floor(value) as bigint) % 11 = 0 then cast(0 as double) else (cast(floor(value) as bigint) % 100) / cast(100 as double) end as n from events)
select meeting, string_agg('0' || x, '' order by event_id) as "ST_timing",
 {r('cast(sum(cast(n as decimal(18,2))) as double) / cast(count(*) as double)', 6)} as "ST_mean_current",
 right(string_agg('0' || x, '' order by event_id), 4) as "ST_previous_time",
 try_cast('0.' || right(right(string_agg('0' || x, '' order by event_id), 4), 2) as double) as "ST_previous_time_num",
 least(count(*), 6) * cast(1.0 as double) as race_ct_clip6 from c group by 1""",
)
def start_lists(spark, sf):
    e = table(spark, sf, "events")
    v = F.floor("value").cast("long")
    cell = F.when(v % 11 == 0, "L").otherwise(F.concat(F.lit("."), F.lpad((v % 100).cast("string"), 2, "0")))
    days = e.groupBy(meeting()).agg(F.sort_array(F.collect_list(F.struct("event_id", cell.alias("x")))).alias("c"))
    days = days.select("meeting", F.col("c.x").alias("cells"), F.size("c").alias("n"))
    out = days.select(
        "meeting", points.start_texts(F.col("cells")).alias("ST_timing"),
        rnd(points.start_mean_of(F.col("cells"), F.col("n")), 6).alias("ST_mean_current"),
        points.previous_start(F.col("cells")).alias("ST_previous_time"),
        points.runs_clipped(F.col("n")).alias("race_ct_clip6"),
    )
    return out.withColumn("ST_previous_time_num", points.previous_start_number(F.col("ST_previous_time")))


@query(
    "scores_flags",
    f"""{lens('boats', 'ranks')} select race_id, lane,
 cast(case when rank_class = 'finish' then [10, 8, 6, 4, 2, 1][cast(finish as int)] else 0 end as bigint) as score,
 cast(case when rank_class = 'finish' then finish <= 2 end as int) as is_top2,
 cast(rank_class = 'finish' and finish = 1 as int) as finish1_flag_cur,
 cast(rank_class = 'finish' and finish = 2 as int) as finish2_flag_cur,
 cast(rank_class = 'finish' and finish = 3 as int) as finish3_flag_cur from ranks""",
)
def scores_flags(spark, sf):
    b = lenses.boats(spark, sf).withColumn("rank", tk.finish_place(F.col("rank_raw")))
    out = scoring.result_flags(b, "rank").select(
        "race_id", "lane", points.finish_score(F.col("rank")).alias("score"),
        scoring.top_flag(F.col("rank")).alias("is_top2"), *[f"finish{i}_flag_cur" for i in (1, 2, 3)],
    )
    return out.withColumn("score", F.coalesce("score", F.lit(0)))


@query(
    "clip_ratio",
    f"""select event_id, least(greatest(value, 5), 100) as clipped, greatest(value, 7) as floored,
 {r('ln(value + 1)')} as log1p_value, {r('ln((value + 0.5) / (20 + 0.5))')} as ratio, {r('(value - 20) / 7')} as z from events""",
)
def clip_ratio(spark, sf):
    v = F.col("value")
    return rounded(
        table(spark, sf, "events").select(
            "event_id", scoring.clip(v, 5, 100).alias("clipped"), scoring.at_least(v, 7).alias("floored"),
            F.log1p(v).alias("log1p_value"), scoring.log_ratio(v, F.lit(20.0), F.lit(0.5)).alias("ratio"),
            scoring.z_score(v, F.lit(20.0), F.lit(7.0)).alias("z"),
        )
    )


PAIRS = """p as (select a.race_id, a.lane as lane_i, b.lane as lane_j, a.price as price_i, b.price as price_j,
 a.discount as discount_i, b.discount as discount_j, a.finish as finish_i, b.finish as finish_j
 from boats a join boats b on a.race_id = b.race_id and a.lane < b.lane)"""


@query("pairs_within_group", f"{lens('boats')}, {PAIRS} select race_id, lane_i, lane_j, price_i, price_j from p")
def pairs(spark, sf):
    return pairs_within_group(lenses.boats(spark, sf), "race_id", "lane", ["price"])


@query(
    "pair_features",
    f"""{lens('boats')}, {PAIRS} select race_id, lane_i, lane_j, discount_i as shared_discount,
 {r('(price_i + price_j) * 0.5', 4)} as price_mean, {r('price_i - price_j', 4)} as price_diff, {r('abs(price_i - price_j)', 4)} as price_adiff,
 cast(finish_i <= 2 and finish_j <= 2 as int) as y from p""",
)
def pair_features(spark, sf):
    b = lenses.boats(spark, sf).withColumn("is_top2", (F.col("finish") <= 2).cast("int"))
    p = pairs_within_group(b, "race_id", "lane", ["price", "discount", "is_top2"])
    out = scoring.pair_features(p, ["price"], ["discount"], "is_top2")
    out = out.select("race_id", "lane_i", "lane_j", "shared_discount", "price_mean", "price_diff", "price_adiff", "y")
    return rounded(out, 4)


@query(
    "meta_features",
    f"""select event_id, {r('value / 500')} as p_base, {r("coalesce(case when user_id % 3 <> 0 then value / 600 end, 0.5)")} as p_sectional,
 {r('abs(value / 500 - 0.5)')} as m_base, {r("abs(coalesce(case when user_id % 3 <> 0 then value / 600 end, 0.5) - 0.5)")} as m_sectional,
 cast(user_id % 3 = 0 as int) as is_sectional_missing, cast(event_type = 'click' as int) as stage_click,
 cast(event_type = 'view' as int) as stage_view from events""",
)
def meta(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("stage"), (F.col("value") / 500).alias("p_base"),
        F.when(F.col("user_id") % 3 != 0, F.col("value") / 600).alias("p_sectional"),
    )
    return rounded(scoring.meta_features(e, contexts={"stage": ["click", "view"]}).drop("stage"))


@query(
    "ability_scale",
    f"""{lens('boats')}, m as (select race_id, lane, discount * 30 as x, max(discount * 30) over (partition by race_id) as mx from boats)
select race_id, lane, {r('case when mx <= 1.5 then x when mx = 0 then 0 else x / mx end')} as ability from m""",
)
def ability_scale(spark, sf):
    b = lenses.boats(spark, sf).withColumn("x", F.col("discount") * 30)
    return rounded(scoring.ability_scale(b, "race_id", "x", "ability").select("race_id", "lane", "ability"))
