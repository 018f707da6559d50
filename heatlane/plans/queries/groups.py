"""Race-level filters, exclusion and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.operators import filters, quality, sets
from heatlane.plans import lenses
from heatlane.plans.lenses import table
from heatlane.plans.registry import lens, query, r, rounded
from heatlane.session import durable
from heatlane.sources import files
from heatlane.streaming.live import guard_races

BR = lens("boats", "ranks")


def ranked(spark, sf):
    b = lenses.boats(spark, sf)
    return b.withColumn("p", tk.parse_rank(F.col("rank_raw"))).select("*", "p.*").drop("p")


def rules():
    return {
        "rank_nonnumeric": F.col("rank_num").isNull(),
        "weather_missing_any": F.col("discount").isNull() | (F.col("discount") > 0.095),
        "sttenji_nonnumeric": F.col("part") % 97 == 0,
    }


FLAGGED = f"""{BR}, flagged as (select *, rank_class <> 'finish' as a, discount > 0.095 as b, part % 97 = 0 as c from ranks),
bad as (select race_id, bool_or(a) as a, bool_or(b) as b, bool_or(c) as c from flagged group by 1)"""


@query(
    "drop_bad_groups",
    f"""{FLAGGED} select f.race_id, lane, finish from ranks f join bad on f.race_id = bad.race_id
where not (bad.a or bad.b or bad.c)""",
)
def drop_bad_groups(spark, sf):
    kept, _ = filters.drop_bad_groups(ranked(spark, sf), "race_id", rules())
    return kept.select("race_id", "lane", "finish")


@query(
    "exclusion_report",
    f"""{FLAGGED}, rs as (select race_id, 'rank_nonnumeric' as reason from bad where a union all
  select race_id, 'weather_missing_any' from bad where b union all select race_id, 'sttenji_nonnumeric' from bad where c
  union all select race_id, 'rank_nonnumeric' from bad where a and b)
select race_id, string_agg(distinct reason, ' / ' order by reason) as reason from rs group by 1""",
)
def exclusion_report(spark, sf):
    """Reasons of this run merged with an older list."""
    b = ranked(spark, sf)
    new = durable(filters.group_reasons(b, "race_id", rules()).withColumnRenamed("rule_key", "reason"), "reasons")
    both = [F.bool_or(F.col("reason") == name) for name in ("rank_nonnumeric", "weather_missing_any")]
    old = new.groupBy("race_id").agg((both[0] & both[1]).alias("both")).where("both")
    return quality.exclusion_report(new, old.select("race_id", F.lit("rank_nonnumeric").alias("reason")))


@query(
    "drop_void_groups",
    f"""{BR} select race_id, lane, rank_class from ranks
where race_id not in (select race_id from ranks where rank_class = 'void')""",
)
def drop_void_groups(spark, sf):
    return filters.drop_void_groups(ranked(spark, sf), "race_id").select("race_id", "lane", "rank_class")


@query(
    "drop_void_rows",
    f"""{BR} select race_id, lane, rank_class from ranks where coalesce(nullif(rank_class, 'unknown'), '') <> 'void'
and motor_number is not null""",
)
def drop_void_rows(spark, sf):
    b = ranked(spark, sf).withColumn("c", F.nullif(F.col("rank_class"), F.lit("unknown")))
    out = filters.drop_void_rows(filters.drop_null_keys(b, ["motor_number"]), "c")
    return out.select("race_id", "lane", "rank_class")


@query(
    "void_summary",
    f"""{BR}, g as (select race_id, count(*) as n, bool_or(rank_class = 'void') as v from ranks group by 1)
select cast(sum(n) as bigint) as rows_before, count(*) as races_before,
 cast(coalesce(sum(n) filter (where v), 0) as bigint) as rows_dropped, count(*) filter (where v) as races_dropped,
 cast(coalesce(sum(n) filter (where not v), 0) as bigint) as rows_after, count(*) filter (where not v) as races_after from g""",
)
def void_summary(spark, sf):
    return quality.void_summary(ranked(spark, sf), "race_id")


@query(
    "complete_groups",
    f"""{lens('lanes')} select race_id, lane, player_id from lanes
where race_id in (select race_id from lanes group by 1 having count(lane) = 6)""",
)
def complete_groups(spark, sf):
    return filters.complete_groups(lenses.lanes(spark, sf), "race_id", "lane").select("race_id", "lane", "player_id")


@query(
    "group_all_flag",
    f"""{lens('lanes')}, t as (select race_id, lane, case when part % 31 <> 0 then time_tenji end as x from lanes)
select race_id, lane, cast(bool_and(coalesce(x >= 5, false)) over (partition by race_id) as int) as is_wakunari from t""",
)
def group_all_flag(spark, sf):
    b = lenses.lanes(spark, sf).withColumn("x", F.when(F.col("part") % 31 != 0, F.col("time_tenji")))
    return quality.group_all_flag(b, "race_id", F.col("x") >= 5, "is_wakunari").select("race_id", "lane", "is_wakunari")


@query(
    "group_checks",
    f"""{lens('lanes')}, t as (select race_id, lane, case when part % 31 <> 0 then time_tenji end as x from lanes)
select race_id, count(*) as n_rows, count(distinct lane) as n_lanes, count(*) - count(x) as null_x from t group by 1
having count(*) <> 6 or count(distinct lane) <> 6 or count(x) <> count(*)""",
)
def group_checks(spark, sf):
    b = lenses.lanes(spark, sf).withColumn("x", F.when(F.col("part") % 31 != 0, F.col("time_tenji")))
    return quality.group_checks(b, "race_id", "lane", ["x"])


@query(
    "live_guard",
    f"""{lens('lanes')}, t as (select race_id, lane, case when part % 31 <> 0 then time_tenji end as x from lanes),
g as (select race_id, bool_or(x is null) as stop from t group by 1)
select t.race_id, lane, cast(stop as int) as stopped from t join g on t.race_id = g.race_id""",
)
def live_guard(spark, sf):
    b = lenses.lanes(spark, sf).withColumn("x", F.when(F.col("part") % 31 != 0, F.col("time_tenji")))
    go, stop = guard_races(b, "race_id", "x")
    both = go.withColumn("stopped", F.lit(0)).unionByName(stop.withColumn("stopped", F.lit(1)))
    return both.select("race_id", "lane", "stopped")


@query(
    "bad_value_topn",
    f"""{BR}, c as (select 'rank' as col, rank_raw as v, rank_class <> 'finish' as bad from ranks union all
 select 'lane', cast(lane as varchar), finish > 3 from ranks union all select 'status', status, status = 'P' from ranks),
n as (select col, v, count(*) as n from c where bad group by 1, 2),
k as (select *, row_number() over (partition by col order by n desc, v) as rn from n)
select col as "column", v as bad_value, n as "count" from k where rn <= 4""",
)
def bad_value_topn(spark, sf):
    b = ranked(spark, sf)
    cells = {
        "rank": (F.col("rank_raw"), F.col("rank_class") != "finish"),
        "lane": (F.col("lane"), F.col("finish") > 3),
        "status": (F.col("status"), F.col("status") == "P"),
    }
    return quality.bad_values(b, cells, 4)


@query(
    "null_rates",
    f"""{BR}, t as (select race_id, case when part % 31 <> 0 then time_tenji end as x, nullif(rank_raw, '') as y,
 case when rank_class = 'finish' then 1 end as z from ranks), n as (select count(*) as n, count(x) as x, count(y) as y, count(z) as z from t)
select c as "column", n, n - v as n_null, {r('(n - v) / cast(n as double)')} as null_rate from (
 select 'x' as c, n, x as v from n union all select 'y', n, y from n union all select 'z', n, z from n)""",
)
def null_rates(spark, sf):
    b = ranked(spark, sf).select(
        F.when(F.col("part") % 31 != 0, F.col("time_tenji")).alias("x"),
        F.nullif(F.col("rank_raw"), F.lit("")).alias("y"),
        F.col("rank_num").alias("z"),
    )
    return rounded(quality.null_rates(b, ["x", "y", "z"]))


@query(
    "null_rates_by_group",
    f"""{BR}, t as (select nullif(status, 'P') as status, case when rank_class = 'finish' then 1 end as z from ranks)
select status, count(*) as n, count(*) - count(z) as n_null, {r('(count(*) - count(z)) / cast(count(*) as double)')} as null_rate
from t group by 1""",
)
def null_rates_by_group(spark, sf):
    b = ranked(spark, sf).withColumn("status", F.nullif(F.col("status"), F.lit("P")))
    return rounded(quality.null_rates_by(b, "status", "rank_num"))


@query(
    "worst_nulls",
    f"""{BR}, n as (select count(*) as n, count(case when part % 31 <> 0 then 1 end) as x, count(nullif(rank_raw, '')) as y,
 count(case when rank_class = 'finish' then 1 end) as z from ranks),
u as (select 'x' as c, n, x as v from n union all select 'y', n, y from n union all select 'z', n, z from n)
select c as "column", n, n - v as n_null, {r('(n - v) / cast(n as double)')} as null_rate from u
order by (n - v) / cast(n as double) desc, c limit 2""",
)
def worst_nulls(spark, sf):
    b = ranked(spark, sf).select(
        F.when(F.col("part") % 31 != 0, 1).alias("x"), F.nullif(F.col("rank_raw"), F.lit("")).alias("y"),
        F.col("rank_num").alias("z"),
    )
    return rounded(quality.worst_nulls(b, ["x", "y", "z"], 2))


@query(
    "category_counts",
    f"""{BR} select nullif(rank_class, 'unknown') as rank_class, count(*) as n from ranks group by 1""",
)
def category_counts(spark, sf):
    b = ranked(spark, sf).withColumn("rank_class", F.nullif(F.col("rank_class"), F.lit("unknown")))
    return quality.category_counts(b, "rank_class")


@query(
    "parse_stats",
    f"""{BR}, c as (select 'rank' as col, trim(rank_raw) <> '' as given, rank_class = 'finish' as parsed from ranks union all
 select 'status', status <> '', status = 'F' from ranks)
select col as "column", count(*) as n, count(*) filter (where given) as n_given,
 count(*) filter (where given and not parsed) as n_failed,
 {r("count(*) filter (where given and not parsed) / cast(nullif(count(*) filter (where given), 0) as double)")} as fail_rate
from c group by 1""",
)
def parse_stats(spark, sf):
    b = ranked(spark, sf)
    cells = {
        "rank": (F.col("rank_raw"), F.col("rank_num")),
        "status": (F.col("status"), F.when(F.col("status") == "F", 1)),
    }
    return rounded(quality.parse_stats(b, cells))


@query(
    "change_counts",
    """select o_orderstatus as file, count(*) as n,
 count(*) filter (where nullif(o_custkey % 9, 0) is distinct from nullif(o_custkey % 3, 0)) as n_changed,
 count(*) filter (where o_custkey % 9 = 0) as n_fallback from orders group by 1""",
)
def change_counts(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("file"),
        F.nullif(F.col("o_custkey") % 9, F.lit(0)).alias("old"),
        F.nullif(F.col("o_custkey") % 3, F.lit(0)).alias("new"),
        (F.col("o_custkey") % 9 == 0).alias("fallback"),
    )
    return quality.change_counts(o, "file", "old", "new", "fallback")


@query(
    "run_summary",
    f"""{lens('boats')} select min(date) as first_day, max(date) as last_day, count(*) as n_rows,
 count(distinct race_id) as n_races from boats""",
)
def run_summary(spark, sf):
    return quality.run_summary(lenses.boats(spark, sf), "date", "race_id")


@query(
    "class_counts",
    f"""{BR} select motor_number, count(*) filter (where rank_class = 'finish') as finish_count,
 count(*) filter (where rank_class = 'dns') as dns_count, count(*) filter (where rank_class = 'dsq') as dsq_count,
 count(*) filter (where rank_class = 'dnf') as dnf_count, count(*) filter (where rank_class = 'fs') as false_start_count,
 count(*) filter (where rank_class = 'ls') as late_start_count,
 count(*) filter (where rank_class = 'void') as void_race_flag_count from ranks group by 1""",
)
def class_counts(spark, sf):
    return quality.class_counts(ranked(spark, sf), ["motor_number"])


@query(
    "group_order",
    f"""{lens('boats')} select race_id, min(date) as date, min(place) as place, min(lane) as lane from boats group by 1""",
)
def group_order(spark, sf):
    return quality.group_order(lenses.boats(spark, sf), "race_id", "date", "place", "lane")


@query(
    "filter_period",
    """select o_orderkey, cast(o_orderdate as date) as date from orders
where cast(o_orderdate as date) between date '1996-02-01' and date '1997-03-15'""",
)
def filter_period(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return filters.filter_period(o, "date", "1996-02-01", "1997-03-15")


@query(
    "filter_with_warmup",
    """select o_orderkey, cast(o_orderdate as date) as date from orders
where cast(o_orderdate as date) between date '1997-01-01' - 180 and date '1997-03-15'""",
)
def filter_with_warmup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return filters.filter_with_warmup(o, "date", "1997-01-01", "1997-03-15", 180)


@query(
    "filter_places",
    f"""{BR} select race_id, lane, cast(rank_code as bigint) as finish_no from ranks where rank_class = 'finish' and lane between 1 and 6""",
)
def filter_places(spark, sf):
    b = lenses.boats(spark, sf).withColumn("finish_no", tk.finish_place(F.col("rank_raw")))
    return filters.filter_places(b, "finish_no", "lane").select("race_id", "lane", "finish_no")


STAGE_CASE = "case part % 6 when 0 then '優勝戦' when 1 then '準優勝戦' when 2 then '準優進出戦' when 3 then '予選' else '一般戦' end"


def stage_names(spark, sf):
    k = F.col("part") % 6
    name = (
        F.when(k == 0, "優勝戦").when(k == 1, "準優勝戦").when(k == 2, "準優進出戦").when(k == 3, "予選").otherwise("一般戦")
    )
    return lenses.boats(spark, sf).withColumn("race_name", name)


@query(
    "filter_stage",
    f"""{lens('boats')}, s as (select race_id, lane, {STAGE_CASE} as race_name from boats)
select * from s where regexp_matches(race_name, '(優勝戦|準優進出戦|準優進出)')""",
)
def filter_stage(spark, sf):
    return filters.filter_stage(stage_names(spark, sf), "race_name", "finals,semi-entry").select("race_id", "lane", "race_name")


@query(
    "filter_keywords",
    f"""{lens('boats')}, s as (select race_id, lane, {STAGE_CASE} as race_name from boats)
select * from s where contains(race_name, '予選') or contains(race_name, '一般')""",
)
def filter_keywords(spark, sf):
    return filters.filter_keywords(stage_names(spark, sf), "race_name", ["予選", "一般"]).select("race_id", "lane", "race_name")


@query("filter_positive", "select event_id, value from events where value > 0 and value is not null")
def filter_positive(spark, sf):
    return filters.filter_positive(table(spark, sf, "events").select("event_id", "value"), "value")


@query(
    "membership",
    """select o_orderkey, o_custkey in (select c_custkey from customer where c_acctbal < 0) as low from orders""",
)
def membership(spark, sf):
    """Set membership both ways: semi join, then anti join, then union."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    low = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    inside = filters.keep_in(o, low, "o_custkey").withColumn("low", F.lit(True))
    outside = filters.keep_not_in(o, low, "o_custkey").withColumn("low", F.lit(False))
    return sets.union_all(inside, outside).select("o_orderkey", "low")


@query(
    "subtract_ids",
    """select o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0
 union select c_custkey from customer where c_mktsegment = 'MACHINERY')""",
)
def subtract_ids(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer")
    out = sets.subtract_ids(o, "c_custkey", c.where("c_acctbal < 0"), c.where("c_mktsegment = 'MACHINERY'"))
    return out.select("o_orderkey")


@query(
    "union_conform",
    """select c_custkey as id, c_acctbal as balance, c_mktsegment as segment, cast(null as varchar) as note from customer
union all select s_suppkey, s_acctbal, null, null from supplier""",
)
def union_conform(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("extra"),
    )
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    target = T.StructType(
        [
            T.StructField("id", T.LongType()), T.StructField("balance", T.DoubleType()),
            T.StructField("segment", T.StringType()), T.StructField("note", T.StringType()),
        ]
    )
    return filters.conform(sets.union_all(c, s), target)


@query(
    "add_new_rows",
    """select o_custkey, o_orderkey from orders where o_orderstatus = 'F' union all
select o_custkey, o_orderkey from orders where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""",
)
def add_new_rows(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    old = o.where("o_orderstatus = 'F'")
    return sets.add_new_rows(old, o, ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("distinct_keys", "select distinct o_custkey, o_orderstatus from orders")
def distinct_keys(spark, sf):
    return sets.distinct_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus"])


@query(
    "first_per_place",
    """select s_nationkey, min(s_suppkey) as s_suppkey from supplier group by 1""",
)
def first_per_place(spark, sf):
    s = table(spark, sf, "supplier").select("s_nationkey", "s_suppkey")
    return sets.first_per_place(s, "s_nationkey", ["s_suppkey"])


@query(
    "distinct_counts",
    """select 'c_mktsegment' as "column", count(distinct c_mktsegment) as n_distinct from customer union all
select 'c_nationkey', count(distinct c_nationkey) from customer union all select 'c_name', count(distinct c_name) from customer""",
)
def distinct_counts(spark, sf):
    return filters.distinct_counts(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey", "c_name"])


@query(
    "select_features",
    """select c_acctbal, c_mktsegment, c_nationkey from customer""",
)
def select_features(spark, sf):
    """Numeric columns and text columns with few values, minus listed ones."""
    c = table(spark, sf, "customer")
    return c.select(*filters.select_features(c, drop=["c_custkey"]))


@query(
    "prefixed_columns",
    """select o_orderkey, o_orderdate as motor_o_orderdate, o_orderpriority as motor_o_orderpriority,
 o_orderstatus as motor_o_orderstatus from orders""",
)
def prefixed_columns(spark, sf):
    o = table(spark, sf, "orders")
    return filters.take_prefixed(o, ["o_orderkey"], ["o_orderd", "o_orderp", "o_orders"], "motor_")


@query(
    "fill_columns",
    """select event_id, coalesce(case when value >= 20 then value end, cast(user_id as double)) as entry,
 coalesce(try_cast(json_extract_string(props, '$.k') as double), cast(0.0 as double)) as k, cast(0.0 as double) as absent from events""",
)
def fill_columns(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("value") >= 20, F.col("value")).alias("entry"),
        F.col("user_id").cast("double").alias("entry_tenji"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    out = filters.fill_neutral(filters.fill_from(e, "entry", "entry_tenji"), ["k", "absent"])
    return out.select("event_id", "entry", "k", "absent")


@query("keys_and_numbers", "select s_suppkey, s_acctbal from supplier")
def keys_and_numbers(spark, sf):
    return filters.keys_and_numbers(table(spark, sf, "supplier"), ["s_suppkey"], drop=["s_nationkey"])


@query(
    "drop_leaks",
    "select o_orderpriority, o_totalprice, o_orderdate from orders",
)
def drop_leaks(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderkey": "race_id", "o_custkey": "player_id", "o_orderstatus": "rank"}
    )
    return filters.drop_columns(o, filters.ID_COLUMNS, filters.LEAK_COLUMNS)


@query(
    "required_keys",
    "select c_custkey, c_nationkey from customer",
)
def required_keys(spark, sf):
    c = filters.require_columns(table(spark, sf, "customer"), ["c_custkey", "c_nationkey"])
    return filters.select_present(filters.require_no_nulls(c, ["c_custkey"]), ["c_custkey", "c_nationkey", "c_absent"])


@query(
    "sample_rows",
    "select o_orderkey, o_custkey from orders order by md5(concat_ws('|', o_orderkey, 42)), o_orderkey limit 100",
)
def sample_rows(spark, sf):
    """Fixed-seed sample of 100 rows: the sampling operator."""
    return files.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 100, 42)


@query(
    "venue_codes",
    """select c_custkey, n_regionkey, lpad(cast(c_nationkey as varchar), 2, '0') as code
from customer join nation on c_nationkey = n_nationkey""",
)
def venue_codes(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    j = table(spark, sf, "customer").join(F.broadcast(n), "c_nationkey")  # 25 nations
    code = tx.venue_code(F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")))
    return j.select("c_custkey", "n_regionkey", code.alias("code"))
