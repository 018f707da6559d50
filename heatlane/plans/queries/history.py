"""History windows, lagged section features, ranks and splits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heatlane.operators import filters, ordered, windows
from heatlane.plans import lenses
from heatlane.plans.lenses import table
from heatlane.plans.registry import lens, query, r, rnd, rounded

FLAGS = {"finish1": "f1", "finish2": "f2", "finish3": "f3"}
HIST_COLS = [f"finish{i}_{k}_last10_entry" for i in (1, 2, 3) for k in ("cnt", "rate")]
FRAME = "over (partition by user_id, event_type order by ts, event_id rows between 10 preceding and 1 preceding)"

_rates = ",\n  ".join(
    f"count(case when started then f{i} end) {FRAME} as finish{i}_cnt_last10_entry,\n  "
    + r(f"sum(case when started then f{i} end) {FRAME} / cast(nullif(count(case when started then f{i} end) {FRAME}, 0) as double)")
    + f" as finish{i}_rate_last10_entry"
    for i in (1, 2, 3)
)
HISTORY_SQL = f"{lens('seq')} select event_id, user_id, event_type,\n  {_rates} from seq"


def _history(spark, sf, **kw):
    out = windows.history_rates(
        lenses.seq(spark, sf), "user_id", "event_type", ["ts", "event_id"], "started", FLAGS,
        suffix="_entry", **kw,
    )
    return rounded(out.select("event_id", "user_id", "event_type", *HIST_COLS))


@query("history_rates", HISTORY_SQL)
def history_rates(spark, sf):
    return _history(spark, sf)


@query("history_rates_hot", HISTORY_SQL)
def history_rates_hot(spark, sf):
    """The same numbers through the hot-key path, with a low limit."""
    return _history(spark, sf, split_rows=(16, 400))


@query(
    "history_mean_std",
    f"""{lens('seq')} select event_id, user_id, event_type,
  {r(f"avg(case when started then value end) {FRAME}")} as st_mean_last10_entry,
  {r(f"stddev_samp(case when started then value end) {FRAME}", 6)} as st_std_last10_entry from seq""",
)
def history_mean_std(spark, sf):
    out = windows.history_rates(
        lenses.seq(spark, sf), "user_id", "event_type", ["ts", "event_id"], "started", {}, "value",
        suffix="_entry",
    )
    return out.select(
        "event_id", "user_id", "event_type",
        rnd("st_mean_last10_entry").alias("st_mean_last10_entry"),
        rnd("st_std_last10_entry", 6).alias("st_std_last10_entry"),
    )


TARGET_FRAME = "over (partition by user_id order by ts, event_id rows between 5 preceding and 1 preceding)"


@query(
    "history_with_targets",
    f"""{lens('seq')}, h as (
  select event_id, user_id, ts, f1, started and event_type <> 'signup' as started, event_type = 'signup' as is_target from seq)
select event_id, is_target,
  count(case when started then f1 end) {TARGET_FRAME} as finish1_cnt_last5,
  {r(f"sum(case when started then f1 end) {TARGET_FRAME} / cast(nullif(count(case when started then f1 end) {TARGET_FRAME}, 0) as double)")} as finish1_rate_last5
from h""",
)
def history_with_targets(spark, sf):
    """Rows that are not in the history get features and never count."""
    every = lenses.seq(spark, sf).withColumn("axis", F.lit("all"))
    known = every.where(F.col("event_type") != "signup")
    both = windows.append_targets(known, every, ["event_id"], "started")
    out = windows.history_rates(both, "user_id", "axis", ["ts", "event_id"], "started", {"finish1": "f1"}, n=5)
    return rounded(out.select("event_id", "is_target", "finish1_cnt_last5", "finish1_rate_last5"))


def _prev_sql() -> str:
    def w(k):
        return f"over (partition by user_id order by day rows between {k} preceding and 1 preceding)"

    one = "over (partition by user_id order by day)"
    parts = []
    for c in ("race_ct", "best", "score"):
        parts.append(f"lag({c}, 1) {one} as prev1_{c}")
    for k in (3, 5):
        parts.append(
            f"{r(f'case when count(race_ct) {w(k)} = {k} then sum(race_ct) {w(k)} end')} as prev{k}_sum_race_ct"
        )
        for c in ("best", "score"):
            mean = f"case when count({c}) {w(k)} = {k} then sum({c}) {w(k)} / cast({k} as double) end"
            parts.append(f"{r(mean, 6)} as prev{k}_mean_{c}")
            parts.append(f"{r(f'lag({c}, 1) {one} - {mean}', 6)} as delta_1_{k}_{c}")
    return f"{lens('months')} select user_id, day, {', '.join(parts)} from months"


@query("prev_n_features", _prev_sql())
def prev_n_features(spark, sf):
    out = windows.prev_features(lenses.months(spark, sf), "user_id", ["day"], ["best", "score"], ["race_ct"])
    out = out.drop("race_ct", "best", "score")
    keep = ("user_id", "day", "prev1_race_ct", "prev1_best", "prev1_score")
    return out.select(*keep, *[rnd(c, 6 if "_sum_" not in c else 8).alias(c) for c in out.columns if c not in keep])


RANK_SQL = "case when {c} is not null then cast(rank() over (partition by race_id order by {c} asc nulls last) as bigint) end"


@query(
    "rank_in_group",
    f"""{lens('boats')}, t as (select race_id, lane, case when part % 7 <> 0 then time_tenji end as x from boats)
select race_id, lane, {RANK_SQL.format(c='x')} as x_rank from t""",
)
def rank_in_group(spark, sf):
    b = lenses.boats(spark, sf).withColumn("x", F.when(F.col("part") % 7 != 0, F.col("time_tenji")))
    return windows.rank_in_group(b, "race_id", "x", "x_rank").select("race_id", "lane", "x_rank")


@query(
    "rank_nulls_last",
    f"""{lens('boats')}, t as (select race_id, lane, case when part % 7 <> 0 then time_tenji end as x from boats)
select race_id, lane, cast(rank() over (partition by race_id order by x asc nulls last) as bigint) as x_rank from t""",
)
def rank_nulls_last(spark, sf):
    b = lenses.boats(spark, sf).withColumn("x", F.when(F.col("part") % 7 != 0, F.col("time_tenji")))
    return windows.rank_in_group(b, "race_id", "x", "x_rank", nulls="last").select("race_id", "lane", "x_rank")


@query(
    "topk_flags",
    f"""{lens('boats')}, t as (select race_id, lane, case when part % 7 <> 0 then time_tenji end as x from boats),
k as (select race_id, lane, {RANK_SQL.format(c='x')} as x_rank from t)
select race_id, lane, cast(coalesce(x_rank <= 1, false) as int) as tenji_top1,
  cast(coalesce(x_rank <= 2, false) as int) as tenji_top2 from k""",
)
def topk_flags(spark, sf):
    b = lenses.boats(spark, sf).withColumn("x", F.when(F.col("part") % 7 != 0, F.col("time_tenji")))
    out = windows.top_flags(windows.rank_in_group(b, "race_id", "x", "k"), "k", prefix="tenji_top")
    return out.select("race_id", "lane", "tenji_top1", "tenji_top2")


@query(
    "top_two_lanes",
    f"""{lens('boats')}, k as (select race_id, lane, price,
  row_number() over (partition by race_id order by price desc, lane) as rn from boats)
select race_id, lane, price from k where rn <= 2""",
)
def top_two_lanes(spark, sf):
    out = windows.top_in_group(lenses.boats(spark, sf), "race_id", [F.col("price").desc(), F.col("lane")], 2)
    return out.select("race_id", "lane", "price")


@query(
    "column_limit",
    f"""{lens('boats')}, k as (select race_id, lane, price, status,
  row_number() over (partition by race_id order by price desc, lane) as rn from boats)
select race_id, lane, price from k where rn <= case status when 'F' then 1 when 'O' then 3 else 2 end""",
)
def column_limit(spark, sf):
    limit = F.when(F.col("status") == "F", 1).when(F.col("status") == "O", 3).otherwise(2)
    b = lenses.boats(spark, sf)
    out = windows.top_in_group(b, "race_id", [F.col("price").desc(), F.col("lane")], limit)
    return out.select("race_id", "lane", "price")


@query(
    "top_rows",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 10""",
)
def top_rows(spark, sf):
    li = lenses.table(spark, sf, "lineitem")
    out = windows.top_rows(li, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey"], 10)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    "keep_first_last",
    """with f as (select *, row_number() over (partition by user_id, event_type order by ts, event_id) a,
  row_number() over (partition by user_id, event_type order by ts desc, event_id desc) z from events)
select x.user_id, x.event_type, x.event_id as first_id, x.value as first_value, y.event_id as last_id, y.value as last_value
from f x join f y on x.user_id = y.user_id and x.event_type = y.event_type where x.a = 1 and y.z = 1""",
)
def keep_first_last(spark, sf):
    e = lenses.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    first = windows.keep_first(e, keys, order).select(*keys, F.col("event_id").alias("first_id"), F.col("value").alias("first_value"))
    last = windows.keep_last(e, keys, order).select(*keys, F.col("event_id").alias("last_id"), F.col("value").alias("last_value"))
    return first.join(last, keys)


@query(
    "timeline_seq",
    """select event_id, row_number() over (order by ts, event_id) as seq from events""",
)
def timeline_seq(spark, sf):
    e = lenses.table(spark, sf, "events").select("event_id", "ts")
    return windows.sequence_by(e, ["ts", "event_id"]).select("event_id", "seq")


@query(
    "timeline_seq_hot",
    """select event_id, row_number() over (order by ts, event_id) as seq from events""",
)
def timeline_seq_hot(spark, sf):
    """The distributed numbering, forced with a low limit."""
    e = lenses.table(spark, sf, "events").select("event_id", "ts")
    return windows.sequence_by(e, ["ts", "event_id"], split_rows=500).select("event_id", "seq")


DUE_SQL = """with j as (select event_id, user_id, event_type, ts - interval 5 minute as run_at,
  row_number() over (partition by user_id, event_type order by ts, event_id) as rn
  from events where ts - interval 5 minute >= timestamp '2024-01-10 00:00:00')
select event_id, user_id, event_type, run_at from j where rn = 1"""


@query("due_jobs", DUE_SQL)
def due_jobs(spark, sf):
    e = lenses.table(spark, sf, "events")
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    out = filters.due_jobs(e.withColumnRenamed("ts", "deadline_dt"), now, 5, keys=["user_id", "event_type"])
    return out.select("event_id", "user_id", "event_type", F.col("run_at").cast("timestamp_ntz").alias("run_at"))


SPLIT_SQL = f"""{lens('boats')}, f as (select race_id, min(date) as d from boats group by 1),
p as (select race_id, row_number() over (order by d, race_id) as pos, count(*) over () as n from f)
select b.race_id, lane, case when pos <= floor(n * cast(0.8 as double)) then 'train' else 'valid' end as part
from boats b join p on b.race_id = p.race_id"""


@query("time_split", SPLIT_SQL)
def time_split(spark, sf):
    b = lenses.boats(spark, sf).drop("part")
    return windows.split_by_first_seen(b, "race_id", ["date"]).select("race_id", "lane", "part")


@query(
    "gate_order",
    f"""{lens('boats')}, c as (select race_id, lane as gate,
  row_number() over (partition by race_id order by price desc, lane) as course from boats)
select race_id, row_number() over (partition by race_id order by gate) as wakuban, course as entry_tenji from c""",
)
def gate_order(spark, sf):
    """Gate seen at each course, turned into the course of each gate."""
    course = F.row_number().over(Window.partitionBy("race_id").orderBy(F.col("price").desc(), "lane"))
    b = lenses.boats(spark, sf).select("race_id", F.col("lane").alias("gate"), course.cast("long").alias("course"))
    out = windows.gate_to_course(b, "race_id", "gate", "course")
    return out.select("race_id", F.col("wakuban").cast("long").alias("wakuban"), "entry_tenji")


@query(
    "ordered_rows",
    f"""{lens('boats')} select race_id, lane, date from boats order by date, race_id, lane""",
)
def ordered_rows(spark, sf):
    return windows.ordered_rows(lenses.boats(spark, sf).select("race_id", "lane", "date"), "date", "race_id", "lane")


@query(
    "running_median_one_key",
    f"""select l_orderkey, l_linenumber, l_partkey, price, {r("quantile_cont(price, 0.5) over w", 6)} as median_before
from (select l_orderkey, l_linenumber, l_partkey, min(l_extendedprice) as price from lineitem group by all)
window w as (order by l_orderkey, l_linenumber, l_partkey rows between unbounded preceding and 1 preceding)""",
)
def running_median_one_key(spark, sf):
    """The exact running median of a whole table as one key."""
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    items = table(spark, sf, "lineitem").groupBy(*ids).agg(F.min("l_extendedprice").alias("price")).withColumn("all", F.lit(1))
    out = ordered.median_before(items, ["all"], ids, "price", "median_before", (1000, 20000))
    return rounded(out.drop("all"), 6)
