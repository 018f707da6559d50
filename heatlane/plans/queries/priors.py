"""Priors, lookups, ranges, running signals and tickets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from heatlane.functions import points
from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.operators import joins, priors, quality, ranges, regime, tickets, windows
from heatlane.plans import lenses
from heatlane.plans.lenses import table
from heatlane.plans.queries.groups import ranked
from heatlane.plans.registry import CONDITION_SQL, RANKING_SQL, lens, query, r, rounded
from heatlane.session import durable

K6 = range(1, 7)


def _counts(cond="finish", n="n_finished"):
    return f"count(*) as {n}, " + ", ".join(f"count(*) filter (where {cond} = {k}) as c{k}" for k in K6)


FD = f"fd as (select place, lane as entry, season_q, {_counts()} from boats where lane between 1 and 6 and finish between 1 and 6 group by 1, 2, 3)"


@query("finish_distribution", f"{lens('boats')}, {FD} select * from fd")
def finish_distribution(spark, sf):
    b = lenses.boats(spark, sf).withColumnRenamed("lane", "entry")
    return priors.finish_distribution(b, ["place", "entry", "season_q"], "finish")


def _share(k, m):
    return f"(c{k} + {m} / cast(6.0 as double)) / (n_finished + cast({m} as double))"


@query(
    "smoothed_share",
    f"{lens('boats')}, {FD} select place, entry, season_q, n_finished, "
    + ", ".join(f"c{k}" for k in K6) + ", " + ", ".join(f"{r(_share(k, 6))} as p{k}" for k in K6) + " from fd",
)
def smoothed_share(spark, sf):
    b = lenses.boats(spark, sf).withColumnRenamed("lane", "entry")
    fd = priors.finish_distribution(b, ["place", "entry", "season_q"], "finish")
    return rounded(priors.smoothed_share(fd, "n_finished", [str(k) for k in K6], 6))


_rel = ", ".join(
    f"{r(f'p{k}')} as p{k}, {r(f'base_p{k}')} as base_p{k}, {r(f'p{k} - base_p{k}')} as adv_p{k}, "
    + r(f"ln((p{k} + 1.0 / (n_finished + 1.0)) / (base_p{k} + 1.0 / (n_finished + 1.0)))") + f" as lr_p{k}"
    for k in K6
)


@query(
    "relative_prior",
    f"{lens('boats')}, {FD}, s as (select *, " + ", ".join(f"c{k} / cast(n_finished as double) as p{k}" for k in K6)
    + " from fd), b as (select *, " + ", ".join(f"avg(p{k}) over (partition by season_q, entry) as base_p{k}" for k in K6)
    + f" from s) select place, entry, season_q, n_finished, {_rel} from b",
)
def relative_prior(spark, sf):
    b = lenses.boats(spark, sf).withColumnRenamed("lane", "entry")
    out = priors.course_prior(b, "place", "entry", "season_q", "finish")
    return rounded(out.drop(*[f"c{k}" for k in K6]))


TR = list(tk.TRICKS.items())
TRICK_CASE = "case player_id % 8 " + " ".join(f"when {i} then '{l}'" for i, (_, l) in enumerate(TR)) + " end"


@query(
    "trick_prior",
    f"{lens('boats')}, w as (select place, lane as entry, season_q, {TRICK_CASE} as t from boats where finish = 1), "
    "d as (select place, entry, season_q, count(*) as n_win, "
    + ", ".join(f"count(*) filter (where t = '{l}') as c_{l}" for _, l in TR)
    + " from w where t is not null group by 1, 2, 3), s as (select *, "
    + ", ".join(f"c_{l} / cast(n_win as double) as p_{l}" for _, l in TR)
    + " from d), b as (select *, " + ", ".join(f"avg(p_{l}) over (partition by season_q, entry) as base_p_{l}" for _, l in TR)
    + " from s) select place, entry, season_q, n_win, "
    + ", ".join(
        f"c_{l}, {r(f'p_{l}')} as p_{l}, {r(f'base_p_{l}')} as base_p_{l}, {r(f'p_{l} - base_p_{l}')} as adv_p_{l}, "
        + r(f"ln((p_{l} + 1.0 / (n_win + 1.0)) / (base_p_{l} + 1.0 / (n_win + 1.0)))") + f" as lr_p_{l}"
        for _, l in TR
    ) + " from b",
)
def trick_prior(spark, sf):
    pick = F.col("player_id") % 8
    name = F.lit("不明")
    for i, (trick, _) in enumerate(TR):
        name = F.when(pick == i, f" {trick}").otherwise(name)
    b = lenses.boats(spark, sf).withColumnRenamed("lane", "entry").withColumn("winning_trick", name)
    return rounded(priors.trick_prior(b, "place", "entry", "season_q", "finish", "winning_trick"))


SHRINK = """g as (select avg(time_tenji) as mu_g, stddev_pop(time_tenji) as sd_g from boats where time_tenji > 0),
c as (select place, lane, season_q, avg(time_tenji) as m, stddev_samp(time_tenji) as s, count(*) as n from boats where time_tenji > 0 group by 1, 2, 3),
pr as (select place, lane, season_q, n / (n + cast(200.0 as double)) * m + (1 - n / (n + cast(200.0 as double))) * mu_g as mu,
 greatest(n / (n + cast(200.0 as double)) * coalesce(s, sd_g) + (1 - n / (n + cast(200.0 as double))) * sd_g, 0.02) as sd, n from c, g)"""


def tenji_prior(b):
    kept = b.where(F.col("time_tenji") > 0)
    return priors.shrunk_mean_sd(kept, ["place", "lane", "season_q"], "time_tenji")


@query(
    "shrunk_mean_sd",
    f"{lens('boats')}, {SHRINK} select place, lane, season_q, {r('mu', 6)} as tenji_mu, {r('sd', 6)} as tenji_sd, n as n_tenji from pr",
)
def shrunk_mean_sd(spark, sf):
    return rounded(tenji_prior(lenses.boats(spark, sf)), 6)


@query(
    "residual_z",
    f"""{lens('boats')}, {SHRINK}, j as (select b.race_id, b.lane, time_tenji - mu as e, (time_tenji - mu) / greatest(sd, 0.02) as z
 from boats b left join pr on b.place = pr.place and b.lane = pr.lane and b.season_q = pr.season_q)
select race_id, lane, {r('e', 6)} as tenji_resid, {r('z', 6)} as tenji_z,
 case when z is not null then rank() over (partition by race_id order by round(z, 6)) end as tenji_z_rank from j""",
)
def residual_z(spark, sf):
    b = lenses.boats(spark, sf)
    prior = durable(tenji_prior(b).drop("n_tenji"), "prior")
    out = joins.lookup_join(b, prior, ["place", "lane", "season_q"])
    out = priors.residual_z(out, "time_tenji", "tenji_mu", "tenji_sd")
    out = rounded(out.select("race_id", "lane", "tenji_resid", "tenji_z"), 6)
    return windows.rank_in_group(out, "race_id", "tenji_z", "tenji_z_rank")


SECTION_POINTS = "case when rank_class = 'finish' then {}[(cast(lane as int) - 1) * 6 + cast(finish as int)] else 0 end"
RP = RANKING_SQL
CP = CONDITION_SQL
SECTION_SQL = f"""p as (select motor_number, section, date,
 case when rank_class = 'finish' then [10, 8, 6, 4, 2, 1][cast(finish as int)] else 0 end as sc,
 {SECTION_POINTS.format(RP)} as rp, {SECTION_POINTS.format(CP)} as cp
 from ranks where rank_class in ('finish', 'dsq', 'dnf', 'fs', 'ls')),
base as (select motor_number, section, count(*) as motor_race_ct, cast(sum(sc) as bigint) as motor_score_sum,
 cast(sum(rp) as bigint) as motor_ranking_point_sum, cast(sum(cp) as bigint) as motor_condition_point_sum,
 min(date) as section_start_dt, max(date) as section_end_dt from p group by 1, 2)"""


def section_points(spark, sf):
    b = ranked(spark, sf).withColumn("entry", tk.clamp_place(F.col("lane")))
    b = b.withColumn("rank_num", tk.clamp_place(F.col("rank_num")))
    b = joins.point_lookup(b, points.point_table(spark), ["entry", "rank_num"], ["ranking_point", "condition_point"])
    return b.withColumn("score", F.coalesce(points.finish_score(F.col("rank_num")), F.lit(0)))


@query(
    "point_lookup",
    f"""{lens('boats', 'ranks')} select race_id, lane, cast({SECTION_POINTS.format(RP)} as bigint) as ranking_point,
 cast({SECTION_POINTS.format(CP)} as bigint) as condition_point from ranks""",
)
def point_lookup(spark, sf):
    return section_points(spark, sf).select("race_id", "lane", "ranking_point", "condition_point")


def section_base(spark, sf):
    cols = {"score": "score", "ranking_point": "ranking_point", "condition_point": "condition_point"}
    return priors.section_totals(section_points(spark, sf), ["motor_number", "section"], "date", "is_start", cols)


@query(
    "section_totals",
    f"""{lens('boats', 'ranks')}, {SECTION_SQL} select *, {r('motor_score_sum / cast(motor_race_ct as double)')} as motor_score_rate,
 {r('motor_ranking_point_sum / cast(motor_race_ct as double)')} as motor_ranking_point_rate,
 {r('motor_condition_point_sum / cast(motor_race_ct as double)')} as motor_condition_point_rate from base""",
)
def section_totals(spark, sf):
    return rounded(section_base(spark, sf))


_w3 = "over (partition by motor_number order by section_start_dt, section_end_dt, section rows between 3 preceding and 1 preceding)"
_w1 = "over (partition by motor_number order by section_start_dt, section_end_dt, section)"


@query(
    "section_features",
    f"""{lens('boats', 'ranks')}, {SECTION_SQL}, x as (select *, motor_score_sum / cast(motor_race_ct as double) as rate from base)
select motor_number, section, lag(motor_race_ct) {_w1} as prev1_motor_race_ct,
 {r(f'case when count(motor_race_ct) {_w3} = 3 then sum(motor_race_ct) {_w3} end')} as prev3_sum_motor_race_ct,
 {r(f'lag(rate) {_w1}', 6)} as prev1_motor_score_rate,
 {r(f'case when count(rate) {_w3} = 3 then avg(rate) {_w3} end', 6)} as prev3_mean_motor_score_rate,
 {r(f'lag(rate) {_w1} - case when count(rate) {_w3} = 3 then avg(rate) {_w3} end', 6)} as delta_1_3_motor_score_rate from x""",
)
def section_features(spark, sf):
    base = durable(section_base(spark, sf), "sections")
    out = windows.prev_features(
        base, "motor_number", ["section_start_dt", "section_end_dt", "section"], ["motor_score_rate"],
        ["motor_race_ct"], ns=(3,),
    )
    return rounded(
        out.select(
            "motor_number", "section", "prev1_motor_race_ct", "prev3_sum_motor_race_ct", "prev1_motor_score_rate",
            "prev3_mean_motor_score_rate", "delta_1_3_motor_score_rate",
        ), 6,
    )


@query(
    "lookup_join",
    """select o_orderkey, o_custkey, c_nationkey, c_acctbal from orders left join customer on o_custkey = c_custkey""",
)
def lookup_join(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("o_custkey"), "c_nationkey", "c_acctbal")
    return joins.lookup_join(o, c, ["o_custkey"])


@query(
    "hit_rate",
    f"""select {r('avg(cast(c_custkey is not null as int))')} as hit_rate from orders left join
 (select * from customer where c_acctbal > 0) c on o_custkey = c_custkey""",
)
def hit_rate(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return rounded(joins.hit_rate(joins.lookup_join(o, c, ["o_custkey"]), "c_acctbal"))


@query(
    "attach_new_columns",
    """with u as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
 row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) rn from lineitem)
select o_orderkey, o_orderstatus, l_partkey, l_suppkey from orders left join u on o_orderkey = l_orderkey and rn = 1""",
)
def attach_new_columns(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("x").alias("o_orderstatus"), "l_linenumber", "l_partkey",
        "l_suppkey", "l_extendedprice",
    )
    out = joins.attach_new_columns(o, li, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("o_orderkey", "o_orderstatus", "l_partkey", "l_suppkey")


@query(
    "attach_first",
    """with u as (select o_custkey, o_orderkey, o_totalprice, row_number() over (partition by o_custkey order by o_orderkey) rn from orders)
select c_custkey, c_acctbal as balance, o_totalprice as balance_snap, o_orderkey from customer left join u on c_custkey = o_custkey and rn = 1""",
)
def attach_first(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"))
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("balance"), "o_orderkey"
    )
    return joins.attach_first(c, o, ["c_custkey"], ["o_orderkey"], "_snap")


@query(
    "anti_join_new",
    """select c_custkey, c_nationkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')""",
)
def anti_join_new(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.only_left(c, o, ["c_custkey"])


@query(
    "left_join_qc",
    f"""with s as (select o_custkey, count(*) as n, avg(o_totalprice) as mean from orders where o_orderstatus = 'F' group by 1)
select count(n) as both_rows, count(*) - count(n) as left_only_rows, {r('avg(cast(n is null as int))')} as null_rate_n,
 {r('avg(cast(mean is null as int))')} as null_rate_mean from customer left join s on c_custkey = o_custkey""",
)
def left_join_qc(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    s = table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean")
    )
    return rounded(joins.join_report(joins.marked_left_join(c, s, ["c_custkey"]), ["n", "mean"]))


@query(
    "history_join",
    f"""with h as (select user_id, event_type, count(*) as n from events group by 1, 2)
select event_id, n from events e left join h on e.user_id = h.user_id and nullif(e.event_type, 'error') = h.event_type""",
)
def history_join(spark, sf):
    e = table(spark, sf, "events")
    hist = e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    left = e.select("event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return joins.attach_history(left, hist, ["user_id", "event_type"]).select("event_id", "n")


@query(
    "known_only",
    """select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 5000)""",
)
def known_only(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return joins.known_only(o, table(spark, sf, "customer").where("c_acctbal > 5000"), "c_custkey").select("o_orderkey")


@query(
    "named_join",
    """select s_suppkey, n_regionkey from supplier join nation on s_nationkey = n_nationkey""",
)
def named_join(spark, sf):
    name = F.concat(F.lit("　NATION_"), F.col("s_nationkey").cast("string"), F.lit("　"))
    s = table(spark, sf, "supplier").select("s_suppkey", name.alias("n_name"))
    n = table(spark, sf, "nation").select("n_name", "n_regionkey")
    return joins.named_join(s, n, "n_name", tx.person_name).select("s_suppkey", "n_regionkey")


@query(
    "positional_join",
    f"""{lens('lanes')}, a as (select race_id, lane, price, row_number() over (partition by race_id order by lane) as pos from lanes),
b as (select race_id, discount, row_number() over (partition by race_id order by discount desc, lane) as pos from lanes)
select a.race_id, lane, price, b.discount from a left join b on a.race_id = b.race_id and a.pos = b.pos""",
)
def positional_join(spark, sf):
    la = lenses.lanes(spark, sf)
    a = joins.numbered_rows(la.select("race_id", "lane", "price"), "race_id", F.col("lane"))
    b = la.select("race_id", "lane", "discount", F.struct(-F.col("discount"), F.col("lane")).alias("o"))
    b = joins.numbered_rows(b, "race_id", F.col("o")).drop("o", "lane")
    return joins.positional_join(a, b, "race_id", "pos").drop("pos")


RANGE_SQL = f"""{lens('snapshots').replace('with ', 'with recursive ')},
z as (select user_id, day, rate, lag(rate) over (partition by user_id order by day) as prev from snapshots),
cand as (select user_id, day as d from z where prev > 0 and rate = 0),
gap as (select user_id, min(d) as d from cand group by 1 union all
 select * from (select gap.user_id, min(cand.d) as d from gap join cand on cand.user_id = gap.user_id and cand.d >= gap.d + 5
 group by gap.user_id, gap.d) q),
starts as (select user_id, min(day) as d from snapshots group by 1 union select user_id, d from gap),
rg as (select user_id, d as effective_from, row_number() over (partition by user_id order by d) as idx_motor,
 lead(d) over (partition by user_id order by d) - 1 as effective_to from starts)"""


@query("gap_filter", f"{RANGE_SQL} select user_id, d as day from gap")
def gap_filter(spark, sf):
    return ranges.generation_starts(lenses.snapshots(spark, sf), ["user_id"], "day", "rate", gap=5)


@query(
    "transition_events",
    f"""{lens('snapshots')}, z as (select user_id, day, rate, lag(rate) over (partition by user_id order by day) as prev from snapshots)
select user_id, day from z where prev > 0 and rate = 0""",
)
def transition_events(spark, sf):
    return windows.transition_events(lenses.snapshots(spark, sf), ["user_id"], ["day"], "rate").select("user_id", "day")


def ranges_of(spark, sf):
    s = lenses.snapshots(spark, sf)
    s = durable(s, "snapshots")
    starts = ranges.generation_starts(s, ["user_id"], "day", "rate", gap=5)
    return durable(ranges.effective_ranges(s, starts, ["user_id"], "day", "rate"), "ranges")


@query(
    "effective_ranges",
    f"""{RANGE_SQL} select user_id, idx_motor, effective_from, effective_to, lpad(cast(user_id % 24 as varchar), 2, '0')
 || lpad(cast(user_id % 100 as varchar), 2, '0') || lpad(cast(idx_motor as varchar), 2, '0') as motor_id from rg""",
)
def effective_ranges(spark, sf):
    out = ranges_of(spark, sf)
    return out.withColumn("motor_id", ranges.motor_id(F.col("user_id") % 24, F.col("user_id") % 100, F.col("idx_motor")))


@query(
    "effective_join_strict",
    f"""{RANGE_SQL} select event_id, idx_motor from events e left join rg on e.user_id = rg.user_id
 and cast(ts as date) between effective_from and coalesce(effective_to, date '2100-12-31')""",
)
def effective_join_strict(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("date"))
    out = joins.effective_join_strict(e, ranges_of(spark, sf), ["user_id"], "date", "idx_motor", 0.0)
    return out.select("event_id", "idx_motor")


@query(
    "effective_join_first",
    f"""{RANGE_SQL}, wide as (select user_id, idx_motor, case when idx_motor = 1 then null else effective_from end as f, effective_to + 3 as t from rg),
m as (select event_id, idx_motor, row_number() over (partition by event_id order by coalesce(f, date '1900-01-01'), idx_motor) as rn
 from events e join wide on e.user_id = wide.user_id
 and cast(ts as date) between coalesce(f, date '1900-01-01') and coalesce(t, date '2100-12-31'))
select e.event_id, idx_motor from events e left join m on e.event_id = m.event_id and rn = 1""",
)
def effective_join_first(spark, sf):
    """Overlapping ranges: the earliest start wins."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("date"))
    wide = ranges_of(spark, sf).select(
        "user_id", "idx_motor", F.when(F.col("idx_motor") != 1, F.col("effective_from")).alias("effective_from"),
        F.date_add("effective_to", 3).alias("effective_to"),
    )
    out = joins.effective_join_first(e, wide, ["user_id"], "date", "idx_motor")
    return out.select("event_id", "idx_motor")


@query(
    "candidate_clashes",
    f"""{RANGE_SQL}, wide as (select user_id, idx_motor, effective_from as f, effective_to + 3 as t from rg)
select event_id, count(distinct idx_motor) as n_candidates, min(idx_motor) as first_candidate
 from events e join wide on e.user_id = wide.user_id and cast(ts as date) between f and coalesce(t, date '2100-12-31')
 group by 1 having count(distinct idx_motor) > 1""",
)
def candidate_clashes(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("date"))
    wide = ranges_of(spark, sf).withColumn("effective_to", F.date_add("effective_to", 3))
    found = joins.range_matches(e, wide, "event_id", ["user_id"], "date", "idx_motor")
    return quality.candidate_clashes(found, "event_id", "idx_motor")


R3 = ["r1", "r2", "r3"]


@query(
    "lane_share_prior",
    f"""{lens('payouts')}, l as (select venue, unnest([r1, r2, r3]) as lane from payouts where valid),
n as (select venue, lane, count(*) as n from l group by 1, 2), g as (select venue, unnest([1,2,3,4,5,6]) as lane from (select distinct venue from l))
select g.venue, cast(g.lane as bigint) as lane, coalesce(n, 0) as "count",
 {r('coalesce(n, 0) / cast(sum(coalesce(n, 0)) over (partition by g.venue) as double)')} as share
from g left join n on g.venue = n.venue and g.lane = n.lane""",
)
def lane_share_prior(spark, sf):
    return rounded(priors.lane_share_prior(lenses.payouts(spark, sf).where("valid"), "venue", R3))


@query("share_violations", f"""{lens('payouts')}, s as (select venue, count(*) filter (where r1 = 1) / (3.0 * count(*)) as gone
 from payouts where valid group by 1 having count(*) > 0)
select venue, {r("1 - gone", 6)} as total
 from s where venue % 4 = 0 and gone > 0""")
def share_violations(spark, sf):
    """Shares of every fourth venue are broken: its first boats' wins in lane 1 are taken out."""
    races = lenses.payouts(spark, sf).where("valid")
    wins = races.groupBy("venue").agg((F.sum((F.col("r1") == 1).cast("int")) / (3 * F.count(F.lit(1)))).alias("gone"))
    shares = priors.lane_share_prior(races, "venue", R3).join(wins, "venue")
    broken = (F.col("venue") % 4 == 0) & (F.col("lane") == 1)
    shares = shares.withColumn("share", F.col("share") - F.when(broken, F.col("gone")).otherwise(0.0))
    return rounded(priors.share_violations(shares, "venue"), 6)


def _venue_prior_sql():
    cols = []
    for kind, depth in (("win", 1), ("top2", 2), ("top3", 3)):
        for k in K6:
            hits = " + ".join(f"count(*) filter (where valid and r{d} = {k})" for d in range(1, depth + 1))
            cols.append(f"(({hits}) + 0.5) / ({depth} * count(*) filter (where valid) + cast(3.0 as double)) as base_{kind}_{k}")
    return f"""vp as (select venue, count(distinct (day, race_no)) filter (where valid) as n_races, count(popularity) as n_popularity_valid,
 cast(median(popularity) as double) as base_popularity_median, count(payout) as n_payout_valid,
 median(ln(payout + 1)) as base_log_payout_median, {', '.join(cols)} from payouts group by 1)"""


BASES = [f"base_{kind}_{k}" for kind in ("win", "top2", "top3") for k in K6]


def signal_prior(spark, sf, **kw):
    p = lenses.payouts(spark, sf)
    p = p.withColumns({c: F.when(F.col("valid"), F.col(c)) for c in R3})
    return priors.venue_signal_prior(p, "venue", ["day", "race_no"], R3, "popularity", "payout", **kw)


VENUE_SQL = (
    f"{lens('payouts')}, {_venue_prior_sql()} select venue, n_races, n_popularity_valid, {r('base_popularity_median')} as base_popularity_median, "
    f"n_payout_valid, {r('base_log_payout_median', 6)} as base_log_payout_median, "
    + ", ".join(f"{r(c, 6)} as {c}" for c in BASES) + " from vp"
)


@query("venue_signal_prior", VENUE_SQL)
def venue_signal_prior(spark, sf):
    return rounded(signal_prior(spark, sf), 6)


@query("venue_signal_prior_hot", VENUE_SQL)
def venue_signal_prior_hot(spark, sf):
    """Medians through the hot-key path."""
    return rounded(signal_prior(spark, sf, split_rows=(100, 500)), 6)


@query("signal_violations", f"{lens('payouts')}, {_venue_prior_sql()} select venue from vp where venue % 4 = 0")
def signal_violations(spark, sf):
    """One base of every fourth venue is raised; the check must name these venues and no other."""
    broken = F.when(F.col("venue") % 4 == 0, 0.25).otherwise(0.0)
    prior = signal_prior(spark, sf).withColumn("base_top2_1", F.col("base_top2_1") + broken)
    return priors.signal_violations(prior).select("venue")


_before = "over (partition by p.venue, day order by race_no, race_id rows between unbounded preceding and 1 preceding)"


def _posterior_sql(strength=20.0):
    ms, ss = [], []
    for kind, depth in (("win", 1), ("top2", 2), ("top3", 3)):
        gaps = []
        for k in K6:
            hits = " + ".join(f"case when valid and r{d} = {k} then 1 else 0 end" for d in range(1, depth + 1))
            post = (
                f"(({depth} * cast({strength} as double) * base_{kind}_{k} + coalesce(sum({hits}) {_before}, 0)) / "
                f"({depth} * cast({strength} as double) + {depth} * coalesce(sum(cast(valid as int)) {_before}, 0)))"
            )
            ms.append(f"{r(f'{post} / base_{kind}_{k}', 6)} as m_{kind}_{k}")
            gaps.append(f"abs({post} - base_{kind}_{k})")
        ss.append(f"{r(' + '.join(gaps), 6)} as strength_{kind}")
    return f"""{lens('payouts')}, {_venue_prior_sql()} select race_id, p.venue, day, race_no,
 cast(coalesce(sum(cast(valid as int)) {_before}, 0) as bigint) as observed_races, {', '.join(ms + ss)}
 from payouts p join vp on p.venue = vp.venue"""


POSTERIOR_SQL = _posterior_sql()
RACE = ["race_id", "venue", "day", "race_no"]


def posterior(spark, sf, **kw):
    return regime.running_posterior(
        lenses.payouts(spark, sf), durable(signal_prior(spark, sf), "prior"), "venue", "day", ["race_no", "race_id"], R3, "valid",
        keep=RACE, **kw,
    )


@query("running_posterior", POSTERIOR_SQL)
def running_posterior(spark, sf):
    return rounded(posterior(spark, sf), 6)


@query("running_posterior_hot", POSTERIOR_SQL)
def running_posterior_hot(spark, sf):
    """Running totals through the hot-key path."""
    return rounded(posterior(spark, sf, split_rows=(10, 700)), 6)


def _share_sql():
    sh = ", ".join(f"sum(n) filter (where lane = {k}) / cast(sum(n) as double) as s{k}" for k in K6)
    w = "over (partition by p.venue, day order by race_no rows between unbounded preceding and 1 preceding)"
    post, gaps = [], []
    for k in K6:
        hits = " + ".join(f"cast({c} = {k} as int)" for c in R3)
        e = f"((cast(60.0 as double) * s{k} + coalesce(sum({hits}) {w}, 0)) / (cast(60.0 as double) + 3 * (count(*) {w})))"
        post.append(f"{r(e, 6)} as p_post_{k}, {r(f'{e} / s{k}', 6)} as m_top3_{k}")
        gaps.append(f"abs({e} - s{k})")
    return f"""{lens('payouts')}, l as (select venue, unnest([r1, r2, r3]) as lane from payouts where valid),
n as (select venue, lane, count(*) as n from l group by 1, 2), s as (select venue, {sh} from n group by 1)
select race_id, count(*) {w} as observed_races, {', '.join(post)}, {r(' + '.join(gaps), 6)} as strength
 from payouts p join s on p.venue = s.venue where valid"""


@query("share_posterior", _share_sql())
def share_posterior(spark, sf):
    p = lenses.payouts(spark, sf)
    shares = durable(priors.lane_share_prior(p.where("valid"), "venue", R3), "prior")
    out = regime.share_posterior(p, shares, "venue", "day", ["race_no"], R3, "valid", keep=["race_id"])
    return rounded(out, 6)


_mw = "over (partition by p.venue, day order by race_no rows between unbounded preceding and 1 preceding)"
MARKET_SQL = f"""{lens('payouts')}, {_venue_prior_sql()}, m as (select race_id, base_popularity_median as bp, base_log_payout_median as bl,
 count(popularity) {_mw} as pop_valid_obs, count(payout) {_mw} as payout_valid_obs,
 coalesce(quantile_cont(cast(popularity as double), 0.5) {_mw}, base_popularity_median) as pp,
 coalesce(quantile_cont(ln(payout + 1), 0.5) {_mw}, base_log_payout_median) as pl from payouts p join vp on p.venue = vp.venue)
select race_id, pop_valid_obs, payout_valid_obs, {r('bp', 6)} as base_popularity_median, {r('bl', 6)} as base_log_payout_median,
 {r('pp', 6)} as post_popularity_median, {r('pl', 6)} as post_log_payout_median, {r('pp / bp', 6)} as regime_popularity_shift,
 {r('exp(pl - bl)', 6)} as regime_payout_shift, {r('abs(ln(pp / bp)) + abs(ln(exp(pl - bl)))', 6)} as strength_market from m"""


def shift(spark, sf, **kw):
    out = regime.market_shift(
        lenses.payouts(spark, sf), durable(signal_prior(spark, sf), "prior"), "venue", "day", ["race_no"],
        "popularity", "payout", keep=["race_id"], **kw,
    )
    return rounded(out, 6)


@query("market_shift", MARKET_SQL)
def market_shift(spark, sf):
    return shift(spark, sf)


@query("market_shift_hot", MARKET_SQL)
def market_shift_hot(spark, sf):
    """Medians by chunks, each with the earlier values in its reach."""
    return shift(spark, sf, split_rows=(10, 4000))


SHARE = "round(price / sum(cast(price as decimal(18,2))) over (partition by race_id), 6)"


def ticket_input(spark, sf):
    """Lane probability = its share of the race's prices; ability = exhibition value."""
    la = lenses.lanes(spark, sf)
    whole = F.sum(F.col("price").cast("decimal(18,2)")).over(Window.partitionBy("race_id")).cast("double")
    j = la.withColumn("t", whole)
    return j.select("race_id", "lane", F.round(F.col("price") / F.col("t"), 6).alias("p"), F.col("time_tenji").alias("ability"))


def _tickets_sql(exacta: bool, ability: bool) -> str:
    sets = ", ".join(f"coalesce(max(p) filter (where lane = {k}), 0) as b{k}" for k in K6)
    abil = ", ".join(
        (f"coalesce(max(ability) filter (where lane = {k}), 0) as r{k}" if ability else f"0 as r{k}") for k in K6
    )
    top = "greatest(" + ", ".join(f"r{k}" for k in K6) + ")"
    norm = ", ".join(f"case when {top} <= 1.5 then r{k} when {top} = 0 then 0 else r{k} / {top} end as a{k}" for k in K6)
    atts = []
    for k in range(2, 7):
        nb = min(k + 1, 6)
        bonus = {4: 1.05, 3: 1.02}.get(k, 1.0)
        s = f"b{k} * (1 + greatest(0, 0.6 - b1)) * cast({bonus} as double) * (1 + cast(0.2 as double) * greatest(0, least(1, b{nb} / greatest(b{k}, 1e-9))))"
        if ability:
            s += f" * (1 + cast(0.1 as double) * greatest(0, least(1, a{nb} / greatest(a{k}, 1e-9))))"
        sig = f"a{nb} / greatest(a{k}, 1e-9)" if ability else f"b{nb} / greatest(b{k}, 1e-9)"
        atts.append(
            f"select race_id, {k} as att, {nb} as nb, {max(k - 1, 2)} as alt, "
            f"case when b1 >= 0.95 * b{nb} then 1 else {nb} end as pref, {sig} as sig, b1, [b1, b2, b3, b4, b5, b6] as b, "
            f"{s} * case when b1 > 0.70 then greatest(0, 1 - (b1 - 0.70)) else 1 end as s from n"
        )
    tag = (lambda t: t) if not exacta else (lambda t: t.replace(")", ",2連)") if t.endswith(")") else t + "(2連)")
    rev = "0.80 + 0.10 * greatest(0, least(1, (sig - 0.70) / 0.30))"
    pats = [
        f"select *, att as i, 1 as j, cast(1.0 as double) as prior, '{tag('成功/差し')}' as tag from att",
        f"select *, att, nb, 0.95, '{tag('成功/右隣同道')}' from att where nb <> att",
        f"select *, nb, att, {rev}, '{tag('成功/右隣同道(逆転)')}' from att where nb <> att and sig >= case when att = 3 then cast(0.90 - 0.02 as double) else 0.90 end and b1 < 0.75",
        f"select *, 1, nb, 0.85, '{tag('裏スジ/1残り右隣')}' from att",
        f"select *, 1, alt, 0.75, '{tag('裏スジ/保険')}' from att",
    ]
    if not exacta:
        pats.append(f"select *, att, pref, 0.90, '{tag('成功/総括')}' from att where pref <> att")
    core = "pow(greatest(b[i], 1e-9), 0.85) * pow(greatest(b[j], 1e-9), 0.65)"
    if exacta:
        rows = f"select race_id, att, i || '-' || j || '-0' as ticket, prior * {core} as score, prior, tag from pt"
    else:
        rows = (
            f"select race_id, att, i || '-' || j || '-' || k as ticket, prior * ({core} + cast(0.08 as double) * greatest(b[k], 1e-9)) as score, prior, tag "
            "from pt, (select unnest([1,2,3,4,5,6]) as k) ks where k <> i and k <> j"
        )
    return f"""{lens('lanes')}, q as (select race_id, lane, {SHARE} as p, time_tenji as ability from lanes),
w as (select race_id, {sets}, {abil} from q group by 1), n as (select *, {norm} from w),
sc as ({' union all '.join(atts)}),
ok as (select *, row_number() over (partition by race_id order by s desc, att) as ar from sc where s >= 0.20 + greatest(0, b1 - 0.70)),
att as (select *, count(*) over (partition by race_id) as na from ok where ar <= 2),
pt as ({' union all '.join(pats)}), tk as ({rows}),
best as (select race_id, ticket, max(score) as score, arg_max(tag, score) as tag from tk group by 1, 2),
na as (select race_id, max(na) as na from att group by 1),
lim as (select b.race_id, ticket, score, tag, row_number() over (partition by b.race_id order by score desc, ticket) as rn,
 {6 if exacta else 10} * na as lim from best b join na on b.race_id = na.race_id)
select race_id, ticket, {r('score', 6)} as score, tag from lim where rn <= lim"""


@query("exacta_ranking", _tickets_sql(True, False))
def exacta_ranking(spark, sf):
    return rounded(tickets.rank_exactas(ticket_input(spark, sf), "race_id", "lane", "p"), 6)


@query("ticket_ranking", _tickets_sql(False, False))
def ticket_ranking(spark, sf):
    return rounded(tickets.rank_tickets(ticket_input(spark, sf), "race_id", "lane", "p"), 6)


@query("ticket_ranking_ability", _tickets_sql(False, True))
def ticket_ranking_ability(spark, sf):
    return rounded(tickets.rank_tickets(ticket_input(spark, sf), "race_id", "lane", "p", "ability"), 6)
