"""Filters, joins, ranges, priors, signals and tickets on hand-made races."""

import datetime as dt
import random

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatlane.functions import scoring
from heatlane.operators import filters, joins, priors, quality, ranges, regime, sets, tickets
from heatlane.streaming import live

D = dt.date


def test_gap_rule(spark):
    days = [D(2024, 1, 1), D(2024, 3, 1), D(2024, 8, 1), D(2024, 9, 1)]
    df = spark.createDataFrame([("m", d) for d in days], "k string, d date")
    assert rows(ranges.gap_filter(df, ["k"], "d", 180), "d") == [(days[0],), (days[2],)]
    exact = spark.createDataFrame([("m", days[0]), ("m", days[0] + dt.timedelta(180))], "k string, d date")
    assert ranges.gap_filter(exact, ["k"], "d", 180).count() == 2


def test_generations(spark):
    seen = [(D(2023, 10, 1), 30.0), (D(2023, 12, 1), 20.0), (D(2024, 1, 1), 0.0), (D(2024, 2, 1), 10.0),
            (D(2024, 3, 1), 0.0), (D(2024, 7, 1), 5.0), (D(2024, 8, 1), 0.0), (D(2024, 8, 20), 9.0), (D(2024, 9, 1), 0.0)]
    snap = spark.createDataFrame([(7, 12, d, r) for d, r in seen], "code int, motor_number int, date date, motor_2rentai_rate double")
    got = rows(ranges.motor_id_map(snap), "motor_id", "effective_from", "effective_to")
    assert got == [
        ("071201", D(2023, 10, 1), D(2023, 12, 31)), ("071202", D(2024, 1, 1), D(2024, 7, 31)), ("071203", D(2024, 8, 1), None),
    ]
    loose = ranges.motor_id_map(snap, use_transition=False)
    assert loose.count() == 3


RANGES = [("m", 1, None, D(2024, 1, 31)), ("m", 2, D(2024, 2, 1), None)]
RANGE_SCHEMA = "k string, id int, effective_from date, effective_to date"


def test_effective_join(spark):
    facts = spark.createDataFrame([(1, "m", D(2024, 1, 31)), (2, "m", D(2024, 2, 1)), (3, "x", D(2024, 2, 1))], "r int, k string, d date")
    table = spark.createDataFrame(RANGES, RANGE_SCHEMA)
    for join in (joins.effective_join_first, joins.effective_join_strict):
        assert rows(join(facts, table, ["k"], "d", "id"), "r", "id") == [(1, 1), (2, 2), (3, None)]
    with pytest.raises(ValueError, match="no id"):
        joins.effective_join_strict(facts, table, ["k"], "d", "id", max_miss_pct=10)
    clash = spark.createDataFrame([*RANGES, ("m", 3, D(2024, 1, 15), D(2024, 3, 1))], RANGE_SCHEMA)
    with pytest.raises(ValueError, match="several"):
        joins.effective_join_strict(facts, clash, ["k"], "d", "id")
    assert rows(joins.effective_join_first(facts, clash, ["k"], "d", "id"), "r", "id")[0] == (1, 1)


def test_effective_join_against_all_ranges(spark):
    """Random overlapping, open, reversed and equal ranges, null keys and days, against a plain loop."""
    rng = random.Random(3)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rng.randrange(700))
    table = [(rng.choice("abc"), i % 40, rng.choice([None, day()]), rng.choice([None, day(), day()])) for i in range(120)]
    table += [(None, 5, None, None), ("c", None, D(2024, 3, 1), D(2024, 3, 2))]
    facts = [(i, rng.choice(["a", "b", "c", "x", None]), rng.choice([day(), day(), day(), None])) for i in range(400)]
    wide = spark.createDataFrame(table, RANGE_SCHEMA)
    asked = spark.createDataFrame(facts, "r int, k string, d date")

    def held(k, d):
        found = [(a or D(1900, 1, 1), v) for key, v, a, z in table if key == k and k and d and (a or D.min) <= d <= (z or D.max)]
        return sorted(found, key=lambda f: (f[0], f[1] is not None, f[1] or 0))

    want = [(r, (held(k, d) or [(None, None)])[0][1]) for r, k, d in facts]
    assert rows(joins.effective_join_first(asked, wide, ["k"], "d", "id"), "r", "id") == sorted(want, key=repr)
    every = [(r, v) for r, k, d in facts for _, v in held(k, d)]
    assert rows(joins.range_matches(asked, wide, "r", ["k"], "d", "id")) == sorted(every, key=repr)
    none = asked.limit(0)
    assert joins.effective_join_strict(none, wide, ["k"], "d", "id", 0.0).count() == 0


def test_effective_join_of_a_key_with_many_ranges(spark):
    """A million ranges of one key, as many rows of one day: no array, no row of the key's size."""
    many = spark.range(1_000_000).select(
        F.lit("m").alias("k"), F.lit(7).alias("id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 9000).cast("int")).alias("effective_from")
    ).withColumn("effective_to", F.date_add("effective_from", 1))
    facts = spark.range(1_000_000).select(F.lit("m").alias("k"), F.lit(D(2012, 5, 5)).alias("d"), "id").withColumnRenamed("id", "r")
    out = joins.effective_join_strict(facts, many, ["k"], "d", "id", max_miss_pct=0.0)
    assert out.where("id = 7").count() == 1_000_000


def test_lookup_contract(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "r int, k string")
    with pytest.raises(ValueError, match="not unique"):
        joins.lookup_join(facts, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), ["k"])
    out = joins.lookup_join(facts, spark.createDataFrame([("a", 1)], "k string, v int"), ["k"])
    assert rows(out, "r", "v") == [(1, 1), (2, None)]


def test_bad_and_void_groups(spark):
    df = spark.createDataFrame([("r1", 1, "finish"), ("r1", 2, "void"), ("r2", 1, "finish"), ("r2", 2, None)], "race string, l int, rank_class string")
    assert rows(filters.drop_void_groups(df, "race"), "race", "l") == [("r2", 1), ("r2", 2)]
    assert filters.drop_void_rows(df).count() == 3
    kept, why = filters.drop_bad_groups(df, "race", {"void": F.col("rank_class") == "void", "none": F.col("rank_class").isNull()})
    assert kept.count() == 0 and rows(why) == [("r1", "void"), ("r2", "none")]
    summary = quality.void_summary(df, "race").first()
    assert (summary["rows_before"], summary["races_dropped"], summary["rows_after"]) == (4, 1, 2)


def test_group_filters_plan_their_input_once(spark):
    """Both ways of dropping groups agree, also on rows without a key, and the small one reads its input once."""
    data = [("a", 1, 1), ("a", 2, None), ("b", 1, 1), ("b", 2, 2), (None, 1, 1), (None, None, None)]
    df = spark.createDataFrame(data, "race string, l int, v int")
    bad = F.col("v").isNull()
    kept = [(None, 1, 1), (None, None, None), ("b", 1, 1), ("b", 2, 2)]
    for small in (True, False):
        assert rows(filters.drop_groups(df, "race", bad, small=small)) == sorted(kept, key=repr)
    assert rows(filters.complete_groups(df, "race", "v", 2)) == [("b", 1, 1), ("b", 2, 2)]
    assert rows(quality.group_all_flag(df, "race", F.col("v") > 0, "all").select("race", "all").distinct()) == [("a", 0), ("b", 1), (None, None)]
    go, stop = live.guard_races(df, "race", "v")
    assert (go.count(), stop.count()) == (4, 2) and go.columns == df.columns
    for out in (filters.drop_groups(df, "race", bad), filters.complete_groups(df, "race", "v"), go):
        assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_exclusion_report_merges(spark):
    a = spark.createDataFrame([("r", "b"), ("r", "a"), ("s", "b")], "race_id string, reason string")
    assert rows(quality.exclusion_report(a, a)) == [("r", "a / b"), ("s", "b")]


def test_group_checks_and_flags(spark):
    df = spark.createDataFrame([("ok", i, 1) for i in range(1, 7)] + [("bad", i, None) for i in range(1, 6)], "race string, l int, v int")
    assert rows(quality.group_checks(df, "race", "l", ["v"]), "race", "n_rows", "null_v") == [("bad", 5, 5)]
    flags = quality.group_all_flag(df, "race", F.col("v") == 1, "all").select("race", "all").distinct()
    assert rows(flags) == [("bad", 0), ("ok", 1)]


def test_guards_and_conform(spark):
    df = spark.createDataFrame([("1", "x")], "a string, extra string")
    out = filters.conform(df, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())]))
    assert out.first() == (1, None) and out.columns == ["a", "b"]
    with pytest.raises(ValueError):
        filters.require_columns(df, ["z"])
    with pytest.raises(ValueError):
        filters.require_no_nulls(out, ["b"])
    assert filters.fill_neutral(df, ["a", "n"]).select("a", "n").first() == (1.0, 0.0)


def test_select_features(spark):
    df = spark.createDataFrame([(1, 2.0, "x", f"t{i}", "p") for i in range(5)], "race_id int, n double, cat string, many string, place string")
    assert filters.select_features(df, max_categories=2) == ["cat", "n"]
    assert filters.select_features(df, use=["n", "cat"], drop=["cat"], add=["many"], force_drop=["n"]) == ["many"]
    with pytest.raises(ValueError):
        filters.select_features(df, use=["gone"])
    assert filters.select_features(df, use=["gone", "n"], allow_missing=True) == ["n"]


def test_smoothing(spark):
    tbl = spark.createDataFrame([(10, *[3, 0, 0, 0, 0, 7])], "n long, c1 long, c2 long, c3 long, c4 long, c5 long, c6 long")
    labels = [str(k) for k in range(1, 7)]
    assert priors.smoothed_share(tbl, "n", labels).first()["p1"] == pytest.approx(0.3)
    assert priors.smoothed_share(tbl, "n", labels, 6).first()["p1"] == pytest.approx(0.25)


def test_shrinkage(spark):
    data = [("a", 6.75 + (0.05 if i % 2 else -0.05)) for i in range(200)] + [("b", 6.65 + (0.05 if i % 2 else -0.05)) for i in range(200)]
    out = priors.shrunk_mean_sd(spark.createDataFrame(data, "k string, v double"), ["k"], "v", names=("mu", "sd", "n"))
    assert out.where("k = 'a'").first()["mu"] == pytest.approx(6.725)
    lone = priors.shrunk_mean_sd(spark.createDataFrame([("a", 1.0)], "k string, v double"), ["k"], "v", names=("mu", "sd", "n"))
    assert lone.first()["sd"] == pytest.approx(0.02)


def test_residual_modes(spark):
    df = spark.createDataFrame([(1.0, 0.5, None), (1.0, 0.5, 0.001)], "v double, mu double, sd double")
    assert [r["tenji_z"] for r in priors.residual_z(df, "v", "mu", "sd").collect()] == [None, 25.0]
    assert [r["tenji_z"] for r in priors.residual_z(df, "v", "mu", "sd", null_sd="floor").collect()] == [25.0, 25.0]


def prior_row(spark, win1=0.5):
    rest = (1 - win1) / 5
    values = [win1, *[rest] * 5, *[1 / 6] * 12]
    names = [f"base_{kind}_{k}" for kind in ("win", "top2", "top3") for k in range(1, 7)]
    return spark.createDataFrame([("v", *values)], "venue string, " + ", ".join(f"{n} double" for n in names))


def test_running_posterior(spark):
    races = spark.createDataFrame(
        [("r1", "v", 1, 1, 1, 2, 3, True), ("r2", "v", 1, 2, 9, 2, 3, True), ("r3", "v", 1, 3, 2, 1, 3, False),
         ("r4", "v", 1, 4, 1, 2, 3, True), ("x", "unknown", 1, 1, 1, 2, 3, True)],
        "race_id string, venue string, day int, no int, r1 int, r2 int, r3 int, valid boolean",
    )
    out = regime.running_posterior(races, prior_row(spark), "venue", "day", ["no"], ["r1", "r2", "r3"], "valid", keep=["race_id"])
    got = {r["race_id"]: r for r in out.collect()}
    assert set(got) == {"r1", "r2", "r3", "r4"}  # no prior, no row
    assert got["r1"]["m_win_1"] == pytest.approx(1.0) and got["r1"]["strength_win"] == pytest.approx(0.0)
    assert got["r2"]["m_win_1"] == pytest.approx(22 / 21)
    # r2 has an impossible place and r3 is invalid: both are shown, neither counts
    assert got["r4"]["m_win_1"] == pytest.approx(22 / 21) and got["r4"]["observed_races"] == 1


def test_market_shift_starts_at_base(spark):
    races = spark.createDataFrame([("a", "v", 1, 1, 4, 99.0), ("b", "v", 1, 2, None, 9.0), ("c", "v", 1, 3, 2, 9.0)], "race_id string, venue string, day int, no int, pop int, pay double")
    prior = spark.createDataFrame([("v", 2.0, 1.0)], "venue string, base_popularity_median double, base_log_payout_median double")
    got = rows(regime.market_shift(races, prior, "venue", "day", ["no"], "pop", "pay", keep=["race_id"]), "race_id", "pop_valid_obs", "regime_popularity_shift")
    assert got == [("a", 0, 1.0), ("b", 1, 2.0), ("c", 1, 2.0)]


def test_lane_share_has_zero_rows(spark):
    p = spark.createDataFrame([("v", 1, 2, 3), ("v", 1, 3, 2), ("v", 1, 2, None)], "venue string, a int, b int, c int")
    got = rows(priors.lane_share_prior(p, "venue", ["a", "b", "c"]), "lane", "count", "share")
    assert got[0] == (1, 2, pytest.approx(1 / 3)) and got[5] == (6, 0, 0.0) and len(got) == 6


def test_pairs(spark):
    df = spark.createDataFrame([("r", k, float(k), k <= 2) for k in range(1, 7)], "race string, lane int, v double, top boolean")
    df = df.withColumn("top", F.col("top").cast("int"))
    pairs = scoring.pair_features(joins.pairs_within_group(df, "race", "lane", ["v", "top"]), ["v"], label="top")
    assert pairs.count() == 15
    first = pairs.where("lane_i = 1 and lane_j = 2").first()
    assert (first["v_mean"], first["v_diff"], first["v_adiff"], first["y"]) == (1.5, -1.0, 1.0, 1)
    assert pairs.where("y = 1").count() == 1


def test_tickets(spark):
    p = {1: 0.3, 2: 0.1, 3: 0.1, 4: 0.35, 5: 0.34, 6: 0.05}
    df = spark.createDataFrame([("r", k, v) for k, v in p.items()], "race string, lane int, p double")
    out = tickets.rank_tickets(df, "race", "lane", "p")
    got = {r["ticket"]: r for r in out.collect()}
    core = 0.35**0.85 * 0.3**0.65
    assert got["4-1-5"]["score"] == pytest.approx(core + 0.08 * 0.34)
    # 5 follows 4 closely, so the reverse pattern 5-4 is open: its prior is 0.8 + 0.1 * ((0.34 / 0.35 - 0.7) / 0.3)
    reverse = (0.8 + 0.1 * (0.34 / 0.35 - 0.7) / 0.3) * (0.34**0.85 * 0.35**0.65 + 0.08 * 0.3)
    assert got["5-4-1"]["score"] == pytest.approx(reverse) and got["5-4-1"]["tag"] == "成功/右隣同道(逆転)"
    assert len(got) <= 20
    calm = spark.createDataFrame([("r", k, 0.9 if k == 1 else 0.02) for k in range(1, 7)], "race string, lane int, p double")
    assert tickets.rank_tickets(calm, "race", "lane", "p").count() == 0
    assert tickets.rank_exactas(df, "race", "lane", "p").where("ticket like '%-0'").count() <= 12


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, w double")
    assert rows(sets.add_new_rows(a, b, ["id"])) == [(1, "x", None), (2, None, 3.0)]
    old = spark.createDataFrame([("p", 1.0, "a")], "rel_path string, mtime double, sha256 string")
    new = spark.createDataFrame([("p", 2.0, "b"), ("q", 1.0, "c")], "rel_path string, mtime double, sha256 string")
    assert rows(sets.upsert(old, new, ["rel_path"], ["mtime"]), "rel_path", "sha256") == [("p", "b"), ("q", "c")]


def test_due_jobs(spark):
    t = spark.createDataFrame([(1, "1", "1", "2024-01-01 10:00:00"), (1, "1", "1", "2024-01-01 10:00:00"), (2, "1", "2", "2024-01-01 09:00:00"), (3, "1", "3", None)], "seq int, jcd string, rno string, d string")
    t = t.withColumn("deadline_dt", F.col("d").cast("timestamp"))
    out = filters.due_jobs(t, F.lit("2024-01-01 09:30:00").cast("timestamp"), 5)
    assert [str(r["run_at"]) for r in out.collect()] == ["2024-01-01 09:55:00"]


def test_history_join_is_many_to_one(spark):
    df = spark.createDataFrame([("r", "p", 1), ("r", "q", None), ("s", "p", 2)], "race string, player string, axis int")
    hist = spark.createDataFrame([("r", "p", 1, 0.5), ("r", "p", 3, 0.7), ("r", "q", None, 0.1), ("r", "q", None, 0.2)], "race string, player string, axis int, rate double")
    keys = ["race", "player", "axis"]
    assert rows(joins.attach_history(df, hist, keys), "race", "player", "rate") == [("r", "p", 0.5), ("r", "q", None), ("s", "p", None)]
    with pytest.raises(Exception, match="several history rows for r, p, 1"):
        joins.attach_history(df, hist.unionByName(hist), keys).collect()


def test_ticket_levels_by_race(spark):
    """Races of two levels ranked together give what each gives alone."""
    data = [(r, k, p) for r in ("n", "f") for k, p in zip(range(1, 7), (0.72, 0.5, 0.45, 0.4, 0.3, 0.2))]
    df = spark.createDataFrame(data, "race string, lane int, p double").withColumn("grade", F.when(F.col("race") == "f", "final").otherwise("normal"))
    both = tickets.rank_tickets(df, "race", "lane", "p", level=F.col("grade"))
    for race, level in (("n", "normal"), ("f", "final")):
        alone = tickets.rank_tickets(df.where(F.col("race") == race), "race", "lane", "p", level=level)
        assert rows(both.where(F.col("race") == race)) == rows(alone)


def test_tickets_are_ranked_inside_the_row_of_a_race(spark):
    """No sorting aggregate over exploded tickets, and rows move by race alone."""
    from heatlane.operators import tickets

    df = spark.range(600).select((F.col("id") / 6).cast("long").alias("race"), (F.col("id") % 6 + 1).alias("lane"), (F.rand(3) / 3).alias("p"))
    for rank in (tickets.rank_tickets, tickets.rank_exactas):
        plan = rank(df, "race", "lane", "p")._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Window" not in plan and plan.count("Exchange") == 1


def test_exclusion_report_query_reads_its_reasons_once(spark, small):
    """New reasons and the older list come from one written table; races are not put together again for each."""
    from heatlane.plans.queries import groups

    out = groups.exclusion_report(spark, small)
    assert all("/reasons-" in path for path in out.inputFiles()) and len(out.inputFiles()) > 0
    found = {r["reason"] for r in out.collect()}
    assert "rank_nonnumeric / weather_missing_any" in found and all(list(x.split(" / ")) == sorted(set(x.split(" / "))) for x in found)
