"""From raw daily rows to the feature table: one lazy chain of operators.

Stages are DataFrame functions; nothing is written in between. Shuffle
boundaries are the race (exclusion, ranks), the player and axis (history) and
the motor (section history).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane import schemas
from heatlane.functions import points
from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.functions.scoring import result_flags, top_flag
from heatlane.operators import filters, joins, priors, quality, windows
from heatlane.session import durable
from heatlane.streaming.live import guard_races


def cast_and_clean(raw: DataFrame) -> DataFrame:
    """Text cells to typed columns; a rate that cannot be read is 0."""
    have = set(raw.columns)
    cols = {}
    if "date" in have:
        cols["date"] = tx.parse_day(F.col("date"))
    if "rank" in have:
        cols["rank_raw"] = F.col("rank")
        cols["rank"] = tx.to_whole(tx.half_width(F.col("rank")))
    cols.update({c: tx.to_whole(tx.half_width(F.col(c))) for c in schemas.WHOLE if c in have})
    cols.update({c: tx.to_number(F.col(c)) for c in schemas.DECIMAL if c in have})
    cols.update({c: F.coalesce(tx.to_number(F.col(c)), F.lit(0.0)) for c in schemas.RATES if c in have})
    cols.update({c: tk.start_time(F.col(c)) for c in schemas.START_TIMES if c in have})
    out = raw.withColumns(cols)
    return windows.rank_in_group(out, "race_id", "ST_tenji", "ST_tenji_rank") if "ST_tenji" in have else out


def conversion_report(typed: DataFrame) -> DataFrame:
    """Rows and nulls per cast column."""
    cast = ["rank", *schemas.WHOLE, *schemas.DECIMAL]
    return quality.null_rates(typed, [c for c in cast if c in typed.columns]).drop("null_rate")


def anomalies(raw: DataFrame, top: int = 20) -> DataFrame:
    """Most frequent cells that do not parse, per column."""
    cells = {}
    for c in ("rank", *schemas.RATES, "temperature", "wind_speed", "water_temperature", "wave_height"):
        if c in raw.columns:
            t = tx.half_width(F.col(c)) if c == "rank" else F.col(c)
            cells[c] = (t, tx.to_number(t).isNull() & (t != ""))
    for c in schemas.START_TIMES:
        if c in raw.columns:
            cells[c] = (F.col(c), tk.start_time(F.col(c)).isNull())
    for c in ("weather", "wind_direction"):
        if c in raw.columns:
            cells[c] = (F.col(c), F.coalesce(tx.is_blank_mark(F.col(c)), F.lit(True)))
    return quality.bad_values(raw, cells, top)


# Texts of the exclusion reasons.
REASONS = {
    "rank_nonnumeric": "着順が数字でない（失格・転覆等）",
    "weather_missing_any": "気象データに欠損あり",
    "sttenji_nonnumeric": "展示STに数値化できない表記あり（L等）",
}


def exclusion_rules(df: DataFrame) -> dict:
    missing = F.lit(False)
    for c in schemas.WEATHER:
        if c in df.columns:
            missing = missing | F.col(c).isNull()
    rules = {"rank_nonnumeric": F.col("rank").isNull(), "weather_missing_any": missing}
    if "ST_tenji" in df.columns:
        rules["sttenji_nonnumeric"] = F.col("ST_tenji").isNull()
    return rules


def base_table(raw: DataFrame, start=None, end=None) -> tuple[DataFrame, DataFrame]:
    """(typed rows of complete races, excluded races with reasons)."""
    typed = filters.filter_period(cast_and_clean(raw), "date", start, end)
    typed = typed.withColumn("is_top2", top_flag(F.col("rank"))).withColumn("season_q", tk.season(F.col("date")))
    kept, broken = filters.drop_bad_groups(typed, "race_id", exclusion_rules(typed))
    named = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])
    return kept, broken.withColumn("reason", F.element_at(named, F.col("rule_key")))


def with_priors(df: DataFrame, tenji: DataFrame, course: DataFrame, trick: DataFrame, live: bool = False) -> DataFrame:
    """Exhibition residuals and ranks, course and trick priors.

    Live rows use the sd floor and rank missing values last.
    """
    keys = ["place", "wakuban", "season_q"]
    out = joins.lookup_join(df, filters.keys_and_numbers(tenji, keys, ("sd_floor", "m_strength")), keys)
    out = priors.residual_z(out, "time_tenji", "tenji_mu", "tenji_sd", null_sd="floor" if live else "null")
    nulls = "last" if live else "unranked"
    for col, name in (("time_tenji", "tenji_rank"), ("tenji_resid", "tenji_resid_rank"), ("tenji_z", "tenji_z_rank")):
        out = windows.rank_in_group(out, "race_id", col, name, nulls)
    out = windows.top_flags(out, "tenji_rank", prefix="tenji_top")
    course_keys = ["place", "entry", "season_q"]
    seen_keys = ["place", "__axis", "season_q"]
    for prior in (course, trick):
        right = filters.keys_and_numbers(prior, course_keys, ("m_strength",)).withColumnRenamed("entry", "__axis")
        out = joins.lookup_join(out.withColumn("__axis", F.col("wakuban")), right, seen_keys).drop("__axis")
    return out


def history_table(raw: DataFrame, start, end, warmup: int = 180) -> DataFrame:
    """All rows from the warm-up on, before any exclusion, with history flags."""
    have = cast_and_clean(raw)
    have = filters.filter_with_warmup(have, "date", start, end, warmup)
    have = filters.fill_from(have, "entry", "entry_tenji") if "entry_tenji" in have.columns else have
    flags = result_flags(have.withColumn("__place", tk.finish_place(F.col("rank_raw"))), "__place", pattern="f{}")
    return flags.withColumn("started", tk.is_started(F.col("rank_raw"))).drop("__place")


def with_history(df: DataFrame, hist: DataFrame, n: int = 10) -> DataFrame:
    """Player history by entry course and by gate, joined on (race, player, axis)."""
    flags = {f"finish{i}": f"f{i}" for i in (1, 2, 3)}
    out = df
    for axis, suffix in (("entry", "_entry"), ("wakuban", "_waku")):
        rows = hist.select("race_id", "player_id", axis, "date", "started", "f1", "f2", "f3", "ST")
        feats = windows.history_rates(
            rows, "player_id", axis, ["date", "race_id"], "started", flags, "ST", n=n, suffix=suffix
        )
        keep = [c for c in feats.columns if c.endswith(suffix)]
        keys = ["race_id", "player_id", axis]
        out = joins.attach_history(out, feats.select(*keys, *keep), keys)
    return out


def with_meeting(df: DataFrame, raceinfo: DataFrame) -> DataFrame:
    """Current-meeting columns; missing ones are neutral."""
    right = raceinfo.withColumn("player_id", tx.to_whole(F.col("player_id")))
    out = joins.attach_new_columns(df, right, ["race_id", "player_id"], ["race_id"])
    out = filters.fill_neutral(out, schemas.SECTIONAL)
    out = filters.ensure_columns(out, ["ST_previous_time"], "string")
    return out.withColumn("ST_previous_time_num", points.previous_start_number(F.col("ST_previous_time"))).withColumn(
        "race_ct_clip6", points.runs_clipped(F.col("race_ct_current"))
    )


def with_motor_id(df: DataFrame, ranges: DataFrame, max_miss_pct: float | None = None) -> DataFrame:
    """Generation of the motor on the race day; two candidates are an error."""
    keys = ["code", "motor_number"]
    return joins.effective_join_strict(df, joins.align_keys(df, ranges, keys), keys, "date", "motor_id", max_miss_pct)


def with_motor_history(df: DataFrame, features: DataFrame, prefix: str = "motor_") -> DataFrame:
    """Lagged section features of the motor; the key must be unique."""
    right = filters.require_no_nulls(features, ["motor_id", "section_id"], "section features")
    right = filters.take_prefixed(right, ["motor_id", "section_id"], ["prev1_", "prev3_", "prev5_", "delta_"], prefix)
    return joins.lookup_join(df, right, ["motor_id", "section_id"])


def build_master(
    raw: DataFrame, tenji: DataFrame, course: DataFrame, trick: DataFrame, raceinfo: DataFrame,
    motor_ranges: DataFrame, motor_features: DataFrame, start, end, stages: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(feature table, excluded races): the six stages in order."""
    base, excluded = base_table(raw, start, end)
    out = with_priors(base, tenji, course, trick)
    out = with_history(out, history_table(raw, start, end))
    out = with_meeting(out, raceinfo)
    out = with_motor_id(out, motor_ranges)
    out = with_motor_history(out, motor_features)
    if stages:
        out = filters.filter_stage(out, "race_name", stages)
    return out, excluded


# --- priors and motor tables ---------------------------------------------------------------------


def build_priors(raw: DataFrame, start, end, m: float = 0.0) -> dict[str, DataFrame]:
    """Exhibition, course and trick priors of a period. Rebuild per time fold
    from its past only, or the prior leaks the future."""
    typed = filters.filter_period(cast_and_clean(raw), "date", start, end)
    typed = typed.withColumn("season_q", tk.season(F.col("date")))
    return {
        "tenji": priors.shrunk_mean_sd(
            filters.filter_positive(typed, "time_tenji"), ["place", "wakuban", "season_q"], "time_tenji"
        ),
        "season_course": priors.course_prior(typed, "place", "entry", "season_q", "rank", m),
        "winning_trick": priors.trick_prior(typed, "place", "entry", "season_q", "rank", "winning_trick", m),
    }


def raw_with_motor(raw: DataFrame, snapshots: DataFrame, ranges: DataFrame) -> DataFrame:
    """Raw rows with the rank parsed, void races dropped, the day's motor
    snapshot beside them and the motor generation (first match)."""
    typed = cast_and_clean(raw).withColumn("p", tk.parse_rank(F.col("rank_raw"))).select("*", "p.*").drop("p")
    kept = filters.drop_void_groups(typed, "race_id")
    snap = joins.align_keys(kept, snapshots, ["date", "code", "motor_number"])
    out = joins.attach_first(kept, snap, ["date", "code", "motor_number"], ["snapshot_id"], "_snap")
    keys = ["code", "motor_number"]
    out = joins.effective_join_first(out, joins.align_keys(out, ranges, keys), keys, "date", "motor_id")
    return out.withColumn("date_iso", tx.iso_day(F.col("date")))


def section_features(with_motor: DataFrame) -> DataFrame:
    """Totals per (motor, section) and their lags."""
    rows = filters.drop_void_rows(filters.drop_null_keys(with_motor, ["motor_id", "section_id"]))
    rows = rows.withColumns({"entry": tk.clamp_place(F.col("entry")), "rank_num": tk.clamp_place(F.col("rank_num"))})
    table = points.point_table(with_motor.sparkSession)
    rows = joins.point_lookup(rows, table, ["entry", "rank_num"], ["ranking_point", "condition_point"])
    rows = rows.withColumn("score", F.coalesce(points.finish_score(F.col("rank_num")), F.lit(0)))
    names = ["score", "ranking_point", "condition_point"]
    base = priors.section_totals(rows, ["motor_id", "section_id"], "date", "is_start", {n: n for n in names})
    base = durable(base, "sections")
    order = ["section_start_dt", "section_end_dt", "section_id"]
    return windows.prev_features(
        base, "motor_id", order, [f"motor_{n}_rate" for n in names], ["motor_race_ct", *[f"motor_{n}_sum" for n in names]]
    )


# --- live rows -----------------------------------------------------------------------------------


def prepare_live(live: DataFrame, training_schema, tenji, course, trick, hist: DataFrame, raceinfo: DataFrame | None = None):
    """Live rows through the training features: conform to the training raw
    table, guard, priors in live mode, history with the live rows as targets,
    neutral meeting values when the card is not there."""
    rows = cast_and_clean(filters.conform(live, training_schema))
    rows = filters.fill_from(rows, "entry", "entry_tenji").withColumn("season_q", tk.season(F.col("date"), "autumn"))
    go, stopped = guard_races(rows, "race_id", "ST_tenji")
    out = with_priors(go, tenji, course, trick, live=True)
    targets = go.select("race_id", "player_id", "entry", "wakuban", "date", "ST")
    out = with_history(out, windows.append_targets(hist, targets, ["race_id", "player_id"], "started"))
    out = with_meeting(out, raceinfo) if raceinfo is not None else filters.fill_neutral(out, schemas.SECTIONAL)
    return out, stopped
