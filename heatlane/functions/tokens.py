"""Domain tokens: start time, finishing rank, season, meeting, grade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from heatlane.functions import text as tx

# Result tokens and the class each belongs to.
RANK_CLASSES = {
    "dns": ["欠"],
    "dsq": ["妨", "エ", "転", "落", "沈", "失"],
    "dnf": ["不"],
    "fs": ["F"],
    "ls": ["L"],
    "void": ["＿"],
}
STARTED_CLASSES = ["finish", "dsq", "dnf", "fs", "ls"]
CLASS_COUNTERS = {
    "finish": "finish_count",
    "dns": "dns_count",
    "dsq": "dsq_count",
    "dnf": "dnf_count",
    "fs": "false_start_count",
    "ls": "late_start_count",
    "void": "void_race_flag_count",
}

# Fixed value: stand-in for a late start seen in the exhibition run.
EXHIBITION_LATE = 0.45

# Winning tricks and their labels.
TRICKS = {
    "逃げ": "nige",
    "差し": "sashi",
    "まくり": "makuri",
    "まくり差し": "makurizashi",
    "抜き": "nuki",
    "恵まれ": "megumare",
}

# The 24 venues in code order.
VENUES = (
    "桐生 戸田 江戸川 平和島 多摩川 浜名湖 蒲郡 常滑 津 三国 びわこ 住之江 "
    "尼崎 鳴門 丸亀 児島 宮島 徳山 下関 若松 芦屋 福岡 唐津 大村"
).split()

# Race-name patterns of the late stages of a meeting.
STAGES = {"finals": "優勝戦", "semi": "準優勝戦", "semi-entry": "準優進出戦|準優進出"}

# Fixed patterns: an optional lane digit and letter, then the number.
TIME = r"(?i)^(?:(?:[0-9]+\s*)?[FL](?=\.)|[FL]\s*|)([0-9]+(?:\.[0-9]+)?|\.[0-9]+)$"
LEGACY_TIME = r"(?i)^(?:[FL](?=\.)|)([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?)$"

START_TIME_KINDS = ("base", "course", "race", "exhibition", "legacy")


def start_time(c: Column, kind: str = "base") -> Column:
    """Start timing in seconds; a false start is negative.

    ``base``: digits may be full-width. ``course``: full-width dot and dash too.
    ``race`` / ``exhibition``: as base, and an exhibition cell such as ``4  L``
    is the late stand-in value. ``legacy``: only ``F.nn``, ``L.nn`` and numbers.
    """
    if kind not in START_TIME_KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    t = tx.half_width(tx.strip(c.cast("string")), marks=kind == "course", letters=kind != "legacy")
    number = F.regexp_extract(t, LEGACY_TIME if kind == "legacy" else TIME, 1)
    sign = F.when(t.rlike(r"(?i)^[0-9]*\s*F"), -1.0).otherwise(1.0)
    scale = F.when(number.rlike("^[0-9]{2}$"), 100.0).otherwise(1.0)
    if kind == "legacy":
        scale = F.lit(1.0)
    value = sign * (number.try_cast("double") / scale)
    if kind == "exhibition":
        return F.when(t.rlike(r"(?i)^[0-9]+\s*L$"), F.lit(EXHIBITION_LATE)).otherwise(value)
    return value


def rank_token(c: Column) -> Column:
    """One normalised token: half-width, no white space, never null."""
    t = F.translate(c.cast("string"), "０１２３４５６ＦＬ　", "0123456FL ")
    return F.coalesce(F.replace(tx.strip(t), F.lit(" "), F.lit("")), F.lit(""))


def _lookup(token: Column, values: dict) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), token)


def _class_of_token() -> dict[str, str]:
    named = {str(k): "finish" for k in range(1, 7)}
    named.update({t: name for name, tokens in RANK_CLASSES.items() for t in tokens})
    return named


def rank_class(token: Column) -> Column:
    return F.coalesce(_lookup(token, _class_of_token()), F.lit("unknown"))


def parse_rank(c: Column) -> Column:
    """Struct (rank_code, rank_num, rank_class, is_start, is_finish)."""
    token = rank_token(c)
    started = {t: cls in STARTED_CLASSES for t, cls in _class_of_token().items()}
    return F.struct(
        token.alias("rank_code"),
        F.regexp_extract(token, "^([1-6])$", 1).try_cast("double").alias("rank_num"),
        rank_class(token).alias("rank_class"),
        F.coalesce(_lookup(token, started), F.lit(False)).alias("is_start"),
        token.rlike("^[1-6]$").alias("is_finish"),
    )


def is_started(c: Column) -> Column:
    """History rule: only ``欠``, blanks and dashes did not start."""
    t = tx.half_width(tx.strip(c.cast("string")), letters=True)
    return F.coalesce(~tx.is_blank_mark(t) & ~F.startswith(t, F.lit("欠")), F.lit(False))


def finish_place(c: Column) -> Column:
    """Place 1..6 or null, after half-width conversion."""
    return tx.parse_lane(c)


def clamp_place(c: Column) -> Column:
    """Rounded number when it lies in 1..6, else null."""
    x = F.rint(tx.to_number(c)).cast("long")
    return F.when(x.between(1, 6), x)


def season(day: Column, when_null: str | None = None) -> Column:
    """spring / summer / autumn / winter by month; live rows use ``autumn`` for null."""
    m = F.month(day)
    out = (
        F.when(m.between(3, 5), "spring").when(m.between(6, 8), "summer").when(m.between(9, 11), "autumn")
    )
    out = out.when(m.isNotNull(), "winter")
    return F.coalesce(out, F.lit(when_null)) if when_null else out


SCHEDULE = r"^\s*([0-9]{1,2})/([0-9]{1,2})\s*-\s*([0-9]{1,2})/([0-9]{1,2})\s*$"


def schedule_is_bad(day_text: Column, schedule: Column) -> Column:
    ok = schedule.rlike(SCHEDULE) & F.substring(tx.strip(day_text), 1, 4).rlike("^[0-9]{4}$")
    return ~F.coalesce(ok, F.lit(False))


def section_id(day_text: Column, code: Column, schedule: Column) -> Column:
    """``<meeting start>_<venue>``; a December start seen in January or February
    belongs to the year before; without a usable schedule the day itself."""
    day = tx.strip(day_text.cast("string"))
    month = F.regexp_extract(schedule, SCHEDULE, 1)
    dom = F.regexp_extract(schedule, SCHEDULE, 2)
    crosses = F.substring(day, 5, 2).isin("01", "02") & (month == "12")
    year = F.substring(day, 1, 4).try_cast("int") - F.when(crosses, 1).otherwise(0)
    start = F.concat(year.cast("string"), tx.pad_left(month, 2), tx.pad_left(dom, 2))
    start = F.when(schedule_is_bad(day, schedule), day).otherwise(start)
    return F.concat(start, F.lit("_"), tx.pad_left(tx.strip(code.cast("string")), 2))


def meeting_days(year: Column, schedule: Column) -> Column:
    """Length of the meeting in days, both ends counted."""

    def date_of(month_group: int, y: Column) -> Column:
        parts = [F.regexp_extract(schedule, SCHEDULE, g) for g in (month_group, month_group + 1)]
        text = F.concat_ws("-", y.cast("string"), tx.pad_left(parts[0], 2), tx.pad_left(parts[1], 2))
        return F.when(schedule.rlike(SCHEDULE), text.try_cast("date"))

    start = date_of(1, year)
    end = date_of(3, year)
    end = F.when(start > end, date_of(3, year + 1)).otherwise(end)
    return (F.datediff(end, start) + 1).cast("long")


def meeting_day(day: Column, length: Column) -> Column:
    """初日 is 1, 最終日 is the last day, else the digits in the text."""
    digits = F.regexp_replace(tx.half_width(day), "[^0-9]", "")
    return (
        F.when(day.contains("最終日"), length)
        .when(day.contains("初日"), F.lit(1).cast("long"))
        .otherwise(F.nullif(digits, F.lit("")).try_cast("long"))
    )


def race_id(day: Column, code: Column, number: Column) -> Column:
    return F.concat(
        tx.compact_day(day), tx.pad_left(code.cast("string"), 2), tx.pad_left(number.cast("string"), 2)
    )


def snapshot_id(day: Column, code: Column) -> Column:
    return F.concat(tx.compact_day(day), F.lit("_"), tx.pad_left(code.cast("string"), 2))


def venue_number(name: Column) -> Column:
    """Venue name to its code; unknown names are null."""
    listed = F.array(*[F.lit(v) for v in VENUES])
    return F.nullif(F.array_position(listed, name), F.lit(0)).cast("int")


def trick_label(c: Column) -> Column:
    """Exact match of one of the six winning tricks, else null."""
    t = tx.strip(c)
    out = F.lit(None).cast("string")
    for name, label in TRICKS.items():
        out = F.when(t == name, label).otherwise(out)
    return out


def stage_pattern(stages: str) -> str:
    """Regular expression for a comma list of stages. ``優勝戦`` is part of
    ``準優勝戦``, so finals alone also keeps semi-finals."""
    wanted = {s.strip().lower().replace("_", "-") for s in stages.split(",") if s.strip()}
    parts = [p for name, p in STAGES.items() if name in wanted]
    return f"({'|'.join(parts)})" if parts else ""


def grade(classes: Column) -> Column:
    """Race grade from the CSS classes (array) of the header cell."""

    def has(*names):
        out = F.lit(False)
        for n in names:
            out = out | F.array_contains(classes, n)
        return out

    return (
        F.when(has("is-SG"), "SG")
        .when(has("is-G1a", "is-G1b"), "G1")
        .when(has("is-G2a", "is-G2b"), "G2")
        .when(has("is-G3a", "is-G3b"), "G3")
        .otherwise("一般")
    )


def day_part(classes: Column) -> Column:
    return (
        F.when(F.array_contains(classes, "is-morning"), "モーニング")
        .when(F.array_contains(classes, "is-nighter"), "ナイター")
        .when(F.array_contains(classes, "is-summer"), "サマータイム")
        .otherwise("通常")
    )


def series(classes: Column, general: Column, grade_name: Column) -> Column:
    return (
        F.when(F.array_contains(classes, "is-venus"), "ヴィーナスシリーズ")
        .when(F.array_contains(classes, "is-lady"), "オールレディース")
        .when(F.array_contains(classes, "is-rookie"), "ルーキーシリーズ")
        .when(general, "一般")
        .when(grade_name.isin("SG", "G1", "G2", "G3"), grade_name)
        .otherwise("")
    )


def css_suffix(classes: Column, missing: str) -> Column:
    """First ``is-`` class without its prefix."""
    marked = F.filter(classes, lambda x: F.startswith(x, F.lit("is-")))
    return F.coalesce(F.substring(F.get(marked, 0), 4, 1000), F.lit(missing))


def prediction_mark(icon: Column) -> Column:
    """Icon 1..4 becomes 4..1; anything else 0."""
    n = tx.to_whole(icon)
    return F.when(n.between(1, 4), 5 - n).otherwise(F.lit(0)).cast("long")


# Trailing words of a race title.
FIXED_ENTRY, STABILISER, DISTANCES = "進入固定", "安定板使用", ["1800m", "1200m"]


def race_title(title: Column) -> Column:
    """Struct (race_name, precondition_1, precondition_2) from the title words."""
    words = F.regexp_extract_all(title, F.lit(r"([\p{L}\p{N}_]+)"), 1)

    def from_end(k: int) -> Column:
        return F.coalesce(F.try_element_at(words, F.lit(-k)), F.lit(""))

    last, before = from_end(1), from_end(2)
    both = (last == STABILISER) & (before == FIXED_ENTRY)
    name = (
        F.when(last.isin(DISTANCES), before)
        .when(last == FIXED_ENTRY, from_end(3))
        .when(both, from_end(4))
        .when(last == STABILISER, from_end(3))
        .otherwise("")
    )
    first = F.when((last == FIXED_ENTRY) | both, FIXED_ENTRY).otherwise("")
    second = F.when(last == STABILISER, STABILISER).otherwise("")
    return F.struct(name.alias("race_name"), first.alias("precondition_1"), second.alias("precondition_2"))
