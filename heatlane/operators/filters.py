"""Row and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.operators.windows import keep_first

# Columns that identify a row, and columns known only after the race.
ID_COLUMNS = ["race_id", "player_id", "player", "motor_id", "motor_number", "boat_number", "section_id"]
LEAK_COLUMNS = [
    "rank", "entry", "ST", "ST_rank", "winning_trick", "remarks",
    "finish1_flag_cur", "finish2_flag_cur", "finish3_flag_cur",
]
HEAVY_TEXT = ["title", "schedule", "timetable", "weather", "place", "origin", "propeller", "parts_exchange"]


def filter_period(df: DataFrame, day: str, start=None, end=None) -> DataFrame:
    """Keep days in [start, end]; either side may be open."""
    out = df
    if start is not None:
        out = out.where(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col(day) <= F.lit(end).cast("date"))
    return out


def filter_with_warmup(df: DataFrame, day: str, start, end, days: int = 180) -> DataFrame:
    """Keep [start - days, end]: enough past for history features, no future."""
    first = F.date_sub(F.lit(start).cast("date"), days)
    return df.where((F.col(day) >= first) & (F.col(day) <= F.lit(end).cast("date")))


def group_reasons(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """One row per (group, rule) that any row of the group breaks."""
    flags = df.groupBy(key).agg(
        *[F.bool_or(F.coalesce(cond, F.lit(False))).alias(f"__{name}") for name, cond in rules.items()]
    )
    named = F.array(*[F.when(F.col(f"__{name}"), F.lit(name)) for name in rules])
    return (
        flags.where(F.col(key).isNotNull())
        .select(key, F.explode(F.array_compact(named)).alias("rule_key"))
    )


def over_group(df: DataFrame, key: str) -> WindowSpec:
    """All rows of a group, for groups that are small by their meaning, such as the boats of a race.
    Rows without a key form no group and are spread by their values."""
    values = [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return Window.partitionBy(key, F.when(F.col(key).isNull(), F.xxhash64(*values)))


def drop_groups(df: DataFrame, key: str, bad: Column, small: bool = True) -> DataFrame:
    """Drop every group in which some row satisfies ``bad``; rows without a key stay.

    Small groups (``small``), such as races, are flagged by a window: ``df`` is planned once, and a partitioning
    by the key is used again. For groups that may be large the bad keys are listed, one row per
    group and task in the shuffle, and the anti join is left to adaptive execution.
    """
    if small:
        flag = F.bool_or(F.coalesce(bad, F.lit(False))).over(over_group(df, key))
        return df.withColumn("__bad", flag).where(F.col(key).isNull() | ~F.col("__bad")).drop("__bad")
    listed = df.where(bad).select(key).distinct()
    return df.join(listed, key, "left_anti")


def drop_bad_groups(df: DataFrame, key: str, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, reasons): a group goes when any of its rows breaks any rule."""
    bad = F.lit(False)
    for cond in rules.values():
        bad = bad | F.coalesce(cond, F.lit(False))
    return drop_groups(df, key, bad), group_reasons(df, key, rules)


def drop_void_groups(df: DataFrame, key: str, cls: str = "rank_class") -> DataFrame:
    return drop_groups(df, key, F.col(cls) == "void")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def drop_void_rows(df: DataFrame, cls: str = "rank_class") -> DataFrame:
    """Rows without a class stay."""
    return df.where(F.coalesce(F.col(cls), F.lit("")) != "void")


def filter_places(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose listed columns all lie in 1..6."""
    out = df
    for c in cols:
        out = out.where(F.col(c).between(1, 6))
    return out


def filter_tricks(df: DataFrame, col: str, label: str = "trick") -> DataFrame:
    return df.withColumn(label, tk.trick_label(F.col(col))).where(F.col(label).isNotNull())


def filter_stage(df: DataFrame, col: str, stages: str = "finals,semi,semi-entry") -> DataFrame:
    pattern = tk.stage_pattern(stages)
    return df.where(F.col(col).rlike(pattern)) if pattern else df


def filter_keywords(df: DataFrame, col: str, words: Sequence[str]) -> DataFrame:
    """Keep rows whose text contains any of the words."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(F.col(col), F.lit(w))
    return df.where(hit)


def filter_positive(df: DataFrame, *cols: str) -> DataFrame:
    out = df
    for c in cols:
        out = out.where(F.col(c) > 0)
    return out


def complete_groups(df: DataFrame, key: str, member: str, size: int = 6) -> DataFrame:
    """Keep groups with exactly ``size`` non-null members, in one scan; groups are small, as in ``drop_groups``."""
    found = F.count(member).over(over_group(df, key))
    return df.withColumn("__m", found).where(F.col(key).isNotNull() & (F.col("__m") == size)).drop("__m")


def keep_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def keep_not_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_anti")


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def drop_columns(df: DataFrame, *lists: Sequence[str]) -> DataFrame:
    return df.drop(*[c for cols in lists for c in cols if c in df.columns])


def take_prefixed(df: DataFrame, keys: Sequence[str], prefixes: Sequence[str], prefix: str = "") -> DataFrame:
    """Keys plus the columns with one of the prefixes, renamed ``prefix + name``."""
    wanted = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in wanted])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones null, extra ones dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def ensure_columns(df: DataFrame, cols: Sequence[str], kind: str = "double") -> DataFrame:
    missing = {c: F.lit(None).cast(kind) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def require_columns(df: DataFrame, cols: Sequence[str], name: str = "table") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    return df


def require_no_nulls(df: DataFrame, cols: Sequence[str], name: str = "table") -> DataFrame:
    """Raise with a few examples when a key column holds a null."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    sample = df.where(bad).select(*cols).limit(10).collect()
    if sample:
        raise ValueError(f"{name}: null keys in {list(cols)}, e.g. {sample}")
    return df


def fill_from(df: DataFrame, col: str, fallback: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.col(fallback)))


def fill_neutral(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """Listed columns as DOUBLE with nulls, bad text and missing columns set to ``value``."""
    out = ensure_columns(df, cols)
    return out.withColumns({c: F.coalesce(tx.to_number(F.col(c)), F.lit(value)) for c in cols})


def keys_and_numbers(df: DataFrame, keys: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Key columns plus numeric columns: what a prior contributes to a join."""
    numeric = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in keys and f.name not in drop
    ]
    return df.select(*keys, *numeric)


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column with its exact number of distinct values.

    Goes through (column, value) pairs, so no task holds the distinct values of
    a whole column.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("p")
    ).select("p.*")
    return pairs.distinct().groupBy("column").agg(F.count("value").alias("n_distinct"))


def select_features(
    df: DataFrame,
    use: Sequence[str] = (),
    add: Sequence[str] = (),
    drop: Sequence[str] = (),
    max_categories: int = 50,
    allow_missing: bool = False,
    force_drop: Sequence[str] = (),
) -> list[str]:
    """Names of the model inputs.

    ``use`` if given, else numeric columns and text columns with few distinct
    values; then minus ``drop``, plus ``add``; ``force_drop`` always wins.
    """
    frame = drop_columns(df, ID_COLUMNS, LEAK_COLUMNS)
    if use:
        chosen = list(dict.fromkeys(use))
    else:
        numeric = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.NumericType)]
        texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
        few = []
        if texts:
            # one row per text column: bounded by the schema
            counts = distinct_counts(frame, texts).where(F.col("n_distinct") <= max_categories)
            few = [r["column"] for r in counts.collect()]
        chosen = sorted(set(numeric + few) - set(HEAVY_TEXT))
    chosen = [c for c in chosen if c not in set(drop)]
    chosen += [c for c in add if c not in chosen]
    missing = [c for c in chosen if c not in frame.columns]
    if missing and not allow_missing:
        raise ValueError(f"selected columns are missing: {missing}")
    return [c for c in chosen if c in frame.columns and c not in set(force_drop)]


def due_jobs(
    timeline: DataFrame, now: Column, minutes: int, deadline: str = "deadline_dt",
    keys: Sequence[str] = ("seq", "jcd", "rno"),
) -> DataFrame:
    """Jobs whose run time (deadline - minutes) has not passed, one per key."""
    run_at = F.col(deadline) - F.make_dt_interval(mins=F.lit(minutes))
    jobs = timeline.where(F.col(deadline).isNotNull()).withColumn("run_at", run_at).where(F.col("run_at") >= now)
    return keep_first(jobs, keys, ["run_at"])
