"""Points from entry and rank history strings, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.functions import text as tx

LANES = range(1, 7)

# Points for finishing first to sixth.
SCORES = [10, 8, 6, 4, 2, 1]


# Ranking points, by entry lane (rows 1 to 6) and place (columns 1 to 6).
RANKING_POINTS = [
    [0, -1, -2, -3, -4, -5],
    [1, 0, -1, -2, -3, -4],
    [2, 1, 0, -1, -2, -3],
    [3, 2, 1, 0, -1, -2],
    [4, 3, 2, 1, 0, -1],
    [5, 4, 3, 2, 1, 0],
]

# Condition points, laid out alike.
CONDITION_POINTS = [
    [2, -1, -2, -3, -4, -5],
    [1, 1, -1, -2, -3, -4],
    [2, 1, 1, -1, -2, -3],
    [3, 2, 1, 0, -1, -2],
    [4, 3, 2, 1, 0, -1],
    [5, 4, 3, 2, 1, -1],
]


def ranking_points(entry: int, place: int) -> int:
    return RANKING_POINTS[entry - 1][place - 1]


def condition_points(entry: int, place: int) -> int:
    return CONDITION_POINTS[entry - 1][place - 1]


def point_rows() -> list[tuple[int, int, int, int]]:
    return [(e, r, ranking_points(e, r), condition_points(e, r)) for e in LANES for r in LANES]


def point_table(spark: SparkSession) -> DataFrame:
    """36 rows: entry, rank_num, ranking_point, condition_point."""
    return spark.createDataFrame(
        point_rows(), "entry long, rank_num long, ranking_point long, condition_point long"
    )


def _flat(kind: str) -> Column:
    """The 36 values as an array; position = (entry - 1) * 6 + place."""
    at = {"ranking": 2, "condition": 3}[kind]
    return F.array(*[F.lit(row[at]) for row in point_rows()])


def point_for(entry: Column, place: Column, kind: str) -> Column:
    ok = entry.between(1, 6) & place.between(1, 6)
    index = ((entry - 1) * 6 + place).cast("int")
    return F.when(ok, F.element_at(_flat(kind), F.when(ok, index).otherwise(1))).otherwise(0)


def zip_points(entries: Column, ranks: Column, kind: str) -> Column:
    """Zip two history strings character by character and map to points.

    The shorter string decides the length, a non-digit entry is skipped, a
    non-digit rank counts 0.
    """
    e, r = F.coalesce(entries, F.lit("")), F.coalesce(ranks, F.lit(""))
    size = F.least(F.length(e), F.length(r))
    positions = F.when(size > 0, F.sequence(F.lit(1), F.greatest(size, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )
    pairs = F.transform(positions, lambda i: F.struct(e.substr(i, F.lit(1)).alias("e"), r.substr(i, F.lit(1)).alias("r")))
    kept = F.filter(pairs, lambda p: p["e"].rlike("^[0-9]$"))
    return F.transform(
        kept,
        lambda p: F.when(
            p["r"].rlike("^[0-9]$"),
            point_for(p["e"].try_cast("int"), p["r"].try_cast("int"), kind),
        ).otherwise(0),
    )


def array_total(points: Column) -> Column:
    return F.aggregate(points, F.lit(0).cast("long"), lambda a, x: a + x)


def joined(points: Column) -> Column:
    return F.array_join(F.transform(points, lambda x: x.cast("string")), " ")


def finish_score(place: Column) -> Column:
    """10, 8, 6, 4, 2, 1 for places 1..6, else 0."""
    p = place.cast("int")
    table = F.array(*[F.lit(s) for s in SCORES])
    ok = p.between(1, 6)
    return F.when(ok, F.element_at(table, F.when(ok, p).otherwise(1))).otherwise(0).cast("long")


def start_mean_of(cells: Column, runs: Column) -> Column:
    """Mean of start-time cells; each gets a leading 0 and unparsable ones count 0."""
    values = F.transform(
        cells, lambda x: F.coalesce(tx.to_number(F.concat(F.lit("0"), x)), F.lit(0.0))
    )
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), runs.cast("double"))


def start_texts(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda x: F.concat(F.lit("0"), x)), "")


def previous_start(cells: Column) -> Column:
    """Last four characters of the joined cells."""
    return F.right(start_texts(cells), F.lit(4))


def previous_start_number(text: Column) -> Column:
    """``0.`` plus the last two characters."""
    return tx.to_number(F.concat(F.lit("0."), F.right(F.coalesce(text, F.lit("")), F.lit(2))))


def runs_clipped(runs: Column, most: int = 6) -> Column:
    return F.least(tx.to_number(runs), F.lit(float(most)))


def add_history_points(df: DataFrame, entries="entry_history", ranks="rank_history", runs="race_ct_current") -> DataFrame:
    """Point strings, sums and rates of the current meeting, both kinds."""
    out = df
    for kind in ("ranking", "condition"):
        points = zip_points(F.col(entries), F.col(ranks), kind)
        out = (
            out.withColumn(f"{kind}_point_list", points)
            .withColumn(f"{kind}_point", joined(F.col(f"{kind}_point_list")))
            .withColumn(f"{kind}_point_sum", array_total(F.col(f"{kind}_point_list")))
            .withColumn(
                f"{kind}_point_rate",
                F.try_divide(F.col(f"{kind}_point_sum").cast("double"), F.col(runs).cast("double")),
            )
            .drop(f"{kind}_point_list")
        )
    return out
