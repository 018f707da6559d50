"""Rule-based ticket ranking from lane probabilities.

A lane 2..6 that is strong against lane 1 is an attacker. Each attacker gives a
fixed set of first/second patterns with a prior; a ticket's score is the prior
times a weight of its first two lanes, with a small share of the third. A race has few
tickets, so they are listed, compared and cut inside its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.functions.scoring import clip

TINY = 1e-9
PAIRS = "array<struct<i:int,j:int,prior:double,tag:string>>"
# Fixed values of the rule set.
FIRST_POWER, SECOND_POWER, THIRD_WEIGHT = 0.85, 0.65, 0.08
LANE_BONUS = {3: 1.02, 4: 1.05}
REVERSE_GATES = {
    "normal": (0.90, 0.75),
    "semi": (0.82, 0.78),
    "final": (0.82, 0.78),
    "graded": (0.82, 0.78),
}
PATTERNS = {
    "inside": (1.00, "成功/差し"),
    "neighbour": (0.95, "成功/右隣同道"),
    "reverse": (None, "成功/右隣同道(逆転)"),
    "preferred": (0.90, "成功/総括"),
    "stay": (0.85, "裏スジ/1残り右隣"),
    "cover": (0.75, "裏スジ/保険"),
}


def lane_arrays(
    df: DataFrame, race: str, lane: str, prob: str, ability: str | None = None, level: Column | None = None
) -> DataFrame:
    """One row per race with lane values as a six-element array, and the race's
    level. Missing lanes are 0. Six conditional buffers per race, whatever the race holds."""

    def packed(col: str) -> Column:
        return F.array(
            *[F.coalesce(F.max(F.when(F.col(lane) == k, F.col(col))), F.lit(0.0)).cast("double") for k in range(1, 7)]
        )

    cols = [packed(prob).alias("p")]
    if ability:
        cols.append(packed(ability).alias("raw"))
    if level is not None:
        cols.append(F.max(level).alias("level"))
    out = df.groupBy(race).agg(*cols)
    if level is None:
        out = out.withColumn("level", F.lit("normal"))
    if not ability:
        return out.withColumn("a", F.lit(None).cast("array<double>"))
    best = F.array_max("raw")
    scaled = F.transform(
        "raw", lambda x: F.when(best <= 1.5, x).when(best == 0, F.lit(0.0)).otherwise(x / best)
    )
    return out.withColumn("a", scaled).drop("raw")


def _ratio(values: Column, lane: Column, neighbour: Column) -> Column:
    return F.element_at(values, neighbour) / F.greatest(F.element_at(values, lane), F.lit(TINY))


def attackers(races: DataFrame, race: str, most: int = 2, threshold: float = 0.20) -> DataFrame:
    """(race, attacker, n_attackers): lanes 2..6 whose score passes the threshold,
    the best ``most`` of them."""
    listed = races.withColumn("__best", _best_lanes(most, threshold))
    return listed.select(race, "p", "a", "level", F.size("__best").alias("n_attackers"), F.explode("__best").alias("att"))


def _best_lanes(most: int, threshold: float) -> Column:
    """Array of the attacking lanes, the best one first."""
    p, b1 = F.col("p"), F.element_at("p", 1)
    damp = F.when(b1 > 0.70, F.greatest(F.lit(0.0), 1 - (b1 - 0.70))).otherwise(F.lit(1.0))
    scored = []
    for k in range(2, 7):
        lane, nb = F.lit(k), F.lit(min(k + 1, 6))
        s = F.element_at(p, k) * (1 + F.greatest(F.lit(0.0), 0.6 - b1)) * F.lit(LANE_BONUS.get(k, 1.0))
        s = s * (1 + 0.2 * clip(_ratio(p, lane, nb), 0, 1))
        with_ability = s * (1 + 0.10 * clip(_ratio(F.col("a"), lane, nb), 0, 1))
        s = F.when(F.col("a").isNull(), s).otherwise(with_ability) * damp
        scored.append(F.struct(s.alias("s"), F.lit(-k).alias("neg")))
    limit = F.lit(float(threshold)) + F.greatest(F.lit(0.0), b1 - 0.70)
    passed = F.filter(F.array(*scored), lambda x: x["s"] >= limit)
    return F.transform(F.slice(F.sort_array(passed, asc=False), 1, most), lambda x: -x["neg"])


def _gate(position: int) -> Column:
    """Gate values of the row's level; an unknown level counts as normal."""
    known = F.create_map(*[F.lit(x) for name, gates in REVERSE_GATES.items() for x in (name, gates[position])])
    return F.coalesce(F.try_element_at(known, F.col("level")), F.lit(REVERSE_GATES["normal"][position]))


def _patterns(att: Column, exacta: bool) -> Column:
    """Array of (first, second, prior, tag) for an attacker of the row; patterns
    that do not apply are dropped."""
    p = F.col("p")
    nb = F.least(att + 1, F.lit(6))
    one = F.lit(1)
    alt = F.greatest(att - 1, F.lit(2))
    preferred = F.when(F.element_at(p, 1) >= 0.95 * F.element_at(p, nb), one).otherwise(nb)
    signal = F.when(F.col("a").isNull(), _ratio(p, att, nb)).otherwise(_ratio(F.col("a"), att, nb))
    gate, weak = _gate(0), _gate(1)
    need = F.when(att == 3, gate - 0.02).otherwise(gate)
    reverse_prior = 0.80 + 0.10 * clip((signal - 0.70) / 0.30, 0, 1)
    has_nb = nb != att
    lanes = {
        "inside": (att, one, F.lit(True)),
        "neighbour": (att, nb, has_nb),
        "reverse": (nb, att, has_nb & (signal >= need) & (F.element_at(p, 1) < weak)),
        "preferred": (att, preferred, (preferred != att) if not exacta else F.lit(False)),
        "stay": (one, nb, F.lit(True)),
        "cover": (one, alt, F.lit(True)),
    }
    rows = []
    for name, (first, second, applies) in lanes.items():
        prior, tag = PATTERNS[name]
        if exacta:
            tag = tag.replace(")", ",2連)") if tag.endswith(")") else f"{tag}(2連)"
        value = reverse_prior if prior is None else F.lit(prior)
        row = F.struct(
            first.cast("int").alias("i"), second.cast("int").alias("j"),
            value.cast("double").alias("prior"), F.lit(tag).alias("tag"),
        )
        rows.append(F.when(applies, row))
    return F.array_compact(F.array(*rows))


def _floor(lane: Column) -> Column:
    return F.greatest(F.element_at("p", lane), F.lit(TINY))


def rank_tickets(
    df: DataFrame, race: str, lane: str, prob: str, ability: str | None = None,
    per_attacker: int = 10, most: int = 2, threshold: float = 0.20, level: str | Column = "normal",
) -> DataFrame:
    """(race, ticket ``i-j-k``, score, tag): best score per ticket, at most
    ``per_attacker`` tickets for each attacker of the race. ``level`` is one name
    for all races or a column of the rows, so that races of several levels are
    ranked together."""
    return _rank(df, race, lane, prob, ability, per_attacker, most, threshold, level, exacta=False)


def rank_exactas(
    df: DataFrame, race: str, lane: str, prob: str, ability: str | None = None,
    most: int = 2, threshold: float = 0.20, level: str | Column = "normal",
) -> DataFrame:
    """First-two form: tickets ``i-j-0``, at most six per attacker."""
    return _rank(df, race, lane, prob, ability, 6, most, threshold, level, exacta=True)


def _rank(df, race, lane, prob, ability, per_attacker, most, threshold, level, exacta) -> DataFrame:
    races = lane_arrays(df, race, lane, prob, ability, None if isinstance(level, str) else level)
    if isinstance(level, str):
        races = races.withColumn("level", F.lit(level))
    races = races.withColumn("__best", _best_lanes(most, threshold)).where(F.size("__best") > 0)
    none = F.array().cast(PAIRS)
    each = [F.when(F.size("__best") > n, _patterns(F.get("__best", F.lit(n)), exacta).cast(PAIRS)).otherwise(none) for n in range(most)]
    # of one first and second lane the greatest prior counts, as a ticket's weights are the same whatever its pattern
    races = races.withColumn("__t", F.array_sort(F.concat(*each)))
    last = F.filter("__t", lambda x, n: (n == F.size("__t") - 1) | (F.get("__t", n + 1)["i"] != x["i"]) | (F.get("__t", n + 1)["j"] != x["j"]))
    races = races.withColumn("__t", last)

    def core(t: Column) -> Column:
        return F.pow(_floor(t["i"]), FIRST_POWER) * F.pow(_floor(t["j"]), SECOND_POWER)

    def ticket(t: Column, third: Column, score: Column) -> Column:
        name = F.concat_ws("-", t["i"].cast("string"), t["j"].cast("string"), third.cast("string"))
        return F.struct((-score).alias("worth"), name.alias("ticket"), score.alias("score"), t["tag"].alias("tag"))

    if exacta:
        listed = F.transform("__t", lambda t: ticket(t, F.lit(0), t["prior"] * core(t)))
    else:
        thirds = F.array(*[F.lit(x) for x in range(1, 7)])

        def filled(t: Column) -> Column:
            free = F.filter(thirds, lambda k: (k != t["i"]) & (k != t["j"]))
            return F.transform(free, lambda k: ticket(t, k, t["prior"] * (core(t) + THIRD_WEIGHT * _floor(k))))

        listed = F.flatten(F.transform("__t", filled))
    best = F.slice(F.sort_array(listed), F.lit(1), F.size("__best") * per_attacker)
    return races.select(race, F.explode(best).alias("t")).select(race, "t.ticket", "t.score", "t.tag")


def limit_by(df: DataFrame, group: str, order: Sequence[Column], limit: Column) -> DataFrame:
    """Top rows per race with a limit that is itself a column."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("__rn", rn).where(F.col("__rn") <= limit).drop("__rn")
