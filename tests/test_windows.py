"""Window edges, the hot-key path and leak freedom."""

import datetime as dt
import random
import statistics

import pytest
from tests.conftest import rows
from pyspark.sql import functions as F

from heatlane.operators import ordered, windows

D = dt.date


def test_history_counts_only_started_rows(spark):
    data = [("a", "x", i, s, f) for i, (s, f) in enumerate([(True, 1), (True, 0), (False, 0), (True, 1)])]
    data += [("a", None, 9, True, 1)]
    df = spark.createDataFrame(data, "p string, axis string, t int, started boolean, f1 int")
    out = windows.history_rates(df, "p", "axis", ["t"], "started", {"w": "f1"}, n=2)
    assert rows(out.where("axis is not null"), "t", "w_cnt_last2", "w_rate_last2") == [
        (0, 0, None), (1, 1, 1.0), (2, 2, 0.5), (3, 1, 0.0),
    ]
    assert rows(out.where("axis is null"), "w_cnt_last2", "w_rate_last2") == [(None, None)]


def test_history_mean_sd(spark):
    df = spark.createDataFrame([("a", "x", i, True, v) for i, v in enumerate([1.0, 2.0, None, 8.0])], "p string, axis string, t int, s boolean, v double")
    got = rows(windows.history_rates(df, "p", "axis", ["t"], "s", {}, "v", n=2).select("t", "st_mean_last2", F.round("st_std_last2", 4)))
    assert got == [(0, None, None), (1, 1.0, None), (2, 1.5, 0.7071), (3, 2.0, None)]


def test_own_result_does_not_leak(spark):
    data = [("a", "x", i, True, i % 2) for i in range(8)]
    changed = [*data[:-1], ("a", "x", 7, False, 1)]
    schema = "p string, axis string, t int, started boolean, f1 int"
    one, two = (
        windows.history_rates(spark.createDataFrame(d, schema), "p", "axis", ["t"], "started", {"w": "f1"}, n=3)
        for d in (data, changed)
    )
    assert rows(one, "t", "w_cnt_last3", "w_rate_last3") == rows(two, "t", "w_cnt_last3", "w_rate_last3")


def test_prev_needs_all_n(spark):
    df = spark.createDataFrame([("m", i, float(i)) for i in (1, 2, 3, 4)], "k string, t int, v double")
    out = windows.prev_features(df, "k", ["t"], ["v"], ["v"], ns=(3,))
    assert rows(out, "t", "prev1_v", "prev3_sum_v", "prev3_mean_v", "delta_1_3_v") == [
        (1, None, None, None, None), (2, 1.0, None, None, None), (3, 2.0, None, None, None), (4, 3.0, 6.0, 2.0, 1.0),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one key is null, the rest are small."""
    rng = random.Random(1)
    data = [("hot", i, float(rng.randrange(50))) for i in range(600)]
    data += [(f"k{i % 40}", 1000 + i, float(rng.randrange(50))) for i in range(300)]
    data += [(None, 5000 + i, 1.0) for i in range(100)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, t long, v double").repartition(7)


@pytest.mark.parametrize("n", [1, 4, 25])
def test_over_previous_hot_equals_plain(skewed, n):
    builders = {"s": lambda w: F.sum("v").over(w), "c": lambda w: F.count("v").over(w)}
    plain = ordered.over_previous(skewed, ["k"], ["t"], n, builders)
    hot = ordered.over_previous(skewed, ["k"], ["t"], n, builders, split_rows=20)
    assert rows(plain, "k", "t", "s", "c") == rows(hot, "k", "t", "s", "c")


def test_over_previous_without_key(skewed):
    builders = {"s": lambda w: F.sum("v").over(w)}
    plain = ordered.over_previous(skewed, [], ["t"], 3, builders)
    hot = ordered.over_previous(skewed, [], ["t"], 3, builders, split_rows=50)
    assert rows(plain, "t", "s") == rows(hot, "t", "s")


def test_totals_before_hot_equals_plain(skewed):
    sums = {"a": F.col("v"), "n": F.lit(1)}
    plain = ordered.totals_before(skewed, ["k"], ["t"], sums)
    hot = ordered.totals_before(skewed, ["k"], ["t"], sums, split_rows=20)
    assert rows(plain, "k", "t", "a", "n") == rows(hot, "k", "t", "a", "n")


def test_totals_over_chunks_shuffle_no_row_for_offsets(spark, monkeypatch):
    """Many hot keys: rows are marked in one pass, and offsets of the few keys of several chunks are broadcast."""
    monkeypatch.setattr(ordered, "MAX_BROADCAST", 40)
    writes, whole = {}, ordered.durable
    monkeypatch.setattr(ordered, "durable", lambda df, label="stage": writes.setdefault(label, whole(df, label)))
    df = spark.range(3000).select("id", F.when(F.col("id") % 101 > 0, F.floor(F.col("id") / 30)).alias("k"))
    got = ordered.totals_before(df, ["k"], ["id"], {"n": F.lit(1).cast("long"), "s": F.col("id")}, (10, 200))
    assert writes["heat"].count() == 3000 and 0 < writes["going"].count() <= 15
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    plain = ordered.totals_before(df, ["k"], ["id"], {"n": F.lit(1).cast("long"), "s": F.col("id")})
    assert rows(got) == rows(plain)


def test_numbered_is_dense(skewed):
    got = [r["i"] for r in ordered.numbered(skewed, [], ["t"], "i", split_rows=60).orderBy("t").collect()]
    assert got == list(range(1, 1001))


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 1.0])
def test_quantile_hot_equals_builtin(skewed, q):
    want = skewed.where("k is not null").groupBy("k").agg(F.percentile("v", F.lit(q)).alias("x"))
    for split in (ordered.SPLIT_ROWS, 15):
        got = ordered.quantile_exact(skewed.where("k is not null"), ["k"], "v", q, "x", split)
        assert rows(got, "k", "x") == rows(want, "k", "x")


@pytest.mark.parametrize("null_share", [0, 3])
def test_median_before_brute_force(skewed, null_share):
    v = F.when(F.col("t") % 5 >= null_share, F.col("v") * 7 + F.col("t") % 3) if null_share else F.col("v") * 7 + F.col("t") % 3
    df = skewed.where("k is not null").withColumn("v", v)
    want = {}
    for key in ("hot", "k1"):
        seen = []
        for r in df.where(F.col("k") == key).orderBy("t").collect():
            want[key, r["t"]] = statistics.median(seen) if seen else None
            if r["v"] is not None:
                seen.append(r["v"])
    for split in (ordered.SPLIT_ROWS, (100, 120)):
        got = ordered.median_before(df, ["k"], ["t"], "v", "m", split)
        assert got.count() == 900
        assert {(r["k"], r["t"]): r["m"] for r in got.where("k in ('hot', 'k1')").collect()} == want


def test_medians_along_brute_force():
    """The median before and after each value, ties and NaN included, given only what can be reached of the values before."""
    import numpy as np

    rng = np.random.default_rng(7)
    for n, m, spread in [(0, 0, 3), (0, 9, 3), (1, 1, 3), (500, 11, 4), (500, 11, 10**6), (40, 90, 7)]:
        held, x = np.sort(rng.integers(0, spread, n) / 7), rng.integers(0, spread, m) / 7
        if m > 8:
            x[3] = np.nan
        low, high = max(0, n // 2 - ordered._reach(m)), n // 2 + ordered._reach(m) + 1
        got = ordered.medians_along(x, held[low:high], low, n)
        for i in range(m + 1):
            some = np.sort(np.concatenate([held, x[:i]]))
            want = (some[(n + i - 1) // 2] + some[(n + i) // 2]) / 2 if n + i else np.nan
            assert got[i] == want or np.isnan(got[i]) and np.isnan(want)


@pytest.mark.parametrize("spread", [1, 5, 10**9])
def test_median_before_over_many_chunks(spark, spread):
    """Several keys over several chunks each, drifting values, ties, nulls and a row of NaN."""
    rng = random.Random(spread)
    data = [(i, "ab"[i % 2] if i % 7 else "c", None if i % 13 == 0 else float("nan") if i == 500 else float(i // 40 + rng.randrange(spread))) for i in range(3000)]
    got = ordered.median_before(spark.createDataFrame(data, "t int, k string, v double"), ["k"], ["t"], "v", "m", (100, 90))
    found, seen = {r["t"]: r["m"] for r in got.collect()}, {"a": [], "b": [], "c": []}
    assert len(found) == 3000
    for t, k, v in data:
        some = sorted(seen[k], key=lambda x: (x != x, x))
        n = len(some)
        assert found[t] == ((some[(n - 1) // 2] + some[n // 2]) / 2 if n else None)
        if v is not None:
            seen[k].append(v)


def test_running_median_moves_rows_as_often_whatever_the_values(spark, monkeypatch):
    writes, whole = [], ordered.durable
    monkeypatch.setattr(ordered, "durable", lambda df, label="stage": writes.append(label) or whole(df, label))
    for values in (3, 5000):
        df = spark.range(6000).select(F.lit(1).alias("k"), "id", (F.xxhash64("id") % values).alias("v"))
        assert ordered.median_before(df, ["k"], ["id"], "v", "m", (1000, 2000)).count() == 6000
        writes.append("|")
    few, many = "".join(f"{w} " for w in writes).split("|")[:2]
    assert few.split() == many.split()


def test_hot_partitions_stay_small(spark, skewed):
    pieces = ordered.chunked(skewed.where("k = 'hot'"), ["k"], ["t"], 600, 50)
    largest = pieces.groupBy("__chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 150


def test_ranks(spark):
    df = spark.createDataFrame([("r", 1, 6.7), ("r", 2, 6.7), ("r", 3, None), ("r", 4, 6.9)], "g string, l int, v double")
    assert rows(windows.rank_in_group(df, "g", "v", "k"), "l", "k") == [(1, 1), (2, 1), (3, None), (4, 3)]
    assert rows(windows.rank_in_group(df, "g", "v", "k", nulls="last"), "l", "k") == [(1, 1), (2, 1), (3, 4), (4, 3)]
    flags = windows.top_flags(windows.rank_in_group(df, "g", "v", "k"), "k")
    assert rows(flags, "l", "top1", "top2") == [(1, 1, 1), (2, 1, 1), (3, 0, 0), (4, 0, 0)]


def test_time_split_counts_races(spark):
    df = spark.createDataFrame([(f"r{i:02d}", i, b) for i in range(11) for b in range(2)], "race string, t int, b int")
    out = windows.split_by_first_seen(df, "race", ["t"])
    parts = {r["race"]: r["part"] for r in out.collect()}
    assert sorted(k for k, v in parts.items() if v == "train") == [f"r{i:02d}" for i in range(8)]
    assert windows.split_by_first_seen(df, "race", ["t"], split_rows=4).where("part = 'valid'").count() == 6


def test_append_targets(spark):
    hist = spark.createDataFrame([(1, "a", True)], "race int, p string, started boolean")
    new = spark.createDataFrame([(1, "a"), (2, "a")], "race int, p string")
    out = windows.append_targets(hist, new, ["race", "p"], "started")
    assert rows(out, "race", "started", "is_target") == [(1, True, False), (2, False, True)]


def test_keep_first_last_and_limit(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k string, t int, v string")
    assert rows(windows.keep_first(df, ["k"], ["t"]), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(windows.keep_last(df, ["k"], ["t"]), "k", "v") == [("a", "y"), ("b", "z")]
    assert windows.sequence_by(df, ["t"]).orderBy("t").first()["seq"] == 1


def test_chunks_do_not_grow_without_bound():
    assert ordered.chunk_count(600, 50) == 12
    assert ordered.chunk_count(36_000_000, (10, 4000)) == ordered.MAX_CHUNKS
    assert ordered.chunk_count(4_000_000_000, 4000) == 1000  # a chunk never holds more than SPLIT_ROWS


def test_long_lists_are_not_broadcast(spark, capsys):
    few = spark.range(9)
    few.join(ordered.listed(spark.range(9), ordered.MAX_BROADCAST + 1), "id").explain()
    assert "Broadcast" not in capsys.readouterr().out
