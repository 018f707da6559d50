"""Preprocessing, metrics, folds, search and stacking."""

import math

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from heatlane.ml import boosting, metrics, preprocess, training
from heatlane.operators import windows
from tests.conftest import rows


@pytest.fixture(scope="module")
def table(spark):
    data = [(i // 6, i % 6, float(i % 6), float(i % 7), "ab"[i % 2], int(i % 6 < 2 or i % 11 == 0)) for i in range(600)]
    df = spark.createDataFrame(data, "race int, lane int, x double, z double, c string, y int")
    return windows.split_by_first_seen(df, "race", ["race"]).repartition(4).cache()


def test_fit_rules(spark):
    df = spark.createDataFrame([(1.0, None, "b", 5.0), (2.0, 0.5, "a", 5.0), (None, 1.0, None, 5.0), (9.0, None, "c", 5.0)], "n double, adv_p1 double, c string, k double")
    p = preprocess.fit(df, ["n", "adv_p1", "k"], ["c"])
    assert p.fill == {"n": 2.0, "adv_p1": 0.0, "k": 5.0}
    assert p.scale["k"] == 1.0 and p.mode["c"] == "a"  # zero variance; tie goes to the smallest
    assert p.scale["n"] == pytest.approx(math.sqrt(((1 - 3.5) ** 2 + 2 * (2 - 3.5) ** 2 + (9 - 3.5) ** 2) / 4))
    assert p.names == ["n", "adv_p1", "k", "c_a", "c_b", "c_c"]
    unseen = p.transform(spark.createDataFrame([(2.0, None, "zzz", 5.0)], df.schema)).first()
    assert (unseen["c_a"], unseen["c_b"], unseen["c_c"]) == (0.0, 0.0, 0.0)
    assert len(p.vector(df).first()["features"]) == 6


def brute(y, p):
    pos = [b for a, b in zip(y, p) if a]
    neg = [b for a, b in zip(y, p) if not a]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, prev = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(1 for a, b in zip(y, p) if b >= t and a)
        recall = tp / len(pos)
        ap += (recall - prev) * tp / sum(1 for b in p if b >= t)
        prev = recall
    ll = -sum(math.log(b if a else 1 - b) for a, b in zip(y, p)) / len(y)
    return auc, ap, ll


@pytest.mark.parametrize("split", [10**6, 3])
def test_binary_metrics_brute_force(spark, split):
    y = [1, 0, 1, 1, 0, 0, 1, 0, 0, 1, 0, 0]
    p = [0.9, 0.8, 0.8, 0.4, 0.4, 0.1, 0.65, 0.65, 0.2, 0.2, 0.05, 0.3]
    got = metrics.binary_metrics(spark.createDataFrame(list(zip(y, p)), "y int, p double"), "y", "p", split).first()
    auc, ap, ll = brute(y, p)
    assert got["auc"] == pytest.approx(auc) and got["pr_auc"] == pytest.approx(ap) and got["logloss"] == pytest.approx(ll)
    assert got["accuracy"] == pytest.approx(8 / 12) and got["n"] == 12
    tp, fp, fn, tn = 3, 2, 2, 5
    assert got["mcc"] == pytest.approx((tp * tn - fp * fn) / math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))


def test_metrics_of_one_class_are_null_or_zero(spark):
    got = metrics.binary_metrics(spark.createDataFrame([(1, 0.9), (1, 1.0)], "y int, p double"), "y", "p").first()
    assert got["auc"] is None and got["mcc"] == 0.0 and got["accuracy"] == 1.0


def test_topk_skips_short_races(spark):
    df = spark.createDataFrame([("a", 1, 0, 0.9), ("a", 2, 1, 0.5), ("b", 1, 0, 0.9), ("b", 2, 0, 0.8), ("b", 3, 1, 0.1), ("c", 1, 1, 0.5)], "r string, l int, y int, p double")
    assert rows(metrics.topk_hit(df, "r", "y", "p", ["l"])) == [(0.5, 2)]


def test_folds_are_balanced(table):
    folds = training.stratified_folds(table, "y", ["race", "lane"])
    per = {}
    for r in folds.groupBy("y", "fold").count().collect():
        per.setdefault(r["y"], []).append(r["count"])
    assert all(len(v) == 5 and max(v) - min(v) <= 1 for v in per.values())
    again = training.stratified_folds(table.repartition(9), "y", ["race", "lane"], split_rows=50)
    assert rows(again, "race", "lane", "fold") == rows(folds, "race", "lane", "fold")


def make(params):
    return LogisticRegression(labelCol="y", regParam=float(params["reg_lambda"]), maxIter=20)


def test_train_search_and_adopt(spark, table):
    prepared = preprocess.fit(table.where("part = 'train'"), ["x", "z"], ["c"])
    ready = prepared.vector(table)
    model, got = training.train(ready, make({"reg_lambda": 0.0}), "race", "y", ["lane"])
    assert got["auc"] > 0.9 and got["top2_hit"] > 0.9 and got["n"] == 120
    trials = spark.createDataFrame(training.random_search(ready, make, "race", "y", ["lane"], 2, space={"reg_lambda": [0.0, 5.0]}))
    best = training.adopt(trials).first()
    assert best["logloss"] == trials.agg(F.min("logloss")).first()[0]
    none_good = training.adopt(trials, current_pr_auc=2.0).first()
    assert none_good["trial"] == best["trial"]
    assert training.rank_trials(trials, 1).count() == 1
    stab = metrics.seed_stability(trials, cols=["logloss"]).first()
    assert stab["logloss_std"] >= 0
    scored = training.score(model, ready, label="base")
    assert scored.select("model_label").first()[0] == "base" and "prediction" not in scored.columns
    rise = {r["feature"]: r["importance"] for r in training.permutation_importance(model, prepared, table, "y", ["x", "z"], ["race", "lane"], 2).collect()}
    assert rise["x"] > 0.1 and abs(rise["z"]) < rise["x"]


def test_boosted_trees(spark, table):
    prepared = preprocess.fit(table, ["x", "z"])
    ready = prepared.vector(table)
    est = training.boosted_trees({"n_estimators": 3, "num_leaves": 7, "colsample_bytree": 0.9, "min_child_samples": 5})
    assert est.getMaxDepth() == 3 and est.getMaxIter() == 3
    model = est.fit(ready)
    top = training.importances(model, prepared.names, spark).orderBy("rank").first()
    assert top["feature"] == "x" and top["rank"] == 1
    assert training.split_counts(model, prepared.names, spark).where("feature = 'x'").first()["n_splits"] > 0


def test_out_of_fold_and_stack(spark, table):
    ready = training.stratified_folds(preprocess.fit(table, ["x"]).vector(table), "y", ["race", "lane"], k=3)
    oof = training.out_of_fold(ready, make({"reg_lambda": 0.01}), k=3, name="p_base")
    assert oof.count() == table.count()
    both = oof.select("race", "lane", "y", "p_base", F.when(F.col("lane") > 2, F.col("p_base")).alias("p_sectional"), F.lit("finals").alias("stage"))
    contexts = {"stage": ["finals", "semi"]}
    model, names = training.stack(both, "y", contexts)
    assert names[-2:] == ["stage_finals", "stage_semi"]
    out = training.apply_stack(model, both.drop("stage"), names, contexts)
    assert out.where("p_meta between 0 and 1").count() == table.count()


def test_open_vocabulary(spark):
    """Codes and sparse vectors against the bounded fit; unseen values, nulls, no rows."""
    df = spark.createDataFrame([(1, 1.0, "b", "x"), (2, 3.0, "a", None), (3, None, None, "y"), (4, 9.0, "c", "x"), (5, 2.0, "a", "x")], "k int, n double, c string, d string")
    coded = preprocess.fit_open(df, ["n"], ["c", "d"], split_rows=2)
    assert coded.sizes == {"c": 3, "d": 2} and coded.mode == {"c": "a", "d": "x"}
    more = df.unionByName(spark.createDataFrame([(6, 1.0, "zz", "x")], df.schema))
    plain = preprocess.fit(df, ["n"], ["c", "d"])
    got = coded.vector(more)
    assert got.columns == [*more.columns, "features"]
    want = {r["k"]: r["features"].toArray().tolist() for r in plain.vector(more).collect()}
    assert {r["k"]: r["features"].toArray().tolist() for r in got.collect()} == want
    assert rows(coded.codes(more).where("k = 6"), "c_code", "d_code") == [(3.0, 0.0)]
    nothing = preprocess.fit_open(df.limit(0), ["n"], ["c"])
    assert nothing.sizes == {"c": 0} and nothing.vector(df).first()["features"].size == 1


def test_open_vocabulary_of_a_million(spark):
    """A model on a text column of 10^6 values: vectors stay sparse, one row a column reaches the driver."""
    big = spark.range(1_000_000).select(F.concat(F.lit("id"), "id").alias("who"), (F.col("id") % 2).alias("y"))
    coded = preprocess.fit_open(big, texts=["who"], split_rows=100_000)
    assert coded.sizes == {"who": 1_000_000}
    v = coded.vector(big.where("who in ('id7', 'id999999', 'id0')")).collect()
    assert all(r["features"].size == 1_000_000 and r["features"].numNonzeros() == 1 for r in v) and len(v) == 3


def test_cross_stack_keeps_both_levels_apart(spark):
    """Random labels and a column that names the row: a tree learns it by heart. Scores of rows a model has seen
    would make the stack sure of itself; nested scores keep its loss near that of a coin."""
    from pyspark.ml.classification import DecisionTreeClassifier

    n = 240
    data = [(i, float(i), float(i * 37 % n), (i * 7919 + i // 5) % 3 % 2, "ab"[i % 2]) for i in range(n)]
    df = spark.createDataFrame(data, "id int, a double, b double, y int, stage string")
    ready = preprocess.fit(df, ["b"]).vector(preprocess.fit(df, ["a"]).vector(df, "fa"), "fb")
    deep = [DecisionTreeClassifier(labelCol="y", featuresCol=f, maxDepth=12, maxBins=256) for f in ("fa", "fb")]
    out = training.cross_stack(ready, "y", *deep, ["id"], F.col("id") % 3 != 0, {"stage": ["a", "b"]}, k=2, inner=2)
    assert out.count() == n and out.where("is_sectional_missing = 1 and p_sectional = 0.5").count() == n // 3 and "__has" not in out.columns
    nested = metrics.binary_metrics(out, "y", "p_meta").first()
    folds = training.nested_folds(ready, "y", ["id"], 2, 2)
    assert all(r["n"] in range(n // 3 // 4 - 1, n) for r in folds.groupBy("y", "fold", "inner").agg(F.count("id").alias("n")).collect())
    seen, held = folds.where("fold = 0"), folds.where("fold = 1")

    def both(fitted, to_score):
        first = training.score(deep[0].fit(fitted), to_score, "p_base")
        return training.score(deep[1].fit(fitted), first, "p_sectional")

    model, names = training.stack(both(seen, seen), "y")  # the leak: the stack learns from scores of seen rows
    leaked = metrics.binary_metrics(training.apply_stack(model, both(seen, held), names), "y", "p_meta").first()
    assert nested["logloss"] < 0.9 < 1.2 < leaked["logloss"] and nested["auc"] < 0.7


def test_store_round_trip(spark, table, tmp_path):
    from heatlane.ml import store

    prepared = preprocess.fit(table, ["x", "z"], ["c"])
    store.save_prepared(spark, prepared, str(tmp_path / "p"))
    again = store.load_prepared(spark, str(tmp_path / "p"))
    assert again == prepared and again.names == prepared.names
    ready = prepared.vector(table)
    for name, est in (("lr", make({"reg_lambda": 0.1})), ("gbt", training.boosted_trees({"n_estimators": 2, "num_leaves": 7}))):
        model = est.fit(ready)
        store.save_model(model, str(tmp_path / name))
        loaded = store.load_model(spark, str(tmp_path / name))
        checks = store.same_scores(training.score(model, ready), training.score(loaded, again.vector(table)), ["race", "lane"])
        assert checks.where("equal and in_range").count() == table.count()


def test_search_space_and_seeds(spark, table):
    with pytest.raises(ValueError, match="reg_lambda"):
        training.boosted_trees({"reg_lambda": 1.0})
    assert training.boosted_trees({"num_leaves": 4095}).getMaxDepth() == 12
    ready = preprocess.fit(table, ["x", "z"]).vector(table)
    params = {"n_estimators": 2, "num_leaves": 7, "subsample": 0.7}
    runs = training.seed_runs(ready, training.boosted_trees, params, "race", "y", ["lane"])
    assert [r["seed"] for r in runs] == [42, 43, 44] and all(r["auc"] > 0.5 for r in runs)
    assert metrics.seed_stability(spark.createDataFrame(runs), cols=["logloss"]).first()["logloss_std"] >= 0


def test_registered_models_do_the_whole_job(spark, small, monkeypatch):
    """The reference's tree count, and 80 trials of trees over the whole space."""
    from heatlane.plans.queries import models

    seen = []

    class Stop(Exception):
        pass

    def trees(params, *a, **k):
        seen.append(params["n_estimators"])
        raise Stop

    def fit(df, features, y, trials, *a, **k):
        seen.append(trials)
        raise Stop

    monkeypatch.setattr(training, "boosted_trees", trees)
    monkeypatch.setattr(boosting, "fit", fit)
    for fn in (models.train_gbt, models.importances, models.saved_model_scores, models.random_search):
        with pytest.raises(Stop):
            fn(spark, small)
    assert seen[:3] == [400, 400, 400] and len(seen) == 4 and len(seen[3]) == 80
    assert {k: sorted({t[k] for t in seen[3]}) for k in seen[3][0]} == boosting.SPACE


def test_numbers_by_hash_are_dense_and_rows_move_once(spark):
    """The numbers of a plain window, also of null keys; no written copy of the rows, one exchange of them."""
    from pyspark.sql import Window

    from heatlane.operators import ordered

    df = spark.range(5000).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 3).alias("k"), F.lit("wide").alias("pad"))
    df = df.withColumn("h", F.xxhash64("id"))
    got = ordered.numbered_by_hash(df, ["k"], ["h", "id"], "i", bits=4)
    want = df.withColumn("i", F.when(F.col("k").isNotNull(), F.row_number().over(Window.partitionBy("k").orderBy("h", "id"))))
    assert rows(got, "id", "i") == rows(want, "id", "i")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line and "pad" not in line for line in plan.splitlines()) <= 2 and "rangepartitioning" not in plan


def test_shuffled_copy_gives_each_value_once_without_a_join(spark):
    df = spark.range(3000).select("id", F.rand(1).alias("x"), (F.col("id") % 2).alias("y"))
    for split in (10**6, 200):
        got = training.shuffled_copy(df.repartition(7), ["id", "x"], ["id"], 5, split)
        assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
        out = got.collect()
        assert sorted(r["alt_id"] for r in out) == list(range(3000)) and sum(r["id"] == r["alt_id"] for r in out) == 0
        assert {(r["id"], r["x"]) for r in out} == {(r["alt_id"], r["alt_x"]) for r in out}
        assert rows(got, "id", "alt_id") == rows(training.shuffled_copy(df.repartition(3), ["id", "x"], ["id"], 5, split), "id", "alt_id")


def test_a_fit_reads_even_parts_of_a_written_table(spark, monkeypatch):
    """The rows of one part are dealt to as many as they need, none lost, and read from files, whatever made them."""
    monkeypatch.setattr(training, "FIT_ROWS", (100, 300))
    df = spark.range(1000).coalesce(1).select("id", (F.col("id") % 2).alias("y"))
    got = training.parted(df, "id")
    sizes = [len(x) for x in got.rdd.glom().collect()]
    assert len(sizes) == 8 and max(sizes) < 300 and sorted(r["id"] for r in got.collect()) == list(range(1000))
    assert training.parted(df.limit(150)).rdd.getNumPartitions() == 2 and training.parted(df.limit(0)).count() == 0
    assert "Range" not in got._jdf.queryExecution().executedPlan().toString() and got.columns == ["id"]


def test_registered_trees_are_fitted_on_parts(spark, small, monkeypatch):
    from heatlane.plans.queries import models

    seen = []
    whole = training.parted
    monkeypatch.setattr(models, "TREES", 2)
    monkeypatch.setattr(training, "parted", lambda df, *cols: seen.append(cols) or whole(df, *cols))
    assert models.train_gbt(spark, small).count() > 0 and seen == [("y", "features"), ()]
    out = models.saved_model_scores(spark, small)
    assert out.count() == out.where("equal and in_range").count() > 0 and len(seen) == 3


def test_boosted_trees_of_merged_rows_are_those_of_spark(spark, monkeypatch):
    """The same trees, importances and probabilities, from a few jobs instead of some three a tree."""
    import numpy as np
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    from heatlane.ml import merged

    rng = np.random.default_rng(4)
    x = np.round(np.column_stack([rng.normal(size=3000) * 3, rng.integers(0, 9, 3000), rng.random(3000) * 50, np.ones(3000)]))
    y = (x[:, 0] + x[:, 1] + rng.normal(size=3000) * 4 > 5).astype(int)
    df = spark.createDataFrame([(int(b), [float(v) for v in a]) for a, b in zip(x, y, strict=True)], "y int, x array<double>")
    df = df.select("y", array_to_vector("x").alias("features")).repartition(3)
    est = training.boosted_trees({"n_estimators": 12, "num_leaves": 15, "learning_rate": 0.2, "min_child_samples": 5})
    spark.sparkContext.setJobGroup("merged", "one fit")
    model = est.fit(df)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("merged"))
    spark.sparkContext.setJobGroup("other", "the rest")
    spark_model = GBTClassifier._fit(est, df) if not isinstance(est, merged.MergedGBTClassifier) else super(merged.MergedGBTClassifier, est)._fit(df)
    a, b = ([r.p for r in training.score(m, df, "p").orderBy("features", "y").collect()] for m in (model, spark_model))
    assert np.allclose(a, b, rtol=1e-12) and len(set(a)) > 50
    assert np.allclose(model.featureImportances.toArray(), spark_model.featureImportances.toArray(), rtol=1e-9)
    assert [t.numNodes for t in model.trees] == [t.numNodes for t in spark_model.trees] and model.treeWeights == spark_model.treeWeights
    assert jobs < 24
    monkeypatch.setattr(merged, "_Grid", merged._Listed)
    assert np.allclose(a, [r.p for r in training.score(est.fit(df), df, "p").orderBy("features", "y").collect()], rtol=1e-12)
    monkeypatch.setattr(merged, "MOST_CELLS", 0)  # Spark's own fit
    assert est.fit(df).getNumTrees == 12
