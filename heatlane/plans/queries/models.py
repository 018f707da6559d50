"""Preprocessing, metrics, training, search, stacking and importances."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from heatlane.functions import scoring
from heatlane.ml import boosting, metrics, preprocess, store, training
from heatlane.operators import joins, windows
from heatlane.plans import lenses
from heatlane.plans.lenses import table
from heatlane.session import durable, scratch_path
from heatlane.plans.registry import lens, query, r, rounded

NUMBERS = ["c_acctbal", "c_nationkey", "adv_p1"]
FIT_CTE = """t as (select c_custkey, case when c_custkey % 13 <> 0 then c_acctbal end as c_acctbal, cast(c_nationkey as double) as c_nationkey,
 case when c_custkey % 5 <> 0 then c_acctbal / 1000 - 4 end as adv_p1, case when c_custkey % 11 <> 0 then c_mktsegment end as c_mktsegment from customer),
f as (select c_custkey, coalesce(c_acctbal, (select median(c_acctbal) from t)) as c_acctbal,
 coalesce(c_nationkey, (select median(c_nationkey) from t)) as c_nationkey, coalesce(adv_p1, 0) as adv_p1 from t)"""


def customers(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    return c.select(
        "c_custkey", F.when(k % 13 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.col("c_nationkey").cast("double").alias("c_nationkey"),
        F.when(k % 5 != 0, F.col("c_acctbal") / 1000 - 4).alias("adv_p1"),
        F.when(k % 11 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


@query(
    "fit_transform_numeric",
    f"with {FIT_CTE} select c_custkey, "
    + ", ".join(
        r(f"({c} - avg({c}) over ()) / case when stddev_pop({c}) over () = 0 then 1 else stddev_pop({c}) over () end", 6)
        + f" as {c}" for c in NUMBERS
    ) + " from f",
)
def fit_transform_numeric(spark, sf):
    c = customers(spark, sf)
    return rounded(preprocess.fit(c, NUMBERS).transform(c, ["c_custkey"]), 6)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "one_hot",
    f"""with {FIT_CTE}, m as (select c_mktsegment as v, count(*) as n from t where c_mktsegment is not null group by 1),
u as (select c_custkey, coalesce(c_mktsegment, (select v from m order by n desc, v limit 1)) as s from t)
select c_custkey, """ + ", ".join(f"cast(s = '{s}' as double) as \"c_mktsegment_{s}\"" for s in SEGMENTS) + " from u",
)
def one_hot(spark, sf):
    c = customers(spark, sf)
    return preprocess.fit(c, texts=["c_mktsegment"]).transform(c, ["c_custkey"])


@query(
    "exact_medians",
    f"""select 'l_extendedprice' as "column", {r('median(l_extendedprice)')} as median from lineitem
union all select 'l_quantity', {r('median(l_quantity)')} from lineitem union all select 'l_tax', {r('median(l_tax)')} from lineitem""",
)
def exact_medians(spark, sf):
    return rounded(preprocess.exact_medians(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_tax"]))


@query(
    "modes",
    """with l as (select 'l_returnflag' as "column", l_returnflag as v, count(*) as n from lineitem group by 1, 2 union all
 select 'l_linestatus', l_linestatus, count(*) from lineitem group by 1, 2),
k as (select *, row_number() over (partition by "column" order by n desc, v) as rn from l) select "column", v as mode from k where rn = 1""",
)
def modes(spark, sf):
    return preprocess.modes(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


METRICS_SQL = f"""{lens('scored')}, d as (select score as s, cast(sum(y) as double) as p, cast(sum(1 - y) as double) as n from scored group by 1),
w as (select *, coalesce(sum(n) over (order by s rows between unbounded preceding and 1 preceding), 0) as nb,
 sum(p) over (order by s desc) as pf, sum(n) over (order by s desc) as nf, sum(p) over () as tp_all, sum(n) over () as tn_all,
 least(greatest(s, 2.220446049250313e-16), 1 - 2.220446049250313e-16) as c from d),
g as (select sum(p * (nb + 0.5 * n)) / (max(tp_all) * max(tn_all)) as auc, sum(p * pf / (pf + nf)) / max(tp_all) as ap,
 -sum(p * ln(c) + n * ln(1 - c)) / (max(tp_all) + max(tn_all)) as ll, coalesce(sum(p) filter (where s >= 0.5), 0) as tp,
 coalesce(sum(n) filter (where s >= 0.5), 0) as fp, coalesce(sum(p) filter (where s < 0.5), 0) as fn,
 coalesce(sum(n) filter (where s < 0.5), 0) as tn from w)
select {r('auc')} as auc, {r('ap')} as pr_auc, {r('ll', 6)} as logloss, {r('(tp + tn) / (tp + tn + fp + fn)')} as accuracy,
 {r('(tp * tn - fp * fn) / (sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn))')} as mcc, cast(tp + tn + fp + fn as bigint) as n from g"""


def _metrics(spark, sf, **kw):
    out = metrics.binary_metrics(lenses.scored(spark, sf), "y", "score", **kw)
    return rounded(out.withColumn("logloss", F.round("logloss", 6)))


@query("binary_metrics", METRICS_SQL)
def binary_metrics(spark, sf):
    return _metrics(spark, sf)


@query("binary_metrics_hot", METRICS_SQL)
def binary_metrics_hot(spark, sf):
    """The running total in chunks."""
    return _metrics(spark, sf, split_rows=100)


@query(
    "topk_hit",
    f"""{lens('scored')}, k as (select race_id, y, row_number() over (partition by race_id order by score desc, line, part, supp) as rn from scored),
g as (select race_id, count(*) as n, max(y) as hit from k where rn <= 2 group by 1)
select {r('avg(hit)')} as top2_hit, count(*) as n_races from g where n = 2""",
)
def topk_hit(spark, sf):
    return rounded(metrics.topk_hit(lenses.scored(spark, sf), "race_id", "y", "score", ["line", "part", "supp"]))


#: The reference's default number of trees.
TREES = 400
INPUTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TIE = ["line", "part", "supp"]


def _ready(spark, sf):
    s = lenses.scored(spark, sf).withColumnRenamed("part", "item")
    s = durable(windows.split_by_first_seen(s, "race_id", ["ts"]), "split")
    prepared = preprocess.fit(s.where(F.col("part") == "train"), INPUTS)
    return prepared, prepared.vector(s)


@query("train_gbt")
def train_gbt(spark, sf):
    """Hold-out scores of boosted trees fitted on the earlier races."""
    _, rows = _ready(spark, sf)
    fit_rows, valid = training.hold_out(rows)
    est = training.boosted_trees({"n_estimators": TREES, "num_leaves": 7, "learning_rate": 0.1})
    out = training.score(est.fit(training.parted(fit_rows, "y", "features")), training.parted(valid), label="boosted")
    return out.select("race_id", "line", "item", "supp", "y", "proba", "model_label")


def _logistic(params):
    return LogisticRegression(labelCol="y", featuresCol="features", regParam=float(params["reg_lambda"]), maxIter=100)


def _split(spark, sf):
    s = lenses.scored(spark, sf).withColumnRenamed("part", "item")
    return windows.split_by_first_seen(s, "race_id", ["ts"])


#: Parameters of the registered leaf-wise fits.
LEAFWISE = {"n_estimators": TREES, "num_leaves": 31, "learning_rate": 0.05, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_samples": 40, "reg_lambda": 1.0, "reg_alpha": 0.1}


@query("random_search")
def random_search(spark, sf):
    """80 trials of boosted trees over all nine parameters, on the hold-out; the adopted one marked."""
    trials = durable(boosting.search(_split(spark, sf), INPUTS, "race_id", "y", ["line", "item", "supp"]), "trials")
    best = training.adopt(trials, 0.0).select("trial").withColumn("adopted", F.lit(True))
    return trials.join(F.broadcast(best), "trial", "left")  # one row


@query("train_leafwise")
def train_leafwise(spark, sf):
    """Leaf-wise trees: fit on the earlier races, hold-out metrics, full refit; the refit's importances beside the metrics."""
    nodes, held = boosting.train(_split(spark, sf), INPUTS, LEAFWISE, "race_id", "y", ["line", "item", "supp"])
    return boosting.importances(nodes).withColumns({k: F.lit(v) for k, v in held.items()})


@query("seed_runs")
def seed_runs(spark, sf):
    """Hold-out metrics of one parameter set over the seeds 42 to 44: mean and population sd."""
    runs = boosting.seed_runs(_split(spark, sf), INPUTS, LEAFWISE, "race_id", "y", ["line", "item", "supp"])
    return metrics.seed_stability(runs)


@query("boosted_stump", f"""{lens('scored')}, m as (select avg(y) as p, count(*) as n, sum(y) as pos from scored),
x as (select 'l_discount' as feature, l_discount::double as x, y from scored union all select 'l_tax', l_tax::double, y from scored),
c as (select feature, x, count(*) as n, sum(y) as pos from x group by 1, 2),
s as (select feature, x, sum(n) over w as n_left, sum(pos) over w as pos_left from c window w as (partition by feature order by x)),
t as (select feature, x, n_left, p, n_left * p - pos_left as gl, (m.n - n_left) * p - (m.pos - pos_left) as gr, n_left * p * (1 - p) as hl, (m.n - n_left) * p * (1 - p) as hr
  from s, m where n_left >= 40 and m.n - n_left >= 40),
b as (select *, gl * gl / (hl + 3) + gr * gr / (hr + 3) as gain from t),
k as (select * from b order by gain desc limit 1)
select feature, {r('x', 6)} as threshold, n_left::bigint as n_left, {r('-0.1 * gl / (hl + 3)', 9)} as value_left, {r('-0.1 * gr / (hr + 3)', 9)} as value_right from k""")
def boosted_stump(spark, sf):
    """One tree of two leaves: the split of greatest gain over two columns, and both leaf values."""
    params = {"n_estimators": 1, "num_leaves": 2, "min_child_samples": 40, "reg_lambda": 3.0}
    nodes = boosting.fit(lenses.scored(spark, sf), ["l_discount", "l_tax"], "y", [params]).filter("tree = 0")
    top, ends = nodes.filter("node = 0"), nodes.filter("node > 0").select("node", "value", "rows")
    left, right = ends.select(*[F.col(c).alias(f"l_{c}") for c in ends.columns]), ends.select(*[F.col(c).alias(f"r_{c}") for c in ends.columns])
    both = top.join(left, F.col("left") == F.col("l_node")).join(right, F.col("right") == F.col("r_node"))
    return both.select(
        "feature", F.round("threshold", 6).alias("threshold"), F.col("l_rows").alias("n_left"), F.round("l_value", 9).alias("value_left"),
        F.round("r_value", 9).alias("value_right"),
    )


@query("seed_stability", f"""{lens('scored')}, g as (select race_id % 3 as seed, avg(score) as logloss, avg(y) as pr_auc from scored group by 1)
select {r('avg(logloss)', 6)} as logloss_mean, {r('stddev_pop(logloss)', 6)} as logloss_std, {r('avg(pr_auc)', 6)} as pr_auc_mean,
 {r('stddev_pop(pr_auc)', 6)} as pr_auc_std from g""")
def seed_stability(spark, sf):
    runs = lenses.scored(spark, sf).groupBy((F.col("race_id") % 3).alias("seed")).agg(
        F.avg("score").alias("logloss"), F.avg("y").alias("pr_auc")
    )
    return rounded(metrics.seed_stability(runs), 6)


@query("out_of_fold")
def out_of_fold(spark, sf):
    """Five stratified folds, every row scored by a model that did not see it."""
    prepared = preprocess.fit(lenses.scored(spark, sf), INPUTS)
    rows = training.stratified_folds(lenses.scored(spark, sf).drop("score"), "y", ["race_id", *TIE, "ts", "l_extendedprice"])
    rows = prepared.vector(rows).select("race_id", *TIE, "y", "fold", "features")
    out = training.out_of_fold(rows, _logistic({"reg_lambda": 0.01}))
    return out.select("race_id", *TIE, "y", "fold", "p_oof")


@query("fold_balance", f"""{lens('scored')}, i as (select y, row_number() over (partition by y) - 1 as i from scored)
select y, cast(i % 5 as int) as fold, count(*) as n from i group by 1, 2""")
def fold_balance(spark, sf):
    """Rows per class and fold of the stratified assignment."""
    folds = training.stratified_folds(lenses.scored(spark, sf), "y", ["race_id", *TIE, "ts", "l_extendedprice"])
    return folds.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("stack_lr")
def stack_lr(spark, sf):
    """Nested cross-fitting: a base and a section model, the latter for a part of the rows, and the stacking
    model on their out-of-fold scores; each row judged by models that did not see its fold."""
    keys = ["race_id", *TIE, "ts", "l_extendedprice"]
    s = lenses.scored(spark, sf).drop("score").withColumn("stage", F.when(F.col("l_tax") > 0.04, "high").otherwise("low"))
    inputs = {"base_features": preprocess.fit(s, INPUTS[:2]), "section_features": preprocess.fit(s, INPUTS[2:])}
    base, section = (LogisticRegression(labelCol="y", featuresCol=n, regParam=0.01, maxIter=100) for n in inputs)

    def ready(rows):
        """The vectors, once the rows have their folds, and what the result needs."""
        for name, prepared in inputs.items():
            rows = prepared.vector(rows, name)
        return rows.drop("ts", *INPUTS)

    out = training.cross_stack(s, "y", base, section, keys, F.col("part") % 4 != 0, {"stage": ["high", "low"]}, ready=ready)
    return out.select("race_id", *TIE, "y", "fold", "p_base", "p_sectional", "p_meta")


@query("nested_fold_balance", f"""{lens('scored')}, i as (select y, row_number() over (partition by y) - 1 as i from scored),
f as (select y, i % 5 as fold, row_number() over (partition by y, i % 5) - 1 as j from i)
select y, cast(fold as int) as fold, cast(j % 4 as int) as "inner", count(*) as n from f group by 1, 2, 3""")
def nested_fold_balance(spark, sf):
    """Rows per class, outer and inner fold."""
    folds = training.nested_folds(lenses.scored(spark, sf), "y", ["race_id", *TIE, "ts", "l_extendedprice"])
    return folds.groupBy("y", "fold", "inner").agg(F.count(F.lit(1)).alias("n"))


@query("out_of_fold_join", f"""{lens('lanes')} select race_id, lane, time_tenji as p_base, case when player_id % 4 <> 0 then price end as p_sectional from lanes""")
def out_of_fold_join(spark, sf):
    """Scores of a second model, there for a part of the entries, beside those of the first."""
    lanes = lenses.lanes(spark, sf)
    base = lanes.select("race_id", "lane", F.col("time_tenji").alias("p_base"))
    section = lanes.where(F.col("player_id") % 4 != 0).select("race_id", "lane", F.col("price").alias("p_sectional"))
    return joins.out_of_fold_join(base, section, ["race_id", "lane"], "p_sectional")


@query("category_codes", """with c as (select 'o_clerk' as "column", o_custkey::varchar as value from orders union select 'o_status', o_orderstatus from orders)
select "column", value, row_number() over (partition by "column" order by value) - 1 as code from c where value is not null""")
def category_codes(spark, sf):
    """Numbers of the categories of an open vocabulary and of a short one."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("o_clerk"), F.col("o_orderstatus").alias("o_status"))
    return preprocess.category_codes(o, ["o_clerk", "o_status"])


CODED_SQL = """with c as (select v, row_number() over (order by v) - 1 as code from (select distinct o_custkey::varchar as v from orders where o_orderkey % 3 <> 0) q)
select o_orderkey, cast(coalesce(code, (select count(*) from c)) as bigint) as o_clerk_code from orders left join c on v = o_custkey::varchar"""


@query("coded_columns", CODED_SQL)
def coded_columns(spark, sf):
    """Codes of a fit on two thirds of the rows; values it has not seen get the number of categories."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_clerk"))
    coded = preprocess.fit_open(o.where(F.col("o_orderkey") % 3 != 0), texts=["o_clerk"])
    return coded.codes(o).select("o_orderkey", F.col("o_clerk_code").cast("long").alias("o_clerk_code"))


@query("importances")
def importances(spark, sf):
    """Gain importances and split counts of the boosted trees."""
    prepared, rows = _ready(spark, sf)
    model = training.boosted_trees({"n_estimators": TREES, "num_leaves": 7}).fit(training.parted(rows, "y", "features"))
    gain = training.importances(model, prepared.names, spark)
    return gain.join(training.split_counts(model, prepared.names, spark), "feature", "left")


@query("permutation_importance")
def permutation_importance(spark, sf):
    prepared, rows = _ready(spark, sf)
    model = _logistic({"reg_lambda": 0.0}).fit(rows)
    keys = ["race_id", "line", "item", "supp", "ts", "l_extendedprice"]
    return training.permutation_importance(model, prepared, rows.drop("features"), "y", INPUTS, keys, repeats=5)


@query("permutation_leafwise")
def permutation_leafwise(spark, sf):
    """The same for the leaf-wise trees, on the hold-out."""
    rows = durable(_split(spark, sf), "split")
    nodes = boosting.fit(rows.where("part = 'train'"), INPUTS, "y", [LEAFWISE])
    keys = ["race_id", "line", "item", "supp", "ts", "l_extendedprice"]
    return boosting.permutation_importance(boosting.Trees(nodes), rows.where("part = 'valid'"), "y", keys)


@query("rank_importances", f"""{lens('lanes')}, g as (select player_id % 50 as feature, max(price) as importance from lanes group by 1)
select feature, importance, rank() over (order by importance desc) as rank from g""")
def rank_importances(spark, sf):
    """Descending rank over a report-sized table."""
    g = lenses.lanes(spark, sf).groupBy((F.col("player_id") % 50).alias("feature")).agg(F.max("price").alias("importance"))
    return windows.rank_in_group(g.withColumn("all", F.lit(1)), "all", "importance", "rank", descending=True).drop("all")


@query("rank_trials", """with t as (select o_custkey as trial, avg(o_totalprice) as logloss, max(o_totalprice) as pr_auc from orders group by 1)
select trial from (select trial, logloss, row_number() over (order by logloss, trial) as rn from t) where rn <= 10""")
def rank_trials(spark, sf):
    t = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("trial")).agg(
        F.avg("o_totalprice").alias("logloss"), F.max("o_totalprice").alias("pr_auc")
    )
    return training.rank_trials(t).select("trial")


@query("trial_report", """with t as (select o_custkey as trial, avg(o_totalprice) as logloss, max(o_totalprice) as pr_auc from orders group by 1),
k as (select *, row_number() over (order by pr_auc desc, trial) as rn from t)
select trial from k where rn <= 10 order by logloss, trial limit 5""")
def trial_report(spark, sf):
    """Ten best by average precision, five of them by log loss."""
    t = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("trial")).agg(
        F.avg("o_totalprice").alias("logloss"), F.max("o_totalprice").alias("pr_auc")
    )
    return training.trial_report(t, "pr_auc").select("trial")


@query("adopt_trial", """with t as (select o_custkey as trial, avg(o_totalprice) as logloss, max(o_totalprice) as pr_auc from orders group by 1),
k as (select *, row_number() over (order by logloss, trial) as rn from t)
select trial from k where rn <= 10 order by (pr_auc >= 200000) desc, logloss, trial limit 1""")
def adopt_trial(spark, sf):
    t = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("trial")).agg(
        F.avg("o_totalprice").alias("logloss"), F.max("o_totalprice").alias("pr_auc")
    )
    return training.adopt(t, 200000.0).select("trial")


def _pairs(spark, sf):
    """Features of lane pairs, each scored by a model fitted on the other folds."""
    b = lenses.boats(spark, sf).withColumn("is_top2", (F.col("finish") <= 2).cast("int"))
    cols = ["price", "time_tenji", "discount", "is_top2"]
    pairs = scoring.pair_features(joins.pairs_within_group(b, "race_id", "lane", cols), ["time_tenji"], ["discount"], "is_top2")
    names = ["time_tenji_mean", "time_tenji_diff", "time_tenji_adiff", "shared_discount"]
    pairs = durable(pairs.select("race_id", "lane_i", "lane_j", "y", *names), "pairs")
    prepared = preprocess.fit(pairs, names)
    rows = prepared.vector(training.stratified_folds(pairs, "y", ["race_id", "lane_i", "lane_j"])).drop(*names)
    return training.out_of_fold(rows, _logistic({"reg_lambda": 0.01}), name="p_top2set")


@query("pair_dataset", None)
def pair_dataset(spark, sf):
    """Out-of-fold scores of lane pairs, five stratified folds."""
    return _pairs(spark, sf).select("race_id", "lane_i", "lane_j", "y", "fold", "p_top2set")


@query("pair_scores_check", f"""{lens('boats')}, t as (select race_id, lane, finish <= 2 as top from boats)
select a.race_id, a.lane as lane_i, b.lane as lane_j, cast(a.top and b.top as int) as y, true as in_range, cast(1 as bigint) as n
 from t a join t b on a.race_id = b.race_id and a.lane < b.lane""")
def pair_scores_check(spark, sf):
    """Every pair once, with its label and a probability."""
    p = _pairs(spark, sf)
    return p.groupBy("race_id", "lane_i", "lane_j", F.col("y").cast("int").alias("y")).agg(
        F.bool_and(F.col("p_top2set").between(0, 1)).alias("in_range"), F.count(F.lit(1)).alias("n")
    )


@query("saved_model_scores", f"""{lens('scored')} select race_id, line, part as item, supp, ts, l_extendedprice, true as equal, true as in_range from scored""")
def saved_model_scores(spark, sf):
    """Transform, base, second and stacked model written, read again and applied to
    raw rows give the scores they gave before."""
    keys = ["race_id", "line", "item", "supp", "ts", "l_extendedprice"]
    raw = training.parted(lenses.scored(spark, sf).withColumnRenamed("part", "item").dropDuplicates(keys))
    prepared = preprocess.fit(raw, INPUTS)
    second_prepared = preprocess.fit(raw, INPUTS[:2])
    base = _logistic({"reg_lambda": 0.01}).fit(prepared.vector(raw))
    second = training.boosted_trees({"n_estimators": TREES, "num_leaves": 7}).fit(second_prepared.vector(raw))

    def both(rows, first, other, models):
        out = training.score(models[0], first.vector(rows), "p_base").drop("features")
        return training.score(models[1], other.vector(out), "p_sectional").drop("features").withColumn("stage", F.lit("all"))

    contexts = {"stage": ["all"]}
    before = both(raw, prepared, second_prepared, (base, second))
    stack, names = training.stack(before, "y", contexts)
    root = scratch_path(spark, "models")
    for name, p in (("base", prepared), ("second", second_prepared)):
        store.save_prepared(spark, p, f"{root}/{name}-prepared")
    for name, m in (("base", base), ("second", second), ("stack", stack)):
        store.save_model(m, f"{root}/{name}")
    loaded = [store.load_model(spark, f"{root}/{n}") for n in ("base", "second", "stack")]
    after = both(raw, *[store.load_prepared(spark, f"{root}/{n}-prepared") for n in ("base", "second")], loaded[:2])
    scores = [training.apply_stack(m, rows, names, contexts) for m, rows in ((stack, before), (loaded[2], after))]
    return store.same_scores(*scores, keys, "p_meta")
