import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from itertools import combinations
from math import factorial

from keepsake.ml import metrics as M
from keepsake.ml import model as ML
from keepsake.ml import shap as SH
from keepsake.ml import split as S


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    data = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(800)]
    return spark.createDataFrame(data, "y int, s double").repartition(5), data


def test_roc_auc_counts_pairs(scored):
    df, data = scored
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    got = M.roc_auc(df, "y", "s").first()
    assert got["roc_auc"] == pytest.approx(wins / len(pos) / len(neg))
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg))


def test_curve_threshold_and_average_precision(scored):
    df, data = scored
    positives = sum(y for y, _ in data)
    want, area, seen = {}, 0.0, 0
    for t in sorted({s for _, s in data}, reverse=True):
        chosen = [y for y, s in data if s >= t]
        tp = sum(chosen)
        want[t] = (tp / len(chosen), tp / positives, 2 * tp / (len(chosen) + positives))
        area += (tp - seen) / positives * tp / len(chosen)
        seen = tp
    curve = M.pr_curve(df, "y", "s")
    for r in curve.collect():
        assert (r["precision"], r["recall"], r["f1"]) == pytest.approx(want[r["threshold"]])
    assert M.average_precision(curve).first()[0] == pytest.approx(area)
    best = M.best_threshold(curve).first()
    top = max(round(f, 12) for _, _, f in want.values())
    assert best["threshold"] == min(t for t, (_, _, f) in want.items() if round(f, 12) == top)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 1.0)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_split_by_time(spark):
    data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * ((i * 37) % 100))) for i in range(100)]
    df = spark.createDataFrame(data, "id int, ts timestamp").repartition(4)
    got = S.temporal_split(df, "ts")
    assert got.filter("NOT is_validation").count() == 80
    assert got.filter("NOT is_validation").agg(F.max("ts")).first()[0] < got.filter("is_validation").agg(F.min("ts")).first()[0]


def test_folds_are_balanced_and_stable(spark, same):
    df = spark.range(1003).selectExpr("id", "CAST(id % 4 = 0 AS INT) AS y")
    dealt = S.stratified_folds(df, "y", ["id"])
    sizes = dealt.groupBy("y", "fold").count().groupBy("y").agg((F.max("count") - F.min("count")).alias("gap"))
    assert all(r["gap"] <= 1 for r in sizes.collect())
    same(dealt, S.stratified_folds(df.repartition(3), "y", ["id"]))


def test_training_set(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, None, 2.0), (2, 1, None, 1, 1.0), (3, 0, 1, 1, 1.0)],
        "company_id long, baked_31d int, churned_31d int, tenure_days int, save_rate_lifetime double",
    )
    got = S.training_set(df)
    assert got.columns == ["company_id", "churned_31d", "tenure_days", "save_rate_lifetime"]
    assert [tuple(r) for r in got.collect()] == [(1, 0, 0, 2.0)]


def test_model_learns_and_ranks_features(spark):
    rng = random.Random(2)
    data = []
    for i in range(600):
        x = rng.random()
        data.append((i, x, rng.random(), int(x > 0.6), i % 5 == 0))
    df = spark.createDataFrame(data, "id int, useful double, noise double, churned_31d int, held boolean")
    config = ML.ChurnConfig(trees=5, depth=3, folds=2, column_share=1.0)
    model = ML.train(df, ["useful", "noise"], config, validation="held")
    scores = ML.score(model, df.filter("held"), F.lit("2024-01-01").cast("date"))
    assert M.roc_auc(scores, "churned_31d", "score").first()["roc_auc"] > 0.95
    assert set(r["risk_tier"] for r in scores.select("risk_tier").distinct().collect()) >= {"LOW", "CRITICAL"}
    top = ML.top_features(ML.permutation_importance(model, df.filter("held"), ["useful", "noise"], ["id"]), 1)
    assert top.first()["feature"] == "useful"
    assert ML.cross_validate(df, ["useful", "noise"], ["id"], config).count() == 2


def known_value(nodes, x, known, at=0):
    """What a tree expects of a row of which only some features are known."""
    n = nodes[at]
    if n.feature < 0:
        return n.value
    if n.feature in known:
        return known_value(nodes, x, known, n.left if x[n.feature] <= n.threshold else n.right)
    return sum(nodes[c].cover / n.cover * known_value(nodes, x, known, c) for c in (n.left, n.right))


def shapley(trees, weights, x):
    out, names = [], range(len(x))
    for i in names:
        others = [j for j in names if j != i]
        total = 0.0
        for size in range(len(x)):
            w = factorial(size) * factorial(len(x) - size - 1) / factorial(len(x))
            for s in combinations(others, size):
                for nodes, weight in zip(trees, weights, strict=True):
                    total += w * weight * (known_value(nodes, x, {*s, i}) - known_value(nodes, x, set(s)))
        out.append(total)
    return out


@pytest.fixture(scope="module")
def four_features(spark):
    rng = random.Random(8)
    data = []
    for i in range(500):
        a, b, c, d = (round(rng.random(), 2) for _ in range(4))
        data.append((i, a, b, c, d, int(a + b * c + 0.3 * rng.random() > 0.9), i % 4 == 0))
    return spark.createDataFrame(data, "id int, a double, b double, c double, d double, churned_31d int, held boolean")


def test_attributions_against_all_subsets(spark, four_features):
    columns = ["a", "b", "c", "d"]
    config = ML.ChurnConfig(trees=4, depth=4, column_share=1.0)
    model = ML.train(four_features, columns, config)
    booster = model.stages[1]
    trees, weights = SH.tree_nodes(spark, booster), list(booster.treeWeights)
    # Some path asks for one feature more than once.
    assert any(len(leaf.features) < 4 and len(nodes) > 9 for nodes in trees for leaf in SH.leaves(nodes))
    explained = SH.attributions(model, four_features.filter("id < 25"), ["id", "a", "b", "c", "d"]).collect()
    for r in explained:
        want = shapley(trees, weights, [r[c] for c in columns])
        assert r["shap"] == pytest.approx(want, abs=1e-9)
        assert r["base"] + sum(r["shap"]) == pytest.approx(r["margin"], abs=1e-9)
    top = {r["feature"]: r["importance"] for r in SH.importance(SH.attributions(model, four_features, ["id"]), columns).collect()}
    assert max(top, key=top.get) == "a" and min(top, key=top.get) == "d"


def test_kept_round():
    assert ML.kept_round([5, 4, 3, 4, 5, 6], 3) == (2, True)
    assert ML.kept_round([5, 4, 3, 4, 5], 3) == (2, False)
    assert ML.kept_round([5, 4, 4.5, 4.2, 3, 2], 3) == (5, False)
    assert ML.kept_round([1, 2, 2, 2, 0], 3) == (0, True)
    assert ML.kept_round([3], 1) == (0, False)


def test_boosting_waits_and_keeps_the_best_round(four_features):
    columns = ["a", "b", "c", "d"]
    config = ML.ChurnConfig(trees=24, depth=3, step=0.8, patience=4, column_share=1.0)
    model, losses = ML.train_with_curve(four_features, columns, config, validation="held")
    best, stopped = ML.kept_round(losses, 4)
    assert stopped and model.stages[1].getNumTrees == best + 1 and 1 < len(losses) <= 24
    assert losses[best] == min(losses[: best + 5])


def test_a_cut_model_has_the_first_trees(spark, four_features):
    columns = ["a", "b", "c", "d"]
    model = ML.train(four_features, columns, ML.ChurnConfig(trees=5, depth=3))
    whole, cut = model.stages[1], ML.truncated(model.stages[1], 3)
    assert SH.tree_nodes(spark, cut) == SH.tree_nodes(spark, whole)[:3]
    assert list(cut.treeWeights) == list(whole.treeWeights)[:3]
    features = model.stages[0].transform(four_features)
    assert cut.transform(features).select("probability").first() != whole.transform(features).select("probability").first()


def test_folds_at_once_rate_alike(four_features):
    config = ML.ChurnConfig(trees=4, depth=2, folds=3, column_share=1.0)
    rated = [
        sorted(map(tuple, ML.cross_validate(four_features, ["a", "b", "c", "d"], ["id"], config, at_once=n).collect()))
        for n in (1, 3)
    ]
    assert rated[0] == rated[1] and len(rated[0]) == 3 and all(a > 0.7 for _, a in rated[0])
