import math
import random

import numpy as np
import pytest

from shelfrisk import session as SS
from shelfrisk.operators import linear as L
from shelfrisk.operators import metrics as M
from shelfrisk.operators import tree as R

X = ["a", "b", "c"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "item int, y double, a double, b double, c double")


def noise(seed, n, item=1):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = pick.random() * 10, float(pick.randint(0, 1)), float(pick.randint(0, 4))
        rows.append((item, round(3 * a - 2 * b + (5 if c > 2 else 0) + pick.gauss(0, 2), 2), round(a, 1), b, c))
    return rows


def test_linear_fit_matches_least_squares(spark):
    rows = noise(1, 200) + noise(2, 50, item=2)
    models = {r["item"]: r for r in L.fit_linear(frame(spark, rows), "item", "y", X).collect()}
    for item, model in models.items():
        part = np.array([r[1:] for r in rows if r[0] == item])
        design = np.column_stack([np.ones(len(part)), part[:, 1:]])
        expected = np.linalg.lstsq(design, part[:, 0], rcond=None)[0]
        got = [model["intercept"], *[model[f"b_{p}"] for p in X]]
        assert got == pytest.approx(expected, abs=1e-9) and model["full_rank"]
        residual = part[:, 0] - design @ got
        assert design.T @ residual == pytest.approx(np.zeros(4), abs=1e-7)


def test_undefined_predictors(spark):
    rows = [(1, y, a, b, 0.0) for _, y, a, b, _ in noise(1, 60)]
    rows += [(2, y, a, b, 2 * a + 1) for _, y, a, b, _ in noise(2, 60)]
    rows += [(3, 5.0, 1.0, 0.0, 0.0)] + [(4, *r[1:]) for r in noise(4, 60)]
    df = frame(spark, rows)
    models = L.fit_linear(df, "item", "y", X)
    assert {r["item"]: r["full_rank"] for r in models.collect()} == {1: False, 2: False, 3: False, 4: True}
    listed = {}
    for r in L.coefficient_rows(models, "item", dict(zip(X, X))).collect():
        listed.setdefault(r["item"], set()).add(r["variable"])
    assert listed == {1: {"a", "b"}, 2: {"a", "b"}, 4: {"a", "b", "c"}}
    assert {r["item"] for r in L.predict_linear(df, models, "item", X).collect()} == {4}
    # The defined ones equal a fit without the undefined one.
    two = {r["item"]: r for r in L.fit_linear(df, "item", "y", X[:2]).collect()}
    for r in models.filter("item < 3").collect():
        assert (r["b_a"], r["b_b"]) == pytest.approx((two[r["item"]]["b_a"], two[r["item"]]["b_b"]))


def test_nearly_equal_predictors_are_told_apart(spark):
    """5e-7 of a column is left by the one before it: above the limit, and far below what sums of products would keep."""
    pick = np.random.default_rng(3)
    a = pick.normal(size=400) + 3
    b = a + 5e-7 * pick.normal(size=400) * np.linalg.norm(a) / 20
    y = 2 * a + 1e6 * (b - a) + pick.normal(size=400)
    rows = [(1, float(v), float(p), float(q), 0.0) for v, p, q in zip(y, a, b)]
    rows += [(2, float(v), float(p), float(p * (1 + 1e-9 * (i % 2))), 0.0) for i, (v, p) in enumerate(zip(y, a))]
    df = frame(spark, rows).repartition(7)
    models = {r["item"]: r for r in L.fit_linear(df, "item", "y", ["a", "b"]).collect()}
    assert models[1]["status"] == "fitted" and models[2]["status"] == "undefined coefficients"
    design = np.column_stack([np.ones(400), a, b])
    expected = np.linalg.lstsq(design, y, rcond=None)[0]
    assert [models[1]["intercept"], models[1]["b_a"], models[1]["b_b"]] == pytest.approx(expected, rel=1e-6)
    assert models[2]["b_b"] is None and models[2]["b_a"] == pytest.approx(np.linalg.lstsq(design[:, :2], y, rcond=None)[0][1])


def test_status_of_each_group(spark):
    rows = noise(5, 40) + [(2, *r[1:]) for r in noise(6, 3)] + [(3, y, a, b, 1.0) for _, y, a, b, _ in noise(7, 30)]
    rows += [(4, y, a, None, c) for _, y, a, _, c in noise(8, 20)] + [(5, *r[1:]) for r in noise(9, 4)]
    models = L.fit_linear(frame(spark, rows).repartition(5), "item", "y", X)
    assert {r["item"]: (r["n"], r["status"]) for r in models.collect()} == {
        1: (40, "fitted"), 2: (3, "too few rows"), 3: (30, "undefined coefficients"), 4: (20, "missing values"), 5: (4, "fitted")}


def test_many_groups_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(L, "HELD_GROUPS", 3)
    rows = [(item, *r[1:]) for item in range(20) for r in noise(item, 12)]
    random.Random(1).shuffle(rows)
    models = {r["item"]: r for r in L.fit_linear(frame(spark, rows).coalesce(1), "item", "y", X).collect()}
    for item in range(20):
        part = np.array([r[1:] for r in rows if r[0] == item])
        design = np.column_stack([np.ones(12), part[:, 1:]])
        if np.linalg.matrix_rank(design) == 4:
            got = [models[item]["intercept"], *[models[item][f"b_{p}"] for p in X]]
            assert got == pytest.approx(np.linalg.lstsq(design, part[:, 0], rcond=None)[0], abs=1e-8)


def test_regression_scores(spark):
    rows = [(1, 2.0, 1.0), (1, 2.0, 5.0), (2, 1.0, 2.0), (2, 3.0, 3.0)]
    predicted = spark.createDataFrame(rows, "item int, y double, p double")
    models = spark.createDataFrame([(1,), (2,), (3,)], "item int")
    got = {r["item"]: r for r in M.scores_of_models(models, predicted, ["item"], "y", "p").collect()}
    assert got[1]["R2"] == 1.0 and got[1]["MAE"] == 2.0
    assert got[2]["R2"] == pytest.approx(0.5) and got[2]["RMSE"] == pytest.approx(math.sqrt(0.5))
    assert got[3]["R2"] == 1.0 and math.isnan(got[3]["RMSE"]) and math.isnan(got[3]["MAE"])


def test_precision_and_recall(spark):
    rows = [(0, 1, 1), (0, 0, 1), (0, 1, 0), (1, 1, 0), (1, 0, 0), (2, 0, 0)]
    scores = M.precision_recall(spark.createDataFrame(rows, "fold int, target int, p int"), ["fold"], "target", "p")
    assert {r["fold"]: (r["precision"], r["recall"]) for r in scores.collect()} == {0: (0.5, 0.5), 1: (0, 0), 2: (0, 0)}
    assert M.mean_scores(scores).first()["precision"] == pytest.approx(1 / 6)


class Brute:
    """Straightforward single-machine tree to check against."""

    def __init__(self, rows, cp, min_split, min_bucket, max_depth=30):
        self.x, self.y = np.array([r[2:] for r in rows]), np.array([r[1] for r in rows])
        self.root = ((self.y - self.y.mean()) ** 2).sum()
        self.price, self.rules, self.kept = cp * self.root, (min_split, min_bucket, max_depth), {}
        self.cost(1, np.arange(len(rows)), 0)

    def cost(self, node, at, depth):
        min_split, min_bucket, max_depth = self.rules
        y = self.y[at]
        risk = ((y - y.mean()) ** 2).sum()
        self.kept[node] = (len(at), y.mean(), None, None)
        best = (0,)
        if len(at) >= min_split and risk > self.price and depth < max_depth:
            for f in range(self.x.shape[1]):
                v = self.x[at, f]
                values = np.unique(v)
                for low, high in zip(values, values[1:]):
                    left = v <= low
                    if min(left.sum(), (~left).sum()) < min_bucket:
                        continue
                    parts = sum(((p - p.mean()) ** 2).sum() for p in (y[left], y[~left]))
                    score = round((risk - parts) / self.root, 9)
                    if score > best[0]:
                        best = (score, f, (low + high) / 2)
        if len(best) == 1:
            return risk + self.price
        _, f, cut = best
        right = self.x[at, f] >= cut
        below = self.cost(2 * node, at[~right], depth + 1) + self.cost(2 * node + 1, at[right], depth + 1)
        if below >= risk + self.price:
            for other in [k for k in self.kept if k != node and any(k >> s == node for s in range(1, 32))]:
                del self.kept[other]
            return risk + self.price
        self.kept[node] = (len(at), y.mean(), X[f], cut)
        return below

    def predict(self, x):
        node = 1
        while self.kept[node][2]:
            node = 2 * node + int(x[X.index(self.kept[node][2])] >= self.kept[node][3])
        return self.kept[node][1]


@pytest.mark.parametrize("cp,task_rows,node_tuples", [(0.0001, 1_000_000, 50_000), (0.02, 1_000_000, 50_000), (0.02, 30, 40), (0.0001, 1_000_000, 5)])
def test_trees_match_brute_force(spark, cp, task_rows, node_tuples):
    rows = noise(7, 260) + noise(8, 90, item=2) + noise(9, 12, item=3)
    df = frame(spark, rows)
    model = R.fit_trees(df, "item", "y", X, cp=cp, task_rows=task_rows, node_tuples=node_tuples)
    walked = R.predict_trees(df, model)
    by_level = R.predict_trees(df, model, tree_nodes=0)
    assert sorted(map(str, walked.collect())) == sorted(map(str, by_level.collect()))
    predicted = walked.collect()
    for item in (1, 2, 3):
        expected = Brute([r for r in rows if r[0] == item], cp, 20, 7)
        nodes = {r["node"]: r for r in model.nodes.filter(f"item = {item}").collect()}
        assert set(nodes) == set(expected.kept)
        for node, (n, mean, feature, cut) in expected.kept.items():
            r = nodes[node]
            assert (r["n"], r["feature"], r["cut"]) == (n, feature, cut) and r["mean"] == pytest.approx(mean)
        for r in predicted:
            if r["item"] == item:
                assert r["prediction"] == pytest.approx(expected.predict([r[x] for x in X]))
    assert 3 not in {r["item"] for r in R.importance_rows(model).collect()}


def test_levels_share_jobs(spark):
    """A tree of many levels takes far fewer stored tables than levels: several levels fit one plan."""
    pick = random.Random(3)
    rows = [(1, 1.4 ** (i // 10) + 1e-3 * pick.random(), i / 3, 0.0, 0.0) for i in range(400)]
    df = frame(spark, rows)
    before = len(SS._STORED)
    model = R.fit_trees(df, "item", "y", X, cp=0.0, min_split=8, min_bucket=4)
    stored = len(SS._STORED) - before
    assert model.depth >= 12 and stored <= 7 + -(-(model.depth + 1) // R.LEVELS_PER_PLAN) < model.depth


def test_deeper_trees_fit_better(spark):
    df = frame(spark, noise(11, 150))
    errors = []
    for depth in (0, 1, 3):
        predicted = R.predict_trees(df, R.fit_trees(df, "item", "y", X, max_depth=depth))
        errors.append(M.regression_scores(predicted, ["item"], "y", "prediction").first()["RMSE"])
    assert errors[0] > errors[1] > errors[2]
