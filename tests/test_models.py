import math
import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from helpers import rows
from tallywork.operators import models, trees
from tallywork.operators.recommendations import best_items


def test_line_equals_the_closed_form(spark):
    data = [(2.0 * x + (x % 3), float(x)) for x in range(50)]
    examples = models.assemble(spark.createDataFrame(data, ["y", "x"]), ["x"], "y")
    model = models.fit_line(examples)
    n = len(data)
    my, mx = sum(y for y, _ in data) / n, sum(x for _, x in data) / n
    sy = math.sqrt(sum((y - my) ** 2 for y, _ in data) / n)
    sx = math.sqrt(sum((x - mx) ** 2 for _, x in data) / n)
    r = sum((y - my) * (x - mx) for y, x in data) / n / sx / sy
    shrink = 0.3 / sy
    slope = (r - shrink * 0.8) / (1 + shrink * 0.2) * sy / sx
    terms = dict(rows(models.line_terms(model, examples, ["x"])))
    assert terms["x"] == pytest.approx(slope, rel=1e-9)
    assert terms["intercept"] == pytest.approx(my - slope * mx, abs=1e-9)


def test_tree_and_metrics_agree_with_the_evaluator(spark):
    data = [(float(x), float(x % 7), 3.0 * x + x % 7) for x in range(300)]
    examples = models.assemble(spark.createDataFrame(data, ["a", "b", "y"]), ["a", "b"], "y")
    model = models.fit_tree(examples)
    assert model.depth <= 5
    scored = models.predict(model, examples)
    got = dict(rows(models.regression_metrics(scored)))
    evaluator = RegressionEvaluator()
    for metric in ("rmse", "mse", "r2", "mae"):
        assert got[metric] == pytest.approx(evaluator.evaluate(scored, {evaluator.metricName: metric}))


def test_metrics_of_a_constant_label(spark):
    scored = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], ["prediction", "label"])
    assert dict(rows(models.regression_metrics(scored)))["r2"] is None


def test_recommendations_follow_taste(spark):
    ratings = [(u, i, 5 if (u + i) % 2 == 0 else 1) for u in range(12) for i in range(12) if (u, i) != (3, 5)]
    df = spark.createDataFrame(ratings, "u int, i int, r int")
    model = models.fit_recommender(df, "u", "i", "r")
    names = spark.createDataFrame([(i, f"item {i}") for i in range(11)], ["i2", "title"])
    users = spark.createDataFrame([(3,)], ["u"])
    got = models.recommend(model, users, names, "i2", "title", k=6).collect()
    assert sorted(r.i for r in got) == [1, 3, 5, 7, 9, 11]
    assert {r.i: r.title for r in got}[11] is None
    assert [r.rating for r in got] == sorted((r.rating for r in got), reverse=True)


def test_recommendations_find_planted_tastes_with_long_ids(spark):
    """Two groups of users, each fond of one half of the items; ids are beyond 32 bits."""
    far = 1 << 40
    ratings = [
        (far + u, far + i, 5.0 if (u < 10) == (i < 6) else 1.0) for u in range(20) for i in range(12) if (u + i) % 5
    ]
    frame = spark.createDataFrame(ratings, "u long, i long, r double")
    names = spark.createDataFrame([(far + i, f"n{i}") for i in range(12)], "i long, name string")
    model = models.fit_recommender(frame, "u", "i", "r")
    got = models.recommend(model, spark.createDataFrame([(far + 3,), (7,)], "u long"), names, "i", "name", 4).collect()
    assert len(got) == 4 and all(r.u == far + 3 and r.i < far + 6 and r.name == f"n{r.i - far}" for r in got)


@pytest.mark.parametrize("first,growth,part", [(256, 8, 4096), (3, 2, 4), (1, 1, 1)])
def test_best_items_equal_the_full_product(spark, first, growth, part):
    """Factors of very different norms, equal items, zero vectors and a user without a vector."""
    rng = random.Random(7)
    items = [(i, [rng.gauss(0, 1) * 4 ** rng.randint(-3, 1) for _ in range(3)]) for i in range(60)]
    items += [(100 + i, list(items[i][1])) for i in range(20)] + [(200, [0.0] * 3), (201, None)]
    users = [(u, [rng.gauss(0, 1) for _ in range(3)]) for u in range(15)] + [(50, [0.0] * 3), (51, None)]
    expected = set()
    for user, u in users:
        if u is None:
            continue
        scored = [(-sum(a * b for a, b in zip(u, v)), item) for item, v in items if v is not None]
        expected |= {(user, item) for _, item in sorted((round(s, 12) + 0.0, item) for s, item in scored)[:5]}
    got = best_items(
        spark.createDataFrame(users, "user int, u array<double>"),
        spark.createDataFrame(items, "item int, v array<double>"), 3, 5, first, growth, part,
    ).collect()
    assert {(r.user, r.item) for r in got} == expected and len(got) == len(expected)


def test_best_items_of_nothing(spark):
    none, some = spark.createDataFrame([], "item int, v array<double>"), spark.createDataFrame([(1, [1.0])], "user int, u array<double>")
    assert best_items(some, none, 1).collect() == []
    assert best_items(some.where("user = 0"), none.union(some), 1).collect() == []


def test_fitted_users_solve_their_equations(spark):
    rng = random.Random(3)
    rows_ = [(rng.randrange(40), rng.randrange(25), rng.randint(1, 5)) for _ in range(900)]
    frame = spark.createDataFrame([*rows_, (None, 1, 2), (1, None, 2)], "u int, i int, r int")
    model = models.fit_recommender(frame, "u", "i", "r")
    found = models.normal_residuals(model, frame, "r").collect()
    assert sum(r.n for r in found) == 900 and max(r.residual for r in found) < 1e-4
    # With another penalty the equations are not those that were solved.
    assert max(r.residual for r in models.normal_residuals(model, frame, "r", 0.5).collect()) > 1e-2


def test_a_tree_as_columns_equals_the_model(spark):
    rng = random.Random(5)
    data = [(rng.random() * 9, float(rng.randint(0, 40)), rng.choice([0.0, 1.0]), rng.random()) for _ in range(800)]
    frame = spark.createDataFrame([(*r, 5 * r[0] + r[1] * r[2] + r[3]) for r in data], "a double, b double, c double, d double, y double")
    columns = ["a", "b", "c", "d"]
    model = models.fit_tree(models.assemble(frame, columns, "y"), maxDepth=7)
    tree = trees.tree_of(model)
    scored = model.transform(models.assemble(frame, columns, "y", *columns))
    assert scored.where(trees.prediction_of(tree, columns) != F.col("prediction")).count() == 0
    found = trees.leaves(frame, tree, columns, "y").collect()
    assert len(found) == model.numNodes - len(trees.inner_nodes(tree)) and sum(r.n for r in found) == 800
    assert all(r.prediction == pytest.approx(r.mean) for r in found)
    splits = {r.node: r for r in trees.splits(frame, tree, columns).collect()}
    assert set(splits) == {n.place for n in trees.inner_nodes(tree)} and splits[1].below + splits[1].above == 800
    for node in trees.inner_nodes(tree):
        for child, n in ((node.left, splits[node.place].below), (node.right, splits[node.place].above)):
            if child.left is not None:
                assert splits[child.place].below + splits[child.place].above == n


def test_a_tree_of_one_leaf(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "x double, y double")
    tree = trees.tree_of(models.fit_tree(models.assemble(frame, ["x"], "y")))
    assert rows(trees.leaves(frame, tree, ["x"], "y")) == [(1, 2, 2.0, 2.0)]
    assert trees.splits(frame, tree, ["x"]).collect() == []
