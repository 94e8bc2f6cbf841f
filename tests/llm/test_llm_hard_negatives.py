"""Hard negatives against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.llm import hard_negatives
from tallywork.llm.hard_negatives import Settings, best, from_embeddings, mine, scores


def plain(rows, anchors, settings):
    """rows, anchors: (vec_id, vector, label) with distinct ids."""
    out = []
    for anchor, v, label in anchors:
        scored = [
            (-sum(a * b for a, b in zip(v, w)), key, other)
            for key, w, other in rows
            if key != anchor and len(w) == len(v)
        ]
        scored.sort(key=lambda r: r[:2])
        positives = [(key, -s) for s, key, other in scored if other == label][: settings.positives]
        for key, p in positives:
            fit = [
                (k, -s) for s, k, other in scored
                if other != label and settings.low * p <= -100 * s <= settings.high * p
            ]
            out += [(anchor, key, i, k, p, s) for i, (k, s) in enumerate(fit[: settings.k], 1)]
    return sorted(out)


def vectors(seed, n=400, size=6, spread=40):
    """Small numbers, so that ties are many; a third of the rows are one vector; labels of very different sizes."""
    rng = random.Random(seed)
    same = [rng.randint(1, spread) for _ in range(size)]
    return [
        (i, list(same) if rng.random() < 0.33 else [rng.randint(-spread // 4, spread) for _ in range(size)], rng.choice([1, 1, 1, 2, 3, 4]))
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "settings",
    [Settings(), Settings(numbers=300, together=3), Settings(positives=9, k=3, low=80, high=100), Settings(positives=1, k=1, low=0, high=60)],
)
def test_negatives_equal_plain_python(spark, settings):
    rows = vectors(1) + [(900, [1, 2], 1), (901, [3, 4], 1), (902, [5, 1], 2), (903, [2, 2], 2), (904, [9], 7)]
    anchors = [r for r in rows if r[0] % 25 == 0 or r[0] >= 900]
    frame = spark.createDataFrame([(*r, 0, 0, "x") for r in rows], "vec_id long, vector array<long>, label long, rank int, block int, slot string")
    got = mine(frame.repartition(5), frame.where("vec_id % 25 = 0 or vec_id >= 900"), settings=settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, anchors, settings)


def test_scores_below_zero_and_none(spark):
    rows = [(0, [10, 0], 1), (1, [-5, 0], 1), (2, [-3, 0], 2), (3, [0, 5], 1), (4, [0, 1], 2), (100, [0, 0], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>, label long")
    got = sorted(tuple(r) for r in mine(frame, frame.where("vec_id % 100 = 0")).collect())
    # Below zero a window is empty; at zero it holds zeros only. Anchor 100 has no positive.
    assert got == plain(rows, [rows[0], rows[5]], Settings()) == [(0, 3, 1, 4, 0, 0), (0, 3, 2, 100, 0, 0)]


def test_odd_rows(spark):
    """Nulls, repeated rows, huge components and empty vectors."""
    schema = "vec_id long, embedding array<double>, label int, n int"
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 1, 0), (1, [0.9, 0.5], 1, 0), (2, [0.5, 0.25], 2, 0), (None, [0.5, 0.25], 2, 0)]
    odd = [(200, None, 1, 0), (3, [nan, 1.0], 1, 0), (4, [1.0, inf], 2, 0), (5, [None, 1.0], 1, 0), (6, [1.0, 1.0], None, 0), (300, [], 1, 0)]
    frame = spark.createDataFrame(good + odd + [good[0], good[2]], schema)
    rows = from_embeddings(frame)
    got = [tuple(r) for r in mine(rows, rows.where("vec_id % 100 = 0")).collect()]
    top = 256 * 230 + 128 * 128
    assert sorted(got, key=repr) == sorted([(0, 1, 1, 2, top, 128 * 256 + 64 * 128), (0, 1, 2, None, top, 128 * 256 + 64 * 128)], key=repr)
    huge = [(0, [1e300, 1.0], 1), (1, [1e300, -1e300], 1), (2, [1e300, 1e300], 2)]
    rows = from_embeddings(spark.createDataFrame(huge, "vec_id long, embedding array<double>, label int"))
    assert mine(rows, rows.where("vec_id = 0")).count() >= 0
    none = from_embeddings(frame.limit(0))
    assert mine(none, none).collect() == []
    assert mine(from_embeddings(frame), none).collect() == []


def test_floor_of_negative_components(spark):
    rows = from_embeddings(spark.createDataFrame([(1, [-0.001, 0.0, 1.0, -1.0], 1)], "vec_id long, embedding array<float>, label int"))
    assert rows.first().vector == [-1, 0, 256, -256]


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for most in (200, 1 << 28):
        a, b = rng.integers(-most, most, (5, 64)), rng.integers(-most, most, (7, 64))
        assert scores(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, q)) for r in a] for q in b]


def test_best_keeps_ties_in_order():
    values = np.array([5, 7, 7, 3, 7, 7])
    assert best(values, np.array([0, 1, 2, 4, 5]), 3).tolist() == [1, 2, 4]
    assert best(values, np.array([3, 0]), 3).tolist() == [0, 3]


def test_slots_are_cut_in_the_map_tasks(spark):
    rows = spark.createDataFrame(vectors(2, 60), "vec_id long, vector array<long>, label long")
    text = mine(rows, rows.where("vec_id % 20 = 0"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    near = hard_negatives._first(spark.range(9).selectExpr("id % 2 AS node", "id AS score", "id", "id AS other"), ["node"], 2)
    assert "WindowGroupLimit" in near._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.node, r.id) for r in near.withColumn("x", F.lit(1)).collect()) == [(0, 6), (0, 8), (1, 5), (1, 7)]
