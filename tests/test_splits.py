import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallywork.operators import splits


@pytest.mark.parametrize("n,k", [(100, 5), (103, 5), (3, 5), (17, 4)])
def test_folds_are_contiguous_disjoint_and_even(spark, n, k):
    df = spark.range(n).selectExpr("id * 37 % 1009 AS v").repartition(4)
    got = splits.assign_folds(df, ["v"], k).orderBy("v").collect()
    expected = []
    for fold in range(k):
        expected += [fold + 1] * (n // k + (1 if fold < n % k else 0))
    assert [r.fold for r in got] == expected


@pytest.mark.parametrize("seed", range(3))
def test_folds_by_several_columns_with_ties_and_nulls(spark, seed):
    """A third of the rows share one value, some have none; the second column tells rows apart."""
    draw = random.Random(seed)
    data = [(draw.choice([None, 7.0, 7.0, draw.random() * 20, float("nan")]), i, "x") for i in range(900)]
    df = spark.createDataFrame(data, "a double, b int, kept string").repartition(5)
    for order_by in (["a", "b"], ["kept", "b"]):
        got = splits.assign_folds(df, order_by, 7)
        assert got.columns == ["a", "b", "kept", "fold"]
        expected = [fold + 1 for fold in range(7) for _ in range(900 // 7 + (fold < 900 % 7))]
        assert [r.fold for r in got.orderBy(*order_by).collect()] == expected


def test_folds_move_no_rows(spark):
    df = spark.range(1000).withColumn("wide", F.lit("x"))
    text = splits.assign_folds(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    main = text.split("Subqueries")[0]
    assert "Sort" not in main.splitlines()[0] and "Exchange" not in main.split("ReusedSubquery")[0].split("Subquery")[0]
    assert splits.assign_folds(df.limit(0), ["id"]).collect() == []


def test_fold_pair(spark):
    folds = splits.assign_folds(spark.range(10), ["id"], 5)
    base, test = splits.fold_pair(folds, 2)
    assert rows(test) == [(2,), (3,)]
    assert base.count() == 8 and base.columns == ["id"]


def plain_holdout(data, start, stop, max_test):
    seen, taken, out = {}, 0, []
    for seq, user in data:
        seen[user] = seen.get(user, 0) + 1
        test = start <= seen[user] <= stop and (max_test <= 0 or taken < max_test)
        taken += test
        out.append((seq, user, test))
    return out


@pytest.mark.parametrize("ranks", [1000, 2])
@pytest.mark.parametrize("start,stop,max_test", [(1, 10, 0), (3, 5, 0), (1, 10, 25), (11, 20, 7)])
def test_holdout_equals_a_plain_walk(spark, monkeypatch, start, stop, max_test, ranks):
    monkeypatch.setattr(splits, "RANKS_IN_MAP_TASKS", ranks)
    draw = random.Random(3)
    users = [1 if draw.random() < 0.4 else draw.randrange(2, 12) for _ in range(200)]
    data = list(enumerate(users))
    df = spark.createDataFrame(data, ["seq", "user"]).repartition(4)
    got = splits.holdout_per_user(df, "user", ["seq"], start, stop, max_test)
    assert [tuple(r) for r in got.orderBy("seq").collect()] == plain_holdout(data, start, stop, max_test)


def test_holdout_ranks_in_the_map_tasks(spark, tmp_path):
    spark.range(100).selectExpr("id AS seq", "id % 3 AS user").write.parquet(str(tmp_path / "t"))
    got = splits.holdout_per_user(spark.read.parquet(str(tmp_path / "t")), "user", ["seq"])
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_random_parts(spark):
    first, second = splits.random_parts(spark.range(1000), [0.5, 0.5], ["id"], seed=1)
    assert first.count() + second.count() == 1000
    assert first.intersect(second).count() == 0
    assert 400 < first.count() < 600


def test_random_parts_do_not_follow_the_layout(spark):
    parts = [
        [r.id for r in splits.random_parts(spark.range(500).repartition(n), [0.3, 0.7], ["id"])[0].orderBy("id").collect()]
        for n in (2, 8)
    ]
    assert parts[0] == parts[1]
    other = splits.random_parts(spark.range(500), [0.3, 0.7], ["id"], seed=7)[0]
    assert sorted(r.id for r in other.collect()) != parts[0]
