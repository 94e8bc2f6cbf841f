from decimal import Decimal

import pytest

from helpers import rows
from tallywork.operators import aggregates, queries


def test_popular_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in (3, 3, 2, 2, 1, 4, 4, 4)], ["k"])
    assert [tuple(r) for r in aggregates.popular(df, "k", 2).collect()] == [(4, 3), (2, 2)]


def test_popular_named_keeps_keys_without_a_name(spark):
    df = spark.createDataFrame([(k,) for k in (1, 1, 2)], ["k"])
    names = spark.createDataFrame([(1, "one")], ["id", "title"])
    got = aggregates.popular_named(df, "k", names, "id", "title").collect()
    assert [tuple(r) for r in got] == [(1, 2, "one"), (2, 1, None)]


def test_average_is_a_true_division(spark):
    df = spark.createDataFrame([(33, 1), (33, 2), (20, 5)], ["age", "friends"])
    assert [tuple(r) for r in aggregates.average_by_key(df, "age", "friends").collect()] == [(20, 5.0), (33, 1.5)]


def test_spend_is_exact_in_either_order(spark):
    df = spark.createDataFrame([(1, 0.1)] * 10 + [(2, 0.25), (3, 1.0)], ["c", "a"])
    falling = [tuple(r) for r in aggregates.spend_by_customer(df, "c", "a").collect()]
    assert falling == [(1, Decimal("1.00")), (3, Decimal("1.00")), (2, Decimal("0.25"))]
    rising = [r.c for r in aggregates.spend_by_customer(df, "c", "a", ascending=True).collect()]
    assert rising == [2, 1, 3]


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame(
        [
            ("A", "TMIN", -75.0),
            ("A", "TMIN", -150.0),
            ("A", "TMAX", 100.0),
            ("A", "XTMIN", -999.0),
            ("B", "TMIN", 0.0),
            ("C", "TMAX", 10.0),
        ],
        ["station", "kind", "t"],
    )


def test_extremes(weather):
    assert rows(aggregates.lowest_by_key(weather, "station", "kind", "t")) == [("A", 5.0), ("B", 32.0)]
    assert rows(aggregates.highest_by_key(weather, "station", "kind", "t")) == [("A", 50.0), ("C", 33.8)]
    both = aggregates.extremes_by_key(weather, "station", "kind", "t")
    assert rows(both) == [("A", 5.0, 50.0)]


def test_small_queries(spark):
    people = spark.createDataFrame([("a", 12), ("b", 13), ("c", 19), ("d", 20), ("e", 21)], ["name", "age"])
    assert rows(queries.in_range(people, "age", 13, 19)) == [("b", 13), ("c", 19)]
    assert [r.name for r in queries.below(people, "age", 21).collect()] == ["a", "b", "c", "d"]
    assert rows(queries.shifted(people, "name", "age", 10))[0] == ("a", 22)
    assert queries.shifted(people, "name", "age", 10).columns == ["name", "age_plus_10"]
    assert rows(queries.containing(people, "name", "b")) == [("b", 13)]
    other = people.withColumn("age", people.age + 100)
    first, second = queries.in_range(people, "age", 0, 200), queries.in_range(other, "age", 0, 200)
    assert first.count() == second.count() == 5
    assert rows(first) != rows(second)
