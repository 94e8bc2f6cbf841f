import math
import random
from collections import defaultdict
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallywork.operators import similarity

COLUMNS = {"user": "u", "item": "i", "rating": "r"}


def frame(spark, ratings):
    return spark.createDataFrame(ratings, "u long, i long, r double")


def plain_pairs(ratings):
    """(item1, item2) -> [(rating1, rating2), ...] over every combination of rows."""
    by_user = defaultdict(list)
    for user, item, rating in ratings:
        by_user[user].append((item, rating))
    pairs = defaultdict(list)
    for rated in by_user.values():
        for (i, x), (j, y) in combinations(sorted(rated), 2):
            if i < j:
                pairs[i, j].append((x, y))
    return pairs


def plain_cosine(ratings, pairs_over=0):
    out = {}
    for key, both in plain_pairs(ratings).items():
        den = math.sqrt(sum(x * x for x, _ in both)) * math.sqrt(sum(y * y for _, y in both))
        if len(both) > pairs_over:
            out[key] = (len(both), sum(x * y for x, y in both) / den if den else 0.0)
    return out


def plain_jaccard(ratings, rating_over, item_count_over, pairs_over):
    users = defaultdict(set)
    for user, item, rating in ratings:
        if rating > rating_over:
            users[item].add(user)
    out = {}
    for i, j in combinations(sorted(users), 2):
        n = len(users[i] & users[j])
        if len(users[i]) > item_count_over and len(users[j]) > item_count_over and n > pairs_over:
            out[i, j] = (n, len(users[i]), len(users[j]), n / len(users[i] | users[j]))
    return out


def by_pair(df):
    return {(r.item1, r.item2): tuple(r)[2:] for r in df.collect()}


def same(got, expected):
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values, abs=1e-12)


def skewed_ratings(seed, repeats=False):
    """Two users that rated nearly everything hold more than half of the rows."""
    draw = random.Random(seed)
    ratings = [(u, i, float(draw.randint(0, 5))) for u in (1, 2) for i in range(40) if draw.random() < 0.95]
    for user in range(3, 25):
        ratings += [(user, i, float(draw.randint(0, 5))) for i in draw.sample(range(40), 3)]
    if repeats:
        ratings += [(u, i, float(draw.randint(1, 5))) for u, i, _ in draw.sample(ratings, 25)]
    return ratings


@pytest.mark.parametrize("pairs_over", [0, 1, 2, 5])
@pytest.mark.parametrize("busy", [2, 7, 10_000])
@pytest.mark.parametrize("repeats", [False, True])
def test_cosine_equals_brute_force_however_users_are_handled(spark, pairs_over, busy, repeats):
    ratings = skewed_ratings(pairs_over, repeats)
    got = similarity.cosine_pairs(frame(spark, ratings), **COLUMNS, pairs_over=pairs_over, busy=busy)
    same(by_pair(got), plain_cosine(ratings, pairs_over))


@pytest.mark.parametrize("busy", [3, 10_000])
@pytest.mark.parametrize("limits", [(3, 2, 1), (1, 0, 0), (2, 1, 2)])
def test_jaccard_equals_brute_force(spark, busy, limits):
    rating_over, item_count_over, pairs_over = limits
    ratings = skewed_ratings(11)
    got = similarity.jaccard_pairs(
        frame(spark, ratings), **COLUMNS, rating_over=rating_over, item_count_over=item_count_over,
        pairs_over=pairs_over, busy=busy,
    )
    same(by_pair(got), plain_jaccard(ratings, rating_over, item_count_over, pairs_over))


def test_busy_users_leave_few_pairs_behind(spark):
    """With one huge user and pairs of more than one rater, that user's own pairs are never made."""
    ratings = [(1, i, 1.0) for i in range(200)] + [(2, 0, 1.0), (2, 1, 1.0)]
    rated = similarity._per_user_item(similarity._rows(frame(spark, ratings), "u", "i", "r", None))
    sizes = spark.createDataFrame([(1, 200, 1)], "user long, items long, most long")
    left_out = similarity._busiest(rated, sizes, 1)
    assert left_out.count() == 200
    kept = rated.join(left_out, ["user", "item"], "left_anti")
    assert similarity._all_pairs(kept, sizes, 10).count() == 1
    got = similarity.cosine_pairs(frame(spark, ratings), **COLUMNS, pairs_over=1, busy=10)
    assert by_pair(got) == {(0, 1): (2, pytest.approx(1.0))}


def test_groups_of_busy_users_are_bounded(spark):
    """A user of 400 items at ``busy`` 50 meets itself in groups of about 50 by 50."""
    rated = similarity._as_sets(similarity._rows(frame(spark, [(1, i, 1.0) for i in range(400)]), "u", "i", "r", None))
    sizes = spark.createDataFrame([(1, 400, 1)], "user long, items long, most long")
    pairs = similarity._grid_pairs(rated, sizes, 50)
    groups = pairs.groupBy("a._mine", "a._other").count().collect()
    assert sum(r["count"] for r in groups) == 400 * 399 // 2
    assert len(groups) == 64 and max(r["count"] for r in groups) <= 80 * 80


def test_top_partners(spark):
    pairs = spark.createDataFrame(
        [(1, 2, 5, 0.5), (1, 3, 9, 0.5), (2, 3, 1, 0.9)], "item1 long, item2 long, n long, score double"
    )
    got = [(r.item, r.partner, r["rank"]) for r in similarity.top_partners_per_item(pairs, 1).orderBy("item").collect()]
    assert got == [(1, 3, 1), (2, 3, 1), (3, 2, 1)]


def test_zero_ratings_score_zero(spark):
    got = similarity.cosine_pairs(frame(spark, [(1, 1, 0.0), (1, 2, 3.0)]), **COLUMNS)
    assert by_pair(got) == {(1, 2): (1, 0.0)}


def test_rows_without_a_rating_do_not_count(spark):
    got = similarity.cosine_pairs(frame(spark, [(1, 1, None), (1, 2, 3.0), (1, 3, 1.0)]), **COLUMNS)
    assert set(by_pair(got)) == {(2, 3)}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.integers(0, 6), st.integers(0, 8)), st.integers(1, 5).map(float), min_size=1, max_size=40
    )
)
def test_any_ratings(spark, table):
    ratings = [(u, i, r) for (u, i), r in table.items()]
    got = by_pair(similarity.cosine_pairs(frame(spark, ratings), **COLUMNS, pairs_over=1, busy=3))
    same(got, plain_cosine(ratings, 1))
    assert all(0 <= score <= 1 + 1e-12 for _, score in got.values())


def test_one_item_equals_its_part_of_the_pair_table(spark):
    ratings = frame(spark, skewed_ratings(5)).cache()
    names = spark.createDataFrame([(i, f"item {i}") for i in range(30)], ["movie_id", "title"])
    pairs = similarity.cosine_pairs(ratings, **COLUMNS)
    from_table = similarity.similar_in_table(pairs, 7, 0.5, 1, names=names).collect()
    direct = similarity.similar_by_cosine(
        ratings, 7, **COLUMNS, score_over=0.5, pairs_over=1, names=names
    ).collect()
    assert len(direct) == 10
    assert [(r.item, r.n, r.title) for r in direct] == [(r.item, r.n, r.title) for r in from_table]

    sets = {"rating_over": 1, "item_count_over": 2}
    pairs = similarity.jaccard_pairs(ratings, **COLUMNS, **sets)
    from_table = similarity.similar_in_table(pairs, 7, 0.05, 1).collect()
    direct = similarity.similar_by_jaccard(ratings, 7, **COLUMNS, **sets, score_over=0.05, pairs_over=1).collect()
    assert direct == from_table and direct


def test_an_item_with_too_few_users_has_no_partners(spark):
    ratings = frame(spark, [(u, i, 5.0) for u in range(20) for i in (1, 2)] + [(1, 3, 5.0), (2, 3, 5.0)])
    got = similarity.similar_by_jaccard(ratings, 3, **COLUMNS, pairs_over=1, score_over=0.0)
    assert got.collect() == []


def test_a_saved_table_reads_one_folder(spark, tmp_path):
    ratings = frame(spark, skewed_ratings(5))
    pairs = similarity.cosine_pairs(ratings, **COLUMNS)
    path = str(tmp_path / "pairs")
    similarity.save_pairs(pairs, path, buckets=8)
    for target in (7, 3, 999):
        found = similarity.similar_in_saved(spark, path, target, 0.5, 1)
        assert found.collect() == similarity.similar_in_table(pairs, target, 0.5, 1).collect()
        text = found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert "PartitionFilters" in text and "substring_index" in text.split("PartitionFilters")[1].split("\n")[0]
        assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 8
    read = spark.read.parquet(path).where("item = 7").select("_bucket").distinct().collect()
    assert len(read) == 1 and read[0][0].endswith("-8")


def test_inputs_are_read_from_one_written_table(spark):
    """Without busy users there is no anti-join and no grid in the plan."""
    text = similarity.cosine_pairs(frame(spark, skewed_ratings(5)), **COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in text and "Union" not in text and "sequence" not in text
