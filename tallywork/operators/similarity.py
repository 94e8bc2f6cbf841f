"""Item-to-item similarity from the users that rated both items.

The work is the sum over users of (items rated)^2, so a user with very many items is the danger.
Three things keep it in hand, none of which changes a result:

* Item filters run before pairing, not after.
* Most questions ask for pairs with more than ``pairs_over`` common users. Then each item may
  leave out its ``pairs_over`` busiest users while pairs are looked for: a pair whose common users
  are all left out by one of its items has too few of them anyway. What the left-out users add is
  joined back for the pairs that were found. This is the prefix filter of set-similarity joins.
* Rows of users with more than ``busy`` items are cut into a grid of groups of about ``busy`` rows a side, in the same
  plan as the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.functions.scalars import other_of_pair, ratio_or_zero
from tallywork.operators.aggregates import with_names
from tallywork.operators.splits import RANKS_IN_MAP_TASKS
from tallywork.session import materialise
from tallywork.sinks import look_up, save_for_lookup

BUSY_USER_ITEMS = 1_000


def _rows(ratings: DataFrame, user: str, item: str, rating: str, rating_over: float | None) -> DataFrame:
    """(user, item, value) of the rows that count."""
    given = F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull()
    rows = ratings.filter(given).select(
        F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("value")
    )
    return rows if rating_over is None else rows.filter(F.col("value") > rating_over)


def _per_user_item(rows: DataFrame) -> DataFrame:
    """(user, item, c, s, q): count, sum and sum of squares, one row also where ratings repeat."""
    return rows.groupBy("user", "item").agg(
        F.count("*").alias("c"),
        F.sum("value").alias("s"),
        F.sum(F.col("value") * F.col("value")).alias("q"),
    )


def _as_sets(rows: DataFrame) -> DataFrame:
    """(user, item, c=1): who rated what, for measures on sets."""
    return rows.select("user", "item").distinct().withColumn("c", F.lit(1).cast("long"))


def _products(cosine: bool) -> dict[str, Column]:
    """What one common user adds to a pair; sides are ``a`` (item1) and ``b`` (item2)."""
    sums = {"n": F.col("a_c") * F.col("b_c")}
    if cosine:
        sums["xx"] = F.col("a_q") * F.col("b_c")
        sums["yy"] = F.col("a_c") * F.col("b_q")
        sums["xy"] = F.col("a_s") * F.col("b_s")
    return sums


def _add_up(pairs: DataFrame, sums: dict[str, Column]) -> DataFrame:
    return pairs.groupBy("item1", "item2").agg(*[F.sum(part).alias(name) for name, part in sums.items()])


def _pair_sums(rated: DataFrame, pairs_over: int, cosine: bool, busy: int) -> DataFrame:
    """(item1, item2, n[, xx, yy, xy]) with item1 < item2 and n > pairs_over."""
    # Written once: what follows reads both sides of the self-join from it.
    rated = materialise(rated, "rated")
    sums = _products(cosine)
    sizes = rated.groupBy("user").agg(F.count("*").alias("items"), F.max("c").alias("most"))
    hot = materialise(sizes.filter(F.col("items") > busy), "busy-users")
    if hot.isEmpty():
        found = _add_up(_plain_pairs(rated), sums)
        return found.filter(F.col("n") > pairs_over) if pairs_over else found
    if pairs_over == 0:
        return _add_up(_all_pairs(rated, hot, busy), sums)

    left_out = materialise(_busiest(rated, hot, pairs_over), "left-out")
    kept = materialise(rated.join(left_out, ["user", "item"], "left_anti"), "kept")
    found = materialise(_add_up(_all_pairs(kept, hot, busy), sums), "found")

    # A common user counts once: where item1 left it out, or else where only item2 did.
    ids = found.select("item1", "item2")
    first = (
        ids.join(left_out.alias("a"), F.col("item1") == F.col("a.item"))
        .join(rated.alias("b"), (F.col("a.user") == F.col("b.user")) & (F.col("item2") == F.col("b.item")))
        .select("item1", "item2", *_sides(rated))
    )
    second = (
        ids.join(left_out.alias("b"), F.col("item2") == F.col("b.item"))
        .join(kept.alias("a"), (F.col("a.user") == F.col("b.user")) & (F.col("item1") == F.col("a.item")))
        .select("item1", "item2", *_sides(rated))
    )
    totals = found.unionByName(_add_up(first, sums)).unionByName(_add_up(second, sums))
    return _add_up(totals, {name: F.col(name) for name in sums}).filter(F.col("n") > pairs_over)


def _plain_pairs(rated: DataFrame) -> DataFrame:
    """The self-join by user."""
    pairs = rated.alias("a").join(
        rated.alias("b"),
        (F.col("a.user") == F.col("b.user")) & (F.col("a.item") < F.col("b.item")),
    )
    return pairs.select(F.col("a.item").alias("item1"), F.col("b.item").alias("item2"), *_sides(rated))


def _all_pairs(rated: DataFrame, hot: DataFrame, busy: int) -> DataFrame:
    """The self-join by user: users of up to ``busy`` items in one group each, the others in a grid of groups.

    Both kinds are in one plan. There are few busy users (at most the rows over ``busy``), so that their ids are mostly
    broadcast, and rows of the others are shuffled once for both sides of the join.
    """
    rest = rated.join(hot.select("user"), "user", "left_anti")
    ids = [F.col("a.item").alias("item1"), F.col("b.item").alias("item2")]
    return _plain_pairs(rest).union(_grid_pairs(rated, hot, busy).select(*ids, *_sides(rated)))


def _sides(rated: DataFrame) -> list[Column]:
    """What both sides of a pair bring, as a_c, b_c and so on."""
    return [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "ab" for c in rated.columns[2:]]


def _busiest(rated: DataFrame, hot: DataFrame, pairs_over: int) -> DataFrame:
    """Per item, the busiest users whose common ratings cannot add up to more than ``pairs_over``.

    The rank filter comes first: it works in the map tasks, so no item is gathered whole. That is
    so up to ``RANKS_IN_MAP_TASKS``; leaving out fewer users than possible is never wrong.
    """
    by_item = Window.partitionBy("item").orderBy(F.desc("items"), F.desc("user"))
    so_far = by_item.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rated.join(hot, "user")
        .withColumn("_rank", F.row_number().over(by_item))
        .filter(F.col("_rank") <= min(pairs_over, RANKS_IN_MAP_TASKS))
        .withColumn("_could_add", F.sum(F.col("c") * F.col("most")).over(so_far))
        .filter(F.col("_could_add") <= pairs_over)
        .select(*rated.columns)
    )


def _grid_pairs(rated: DataFrame, hot: DataFrame, busy: int) -> DataFrame:
    """The self-join of busy users, with the rows of each in a grid of groups of about ``busy``."""
    cells = F.ceil(F.col("items") / busy).cast("int")
    cut = (
        rated.join(hot.select("user", "items"), "user")
        .withColumn("_cells", cells)
        .withColumn("_mine", F.pmod(F.xxhash64("item"), F.col("_cells")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)))
        .drop("items", "_cells")
    )
    return cut.alias("a").join(
        cut.alias("b"),
        (F.col("a.user") == F.col("b.user"))
        & (F.col("a._mine") == F.col("b._other"))
        & (F.col("a._other") == F.col("b._mine"))
        & (F.col("a.item") < F.col("b.item")),
    )


def common_raters(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    rating_over: float | None = None,
    pairs_over: int = 0,
    busy: int = BUSY_USER_ITEMS,
) -> DataFrame:
    """(item1, item2, n): how many rated both, item1 < item2, n > pairs_over."""
    return _pair_sums(_as_sets(_rows(ratings, user, item, rating, rating_over)), pairs_over, False, busy)


def jaccard_pairs(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    rating_over: float | None = 3,
    item_count_over: int = 10,
    pairs_over: int = 1,
    busy: int = BUSY_USER_ITEMS,
) -> DataFrame:
    """(item1, item2, n, count1, count2, score) with score = n / (count1 + count2 - n).

    Only items with more than ``item_count_over`` users and pairs with more than ``pairs_over``.
    """
    rated = _as_sets(_rows(ratings, user, item, rating, rating_over))
    # Written because it is used three times; by its size a small one is broadcast, and then the
    # item filter leaves the rows where they are.
    counts = materialise(
        rated.groupBy("item").agg(F.count("*").alias("count")).filter(F.col("count") > item_count_over), "counts"
    )
    frequent = rated.join(counts.select("item"), "item", "left_semi")
    pairs = _pair_sums(frequent, pairs_over, False, busy)
    return (
        pairs.join(counts.select(F.col("item").alias("item1"), F.col("count").alias("count1")), "item1")
        .join(counts.select(F.col("item").alias("item2"), F.col("count").alias("count2")), "item2")
        .select(
            "item1",
            "item2",
            "n",
            "count1",
            "count2",
            (F.col("n") / (F.col("count1") + F.col("count2") - F.col("n"))).alias("score"),
        )
    )


def cosine_pairs(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    rating_over: float | None = None,
    pairs_over: int = 0,
    busy: int = BUSY_USER_ITEMS,
) -> DataFrame:
    """(item1, item2, n, score): cosine of the two rating vectors over their common users.

    A user that rated an item several times counts with every combination of those ratings.
    """
    rows = _rows(ratings, user, item, rating, rating_over)
    sums = _pair_sums(_per_user_item(rows), pairs_over, True, busy)
    return sums.select("item1", "item2", "n", _cosine())


def _cosine() -> Column:
    return ratio_or_zero(F.col("xy"), F.sqrt("xx") * F.sqrt("yy")).alias("score")


def _best(scored: DataFrame, k: int) -> DataFrame:
    return scored.orderBy(F.desc("score"), F.desc("n"), "item").limit(k)


def both_directions(pairs: DataFrame) -> DataFrame:
    """(item, partner, n, score): every pair once from either item."""
    one = pairs.select(F.col("item1").alias("item"), F.col("item2").alias("partner"), "n", "score")
    return one.union(pairs.select(F.col("item2").alias("item"), F.col("item1").alias("partner"), "n", "score"))


def top_partners_per_item(pairs: DataFrame, k: int = 10) -> DataFrame:
    """(item, partner, n, score, rank): the ``k`` best partners of every item of a pair table.

    Ties go to more common users, then to the smaller partner. The rank filter works in the map tasks (for k up to
    ``RANKS_IN_MAP_TASKS``), so what is shuffled is at most k rows per item and task.
    """
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.desc("n"), "partner")
    return both_directions(pairs).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def save_pairs(pairs: DataFrame, path: str, buckets: int = 64) -> None:
    """Save a pair table in both directions, laid out for ``similar_in_saved``."""
    save_for_lookup(both_directions(pairs), path, "item", buckets, [F.desc("score")])


def similar_in_saved(
    spark: SparkSession,
    path: str,
    target: object,
    score_over: float,
    pairs_over: float = 50,
    k: int = 10,
    names: DataFrame | None = None,
    names_key: str = "movie_id",
    name: str = "title",
) -> DataFrame:
    """Best partners of one item from a table of ``save_pairs``, of which only the item's folder is read."""
    own = look_up(spark, path, "item", target).filter((F.col("score") > score_over) & (F.col("n") > pairs_over))
    return _named(_best(own.select(F.col("partner").alias("item"), "score", "n"), k), names, names_key, name)


def similar_in_table(
    pairs: DataFrame,
    target: object,
    score_over: float,
    pairs_over: float = 50,
    k: int = 10,
    names: DataFrame | None = None,
    names_key: str = "movie_id",
    name: str = "title",
) -> DataFrame:
    """Best partners of one item from a pair table that exists already (a saved one, say)."""
    scored = pairs.filter(
        ((F.col("item1") == target) | (F.col("item2") == target))
        & (F.col("score") > score_over)
        & (F.col("n") > pairs_over)
    ).select(other_of_pair(F.col("item1"), F.col("item2"), target).alias("item"), "score", "n")
    return _named(_best(scored, k), names, names_key, name)


def similar_by_jaccard(
    ratings: DataFrame,
    target: object,
    user: str,
    item: str,
    rating: str,
    rating_over: float | None = 3,
    item_count_over: int = 10,
    score_over: float = 0.30,
    pairs_over: float = 50,
    k: int = 10,
    names: DataFrame | None = None,
    names_key: str = "movie_id",
    name: str = "title",
) -> DataFrame:
    """Best partners of one item without building the pair table.

    The ratings of the item's own users are counted by item, without pairing them with each other:
    linear in the ratings. User counts are then taken for the items still in question only.
    """
    rows = _rows(ratings, user, item, rating, rating_over)
    own = materialise(rows.filter(F.col("item") == target).select("user").distinct(), "own-users")
    common = materialise(
        rows.filter(F.col("item") != target)
        .join(own, "user", "left_semi")
        .groupBy("item")
        .agg(F.count_distinct("user").alias("n"))
        .filter((F.col("n") > pairs_over) & (F.col("n") > 1)),
        "common",
    )
    counts = (
        rows.join(common, "item")
        .groupBy("item")
        .agg(F.count_distinct("user").alias("count"), F.max("n").alias("n"))
        .filter(F.col("count") > item_count_over)
    )
    scored = (
        counts.withColumn("own", own.select(F.count("*")).scalar())
        .filter(F.col("own") > item_count_over)
        .select("item", (F.col("n") / (F.col("own") + F.col("count") - F.col("n"))).alias("score"), "n")
        .filter(F.col("score") > score_over)
    )
    return _named(_best(scored, k), names, names_key, name)


def similar_by_cosine(
    ratings: DataFrame,
    target: object,
    user: str,
    item: str,
    rating: str,
    rating_over: float | None = None,
    score_over: float = 0.97,
    pairs_over: float = 50,
    k: int = 10,
    names: DataFrame | None = None,
    names_key: str = "movie_id",
    name: str = "title",
) -> DataFrame:
    """Best partners of one item by cosine, without building the pair table.

    Each rating of the item's users adds to the sums of its item. If those users are few enough to
    broadcast, the ratings are not shuffled before they are summed.
    """
    rows = _rows(ratings, user, item, rating, rating_over)
    own = materialise(_per_user_item(rows.filter(F.col("item") == target)).drop("item"), "own-users")
    value = F.col("value")
    scored = (
        rows.filter(F.col("item") != target)
        .join(own, "user")
        .groupBy("item")
        .agg(
            F.sum("c").alias("n"),
            F.sum("q").alias("xx"),
            F.sum(F.col("c") * value * value).alias("yy"),
            F.sum(F.col("s") * value).alias("xy"),
        )
        .select("item", _cosine(), "n")
        .filter((F.col("score") > score_over) & (F.col("n") > pairs_over))
    )
    return _named(_best(scored, k), names, names_key, name)


def _named(best: DataFrame, names: DataFrame | None, names_key: str, name: str) -> DataFrame:
    if names is None:
        return best
    return with_names(best, names, "item", names_key, name).orderBy(F.desc("score"), F.desc("n"), "item")
