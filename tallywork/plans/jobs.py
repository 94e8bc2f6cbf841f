"""Whole jobs from files. Each takes (spark, paths and settings) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywork import schemas
from tallywork.functions.logs import parse_logs
from tallywork.operators import aggregates, graph, models, queries, similarity, splits, words
from tallywork.session import materialise
from tallywork.sources import adjacency, files
from tallywork.sources.streams import stream_lines
from tallywork.streaming.counts import running_counts, sliding_counts


def _ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    schema = schemas.RATINGS if sep == "\t" else schemas.RATINGS_FRACTIONAL
    return files.read_delimited(spark, path, schema, sep)


def _titles(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    return files.read_delimited(spark, path, schemas.TITLES, sep, encoding="ISO-8859-1")


def rating_histogram(spark, ratings: str) -> DataFrame:
    picked = files.read_lines(spark, ratings).select(files.blank_field(2).alias("rating"))
    return aggregates.histogram(picked, "rating")


def popular_items(spark, ratings: str, titles: str | None = None, k: int = 10) -> DataFrame:
    rated = _ratings(spark, ratings)
    if titles is None:
        return aggregates.popular(rated, "movie_id", k)
    return aggregates.popular_named(rated, "movie_id", _titles(spark, titles), "movie_id", "title", k)


def average_friends(spark, friends: str, header: bool = True) -> DataFrame:
    if header:
        people = files.read_with_header(spark, friends)
    else:
        people = files.read_delimited(spark, friends, schemas.FRIENDS)
    return aggregates.average_by_key(people, "age", "friends")


def spend_by_customer(spark, orders: str, ascending: bool = False) -> DataFrame:
    bought = files.read_delimited(spark, orders, schemas.ORDERS)
    return aggregates.spend_by_customer(bought, "customer_id", "amount_spent", ascending)


def temperatures(spark, weather: str) -> DataFrame:
    measured = files.read_delimited(spark, weather, schemas.WEATHER)
    return aggregates.extremes_by_key(measured, "station_id", "measure_type", "temperature")


def lowest_temperatures(spark, weather: str) -> DataFrame:
    measured = files.read_delimited(spark, weather, schemas.WEATHER)
    return aggregates.lowest_by_key(measured, "station_id", "measure_type", "temperature")


def highest_temperatures(spark, weather: str) -> DataFrame:
    measured = files.read_delimited(spark, weather, schemas.WEATHER)
    return aggregates.highest_by_key(measured, "station_id", "measure_type", "temperature")


def word_count(spark, text: str, mode: str = "ascii", ascending: bool = False) -> DataFrame:
    return words.word_count(files.read_lines(spark, text), mode=mode, ascending=ascending)


def _names(spark: SparkSession, path: str) -> DataFrame:
    return files.read_delimited(spark, path, schemas.NAMES, sep=" ")


def most_connected(spark, lines: str, names: str) -> DataFrame:
    return graph.most_connected(graph.degrees(files.read_lines(spark, lines)), _names(spark, names))


def connected_once(spark, lines: str, names: str) -> DataFrame:
    return graph.of_degree(graph.degrees(files.read_lines(spark, lines)), _names(spark, names))


def least_connected(spark, lines: str, names: str, at_least: int = 0) -> DataFrame:
    return graph.least_connected(graph.degrees(files.read_lines(spark, lines)), _names(spark, names), at_least)


def separation(spark, lines: str, source: int, target: int, rounds: int = 10) -> DataFrame:
    parsed = adjacency.parse_adjacency(files.read_lines(spark, lines))
    return graph.separation(adjacency.edges_of(parsed), source, target, rounds)


def people_aged(spark, friends: str, low: int = 13, high: int = 19) -> DataFrame:
    return queries.in_range(files.read_delimited(spark, friends, schemas.FRIENDS), "age", low, high)


def people_below(spark, friends: str, age: int = 21) -> DataFrame:
    return queries.below(files.read_with_header(spark, friends), "age", age)


def people_per_age(spark, friends: str) -> DataFrame:
    return queries.rows_per_value(files.read_with_header(spark, friends), "age").orderBy("age")


def people_older(spark, friends: str, by: int = 10) -> DataFrame:
    return queries.shifted(files.read_with_header(spark, friends), "name", "age", by)


def _given(**settings: object) -> dict[str, object]:
    """The settings that were given; the others keep the operator's own defaults."""
    return {name: value for name, value in settings.items() if value is not None}


def similar_items(
    spark, ratings: str, titles: str, item: int, measure: str = "jaccard", sep: str = "\t",
    rating_over: float = None, score_over: float = None, pairs_over: float = None, item_count_over: int = None,
    k: int = 10,
) -> DataFrame:
    """The ``k`` best partners of an item; ``sep`` "::" for the fractional layout.

    The thresholds are the measure's own where none is given; ``item_count_over`` is for Jaccard only.
    """
    find = {"jaccard": similarity.similar_by_jaccard, "cosine": similarity.similar_by_cosine}[measure]
    names = _titles(spark, titles, sep="|" if sep == "\t" else sep)
    given = _given(
        rating_over=rating_over, score_over=score_over, pairs_over=pairs_over, item_count_over=item_count_over, k=k
    )
    return find(_ratings(spark, ratings, sep), item, "user_id", "movie_id", "rating", names=names, **given)


def item_pairs(
    spark, ratings: str, measure: str = "cosine", sep: str = "\t",
    rating_over: float = None, pairs_over: int = None, item_count_over: int = None,
) -> DataFrame:
    """The whole pair table, to be saved; thresholds as in ``similar_items``."""
    find = {"jaccard": similarity.jaccard_pairs, "cosine": similarity.cosine_pairs}[measure]
    given = _given(rating_over=rating_over, pairs_over=pairs_over, item_count_over=item_count_over)
    return find(_ratings(spark, ratings, sep), "user_id", "movie_id", "rating", **given)


def top_partners(spark, ratings: str, k: int = 10, measure: str = "cosine", sep: str = "\t") -> DataFrame:
    """The ``k`` best partners of every item, to be saved."""
    return similarity.top_partners_per_item(item_pairs(spark, ratings, measure, sep), k)


def recommendations(spark, ratings: str, titles: str, user: int = None, users: str = None, k: int = 10) -> DataFrame:
    """The ``k`` best items of one ``user``, or of all in a file of ``users``, an id a line."""
    if (user is None) == (users is None):
        raise ValueError("give user= or users=")
    model = models.fit_recommender(_ratings(spark, ratings), "user_id", "movie_id", "rating")
    if users is None:
        asked = files.frame_from_rows(spark, [(user,)], ["user_id"])
    else:
        asked = spark.read.text(users).select(F.trim("value").try_cast("long").alias("user_id")).dropna()
    return models.recommend(model, asked, _titles(spark, titles), "movie_id", "title", k)


def line_predictions(spark, examples: str, seed: int = 42) -> DataFrame:
    """Trained on one half of the rows, (prediction, label) of the other half."""
    rows = files.read_delimited(spark, examples, schemas.REGRESSION)
    parts = splits.random_parts(rows, [0.5, 0.5], ["label", "feature"], seed)
    training, test = (models.assemble(part, ["feature"], "label") for part in parts)
    return models.predict(models.fit_line(training), test)


# Columns of the file.
PRICE_FEATURES = ["HouseAge", "DistanceToMRT", "NumberConvenienceStores"]


def _price_predictions(spark: SparkSession, houses: str, seed: int) -> DataFrame:
    rows = files.read_with_header(spark, houses).select(*PRICE_FEATURES, "PriceOfUnitArea")
    parts = splits.random_parts(rows, [0.8, 0.2], rows.columns, seed)
    training, test = (materialise(models.assemble(p, PRICE_FEATURES, "PriceOfUnitArea"), "examples") for p in parts)
    return models.predict(models.fit_tree(training), test)


def price_predictions(spark, houses: str, seed: int = 42) -> DataFrame:
    """A tree trained on four fifths of the rows, (prediction, label) of the rest."""
    return _price_predictions(spark, houses, seed)


def price_metrics(spark, houses: str, seed: int = 42) -> DataFrame:
    return models.regression_metrics(_price_predictions(spark, houses, seed))


def status_stream(spark, folder: str) -> DataFrame:
    """A streaming DataFrame: hand it to a sink."""
    return running_counts(parse_logs(stream_lines(spark, folder)))


def endpoint_stream(
    spark, folder: str, size: str = "30 seconds", slide: str = "10 seconds", watermark: str = None
) -> DataFrame:
    """A streaming DataFrame: hand it to a sink. With a ``watermark`` that is to be one for closed windows (append mode).

    Times are those of processing; what a watermark closes is then final, as no line comes in late.
    """
    lines = parse_logs(stream_lines(spark, folder))
    return sliding_counts(lines, size=size, slide=slide, watermark=watermark)


def rating_folds(spark, ratings: str, k: int = 5) -> DataFrame:
    """The ratings in file order, cut into ``k`` folds."""
    rows = materialise(files.in_file_order(_ratings(spark, ratings)), "ratings")
    return splits.assign_folds(rows, ["line"], k).drop("line")


def rating_holdout(spark, ratings: str, start: int = 1, stop: int = 10, max_test: int = 0) -> DataFrame:
    """Per user the ratings ``start..stop`` in file order marked as test."""
    rows = materialise(files.in_file_order(_ratings(spark, ratings)), "ratings")
    return splits.holdout_per_user(rows, "user_id", ["line"], start, stop, max_test).drop("line")
