"""Regression and recommendation over the contract tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.operators import models, trees
from tallywork.operators.splits import random_parts, with_part
from tallywork.plans.registry import query
from tallywork.session import materialise
from tallywork.sources.files import frame_from_rows, read_table


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, words, n_chars) of each document, written because fits read it often."""
    docs = read_table(spark, folder, "documents")
    words = F.regexp_count("text", F.lit(r"\S+")).cast("double").alias("words")
    return materialise(docs.select("doc_id", words, "n_chars"), "sizes")


def _line_examples(counts: DataFrame) -> DataFrame:
    return models.assemble(counts, ["words"], "n_chars")


def text_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Characters (label) against words (feature) of each document."""
    return _line_examples(word_counts(spark, folder))


_SIZES = """
    SELECT CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y, doc_id
    FROM documents
"""


def split_sql(key: str, seed: int = 42) -> str:
    """The place in [0, 2^32) by which a random split of that key and seed decides."""
    return f"CAST(('0x' || substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8)) AS BIGINT)"


# One feature has a closed form: the correlation shrunk by the penalty over the label's (population)
# deviation, back in units.
_HALF = f"{split_sql('doc_id')} < 2147483648"
_LINE_OF = f"""
    WITH sizes AS ({_SIZES}),
    moments AS (
        SELECT corr(y, x) AS r, stddev_pop(x) AS sx, stddev_pop(y) AS sy, avg(x) AS mx, avg(y) AS my FROM sizes
        WHERE %s
    ),
    line AS (
        SELECT slope, my - slope * mx AS intercept
        FROM (
            SELECT *, sign(r) * greatest(abs(r) - 0.3 / sy * 0.8, 0) / (1 + 0.3 / sy * 0.2) * sy / sx AS slope
            FROM moments
        )
    )
"""
_LINE = _LINE_OF % "true"


@query(
    "linear_regression_fit",
    f"""
    {_LINE}
    SELECT 'intercept' AS term, round(intercept, 6) AS value FROM line
    UNION ALL SELECT 'words', round(slope, 6) FROM line
    """,
)
def linear_regression_fit(spark, folder):
    examples = text_sizes(spark, folder)
    model = models.fit_line(examples)
    return models.line_terms(model, examples, ["words"]).withColumn("value", F.round("value", 6))


@query(
    "linear_regression_predict",
    f"{_LINE} SELECT round(intercept + slope * x, 3) AS prediction, y AS label FROM sizes, line",
)
def linear_regression_predict(spark, folder):
    examples = text_sizes(spark, folder)
    scored = models.predict(models.fit_line(examples), examples)
    return scored.withColumn("prediction", F.round("prediction", 3))


@query(
    "linear_regression_metrics",
    f"""
    {_LINE},
    sums AS (
        SELECT avg((y - intercept - slope * x) ** 2) AS mse, avg(abs(y - intercept - slope * x)) AS mae,
               var_pop(y) AS spread
        FROM sizes, line
    )
    SELECT 'rmse' AS metric, round(sqrt(mse), 4) AS value FROM sums
    UNION ALL SELECT 'mse', round(mse, 4) FROM sums
    UNION ALL SELECT 'r2', round(1 - mse / spread, 4) FROM sums
    UNION ALL SELECT 'mae', round(mae, 4) FROM sums
    """,
)
def linear_regression_metrics(spark, folder):
    examples = text_sizes(spark, folder)
    scored = models.predict(models.fit_line(examples), examples)
    return models.regression_metrics(scored).withColumn("value", F.round("value", 4))


@query(
    "linear_regression_split",
    f"""
    {_LINE_OF % _HALF}
    SELECT round(intercept + slope * x, 3) AS prediction, y AS label FROM sizes, line WHERE NOT ({_HALF})
    """,
)
def linear_regression_split(spark, folder):
    """Trained with the default settings on one half, (prediction, label) of the other half."""
    training, test = random_parts(word_counts(spark, folder), [0.5, 0.5], ["doc_id"])
    model = models.fit_line(_line_examples(training))
    return models.predict(model, _line_examples(test)).withColumn("prediction", F.round("prediction", 3))


PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def price_parts(spark: SparkSession, folder: str, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """Examples of four fifths of the line items, and of the rest; split by key and written once, with the part of each."""
    lines = with_part(read_table(spark, folder, "lineitem"), [0.8, 0.2], ["l_orderkey", "l_linenumber"])
    rows = materialise(models.assemble(lines, features, "l_extendedprice", "part"), "examples")
    training, test = (rows.where(F.col("part") == k).drop("part") for k in range(2))
    return training, test


_STUMP = """
    WITH features AS (
        SELECT 'discount' AS name, l_discount AS x, l_extendedprice AS y FROM lineitem WHERE %s
        UNION ALL SELECT 'tax', l_tax, l_extendedprice FROM lineitem WHERE %s
    ),
    per_value AS (SELECT name, x, count(*) AS c, sum(y) AS s FROM features GROUP BY name, x),
    cuts AS (
        SELECT name, x, sum(c) OVER below AS cl, sum(s) OVER below AS sl,
               sum(c) OVER (PARTITION BY name) AS c, sum(s) OVER (PARTITION BY name) AS s
        FROM per_value WINDOW below AS (PARTITION BY name ORDER BY x)
    ),
    best AS (
        SELECT * FROM cuts WHERE cl < c ORDER BY sl * sl / cl + (s - sl) * (s - sl) / (c - cl) DESC LIMIT 1
    )
"""
_TRAINED = f"{split_sql('l_orderkey, l_linenumber')} < {round(0.8 * (1 << 32))}"


@query(
    "tree_stump",
    f"""
    {_STUMP % ("true", "true")}
    SELECT round(sl / cl, 3) AS prediction, CAST(cl AS BIGINT) AS n FROM best
    UNION ALL SELECT round((s - sl) / (c - cl), 3), CAST(c - cl AS BIGINT) FROM best
    """,
)
def tree_stump(spark, folder):
    """A tree of one split on two features of few values: the two leaf means and their rows."""
    lines = read_table(spark, folder, "lineitem")
    examples = materialise(models.assemble(lines, ["l_discount", "l_tax"], "l_extendedprice"), "examples")
    scored = models.predict(models.fit_tree(examples, maxDepth=1), examples)
    leaves = scored.groupBy("prediction").agg(F.count("*").alias("n"))
    return leaves.withColumn("prediction", F.round("prediction", 3))


@query(
    "tree_stump_split",
    f"""
    {_STUMP % (_TRAINED, _TRAINED)}
    SELECT round(CASE WHEN (CASE name WHEN 'tax' THEN l_tax ELSE l_discount END) <= x THEN sl / cl
                      ELSE (s - sl) / (c - cl) END, 3) AS prediction, l_extendedprice AS label
    FROM lineitem, best WHERE NOT ({_TRAINED})
    """,
)
def tree_stump_split(spark, folder):
    """A tree of one split, trained on four fifths of the rows; (prediction, label) of the rest."""
    training, test = price_parts(spark, folder, ["l_discount", "l_tax"])
    scored = models.predict(models.fit_tree(training, maxDepth=1), test)
    return scored.withColumn("prediction", F.round("prediction", 3))


GROWN = 5
_SPLIT_FEATURES = {"discount": "l_discount", "tax": "l_tax", "line": "l_linenumber"}


def _grown_sql(depth: int) -> str:
    """The tree by SQL, level by level: each node takes the cut that leaves the least squares of the rows' distances to the means."""
    values = " ".join(f"WHEN '{name}' THEN {column}" for name, column in _SPLIT_FEATURES.items())
    ctes = ["level0 AS (SELECT *, l_extendedprice AS y, CAST(1 AS BIGINT) AS node FROM lineitem)"]
    for level in range(depth):
        long = " UNION ALL ".join(
            f"SELECT node, {k} AS f, '{name}' AS feature, CAST({column} AS DOUBLE) AS x, y FROM level{level}"
            for k, (name, column) in enumerate(_SPLIT_FEATURES.items())
        )
        ctes += [
            f"per{level} AS (SELECT node, f, feature, x, count(*) AS c, sum(y) AS s FROM ({long}) GROUP BY ALL)",
            f"""cuts{level} AS (
                SELECT node, f, feature, x, sum(c) OVER below AS cl, sum(s) OVER below AS sl,
                       sum(c) OVER (PARTITION BY node, f) AS c, sum(s) OVER (PARTITION BY node, f) AS s
                FROM per{level} WINDOW below AS (PARTITION BY node, f ORDER BY x)
            )""",
            f"""best{level} AS (
                SELECT * FROM cuts{level} WHERE cl < c
                QUALIFY row_number() OVER (
                    PARTITION BY node ORDER BY sl * sl / cl + (s - sl) * (s - sl) / (c - cl) DESC, f, x
                ) = 1
            )""",
            f"""level{level + 1} AS (
                SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node
                    WHEN CASE b.feature {values} END <= b.x THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
                FROM level{level} r LEFT JOIN best{level} b ON b.node = r.node
            )""",
        ]
    return "WITH " + ", ".join(ctes)


def _grown(spark, folder):
    columns = list(_SPLIT_FEATURES.values())
    rows = read_table(spark, folder, "lineitem").select(*columns, "l_extendedprice")
    examples = materialise(models.assemble(rows, columns, "l_extendedprice"), "examples")
    return rows, trees.tree_of(models.fit_tree(examples, maxDepth=GROWN)), columns


@query(
    "tree_leaves",
    f"""
    {_grown_sql(GROWN)}
    SELECT node AS leaf, count(*) AS n, round(avg(y), 3) AS prediction, round(avg(y), 3) AS mean FROM level{GROWN} GROUP BY node
    """,
)
def tree_leaves(spark, folder):
    """The leaves of a tree of depth five, by place: rows, what the model predicts, and the mean of the rows."""
    rows, tree, columns = _grown(spark, folder)
    found = trees.leaves(rows, tree, columns, "l_extendedprice")
    return found.withColumn("prediction", F.round("prediction", 3)).withColumn("mean", F.round("mean", 3))


@query(
    "tree_splits",
    f"""
    {_grown_sql(GROWN)}
    """
    + " UNION ALL ".join(
        f"SELECT node, feature, CAST(cl AS BIGINT) AS below, CAST(c - cl AS BIGINT) AS above FROM best{level}"
        for level in range(GROWN)
    ),
)
def tree_splits(spark, folder):
    """The splits of that tree: which feature, and the rows on either side."""
    rows, tree, columns = _grown(spark, folder)
    names = {column: name for name, column in _SPLIT_FEATURES.items()}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return trees.splits(rows, tree, columns).withColumn("feature", named[F.col("feature")])


@query("tree_regression")
def tree_regression(spark, folder):
    training, test = price_parts(spark, folder, PRICE_FEATURES)
    return models.predict(models.fit_tree(training), test)


@query("tree_metrics")
def tree_metrics(spark, folder):
    training, test = price_parts(spark, folder, PRICE_FEATURES)
    return models.regression_metrics(models.predict(models.fit_tree(training), test))


def _ordered_from(spark: SparkSession, folder: str) -> DataFrame:
    """What customers ordered from which supplier, as ratings."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query("als_recommend")
def als_recommend(spark, folder):
    """Ten suppliers for customer 8, trained on what all customers ordered from whom."""
    model = models.fit_recommender(_ordered_from(spark, folder), "o_custkey", "l_suppkey", "l_quantity")
    users = frame_from_rows(spark, [(8,)], ["o_custkey"])
    return models.recommend(model, users, read_table(spark, folder, "supplier"), "s_suppkey", "s_name")


@query(
    "als_recommend_many",
    """
    WITH asked AS (SELECT DISTINCT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 = 0)
    SELECT o_custkey, least(10, (SELECT count(DISTINCT l_suppkey) FROM lineitem)) AS items, CAST(0 AS BIGINT) AS rising FROM asked
    """,
)
def als_recommend_many(spark, folder):
    """Ten suppliers for each tenth customer: per customer how many came out, and how often a rating is above the one before."""
    ratings = materialise(_ordered_from(spark, folder), "ratings")
    model = models.fit_recommender(ratings, "o_custkey", "l_suppkey", "l_quantity")
    users = ratings.select("o_custkey").where("o_custkey % 10 = 0")
    best = models.recommend(model, users, read_table(spark, folder, "supplier"), "s_suppkey", "s_name")
    before = F.lag("rating").over(Window.partitionBy("o_custkey").orderBy(F.desc("rating"), "l_suppkey"))
    return best.withColumn("rose", (F.col("rating") > before).cast("int")).groupBy("o_custkey").agg(
        F.count_distinct("l_suppkey").alias("items"), F.coalesce(F.sum("rose"), F.lit(0)).alias("rising")
    )


@query(
    "als_residual",
    """
    SELECT count(DISTINCT o_custkey) AS users, count(*) AS ratings, CAST(0 AS DOUBLE) AS residual
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def als_residual(spark, folder):
    """Users and ratings of the fit, and how far the worst user's factors are from solving their normal equations."""
    ratings = materialise(_ordered_from(spark, folder), "ratings")
    model = models.fit_recommender(ratings, "o_custkey", "l_suppkey", "l_quantity")
    return models.normal_residuals(model, ratings, "l_quantity").agg(
        F.count("*").alias("users"), F.sum("n").alias("ratings"), F.round(F.max("residual"), 3).alias("residual")
    )


@query(
    "als_recommend_checks",
    """
    SELECT least(10, count(DISTINCT l_suppkey)) AS items, least(10, count(DISTINCT l_suppkey)) AS named,
           least(10, count(DISTINCT l_suppkey)) AS finite
    FROM lineitem
    """,
)
def als_recommend_checks(spark, folder):
    """Of the recommendations: distinct items that the tables know, those with the right name, finite ratings."""
    best = als_recommend(spark, folder)
    known = read_table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("_item")).distinct()
    names = read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("_key"), F.col("s_name").alias("_name"))
    joined = best.join(known, F.col("l_suppkey") == F.col("_item")).join(names, F.col("l_suppkey") == F.col("_key"))
    finite = F.col("rating").isNotNull() & ~F.isnan("rating") & (F.abs("rating") != float("inf"))
    return joined.agg(
        F.count_distinct("l_suppkey").alias("items"),
        F.count_if(F.col("s_name") == F.col("_name")).alias("named"),
        F.count_if(finite).alias("finite"),
    )
