"""Time plain forms of some jobs against the library's forms, on the same session and tables.

    python benchmarks/forms.py [folder] [cores]

One unmeasured run, then the median of three; prints a Markdown table.
"""

from __future__ import annotations

import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tallywork.operators import aggregates, similarity  # noqa: E402
from tallywork.operators.words import word_count  # noqa: E402
from tallywork.session import build_session  # noqa: E402
from tallywork.sources.files import read_table, spread  # noqa: E402

COLUMNS = {"user": "l_orderkey", "item": "l_suppkey", "rating": "l_quantity"}
TARGET = 5


def named_counts_by_udf(spark, folder):
    names = dict(read_table(spark, folder, "part").select("p_partkey", "p_name").collect())
    shared = spark.sparkContext.broadcast(names)
    lookup = F.udf(lambda key: shared.value.get(key))
    counts = read_table(spark, folder, "lineitem").groupBy("l_partkey").count()
    return counts.withColumn("p_name", lookup("l_partkey")).orderBy(F.desc("count"))


def named_counts(spark, folder):
    return aggregates.popular_named(
        read_table(spark, folder, "lineitem"), "l_partkey", read_table(spark, folder, "part"), "p_partkey", "p_name", None
    )


def extremes_in_two_passes(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    low = aggregates.lowest_by_key(lines, "l_suppkey", "l_returnflag", "l_quantity", "A")
    high = aggregates.highest_by_key(lines, "l_suppkey", "l_returnflag", "l_quantity", "R")
    return low.join(high, "l_suppkey")


def extremes(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return aggregates.extremes_by_key(lines, "l_suppkey", "l_returnflag", "l_quantity", "A", "R")


def words_by_python(spark, folder):
    breaks = re.compile(r"[^a-zA-Z0-9_]+")
    texts = read_table(spark, folder, "documents").select("text").rdd
    counted = (
        texts.flatMap(lambda row: [w.lower() for w in breaks.split(row.text) if w])
        .map(lambda word: (word, 1))
        .reduceByKey(lambda a, b: a + b)
    )
    return counted.toDF("word string, n long")


def words(spark, folder):
    return word_count(spread(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id"), "text")


def jaccard_filtered_last(spark, folder):
    rated = read_table(spark, folder, "lineitem").filter("l_quantity > 25").select("l_orderkey", "l_suppkey").distinct()
    counts = rated.groupBy("l_suppkey").count()
    a, b = rated.alias("a"), rated.alias("b")
    pairs = (
        a.join(b, (F.col("a.l_orderkey") == F.col("b.l_orderkey")) & (F.col("a.l_suppkey") < F.col("b.l_suppkey")))
        .select(F.col("a.l_suppkey").alias("i"), F.col("b.l_suppkey").alias("j"))
        .groupBy("i", "j")
        .count()
        .withColumnRenamed("count", "n")
    )
    one = counts.select(F.col("l_suppkey").alias("i"), F.col("count").alias("ci"))
    two = counts.select(F.col("l_suppkey").alias("j"), F.col("count").alias("cj"))
    scored = pairs.join(one, "i").join(two, "j")
    return scored.withColumn("score", F.col("n") / (F.col("ci") + F.col("cj") - F.col("n"))).filter(
        "ci > 320 AND cj > 320 AND n > 1"
    )


def jaccard(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return similarity.jaccard_pairs(lines, **COLUMNS, rating_over=25, item_count_over=320)


def partners_from_all_pairs(spark, folder):
    pairs = similarity.cosine_pairs(read_table(spark, folder, "lineitem"), **COLUMNS)
    return similarity.similar_in_table(pairs, TARGET, score_over=0.5, pairs_over=1)


def partners(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    return similarity.similar_by_cosine(lines, TARGET, **COLUMNS, score_over=0.5, pairs_over=1)


FORMS = [
    ("names: UDF on a broadcast dictionary / join", named_counts_by_udf, named_counts),
    ("min and max: two passes and a join / one pass", extremes_in_two_passes, extremes),
    ("words: Python RDD / columns", words_by_python, words),
    ("Jaccard: item filter after / before pairing", jaccard_filtered_last, jaccard),
    ("partners of one item: all pairs first / direct", partners_from_all_pairs, partners),
]


def seconds(form, spark, folder) -> float:
    taken = []
    for _ in range(4):
        began = time.perf_counter()
        form(spark, folder).write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - began)
    return statistics.median(taken[1:])


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = build_session(
        "forms", master=f"local[{cores}]", spark__sql__shuffle__partitions=cores, spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    print("| job: plain form / our form | plain (s) | ours (s) | ratio |\n|---|---|---|---|")
    for label, plain, ours in FORMS:
        slow, fast = seconds(plain, spark, folder), seconds(ours, spark, folder)
        print(f"| {label} | {slow:.2f} | {fast:.2f} | {slow / fast:.1f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
