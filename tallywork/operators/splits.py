"""Data preparation: folds, per-user holdout, random split."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.session import materialise

# Up to this rank Spark applies a rank filter in the map tasks, before rows of a group are brought
# together (its default for spark.sql.optimizer.windowGroupLimitThreshold).
RANKS_IN_MAP_TASKS = 1000


def with_position(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add ``position`` (from 1) in the order of ``order_by``, and the row count ``total``.

    A range sort spreads the order over all tasks.
    """
    return numbered(df.orderBy(*order_by))


def numbered(df: DataFrame) -> DataFrame:
    """Add ``position`` (from 1) in the order in which the rows lie, and the row count ``total``.

    The rows are written once, because a second evaluation may deal them otherwise (a range sort draws other bounds, say); a
    row then has its task and its place in the task, and the row counts of the earlier tasks make up the rest.
    """
    in_task = F.col("_mark").bitwiseAND((1 << 33) - 1)
    placed = materialise(df.withColumn("_mark", F.monotonically_increasing_id()), "ordered").withColumn(
        "_task", F.shiftright("_mark", 33)
    )
    tasks = placed.groupBy("_task").agg(F.count("*").alias("_rows"))
    # One row per write task, so a single window partition and a broadcast are both safe.
    every = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select(
        "_task",
        F.coalesce(F.sum("_rows").over(every), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("total"),
    )
    return (
        placed.join(F.broadcast(offsets), "_task")
        .withColumn("position", F.col("_before") + in_task + 1)
        .drop("_task", "_mark", "_before")
    )


def assign_folds(df: DataFrame, order_by: Sequence[str], k: int = 5) -> DataFrame:
    """Add ``fold`` in 1..k: contiguous runs in the given order, sizes at most one apart.

    ``order_by`` must tell any two rows apart. Rows stay where they are: they are compared with the keys at which the
    folds after the first begin.
    """
    place = F.struct(*order_by)
    behind = [(place >= border).cast("int") for border in _borders(df, order_by, k)]
    return df.withColumn("fold", reduce(add, behind, F.lit(1)))


def _borders(df: DataFrame, order_by: Sequence[str], k: int, near: float = 0.001) -> list[Column]:
    """The keys of the first rows of folds 2 to k, as structs of ``order_by``; of folds without rows there are none.

    A sketch of the first order column gives values a little (``near``, as a share of the rows) before and behind each
    border. Rows are counted between these values, exactly, which tells between which two a border lies and how many rows from there.
    Only the keys between those are sorted, with what else shares the values. How good the sketch is decides how many keys
    that are, never which border is found. Order columns other than numbers have no sketch, and all keys are sorted.
    """
    lead, cuts = F.col(order_by[0]), []
    if isinstance(df.schema[order_by[0]].dataType, T.NumericType):
        shares = sorted({min(1.0, max(0.0, b / k + d)) for b in range(1, k) for d in (-near, near)})
        if shares:
            cuts = sorted(set(df.agg(F.percentile_approx(lead, shares, int(10 / near))).first()[0] or []))
    between = reduce(add, [F.coalesce((lead >= cut).cast("int"), F.lit(0)) for cut in cuts], F.lit(0))
    keys = df.select(between.alias("_between"), F.struct(*order_by).alias("_key"))
    counts = {r["_between"]: r["n"] for r in keys.groupBy("_between").agg(F.count("*").alias("n")).collect()}
    n, before = sum(counts.values()), {}
    for at in sorted(counts):
        before[at] = sum(counts[b] for b in counts if b < at)
    starts = [at for b in range(1, k) if (at := b * (n // k) + min(b, n % k)) < n]
    homes = [max(b for b in counts if before[b] <= at) for at in starts]
    if not starts:
        return []
    sorted_ = with_position(keys.filter(F.col("_between").isin(homes)), ["_between", "_key"])
    wanted = [
        sum(counts[b] for b in set(homes) if b < home) + at - before[home] + 1 for at, home in zip(starts, homes)
    ]
    found = materialise(sorted_.filter(F.col("position").isin(wanted)).select("position", "_key"), "borders")
    return [found.filter(F.col("position") == at).select("_key").scalar() for at in sorted(set(wanted))]


def fold_pair(folds: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(base, test) of one fold."""
    test = F.col("fold") == fold
    return folds.filter(~test).drop("fold"), folds.filter(test).drop("fold")


def holdout_per_user(
    df: DataFrame,
    user: str,
    order_by: Sequence[str],
    start: int = 1,
    stop: int = 10,
    max_test: int = 0,
) -> DataFrame:
    """Add ``is_test``: true for the rows ``start..stop`` of each user in the given order.

    ``order_by`` must tell the rows of a user apart. With ``max_test`` only so many rows, first in
    ``order_by`` over all users, become test rows; 0 sets no limit.

    Only the two bounding rows per user are looked for. The rank filter is applied in the map
    tasks already (at most ``stop`` rows per user leave each), so no user is gathered whole. For
    ranks that are too high for this, each input partition's share of a user is ranked first.
    """
    place = F.struct(*order_by)
    rows = df.select(user, place.alias("_at"))
    if stop > RANKS_IN_MAP_TASKS:
        share = Window.partitionBy(user, "_part").orderBy("_at")
        rows = (
            rows.withColumn("_part", F.spark_partition_id())
            .withColumn("_rank", F.row_number().over(share))
            .filter(F.col("_rank") <= stop)
            .drop("_part", "_rank")
        )
    ranked = (
        rows.withColumn("_rank", F.row_number().over(Window.partitionBy(user).orderBy("_at")))
        .filter(F.col("_rank") <= stop)
    )
    bounds = (
        ranked.filter(F.col("_rank") >= start)
        .groupBy(F.col(user).alias("_user"))
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    )
    marked = df.join(bounds, F.col(user).eqNullSafe(F.col("_user")), "left").withColumn(
        "is_test", F.coalesce(place.between(F.col("_from"), F.col("_to")), F.lit(False))
    )
    marked = marked.drop("_user", "_from", "_to")
    if max_test > 0:
        marked = materialise(marked, "holdout")
        numbered = with_position(marked.filter("is_test"), order_by)
        tested = numbered.withColumn("is_test", F.col("position") <= max_test)
        marked = marked.filter("NOT is_test").unionByName(tested.drop("position", "total"))
    return marked


def with_part(
    df: DataFrame, weights: Sequence[float], key: Sequence[str], seed: int = 42, name: str = "part"
) -> DataFrame:
    """Add a column (``part``, from 0): a random split in the given proportions, by a hash of the ``key`` columns and the seed.

    A row's part depends on nothing else, so parts are the same however the rows lie. The leading 32 bits of an MD5 are a
    number in [0, 1); any other engine with MD5 can tell the parts as well. Rows of equal keys go together; a NULL
    counts as an empty text.
    """
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key], F.lit(str(seed))))
    at = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    total, part = float(sum(weights)), F.lit(0)
    for k in range(1, len(weights)):
        part = part + (at >= round(sum(weights[:k]) / total * (1 << 32))).cast("int")
    return df.withColumn(name, part)


def random_parts(df: DataFrame, weights: Sequence[float], key: Sequence[str], seed: int = 42) -> list[DataFrame]:
    """The parts of ``with_part``, which never overlap, as a frame each."""
    marked = with_part(df, weights, key, seed, "_part")
    return [marked.filter(F.col("_part") == k).drop("_part") for k in range(len(weights))]
