"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest.

The trees (Spark ML) learn from labelled URLs. Where no labels are given, the URLs that a rule decides are the
labelled ones. Features and scoring are column expressions; no row leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallywork.llm.common import materialise


@dataclass(frozen=True)
class Rule:
    """Allows or blocks the urls of a host and its subdomains whose path starts with ``path`` ("/" or more)."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def parse_rules(text: str) -> list[Rule]:
    """Rules from lines or commas like ``allow org/, block example.org/es/``."""
    rules = []
    for item in text.replace("\n", ",").split(","):
        if item.strip():
            verdict, target = item.split()
            host, _, path = target.partition("/")
            rules.append(Rule(verdict, host.lower(), f"/{path}"))
    return rules


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or for null."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The name of the longest rule that fits, else null. Equally long rules: the first in order of names."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name))[::-1]:
        own = (host == rule.host) | host.endswith(f".{rule.host}")
        fits = F.when(own & path.startswith(rule.path), F.lit(rule.name)).otherwise(fits)
    return fits


def _share(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character over letters, digits and the common marks of a URL."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    counts = F.transform(
        F.split(F.lit("a b c d e f g h i j k l m n o p q r s t u v w x y z 0 1 2 3 4 5 6 7 8 9 - . _ ~ / %"), " "),
        lambda letter: (F.length(text) - F.length(F.replace(text, letter, F.lit("")))) / n,
    )
    return F.aggregate(counts, F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL; all are numbers, and 0 for an empty one."""
    whole = F.lower(F.coalesce(url, F.lit("")))
    query = F.regexp_extract(whole, r"\?([^#]*)", 1)
    first = F.regexp_extract(host, r"^(?:www\.|m\.|blog\.)?([^.]*)", 1)
    return {
        "length": F.length(whole),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_depth": F.size(F.split(host, r"\.")),
        "path_depth": F.length(F.regexp_replace(path, "[^/]", "")),
        "digit_ratio": _share(whole, "0-9"),
        "host_digits": _share(host, "0-9"),
        "letter_ratio": _share(whole, "a-z"),
        "hyphens": F.length(F.regexp_replace(host, "[^-]", "")),
        "name_length": F.length(first),
        "entropy": _entropy(whole),
        "host_entropy": _entropy(host),
        "name_vowels": _share(first, "aeiou"),
        "parameters": F.when(F.length(query) > 0, F.size(F.split(query, "&"))).otherwise(0),
        "query_length": F.length(query),
        "fragment": F.contains(whole, F.lit("#")).cast("int"),
        "secure": whole.startswith("https").cast("int"),
        "page_name": F.regexp_like(path, F.lit(r"\.[a-z]{2,5}$")).cast("int"),
    }


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


@dataclass
class UrlModel:
    """Trees, and how often each suffix was blocked among the labelled URLs: (__suffix, __rate, __weight)."""

    trees: object
    suffixes: DataFrame
    mean: float

    def score(self, urls: DataFrame, url: str, host: str, path: str, out: str) -> DataFrame:
        """Adds ``out``, the probability of a block."""
        columns = features(F.col(url), F.col(host), F.col(path))
        columns |= _suffix_columns(self.mean)
        assembler = VectorAssembler(inputCols=[f"__f_{c}" for c in columns], outputCol="__features")
        known = _with_suffixes(urls, F.col(host), self.suffixes)
        ready = known.withColumns({f"__f_{name}": c.cast("double") for name, c in columns.items()})
        scored = self.trees.transform(assembler.transform(ready))
        return scored.select(*urls.columns, vector_to_array("probability")[1].alias(out))


def _with_suffixes(urls: DataFrame, host: Column, suffixes: DataFrame) -> DataFrame:
    return urls.withColumn("__suffix", suffix_of(host)).join(suffixes, "__suffix", "left")


def _suffix_columns(mean: float) -> dict[str, Column]:
    return {
        "suffix_rate": F.coalesce("__rate", F.lit(mean)),
        "suffix_weight": F.coalesce("__weight", F.lit(0.0)),
    }


def train(
    labelled: DataFrame,
    url: str = "url",
    label: str = "label",
    bound: int = 20_000,
    rounds: int = 12,
    depth: int = 4,
    seed: int = 7,
) -> UrlModel | None:
    """Trees fitted on (url, label 0/1) rows, 1 meaning block; None if there are fewer than two labels.

    Each label's distinct urls are sampled by themselves, by a hash of the url: of all together about ``bound``, and of either
    label an eighth of that if it has as many. A row weighs what it stands for. Suffix statistics are over all rows.
    """
    rows = labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("label"))
    rows = rows.where(F.col("url").isNotNull() & F.col("label").isin(0.0, 1.0))
    rows = materialise(rows.groupBy("url", "label").agg(F.count("*").alias("copies")), "labelled")
    counts = {r.label: (r.n, r.rows) for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("copies").alias("rows")).collect()}
    if len(counts) < 2:
        return None
    n = sum(c for _, c in counts.values())
    mean = counts[1.0][1] / n
    rows = rows.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Rates are drawn towards the mean, so a suffix that is rarely seen says little.
    times = F.sum("copies")
    suffixes = rows.groupBy(suffix_of(F.col("host")).alias("__suffix")).agg(
        ((F.sum(F.col("copies") * F.col("label")) + 20 * mean) / (times + 20)).alias("__rate"), (times / n).alias("__weight")
    )
    suffixes = materialise(suffixes, "suffixes")
    distinct = sum(c for c, _ in counts.values())
    sample = None
    for kind, (own, _) in counts.items():
        taken = own if distinct <= bound else min(own, max(1, bound // 8, bound * own // distinct))
        chosen = rows.where(F.col("label") == kind)
        if taken < own:
            chosen = chosen.orderBy(F.xxhash64("url", F.lit("sample")), "url").limit(taken)
        chosen = chosen.withColumn("__stands", F.col("copies") * F.lit(own / taken))
        sample = chosen if sample is None else sample.union(chosen)
    columns = features(F.col("url"), F.col("host"), F.col("path")) | _suffix_columns(mean)
    sample = _with_suffixes(sample, F.col("host"), suffixes).select(
        "label", "__stands", *[c.cast("double").alias(f"__f_{name}") for name, c in columns.items()]
    )
    # Written once and read in few parts: every round of boosting reads it again.
    sample = materialise(sample.coalesce(8), "labelled-urls")
    ready = VectorAssembler(inputCols=[f"__f_{c}" for c in columns], outputCol="__features").transform(sample)
    trees = GBTClassifier(
        featuresCol="__features", labelCol="label", weightCol="__stands", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed
    )
    return UrlModel(trees.fit(ready), suffixes, mean)


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    labelled: DataFrame | None = None,
    url: str = "url",
    keep: list[str] | None = None,
    threshold: float = 0.5,
    bound: int = 20_000,
) -> DataFrame:
    """``keep`` columns with host, path, rule, verdict and the trees' score of each row.

    The verdict is the longest fitting rule's, else "block" where the score reaches ``threshold`` and "allow" below
    it. ``labelled`` holds (url, label 0/1); by default the rows that a rule decides. Null and empty urls have an empty host and
    path, fit no rule and are scored like any other; repeated rows are judged alike. With labels of one
    kind only there is nothing to learn: the score is then that label, or 0 with none at all. Columns of ``pages`` other than ``url`` and ``keep`` are not touched.
    """
    names = keep or ["page_id"]
    # Columns that are only carried get neutral names, as Spark ML adds columns of its own.
    rows = pages.select(*[F.col(n).alias(f"__k{i}") for i, n in enumerate(names)], F.col(url).alias("__url"))
    rows = rows.withColumns({"__host": host_of(F.col("__url")), "__path": path_of(F.col("__url"))})
    rows = rows.withColumn("__rule", matched_rule(F.col("__host"), F.col("__path"), rules))
    verdicts = {r.name: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for name, verdict in verdicts.items():
        by_rule = F.when(F.col("__rule") == name, F.lit(verdict)).otherwise(by_rule)
    rows = rows.withColumn("__by_rule", by_rule)
    if labelled is None:
        labelled = rows.where(F.col("__rule").isNotNull()).select(
            F.col("__url").alias("url"), (F.col("__by_rule") == "block").cast("int").alias("label")
        )
    model = train(labelled, bound=bound)
    if model is None:
        one = labelled.agg(F.max("label")).first()[0]
        scored = rows.withColumn("__score", F.lit(float(one or 0)))
    else:
        scored = model.score(rows, "__url", "__host", "__path", "__score")
    by_score = F.when(F.col("__score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        *[F.col(f"__k{i}").alias(n) for i, n in enumerate(names)],
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.coalesce("__by_rule", by_score).alias("verdict"),
        F.col("__score").alias("score"),
    )
