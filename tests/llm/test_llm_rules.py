"""Quality rules, classifiers and URL verdicts."""

import random

import numpy as np
import pytest
from brute import repetition
from pyspark.sql import functions as F

from tallywork.llm import byte_cnn, quality_rules, toxicity, url_filter
from tallywork.llm.common import held_out, kept_rows, label_sample


def test_repetition_equals_brute_force():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += [None, "", "a", "of " * 60, "x y z " * 9, "a\n\nb\na\n"]
    limits = quality_rules.Limits(repeat_words=4)
    for chunk in (50, 10**6):
        found = quality_rules.measure(texts, limits, chunk)
        for i, text in enumerate(texts):
            got = tuple(found[c][i] for c in ("n_words", "n_repeat_words", "repeated_words", "longest_repeat"))
            assert got == repetition(text, 4)


def test_base_counts(odd_docs):
    rows = quality_rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    odd = by_id[9]  # "!!! ### $$$ 1,000.50"
    assert (odd.n_words, odd.word_chars, odd.n_symbols, odd.base_failed, odd.kept) == (4, 17, 6, True, False)
    lines = quality_rules.measure(["a b\na b\n\n \na b\nc"], quality_rules.Limits())
    assert lines["n_dup_lines"] == [2]


def test_verdicts():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    good = " ".join(words)
    passage = " ".join(rng.choice(words) for _ in range(40))
    half = f"{passage} {passage}\n{' '.join(words[:20])}"
    long = " ".join(words[:120] + ["and"] + words[:120] + [f"x{i}" for i in range(900)])
    found = quality_rules.measure([good, half, long, "short"], quality_rules.Limits())
    assert found["kept"] == [True, False, False, False]
    assert found["base_failed"] == [False, True, False, True]
    assert found["longest_repeat"] == [0, 40, 120, 0]


def test_keep_good_leaves_columns(odd_docs, no_docs):
    good = quality_rules.keep_good(odd_docs)
    assert good.schema == odd_docs.schema and good.count() == 0
    assert quality_rules.keep_good(no_docs).collect() == []


def _labelled(spark, make, n=400):
    rng = random.Random(9)
    rows = [(i, *make(rng, i)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, mark int")
    return docs, labels


def _held_out_accuracy(scored, labels, threshold):
    rows = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert len(rows) > 50
    return np.mean([(r.score >= threshold) == bool(r.mark) for r in rows])


def test_toxicity_on_held_out_rows(spark):
    def make(rng, i):
        words = [f"n{rng.randint(0, 60)}" for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[rng.randint(0, 59)] = rng.choice(["vile", "nasty"])
        return " ".join(words), int(bad)

    docs, labels = _labelled(spark, make, 600)
    model = toxicity.train(label_sample(docs, labels, "mark", 10_000))
    assert 0 < len(model.weights) < 400
    assert _held_out_accuracy(model.score(docs), labels, 0.3) > 0.95
    kept = model.keep_clean(docs)
    assert kept.schema == docs.schema
    assert kept.where("text like '%vile%' or text like '%nasty%'").count() <= 6


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    empty = spark.createDataFrame([], "doc_id long, mark int")
    model = toxicity.train(label_sample(no_docs, empty, "mark", 10))
    rows = model.score(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert model.keep_clean(odd_docs).count() == odd_docs.count()


def test_sample_is_bounded_and_leaves_held_out_rows(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("mark"))
    rows = label_sample(docs, labels, "mark", 200).collect()
    assert 120 < len(rows) < 300
    import zlib

    assert not any(zlib.crc32(str(r.id).encode()) % 4 == 2 for r in rows)


def test_network_on_held_out_rows(spark):
    def make(rng, i):
        bad = i % 3 == 0
        return " ".join("".join(rng.choice("abcde") for _ in range(5)) + ("***" if bad else "") for _ in range(40)), int(not bad)

    docs, labels = _labelled(spark, make)
    settings = byte_cnn.Settings(filters=8, hidden=6, rounds=6, rate=0.01)
    model = byte_cnn.train(label_sample(docs, labels, "mark", 10_000), settings)
    assert _held_out_accuracy(model.score(docs), labels, 0.7) > 0.95


def test_network_odd_rows(spark, odd_docs, no_docs):
    empty = spark.createDataFrame([], "doc_id long, mark int")
    model = byte_cnn.train(label_sample(no_docs, empty, "mark", 10), byte_cnn.Settings(filters=4, hidden=3))
    rows = model.score(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert model.score(no_docs).collect() == []


def test_chunks_cover_whole_texts():
    settings = byte_cnn.Settings(chunk=16, overlap=4)
    for n in (0, 1, 15, 16, 17, 28, 29, 100):
        text = "".join(chr(97 + i % 26) for i in range(n))
        chunks = byte_cnn.chunks_of(text, settings)
        joined = bytes(chunks[0]) + b"".join(bytes(c[4:]) for c in chunks[1:])
        assert joined.rstrip(b"\0").decode() == text


def test_network_gradients():
    settings = byte_cnn.Settings(chunk=64, overlap=16, width=4, vector=3, filters=4, hidden=5)
    p = {k: v.astype(np.float64) for k, v in byte_cnn.start(settings).items()}
    texts, labels = ["hello there !!! ### foo bar " * 4, "ab", "quick brown fox jumps over"], np.array([0, 1, 1.0])
    parts = [byte_cnn.chunks_of(t, settings) for t in texts]
    sizes = np.array([len(c) for c in parts])
    chunks = np.concatenate(parts)

    def loss():
        answers, _ = byte_cnn.convolve(p, chunks, settings)
        found = byte_cnn._head(p, byte_cnn._pool(answers, np.cumsum(sizes) - sizes, sizes))[1]
        return -np.mean(labels * np.log(found) + (1 - labels) * np.log(1 - found))

    slopes = byte_cnn.gradients(p, chunks, sizes, labels, settings)
    rng = np.random.default_rng(0)
    for name, value in p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            kept = value[at]
            value[at] = kept + 1e-5
            above = loss()
            value[at] = kept - 1e-5
            slope = (above - loss()) / 2e-5
            value[at] = kept
            if not (name == "vectors" and at[0] == 0):
                assert slopes[name][at] == pytest.approx(slope, abs=1e-4)


RULES = url_filter.parse_rules("allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/")


def test_hosts_paths_and_rules(spark):
    urls = [
        ("HTTP://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/"),
        ("https://notexample.org/es/2", "notexample.org", "/es/2", "org/"),
        ("x://com/de/", "com", "/de/", "com/de/"),
        ("x://a.com/fr/?q=://b.org/", "a.com", "/fr/", "com/fr/"),
        ("http://a.org", "a.org", "", None),
        ("http://a.net?u", "a.net", "", None),
        ("no scheme", "", "", None),
        ("://", "", "", None),
        ("a\nb://H/p\nq#z", "h", "/p\nq", None),
        (None, "", "", None),
        ("", "", "", None),
    ]
    rows = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(urls)], "page_id long, url string, probability string")
    got = url_filter.judge_urls(rows, RULES, keep=["page_id", "probability"]).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [u[1:] for u in urls]
    allowed = {"org/": "allow", "com/fr/": "allow"}
    assert all(r.verdict == allowed.get(r.rule, "block") for r in got if r.rule)
    assert all(r.verdict in ("allow", "block") and r.probability == "x" for r in got)


def test_urls_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(none, RULES).collect() == []


def test_trees_learn_from_labels(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        bad = i % 2
        host = f"www{rng.randint(1000, 9999)}-x{rng.randint(10, 99)}.com" if bad else rng.choice(["home", "paper", "garden"]) + ".com"
        rows.append((i, f"https://{host}/{rng.choice(['a', 'b'])}/{rng.randint(1, 99)}", bad))
    labelled = spark.createDataFrame(rows, "page_id long, url string, label int")
    test = labelled.where("page_id % 4 = 0")
    got = url_filter.judge_urls(test, [], labelled=labelled.where("page_id % 4 != 0"), keep=["page_id"]).collect()
    assert np.mean([(r.verdict == "block") == bool(r.page_id % 2) for r in got]) > 0.95


def test_urls_with_few_blocked_and_many_suffixes(spark):
    """One blocked url among many allowed ones is learnt beyond the bound, copies or not; all suffixes are known."""
    rows = [(f"http://a{i}.s{i % 400}/x", 0) for i in range(1200)] + [("http://999-999-999.bad/?q=1&r=2&s=3", 1)] * 50
    labelled = spark.createDataFrame(rows, "url string, label int")
    model = url_filter.train(labelled, bound=100, rounds=2, depth=2)
    assert model is not None and model.suffixes.count() == 401
    pages = spark.createDataFrame([(1, "http://a3.s3/x"), (2, "http://999-999-999.bad/?q=1&r=2&s=3")], "page_id long, url string")
    got = url_filter.judge_urls(pages, [], labelled=labelled, bound=100).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "allow", 2: "block"}


def test_filters_of_whole_rows_get_bounded_slices(spark):
    """The pipeline's first stages held a whole Arrow batch as Python objects; 10,000 rows of text a worker."""
    docs = spark.range(0, 3000, 1, 1).withColumn("text", F.repeat(F.lit("word "), F.lit(3)))
    found = kept_rows(docs, lambda batch: [batch.num_rows <= 1024] * batch.num_rows)
    assert found.schema == docs.schema and found.count() == 3000
    odd = kept_rows(docs, lambda batch: [i % 2 == 1 for i in batch.column(0).to_pylist()])
    assert [r.id for r in odd.orderBy("id").collect()] == list(range(1, 3000, 2))
