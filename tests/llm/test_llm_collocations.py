"""Collocations against counts of plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallywork.llm import collocations
from tallywork.llm.collocations import END, Settings, Tiles, _Sums, lang_seed, phrases, tile_counts, word_id

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, settings):
    """rows: (lang, text). The result's rows by counting everything."""
    counts = defaultdict(lambda: [Counter(), Counter(), Counter()])
    for lang, text in rows:
        own = counts[lang if lang is not None else "und"]
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for width in (1, 2, 3):
                own[width - 1].update(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    out = set()
    for lang, own in counts.items():
        n = sum(own[0].values())
        candidates = {p: c for width in (1, 2) for p, c in own[width].items() if c >= settings.least}
        found = []
        for p, a in candidates.items():
            longer = [c for q, c in candidates.items() if len(q) > len(p) and p in (q[:-1], q[1:])]
            if any(100 * c >= settings.inside * a for c in longer):
                continue
            cuts = [(own[k - 1][p[:k]], own[len(p) - k - 1][p[k:]]) for k in range(1, len(p))]
            scores = [10**6 * a * a // (l * r) for l, r in cuts]
            k = scores.index(min(scores))
            found.append((-scores[k], -a, " ".join(p).encode(), *cuts[k], n))
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(found)[: settings.top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return out


def texts(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Of", "THE", "ß", "é", "\U0001f600", "\x1cx"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for _ in range(n):
        body = []
        for _ in range(rng.choice([0, 1, 2, 30, 80])):
            body += rng.choice([rng.choices(words, weights), ["new", "york", "city"], ["ha", "ha", "ha"], ["x" * 90, "y" * 90]])
            body[-1] += rng.choice(["", "", "", ",", ".\n", "\t"])
        rows.append((rng.choice(["en", "en", "de", None, "und"]), " ".join(body)))
    return rows + [("en", None), (None, ""), ("fr", "  "), ("fr", ".,;"), ("it", "a b " * 20_000), ("it", "z" * 100_000)]


def run(spark, rows, settings):
    """With other columns whose names the operator uses itself."""
    frame = spark.createDataFrame([(*r, 1, "k", 2, "h") for r in rows], "lang string, text string, n int, word string, id int, hash string")
    got = phrases(frame.repartition(3), settings=settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize(
    "settings",
    [
        Settings(),
        # Few ids by rank, so that most words and pairs go by their hashes; small buffers.
        Settings(words=5, pairs=3, buffer=500),
        # A filter that lets everything through.
        Settings(words=5, pairs=0, bits=1),
        Settings(words=0, pairs=0, least=2, top=7),
    ],
)
def test_phrases_equal_plain_counts(spark, settings):
    rows = texts(1)
    got = run(spark, rows, settings)
    assert len(got) == len(set(got)) and set(got) == plain(rows, settings)
    assert {r[0] for r in got} >= {"en", "de", "und", "it"}


def test_clashing_hashes_are_told_apart(spark, monkeypatch):
    """With hashes of three bits nearly all words clash."""
    from pyspark.sql import functions as F

    low = (1 << 63) | 7
    monkeypatch.setattr(collocations, "_hash", lambda lang, word: F.xxhash64(lang, word).bitwiseAND(F.lit(low - (1 << 64))).bitwiseOR(F.lit(-(1 << 63))))
    rows = texts(2, 60)
    settings = Settings(words=3, pairs=2, bits=1)
    assert set(run(spark, rows, settings)) == plain(rows, settings)


def test_no_documents(spark, no_docs):
    from pyspark.sql import functions as F

    assert phrases(no_docs.withColumn("lang", F.lit("en"))).collect() == []


def test_ids_of_columns_and_tasks_agree(spark):
    from pyspark.sql import functions as F

    rows = [("en", "the"), ("", "x" * 500), ("und", "é\U0001f600"), ("de", "")]
    got = spark.createDataFrame(rows, "lang string, word string").select(collocations._hash("lang", "word").alias("h"), "lang", "word")
    for r in got.collect():
        assert r.h == word_id(lang_seed(r.lang), r.word.encode()) < 0


@pytest.mark.parametrize("rows,columns", [(1, 1), (33, 5000), (131_072, 131_072)])
def test_tiles_give_ids_back(rows, columns):
    rng = np.random.default_rng(1)
    tiles = Tiles(rows, columns)
    left, right = (rng.random(200_000) ** 6 * rows).astype(np.int64), (rng.random(200_000) ** 6 * columns).astype(np.int64)
    found = Counter()
    sums = {}
    for half in (slice(0, 150_000), slice(150_000, None)):
        for tile, cells, counts in tile_counts(tiles, tiles.codes(left[half], right[half])):
            assert cells.max() < tiles.area(tile) <= 1 << collocations.BITS and (np.diff(cells) > 0).all()
            sums.setdefault(tile, _Sums(tiles.area(tile))).add(cells, counts)
    for tile, own in sums.items():
        cells, counts = own.found(1)
        for a, b, n in zip(*(x.tolist() for x in tiles.ids(tile, cells)), counts.tolist()):
            found[a, b] += n
    assert found == Counter(zip(left.tolist(), right.tolist()))


def test_packed_numbers_come_back():
    values = np.array([0, 1, 255, 256, 65_536, (1 << 32) - 1])
    assert collocations._unpacked(collocations._packed(values)).tolist() == values.tolist()
    assert END > 1 << 40
