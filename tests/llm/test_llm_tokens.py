"""Byte-level encoding and decoding, token counts and packing against the libraries."""

import base64
import gc
import random
import weakref
import zlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from brute import best_fit
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywork.llm import byte_bpe, common, packing, token_counts, vocabularies
from tallywork.llm.vocabularies import LONG, Recent, Vocabulary, spaced_pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "ab 1.,\n \t'sé日\x1c\u00a0 "
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_equal_whole_texts(path):
    vocabulary = Vocabulary(open(path, "rb").read(), 1000)
    ids = packing._Ids(vocabulary, 50)
    for text in random_texts(2000) + ["Hello, World! " * 30, "ÀÉ ñandú straße. İ"]:
        want = vocabulary.whole(text)
        if path == WORDS:
            assert ids.encode(text) == want
        else:
            assert b"".join(vocabulary.ids_of(p) for p in spaced_pieces(text)) == want


def test_recent_keeps_its_bound():
    asked = []
    cache = Recent(lambda k: asked.append(k) or k * 2, 10)
    for k in list(range(100)) + [99, 99]:
        assert cache[str(k)] == str(k) * 2
    assert len(cache) + len(cache.older) <= 11
    assert asked == [str(k) for k in range(100)]
    # Long pieces, as texts without blanks are, are computed each time.
    long = "x" * 20_000
    assert cache[long] == cache[long] == long * 2 and asked[-2:] == [long, long]
    assert max(map(len, [*cache, *cache.older])) <= LONG


def test_frequent_pieces_are_short(spark):
    docs = spark.createDataFrame([(i, "y" * 5_000 + " a b") for i in range(6)], "doc_id long, text string")
    assert sorted(token_counts.frequent_pieces(docs)) == [" a", " b"]


def test_encode_and_decode(spark, odd_docs, tik):
    texts = [(1000 + i, t) for i, t in enumerate(random_texts(300))]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    # A small block makes many of them; words then meet from different blocks.
    found = byte_bpe.decode(byte_bpe.encode(docs.repartition(3).cache(), RANKS, public_tokenizers.PATTERN, block=2000), RANKS)
    got = sorted(((r.doc_id, list(r.ids), bytes(r.bytes)) for r in found.collect()), key=repr)
    want = [(r.doc_id, tik.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert got == sorted(want, key=repr)


def test_encode_no_rows(no_docs):
    found = byte_bpe.decode(byte_bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS)
    assert found.columns == ["doc_id", "ids", "bytes"] and found.collect() == []


def test_decode_keeps_nulls_and_refuses_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "k int, ids array<int>")
    assert [r.bytes for r in byte_bpe.decode(rows, RANKS).orderBy("k").collect()] == [None, b"", b'!"']
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(4, [60000])], "k int, ids array<int>"), RANKS).collect()


def test_counts(spark, odd_docs):
    texts = [(1000 + i, t) for i, t in enumerate(random_texts(200, 5))]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(texts, "doc_id long, text string"))
    library = Tokenizer.from_file(BYTES)
    # Tiny tiers: every path is taken.
    found = token_counts.count_tokens(docs, BYTES, limit=10, frequent=5, cached=20)
    got = sorted(map(tuple, found.collect()), key=repr)
    want = []
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id, len((r.text or "").encode()), n, n > 10))
    assert got == sorted(want, key=repr)


def test_counts_no_rows_and_kept_columns(no_docs, odd_docs):
    assert token_counts.count_tokens(no_docs, BYTES).collect() == []
    kept = token_counts.count_tokens(odd_docs, BYTES, keep=["score", "doc_id"])
    assert kept.columns == ["score", "doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert kept.count() == odd_docs.count()


def test_plan_is_best_fit():
    rng = random.Random(2)
    for size in (10, 64, 4096):
        counts = {}
        for _ in range(200):
            length = rng.randint(1, size)
            counts[length] = counts.get(length, 0) + rng.choice([1, 2, 40])
        bins, ranks = {}, {}
        for length, rank, count, first, each, offset in packing.plan(counts, size):
            for k in range(count):
                bins.setdefault(first + k // each, []).append((offset + k % each * length, length))
                ranks.setdefault(length, []).append(rank + k)
        assert {n: len(r) for n, r in ranks.items()} == counts
        assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
        for pieces in bins.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= size
        assert len(bins) == best_fit([n for n, c in counts.items() for _ in range(c)], size)


def test_plan_stays_small():
    counts = {n: 10**9 for n in range(1, 4097)}
    assert len(packing.plan(counts)) < 36 * 4096


def test_packing(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(77, "alpha beta " * 5000)], "doc_id long, text string"))
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(docs.repartition(3).cache(), WORDS).collect()
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want.append((r.doc_id, k // 4096, k, len(part), zlib.crc32(array("I", part).tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) == best_fit([r.length for r in rows], 4096)


def test_packing_no_rows(no_docs):
    assert packing.pack_documents(no_docs, WORDS).collect() == []


def test_packing_ranks_over_many_tasks(spark):
    pieces = spark.range(5000).select("id", (F.col("id") % 7 + 1).alias("length")).repartition(9)
    rows = packing.pack(pieces, 8).collect()
    places = {(r.sequence_id, r.offset + k) for r in rows for k in range(r.length)}
    assert len(rows) == 5000 and len(places) == sum(r.length for r in rows)


class Plain:
    """Stands for a table; gives the function of its tasks."""

    schema = None

    def mapInArrow(self, run, schema):
        return run


def test_tasks_give_back_what_other_operators_left(spark, monkeypatch):
    monkeypatch.setattr(vocabularies, "_built", {})
    tasks = [
        common.arrow_rows(Plain(), lambda batches: batches, "n long"),
        common.kept_rows(Plain(), lambda batch: []),
    ]
    for run in tasks:
        vocabularies.once(("pieces",), dict)
        assert list(run(iter([]))) == [] and not vocabularies._built
    vocabularies.once(("pieces",), dict)
    assert list(common.arrow_rows(Plain(), lambda batches: batches, "n long", holds=True)(iter([]))) == [] and vocabularies._built


def test_a_forgotten_vocabulary_gives_its_memory_back():
    """A vocabulary and its cache refer to each other, so counting references does not free them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = vocabularies.once((path, "forgotten"), lambda: packing._Ids(Vocabulary(open(path, "rb").read(), 100), 100))
    held = weakref.ref(ids.vocabulary)
    del ids
    gc.disable()
    try:
        common.forget()
        assert held() is None
    finally:
        gc.enable()
