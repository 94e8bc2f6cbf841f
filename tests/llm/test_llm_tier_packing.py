"""Packing into windows of several lengths."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywork.llm import tier_packing
from tallywork.llm.tier_packing import _SETTLED, _Encoder, pack_documents, plan

PATH = public_tokenizers.path("byte_bpe_50k.json")


def lay_out(counts, found, window):
    """Every window's tokens, place by place, as the plan says; checks that no place is used twice."""
    used = defaultdict(set)

    def put(sequence, offset, length):
        places = set(range(offset, offset + length))
        assert not used[sequence] & places
        used[sequence] |= places

    by_length = defaultdict(list)
    for length, rank, count, first, each, offset in found.steps:
        by_length[length].append((rank, count))
        for k in range(count):
            put(first + k // each, offset + k % each * length, length)
    for length, count in counts.items():
        if length > found.filler:
            ranks = sorted(r + k for r, c in by_length[length] for k in range(c))
            assert ranks == list(range(count))
    supply = sum(n * c for n, c in counts.items() if n <= found.filler)
    for k, (start, room, first, offset) in enumerate(found.gaps):
        end = found.gaps[k + 1][0] if k + 1 < len(found.gaps) else supply
        assert (end - start) % room == 0
        for i in range((end - start) // room):
            put(first + i, offset, room)
    return used


@pytest.mark.parametrize("seed", range(12))
def test_every_window_of_a_plan_is_full(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(1, 1025), rng.choice([1, 3, 40, 400]))
    counts = {n: rng.choice([1, 2, 7, 60]) for n in lengths}
    found = plan(counts)
    used = lay_out(counts, found, 1024)
    sizes = {first + k: size for first, number, size, _ in found.windows for k in range(number)}
    assert set(used) == set(sizes)
    for sequence, places in used.items():
        assert places == set(range(sizes[sequence])) and not sizes[sequence] & (sizes[sequence] - 1)
    before = Counter()
    for first, number, size, told in found.windows:
        assert told == before[size]
        before[size] += number


def test_a_plan_does_not_grow_with_the_counts():
    lengths = range(1, 1025)
    small, large = plan({n: 5 + n % 7 for n in lengths}), plan({n: (5 + n % 7) * 10**9 for n in lengths})
    assert len(large.steps) < 40_000 and len(small.steps) < 40_000
    assert sum(n for _, n, _, _ in large.windows) > 10**11


def test_odd_counts():
    assert plan({}).steps == [] and plan({}).gaps == []
    assert [w[:3] for w in plan({37: 1}).windows] == [(0, 1, 32), (1, 1, 4), (2, 1, 1)]
    assert [w[:3] for w in plan({1024: 3, 512: 2}).windows] == [(0, 3, 1024), (3, 2, 512)]
    # Rests that leave gaps and nothing shorter to fill them with: some are cut up.
    assert sum(n * size for _, n, size, _ in plan({1000: 42}).windows) == 42_000


def test_whole_rests_fill_gaps_before_filler_does():
    found = plan({1000: 10, 24: 0, 600: 4, 424: 4, 300: 1, 30: 100})
    assert (424, 0, 4) in [s[:3] for s in found.steps if s[5] == 600]
    assert found.filler == 64


def library_ids(texts):
    library = Tokenizer.from_file(PATH)
    return [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pieces_are_the_librarys_ids_without_gaps(spark, odd_docs):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of", "Straße", "reallylongword", "1,5\n"]) for _ in range(rng.choice([3, 40, 700, 4000]))) for _ in range(60)]
    base = odd_docs.collect()
    rows = [(r.doc_id, r.text) for r in base] + [(1000 + i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(*r, "k", 1, 2, 3) for r in rows], "doc_id long, text string, task string, rank int, ids int, length int")
    got = pack_documents(frame.repartition(5), PATH, pattern=public_tokenizers.PATTERN, step_tokens=2048).collect()
    expected = Counter(
        (key, tuple(ids)) for (key, _), ids in zip(rows, library_ids([t or "" for _, t in rows])) if key is not None and key >= 1000
    )
    pieces = defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids)
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for key, ids in expected:
        own = sorted(pieces[key])
        assert [s for s, _, _ in own] == np.cumsum([0, *(len(p) for _, p, _ in own[:-1])]).tolist()
        assert tuple(i for _, p, _ in own for i in p) == ids and {n for _, _, n in own} == {len(ids)}
    # Of repeated and null ids, the tokens add up.
    assert sum(r.length for r in got) == sum(len(i) for i in library_ids([t or "" for _, t in rows]))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.window, r.step_group, r.step_at))
    for own in sequences.values():
        own.sort()
        assert [o for o, *_ in own] == np.cumsum([0, *(n for _, n, *_ in own[:-1])]).tolist()
        assert sum(n for _, n, *_ in own) == own[0][2] and len({o[2:] for o in own}) == 1
    # Groups of a window length differ by one sequence at most.
    groups = defaultdict(Counter)
    for own in sequences.values():
        groups[own[0][2]][own[0][3]] += 1
    for window, sizes in groups.items():
        assert max(sizes.values()) - min(sizes.values()) <= 1
        assert max(sizes.values()) * window <= 2048 or len(sizes) == 1


def test_no_documents(spark, no_docs):
    assert pack_documents(no_docs, PATH, pattern=public_tokenizers.PATTERN).collect() == []


def test_the_fast_way_gives_the_librarys_ids():
    with open(PATH, "rb") as file:
        encoder = _Encoder(file.read(), public_tokenizers.PATTERN)
    assert encoder.fast is not None
    library = Tokenizer.from_file(PATH)
    settled = [chr(c) for c in range(0x2100) if _SETTLED.fullmatch(chr(c))]
    texts = [f"a{c}b {c}{c} 1{c}{c}2\n{c}s '{c} {c}  x" for c in settled]
    texts += ["", " ", "x" * 30_000, "don't  I'LL we're\n\n\n  so", "a <|endoftext|> b", "<|endoftext|", "日本語 テスト ½"]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_sizes_must_be_powers_of_two(spark, no_docs):
    with pytest.raises(ValueError):
        pack_documents(no_docs, PATH, window=1000)
