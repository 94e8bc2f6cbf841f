"""Components, the n-gram join, substring dedup, near-duplicate vectors and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, jaccard_components, shingle_set
from pyspark.sql import functions as F

from tallywork.llm import cells, common, embedding_dups, jaccard_join, substring_dedup
from tallywork.llm.components import connected_components
from tallywork.llm.hnsw import Graph

TEXT = "doc_id long, text string, n_chars long, root string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "k") for d, t in rows], TEXT).repartition(3)


def near_texts(seed=1):
    """Groups of near copies around the threshold, small sets, exact copies and singles."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(8):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 30, 60, 140]))]
        for _ in range(5):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    rows += [(100, "A b"), (101, "a B"), (102, None), (103, ""), (104, " \t"), (105, "a"), (106, rows[0][1].upper())]
    return rows


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 230)] + [(7, 7)]
    frame = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == components({n for link in links for n in link}, links)
    assert connected_components(frame.limit(0)).collect() == []


@pytest.mark.parametrize("frequent", [0, 65_536])
def test_keys_meet_for_every_linked_pair(frequent):
    """Any two sets that reach the threshold share a key, also where frequent shingles are left out."""
    join = jaccard_join.Join()
    rng = np.random.default_rng(4)
    common = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64)) if frequent else np.zeros(0, np.uint64)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        own = rng.integers(0, 2**63, n).astype(np.uint64)
        if frequent:
            some = rng.random(n) < rng.choice([0.5, 1.0])
            own[some] = rng.choice(common, int(some.sum()))
        a = np.unique(own)
        changes = int(rng.integers(0, max(1, len(a) // 9) + 1))
        b = np.unique(np.concatenate([a[changes:], rng.integers(0, 2**63, int(rng.integers(0, changes + 1))).astype(np.uint64)]))
        both, all_ = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * both >= 90 * all_:
            assert np.intersect1d(jaccard_join.keys(a, common, join), jaccard_join.keys(b, common, join)).size


def test_divide_skip_equals_brute_force():
    join = jaccard_join.Join()
    rng = random.Random(3)
    for two in (False, True):
        base = [rng.sample(range(400), 60) for _ in range(4)]
        sets = []
        for b in base * 6:
            own = set(b)
            for _ in range(rng.randint(0, 4)):
                own.discard(rng.choice(b))
                own.add(rng.randrange(400))
            sets.append(np.array(sorted(own), np.uint64))
        names, sides = list(range(len(sets))), [i % 2 if two else 0 for i in range(len(sets))]
        links = list(jaccard_join.divide_skip(join, names, sides, sets))
        real = [
            (i, j)
            for i in names
            for j in range(i)
            if (not two or sides[i] != sides[j])
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 90 * len(np.union1d(sets[i], sets[j]))
        ]
        assert set(map(frozenset, links)) <= set(map(frozenset, real))
        assert components(names, links) == components(names, real)


def test_blocks_of_one_group_give_one_link():
    """Links of all cells of a large group are about as many as its items and cells, and reach what all links reach."""
    join, rng = jaccard_join.Join(), random.Random(4)
    sets = [np.array(sorted(set(range(200 * (k % 2), 200 * (k % 2) + 99)) | {1000 + k}), np.uint64) for k in range(60)]
    names, links = list(range(60)), []
    blocks = [names[at : at + 10] for at in range(0, 60, 10)]
    for i, own in enumerate(blocks):
        for j, other in enumerate(blocks[: i + 1]):
            cell = own if i == j else [*own, *other]
            rng.shuffle(cell)
            sides = [int(i != j and k in other) for k in cell]
            got = list(jaccard_join.cell_links(join, cell, sides, [sets[k] for k in cell]))
            assert i == j or len(got) == 2
            links += got
    assert len(set(components(names, links).values())) == 2


@pytest.mark.parametrize("two", [False, True])
def test_exact_jaccard_equals_brute_force(two):
    rng = np.random.default_rng(12)
    settings = substring_dedup.Settings()
    for n in (1, 2, 3, 25):
        base = np.unique(rng.integers(0, 1 << 63, 60).astype(np.uint64))
        sets = []
        for _ in range(n):
            kept = base[rng.random(len(base)) < rng.choice([0.5, 0.93, 1.0])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(rng.integers(0, 9))).astype(np.uint64)])))
        names, sides = list(range(n)), [i % 2 if two else 0 for i in range(n)]
        counts = substring_dedup.overlaps(sets, columns=16)
        assert all(counts[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in names for j in names if i != j)
        real = [
            (i, j) for i in names for j in range(i)
            if (not two or sides[i] != sides[j]) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
        ]
        links = list(substring_dedup.exact_jaccard(settings, names, sides, sets))
        assert set(links) <= set(real) and components(names, links) == components(names, real)


def test_cells_cut_clusters(spark):
    """Every pair of a cluster meets once, in cells of bounded size."""
    sets = [(1, bytes([i]), np.array([i], np.uint64).tobytes()) for i in range(60)] + [(2, b"x", b""), (2, b"x", b"")]
    frame = spark.createDataFrame([(c, bytearray(i), bytearray(s)) for c, i, s in sets], "cluster long, item binary, set binary")

    def every(names, sides, _):
        assert len(names) < 40
        two = any(sides)
        for x in range(len(names)):
            for y in range(x):
                if not two or sides[x] != sides[y]:
                    yield names[x], names[y]

    links = cells.search_cells(frame, every, items=10).collect()
    assert len(links) == len({frozenset((bytes(r.a), bytes(r.b))) for r in links}) == 60 * 59 // 2


def test_filter_grows_with_its_keys(spark):
    assert common.filter_bits(10) == 1 << 16
    assert common.filter_bits(5_000_000) >= 8 * 5_000_000
    assert common.filter_bits(common.FILTER_BITS + 1) == 0
    rows, wanted = spark.range(200_000), spark.range(0, 200_000, 50).select(F.col("id").alias("of"))
    kept = {r.id for r in common.thinned(rows, "id", wanted, "of").collect()}
    assert set(range(0, 200_000, 50)) <= kept and len(kept) < 40_000


def test_ngram_join(spark):
    rows = near_texts()
    found = jaccard_join.components(docs_of(spark, rows), join=jaccard_join.Join(seen=3, frequent=50))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == jaccard_components(rows)


def test_ngram_join_keeps_one_of_each(spark):
    rows = near_texts(2)[:25] + [(900, "a b c d"), (900, "a b c d"), (None, "a b c d"), (None, "p q r s"), (901, None), (901, None)]
    docs = docs_of(spark, rows)
    kept = jaccard_join.keep_one(docs)
    assert kept.schema == docs.schema
    want = {d for d, (_, c) in jaccard_components(rows[:25]).items() if d == c}
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    texts = dict(rows[:25])
    extra = [(900, "a b c d"), (None, "p q r s"), (901, None), (901, None)]
    assert got == sorted([(d, texts[d]) for d in want] + extra, key=repr)


def test_ngram_join_writes_no_keys_beside_the_texts(spark, monkeypatch):
    """Keys take more room than the texts and would stay until the result has been read."""
    written = []
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, label: written.append(df) or common.materialise(df, label))
    rows = near_texts(5)[:25]
    kept = jaccard_join.keep_one(docs_of(spark, rows), join=jaccard_join.Join(seen=3, frequent=50))
    assert not any(kind.startswith("array") for df in written for _, kind in df.dtypes)
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, c) in jaccard_components(rows).items() if d == c}


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(5)
    for join in (jaccard_join.Join(), jaccard_join.Join(width=5, over=80)):
        for _ in range(300):
            n, drop, more = int(rng.integers(1, 400)), int(rng.integers(0, 60)), int(rng.integers(0, 60))
            both = rng.integers(0, 1 << 62, n + more, dtype=np.uint64)
            x, y = both[: max(1, n)], both[min(drop, n - 1) :]
            same = len(np.intersect1d(x, y))
            if join.under * same >= join.over * (len(x) + len(y) - same):
                assert jaccard_join.may_link(join, len(x), jaccard_join.parity_bits(x), len(y), jaccard_join.parity_bits(y))
    x, y = (rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (200, 210))
    assert not jaccard_join.may_link(join, 200, jaccard_join.parity_bits(x), 210, jaccard_join.parity_bits(y))


@pytest.mark.parametrize("few", [1, 32])
def test_keys_shared_by_chance_do_not_glue_clusters(spark, few):
    rng = np.random.default_rng(6)
    own = rng.integers(0, 1 << 62, (30, 200), dtype=np.uint64)
    sets = [*own, own[0][:190]]  # the last is near the first
    rows = [(k, bytes([k]), len(s), jaccard_join.parity_bits(s)) for k, s in enumerate(sets)]
    # Each meets the next by a key, the last one the first.
    pairs = [(100 + k, k) for k in range(30)] + [(100 + k, k + 1) for k in range(29)] + [(7, 0), (7, 30)]
    found = jaccard_join.clustered(
        spark.createDataFrame(pairs, "key long, item long"),
        spark.createDataFrame(rows, "item long, sig binary, n long, bits binary"),
        jaccard_join.Join(width=5, over=80),
        few=few,
    )
    clusters = {r.node: r.component for r in found.collect()}
    assert clusters == ({0: 0, 30: 0} if few > 1 else {k: 0 for k in range(31)})


def test_ngram_join_odd_and_no_rows(odd_docs, no_docs):
    assert jaccard_join.components(odd_docs).count() == odd_docs.count()
    assert jaccard_join.components(no_docs).collect() == []
    assert jaccard_join.keep_one(no_docs).collect() == []


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))

    texts = {d: "\n".join(prose(rng.randint(20, 60)) for _ in range(3)) for d in range(60)}
    passages = {}
    for k in range(12):
        passage = prose(rng.choice([51, 60, 90]))
        holders = list(range(4 * k, 4 * k + 3))
        for d in holders:
            words = texts[d].split(" ")
            at = rng.randrange(1, len(words))
            texts[d] = " ".join(words[:at] + [passage] + words[at:])
        passages[passage] = holders
    return texts, passages


def test_planted_passages_go_from_all_but_one(spark, planted):
    texts, passages = planted
    docs = docs_of(spark, list(texts.items()))
    spans = substring_dedup.repeated_spans(docs).collect()
    assert {r.doc_id for r in spans} == {d for holders in passages.values() for d in holders}
    assert all(r.component_id // 4 == r.doc_id // 4 for r in spans)
    assert all(r.removed == (r.doc_id != r.component_id) for r in spans)
    new = substring_dedup.remove_repeats(docs)
    assert new.schema == docs.schema
    after = {r.doc_id: r for r in new.collect()}
    assert len(after) == len(texts)
    assert all(after[d].text == texts[d] for d in texts if d % 4 == 0)
    for passage, holders in passages.items():
        assert [passage in after[d].text for d in holders] == [True, False, False]
    for d in set(texts) - {d for holders in passages.values() for d in holders}:
        assert after[d].text == texts[d]
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_spans_are_where_the_words_are(spark, planted):
    texts, _ = planted
    for r in substring_dedup.repeated_spans(docs_of(spark, list(texts.items()))).collect():
        part = texts[r.doc_id][r.start : r.end]
        assert len(part.split()) == r.n_words and part[0].strip()
        assert r.end == len(texts[r.doc_id]) or texts[r.doc_id][r.end].strip()


def test_near_paragraphs_are_linked(spark):
    rng = random.Random(6)
    line = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    other = line[:59] + ["changed"]
    settings = substring_dedup.Settings(around=40)  # lines are the paragraphs
    assert settings.bands == 4
    docs = docs_of(spark, [(1, " ".join(line)), (2, " ".join(other)), (3, " ".join(f"x{i}" for i in range(60)))])
    got = sorted((r.doc_id, r.removed, r.n_words) for r in substring_dedup.repeated_spans(docs, settings=settings).collect())
    assert got == [(1, False, 60), (2, True, 60)]


def fresh(tag):
    """Words that no other text holds."""
    return lambda n, rows=iter(range(10**6)): " ".join(f"{tag}{next(rows)}" for _ in range(n))


def edited(text, times):
    words = text.split(" ")
    for k in range(times):
        words[(2 * k + 1) * len(words) // (2 * times)] = f"edit{k}"
    return " ".join(words)


def test_edited_and_wrapped_passages_go(spark):
    own, rows, want = fresh("e"), [], {}
    for n, times in ((60, 1), (200, 4), (100, 0)):
        passage = own(n)
        words = edited(passage, times).split(" ")
        wrapped = "\n".join(" ".join(words[i : i + 9]) for i in range(0, n, 9))
        for copy in (passage, " ".join(words), wrapped):
            head, tail = own(30), own(30)
            want[len(rows)] = f"{head}\n{passage}\n{tail}" if copy is passage else f"{head}\n{tail}"
            rows.append((len(rows), f"{head}\n{copy}\n{tail}"))
    assert {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()} == {
        d: want[d] for d, _ in rows
    }


def test_all_holders_count(spark):
    own = fresh("h")
    one, two, hot, passage = own(10), own(10), own(10), own(40)
    rows = [(1, f"{own(30)}\n{one}\n{own(30)}"), (2, f"{own(30)}\n{two}\n{own(30)}"), (3, f"{own(30)}\n{one}\n{two}\n{own(30)}")]
    rows += [(d, f"{own(30)}\n{hot}\n{own(30)}") for d in range(10, 20)]
    rows += [(d, f"{own(30)}\n{hot}\n{passage}\n{own(30)}") for d in (20, 21)]
    found = substring_dedup.repeated_spans(docs_of(spark, rows)).collect()
    got = sorted((r.doc_id, r.start, r.n_words, r.component_id, r.n_docs, r.removed) for r in found)
    at = {d: t.index("\n") + 1 for d, t in rows}
    assert got == [
        (3, at[3], 20, 1, 2, True),
        (20, at[20], 10, 10, 12, True),
        (20, at[20] + len(hot) + 1, 40, 20, 2, False),
        (21, at[21], 50, 10, 12, True),
    ]


def test_short_lines_are_found(spark):
    own, rng = fresh("s"), random.Random(9)
    lines = "\n".join(own(rng.randint(1, 4)) for _ in range(30))
    rows = [(d, f"{own(30)}\n{lines}\n{own(30)}") for d in (1, 2)]
    got = sorted((r.doc_id, r.n_words, r.removed) for r in substring_dedup.repeated_spans(docs_of(spark, rows)).collect())
    n = len(lines.split())
    assert n > 50 and got == [(1, n, False), (2, n, True)]


def test_passages_go_to_their_ends(spark):
    own, rows, want = fresh("p"), [], {}
    for k in range(300):
        passage = own((16, 51, 60)[k % 3])
        for copy in range(2):
            head, tail = own(20), own(20)
            want[len(rows)] = f"{head} {passage} {tail}" if copy == 0 else f"{head} {tail}"
            rows.append((len(rows), f"{head} {passage} {tail}"))
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    assert got == want


def test_substring_odd_and_no_rows(spark, odd_docs, no_docs):
    new = substring_dedup.remove_repeats(odd_docs)
    assert new.schema == odd_docs.schema and new.count() == odd_docs.count()
    assert substring_dedup.repeated_spans(no_docs).collect() == []
    assert substring_dedup.remove_repeats(no_docs).collect() == []


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for label in (1, 2, None):
        for _ in range(30):
            base = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 5))):
                rows.append((len(rows), (base + 0.04 * rng.standard_normal(16)).astype(np.float32).tolist(), label))
    center = rng.standard_normal(16)
    for _ in range(120):  # a group larger than the first beam
        rows.append((len(rows), (center + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist(), 2))
    for v in (None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]):
        rows.append((len(rows), v, 1))
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(3)]
    rows.append((None, rows[5][1], rows[5][2]))
    return rows


def brute_vectors(rows, least=0.98):
    ok = [
        l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows
    ]
    n = len(rows)
    links = []
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links.append((j, i))
    found = components(range(n), links)
    lowest = {}
    for i in range(n):
        if rows[i][0] is not None:
            lowest[found[i]] = min(lowest.get(found[i], rows[i][0]), rows[i][0])
    degree = [0] * n
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return sorted(((r[0], d, lowest.get(found[i])) for i, (r, d) in enumerate(zip(rows, degree))), key=repr)


@pytest.mark.parametrize("shard", [16_384, 60])
def test_near_vectors(spark, shard):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = embedding_dups.near_duplicates(frame, settings=embedding_dups.Settings(shard=shard)).collect()
    want = brute_vectors(rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_beams_widen_until_audits_pass():
    """A beam of one misses links; that next to no query has one must not hide it: planted copies show it."""
    rng = np.random.default_rng(8)
    left = rng.standard_normal((3000, 128))
    pairs = [(5 + 80 * k, 41 + 80 * k) for k in range(20)]
    for a, b in pairs:
        left[b] = left[a] + 0.15 * rng.standard_normal(128)
    settings = embedding_dups.Settings(beam=1, audited=4)
    built = Graph(embedding_dups.units(left), links=4, beam=8)
    graph = Graph.of_rows(built.vectors, built.rows(), links=4)
    assert all((x == y).all() for x, y in zip(graph.layers, built.layers)) and (graph.tops == built.tops).all()
    beam, recall = embedding_dups.audited_beam(graph, graph.vectors, settings)
    assert beam > 1 and recall >= settings.recall
    got = {(q, int(r)) for q, found in embedding_dups.cell_links(graph, left, None, beam, settings) for r in found}
    want = {p for a, b in pairs for p in ((a, b), (b, a))}
    assert got <= want and len(got) >= 0.9 * len(want)


def test_planted_copies_are_near():
    rng = np.random.default_rng(2)
    unit = embedding_dups.units(rng.standard_normal((50, 16)))
    made = embedding_dups.planted_copies(unit, 200, 0.98)
    best = (made @ unit.T).max(axis=1)
    assert (best >= 0.98 - 1e-5).all() and (best < 1 + 1e-5).all() and best.min() < 0.985
    assert embedding_dups.planted_copies(np.ones((1, 1), np.float32), 5, 0.98).shape == (5, 1)


def test_graphs_are_built_once_a_shard_and_searched_by_all(spark):
    """Links in many shards of one label, and recall per search."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal((900, 24))
    copies = base[rng.integers(0, 900, 600)] + 0.05 * rng.standard_normal((600, 24))
    rows = [(i, v.tolist(), 1, 0.5) for i, v in enumerate(np.concatenate([base, copies]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, recall double").repartition(4)
    settings = embedding_dups.Settings(shard=300)
    found = embedding_dups.find(frame, "vec_id", "embedding", "label", settings)
    audits = embedding_dups.audits(found).collect()
    shards = 1 + max(r.other for r in audits)
    assert shards == 5 and {(r.shard, r.other) for r in audits} == {(i, j) for j in range(shards) for i in range(j + 1)}
    assert len(audits) == shards * (shards + 1) // 2 and all(r.recall >= settings.recall for r in audits)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dups.linked(found).collect()}
    want = {i: (n, c) for i, n, c in brute_vectors([(i, v, l) for i, v, l, _ in rows])}
    assert sum(n for n, _ in want.values()) > 600
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)


def test_links_count_for_both_ends():
    rng = np.random.default_rng(9)
    one = rng.random((611, 611)) < 0.01
    copies = rng.integers(1, 4, 611)
    assert (embedding_dups.both_ends(np.packbits(one, axis=1), copies) == (one | one.T) @ copies).all()


def test_vectors_no_rows(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dups.near_duplicates(none).collect() == []


def test_graph_recall():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((1500, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = Graph(vectors)
    assert len(graph.layers) > 1
    ids, score = graph.search(vectors[:100], 64)
    best = np.argsort(-(vectors[:100] @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(best[i]) & set(ids[i][:10])) / 10 for i in range(100)]) > 0.9
    assert (np.diff(score, axis=1) <= 0).all()


def test_pipeline_drops_near_copies(spark):
    """200 words with four edits: 0.815 on five words, 0.886 on three."""
    import corpus_pipeline

    base = fresh("n")(200)
    docs = docs_of(spark, [(1, base), (2, edited(base, 4)), (3, edited(base, 8))])
    kept = corpus_pipeline.distinct(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_pipeline(spark, tmp_path):
    """The stages against what plain Python says of the same documents."""
    import corpus_pipeline

    rng = random.Random(12)
    names = [f"n{i}" for i in range(900)]

    def prose(n):
        return " ".join(rng.choice(names) for _ in range(n))

    rows = [(i, prose(90)) for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # exact copies
    rows += [(200 + i, prose(60) + " vile nasty vile") for i in range(40)]  # toxic
    rows += [(300, "short"), (301, "again and " * 60), (302, None)]
    passage = prose(70)
    rows += [(400 + i, f"{prose(50)} {passage} {prose(50)}") for i in range(3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], schema)
    labels = [(d, 1, int(200 <= d < 300)) for d, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, counts = docs, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        before, kept = kept, spark.read.parquet(f"{tmp_path}/stage{k}")
        if k < 4:
            assert kept.columns == docs.columns
            counts.append({r.doc_id for r in kept.select("doc_id").collect()})
    everything = {d for d, _ in rows}
    assert everything - counts[0] == {300, 301, 302}
    assert counts[0] - counts[1] == {d for d in everything if 200 <= d < 300}
    assert counts[1] - counts[2] == {100, 101, 102, 103, 104}
    assert counts[3] == counts[2]
    after = {r.doc_id: r.text for r in before.collect()}
    assert [passage in after[400 + i] for i in range(3)] == [True, False, False]
    assert {r.doc_id for r in kept.collect()} == counts[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept.count()


def shared_windows(texts, width=16):
    """Windows of so many words that more than one text holds, and who holds them."""
    holders = {}
    for d, text in texts.items():
        words = text.split()
        for i in range(len(words) - width + 1):
            holders.setdefault(tuple(words[i : i + width]), set()).add(d)
    return {w: ds for w, ds in holders.items() if len(ds) > 1}


def test_no_shared_window_stays_and_none_is_lost(spark):
    """Copies, edited copies, passages inside lines, wrapped ones, stock phrases and repeated words."""
    rng, rows = random.Random(21), []
    words = [f"w{i}" for i in range(4000)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    def lines(own):
        return "\n".join(" ".join(own[i : i + 12]) for i in range(0, len(own), 12))

    passages, stock = [prose(rng.choice([16, 30, 55, 120])) for _ in range(12)], prose(9)
    for d in range(90):
        own = prose(rng.choice([30, 120, 300]))
        for passage in rng.sample(passages, rng.choice([0, 1, 2])):
            at = rng.randrange(len(own))
            own[at:at] = passage
        if d % 4 == 0:
            at = rng.randrange(len(own))
            own[at:at] = stock
        rows.append((d, lines(own)))
    for d in range(20):
        own = rows[d][1].split()
        for _ in range(rng.choice([0, 1, 4])):
            own[rng.randrange(len(own))] = "edit"
        rows.append((100 + d, rng.choice([lines, " ".join])(own)))
    rows += [(200 + d, "the " * (40 + d)) for d in range(4)] + [(210 + d, "la di " * (30 + d)) for d in range(3)]
    before = dict(rows)
    after = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs_of(spark, rows)).collect()}
    shared = shared_windows(before)
    # What a document has now and had before, window by window: none is in two documents, and none is in no document.
    held = {}
    for d, text in after.items():
        old = {tuple(before[d].split()[i : i + 16]) for i in range(len(before[d].split()) - 15)}
        new = text.split()
        for i in range(len(new) - 15):
            if (window := tuple(new[i : i + 16])) in old and window in shared:
                held.setdefault(window, set()).add(d)
    assert len(shared) > 500 and not {w: ds for w, ds in held.items() if len(ds) > 1}
    # Windows of passages, and of copied documents without passages and stock phrases, stay in one; others may lie across the
    # ends of what goes, as a stock phrase does inside a longer run.
    inside = {tuple(p[i : i + 16]) for p in passages for i in range(len(p) - 15)}
    own = {d: {w for w, ds in shared.items() if d in ds} for d in range(20) if d % 4}
    inside |= set().union(*(ws for d, ws in own.items() if all(shared[w] == {d, 100 + d} for w in ws)))
    assert len(inside & set(shared)) > 500 and not [w for w in inside & set(shared) if w not in held]
    assert all(after[d] == before[d] for d in before if not any(d in ds for ds in shared.values()))


def test_keys_are_made_twice(spark):
    """Once to find those that several sets have, once for the sets that have them."""
    join = jaccard_join.Join(width=1)
    sets = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 0, 1, 500, 900)]
    sigs = [jaccard_join.signature(s) for s in sets]
    items = [int.from_bytes(sig[:8], "little", signed=True) for sig in sigs]
    met = spark.sparkContext.accumulator(0)
    given = [(k, item) for s, item in zip(sets, items) for k in jaccard_join.keys(s, np.zeros(0, np.uint64), join).view(np.int64).tolist()]

    def passed(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    pairs = spark.createDataFrame(given, "key long, item long").mapInArrow(passed, "key long, item long")
    rows = [(i, bytearray(sig), len(s), bytearray(jaccard_join.parity_bits(s))) for i, sig, s in zip(items, sigs, sets)]
    clusters = jaccard_join.clustered(pairs, spark.createDataFrame(rows, "item long, sig binary, n long, bits binary"), join)
    assert {r.node for r in clusters.collect()} == {items[0], items[2]}
    assert met.value == 2 * len(given)


def test_flat_columns_give_the_same_lists():
    marks = [{"start": 3, "removed": True, "id": "x", "before": [1, -2]}, {"start": 5, "removed": False, "id": None, "before": []}]
    fields = [("start", pa.int32()), ("removed", pa.bool_()), ("id", pa.string()), ("before", pa.list_(pa.int64()))]
    kind = pa.list_(pa.struct(fields))
    column = pa.array([marks, [], marks[1:], None, marks[:1]], kind)
    for own in (column, column[:3], column[1:3], column[2:], column[:0], column[3:4]):
        assert substring_dedup._plain(own) == own.to_pylist()
    assert substring_dedup._plain(pa.array([1, None, 3])) == [1, None, 3]
