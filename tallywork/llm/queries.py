"""The numbered queries: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from tallywork.llm import byte_bpe, byte_cnn, collocations, embedding_dups, hard_negatives, jaccard_join, packing, quality_rules, substring_dedup, tier_packing, token_counts, toxicity, url_filter
from tallywork.llm.common import held_out, label_sample, table
from tallywork.llm.registry import query

URL_RULES = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"


@query("op4_token_counts")
def op4_token_counts(spark, folder: str) -> DataFrame:
    """Tokens of every document by the byte-level vocabulary."""
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_url_filters")
def op10_url_filters(spark, folder: str) -> DataFrame:
    """Allow or block for every page's url."""
    return url_filter.judge_urls(table(spark, folder, "pages"), url_filter.parse_rules(URL_RULES))


@query("op8_quality_rules")
def op8_quality_rules(spark, folder: str) -> DataFrame:
    """Counts, base rules and the repetition verdict of every document."""
    return quality_rules.judge(table(spark, folder, "documents"))


BASE_RULES = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT r, i, w[i:i + 2] AS three FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeated AS (
  SELECT r, unnest([i, i + 1, i + 2]) AS place FROM windows QUALIFY count(*) OVER (PARTITION BY r, three) > 1
), repeats AS (
  SELECT r, count(DISTINCT place) AS n FROM repeated GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), counts AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM words LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
"""


@query("base_rules", BASE_RULES)
def base_rules(spark, folder: str) -> DataFrame:
    """What ``op8_quality_rules`` counts and what its base rules make of it, beside the SQL for both."""
    counts = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return quality_rules.judge(table(spark, folder, "documents")).select(*counts)


@query("op3_toxicity")
def op3_toxicity(spark, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs, settings = table(spark, folder, "documents"), toxicity.Settings()
    sample = label_sample(docs, table(spark, folder, "labels"), "toxic", settings.bound)
    scored = toxicity.train(sample, settings).score(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark, folder: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs, settings = table(spark, folder, "documents"), byte_cnn.Settings()
    sample = label_sample(docs, table(spark, folder, "labels"), "quality", settings.bound)
    scored = byte_cnn.train(sample, settings).score(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op1_byte_bpe")
def op1_byte_bpe(spark, folder: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    both = byte_bpe.decode(ids, ranks, out="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Components by the smallest id that links reach, from nodes(id) and links(a, b).
_REACHED = """
, ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links)
, reached(id, other) AS (
  SELECT id, id FROM nodes UNION SELECT r.id, ends.b FROM reached r JOIN ends ON ends.a = r.other
), components AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id AS id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), nodes AS (SELECT id, len(s) AS n, s FROM sets),
members AS (SELECT id, n, unnest(s) AS shingle FROM nodes),
frequent AS (SELECT shingle FROM members GROUP BY shingle HAVING count(*) > 1),
shared AS (SELECT id, n, shingle FROM members JOIN frequent USING (shingle)),
links AS (
  SELECT x.id AS a, y.id AS b FROM shared x JOIN shared y ON x.shingle = y.shingle AND x.id < y.id
  WHERE 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
  GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
) {_REACHED}
SELECT n.id AS doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.component_id FROM nodes n JOIN components c ON c.id = n.id
"""

NEAR_VECTORS = f"""
WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS v,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings
), lengths AS (SELECT *, sqrt(list_dot_product(v, v)) AS length FROM nodes WHERE usable),
links AS (
  SELECT x.id AS a, y.id AS b FROM lengths x JOIN lengths y ON x.label = y.label AND len(x.v) = len(y.v) AND x.id < y.id
  WHERE list_dot_product(x.v, y.v) / (x.length * y.length) >= 0.98
) {_REACHED}
SELECT n.id AS vec_id, (SELECT count(*) FROM ends WHERE ends.a = n.id) AS n_links, c.component_id, n.id = c.component_id AS kept
FROM nodes n JOIN components c ON c.id = n.id
"""


@query("op7_ngram_jaccard_join", NGRAM_JOIN)
def op7_ngram_jaccard_join(spark, folder: str) -> DataFrame:
    """Components of documents that share nine tenths of their three-word shingles."""
    return jaccard_join.components(table(spark, folder, "documents"))


@query("op6_embedding_near_dedup", NEAR_VECTORS)
def op6_embedding_near_dedup(spark, folder: str) -> DataFrame:
    """Links and components of vectors of equal labels."""
    return embedding_dups.near_duplicates(table(spark, folder, "embeddings"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, folder: str) -> DataFrame:
    """The repeated passages of every document that holds any."""
    return substring_dedup.repeated_spans(table(spark, folder, "documents")).drop("doc")


HARD_NEGATIVES = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label,
    list_dot_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id
WHERE s.label <> p.own AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""


@query("op11_hard_negatives", HARD_NEGATIVES)
def op11_hard_negatives(spark, folder: str) -> DataFrame:
    """For every anchor and positive, the best rows of other labels in the window below the positive's score."""
    rows = hard_negatives.from_embeddings(table(spark, folder, "embeddings"))
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return hard_negatives.mine(rows, rows.where("vec_id % 100 = 0"))


@query("op12_tier_packing")
def op12_tier_packing(spark, folder: str) -> DataFrame:
    """Every document's pieces in full windows of 1024 tokens or a smaller power of two."""
    pieces = tier_packing.pack_documents(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), pattern=public_tokenizers.PATTERN
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_group", "step_at"
    )


COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), sequences AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM sequences
), f1 AS (
  SELECT lang, w[i] AS w1, count(*) AS f FROM placed GROUP BY ALL
), f2 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM placed WHERE i < len(w) GROUP BY ALL
), f3 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM placed WHERE i < len(w) - 1 GROUP BY ALL HAVING count(*) >= 10
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang
), held AS (
  SELECT lang, w1, w2, max(f) AS longer
  FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 p JOIN f1 l ON l.lang = p.lang AND l.w1 = p.w1 JOIN f1 r ON r.lang = p.lang AND r.w1 = p.w2
  LEFT JOIN held h ON h.lang = p.lang AND h.w1 = p.w1 AND h.w2 = p.w2
  WHERE p.f >= 10 AND (h.longer IS NULL OR 100 * h.longer < 50 * p.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, l.f, r.f
  FROM f3 t JOIN f1 l ON l.lang = t.lang AND l.w1 = t.w1 JOIN f2 r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, l.f, r.f
  FROM f3 t JOIN f2 l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN f1 r ON r.lang = t.lang AND r.w1 = t.w3
), scored AS (
  SELECT *, (a::HUGEINT * a * 1000000 // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query("op13_collocations", COLLOCATIONS)
def op13_collocations(spark, folder: str) -> DataFrame:
    """Each language's best phrases of two and three words."""
    return collocations.phrases(table(spark, folder, "documents"))
