"""The operators' queries over the driver's tables, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeweir.llm import alignment, cascade, decontaminate, language, lpf, negatives, packing, paragraphs, pii, setsketch, templates, tiers, urls

#: Vocabulary files of public tokenizers; parameters of the packing and alignment operators.
TOKENIZER = "word_bpe_49k.json"
BYTES_TOKENIZER = "byte_bpe_50k.json"
PIECES_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.without_repeats(table(spark, sf_dir, "documents"))


def op2_host_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_setsketch_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op4_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op5_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op6_longest_previous_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf.without_repeats(table(spark, sf_dir, "documents"), length=400, shorter=256)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.statistics(table(spark, sf_dir, "documents"))


def op10_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_tiered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiers.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTES_TOKENIZER))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(BYTES_TOKENIZER), tokenizer_path(PIECES_TOKENIZER))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


QUERIES = {f.__name__: f for f in (
    op1_paragraph_minhash,
    op2_host_segmentation,
    op3_setsketch_near_duplicates,
    op4_suffix_automaton,
    op5_site_templates,
    op6_longest_previous_factor,
    op7_personal_data,
    op8_string_kernel,
    op9_quality_cascade,
    op10_vector_best_fit,
    op11_tiered_packing,
    op12_tokenizer_alignment,
    op13_hard_negatives,
)}

WORDS = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{WORDS}') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.seen = l.a
)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.seen) AS component_id, s.doc_id = min(r.seen) AS kept
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.s
"""

BENCH_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{BENCH_WORDS}') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '{BENCH_WORDS}') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), starts AS (
  SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS x
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT s.doc_id, s.p, s.size, k.item_id FROM starts s JOIN windows k ON s.size = k.size AND s.x = k.x
), hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
  sha256(coalesce(f.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 2], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)
), again AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '{WORDS}'))) - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '{WORDS}')))) AS dup
  FROM (SELECT doc_id, string_split(t, chr(10)) AS l FROM d)
), s AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, l.dup AS n_dup_lines, l.n_lines,
    coalesce(c.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS capitals
  FROM d JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 100 > n_words * 30
    OR n_dup_lines * 100 > n_lines * 50 OR word_chars > n_words * 15 OR word_chars < n_words * 2
    OR capitals * 2 > word_chars) AS kept
FROM s
"""

OP13_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, id, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT * FROM n WHERE rank <= 10
"""

#: What SQL can't say (segmentation, kernels, tokens, spans, markup, byte strings) is tested against brute force instead.
ORACLES = {
    "op3_setsketch_near_duplicates": OP3_SQL,
    "op4_suffix_automaton": OP4_SQL,
    "op9_quality_cascade": OP9_SQL,
    "op13_hard_negatives": OP13_SQL,
}
