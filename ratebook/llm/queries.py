"""One registered query per operator: its digest columns over the whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, decontamination, importance, ngram_join, packing, ppm, quality_rules, simhash, substring_dedup, suffix_dedup, token_counts, toxicity

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), VOCABULARY)


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), VOCABULARY)


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    saying = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(saying).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup_windows(table(spark, folder, "documents")).drop("kept")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("key")


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_strings(table(spark, folder, "documents")).drop("kept")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(
        table(spark, folder, "documents"), table(spark, folder, "labels"), fold(5) == 0
    )


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents")).drop("set", "key", "component")


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.score(table(spark, folder, "documents"), fold(7) == 2)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("n_words")


def op12_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_chat_formatting, op3_quality_rules, op4_token_counts, op5_substring_dedup, op6_decontamination, op7_suffix_dedup, op8_toxicity, op9_ngram_jaccard_join, op10_lm_scoring, op11_importance_resampling, op12_simhash_dedup, op13_collocations)
}

_DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT item, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w
  FROM b WHERE len(w) > 0),
bs AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM bw),
ns AS (SELECT DISTINCT n FROM bs),
dw AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n),
h AS (
  SELECT doc_id, i, n, s FROM (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s FROM dw)
  WHERE (n, s) IN (SELECT n, s FROM bs)),
p AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
m AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h JOIN bs USING (n, s)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""

# A CRC is a sum without carry of what each byte becomes by the bytes behind it: `k` tables that by
# distance from the end, `z` what the start value becomes.
_IMPORTANCE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
fd AS (
  SELECT doc_id, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
    || [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS f FROM d),
fb AS (
  SELECT unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
    || [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS f FROM b),
f AS (
  SELECT f, hex(encode(f)) AS x, length(x) // 2 AS n
  FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
steps(b, s, i) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, i + 1
  FROM steps WHERE i < 8),
t AS MATERIALIZED (SELECT b, s FROM steps WHERE i = 8),
k(v, d, s) AS (
  SELECT printf('%02X', b), 0, s FROM t
  UNION ALL
  SELECT v, d + 1, xor(t.s, k.s >> 8) FROM k JOIN t ON t.b = k.s & 255
  WHERE d < (SELECT max(n) FROM f)),
z(n, s) AS (
  SELECT 0, 4294967295
  UNION ALL
  SELECT n + 1, xor(t.s, z.s >> 8) FROM z JOIN t ON t.b = z.s & 255
  WHERE n < (SELECT max(n) FROM f)),
bytes AS (
  SELECT f, n, substr(x, CAST(2 * i - 1 AS BIGINT), 2) AS v, n - i AS d
  FROM (SELECT f, x, n, unnest(range(1, n + 1)) AS i FROM f)),
h AS (
  SELECT f, xor(xor(bit_xor(k.s), any_value(z.s)), 4294967295) % 10000 AS bucket
  FROM bytes JOIN k USING (v, d) JOIN z USING (n) GROUP BY f),
sums AS (SELECT bucket, count(*) AS s FROM fd JOIN h USING (f) GROUP BY bucket),
aims AS (SELECT bucket, count(*) AS t FROM fb JOIN h USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE
    * ((SELECT count(*) FROM fd) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM fb) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM sums LEFT JOIN aims USING (bucket)),
w AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM fd JOIN h USING (f) JOIN gains USING (bucket) GROUP BY doc_id),
u AS (
  SELECT doc_id, len(w) AS n_words, CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM d),
r AS (
  SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0)
      + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM u LEFT JOIN w USING (doc_id)),
o AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM r WHERE n_words >= 20)
SELECT r.doc_id, n_features, weight, score, o.rank
FROM r LEFT JOIN o
  ON r.doc_id = o.doc_id AND o.rank <= (SELECT 5 * count(*) // 100 FROM r WHERE n_words >= 20)
"""

_COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
c AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS a FROM (
    SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ')
      FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM w, (VALUES (1), (2), (3)) AS sizes(size))
  GROUP BY lang, size, phrase),
k AS (SELECT *, string_split(phrase, ' ') AS w FROM c WHERE size > 1 AND a >= 10),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[: k], ' ') AS f1,
    array_to_string(w[k + 1 :], ' ') AS f2
  FROM (SELECT *, unnest(range(1, size)) AS k FROM k)),
s AS (
  SELECT cuts.*, l.a AS l, r.a AS r,
    CAST(1000000::HUGEINT * cuts.a * cuts.a // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts JOIN c l ON l.lang = cuts.lang AND l.phrase = f1
    JOIN c r ON r.lang = cuts.lang AND r.phrase = f2),
best AS (
  SELECT * FROM s
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM k WHERE size = 3) GROUP BY lang, phrase),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang)
SELECT lang, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN inner_ USING (lang, phrase) JOIN n USING (lang)
WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op6_decontamination": _DECONTAMINATION,
    "op11_importance_resampling": _IMPORTANCE,
    "op13_collocations": _COLLOCATIONS,
}
