"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.llm import bpe, exact_dedup, html_text, importance, line_dedup, media, mixing, phrases, pieces, quality, sharding, simhash_dedup, substring_dedup
from fernlight.llm.common import ship
from fernlight.operators.mapping import spread


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), window=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media_digests(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic margin is the form and length class of a text: the table has no topics."""
    out = mixing.mixture(spread(_read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")))
    return out.withColumns({c: F.round(c, 6) for c in ("p", "residual", "off_goal")})


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")), _read(spark, sf_dir, "labels"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digests(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(spread(_read(spark, sf_dir, "pages")))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")), shingle=4)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_read(spark, sf_dir, "documents"), shards=24)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_read(spark, sf_dir, "documents"), keep="largest")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_chunks(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")), _read(spark, sf_dir, "benchmark"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spread(_read(spark, sf_dir, "documents").select("lang", "text")))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_media_columns, op3_source_mixing, op4_quality_classifier, op5_sentencepiece, op6_html_extraction, op7_simhash_dedup, op8_sharding, op9_exact_dedup, op10_line_dedup, op11_importance_resampling, op12_phrase_collocations, op13_bpe)}

ORACLES = {
    "op1_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, w FROM d),
x AS (SELECT doc_id, p, w[p] AS word, CASE WHEN p + 49 <= len(w) THEN sha256(array_to_string(w[p:p + 49], ' ')) END AS h FROM s),
m AS (SELECT doc_id, p, word, h IS NOT NULL AND min(doc_id) OVER (PARTITION BY h) < doc_id AS gone FROM x),
k AS (SELECT doc_id, p, word, max(gone::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS covered FROM m),
t AS (SELECT doc_id, count(*) FILTER (covered) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT covered) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id)
""",
    "op3_source_mixing": mixing.mixture_sql(),
    "op11_importance_resampling": importance.resample_sql(),
    "op12_phrase_collocations": phrases.collocations_sql(),
    "op9_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
""",
    "op10_line_dedup": """
WITH a AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
b AS (SELECT *, list_transform(l, lambda x: md5(x)) AS h FROM a),
c AS (SELECT *, list_filter(range(1, len(l) + 1), lambda i: i = len(l) OR left(md5(CASE WHEN i > 1 THEN h[i - 1] ELSE '' END || h[i]), 1) IN ('0', '4', '8', 'c')) AS e FROM b),
u AS (SELECT doc_id, l, e, unnest(range(1, len(e) + 1)) AS k FROM c),
v AS (SELECT doc_id, len(l) AS n_lines, len(e) AS n_chunks, k, CASE WHEN k > 1 THEN e[k - 1] ELSE 0 END + 1 AS s, e[k] AS z, l FROM u),
w AS (SELECT doc_id, n_lines, n_chunks, k, z - s + 1 AS n, array_to_string(l[s:z], chr(10)) AS t FROM v),
r AS (SELECT *, n >= 2 AND row_number() OVER (PARTITION BY n >= 2, t ORDER BY doc_id, k) > 1 AS gone FROM w)
SELECT doc_id, any_value(n_lines)::INT AS n_lines, any_value(n_chunks)::INT AS n_chunks, coalesce(sum(n) FILTER (gone), 0)::INT AS n_removed, sha256(coalesce(string_agg(t, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
""",
}
