"""The driver tables as posts: events give author, time and engagement, documents give text.

An event has the document numbered event_id modulo the number of documents. Texts are enriched by
doc_id modulo 8, so that negation, risk and Indic terms occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.operators.mapping import spread

AS_OF = "2024-01-31 00:00:00"

EXTRA = {0: " not buy not buy", 1: " SURE SHOT guaranteed 100%", 2: " नहीं तेजी गिरावट", 3: " never red no breakout"}
INSTEAD = {5: "not buy not buy never sell", 6: "Operator fixed target 100% jackpot"}
TAGS = {"view": "banknifty", "click": "nifty50", "purchase": "sensex", "signup": "intraday"}


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def enriched(doc_id: Column, text: Column) -> Column:
    k, out = doc_id % 8, text
    for n, extra in EXTRA.items():
        out = F.when(k == n, F.concat(text, F.lit(extra))).otherwise(out)
    for n, new in INSTEAD.items():
        out = F.when(k == n, F.lit(new)).otherwise(out)
    return out


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and content."""
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", enriched(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("content"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without text, and the doc_id of their text."""
    n = read(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n_docs"))
    e = spread(read(spark, sf_dir, "events")).crossJoin(F.broadcast(n))  # one row
    tag = F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv])[F.col("event_type")]
    return e.select(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).cast("long").alias("reply_count"),
        F.lit(0).cast("long").alias("repost_count"),
        F.floor("value").cast("long").alias("like_count"),
        (F.get_json_object("props", "$.k").cast("long") * 100).alias("view_count"),
        F.lit(0).cast("long").alias("bookmark_count"),
        F.floor("value").cast("long").alias("engagement_total"),
        F.when(tag.isNotNull(), F.array(tag)).otherwise(F.array().cast("array<string>")).alias("hashtags"),
        tag.alias("query_tag"),
        (F.col("event_id") % F.col("n_docs")).alias("doc_id"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts with their texts; documents are the smaller side in rows, each used by many events."""
    posts = events(spark, sf_dir).join(contents(spark, sf_dir), "doc_id")
    tag = F.col("query_tag")
    return posts.withColumns({"mentions": F.array().cast("array<string>"), "url": F.concat(F.lit("https://example.org/"), F.col("username"), F.lit("/status/"), F.col("tweet_id")), "query_tag": F.coalesce(tag, F.lit("")), "collected_at": as_of()}).drop("engagement_total")


# --- the same in DuckDB

EVENTS_SQL = """
n AS (SELECT count(*) AS n_docs FROM documents),
ev AS (SELECT event_id, event_id::VARCHAR AS tweet_id, 'user_' || user_id::VARCHAR AS username, ts AS timestamp,
  floor(value)::BIGINT AS engagement_total, (props::JSON->>'$.k')::BIGINT * 100 AS view_count,
  CASE event_type WHEN 'view' THEN 'banknifty' WHEN 'click' THEN 'nifty50' WHEN 'purchase' THEN 'sensex' WHEN 'signup' THEN 'intraday' END AS tag,
  event_id % n_docs AS doc_id FROM events, n)"""

CONTENTS_SQL = r"""
ct AS (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN coalesce(text, '') || ' not buy not buy' WHEN 1 THEN coalesce(text, '') || ' SURE SHOT guaranteed 100%'
  WHEN 2 THEN coalesce(text, '') || ' नहीं तेजी गिरावट' WHEN 3 THEN coalesce(text, '') || ' never red no breakout'
  WHEN 5 THEN 'not buy not buy never sell' WHEN 6 THEN 'Operator fixed target 100% jackpot' ELSE coalesce(text, '') END AS raw FROM documents),
nm AS (SELECT doc_id, raw, trim(regexp_replace(regexp_replace(raw, '[\x{200B}-\x{200D}\x{FEFF}]', '', 'g'), '[\s\x{85}\p{Z}]+', ' ', 'g')) AS content FROM ct),
an AS (SELECT doc_id, raw, content, trim(regexp_replace(regexp_replace(lower(content), 'https?://[^\s\p{Z}]+', ' <url> ', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS normalized_content FROM nm)"""
