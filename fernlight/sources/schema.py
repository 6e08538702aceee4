"""Schemas of stored posts and of signals."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _TS, _A = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.ArrayType(T.StringType())

POSTS = T.StructType([T.StructField(n, t) for n, t in (
    ("tweet_id", _S), ("username", _S), ("timestamp", _TS), ("content", _S), ("normalized_content", _S), ("language_hint", _S),
    ("reply_count", _L), ("repost_count", _L), ("like_count", _L), ("view_count", _L), ("bookmark_count", _L), ("engagement_total", _L),
    ("mentions", _A), ("hashtags", _A), ("url", _S), ("query_tag", _S), ("collected_at", _TS), ("fingerprint", _S), ("event_date", _S), ("event_hour", _S),
)])

#: A post before cleaning.
RAW = T.StructType([f for f in POSTS if f.name not in ("normalized_content", "language_hint", "engagement_total", "fingerprint", "event_date", "event_hour")])

SIGNALS = T.StructType([T.StructField(n, t) for n, t in (
    ("window_start", _S), ("market", _S), ("tweet_count", _L), ("unique_authors", _L), ("engagement_total", _L), ("bullish_count", _L), ("bearish_count", _L), ("neutral_count", _L),
    ("composite_signal", _D), ("ci95_lower", _D), ("ci95_upper", _D), ("confidence", _D), ("manipulation_risk_mean", _D),
)])

PARTITIONS = ("event_date", "event_hour")
