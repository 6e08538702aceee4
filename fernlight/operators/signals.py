"""Window signals per market, the run summary and value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernlight.functions import features as X
from fernlight.functions.numbers import round6
from fernlight.functions.text import HINTS

#: What a summary says about its method.
METHODOLOGY = {
    "text_features": "finance lexicon + negation + manipulation-risk discount",
    "weighting": "recency decay + log engagement + log reach",
    "confidence_interval": "normal approximation over weighted window variance",
    "disclaimer": "Research signal only; not financial advice or an execution strategy.",
}

COUNTS = ("tweet_count", "unique_authors", "engagement_total", "bullish_count", "bearish_count", "neutral_count")


def aggregates(approximate_authors: bool = False, authors: bool = True) -> list[Column]:
    """Mergeable aggregates of one window; approximate_authors for very wide windows. Without authors, all can be summed again."""
    author = F.coalesce(F.nullif("username", F.lit("")), F.lit("unknown"))
    w, s = F.col("weight"), F.col("signal")
    return [
        F.count(F.lit(1)).alias("tweet_count"),
        *([(F.approx_count_distinct(author) if approximate_authors else F.countDistinct(author)).alias("unique_authors")] if authors else []),
        F.sum(F.coalesce("engagement_total", F.lit(0))).alias("engagement_total"),
        F.count_if(s > 0.05).alias("bullish_count"),
        F.count_if(s < -0.05).alias("bearish_count"),
        F.count_if((s >= -0.05) & (s <= 0.05)).alias("neutral_count"),
        F.sum(w).alias("__w"), F.sum(w * s).alias("__ws"), F.sum(w * s * s).alias("__wss"), F.sum("manipulation_risk").alias("__risk"),
    ]


def finish(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean, its interval, and the confidence score, from the sums of `aggregates`."""
    n, w = F.col("tweet_count"), F.col("__w")
    mean = F.when(w != 0, F.col("__ws") / w).otherwise(F.lit(0.0))
    df = groups.withColumn("__mean", mean)
    variance = F.greatest(F.lit(0.0), F.when(w != 0, F.col("__wss") / w).otherwise(F.lit(0.0)) - F.col("__mean") * F.col("__mean"))
    df = df.withColumn("__margin", 1.96 * F.sqrt(variance / F.greatest(F.lit(1.0), F.least(n.cast("double"), w))))
    score = 0.45 * F.least(F.lit(1.0), n / 40) + 0.35 * (F.col("unique_authors") / F.greatest(F.lit(1), n)) + 0.20 * F.greatest(F.lit(0.0), 1.0 - F.col("__margin"))
    return df.select(
        *keys, *COUNTS,
        round6(F.col("__mean")).alias("composite_signal"),
        round6(F.greatest(F.lit(-1.0), F.col("__mean") - F.col("__margin"))).alias("ci95_lower"),
        round6(F.least(F.lit(1.0), F.col("__mean") + F.col("__margin"))).alias("ci95_upper"),
        round6(F.least(F.lit(1.0), score)).alias("confidence"),
        round6(F.col("__risk") / n).alias("manipulation_risk_mean"),
    )


def _keyed(scored: DataFrame, minutes: int, *more: Column) -> DataFrame:
    return scored.select(
        X.window_start(F.col("timestamp"), minutes).alias("window_start"), X.market(F.col("hashtags"), F.col("query_tag")).alias("market"),
        "username", "engagement_total", "signal", "weight", "manipulation_risk", *more,
    )


def signals(scored: DataFrame, *, minutes: int = 15) -> DataFrame:
    """One row per (window, market) of posts that have signal and weight; unordered."""
    out = finish(_keyed(scored, minutes).groupBy("window_start", "market").agg(*aggregates()), ["window_start", "market"])
    return out.withColumn("window_start", X.iso(F.col("window_start")))


def language_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy(F.coalesce(F.nullif("language_hint", F.lit("")), F.lit("unknown")).alias("language_hint")).agg(F.count(F.lit(1)).alias("n"))


def label(x: Column) -> Column:
    return F.when(x > 0.08, "bullish").when(x < -0.08, "bearish").otherwise("neutral")


def _totals() -> list[Column]:
    return [F.coalesce(F.sum("tweet_count"), F.lit(0)).alias("tweet_count"), F.count(F.lit(1)).alias("window_count"), F.sum(F.col("composite_signal") * F.col("tweet_count")).alias("__s")]


def _told(total: DataFrame) -> DataFrame:
    """The summary of one row of totals and language_counts."""
    some = F.col("window_count") > 0
    overall = F.when(some, F.when(F.col("tweet_count") > 0, F.col("__s") / F.col("tweet_count")).otherwise(F.lit(0.0)))
    return total.withColumn("__o", overall).select(
        "tweet_count", F.when(some, F.col("window_count")).alias("window_count"), F.when(~some, F.lit("no_data")).alias("status"),
        round6(F.col("__o")).alias("overall_signal"), F.when(some, label(F.col("__o"))).alias("overall_label"), "language_counts",
        F.when(some, F.struct(*[F.lit(v).alias(k) for k, v in METHODOLOGY.items()])).alias("methodology"),
    )


def summary(signal_rows: DataFrame, languages: DataFrame) -> DataFrame:
    """One row. Over no windows: status no_data and no other figures. Languages are a map."""
    langs = languages.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("language_hint", "n")))).alias("language_counts"))
    return _told(signal_rows.agg(*_totals()).crossJoin(F.broadcast(langs)))  # one row each


def signals_with_languages(scored: DataFrame, *, minutes: int = 15) -> DataFrame:
    """As signals, with `languages`: posts of each of HINTS. From posts that have signal, weight and language_hint, read and grouped once."""
    hint = F.coalesce(F.nullif("language_hint", F.lit("")), F.lit("unknown"))
    counts = [F.count_if(F.col("__hint") == h) for h in HINTS]
    groups = _keyed(scored, minutes, hint.alias("__hint")).groupBy("window_start", "market").agg(*aggregates(), F.array(*counts).alias("languages"))
    return finish(groups, ["window_start", "market", "languages"]).withColumn("window_start", X.iso(F.col("window_start")))


def summary_of(windows: DataFrame) -> DataFrame:
    """As summary, from signals with their languages."""
    totals = [F.coalesce(F.sum(F.get("languages", F.lit(k))), F.lit(0)).alias(f"__n{k}") for k in range(len(HINTS))]
    counts = F.map_from_arrays(F.array(*map(F.lit, HINTS)), F.array(*[f"__n{k}" for k in range(len(HINTS))]))
    return _told(windows.agg(*_totals(), *totals).withColumn("language_counts", F.map_filter(counts, lambda _, n: n > 0)))


def run_summary(scored: DataFrame, *, minutes: int = 15) -> DataFrame:
    """As summary, from posts that have signal, weight and language_hint (one of HINTS), which are read and grouped once."""
    return summary_of(signals_with_languages(scored, minutes=minutes))
