"""Lexicon features, signal and weight of a post as Columns."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernlight.functions import text as T
from fernlight.functions.lexicon import BEARISH, BULLISH, MARKETS, NEGATIONS, RISK


def hits(lowered: Column, terms: tuple[str, ...]) -> Column:
    """How many terms occur in the text at all, each as often as the list has it."""
    total = F.lit(0)
    for term, weight in Counter(terms).items():
        total = total + F.contains(lowered, F.lit(term)).cast("int") * weight
    return total


def flips(tokens: Column) -> Column:
    """1 for each negated bullish token and -1 for each negated bearish one, in order."""

    def flip(token: Column, i: Column) -> Column:
        after = F.get(tokens, i + 1)
        return F.when(token.isin(*NEGATIONS), F.when(after.isin(*set(BULLISH)), F.lit(1)).when(after.isin(*set(BEARISH)), F.lit(-1)))

    return F.filter(F.transform(tokens, flip), lambda x: x.isNotNull())


def folded(bullish: Column, bearish: Column, turned: Column) -> Column:
    """struct(b, s) after each flip moves a hit to the other side, none going below 0."""
    start = F.struct(bullish.cast("int").alias("b"), bearish.cast("int").alias("s"))

    def step(acc: Column, x: Column) -> Column:
        up = F.struct(F.greatest(acc["b"] - 1, F.lit(0)).alias("b"), (acc["s"] + 1).alias("s"))
        down = F.struct((acc["b"] + 1).alias("b"), F.greatest(acc["s"] - 1, F.lit(0)).alias("s"))
        return F.when(x == 1, up).otherwise(down)

    return F.aggregate(turned, start, step)


def with_features(df: DataFrame, text_col: str) -> DataFrame:
    """Adds polarity, bullish_hits, bearish_hits, manipulation_risk, uppercase_ratio, exclamation_count."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def counted(low: Column) -> Column:
        negated = reduce(lambda a, t: a | F.contains(low, F.lit(t)), NEGATIONS, F.lit(False))  # most texts hold no negation and need no tokens
        tokens = F.when(negated, T.tokens(low)).otherwise(F.array().cast("array<string>"))
        return F.struct(hits(low, BULLISH).alias("b"), hits(low, BEARISH).alias("s"), hits(low, RISK).alias("r"), tokens.alias("tokens"))

    # a lambda's argument is evaluated once, even where a filter is pushed below and repeats the expression
    df = df.withColumn("__low", F.get(F.transform(F.array(F.lower(text)), counted), F.lit(0)))
    df = df.withColumn("__hit", F.get(F.transform(F.array("__low"), lambda x: folded(x["b"], x["s"], flips(x["tokens"]))), F.lit(0)))
    b, s = F.col("__hit.b"), F.col("__hit.s")
    df = df.withColumns({"bullish_hits": b, "bearish_hits": s, "uppercase_ratio": T.uppercase_ratio(text), "exclamation_count": T.exclamations(text)})
    risk = F.least(F.lit(1.0), F.col("__low.r") * F.lit(0.3) + F.greatest(F.lit(0.0), F.col("uppercase_ratio") - 0.45))
    df = df.withColumns({"polarity": F.when(b + s > 0, (b - s) / (b + s)).otherwise(F.lit(0.0)), "manipulation_risk": risk})
    return df.drop("__low", "__hit")


def recency(timestamp: Column, as_of: Column) -> Column:
    hours = (F.unix_micros(as_of) - F.unix_micros(timestamp)) / F.lit(3.6e9)
    return F.exp(-F.greatest(F.lit(0.0), hours) / 12.0)


def social(engagement: Column, views: Column) -> Column:
    zero = F.lit(0)
    return F.least(F.lit(3.0), 1.0 + 0.22 * F.log1p(F.greatest(zero, engagement)) + 0.08 * F.log1p(F.greatest(zero, views)))


def with_signal(df: DataFrame, as_of: Column, *, timestamp: str = "timestamp", engagement: str = "engagement_total", views: str = "view_count") -> DataFrame:
    """Adds signal and weight; as_of is explicit so that results repeat."""
    quality = 1.0 - 0.65 * F.col("manipulation_risk")
    seen = recency(F.col(timestamp), as_of) * social(F.coalesce(F.col(engagement), F.lit(0)), F.coalesce(F.col(views), F.lit(0)))
    return df.withColumns({"signal": F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("polarity") * quality)), "weight": F.greatest(F.lit(0.05), seen * quality)})


def market(hashtags: Column, query_tag: Column) -> Column:
    tags = F.array_union(F.transform(F.coalesce(hashtags, F.array().cast("array<string>")), F.lower), F.array(F.lower(F.coalesce(query_tag, F.lit("")))))
    out = F.when(F.array_contains(tags, MARKETS[0]), MARKETS[0])
    for m in MARKETS[1:]:
        out = out.when(F.array_contains(tags, m), m)
    return out.otherwise("other")


def window_start(timestamp: Column, minutes: int) -> Column:
    """Floor within the hour: for minutes that don't divide 60 the last window of an hour is short."""
    if minutes < 1:
        raise ValueError("minutes must be at least 1")
    minute = F.minute(timestamp)
    return F.date_trunc("hour", timestamp) + F.make_dt_interval(F.lit(0), F.lit(0), (minute - minute % minutes).cast("int"), F.lit(0))


def iso(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ssxxx")
