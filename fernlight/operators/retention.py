"""Cut-offs, limits and the report of a collection run."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_run(target: int, hours: int) -> None:
    if target <= 0:
        raise ValueError("target must be greater than zero")
    if hours <= 0:
        raise ValueError("hours must be greater than zero")


def recent(posts: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """Posts of the last hours, the edge included."""
    return posts.where(F.col("timestamp") >= as_of - F.make_dt_interval(F.lit(0), F.lit(hours)))


def recent_count(posts: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """One row: distinct non-empty ids of the last hours."""
    return recent(posts.where("tweet_id <> ''"), as_of, hours).agg(F.countDistinct("tweet_id").alias("existing_unique"))


def raw_target(remaining: int, multiplier: float) -> int:
    """Candidates to read for a number of new posts."""
    return max(remaining + 500, math.ceil(remaining * multiplier))


def take_first(posts: DataFrame, remaining: int, order: list[Column]) -> DataFrame:
    return posts.orderBy(*order).limit(max(0, remaining))


def report(existing: int, accepted: int, duplicates: int, written: int, target: int, state: str) -> dict:
    total = existing + accepted
    return {
        "requested_total": target, "existing_unique": existing, "accepted_this_run": accepted, "duplicates_this_run": duplicates, "written_this_run": written,
        "total_unique": total, "remaining": max(target - total, 0), "target_met": total >= target, "dedupe_index": state,
    }


def period(posts: DataFrame) -> DataFrame:
    return posts.agg(F.min("timestamp").alias("period_start"), F.max("timestamp").alias("period_end"))
