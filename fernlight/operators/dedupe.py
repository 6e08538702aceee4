"""Dedupe of posts: within a batch, against the state of earlier runs, and for arbitrary key pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(posts: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by a total order. min_by is partial before the shuffle, so a key that fills much of the input leaves one row a task."""
    row = F.struct(*[F.col(f"`{c}`") for c in posts.columns])
    return posts.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def new_only(posts: DataFrame, seen: DataFrame) -> DataFrame:
    """Posts whose fingerprint and (non-empty) id are not in the state: two equality anti-joins in place of an OR."""
    left = posts.join(seen.select("fingerprint"), "fingerprint", "left_anti")
    ids = seen.where("tweet_id <> ''").select(F.col("tweet_id").alias("__seen"))
    return left.join(ids, (F.col("tweet_id") != "") & (F.col("tweet_id") == F.col("__seen")), "left_anti").select(*posts.columns)


def seeds(ids: DataFrame) -> DataFrame:
    """State rows of ids: trimmed, distinct, none empty."""
    own = ids.select(F.trim(F.col("tweet_id").cast("string")).alias("tweet_id")).where("tweet_id <> ''").distinct()
    return own.select(F.sha2(F.concat(F.lit("id:"), F.col("tweet_id")), 256).alias("fingerprint"), "tweet_id")


def known_of(posts: DataFrame) -> DataFrame:
    """State rows of stored posts: their own fingerprints, and those of their ids."""
    own = posts.select("fingerprint", "tweet_id").where("fingerprint is not null")
    return own.unionByName(seeds(posts.select("tweet_id"))).groupBy("fingerprint").agg(F.max("tweet_id").alias("tweet_id"))


def seed_state(state: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The new state, and the rows put in: those whose fingerprint it lacked."""
    new = seeds(ids).join(state.select("fingerprint"), "fingerprint", "left_anti")
    return state.select("fingerprint", "tweet_id").unionByName(new), new


def greedy_pairs(rows: DataFrame, order: str, checkpoint: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds `accepted` for arbitrary (fingerprint, tweet_id) pairs: a row goes if an accepted earlier row has its fingerprint or its non-empty id.

    Rounds: of the open rows those that come first in both their keys are accepted, and rows that share a
    key with them go. Rounds follow the longest chain of rows that wait for each other, not the
    number of rows. `order` is a column of distinct values. Derived fingerprints need `first_wins` alone.
    """
    checkpoint = checkpoint or (lambda df: df.checkpoint())
    keyed = rows.select("*", F.nullif(F.col("tweet_id"), F.lit("")).alias("__id"))
    out, left = None, checkpoint(keyed)
    while not left.isEmpty():
        by_f = left.groupBy("fingerprint").agg(F.min(order).alias("__f"))
        by_i = left.where("__id is not null").groupBy("__id").agg(F.min(order).alias("__i"))
        ranked = left.join(by_f, "fingerprint").join(by_i, "__id", "left")
        took = checkpoint(ranked.where((F.col(order) == F.col("__f")) & F.coalesce(F.col(order) == F.col("__i"), F.lit(True))).select(*keyed.columns))
        others = left.join(took.select(order), order, "left_anti")
        prints = took.select("fingerprint").withColumn("__hit_f", F.lit(True))
        ids = took.where("__id is not null").select("__id").withColumn("__hit_i", F.lit(True))
        told = checkpoint(others.join(prints, "fingerprint", "left").join(ids, "__id", "left"))
        gone = F.coalesce("__hit_f", "__hit_i", F.lit(False))
        done = took.select(*rows.columns, F.lit(True).alias("accepted")).unionByName(told.where(gone).select(*rows.columns, F.lit(False).alias("accepted")))
        out = done if out is None else out.unionByName(done)
        left = told.where(~gone).select(*keyed.columns)
    return out if out is not None else rows.withColumn("accepted", F.lit(True))
