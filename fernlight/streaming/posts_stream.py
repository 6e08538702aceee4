"""Streams of raw posts: cleaning, dedupe within a watermark, window signals, exactly-once ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fernlight.functions import features as X
from fernlight.operators.dedupe import first_wins, known_of
from fernlight.operators.signals import aggregates, finish
from fernlight.plans.runs import score
from fernlight.sources.commits import Log
from fernlight.sources.posts import clean, read_files, stage_posts
from fernlight.sources.schema import PARTITIONS, RAW
from fernlight.sources.state import read_state, unknown, write_part


def read_raw(spark: SparkSession, path: str, *, fmt: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


def clean_stream(raw: DataFrame, *, late: str = "24 hours") -> DataFrame:
    """Clean posts, each fingerprint once within the watermark; rows later than it are dropped."""
    return clean(raw).withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["fingerprint"])


def signal_stream(posts: DataFrame, as_of: Column, *, minutes: int = 15) -> DataFrame:
    """Signals of closed windows, equal to the batch ones, authors counted exactly; posts must have a watermark on timestamp.

    Two chained aggregates: sums of each author in a window, and from these the window with its number of authors. Where
    minutes divides 60, a window's row comes when the watermark passes its end. Other windows are floors within the hour,
    the last of an hour short; they lie in hours, and their rows come when the watermark passes the hour.
    """
    span = f"{minutes} minutes" if minutes >= 1 and 60 % minutes == 0 else "1 hour"
    start = X.window_start(F.col("timestamp"), minutes)
    author = F.coalesce(F.nullif("username", F.lit("")), F.lit("unknown"))
    keyed = score(posts, as_of).withColumns({"market": X.market(F.col("hashtags"), F.col("query_tag")), "start": start, "author": author})
    by_author = keyed.groupBy(F.window("timestamp", span).alias("span"), "start", "market", "author").agg(*aggregates(authors=False))
    names = [c for c in by_author.columns if c not in ("span", "start", "market", "author")]
    whole = by_author.groupBy(F.window(F.window_time("span"), span).alias("span"), "start", "market").agg(*[F.sum(c).alias(c) for c in names], F.count(F.lit(1)).alias("unique_authors"))
    return finish(whole.withColumnRenamed("start", "window_start"), ["window_start", "market"]).withColumn("window_start", X.iso(F.col("window_start")))


def store_stream(raw: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Writes deduplicated posts to the partitioned store; the file sink's log makes each row appear once."""
    return clean_stream(raw).writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*PARTITIONS).trigger(**(trigger or {"availableNow": True})).start()


def upsert_batches(raw: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None, buckets: int = 64) -> StreamingQuery:
    """As store_stream but against all that is stored, however old, and beside other writers.

    A batch's posts and their state become part of the store by one commit, which also names the batch: one that is
    tried again after its commit adds nothing. The state is read where it lies and not shuffled. Files of others
    are read into the state by the first batch that finds them.
    """

    stream = stream_id(raw.sparkSession, checkpoint)

    def add(batch: DataFrame, number: int) -> None:
        one = first_wins(batch, ["fingerprint"], [F.col("timestamp"), F.col("tweet_id"), F.col("username")]).persist()
        commit_batch(one, path, stream, number, buckets=buckets)
        one.unpersist()

    return clean(raw).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of a stream in the log of a store: made once, and kept and lost with its checkpoint."""
    log = Log(spark, checkpoint)
    where = log.at(f"{log.path}/fernlight_stream")
    if not log.files.exists(where):
        log.files.mkdirs(log.at(log.path))
        log.write(f"{log.path}/fernlight_stream", str(uuid.uuid4()))
    return log.text(f"{log.path}/fernlight_stream")


def commit_batch(posts: DataFrame, path: str, stream: str, number: int, *, buckets: int, since_joined: bool = False, tries: int = 20) -> None:
    """Adds those of the posts, each fingerprint once, that the store lacks, unless this batch has a commit.

    since_joined: compare them only with what others have committed since the stream joined; the stream knows the rest.
    """
    spark = posts.sparkSession
    for _ in range(tries):
        log, mark = Log(spark, path), str(uuid.uuid4())
        seen = log.snapshot()
        if seen.batches.get(stream, -1) >= number:
            return
        entry: dict = {"buckets": seen.buckets or buckets, "batches": {stream: number}, "add": {}, "parts": []}
        foreign = log.unlogged(seen)
        if foreign:
            write_part(known_of(read_files(spark, path, foreign)), path, f"{mark}-found", entry["buckets"])
            entry |= {"add": foreign, "parts": [f"{mark}-found"]}
        parts = [p for p, n in seen.parts.items() if n > seen.joined.get(stream, 0) and not p.startswith(stream)] if since_joined else [*seen.parts]
        parts += entry["parts"]
        new = (unknown(posts, read_state(spark, path, parts, entry["buckets"])) if parts else posts).persist()
        _, files = stage_posts(new, log, mark)
        if files:
            own = f"{stream}-{mark}"
            write_part(new, path, own, entry["buckets"])
            entry |= {"add": entry["add"] | files, "parts": [*entry["parts"], own]}
        new.unpersist()
        if not entry["add"] or log.put(seen, entry):  # without new posts there is nothing to commit
            return
        log.remove([*files])
    raise RuntimeError(f"other writers came first {tries} times")
