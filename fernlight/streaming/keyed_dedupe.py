"""Dedupe of a stream against all that was ever stored, by keyed state.

State is one value a fingerprint, in RocksDB beside the executors: a batch looks up the fingerprints that it
holds and uploads what it has changed, so its work follows the batch and not the store. What is stored
when the stream begins is its initial state. A time to live, counted from the batch that accepted a
post, lets old fingerprints go; without one they stay.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fernlight.operators.dedupe import known_of
from fernlight.sources.commits import Log
from fernlight.sources.posts import clean, read_files
from fernlight.sources.schema import POSTS
from fernlight.sources.state import read_state, write_part
from fernlight.streaming.posts_stream import commit_batch, stream_id

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Posts with times as microseconds, as they pass through Python.
PLAIN = T.StructType([T.StructField(f.name, T.LongType() if f.dataType == T.TimestampType() else f.dataType) for f in POSTS])
_TIMES = [f.name for f in POSTS if f.dataType == T.TimestampType()]


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB; a stream takes its settings along when it starts."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def processor(ttl: timedelta | None) -> StatefulProcessor:
    """Gives the first row of a key that has no state, and notes it. First: by time, id and author, as in batches.

    The class is local, so that it travels to executors that lack this package.
    """

    class FirstSeen(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "known boolean", None if ttl is None else max(1, int(ttl.total_seconds() * 1000)))

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            first = min(rows, key=lambda r: tuple((x is not None, x) for x in (r.timestamp, r.tweet_id, r.username)))
            if not self.seen.exists():
                self.seen.update((True,))
                yield first

        def handleInitialState(self, key, initialState: Row, timerValues) -> None:
            self.seen.update((True,))

        def close(self) -> None:
            pass

    return FirstSeen()


def thinned(posts: DataFrame) -> DataFrame:
    """The first row of each fingerprint in each Arrow batch, so that one which fills the input leaves few rows to shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = pa.compute.sort_indices(pa.Table.from_batches([batch]), sort_keys=[(c, "ascending") for c in ("timestamp", "tweet_id", "username")], null_placement="at_start")
            prints = batch.column(batch.schema.get_field_index("fingerprint")).take(order).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            _, first = np.unique(prints, return_index=True)
            yield batch.take(order.take(pa.array(np.sort(first))))

    return posts.mapInArrow(run, posts.schema)


def first_seen(posts: DataFrame, known: DataFrame | None = None, *, ttl: timedelta | None = None) -> DataFrame:
    """Of a stream of clean posts, each fingerprint's first post, unless it is known. known: a table with fingerprint, which the first batch takes as state."""
    plain = posts.select(*[F.unix_micros(f.name).alias(f.name) if f.name in _TIMES else F.col(f.name) for f in POSTS])
    start = None if known is None else known.select("fingerprint").withColumn("known", F.lit(True)).groupBy("fingerprint")
    out = thinned(plain).groupBy("fingerprint").transformWithState(processor(ttl), PLAIN, "Append", "None" if ttl is None else "ProcessingTime", start)
    return out.select(*[F.timestamp_micros(f.name).alias(f.name) if f.name in _TIMES else F.col(f.name) for f in POSTS])


def keyed_batches(raw: DataFrame, path: str, checkpoint: str, *, ttl: timedelta | None = None, trigger: dict | None = None, buckets: int = 64, observe: str | None = None) -> StreamingQuery:
    """As upsert_batches, its known posts in keyed state: a batch is compared with the store only for what others have committed since the stream joined.

    With ttl, a fingerprint that was accepted longer ago is accepted again. Spark then runs batches without end, so the stream
    needs a trigger by time (a minute by default). observe: the name under which listeners are told `n`, the new posts of a batch.
    """
    spark, trigger = raw.sparkSession, trigger or ({"availableNow": True} if ttl is None else {"processingTime": "1 minute"})
    if ttl is not None and "processingTime" not in trigger:
        raise ValueError("a time to live needs a trigger by time")
    stream = stream_id(spark, checkpoint)
    known = join(spark, path, stream, buckets)

    def add(batch: DataFrame, number: int) -> None:
        own = batch.persist()
        own.count()  # all partitions run, and so note their state, also where the batch has its commit already
        commit_batch(own, path, stream, number, buckets=buckets, since_joined=True)
        own.unpersist()

    new = first_seen(clean(raw), known, ttl=ttl)
    if observe:
        new = new.observe(observe, F.count(F.lit(1)).alias("n"))
    with rocksdb(spark):
        return new.writeStream.foreachBatch(add).outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).start()


def join(spark: SparkSession, path: str, stream: str, buckets: int) -> DataFrame:
    """Puts an entry that the stream begins, once, and gives the state as of that entry."""
    log = Log(spark, path)
    while stream not in (seen := log.snapshot()).joined:
        mark, entry = f"{uuid.uuid4()}-found", {"joined": [stream], "buckets": seen.buckets or buckets}
        if foreign := log.unlogged(seen):
            write_part(known_of(read_files(spark, path, foreign)), path, mark, entry["buckets"])
            entry |= {"add": foreign, "parts": [mark]}
        log.put(seen, entry)
    return read_state(spark, path, [p for p, n in seen.parts.items() if n <= seen.joined[stream]], seen.buckets)
