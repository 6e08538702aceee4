"""Collection in rounds as a stream: each round asks every query for its next page.

The source gives requests (query, number of the page), one round a batch, and its offset is the number of the
next round, so a stream goes on where its checkpoint says. Executors fetch the pages; ids are told apart by keyed state,
across queries, rounds and restarts. A listener notes the new posts of each batch and ends the
stream after `patience` rounds without any, or once there are enough.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from datetime import datetime
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from fernlight.sources.schema import RAW
from fernlight.streaming.keyed_dedupe import keyed_batches

#: A page of a query: posts as mappings of RAW's columns; what is missing is null.
Pages = Callable[[str, int, datetime], list[dict[str, Any]]]


def request_source(queries: tuple[str, ...], name: str = "rounds") -> type[DataSource]:
    """A data source to register with spark.dataSource: a row for each query and round."""

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self) -> dict:
            return {"round": 0}

        def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
            end = {"round": start["round"] + 1}
            return self.readBetweenOffsets(start, end), end

        def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
            return iter([(q, n) for n in range(start["round"], end["round"]) for q in queries])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "query string, number long"

        def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
            return Reader()

    return Source


def collected(requests: DataFrame, pages: Pages, cutoff: datetime) -> DataFrame:
    """Raw posts of the requested pages, fetched where the requests are dealt to; none older than the cutoff."""
    schema, names = to_arrow_schema(RAW), RAW.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [r for r in pages(query, number, cutoff) if r["timestamp"] >= cutoff]
                yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)

    return requests.repartition("query").mapInArrow(run, RAW)


class Progress(StreamingQueryListener):
    """Counts new posts of one stream, and sets `over` when it has enough or no more come."""

    def __init__(self, patience: int, target: int):
        if patience < 1:
            raise ValueError("patience must be at least 1")
        self.patience, self.target = patience, target
        self.rounds = self.idle = self.new = 0
        self.over = threading.Event()

    def note(self, new: int) -> None:
        if not self.over.is_set():
            self.rounds, self.new = self.rounds + 1, self.new + new
            self.idle = 0 if new else self.idle + 1
            if self.idle >= self.patience or self.new >= self.target:
                self.over.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(f"new-{id(self)}")
        if seen is not None:
            self.note(seen.n)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def collect_rounds(spark: SparkSession, pages: Pages, path: str, checkpoint: str, *, queries: tuple[str, ...], cutoff: datetime, target: int, patience: int = 5, every: str = "5 seconds", buckets: int = 64) -> dict[str, int]:
    """Runs rounds until `target` new posts are stored, or `patience` rounds bring none; how many rounds and new posts.

    The last round is stored whole, so there may be more posts than the target.
    """
    told = Progress(patience, target)
    spark.dataSource.register(request_source(queries))
    raw = collected(spark.readStream.format("rounds").load(), pages, cutoff)
    spark.streams.addListener(told)
    try:
        query = keyed_batches(raw, path, checkpoint, trigger={"processingTime": every}, buckets=buckets, observe=f"new-{id(told)}")
        try:
            while not told.over.wait(0.2) and query.isActive:
                pass
        finally:
            query.stop()
        if query.exception():
            raise query.exception()
    finally:
        spark.streams.removeListener(told)
    return {"rounds": told.rounds, "new_posts": told.new}
