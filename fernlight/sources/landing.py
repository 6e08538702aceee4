"""Landed pages of posts: rows of HTML or JSON instead of a live browser, and the source interface.

A live browser session is no part of an analytics engine; what it would show lands as files, and this
module turns them into raw posts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from fernlight.functions import dom
from fernlight.functions import text as T
from fernlight.functions.numbers import compact_count
from fernlight.sources.schema import RAW


PARTS = "struct<time:string,href:string,content:string,names:array<string>,views:string,reply:string,retweet:string,like:string,bookmark:string>"
OUTLINE = "struct<title:string,heading:string,links:array<string>,n_elements:int,depth:int>"

cloudpickle.register_pickle_by_value(dom)  # executors need not have this package


def _of_html(function: Callable[[str | None], Any], kind: str, html: Column) -> Column:
    """A function of one page as a Column, over Arrow batches."""
    arrow = to_arrow_type(_parse_datatype_string(kind))

    @F.arrow_udf(kind)
    def run(column: pa.Array) -> pa.Array:
        return pa.array([function(x) for x in column.to_pylist()], arrow)

    return run(html)


def split_articles(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """One row per post element of a page, beside the page's columns; one inside another is a row of its own."""
    return pages.withColumn("article", F.explode(_of_html(dom.articles, "array<string>", F.col(html_col))))


def outlines(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds title, heading, links, n_elements and depth of each page's tree of elements. Null and empty pages have no elements."""
    return pages.withColumn("__o", _of_html(dom.outline, OUTLINE, F.col(html_col))).select(*[F.col(f"`{c}`") for c in pages.columns], "__o.*")


def parse_articles(articles: DataFrame, query_tag: Column, collected_at: Column, html_col: str = "article") -> DataFrame:
    """Raw posts. Elements without a time, a status id or text, or with a number that can't be read, are left out.

    Elements are read as trees: the id is that of the link around the first time, texts include those of nested
    elements, and attributes may stand in any order.
    """
    df = articles.withColumn("__a", _of_html(dom.post_parts, PARTS, F.col(html_col)))
    part = lambda name: F.col(f"__a.{name}")
    count = lambda name: compact_count(F.coalesce(part(name), F.lit("")))
    text, href = part("content"), F.coalesce(part("href"), F.lit(""))
    out = df.select(
        T.status_id(href).alias("tweet_id"), T.username_of(part("names")).alias("username"), part("time").try_cast("timestamp").alias("timestamp"), text.alias("content"),
        count("reply").alias("reply_count"), count("retweet").alias("repost_count"), count("like").alias("like_count"), count("views").alias("view_count"), count("bookmark").alias("bookmark_count"),
        T.mentions(text).alias("mentions"), T.hashtags(text).alias("hashtags"), href.alias("url"), query_tag.alias("query_tag"), collected_at.alias("collected_at"),
    )
    whole = (F.col("tweet_id") != "") & F.col("timestamp").isNotNull() & (F.col("content") != "")
    for c in ("reply_count", "repost_count", "like_count", "view_count", "bookmark_count"):
        whole = whole & F.col(c).isNotNull()
    return out.where(whole)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Raw posts of JSON lines; lines that can't be read are left out."""
    bad = "_corrupt_record"
    df = spark.read.schema(StructType([*RAW.fields, StructField(bad, StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).json(path)
    return df.where(F.col(bad).isNull()).drop(bad)


class Collector:
    """Interface of a source of raw posts: override `collect`."""

    def collect(self, *, queries: tuple[str, ...], cutoff: datetime, target: int) -> Iterator[dict[str, Any]]:
        raise NotImplementedError


class RoundCollector(Collector):
    """A source that shows posts round by round, as a page that grows when it is scrolled: override `rounds`.

    A query ends after `patience` rounds without a new id, after `target` posts, or with its rounds. Posts
    older than the cutoff are left out; each id is given once.
    """

    def __init__(self, patience: int = 5):
        if patience < 1:
            raise ValueError("patience must be at least 1")
        self.patience = patience

    def rounds(self, query: str, cutoff: datetime) -> Iterator[list[dict[str, Any]]]:
        raise NotImplementedError

    def collect(self, *, queries: tuple[str, ...], cutoff: datetime, target: int) -> Iterator[dict[str, Any]]:
        seen: set[str] = set()
        given = 0
        for query in queries:
            idle = 0
            for rows in self.rounds(query, cutoff):
                new = [r for r in rows if r["tweet_id"] not in seen and not seen.add(r["tweet_id"])]
                idle = 0 if new else idle + 1
                for row in new:
                    if given < target and row["timestamp"] >= cutoff:
                        given += 1
                        yield row
                if idle == self.patience or given >= target:
                    break


class _Part(InputPartition):
    def __init__(self, query: str):
        super().__init__(query)
        self.query = query


class _Reader(DataSourceReader):
    def __init__(self, collector: Collector, queries: tuple[str, ...], cutoff: datetime, target: int):
        self.collector, self.queries, self.cutoff, self.target = collector, queries, cutoff, target

    def partitions(self) -> list[InputPartition]:
        return [_Part(q) for q in self.queries]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for row in self.collector.collect(queries=(partition.query,), cutoff=self.cutoff, target=self.target):
            yield tuple(row.get(f.name) for f in RAW)


def collector_source(collector: Collector, queries: tuple[str, ...], cutoff: datetime, target: int, name: str = "collector") -> type[DataSource]:
    """A data source, one partition a query, to register with spark.dataSource and read by name."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return RAW

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(collector, queries, cutoff, target)

    return Source
