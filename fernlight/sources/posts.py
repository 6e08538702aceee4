"""The partitioned store of posts: cleaning, writing, pruned reading."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fernlight.functions import text as T
from fernlight.sources.commits import OWN, Log
from fernlight.sources.schema import PARTITIONS, POSTS


def engagement(df_cols: tuple[str, ...] = ("reply_count", "repost_count", "like_count", "bookmark_count")) -> Column:
    """Views don't count."""
    total = F.lit(0).cast("long")
    for c in df_cols:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def clean(raw: DataFrame) -> DataFrame:
    """Raw posts as stored posts, with columns in the store's order. Work is per row; nothing is shuffled."""
    df = raw.withColumns({"username": T.clean_username(F.coalesce("username", F.lit(""))), "content": T.normalize_text(F.coalesce("content", F.lit("")))})
    df = df.withColumns({
        "normalized_content": T.for_analysis("content"), "language_hint": T.language_hint("content"),
        "mentions": T.clean_tags("mentions", "@"), "hashtags": T.clean_tags("hashtags", "#"), "engagement_total": engagement(),
        "event_date": F.date_format("timestamp", "yyyy-MM-dd"), "event_hour": F.date_format("timestamp", "HH"),
    })
    df = df.withColumn("fingerprint", T.fingerprint(F.col("tweet_id"), F.col("username"), F.col("timestamp"), F.col("normalized_content")))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POSTS])


def _written(posts: DataFrame, path: str, rows_per_file: int, rows_per_group: int) -> int:
    """Appends rows by hour to a folder; how many."""
    seen = Observation()
    counted = posts.select(*[f.name for f in POSTS]).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.hint("rebalance", *[F.col(c) for c in PARTITIONS]).write.mode("append").option("compression", "zstd").option("parquet.enable.dictionary", True).option("parquet.block.row.count.limit", rows_per_group).option("maxRecordsPerFile", rows_per_file).partitionBy(*PARTITIONS).parquet(path)
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:  # a plan that the optimizer finds empty runs without its observation: no row to convert
        if "toPyRow" not in str(e):
            raise
        return 0


def write_posts(posts: DataFrame, path: str, *, rows_per_file: int = 2_000_000, rows_per_group: int = 500_000) -> int:
    """Appends to the store and returns the number of rows written. Files are zstd with dictionaries, of so many rows at most in a file and in a row group.

    Rows of an hour meet before the write, so an hour gets a few large files; a rebalance, unlike a
    plain repartition, lets AQE split an hour that holds much of the input. Where the store has a log of commits, the
    files count from the next run on, which reads them into its state.
    """
    return _written(posts, path, rows_per_file, rows_per_group)


def stage_posts(posts: DataFrame, log: Log, mark: str, *, rows_per_file: int = 2_000_000, rows_per_group: int = 500_000) -> tuple[int, dict[str, int]]:
    """As write_posts, but the files count for nobody until a commit names them: rows, and sizes of the files by path."""
    staged = f"{log.path}/_staged/{mark}"
    rows = _written(posts, staged, rows_per_file, rows_per_group)
    return rows, log.place(staged, mark)


def read_files(spark: SparkSession, path: str, names: Iterable[str], *, since: datetime | None = None) -> DataFrame:
    """Posts of some files of the store; those of hours before since are not even opened."""
    if since is not None:
        first = f"event_date={since.astimezone(timezone.utc):%Y-%m-%d/event_hour=%H}"
        names = [n for n in names if n.rpartition("/")[0] >= first]
    paths = [f"{path.rstrip('/')}/{n}" for n in sorted(names)]
    if not paths:
        return spark.createDataFrame([], POSTS)
    return _since(spark.read.schema(POSTS).option("basePath", path).parquet(*paths), since)


def _since(df: DataFrame, since: datetime | None) -> DataFrame:
    if since is None:
        return df
    utc = since.astimezone(timezone.utc)
    day, hour = utc.strftime("%Y-%m-%d"), utc.strftime("%H")
    pruned = (F.col("event_date") > day) | ((F.col("event_date") == day) & (F.col("event_hour") >= hour))
    return df.where(pruned & (F.col("timestamp") >= F.lit(utc)))


def read_posts(spark: SparkSession, path: str, *, since: datetime | None = None) -> DataFrame:
    """Stored posts, none where nothing is stored; of a store with a log, those that it names. since: inclusive; prunes partitions and row groups too."""
    log = Log(spark, path)
    if log.exists():
        return read_files(spark, path, log.snapshot().files, since=since)
    try:
        df = spark.read.schema(POSTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], POSTS)
    if log.began():  # a first commit that has not come yet, or never will
        df = df.where(~F.startswith("_metadata.file_name", F.lit(OWN)))
    return _since(df, since)


def count_rows(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """One row: n, from the footers of Parquet files; no column is read.

    The aggregate is pushed into the scan by Spark's second Parquet reader, which a session of its own turns on.
    """
    own = spark.newSession()
    for key, value in FOOTERS.items():
        own.conf.set(key, value)
    return own.read.parquet(*([path] if isinstance(path, str) else path)).agg(F.count(F.lit(1)).alias("n"))


FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def post_ids(posts: DataFrame, *, cutoff: Column | None = None) -> DataFrame:
    """Non-empty ids, of posts no older than cutoff."""
    keep = F.col("tweet_id") != ""
    return posts.where(keep if cutoff is None else keep & (F.col("timestamp") >= cutoff)).select("tweet_id")
