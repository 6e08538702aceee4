"""The state of a store: fingerprints of all that was ever accepted, bucketed so that it is never shuffled.

Each commit adds a part, a folder of files bucketed and sorted by fingerprint; the log names the parts that
count. Parts are read as one bucketed table, so a join by fingerprint sends only the other side to the
buckets, and the state is read where it lies. The number of buckets is fixed by a store's first commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.functions.text import short_hash
from fernlight.sources.commits import Log, Snapshot

COLUMNS = "fingerprint STRING, tweet_id STRING, part STRING"


def folder(path: str) -> str:
    return f"{path.rstrip('/')}__state"


def _name(spark: SparkSession, where: str) -> str:
    own = spark.sql("SELECT 1").select(short_hash(F.lit(where)).alias("h")).first().h
    return f"fernlight_state_{own}"


def read_state(spark: SparkSession, path: str, parts: list[str], buckets: int) -> DataFrame:
    """fingerprint and tweet_id of some parts, as a bucketed table; files of other parts are skipped by their statistics."""
    where = folder(path)
    files = Log(spark, where)
    files.files.mkdirs(files.at(where))
    name = _name(spark, f"{where}:{buckets}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet OPTIONS (recursiveFileLookup 'true') CLUSTERED BY (fingerprint) SORTED BY (fingerprint) INTO {int(buckets)} BUCKETS LOCATION '{_escaped(where)}'")
    spark.catalog.refreshTable(name)
    return spark.table(name).where(F.col("part").isin(parts)).select("fingerprint", "tweet_id")


def write_part(rows: DataFrame, path: str, part: str, buckets: int) -> None:
    """Adds a part of rows fingerprint, tweet_id; it counts once a commit names it."""
    spark, name = rows.sparkSession, f"fernlight_part_{part.replace('-', '')}"
    own = rows.select("fingerprint", "tweet_id", F.lit(part).alias("part")).repartition(buckets, "fingerprint")
    own.write.format("parquet").option("compression", "zstd").option("path", f"{folder(path)}/{part}").bucketBy(buckets, "fingerprint").sortBy("fingerprint").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


def merge_parts(spark: SparkSession, path: str, mark: str) -> bool:
    """Puts one part in the place of all; False where another commit came first."""
    log = Log(spark, path)
    seen = log.snapshot()
    if len(seen.parts) < 2:
        return True
    write_part(read_state(spark, path, [*seen.parts], seen.buckets), path, mark, seen.buckets)
    return log.put(seen, {"parts": [mark], "drop_parts": [*seen.parts]})


def unknown(posts: DataFrame, state: DataFrame) -> DataFrame:
    """Posts whose fingerprint the state lacks. A post with an id has the fingerprint of its id, so no second join by ids is needed."""
    return posts.join(state.select("fingerprint"), "fingerprint", "left_anti").select(*posts.columns)


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def snapshot_state(spark: SparkSession, path: str, snapshot: Snapshot, more: list[str], buckets: int) -> DataFrame:
    """The state as of a snapshot, and parts of an attempt that is not committed yet."""
    return read_state(spark, path, [*snapshot.parts, *more], snapshot.buckets or buckets)
