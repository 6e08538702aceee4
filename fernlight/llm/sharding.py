"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns `vnodes` points of a ring of 2**32 places; a document starts at the place of its
id's hash and belongs to the next point clockwise. Loads are bounded: of N documents the first
N mod n shards may hold ceil(N / n) and the others floor(N / n), so counts end at most one apart. A
shard over its bound keeps its first documents in ring order; the others continue clockwise to the
next point whose shard has room. Only overflow moves away from its home.

What a document does depends on the number of documents that start at each point alone. A first scan,
of ids only, counts them by point; a point with over `HOT` times the mean is split into classes of a
hash of the row, one for each mean, so there are at most twice as many classes as points (`shards *
vnodes`), whatever the input. Their counts go to the driver, which walks the ring and returns, for
each point and class, runs of ranks and their shards. Documents take their rank by a window over small
rows without text; that is the only shuffle of rows. The order in a point is: class, place, id, CRC, size.

Cases: null text has size 8 and the CRC of no bytes. Null ids and repeated ids start at one place;
their classes are different tasks, so a point that holds a third of all rows is split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACES = 1 << 32
HOT = 8


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all points in order, and the shard of each."""
    from fernlight.llm.common import mix64

    ids = np.arange(shards * vnodes, dtype=np.uint64)
    places = mix64(mix64(ids + np.uint64(1)) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)
    order = np.lexsort((ids, places))
    return places[order].astype(np.int64), (ids[order] // np.uint64(vnodes)).astype(np.int64)


def capacities(total: int, shards: int) -> np.ndarray:
    return np.full(shards, total // shards, np.int64) + (np.arange(shards) < total % shards)


def walk(counts: np.ndarray, owners: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (point, first rank, last rank + 1, shard, slot of the first) for `counts` documents a point."""
    room = capacities(int(counts.sum()), shards)
    used = np.zeros(shards, np.int64)
    runs, waiting = [], []
    for point, (n, shard) in enumerate(zip(counts.tolist(), owners.tolist(), strict=True)):
        home = min(n, int(room[shard] - used[shard]))
        if home:
            runs.append((point, 0, home, shard, int(used[shard])))
            used[shard] += home
        waiting.append((home, n))
    carried: list[tuple[int, int, int]] = []
    for step in range(2 * len(owners)):
        point = step % len(owners)
        shard = int(owners[point])
        while carried and used[shard] < room[shard]:
            at, low, high = carried.pop(0)
            take = min(high - low, int(room[shard] - used[shard]))
            runs.append((at, low, low + take, shard, int(used[shard])))
            used[shard] += take
            if low + take < high:
                carried.insert(0, (at, low + take, high))
        if step < len(owners) and waiting[point][0] < waiting[point][1]:
            carried.append((point, *waiting[point]))
    return runs


def place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(PLACES))


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Classes of each point: one, or one for each mean that a hot point holds."""
    mean = max(1.0, counts.sum() / len(counts))
    return np.where(counts > HOT * mean, np.ceil(counts / mean), 1).astype(np.int64)


def _counts(numbers: DataFrame, size: int) -> np.ndarray:
    """How often each of the numbers 0 to size - 1 occurs in column n."""
    seen, out = numbers.groupBy("n").count().toArrow(), np.zeros(size, np.int64)
    out[seen["n"].to_numpy()] = seen["count"].to_numpy()
    return out


def assign_shards(docs: DataFrame, *, shards: int = 24, vnodes: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard, moved."""
    spark = docs.sparkSession
    places, owners = ring(shards, vnodes)

    @F.pandas_udf("int")
    def point_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, at.to_numpy()) % len(places)).astype("int32")

    own = F.col(id_col).cast("long")
    classes = classes_of(_counts(docs.select(point_of(place(own)).alias("n")), len(places)))
    first = np.cumsum(classes) - classes

    @F.pandas_udf("int")
    def cell_of(at: pd.Series, h: pd.Series) -> pd.Series:
        point = np.searchsorted(places, at.to_numpy()) % len(places)
        return pd.Series(first[point] + h.to_numpy() % classes[point]).astype("int32")

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(own.alias("i"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    rows = rows.withColumn("at", place(F.col("i"))).withColumn("cell", cell_of("at", F.xxhash64("i", "crc", "size")))

    cells = np.repeat(owners, classes)
    counts = _counts(rows.select(F.col("cell").alias("n")), len(cells))
    runs = np.array(walk(counts, cells, shards), np.int64).reshape(-1, 5).T
    names = ["cell", "low", "high", "shard", "slot0"]
    plan = spark.createDataFrame(pa.table({name: x.astype(np.int32) if name == "cell" else x for name, x in zip([*names, "home"], [*runs, cells[runs[0]]], strict=True)}))
    by_cell = plan.groupBy("cell", "home").agg(F.sort_array(F.collect_list(F.struct(*names[1:]))).alias("runs"))

    rank = F.row_number().over(Window.partitionBy("cell").orderBy("at", "i", "crc", "size")).cast("long") - 1
    run = F.element_at(F.filter("runs", lambda x: (x["low"] <= F.col("rank")) & (F.col("rank") < x["high"])), 1)
    out = rows.withColumn("rank", rank).join(F.broadcast(by_cell), "cell").withColumn("run", run)
    return out.select(
        F.col("i").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("run.shard").cast("int").alias("shard"), (F.col("run.slot0") + F.col("rank") - F.col("run.low")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), (F.col("run.shard") != F.col("home")).alias("moved"),
    )
