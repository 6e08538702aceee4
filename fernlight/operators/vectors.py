"""Hashed n-gram vectors: by Spark ML, by signed murmur3 as hashing vectorisers have it, and by MD5."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernlight.functions.text import word_ngrams


def hashed_vectors(posts: DataFrame, *, features: int = 1 << 14, id_col: str = "tweet_id", text_col: str = "normalized_content") -> DataFrame:
    """id and a sparse vector of 1- and 2-gram counts with length 1 (all zero without a token)."""
    grams = posts.select(id_col, word_ngrams(F.coalesce(text_col, F.lit(""))).alias("__grams"))
    counted = HashingTF(numFeatures=features, inputCol="__grams", outputCol="__tf").transform(grams)
    return Normalizer(p=2.0, inputCol="__tf", outputCol="vector").transform(counted).select(id_col, "vector")


def _bound(value: Column, f) -> Column:
    """f(value) with value computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def weighted(buckets: Column) -> Column:
    """(bucket, weight) of an array of buckets: counts over the length of the row's vector, in order of buckets."""

    def counts(s: Column) -> Column:
        starts = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull())
        return _bound(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("bucket"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("n"))))

    def over_length(rows: Column) -> Column:
        length = F.sqrt(F.aggregate(rows, F.lit(0.0), lambda a, r: a + r["n"] * r["n"]))
        return _bound(length, lambda z: F.transform(rows, lambda r: F.struct(r["bucket"].alias("bucket"), F.round(r["n"] / z, 6).alias("weight"))))

    return _bound(_bound(F.array_sort(buckets), counts), over_length)


def hashed_ngrams(posts: DataFrame, *, features: int = 1 << 14, id_col: str = "tweet_id", text_col: str = "normalized_content") -> DataFrame:
    """(id, bucket, weight) of MD5 buckets. All n-grams of a row are in the row, so nothing is shuffled; memory follows one text."""
    bucket = lambda g: (F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % features).cast("int")
    grams = word_ngrams(F.coalesce(text_col, F.lit("")))
    return posts.select(id_col, F.explode(weighted(F.transform(grams, bucket))).alias("__x")).select(id_col, "__x.bucket", "__x.weight")


def murmur3(raw: np.ndarray, at: np.ndarray, seed: int = 0) -> np.ndarray:
    """Signed 32-bit MurmurHash3 of the byte strings raw[at[k]:at[k + 1]], all at once, block by block."""
    mask, size = np.uint64(0xFFFFFFFF), np.diff(at)
    turn = lambda x, r: ((x << np.uint64(r)) | (x >> np.uint64(32 - r))) & mask
    h, padded = np.full(len(size), seed, np.uint64), np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint64)

    def mixed(k: np.ndarray) -> np.ndarray:
        return turn(k * np.uint64(0xCC9E2D51) & mask, 15) * np.uint64(0x1B873593) & mask

    def word(p: np.ndarray) -> np.ndarray:
        return padded[p] | padded[p + 1] << np.uint64(8) | padded[p + 2] << np.uint64(16) | padded[p + 3] << np.uint64(24)

    order = np.argsort(-size, kind="stable")  # long ones first, so that each block's rows are a prefix
    start, blocks = at[:-1][order], size[order] >> 2
    for b in range(int(blocks[0]) if len(blocks) else 0):
        n = int(np.searchsorted(-blocks, -b))
        rows = order[:n]
        h[rows] = (turn(h[rows] ^ mixed(word(start[:n] + 4 * b)), 13) * np.uint64(5) + np.uint64(0xE6546B64)) & mask
    rest = size & 3
    tail = word(at[:-1] + (size & ~3)) & (np.uint64(1) << (8 * rest).astype(np.uint64)) - np.uint64(1)
    h ^= np.where(rest > 0, mixed(tail), np.uint64(0)) ^ size.astype(np.uint64)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor) & mask
    return h.astype(np.uint32).view(np.int32)


def murmur3_features(posts: DataFrame, *, features: int = 1 << 14, id_col: str = "tweet_id", text_col: str = "normalized_content") -> DataFrame:
    """(id, bucket, weight): bucket is |signed murmur3 of the n-gram, seed 0| mod features, as hashing vectorisers choose it; weights as in hashed_ngrams."""
    own = posts.select(F.col(id_col), word_ngrams(F.coalesce(text_col, F.lit(""))).alias("__grams"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                ids, grams = batch.column(0).slice(i, 500), batch.column(1).slice(i, 500)
                flat = grams.flatten().cast(pa.large_binary())
                _, offsets, data = flat.buffers()
                at = np.frombuffer(offsets, np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
                h = np.abs(murmur3(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at).astype(np.int64)) % features
                row = np.repeat(np.arange(len(ids)), grams.value_lengths().fill_null(0).to_numpy())
                key, n = np.unique(row * features + h, return_counts=True)
                row, bucket = key // features, key % features
                length = np.sqrt(np.bincount(row, weights=n.astype(float) ** 2, minlength=len(ids)))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(bucket.astype(np.int32)), pa.array(n / length[row])], ["id", "bucket", "weight"])

    hashed = own.mapInArrow(run, f"id {own.schema[0].dataType.simpleString()}, bucket int, weight double")
    return hashed.select(F.col("id").alias(id_col), "bucket", F.round("weight", 6).alias("weight"))


def vector_metadata(vectors: DataFrame, features: int, batch: int = 1000) -> DataFrame:
    return vectors.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.ceil(F.col("rows") / batch).alias("batches"), F.lit(features).alias("features"))
