"""Importance resampling towards a target distribution over hashed n-grams, by external sort-count.

A text's features are its runs of one to `longest` words; a feature's bucket is the CRC-32 of its bytes
modulo `buckets`. A bucket's gain says how much more frequent it is in the target than in the corpus,
a document's weight is the mean gain of its features, and adding Gumbel noise to the weights and
taking the highest draws documents by their importance, without replacement.

* Streams. One scan of the texts writes, for blocks of a few MB, the document ids, the number of words of
  each (from which the document offsets follow) and one packed stream of uint16 buckets, document
  by document, as a checkpoint in the shared folder. Texts are not read again.
* Counts. Each block's stream is sorted and run-length encoded; a task adds up its runs and gives one row a
  bucket, so at most `buckets` rows a task are shuffled. The sums, `buckets` rows, are all that the driver sees.
* Weights. The streams are read a second time: gains are gathered by bucket and summed between the
  document offsets with np.add.reduceat.
* Ranks. Scores are whole numbers of a bounded range (some 10^5 values, whatever the input), so a
  histogram of them says how many documents are ahead of each score; within one score, a window over
  small rows orders ties. No task sorts all documents.

CRCs are computed for all words of a block at once, one byte a step, and those of longer runs are combined
from those of their words: appending m bytes is a linear map of the 32 bits, tabulated for m up to 64.
Longer words are taken one by one.

Cases: a null text has no words; without features the weight is 0. A null id draws the noise of the
empty string and loses ties. Rows that repeat an id have equal noise; their ties go to the one with fewer features,
then to the smaller weight. An empty corpus gives no rows; an empty target gives gains all the same.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed, chunks, column_bytes, ragged

SHORT = 64
_FULL = np.uint32(0xFFFFFFFF)

#: Words are runs of digits, ASCII letters and all bytes beyond ASCII; A-Z count as a-z.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[ord("0") : ord("9") + 1] = _IS_WORD[ord("a") : ord("z") + 1] = _IS_WORD[ord("A") : ord("Z") + 1] = _IS_WORD[0x80:] = True


def _byte_table() -> np.ndarray:
    """What a byte does to a CRC (reflected polynomial 0xEDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_BYTE = _byte_table()


def _append_tables() -> np.ndarray:
    """[m, k, b]: what byte k of a CRC, being b, becomes when m zero bytes follow."""
    out = np.zeros((SHORT + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for m in range(SHORT):
        out[m + 1] = _BYTE[out[m] & np.uint32(0xFF)] ^ (out[m] >> np.uint32(8))
    return out


_APPEND = _append_tables()


def _step(crc: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    state = crc ^ _FULL
    return _BYTE[(state ^ np.uint32(byte) if isinstance(byte, int) else state ^ byte.astype(np.uint32)) & np.uint32(0xFF)] ^ (state >> np.uint32(8)) ^ _FULL


def word_crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(-np.minimum(size, SHORT + 1), kind="stable")
    long = int(np.count_nonzero(size > SHORT))
    for k in order[:long].tolist():
        out[k] = zlib.crc32(raw[starts[k] : ends[k]].tobytes())
    order = order[long:]
    at, live_size = starts[order], size[order]
    crc = np.zeros(len(order), np.uint32)
    for t in range(int(live_size[0]) if len(order) else 0):
        live = int(np.searchsorted(-live_size, -t, side="left"))
        crc[:live] = _step(crc[:live], raw[at[:live] + t])
    out[order] = crc
    return out


def joined_crcs(left: np.ndarray, words: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of left + blank + word, given those of left and of the words."""
    crc, size = _step(left, 0x20), ends - starts
    m = np.minimum(size, SHORT)
    out = words.copy()
    for k in range(4):
        out ^= _APPEND[m, k, (crc >> np.uint32(8 * k)) & np.uint32(0xFF)]
    for k in np.flatnonzero(size > SHORT).tolist():
        out[k] = zlib.crc32(raw[starts[k] : ends[k]].tobytes(), int(crc[k]))
    return out


def features_of(words: np.ndarray, longest: int) -> np.ndarray:
    """Features of a text of so many words."""
    return sum(np.maximum(words - k, 0) for k in range(longest))


def bucket_stream(raw: np.ndarray, offsets: np.ndarray, *, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text raw[offsets[k]:offsets[k + 1]], and the buckets of all features, text by text."""
    low, n = offsets[0], len(offsets) - 1
    raw, edges = _FOLD[raw[low : offsets[-1]]], offsets - low
    word = np.concatenate([[False], _IS_WORD[raw], [False]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[edges] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
    words = np.diff(np.searchsorted(starts, edges))
    total = features_of(words, longest)
    out = np.empty(int(total.sum()), np.uint16)
    place = np.cumsum(total) - total
    one = run = word_crcs(raw, starts, ends)
    first = np.cumsum(words) - words
    for k in range(longest):
        if k:  # runs of k + 1 words, by the place of their first word
            run = np.concatenate([joined_crcs(run[: len(run) - 1], one[k:], raw, starts[k:], ends[k:]), run[:0]]) if len(run) > 1 else run[:0]
        here = np.maximum(words - k, 0)
        out[ragged(place, here)] = run[ragged(first, here)] % np.uint32(buckets)
        place = place + here
    return words, out


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a stream in order, and how often each occurs: sorted, then run-length encoded."""
    ordered = np.sort(stream, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else np.zeros(1, np.int64)
    return ordered[edge[:-1]], np.diff(edge)


def write_streams(docs: DataFrame, *, buckets: int, longest: int, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of documents: ids (array<long>), words (array<int>) and stream (uint16, low byte first), written to the shared folder."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be 1 to 65536")
    if longest < 1:
        raise ValueError("longest must be at least 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                words, stream = bucket_stream(raw, at[i : j + 1], buckets=buckets, longest=longest)
                ids = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), batch.column(0).slice(i, j - i))
                counts = pa.ListArray.from_arrays(pa.array([0, j - i], pa.int32()), pa.array(words, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, counts, pa.array([stream.astype("<u2").tobytes()], pa.binary())], ["ids", "words", "stream"])

    own = docs.select((F.lit(None) if id_col is None else F.col(id_col)).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return checkpointed(own.mapInArrow(run, "ids array<long>, words array<int>, stream binary"))


def bucket_counts(streams: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; the driver gets one number a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for stream in batch.column(0):
                value, n = run_lengths(np.frombuffer(stream.as_buffer(), "<u2"))
                total[value] += n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["b", "n"])

    sums = streams.select("stream").mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[sums["b"].to_numpy()] = sums["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log of the ratio of smoothed shares, floored."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(streams: DataFrame, gain: np.ndarray, longest: int) -> DataFrame:
    """i, n_words, n_features and weight of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = batch.column(1)[k].values.to_numpy().astype(np.int64)
                total = features_of(words, longest)
                each = gain[np.frombuffer(batch.column(2)[k].as_buffer(), "<u2")]
                weight, some = np.zeros(len(words), np.int64), total > 0
                if some.any():
                    weight[some] = np.add.reduceat(each, (np.cumsum(total) - total)[some]) // total[some]
                yield pa.RecordBatch.from_arrays([batch.column(0)[k].values, pa.array(words), pa.array(total), pa.array(weight)], ["i", "n_words", "n_features", "weight"])

    return streams.mapInArrow(run, "i long, n_words long, n_features long, weight long")


def scored(weighed: DataFrame, seed: int) -> DataFrame:
    """Adds score: the weight and Gumbel noise that follows from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("i").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


def ranked(rows: DataFrame, *, percent: int, min_words: int) -> DataFrame:
    """Adds rank: 1, 2, 3 ... of the drawn, by score, ties to smaller ids; null of the others."""
    able = F.col("n_words") >= min_words
    by_score = rows.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy(F.col("score").desc())  # over one row a score, of which there are some 10^5 at most
    total = by_score.agg(F.floor(F.sum("n") * percent / 100).cast("long").alias("draw"))
    before = by_score.withColumn("before", F.sum("n").over(ahead) - F.col("n")).crossJoin(F.broadcast(total)).where("before < draw")  # one row
    joined = rows.join(F.broadcast(before.select(F.col("score").alias("at"), "before", "draw")), able & (F.col("score") == F.col("at")), "left")
    tie = Window.partitionBy("score").orderBy(F.col("i").asc_nulls_last(), "n_features", "weight")
    inside = joined.where("before is not null").withColumn("rank", F.col("before") + F.row_number().over(tie))
    names = [*rows.columns, "rank"]
    drawn = inside.withColumn("rank", F.when(F.col("rank") <= F.col("draw"), F.col("rank")).cast("long"))
    rest = joined.where("before is null").withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*names).unionByName(rest.select(*names))


def resample(docs: DataFrame, target: DataFrame, *, buckets: int = 10_000, longest: int = 2, percent: int = 25, min_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """One row per document: id, n_features, weight, score and rank among the drawn (null: not drawn)."""
    streams = write_streams(docs, buckets=buckets, longest=longest, id_col=id_col, text_col=text_col)
    aim = write_streams(target, buckets=buckets, longest=longest, id_col=None, text_col=target_text_col)
    gain = gains(bucket_counts(streams, buckets), bucket_counts(aim, buckets))
    rows = checkpointed(scored(weigh(streams, gain, longest), seed))
    return ranked(rows, percent=percent, min_words=min_words).select(F.col("i").alias(id_col), "n_features", "weight", "score", "rank")


def drawn_documents(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn documents with their columns. Ids must be unique: a row stays if its id was drawn."""
    ids = resample(docs, target, id_col=id_col, **options).where("rank is not null").select(F.col(id_col).alias("__drawn"))
    return docs.join(ids, docs[id_col] == F.col("__drawn"), "left_semi")


def resample_sql(*, buckets: int = 10_000, percent: int = 25, min_words: int = 20, seed: int = 7) -> str:
    """The same for runs of one and two words. CRCs go over hexadecimal digits, by the rule that makes the table."""
    turns = "".join(f"c{k + 1} AS (SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM c{k}),\n" for k in range(8))
    return rf"""
WITH c0 AS (SELECT range AS b, range::BIGINT AS c FROM range(256)),
{turns}tab AS (SELECT list(c ORDER BY b) AS tab FROM c8),
t AS (SELECT 0 AS side, doc_id AS i, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
d AS (SELECT row_number() OVER () AS u, side, i, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
g AS (SELECT u, side, unnest(list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))) AS f FROM d),
n AS (SELECT u, side, f, count(*) AS n FROM g GROUP BY ALL),
h AS (SELECT f, list_transform(range(0, strlen(f)), lambda k: ('0x' || substr(hex(encode(f)), 2 * k::INT + 1, 2))::BIGINT) AS b FROM (SELECT DISTINCT f FROM n)),
z AS (SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda s, x: xor(tab[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) % {buckets} AS z FROM h, tab),
m AS (SELECT z, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM n JOIN z USING (f) GROUP BY z),
a AS (SELECT coalesce(sum(s), 0)::DOUBLE AS sa, coalesce(sum(t), 0)::DOUBLE AS ta FROM m),
gain AS (SELECT z, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + {buckets}) / ((coalesce(s, 0) + 1)::DOUBLE * (ta + {buckets}))))::BIGINT AS gain FROM m, a),
k AS (SELECT u, sum(n) AS nf, sum(n * gain) AS total FROM n JOIN z USING (f) JOIN gain USING (z) WHERE side = 0 GROUP BY u),
r AS (SELECT i AS doc_id, len(w) AS nw, coalesce(nf, 0)::BIGINT AS n_features, CASE WHEN nf IS NULL THEN 0 ELSE ((total - ((total % nf) + nf) % nf) // nf) END::BIGINT AS weight,
  ('0x' || left(sha256('{seed}:' || coalesce(i::VARCHAR, '')), 8))::BIGINT AS h FROM d LEFT JOIN k USING (u) WHERE side = 0),
e AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY nw >= {min_words} ORDER BY score DESC, doc_id, n_features, weight) AS o, count(*) OVER (PARTITION BY nw >= {min_words}) AS total FROM e)
SELECT doc_id, n_features, weight, score, CASE WHEN nw >= {min_words} AND o <= total * {percent} // 100 THEN o END::BIGINT AS rank FROM o
"""
