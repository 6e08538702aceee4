"""Substring dedup by level-wise doubling.

Words are `[^\\x20\\x09-\\x0D]+`. A window of `window` words of a document is a repeat if the same
word sequence also starts in a document with a smaller id; every word that a repeat covers goes.
Windows are judged on the input.

Levels. A window can only be repeated if all shorter windows inside it are. So short ones are counted
first, and only what occurs in two documents is extended to twice its length, rounded so that the
wanted length is met: 13, 25 and 50 words for a window of 50. That goes on until the last level or
until no candidate survives (an empty level empties the joins of all later ones).

* Below the last level not every short window is sent, but only the anchor of each full window: the
  least hash of the windows of the level's length inside it. It depends on that full window alone, so
  equal windows have equal anchors, and of n words about 2 / (window - length + 2) travel. A
  full window is a candidate of the next level if its anchor occurs in two documents; only anchors
  of candidates are sent there.
* The level before the last counts runs of full windows too. Consecutive ones with one anchor are a
  stretch, candidates or not, and a stretch with a candidate sends a hash of all its words, 128 bits with its anchor. Where an
  anchor has one such hash in all documents, all full windows of the stretch are counted at once: they
  occur in just these documents, stay in the smallest and go in the others. The last level takes, window
  by window, the stretches that differ between documents, as at the ends of passages.
* At the last level windows are told apart by 128 bits, of two hashes of their words by different
  bases; the smallest document of each stays a provider and the others lose it. On the way back
  windows and stretches are looked up among those that their own document loses, by 64 bits.

The first level reads the texts where they are and writes its few surviving anchors. Behind it text is
shuffled once, by document, for all levels of windows up to 50 words. Counting is a partial
aggregation before the shuffle, so a passage of every document becomes one row a task. The way back
to documents is a sort-merge join on small rows; its key is written anew so that both sides are
shuffled for it, which is what AQE needs to split a skewed key.

Cases: null or empty text has no words. A null id takes no part and its row keeps all words; such rows
are dealt by their place in the input under ids of their own, the 2**40 least ones, which no document
may have. Rows with one id are one document for the rule; each is judged by its own text. Texts shorter than a
window never change. Memory follows one document plus about 2 MB of neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed, chunks, column_bytes, run_hashes, sliding_min, span_hashes, window_hashes, word_spans

#: Ids below are of rows without one.
NO_ID, OWN_IDS = -(1 << 63), 1 << 40
FIRST = 13


def lengths_of(window: int, first: int = FIRST) -> list[int]:
    """Lengths of the levels: halves of the next, rounded up, down to about `first` words; two at least."""
    out = [window]
    while len(out) < 2 or out[0] >= 2 * first - 1 and out[0] > 2:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _flat(batch: pa.RecordBatch, i: int, j: int, raw: np.ndarray, at: np.ndarray, second: bool = False):
    """Word hashes of rows i to j, and the offset of each row's first word; second: and the words' second hashes."""
    part, offsets = raw[at[i] : at[j]], at[i : j + 1] - at[i]
    starts, ends, first = word_spans(part, offsets)
    return span_hashes(part, starts, ends), first, span_hashes(part, starts, ends, second=True) if second else None


def _windows(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that stay inside a row, and their rows."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
    return np.arange(int(counts.sum())) + np.repeat(first[:-1] - before, counts), rows


def _anchors(words: np.ndarray, length: int, window: int) -> np.ndarray:
    """For each full window the least hash of its windows of `length` words."""
    return sliding_min(window_hashes(words, length), window - length + 1)


def _stretches(words: np.ndarray, length: int, window: int, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of full windows, some there are, and the first and last window of each run of one anchor in a row."""
    low = _anchors(words, length, window)[starts]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(new)
    return low, begin, np.append(begin[1:], len(starts)) - 1


def _lists(column: pa.Array, i: int, j: int) -> np.ndarray:
    """The sorted distinct values of list rows i to j."""
    return np.unique(column.slice(i, j - i).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))


def _anchor_level(lengths: list[int], level: int):
    """Anchors of the level's length of full windows whose anchors of the level before are in the lists: rows (k, d), or of stretches (k, d, c) if the next level is the last."""
    length, window = lengths[level], lengths[-1]
    last = level == len(lengths) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                words, first, other = _flat(batch, i, j, raw, at, second=last)
                starts, rows = _windows(first, window)
                if not len(starts):
                    continue
                keep = ids[i:j][rows] >= NO_ID + OWN_IDS
                if level:
                    keep &= np.isin(_anchors(words, lengths[level - 1], window)[starts], _lists(batch.column(2), i, j))
                low, begin, end = _stretches(words, length, window, starts, rows)
                some = np.logical_or.reduceat(keep, begin)
                begin, end = begin[some], end[some]
                columns = {"k": low[begin].view(np.int64), "d": ids[i:j][rows[begin]]}
                if last:
                    columns["c"] = run_hashes(other, starts[begin], starts[end] + window).view(np.int64)
                yield pa.RecordBatch.from_pydict({name: pa.array(x) for name, x in columns.items()})

    return run


def _last_level(lengths: list[int]):
    """Windows of the last length whose anchors are in the lists: rows (h, g, d, later)."""
    length = lengths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                alive, later = _lists(batch.column(2), i, j), _lists(batch.column(3), i, j)
                words, first, other = _flat(batch, i, j, raw, at, second=True)
                starts, rows = _windows(first, length)
                if not len(starts) or not len(alive):
                    continue
                anchors = _anchors(words, lengths[-2], length)[starts]
                keep = np.isin(anchors, alive)
                starts, rows, late = starts[keep], rows[keep], np.isin(anchors[keep], later)
                h = window_hashes(words, length)[starts]
                order = np.lexsort((h, rows))  # a window that a row repeats is told once
                once = np.ones(len(order), bool)
                once[1:] = (h[order][1:] != h[order][:-1]) | (rows[order][1:] != rows[order][:-1])
                one = order[once]
                g = run_hashes(other, starts[one], starts[one] + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[one].view(np.int64)), pa.array(g.view(np.int64)), pa.array(ids[i:j][rows[one]]), pa.array(late[one])],
                    ["h", "g", "d", "later"],
                )

    return run


_OUT = pa.schema([("d", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("kept", pa.string())])


def _remove(window: int, shorter: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                gone, whole = batch.column(2).slice(i, j - i), batch.column(3).slice(i, j - i)
                n_words, n_removed, spans, kept = [], [], [], []
                for k in range(j - i):
                    words = raw[at[i + k] : at[i + k + 1]].tobytes().split()
                    n_words.append(len(words))
                    marked = []
                    if (gone[k].is_valid or whole[k].is_valid) and len(words) >= window:
                        flat, _, other = _flat(batch, i + k, i + k + 1, raw, at, second=True)
                        out = np.isin(window_hashes(flat, window), _lists(gone, k, k + 1))
                        every = np.arange(len(out))
                        _, begin, end = _stretches(flat, shorter, window, every, np.zeros_like(every))
                        out |= np.repeat(np.isin(run_hashes(other, begin, end + window), _lists(whole, k, k + 1)), end - begin + 1)
                        starts = np.flatnonzero(out)
                        if len(starts):
                            cover = np.zeros(len(words) + 1, np.int64)
                            np.add.at(cover, starts, 1)
                            np.add.at(cover, starts + window, -1)
                            covered = np.cumsum(cover[:-1]) > 0
                            edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                            marked = [{"first": int(a), "last": int(b) - 1} for a, b in edge.reshape(-1, 2)]
                            words = list(compress(words, ~covered))
                    n_removed.append(n_words[-1] - len(words))
                    spans.append(marked)
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, _OUT.field("spans").type), pa.array(kept, pa.binary()).cast(pa.string())], schema=_OUT)

    return run


def _back(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys, shuffled for the join on both sides."""
    anew = [F.bitwise_not(F.col(k)).alias(f"n_{k}") for k in keys]
    named = [f"n_{k}" for k in keys]
    return rows.select("*", *anew).join(groups.select(*[c for c in groups.columns if c not in keys], *anew), named)


def remove_repeats(docs: DataFrame, *, window: int = 50, first: int = FIRST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_removed, removed spans (word numbers) and the kept words.

    first: about the words of the first level; see lengths_of.
    """
    if window < 2 or first < 1:
        raise ValueError("a window has two words at least")
    lengths = lengths_of(window, first)

    row = F.pmod(F.monotonically_increasing_id(), F.lit(OWN_IDS)) + F.lit(NO_ID)
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), row, F.lit(NO_ID)).alias("d"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    read, last = own, len(lengths) - 2
    own = own.repartition("d")
    for level in range(last + 1):
        rows = read.mapInArrow(_anchor_level(lengths, level), "k long, d long" + (", c long" if level == last else ""))
        groups = rows.groupBy("k").agg(F.min("d").alias("low"), F.max("d").alias("high"), *([(F.min("c") == F.max("c")).alias("one"), F.min("c").alias("content")] if level == last else [])).where("low < high").drop("high")
        found = _back(rows, groups, ["k"])
        if level < last:
            alive = checkpointed(found.groupBy("d").agg(F.collect_set("k").alias("alive")))
            read = own.join(alive, "d").select("d", "t", "alive")

    found = found.select("d", "k", "one", "content", (F.col("d") > F.col("low")).alias("later"))
    whole = found.where("one and later").groupBy("d").agg(F.collect_set("content").alias("whole"))
    alive = found.where("not one").groupBy("d").agg(F.collect_set("k").alias("alive"), F.collect_set(F.when(F.col("later"), F.col("k"))).alias("late"))
    rows = own.join(alive, "d").select("d", "t", "alive", "late").mapInArrow(_last_level(lengths), "h long, g long, d long, later boolean")
    groups = rows.groupBy("h", "g").agg(F.min("d").alias("low"), F.max("d").alias("high")).where("low < high").drop("high")
    gone = _back(rows.where("later"), groups, ["h", "g"]).where("d > low").groupBy("d").agg(F.collect_set("h").alias("gone"))

    marked = own.join(gone, "d", "left").join(whole, "d", "left").select("d", "t", "gone", "whole")
    out = marked.mapInArrow(_remove(window, lengths[-2]), "d long, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept string")
    return out.select(F.when(F.col("d") >= NO_ID + OWN_IDS, F.col("d")).alias(id_col), "n_words", "n_removed", "spans", F.col("kept").alias("kept_text"))
