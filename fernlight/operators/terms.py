"""Lexicons as tables: which of very many terms occur in each text, by an Aho-Corasick automaton over Arrow buffers.

The automaton is arrays: a hash table of (state, byte) transitions, failure links, and for each state the term that
ends there and the nearest state behind it where one does. Texts are cut into pieces that overlap by the longest
term less one, so nothing is lost between them; all pieces of a batch advance together, one byte a step, and those
without a transition fall back together. A term counts once a text, however often and in however many pieces it
occurs. Memory follows a batch of 2 MB and the automaton, not the text or the number of hits.

The terms go to the driver, which builds the automaton and hands it to all tasks: `MOST_BYTES` of terms at most,
some ten million; more is refused. The module stands alone and travels with the function that uses it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MOST_BYTES = 128 << 20
PIECE, BATCH = 2048, 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Automaton:
    """States are numbered by level; 0 is the root."""

    keys: np.ndarray  # of transitions: state << 8 | byte, hashed, open addressing
    values: np.ndarray
    fail: np.ndarray
    term: np.ndarray  # number of the term that ends at a state, or -1
    link: np.ndarray  # nearest state down the failure links, itself included, where a term ends; 0: none
    longest: int

    def go(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The state each transition leads to; -1 where there is none."""
        key = state.astype(np.uint64) << np.uint64(8) | byte.astype(np.uint64)
        mask = len(self.keys) - 1
        at = (key * _ODD >> np.uint64(64 - mask.bit_length())).astype(np.int64) if mask else np.zeros(len(key), np.int64)
        out = np.full(len(key), -1, np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            found = self.keys[at[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found != _FREE)]
            at[open_] = (at[open_] + 1) & mask
        return out

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Goes on by a byte, over failure links where needed."""
        out = self.go(state, byte)
        stuck = np.flatnonzero(out < 0)
        at = state[stuck]
        while len(stuck):
            home = at == 0
            out[stuck[home]] = 0
            stuck, at = stuck[~home], self.fail[at[~home]]
            next_ = self.go(at, byte[stuck])
            done = next_ >= 0
            out[stuck[done]] = next_[done]
            stuck, at = stuck[~done], at[~done]
        return out


_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash table half full at most; keys that meet go on to the next free place, all in turn together."""
    size = 1 << max(1, int(2 * len(keys)).bit_length())
    table, held = np.full(size, _FREE), np.zeros(size, np.int64)
    at = (keys * _ODD >> np.uint64(64 - (size - 1).bit_length())).astype(np.int64)
    open_ = np.arange(len(keys))
    while len(open_):
        free = table[at[open_]] == _FREE
        some = open_[free]
        _, first = np.unique(at[some], return_index=True)
        took = some[first]
        table[at[took]], held[at[took]] = keys[took], values[took]
        open_ = np.setdiff1d(open_, took, assume_unique=True)
        at[open_] = (at[open_] + 1) & (size - 1)
    return table, held


def build(terms: list[bytes]) -> Automaton:
    """Of distinct terms, none empty."""
    order = sorted(range(len(terms)), key=lambda k: terms[k])
    length = np.array([len(terms[k]) for k in order], np.int64)
    raw = np.frombuffer(b"".join(terms[k] for k in order), np.uint8)
    start = np.cumsum(length) - length
    # sorted terms that share a prefix are neighbours: each level's states are runs of them
    state = np.zeros(len(order), np.int64)
    parents, bytes_, levels, n = [np.zeros(1, np.int64)], [np.zeros(1, np.uint8)], [np.zeros(1, np.int64)], 1
    ends: list[tuple[int, np.ndarray, np.ndarray]] = []
    for depth in range(int(length.max()) if len(order) else 0):
        live = np.flatnonzero(length > depth)
        byte = raw[start[live] + depth]
        new = np.concatenate([[True], (state[live][1:] != state[live][:-1]) | (byte[1:] != byte[:-1])])
        number = n + np.cumsum(new) - 1
        parents.append(state[live][new])
        bytes_.append(byte[new])
        levels.append(np.arange(n, n + int(new.sum())))
        state[live] = number
        n += int(new.sum())
        done = live[length[live] == depth + 1]
        ends.append((depth, done, state[done]))
    parent, byte = np.concatenate(parents), np.concatenate(bytes_)
    keys, values = _table(parent[1:].astype(np.uint64) << np.uint64(8) | byte[1:].astype(np.uint64), np.arange(1, n))
    term = np.full(n, -1, np.int64)
    for _, done, at in ends:
        term[at] = np.array(order, np.int64)[done]
    out = Automaton(keys, values, np.zeros(n, np.int64), term, np.zeros(n, np.int64), int(length.max()) if len(order) else 1)
    for level in levels[1:]:  # failure links follow those of the level before
        deep = parent[level] != 0
        out.fail[level[deep]] = out.step(out.fail[parent[level[deep]]], byte[level[deep]])
        out.link[level] = np.where(term[level] >= 0, level, out.link[out.fail[level]])
    return out


def found_in(a: Automaton, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, term), each once, of the texts raw[at[k]:at[k + 1]]."""
    size = np.diff(at)
    step = max(PIECE, 2 * a.longest)
    count = np.maximum(1, -(-(size - a.longest + 1) // step))  # pieces of a text; each goes on for longest - 1 bytes
    text = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = at[text] + nth * step
    end = np.minimum(begin + step + a.longest - 1, at[text + 1])
    order = np.argsort(begin - end, kind="stable")  # longest first: those still running are a prefix
    text, begin, length = text[order], begin[order], (end - begin)[order]
    state, pairs = np.zeros(len(text), np.int64), []
    live = len(text)
    for t in range(int(length[0]) if live else 0):
        while length[live - 1] <= t:
            live -= 1
        state[:live] = a.step(state[:live], raw[begin[:live] + t])
        k = np.flatnonzero(a.link[state[:live]])
        at_ = a.link[state[k]]
        while len(k):
            pairs.append(text[k] * len(a.term) + at_)
            at_ = a.link[a.fail[at_]]
            k, at_ = k[at_ > 0], at_[at_ > 0]
        if len(pairs) > 4096:  # what one text repeats
            pairs = [np.unique(np.concatenate(pairs))]
    every = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return every // len(a.term), a.term[every % len(a.term)]


def term_hits(texts: DataFrame, terms: DataFrame, *, text_col: str, term_col: str = "term", weight_col: str = "weight", list_col: str = "list") -> DataFrame:
    """texts with a column for each list of terms: the summed weights of those that occur in the text.

    A term that a list has several times counts with all its weights, as `hits` does. Null texts hold nothing; the empty term is in every
    other text; null terms, lists and weights are left out. Texts are compared as they are: lower them first.
    """
    rows = terms.select(F.col(list_col).cast("string").alias("l"), F.col(term_col).cast("string").alias("t"), F.col(weight_col).cast("long").alias("w")).dropna().groupBy("l", "t").agg(F.sum("w").alias("w")).persist()
    total = rows.agg(F.sum(F.octet_length("t")).alias("n")).first().n or 0
    if total > MOST_BYTES:
        raise ValueError(f"{total} bytes of terms; {MOST_BYTES} at most")
    held = rows.orderBy("l", "t").toArrow()
    rows.unpersist()
    lists = sorted(set(held["l"].to_pylist()))
    words = sorted({t.encode() for t in held["t"].to_pylist() if t})
    place = {w: k for k, w in enumerate(words)}
    weights, always = np.zeros((len(lists), len(words)), np.int64), np.zeros(len(lists), np.int64)
    for name, t, w in zip(*(held[c].to_pylist() for c in "ltw"), strict=True):
        if t:
            weights[lists.index(name), place[t.encode()]] = w
        else:
            always[lists.index(name)] = w
    if set(lists) & set(texts.columns):
        raise ValueError("a list has the name of a column")
    shared = texts.sparkSession.sparkContext.broadcast((vars(build(words)), weights, always))
    where = texts.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, weights, always = shared.value
        a = Automaton(**parts)
        for batch in batches:
            column = batch.column(where)
            some = pa.compute.is_valid(column).to_numpy(zero_copy_only=False)
            own = column.fill_null("").cast(pa.large_binary())
            _, offsets, data = own.buffers()
            at = np.frombuffer(offsets, np.int64)[own.offset : own.offset + len(own) + 1]
            raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            sums = np.zeros((len(weights), batch.num_rows), np.int64) + always[:, None] * some
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(at, at[i] + BATCH, side="right")) - 1)
                text, term = found_in(a, raw, at[i : j + 1])
                for k in range(len(weights)):
                    np.add.at(sums[k], i + text, weights[k][term])
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, sums)], [*batch.schema.names, *lists])

    return texts.mapInArrow(run, StructType([*texts.schema.fields, *[StructField(name, LongType()) for name in lists]]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
