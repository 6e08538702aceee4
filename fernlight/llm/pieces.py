"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is split into words as SentencePiece does: a space is written as the mark U+2581, one mark is
put before the text, and a word is a run of marks with what follows up to the next mark. No piece has a
mark behind another character (checked when a model is read), so the best pieces of a text are the
best pieces of its words, and each distinct word of a chunk is cut once. Likewise a word is taken apart
where no piece has its two neighbouring characters side by side.

All distinct words of a chunk advance together, one character a step, longest words first so that
those still running are a prefix; equal lengths end at the same step. At each character the hashes
of the up to `longest` substrings that end there are extended from the step before, probe the
sorted hashes of the pieces, and the maximum over best score before + piece score, with the longest piece first among equals,
stores score and backpointer. Characters that no piece covers score least - 10 and become
byte pieces. Backpointers are followed for all words at once.

The score of a cut is the sum of its pieces' scores, as in SentencePiece's unigram model. Decoding
joins pieces' bytes, turns marks into spaces and drops the first: it returns every text as it was.
A mark in the text itself is stored as its three bytes, so it comes back as well.

Cases: null text counts as empty, and an empty text has no pieces. Texts without a space are one
word, whatever their length: no cut of them is left out, but words this long advance alone and take
some 40 microseconds a character. Memory follows 2 MB of text or one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.llm.common import chunks, column_bytes, ragged, span_hashes

MARK = 0x2581
UNKNOWN_PENALTY = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15)
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Pieces:
    """A vocabulary as arrays. hashes: of normal pieces, sorted; ids and scores in that order."""

    hashes: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    lengths: np.ndarray
    longest: int
    unknown: float
    byte_ids: np.ndarray  # of bytes 0 to 255
    data: np.ndarray  # what each id decodes to, one after the other
    offsets: np.ndarray
    maybe: np.ndarray  # by the first 20 bits of a hash: whether any piece begins so
    neighbours: np.ndarray  # pairs of characters that are next to each other in a piece, sorted

    @classmethod
    def build(cls, pieces: list[tuple[int, str, float]], byte_ids: list[int], size: int) -> Pieces:
        """pieces: (id, piece, score) of normal pieces; byte_ids: of bytes 0 to 255."""
        if any("▁" in p.lstrip("▁") for _, p, _ in pieces):
            raise ValueError("a piece has a mark behind another character")
        hashes = np.array([hash_of(p) for _, p, _ in pieces], np.uint64)
        order = np.argsort(hashes)
        if (np.diff(hashes[order].astype(object)) == 0).any():
            raise ValueError("two pieces have one hash")
        text = [b""] * size
        for i, p, _ in pieces:
            text[i] = p.replace("▁", " ").encode()
        for b, i in enumerate(byte_ids):
            text[i] = bytes([b])
        maybe = np.zeros(1 << 20, bool)
        maybe[hashes >> np.uint64(44)] = True
        take = lambda k, t: np.array([x[k] for x in pieces], t)[order]
        scores = take(2, np.float64)
        return cls(hashes[order], take(0, np.int32), scores, np.array([len(p) for _, p, _ in pieces])[order], max(len(p) for _, p, _ in pieces), float(scores.min()) - UNKNOWN_PENALTY, np.array(byte_ids, np.int32), np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in text])]), maybe, np.array(sorted({ord(a) << 32 | ord(b) for _, p, _ in pieces for a, b in zip(p, p[1:])}), np.int64))


def read_model(path: str) -> Pieces:
    """Reads a SentencePiece model file on the driver."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    bytes_at = {p.id_to_piece(i): i for i in range(p.vocab_size()) if p.is_byte(i)}
    if len(bytes_at) != 256:
        raise ValueError("the model has no byte pieces")
    normal = [(i, p.id_to_piece(i), p.get_score(i)) for i in range(p.vocab_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    return Pieces.build(normal, [bytes_at[f"<0x{b:02X}>"] for b in range(256)], p.vocab_size())


def hash_of(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _viterbi(v: Pieces, points: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of words points[at:at + size], most characters first, in order, and their counts; -point - 1 for an unknown character."""
    n, wide = len(at), v.longest
    back = np.zeros(len(points) + 1, np.int16)  # at the place of the last character of a piece
    token = np.zeros(len(points) + 1, np.int64)
    # column c is the substring of wide - c characters
    hashes = np.zeros((n, wide), np.uint64)
    before = np.full((n, wide), -np.inf)
    before[:, wide - 1] = 0.0
    live = n
    for t in range(int(size[0]) if n else 0):
        while size[live - 1] <= t:
            live -= 1
        place = at[:live] + t
        point = points[place]
        low = max(0, wide - 1 - t)  # no substring is longer than what came
        h, b = hashes[:live, low:], before[:live, low:]
        h[:, :-1] = h[:, 1:] * _BASE
        h[:, -1] = 0
        h += (point + 1).astype(np.uint64)[:, None]
        row, col = np.nonzero(v.maybe[h >> np.uint64(44)])
        key = h[row, col]
        found = np.searchsorted(v.hashes, key)
        found[found == len(v.hashes)] = 0
        hit = v.hashes[found] == key
        row, col, found = row[hit], col[hit], found[hit]
        score = np.full(h.shape, -np.inf)
        score[row, col] = b[row, col] + v.scores[found]
        which = np.zeros(h.shape, np.int32)
        which[row, col] = v.ids[found]
        one = score[:, -1]
        lone = one == -np.inf
        one[lone] = b[lone, -1] + v.unknown
        best = score.argmax(axis=1)
        each = np.arange(live)
        back[place] = h.shape[1] - best
        token[place] = np.where(lone & (best == h.shape[1] - 1), -point - 1, which[each, best])
        b = before[:live, max(0, low - 1) :]
        b[:, :-1] = b[:, 1:]
        b[:, -1] = score[each, best]
    # follow the backpointers of all words at once
    place, words, got_word, got = at + size - 1, np.arange(n), [], []
    while len(words):
        got_word.append(words)
        got.append(token[place])
        place = place - back[place]
        more = place >= at[words]
        place, words = place[more], words[more]
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, tokens = np.concatenate(got_word), np.concatenate(got)
    step = np.repeat(np.arange(len(got)), [len(x) for x in got])
    order = np.lexsort((-step, word))
    return tokens[order], np.bincount(word, minlength=n)


def _expand(v: Pieces, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unknown characters as byte pieces."""
    odd = np.flatnonzero(tokens < 0)
    if not len(odd):
        return tokens.astype(np.int32), counts
    text = [chr(MARK if p == OWN_MARK else p).encode() for p in (-tokens[odd] - 1).tolist()]
    each = np.ones(len(tokens), np.int64)
    each[odd] = [len(t) for t in text]
    out = np.repeat(tokens, each).astype(np.int32)
    start = np.cumsum(each) - each
    out[ragged(start[odd], each[odd])] = v.byte_ids[np.frombuffer(b"".join(text), np.uint8)]
    total = np.concatenate([[0], np.cumsum(each)])
    edge = np.concatenate([[0], np.cumsum(counts)])
    return out, total[edge[1:]] - total[edge[:-1]]


OWN_MARK = 0x110000  # stands for a mark of the text itself


def encode_texts(v: Pieces, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts raw[at[k]:at[k + 1]], one after the other, and their counts."""
    n = len(at) - 1
    size = np.diff(at)
    some = size > 0
    # every text that has characters gets a space in front
    length = size + some
    offsets = np.concatenate([[0], np.cumsum(length)])
    flat = np.full(int(offsets[-1]), 0x20, np.uint8)
    flat[ragged(offsets[:-1] + some, size)] = raw[at[0] : at[-1]]
    if not len(flat):
        return np.zeros(0, np.int32), np.zeros(n, np.int64)
    space = flat == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1][some]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(flat))
    hashes = span_hashes(flat, starts, ends)
    _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
    pick = ragged(starts[example], (ends - starts)[example])
    words = flat[pick]
    points = np.frombuffer(words.tobytes().decode("utf-8", errors="replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    head = (words & 0xC0) != 0x80
    edge = np.concatenate([[0], np.cumsum((ends - starts)[example])])
    chars = np.concatenate([[0], np.cumsum(head)])[edge]
    points = np.where(points == 0x20, MARK, np.where(points == MARK, OWN_MARK, points))
    # where no piece has two neighbours side by side, every cut of the word has a cut
    pairs = points[:-1] << 32 | points[1:]
    found = np.searchsorted(v.neighbours, pairs)
    apart = np.ones(len(points), bool)
    if len(v.neighbours):
        apart[1:] = v.neighbours[np.minimum(found, len(v.neighbours) - 1)] != pairs
    apart[chars[:-1]] = True
    part = np.flatnonzero(apart)
    size_of = np.diff(np.append(part, len(points)))
    order = np.argsort(-size_of, kind="stable")
    tokens, counts = _viterbi(v, points, part[order], size_of[order])
    tokens, counts = _expand(v, tokens, counts)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tokens, counts = tokens[ragged((np.cumsum(counts) - counts)[rank], counts[rank])], counts[rank]
    total = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(part, chars)]
    begin, counts = total[:-1], np.diff(total)
    ids = tokens[ragged(begin[which], counts[which])]
    word_total = np.concatenate([[0], np.cumsum(counts[which])])
    return ids, np.diff(word_total[np.searchsorted(starts, offsets)])


def decode_ids(v: Pieces, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and offsets. Ids that stand for no text are skipped."""
    begin, size = v.offsets[ids], v.offsets[ids + 1] - v.offsets[ids]
    raw = v.data[ragged(begin, size)]
    total = np.concatenate([[0], np.cumsum(size)])
    edge = total[np.concatenate([[0], np.cumsum(counts)])]
    # the space in front of each text goes
    lead = edge[:-1][(np.diff(edge) > 0)]
    lead = lead[raw[lead] == 0x20]
    keep = np.ones(len(raw), bool)
    keep[lead] = False
    left = np.concatenate([[0], np.cumsum(keep)])
    return raw[keep], left[edge]


# --- the operator


def _shared(spark: SparkSession, model: str | Pieces):
    return spark.sparkContext.broadcast(read_model(model) if isinstance(model, str) else model)


def encode(docs: DataFrame, *, model: str | Pieces = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array of int), n_tokens."""
    vocabulary = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at, 2 << 20):
                ids, counts = encode_texts(v, raw, at[i : j + 1])
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(counts)], ["i", "ids", "n_tokens"])

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return own.mapInArrow(run, "i long, ids array<int>, n_tokens long").withColumnRenamed("i", id_col)


def decode(rows: DataFrame, *, model: str | Pieces = DEFAULT_MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, text."""
    vocabulary = _shared(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                lists = batch.column(1).slice(i, 1000)
                counts = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                raw, at = decode_ids(v, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1000), pa.array([raw[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()).cast(pa.string())], ["i", "text"])

    own = rows.select(F.col(id_col).cast("long").alias("i"), F.col(ids_col).cast("array<int>").alias("ids"))
    return own.mapInArrow(run, "i long, text string").withColumnRenamed("i", id_col)


def encoded_digests(docs: DataFrame, *, model: str | Pieces = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, n_byte_tokens, ids_sha256 (of int32, low byte first), text_sha256 (of the decoded ids), round_trip."""
    vocabulary = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at, 2 << 20):
                ids, counts = encode_texts(v, raw, at[i : j + 1])
                back, edge = decode_ids(v, ids, counts)
                cut = np.concatenate([[0], np.cumsum(counts)])
                is_byte = np.concatenate([[0], np.cumsum(np.isin(ids, v.byte_ids))])
                codes = ids.astype("<i4")
                sha = [hashlib.sha256(codes[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                text = [hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                same = np.diff(edge) == np.diff(at[i : j + 1])
                if same.all() and np.array_equal(back, raw[at[i] : at[j]]):
                    trips = same
                else:
                    trips = np.array([np.array_equal(back[edge[k] : edge[k + 1]], raw[at[i + k] : at[i + k + 1]]) for k in range(j - i)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts), pa.array(is_byte[cut[1:]] - is_byte[cut[:-1]]), pa.array(sha, pa.string()), pa.array(text, pa.string()), pa.array(trips)], ["i", "n_tokens", "n_byte_tokens", "ids_sha256", "text_sha256", "round_trip"])

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return own.mapInArrow(run, "i long, n_tokens long, n_byte_tokens long, ids_sha256 string, text_sha256 string, round_trip boolean").withColumnRenamed("i", id_col)
