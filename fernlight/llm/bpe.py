"""Byte-pair encoding and decoding with content-defined chunks that are encoded once.

* Chunks. A rolling hash over 16 bytes cuts texts where its low bits are zero, on character boundaries, at least
  `GAP` bytes apart: some 300 bytes a chunk, the same chunks wherever the same passage occurs. Each task keeps
  the ids of the chunks it has met by 128 bits of their content, so what documents share is encoded
  once a task. The store is emptied when it holds `STORE_TOKENS` ids.
* Joins. This tokenizer drops white space, and nothing on one side of ASCII white space changes ids
  on the other. So ids of two neighbouring chunks agree with those of the text but for the stretch
  without white space that a cut divides. Where a cut has white space at its side, the ids are
  joined as they are; else the ids of the divided ends are dropped, and the stretch is encoded again as
  a whole, over as many chunks as it takes until both its ends are at white space. Every cut ends
  in one of these two states, so ids equal those of the whole text.
* Words. Distinct stretches of all new chunks are split into words (letters, single digits, other
  signs, and the seven endings behind an apostrophe) by byte classes where they are ASCII or Latin letters up
  to U+00FF, and by the file's own normalizer and pre-tokenizer where they are not. All words of one length class merge together:
  each round applies to every word its pair of the lowest rank, the leftmost among equals, looked up in
  a hash table of pairs. Words of over 64 bytes merge alone, by a heap.
* Decoding looks up the text of each id and joins them by one blank, as the file has no decoder; special
  tokens are kept.

Sharing stays inside a task: sharing across tasks would send every text and its ids through a shuffle.

Cases: null text counts as empty; an empty text has no ids and decodes to the empty text. Special tokens in
a text get their ids. Texts without white space are one stretch, taken whole, however long. Rows that
repeat an id are rows of their own, and a null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.llm.common import Powers, chunks, column_bytes, ragged, span_hashes

DEFAULT_MODEL = "/opt/tokenizers/word_bpe_49k.json"
WINDOW, CUT_BITS, GAP = 16, 8, 64
STORE_TOKENS = 8_000_000
WIDEST = 64
_NONE = np.int32(0x7FFFFFFF)
_ROLL = Powers(0xA24BAED4963EE407)

#: How the file splits words, and the endings of that pattern with their apostrophe left out.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[_IS_SPACE] = 0
_CLASS[0x80:] = _LETTER  # of U+00C0 to U+00FF, as two bytes


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@dataclass
class Vocabulary:
    """A tokenizer file as arrays. inner and last: ids of a byte inside and at the end of a word."""

    inner: np.ndarray
    last: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray, int]]  # pair keys, ranks, multiplier; a key is in the first table that has room
    made: np.ndarray  # the id that the merge of a rank makes
    special: dict[str, int]
    texts: list[bytes]  # of ids
    source: str  # the file without vocabulary, for texts beyond ASCII
    _tools: Any = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tools": None}

    def tools(self) -> Any:
        if self._tools is None:
            from tokenizers import Tokenizer

            self._tools = Tokenizer.from_str(self.source)
        return self._tools

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; _NONE where they don't merge."""
        key = left.astype(np.uint64) << np.uint64(17) | right.astype(np.uint64)
        out = np.full(key.shape, _NONE, np.int32)
        for keys, ranks, odd in self.tables:
            at = (key * np.uint64(odd)) >> np.uint64(64 - (len(keys).bit_length() - 1))
            hit = keys[at] == key
            out[hit] = ranks[at[hit]]
        return out


def _pair_tables(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Hash tables without probing: keys that meet in one go on to the next, which is smaller."""
    ranks, out, bits, odd = np.arange(len(keys), dtype=np.int32), [], 19, 0x9E3779B97F4A7C15
    while len(keys):
        at = ((keys * np.uint64(odd)) >> np.uint64(64 - bits)).astype(np.int64)
        table, values = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(1 << bits, np.int32)
        _, first = np.unique(at, return_index=True)
        table[at[first]], values[at[first]] = keys[first], ranks[first]
        out.append((table, values, odd))
        left = np.ones(len(keys), bool)
        left[first] = False
        keys, ranks, bits, odd = keys[left], ranks[left], max(10, bits - 3), (odd * 0xD6E8FEB86659FD93 | 1) & 0xFFFFFFFFFFFFFFFF
    return out


def read_vocabulary(path: str) -> Vocabulary:
    """Reads a tokenizer file on the driver: byte-level BPE with word ends and without a decoder."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, suffix = file["model"], file["model"]["end_of_word_suffix"]
    split = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
    kinds = [x["type"] for x in (file["normalizer"] or {}).get("normalizers", [])]
    if model["type"] != "BPE" or not suffix or split != PATTERN or kinds != ["NFC", "Replace", "Lowercase"] or file["decoder"] or any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in file["added_tokens"]):
        raise ValueError("a lower-casing byte-level BPE with word ends and no decoder is needed")
    vocabulary, chars = model["vocab"], byte_characters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    keys = np.array([vocabulary[a] << 17 | vocabulary[b] for a, b in merges], np.uint64)
    special = {x["content"]: x["id"] for x in file["added_tokens"]}
    texts = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, i in [*vocabulary.items(), *special.items()]:
        texts[i] = token.encode()
    source = json.dumps(file | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []})
    return Vocabulary(np.array([vocabulary[c] for c in chars], np.int32), np.array([vocabulary[c + suffix] for c in chars], np.int32), _pair_tables(keys), np.array([vocabulary[a + b] for a, b in merges], np.int32), special, texts, source)


# --- merging


def _merge_long(v: Vocabulary, ids: list[int]) -> list[int]:
    """One word by a heap of (rank, place)."""
    n = len(ids)
    after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    first = v.ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
    heap = [(r, k, ids[k], ids[k + 1]) for k, r in enumerate(first) if r != _NONE]
    heapq.heapify(heap)
    known: dict[tuple[int, int], int] = {}

    def rank(a: int, b: int) -> int:
        if (a, b) not in known:
            known[a, b] = int(v.ranks(np.array([a]), np.array([b]))[0])
        return known[a, b]

    while heap:
        r, k, a, b = heapq.heappop(heap)
        j = after[k]
        if gone[k] or j >= n or ids[k] != a or ids[j] != b:
            continue
        ids[k], gone[j], after[k] = int(v.made[r]), True, after[j]
        if after[k] < n:
            before[after[k]] = k
        for x, y in ((before[k], k), (k, after[k])):
            if x >= 0 and y < n and (s := rank(ids[x], ids[y])) != _NONE:
                heapq.heappush(heap, (s, x, ids[x], ids[y]))
    return [i for i, g in zip(ids, gone, strict=True) if not g]


def _merge_together(v: Vocabulary, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of ids, each of its size, merged in place of one another; sizes are changed, ids come back."""
    ids, width = ids.copy(), ids.shape[1]
    if width < 2:
        return ids
    column = np.arange(width - 1)
    rank = v.ranks(ids[:, :-1], ids[:, 1:])
    rank[column[None, :] >= size[:, None] - 1] = _NONE
    live = np.arange(len(ids))
    while len(live):
        at = rank.argmin(axis=1)
        best = rank[np.arange(len(live)), at]
        on = best != _NONE
        if not on.all():
            live, rank, at, best = live[on], rank[on], at[on], best[on]
            if not len(live):
                break
        row, each = ids[live], np.arange(len(live))
        behind = column[None, :] > at[:, None]
        row[:, :-1] = np.where(behind, row[:, 1:], row[:, :-1])
        row[each, at] = v.made[best]
        rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
        size[live] -= 1
        left = size[live]
        rank[each, np.maximum(left - 1, 0)] = _NONE
        ids[live] = row
        for side in (at - 1, at):
            k = np.flatnonzero((side >= 0) & (side + 1 < left))
            rank[k, side[k]] = v.ranks(row[k, side[k]], row[k, side[k] + 1])
    return ids


def merge_words(v: Vocabulary, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words raw[starts:ends], one after the other, and their counts."""
    size = ends - starts
    flat, done = [], []
    low = 0
    for width in (2, 4, 6, 8, 12, 16, 32, WIDEST):
        which = np.flatnonzero((size > low) & (size <= width))
        low = width
        if not len(which):
            continue
        n = size[which].copy()
        place = starts[which, None] + np.minimum(np.arange(width)[None, :], n[:, None] - 1)
        ids = v.inner[raw[place]]
        ids[np.arange(len(which)), n - 1] = v.last[raw[ends[which] - 1]]
        ids = _merge_together(v, ids, n)
        flat.append(ids[np.arange(width)[None, :] < n[:, None]])
        done.append((which, n))
    for k in np.flatnonzero(size > WIDEST).tolist():
        own = raw[starts[k] : ends[k]]
        ids = _merge_long(v, [*v.inner[own[:-1]].tolist(), int(v.last[own[-1]])])
        flat.append(np.array(ids, np.int32))
        done.append((np.array([k]), np.array([len(ids)])))
    counts = np.zeros(len(size), np.int64)
    if not done:
        return np.zeros(0, np.int32), counts
    which, n, ids = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done]), np.concatenate(flat)
    counts[which] = n
    at = np.zeros(len(size), np.int64)
    at[which] = np.cumsum(n) - n
    return ids[ragged(at, counts)], counts


# --- stretches without white space


def _plain_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased stretches of ASCII and U+00C0 to U+00FF, in order."""
    if not len(starts):
        return starts, ends
    # stretches side by side, a blank behind each
    size = ends - starts
    at = ragged(starts, size)
    gap = np.cumsum(size + 1) - (size + 1)
    own = np.full(int(gap[-1] + size[-1] + 4), 0x20, np.uint8)
    home = ragged(gap, size)
    own[home] = low[at]
    kind = _CLASS[own]
    new = np.ones(len(own), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    quote = np.flatnonzero((own[:-4] == ord("'")) & new[:-4])
    for ending in ENDINGS:
        hit = quote.copy()
        for k, c in enumerate(ending.encode()):
            hit = hit[own[hit + 1 + k] == c]
        new[hit + 1] = False
        new[hit + 1 + len(ending)] = True
    back = np.zeros(len(own), np.int64)
    back[home] = at
    begin = np.flatnonzero(new & (kind > 0))
    finish = np.flatnonzero(np.concatenate([new[1:] | (kind[1:] == 0), [True]]) & (kind > 0))
    return back[begin], back[finish] + 1


def _fold_latin(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes, and which are neither ASCII nor a letter of U+00C0 to U+00FF. Those letters are composed, and nothing but a later sign could compose with them."""
    tail = np.zeros(len(raw), bool)
    tail[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    letter = tail.copy()
    letter[:-1] |= tail[1:]
    low = _FOLD[raw]
    low[tail & (raw <= 0x9E)] += 0x20
    return low, (raw >= 0x80) & ~letter


def _library_words(v: Vocabulary, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words of each part, their sizes, and the number of words of each part, by the file's own rules.

    Parts go through together, with a zero byte in white space between them, which is a word of its own; parts
    that hold one themselves go alone.
    """
    tools, chars = v.tools(), byte_characters()
    words_of = lambda text: [w for w, _ in tools.pre_tokenizer.pre_tokenize_str(tools.normalizer.normalize_str(text))]
    zero, out, counts = chars[0], [], np.zeros(len(parts), np.int64)
    if any("\0" in p for p in parts):
        for k, part in enumerate(parts):
            own = words_of(part)
            counts[k] = len(own)
            out += own
    elif parts:
        found = words_of(" \0 ".join(parts))
        edge = np.array([-1, *(k for k, w in enumerate(found) if w == zero), len(found)])
        counts = np.diff(edge) - 1
        out = [w for w in found if w != zero]
    table = np.zeros(0x200, np.uint8)
    table[[ord(c) for c in chars]] = np.arange(256)
    return table[np.frombuffer("".join(out).encode("utf-32-le"), np.uint32)], np.array([len(w) for w in out], np.int64), counts


def encode_stretches(v: Vocabulary, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each stretch raw[starts:ends], one after the other, and their counts. Stretches are in order and lie apart."""
    n = len(starts)
    low, foreign = _fold_latin(raw)
    odd = np.concatenate([[0], np.cumsum(foreign)])
    mark = np.zeros(len(raw), bool)
    for token in v.special:  # where a special token may begin
        two = token.encode()[:2]
        mark[:-1] |= (raw[:-1] == two[0]) & (raw[1:] == two[-1])
    marks = np.concatenate([[0], np.cumsum(mark)])
    plain = (odd[ends] == odd[starts]) & (marks[ends] == marks[starts])
    p = np.flatnonzero(plain)
    begin, finish = _plain_words(low, starts[p], ends[p])
    owner = p[np.searchsorted(starts[p], begin, side="right") - 1] if len(p) else np.zeros(0, np.int64)
    ids, counts = merge_words(v, low, begin, finish)
    total = np.bincount(owner, weights=counts, minlength=n).astype(np.int64)

    rest = np.flatnonzero(~plain)
    if not len(rest):
        return ids, total
    split = re.compile("(" + "|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
    parts, whose, special = [], [], []
    for k, a, b, marked in zip(rest.tolist(), starts[rest].tolist(), ends[rest].tolist(), (marks[ends] > marks[starts])[rest].tolist(), strict=True):
        text = raw[a:b].tobytes().decode("utf-8", errors="replace")
        for part in split.split(text) if marked else [text]:
            if part:
                token = v.special.get(part, -1)
                parts.append("" if token >= 0 else part)
                whose.append(k)
                special.append(token)
    special, whose = np.array(special, np.int64), np.array(whose, np.int64)
    buffer, size, words = _library_words(v, parts)
    end = np.cumsum(size)
    more, each = merge_words(v, buffer, end - size, end)
    each = np.diff(np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(words)])])  # ids of a part
    lone = special >= 0
    each = each + lone
    out = np.empty(int(each.sum()), np.int32)
    at = np.cumsum(each) - each
    out[at[lone]] = special[lone]
    out[ragged(at[~lone], each[~lone])] = more
    extra = np.bincount(whose, weights=each, minlength=n).astype(np.int64)
    # both kinds in the order of the stretches
    counts = total + extra
    place = np.cumsum(counts) - counts
    joined = np.empty(int(counts.sum()), np.int32)
    joined[ragged(place[p], total[p])] = ids
    joined[ragged(place[rest], extra[rest])] = out
    return joined, counts


def _distinct(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each distinct span (by 128 bits), in order, and which of them each span is."""
    one = span_hashes(raw, starts, ends)
    two = span_hashes(raw, starts, ends, second=True)
    _, first, which = np.unique(one, return_index=True, return_inverse=True)
    if len(first) and not np.array_equal(two[first][which], two):
        _, first, which = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return first[order], rank[which.reshape(-1)]


def stretches(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what white space and edges (sorted places, 0 and the end among them) divide."""
    solid = np.concatenate([[False], ~_IS_SPACE[raw], [False]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[edges] = True
    return np.flatnonzero(solid[1:-1] & (~solid[:-2] | cut[:-1])), np.flatnonzero(solid[1:-1] & (~solid[2:] | cut[1:])) + 1


# --- chunks


def cut_places(raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sorted places where chunks begin or end, those of texts among them. edges: offsets of the texts from 0."""
    if len(raw) < WINDOW:
        return np.unique(edges)
    up, down = _ROLL.upto(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
    rolled = (total[WINDOW:] - total[:-WINDOW]) * down[: len(raw) - WINDOW + 1]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    found = np.flatnonzero(rolled[:-1] >> np.uint64(64 - CUT_BITS) == 0) + WINDOW  # cut behind the window
    found = found[(raw[found] & 0xC0) != 0x80]
    text = np.searchsorted(edges, found, side="right") - 1
    found = found[found - edges[text] >= GAP]
    kept, last = [], -GAP
    while len(found):  # of cuts that are close to each other the first stays; mostly few are
        close = np.concatenate([[False], np.diff(found) < GAP])
        if not close.any():
            kept.append(found)
            break
        k = int(close.argmax())
        kept.append(found[:k])
        last = found[k - 1]
        found = found[int(np.searchsorted(found, last + GAP)) :]
    return np.unique(np.concatenate([edges, *kept]))


class Store:
    """Ids of the chunks that a task has met: each chunk's ids, and how many belong to its first and last stretch."""

    def __init__(self, limit: int = STORE_TOKENS):
        self.slots: dict[tuple[int, int], tuple[np.ndarray, int, int]] = {}
        self.limit, self.held, self.asked, self.met = limit, 0, 0, 0


def encode_texts(v: Vocabulary, raw: np.ndarray, at: np.ndarray, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts raw[at[k]:at[k + 1]], one after the other, and their counts."""
    own, edges = raw[at[0] : at[-1]], at - at[0]
    if not len(own):
        return np.zeros(0, np.int32), np.zeros(len(at) - 1, np.int64)
    places = cut_places(own, edges)
    begin, end = places[:-1], places[1:]
    keys = list(zip(span_hashes(own, begin, end).tolist(), span_hashes(own, begin, end, second=True).tolist(), strict=True))
    store.asked += len(keys)
    if store.held > store.limit:
        store.slots.clear()
        store.held = 0
    new: dict[tuple[int, int], int] = {}
    for k, key in enumerate(keys):
        if key not in store.slots and key not in new:
            new[key] = k
    store.met += len(keys) - len(new)

    # distinct stretches of new chunks, and those that a cut divides, whole
    chosen = np.array(list(new.values()), np.int64)
    starts, ends = stretches(own, places)
    inside = np.zeros(len(begin), bool)
    inside[chosen] = True
    chunk = np.searchsorted(places, starts, side="right") - 1
    mine = inside[chunk]
    whole_start, whole_end = stretches(own, edges)
    cuts = places[~np.isin(places, edges)]
    broken = cuts[~_IS_SPACE[own[cuts]] & ~_IS_SPACE[own[cuts - 1]]]
    divided = np.unique(np.searchsorted(whole_start, broken, side="right") - 1)
    s, e = np.concatenate([starts[mine], whole_start[divided]]), np.concatenate([ends[mine], whole_end[divided]])
    order = np.lexsort((e, s))
    first, which = _distinct_any(own, s[order], e[order])
    text, bound = _side_by_side(own, s[order][first], e[order][first])
    ids, counts = encode_stretches(v, text, bound[:-1], bound[1:])
    offset = np.concatenate([[0], np.cumsum(counts)])
    slot = np.empty(len(order), np.int64)
    slot[order] = which
    of_chunk, of_whole = slot[: int(mine.sum())], slot[int(mine.sum()) :]

    # what the store gets
    n_of = counts[of_chunk]
    flat = ids[ragged(offset[of_chunk], n_of)].astype(np.int32)
    total = np.concatenate([[0], np.cumsum(n_of)])
    chunk_of = chunk[mine]
    low, high = np.searchsorted(chunk_of, chosen), np.searchsorted(chunk_of, chosen, side="right")
    for key, c, a, b in zip(new, chosen.tolist(), low.tolist(), high.tolist(), strict=True):
        got = flat[total[a] : total[b]]
        store.slots[key] = (got.copy(), int(n_of[a]) if b > a and not _IS_SPACE[own[begin[c]]] else 0, int(n_of[b - 1]) if b > a and not _IS_SPACE[own[end[c] - 1]] else 0)
        store.held += len(got) + 50

    # join: ends that a cut divides are dropped, and the stretch follows the chunk that it begins in
    is_broken = np.isin(places, broken)
    starts_in = np.searchsorted(places, whole_start[divided], side="right") - 1
    again = dict(zip(starts_in.tolist(), of_whole.tolist(), strict=True))
    solid = np.concatenate([[0], np.cumsum(_IS_SPACE[own])])
    single = (solid[end] == solid[begin]).tolist()
    left, right = is_broken[:-1].tolist(), is_broken[1:].tolist()
    parts, length = [], np.zeros(len(keys), np.int64)
    for k, key in enumerate(keys):
        got, head, tail = store.slots[key]
        if left[k] or right[k]:
            got = got[:0] if single[k] else got[head * left[k] : len(got) - tail * right[k]]
        parts.append(got)
        length[k] = len(got)
        if k in again and right[k]:
            j = again[k]
            parts.append(ids[offset[j] : offset[j + 1]])
            length[k] += counts[j]
    total = np.concatenate([[0], np.cumsum(length)])
    return np.concatenate(parts).astype(np.int32), np.diff(total[np.searchsorted(places, edges)])


def _side_by_side(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = ends - starts
    return raw[ragged(starts, size)], np.concatenate([[0], np.cumsum(size)])


def _distinct_any(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _distinct, of spans that may lie in each other."""
    text, bound = _side_by_side(raw, starts, ends)
    return _distinct(text, bound[:-1], bound[1:])


def decode_ids(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after the other, and offsets: the ids' texts joined by a blank."""
    return _joined(*_spaced(v.texts), ids, counts)


def _spaced(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b" ".join(texts) + b" ", np.uint8), np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])


def _joined(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of ids with a blank behind each; the last blank of a row is outside its offsets' end."""
    size = offsets[ids + 1] - offsets[ids]
    edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    return data[ragged(offsets[ids], size)], edge


# --- the operator


def _shared(spark: SparkSession, model: str | Vocabulary):
    return spark.sparkContext.broadcast(read_vocabulary(model) if isinstance(model, str) else model)


def encode(docs: DataFrame, *, model: str | Vocabulary = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array of int), n_tokens."""
    vocabulary = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, store = vocabulary.value, Store()
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                ids, counts = encode_texts(v, raw, at[i : j + 1], store)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(counts)], ["i", "ids", "n_tokens"])

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return own.mapInArrow(run, "i long, ids array<int>, n_tokens long").withColumnRenamed("i", id_col)


def decode(rows: DataFrame, *, model: str | Vocabulary = DEFAULT_MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, text. Null ids count as none; an id beyond the vocabulary fails."""
    vocabulary = _shared(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                lists = batch.column(1).slice(i, 1000)
                counts = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
                raw, at = decode_ids(v, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                texts = [raw[a : max(a, b - 1)].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1000), pa.array(texts, pa.binary()).cast(pa.string())], ["i", "text"])

    own = rows.select(F.col(id_col).cast("long").alias("i"), F.col(ids_col).cast("array<int>").alias("ids"))
    return own.mapInArrow(run, "i long, text string").withColumnRenamed("i", id_col)


def encoded_digests(docs: DataFrame, *, model: str | Vocabulary = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256 (of the decoded ids)."""
    vocabulary = _shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, store = vocabulary.value, Store()
        tables = [_spaced(v.texts), _spaced([str(i).encode() for i in range(len(v.texts))])]
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at):
                ids, counts = encode_texts(v, raw, at[i : j + 1], store)
                sha = []
                for table in tables:
                    text, edge = _joined(*table, ids, counts)
                    sha.append(pa.array([hashlib.sha256(text[a : max(a, b - 1)]).hexdigest() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(counts), sha[1], sha[0]], ["i", "n_tokens", "ids_sha256", "decoded_sha256"])

    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return own.mapInArrow(run, "i long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("i", id_col)
