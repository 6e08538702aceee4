"""SimHash near-dedup with keys from the binary Golay code.

Fingerprint: texts are lower-cased (A-Z), split into words `[^\\x20\\x09-\\x0D]+`, and every shingle of
`shingle` words, repeats included, is hashed by XXH64 (UTF-8, seed 42); a bit is set if more than half
of the hashes have it. Fewer words make one shingle; no words make fingerprint zero.

Links: two fingerprints link at 4 or fewer differing bits, and documents get the smallest id that
links reach. The 64 bits are three segments of 22, 21 and 21 bits, each a word of the perfect
(23, 12) Golay code's space with the rest zero. The keys of a segment are the indices of the
codewords nearest to it and to each of its neighbours at one bit, one to six of them: two segments
at two bits or fewer share a key, for the word between them decodes alike from both sides.

Pigeonhole: the two segments with the fewest errors have two errors together at most. So either

* one is equal and the other has at most two: key (equal segment, Golay key), or
* both have one: key (own decoding, neighbour's decodings) meets key (neighbour's, own).

Distinct fingerprints (copies are one already) are dealt by these keys. A bucket's fingerprints are
compared by search: what a fingerprint reaches is taken out, so a group of n near copies makes
n - 1 links and not n * n. Buckets over `block` fingerprints are compared block by block and then
pair of blocks by pair of blocks, in tasks of their own. Every link is verified by counting bits.

Long texts are hashed in parts of 4 MB that overlap by a shingle less one word.

Cases: null and empty texts and texts of white space have fingerprint zero and link like others.
Rows that repeat an id count once as a node and keep their rows. A null id is never the component's
id unless it is alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed, chunks, column_bytes, mix64, ragged
from fernlight.llm.components import components

RADIUS = 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# --- fingerprints

_BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)


def _hashes(text: bytes, shingle: int) -> list[int]:
    """XXH64 of every shingle, repeats included."""
    digest, words = xxhash.xxh64_intdigest, text.translate(_LOWER).split()
    if len(words) <= shingle:
        return [digest(b" ".join(words), 42)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    return [digest(line[s:e], 42) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def _parts(text: bytes, shingle: int, limit: int) -> Iterator[bytes]:
    """A text in parts of about `limit` bytes that hold each of its shingles once."""
    if len(text) <= limit:
        yield text
        return
    at, carried, some = 0, [], False
    while at < len(text):
        space = _SPACE.search(text, at + limit)
        end = space.start() if space else len(text)
        words = carried + text[at:end].split()
        at = end
        if len(words) >= shingle:
            yield b" ".join(words)
            some, carried = True, words[len(words) - shingle + 1 :]
        else:
            carried = words
    if not some:
        yield b" ".join(carried)


def fingerprints(texts: list[bytes], shingle: int, distinct: bool = False, limit: int = 1 << 22) -> np.ndarray:
    """SimHash of each text, as unsigned 64-bit numbers. distinct: each shingle counts once."""
    arrays, hashes, owners, counts, long = [], [], [], [], False
    for k, text in enumerate(texts):
        long |= len(text) > limit
        for part in _parts(text, shingle, limit):
            made = _hashes(part, shingle)
            if distinct:
                made = list(set(made))
            hashes += made
            owners.append(k)
            counts.append(len(made))
            if len(hashes) > 1 << 19:
                arrays.append(np.array(hashes, np.uint64))
                hashes = []
    arrays.append(np.array(hashes, np.uint64))
    values, owner = np.concatenate(arrays), np.repeat(np.array(owners, np.int64), counts)
    if distinct and long:
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
    n = len(texts)
    totals = np.bincount(owner, minlength=n)
    bytes_of = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    out = np.zeros(n, np.uint64)
    for k in range(8):
        seen = np.bincount((owner << 8) + bytes_of[:, k], minlength=n << 8).reshape(n, 256) @ _BITS
        out = (out << np.uint64(8)) | np.packbits(seen * 2 > totals[:, None], axis=1)[:, 0].astype(np.uint64)
    return out


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at, 1 << 20):
                texts = [raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(fingerprints(texts, shingle).view(np.int64))], ["i", "f"])

    return run


# --- Golay code

_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, fixed value


class Golay:
    """Decodes 23-bit words to the index (first 12 bits) of the one codeword within three bits."""

    def __init__(self):
        low = np.arange(1 << 11)
        high = np.arange(1 << 12)
        self.low, self.high = low.astype(np.uint16), self._remainder(high << 11).astype(np.uint16)
        one = 1 << np.arange(23)
        errors = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]), *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])]
        errors = np.array(errors, np.uint32)
        self.error = np.zeros(1 << 11, np.uint32)
        self.error[self._remainder(errors.astype(np.int64))] = errors

    @staticmethod
    def _remainder(word: np.ndarray) -> np.ndarray:
        word = word.copy()
        for bit in range(22, 10, -1):
            word ^= np.where(word >> bit & 1, _GENERATOR << (bit - 11), 0)
        return word

    def index(self, word: np.ndarray) -> np.ndarray:
        syndrome = self.high[word >> np.uint32(11)] ^ self.low[word & np.uint32(0x7FF)]
        return (word ^ self.error[syndrome]) >> np.uint32(11)

    def keys(self, word: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(n, width + 1) indices of a word and its neighbours, sorted, and which are first of their value."""
        near = np.empty((len(word), width + 1), np.uint32)
        near[:, 0] = self.index(word)
        for bit in range(width):
            near[:, bit + 1] = self.index(word ^ np.uint32(1 << bit))
        near.sort(axis=1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        return near, new


_golay: list[Golay] = []


def bucket_keys(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, position in f) of fingerprints f."""
    if not _golay:
        _golay.append(Golay())
    code = _golay[0]
    exact = [((f >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32) for at, width in SEGMENTS]
    own = [code.index(x) for x in exact]
    near = [code.keys(x, width) for x, (_, width) in zip(exact, SEGMENTS, strict=True)]
    keys, places = [], []
    for a in range(3):
        for b in range(3):
            if a == b:
                continue
            at, col = np.nonzero(near[b][1])
            index = near[b][0][at, col].astype(np.int64)
            keys.append(np.int64(a * 3 + b) << 40 | exact[a][at].astype(np.int64) << 12 | index)
            low, high = min(a, b), max(a, b)
            pair = own[a][at].astype(np.int64) << 12 | index if a < b else index << 12 | own[a][at].astype(np.int64)
            keys.append(np.int64(9 + low * 3 + high) << 40 | pair)
            places += [at, at]
    return np.concatenate(keys), np.concatenate(places)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fingerprint) of each key of fingerprints."""
    for batch in batches:
        f = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for i in range(0, len(f), 1 << 13):
            part = f[i : i + (1 << 13)]
            keys, at = bucket_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], ["k", "f"])


# --- buckets


def links(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that connect what pairs of distinct f within RADIUS connect: a spanning forest."""
    alone = np.arange(len(f))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(alone) > 1:
        front, alone = alone[:1], alone[1:]
        while len(front) and len(alone):
            step = front[: max(1, (1 << 22) // len(alone))]
            front = front[len(step) :]
            near = np.bitwise_count(f[step][:, None] ^ f[alone][None, :]) <= RADIUS
            hit = near.any(axis=0)
            if hit.any():
                left.append(step[near[:, hit].argmax(axis=0)])
                right.append(alone[hit])
                front = np.concatenate([front, alone[hit]])
                alone = alone[~hit]
    return np.concatenate(left), np.concatenate(right)


def _search(block: int):
    """Reads rows (key, fingerprint) in their order; makes links (0, fingerprint, fingerprint) and, of buckets over block, (block + 1, key, fingerprint)."""

    def told(left: np.ndarray, right: np.ndarray, out: list, z: int = 0) -> None:
        out.append((np.full(len(left), z), left.view(np.int64), right.view(np.int64)))

    def finish(key: int, values: np.ndarray, out: list) -> None:
        values = values[np.concatenate([[True], values[1:] != values[:-1]])]
        if len(values) < 2:
            return
        for k, at in enumerate(range(0, len(values), block)):
            part = values[at : at + block]
            a, b = links(part)
            told(part[a], part[b], out)
            if len(values) > block:
                told(np.full(len(part), key, np.int64), part, out, k + 1)

    def batch_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)], ["z", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, values = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            values = values.view(np.uint64)
            edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            out: list = []
            if held_key is not None and key[0] != held_key:
                finish(held_key, np.concatenate(held), out)
                held_key, held = None, []
            sizes = np.diff(edge)
            inner = np.ones(len(sizes), bool)
            inner[[0, -1]] = False
            two = edge[:-1][inner & (sizes == 2)]  # most buckets hold one or two
            a, b = values[two], values[two + 1]
            near = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
            told(a[near], b[near], out)
            for r in np.flatnonzero((sizes > 2) | ~inner):
                part = values[edge[r] : edge[r + 1]]
                if r == len(sizes) - 1:
                    held = [*held, part] if held_key == key[-1] else [part]
                    held_key = key[-1]
                elif r == 0 and held_key is not None:
                    finish(held_key, np.concatenate([*held, part]), out)
                    held_key, held = None, []
                else:
                    finish(int(key[edge[r]]), part, out)
            yield batch_of(out)
        out = []
        if held_key is not None:
            finish(held_key, np.concatenate(held), out)
        if out:
            yield batch_of(out)

    return run


def fingerprint_links(distinct: DataFrame, *, block: int = 1 << 15) -> DataFrame:
    """Links (a, b) among distinct fingerprints f; they connect all that pairs within RADIUS connect.

    A fingerprint becomes about sixty rows, so the few that a small input has are dealt to all tasks first.
    """
    parts = max(distinct.sparkSession.sparkContext.defaultParallelism, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = distinct.repartition(parts).mapInArrow(_deal, "k long, f long")
    found = checkpointed(keyed.repartition("k").sortWithinPartitions("k", "f").mapInArrow(_search(block), "z long, a long, b long"))
    edges, wide = found.where("z = 0").select("a", "b"), found.where("z > 0").select(F.col("a").alias("k"), F.col("b").alias("f"), "z")
    if wide.agg(F.max("z")).first()[0]:
        # two blocks have a task's key of their own; links within each are made already
        spread = wide.join(wide.groupBy("k").agg(F.max("z").alias("m")), "k").withColumn("o", F.explode(F.sequence(F.lit(1).cast("long"), "m"))).where("o <> z")
        pair = spread.select(F.xxhash64("k", F.least("z", "o"), F.greatest("z", "o")).alias("k"), "f")
        more = pair.repartition("k").sortWithinPartitions("k", "f").mapInArrow(_search(2 * block), "z long, a long, b long")
        edges = edges.union(more.where("z = 0").select("a", "b"))
    return edges


def near_groups(docs: DataFrame, *, shingle: int = 4, block: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id, group_size, kept (the rows of the component's id)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = checkpointed(docs.select(F.col(id_col).cast("long").alias("i"), text.alias("t")).mapInArrow(_fingerprint(shingle), "i long, f long"))
    distinct = own.groupBy("f").agg(F.min("i").alias("low"), F.count(F.lit(1)).alias("n"))
    roots = components(fingerprint_links(distinct.select("f"), block=block))
    rooted = distinct.join(roots, F.col("f") == F.col("node"), "left").select("f", "low", "n", F.coalesce("root", "f").alias("root"))
    totals = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("group_size"))
    # the key is written anew so that both sides are shuffled for the join, which AQE needs to split a large group
    totals = totals.select(F.bitwise_not("root").alias("nr"), "component_id", "group_size")
    named = rooted.withColumn("nr", F.bitwise_not("root")).join(totals, "nr").select("f", "component_id", "group_size")
    out = own.join(named, "f")
    return out.select(F.col("i").alias(id_col), F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id", "group_size", F.col("i").eqNullSafe(F.col("component_id")).alias("kept"))


# --- near copies by similarity

#: Ids that are broadcast at most; more are joined by a shuffle.
FEW_IDS = 1_000_000


def _sets(texts: list[bytes], shingle: int, limit: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """The set of shingle hashes of each text, one after the other, and len + 1 offsets."""
    sets = [np.unique(np.concatenate([np.array(_hashes(part, shingle), np.uint64) for part in _parts(text, shingle, limit)])) for text in texts]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.concatenate([[0], np.cumsum([len(x) for x in sets], dtype=np.int64)])


#: Candidates share all ROWS least values of at least one of BANDS bands: pairs at J do by 1 - (1 - J^ROWS)^BANDS, 0.99997 at 0.8.
BANDS, ROWS = 20, 4
_FACTORS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_FIRST, _SECOND = np.uint64(0xA5A5F00DBEEF1234), np.uint64(0x3C79AC492BA7B653)


def band_keys(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(n, BANDS) keys of sets, none empty, one after the other between the offsets at: equal where the least values under ROWS orders are."""
    keys = np.empty((len(at) - 1, BANDS), np.uint64)
    for band in range(BANDS if len(at) > 1 else 0):
        key = np.full(len(at) - 1, np.uint64(band))
        for row in range(ROWS):
            key = mix64(key ^ np.minimum.reduceat(values * _FACTORS[band * ROWS + row], at[:-1]))
        keys[:, band] = key
    return keys


def _sketches(shingle: int):
    """Of each text its id, four-word fingerprint, two hashes of its set of shingles (d, e) and the set's band keys, none if it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at, 1 << 20):
                texts = [raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)]
                values, ends = _sets(texts, shingle)
                some = np.diff(ends) > 0
                own = np.append(ends[:-1][some], ends[-1])
                both = np.zeros((2, j - i), np.uint64)
                if some.any():
                    both[:, some] = [np.add.reduceat(mix64(values ^ c), own[:-1]) for c in (_FIRST, _SECOND)]
                bands = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32), pa.array(band_keys(values, own).ravel().view(np.int64)))
                numbers = [pa.array(x.view(np.int64)) for x in (fingerprints(texts, 4), *both)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *numbers, bands], ["i", "f", "d", "e", "m"])

    return run


def _shingle_sets(shingle: int):
    """Sets of shingles in place of the texts in the second column; the other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = column_bytes(batch.column(1))
            for i, j in chunks(at, 1 << 20):
                values, ends = _sets([raw[at[k] : at[k + 1]].tobytes() for k in range(i, j)], shingle)
                sets = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(values.view(np.int64)))
                others = [c.slice(i, j - i) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([others[0], sets, *others[2:]], [batch.schema.names[0], "s", *batch.schema.names[2:]])

    return run


def few(ids: DataFrame) -> DataFrame:
    """ids, marked for broadcast if they are counted to be few."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def _least_ids(own: DataFrame, fingerprints: list[str]) -> tuple[DataFrame, DataFrame]:
    """The smallest id of each combination of fingerprints, and links (a, b) from it to the other ids of the combination, beside the fingerprints."""
    least = own.groupBy(*fingerprints).agg(F.min("i").alias("low"))
    anew = [F.bitwise_not(F.col(c)).alias(f"n{c}") for c in fingerprints]  # shuffled for the join on both sides, so that AQE can split a group
    within = own.select("i", *anew).join(least.select("low", *anew), [f"n{c}" for c in fingerprints]).where("i <> low")
    return least, within.select(F.col("low").alias("a"), F.col("i").alias("b"), *[F.bitwise_not(f"n{c}").alias(c) for c in fingerprints])


def similar_links(values: np.ndarray, at: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that connect what pairs of sets with a Jaccard similarity of `similarity` or more connect: a spanning forest.

    The sets are values between the offsets at. What a set reaches is taken out, and all others are
    compared with each set reached, by counts over an index of the sets not yet taken.
    """
    size, n = np.diff(at), len(at) - 1
    code = np.unique(values, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    owner, coded = np.repeat(np.arange(n), size)[order], code[order]
    codes = int(coded[-1]) + 1 if len(coded) else 0
    alone, rest, indexed = np.ones(n, bool), n, n
    many = np.bincount(coded, minlength=codes)
    first = np.cumsum(many) - many
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for seed in range(n):
        if not alone[seed]:
            continue
        front, alone[seed], rest = [seed], False, rest - 1
        while front and rest:
            if rest < indexed // 2:
                keep = alone[owner]
                owner, coded, indexed = owner[keep], coded[keep], rest
                many = np.bincount(coded, minlength=codes)
                first = np.cumsum(many) - many
            k = front.pop()
            own = code[at[k] : at[k + 1]]
            shared = np.bincount(owner[ragged(first[own], many[own])], minlength=n)
            union = size[k] + size - shared
            hit = np.flatnonzero(alone & ((union == 0) | (shared >= union * similarity)))
            left.append(np.full(len(hit), k))
            right.append(hit)
            alone[hit], rest = False, rest - len(hit)
            front += hit.tolist()
    return np.concatenate(left), np.concatenate(right)


def _similar(similarity: float):
    """Reads rows (group, id, set) in order of groups; makes links (a, b) of ids. With a fourth column, only pairs of which one is marked are tried."""

    def finish(parts: list) -> pa.RecordBatch:
        ids, sizes, values, *marks = (np.concatenate(x) for x in zip(*parts, strict=True))
        at = np.concatenate([[0], np.cumsum(sizes)])
        a, b = marked_links(values, at, marks[0], similarity) if marks else similar_links(values, at, similarity)
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, ids = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            marks = [batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in range(3, batch.num_columns)]
            at = batch.column(2).offsets.to_numpy().astype(np.int64)
            values = batch.column(2).values.to_numpy(zero_copy_only=False).view(np.uint64)
            edge = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if held and key[s] != held_key:
                    yield finish(held)
                    held = []
                held_key = key[s]
                held.append((ids[s:e], np.diff(at[s : e + 1]), values[at[s] : at[e]], *(m[s:e] for m in marks)))
        if held:
            yield finish(held)

    return run


#: Rarity of shingles is told by so many counts, whatever the input: shingles that share one look more frequent than they are.
CELL_BITS = 18


def _cells(values: np.ndarray) -> np.ndarray:
    return (mix64(values ^ _SECOND) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """i, k and x of sets (i, s): the rarest shingles k of each, x of them marked, so that of two similar sets the smaller has a marked one that the larger has too.

    Sets of a <= b shingles with a similarity of t share at least 2 t / (1 + t) a of them, and t b. So in any
    order of all shingles, the first that they share is among the first a - 2 t / (1 + t) a + 1 of the smaller, which are marked,
    and the first b - t b + 1 of the larger. In order of rarity, pages of one template that are not similar have no
    such shingle: what they share comes last. Any order finds all pairs, so a table of counts of a fixed size will do. Shingles that
    nobody marks, or only one set has, are left out.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            total += np.bincount(_cells(batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["c", "n"])

    seen, table = sets.select("s").mapInArrow(counted, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).toArrow(), np.zeros(1 << CELL_BITS, np.int64)
    table[seen["c"].to_numpy()] = seen["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(table)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                values, lists = part.column(1).flatten().to_numpy(zero_copy_only=False).view(np.uint64), part.column(1)
                size = np.array([len(x) for x in lists], np.int64)
                owner, begin = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
                order = np.lexsort((values, counts[_cells(values)], owner))
                least = lambda share: size - np.ceil(size * share - 1e-9).astype(np.int64) + 1  # noqa: B023, E731
                taken, marked = np.minimum(size, least(similarity)), least(2 * similarity / (1 + similarity))
                at = np.arange(int(taken.sum())) - np.repeat(np.cumsum(taken) - taken, taken)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, taken)), pa.array(values[order[ragged(begin, taken)]].view(np.int64)), pa.array(at < np.repeat(marked, taken))], ["i", "k", "x"])

    prefix = checkpointed(sets.select("i", "s").mapInArrow(cut, "i long, k long, x boolean"))
    used = prefix.groupBy("k").agg(F.count_if("x").alias("marks"), F.count(F.lit(1)).alias("n")).where("marks > 0 and n > 1").select(F.bitwise_not("k").alias("nk"), "marks", "n")
    # the key is written anew so that both sides are shuffled for the join, which AQE needs to split a key
    return prefix.select("i", F.bitwise_not("k").alias("nk"), "x").join(used, "nk").withColumnRenamed("nk", "k")


def marked_links(values: np.ndarray, at: np.ndarray, marked: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that connect what similar pairs of a marked set and any other connect."""
    size, n = np.diff(at), len(at) - 1
    code = np.unique(values, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    owner = np.repeat(np.arange(n), size)[order]
    many = np.bincount(code) if len(code) else np.zeros(0, np.int64)
    first, group = np.cumsum(many) - many, np.arange(n)
    left, right = [], []
    for k in np.flatnonzero(marked).tolist():
        own = code[at[k] : at[k + 1]]
        shared = np.bincount(owner[ragged(first[own], many[own])], minlength=n)
        hit = np.flatnonzero((shared >= (size[k] + size - shared) * similarity) & (group != group[k]))
        if len(hit):
            joined, one = np.unique(group[hit], return_index=True)
            left += [k] * len(one)
            right += hit[one].tolist()
            group[np.isin(group, joined)] = group[k]
    return np.array(left, np.int64), np.array(right, np.int64)


def _tried_by_prefix(texts: DataFrame, ids: DataFrame, shingle: int, similarity: float, members: int) -> DataFrame:
    """Links (a, b) that connect what similar pairs among the ids connect: pairs that share a rare shingle which one of them marks.

    A shingle's marked sets and all its sets are dealt in blocks of about `members`; each pair of blocks is one task's.
    """
    sets = checkpointed(texts.join(few(ids.select("i").distinct()), "i").mapInArrow(_shingle_sets(shingle), "i long, s array<long>"))
    tried = _prefixes(sets, similarity)
    blocks = lambda n: F.ceil(F.col(n) / members)
    zero = F.lit(0).cast("long")
    dealt = tried.select("i", "k", "x", blocks("marks").alias("u"), blocks("n").alias("m"))
    row, column = F.pmod(F.xxhash64("i"), "u"), F.pmod(F.xxhash64("i"), "m")
    marks = dealt.where("x").select("i", "k", row.alias("r"), F.explode(F.sequence(zero, F.col("m") - 1)).alias("c"), F.lit(True).alias("x"))
    others = dealt.select("i", "k", F.explode(F.sequence(zero, F.col("u") - 1)).alias("r"), column.alias("c"), F.lit(False).alias("x"))
    placed = marks.unionByName(others).groupBy("i", F.xxhash64("k", "r", "c").alias("g")).agg(F.max("x").alias("x"))
    by_id = placed.groupBy("i").agg(F.collect_list(F.struct("g", "x")).alias("gs"))
    rows = sets.join(by_id, "i").select("i", "s", F.explode("gs").alias("v")).select("v.g", "i", "s", "v.x")
    return checkpointed(rows.repartition("g").sortWithinPartitions("g").mapInArrow(_similar(similarity), "a long, b long"))


def _similar_within(texts: DataFrame, keyed: DataFrame, shingle: int, similarity: float, members: int) -> DataFrame:
    """Links (a, b) that connect what similar pairs connect among the ids i of each key k.

    All pairs of a key are tried on their whole sets; keys of the same ids are one. Keys of over twice
    `members` ids are dealt in blocks of about that many, each with the key's smallest id. Where that
    leaves a key's ids in several groups, its ids are tried by the rarest shingles of their sets (see _prefixes).
    """
    hashed = F.xxhash64("i")
    sums = [F.min("i").alias("low"), F.bit_xor(hashed).alias("x"), F.sum(hashed.bitwiseAND((1 << 31) - 1)).alias("y"), F.count(F.lit(1)).alias("n")]
    keys = keyed.groupBy("k").agg(*sums).where("n > 1").groupBy("low", "x", "y", "n").agg(F.min("k").alias("k"))
    # the key is written anew so that both sides are shuffled for the join, which AQE needs to split a key
    anew = keys.select(F.bitwise_not("k").alias("nk"), "low", F.ceil(F.col("n") / members).alias("m"))
    named = checkpointed(keyed.select("i", F.bitwise_not("k").alias("nk")).join(anew, "nk").select("i", F.col("nk").alias("k"), "m", (F.col("i") == F.col("low")).alias("c")))

    wide, blocks = F.col("m") > 2, F.sequence(F.lit(0).cast("long"), F.col("m") - 1)
    by_id = named.groupBy("i").agg(F.collect_list(F.struct("k", "m", "c")).alias("ks"))
    sets = texts.join(few(named.select("i").distinct()), "i").mapInArrow(_shingle_sets(shingle), "i long, s array<long>")
    each = sets.join(by_id, "i").select("i", "s", F.explode("ks").alias("v")).select("i", "s", "v.*")
    placed = each.withColumn("z", F.when(wide, F.pmod(F.xxhash64("i"), "m")).otherwise(0)).withColumn("o", F.explode(F.when(wide & F.col("c"), blocks).otherwise(F.array("z"))))
    dealt = placed.select(F.xxhash64("k", "o").alias("g"), "i", "s")
    found = checkpointed(dealt.repartition("g").sortWithinPartitions("g").mapInArrow(_similar(similarity), "a long, b long"))
    large = named.where(wide)
    if large.isEmpty():
        return found
    grouped = large.join(components(found), F.col("i") == F.col("node"), "left").withColumn("root", F.coalesce("root", "i"))
    apart = grouped.groupBy("k").agg(F.min("root").alias("r"), F.max("root").alias("q")).where("r < q").select(F.bitwise_not("k").alias("nk"))
    rest = checkpointed(large.withColumn("nk", F.bitwise_not("k")).join(apart, "nk", "left_semi").drop("nk"))
    if rest.isEmpty():
        return found
    return found.union(_tried_by_prefix(texts, rest, shingle, similarity, members))


#: Rows that repeat an id with another text are nodes of their own, numbered from here up.
OWN_NODES = 1 << 62


def _nodes(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """texts (i, t) as nodes (i, t), and (node, id, hash of the text) of those whose id other texts have too; None if there are none."""
    if texts.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return texts, None
    hashed = texts.withColumn("v", F.xxhash64("t"))
    several = hashed.groupBy("i").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low < high").select(F.col("i").alias("j"), "low")
    versions = hashed.join(several, F.col("i") == F.col("j")).groupBy("i", "v").agg(F.first("low").alias("low"))
    if texts.agg(F.max("i")).first()[0] >= OWN_NODES:
        raise ValueError("ids of 2**62 and more, where ids repeat with different texts")
    named = checkpointed(versions.withColumn("node", F.when(F.col("v") == F.col("low"), F.col("i")).otherwise(F.monotonically_increasing_id() + OWN_NODES)).drop("low"))
    if named.isEmpty():
        return texts, None
    return hashed.join(named, ["i", "v"], "left").select(F.coalesce("node", "i").alias("i"), "t"), named


def near_copies(docs: DataFrame, *, similarity: float = 0.8, shingle: int = 5, block: int = 1 << 15, members: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct id and text: id, text_hash, component_id, kept (one row a group).

    text_hash is the text's xxhash64 where its id has several texts, else null. Links are those of
    near_groups, and all candidates that are similar.

    Candidates come from the sets of shingles of `shingle` words themselves: the least values of a set
    under random orders agree with those of another as often as the two are similar, and are dealt in
    bands (see BANDS), so that a similar pair is found with a known probability whatever else its texts
    hold; how many a document has does not depend on the number of documents that are not similar to it.
    Equal sets are one. All pairs of texts that share a band's key are tried: they link if their sets
    have a Jaccard similarity of `similarity` or more, computed exactly.

    The smallest id of a group stays; of an id with several texts, the one with the least hash counts as
    that id and the others come behind all ids; ids of 2**62 and more are refused then (ValueError). Null ids are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts, named = _nodes(docs.select(F.col(id_col).cast("long").alias("i"), text.alias("t")).where("i is not null"))
    own = checkpointed(texts.mapInArrow(_sketches(shingle), "i long, f long, d long, e long, m array<long>"))

    least, within = _least_ids(own, ["f"])
    across = fingerprint_links(least.select("f"), block=block).join(least.select(F.col("f").alias("a"), F.col("low").alias("x")), "a").join(least.select(F.col("f").alias("b"), F.col("low").alias("y")), "b")
    sure = within.select("a", "b").union(across.select("x", "y"))

    copies = checkpointed(_least_ids(own, ["d", "e"])[1])
    first = own.join(few(copies.select(F.col("b").alias("i"))), "i", "left_anti")
    alike = _similar_within(texts, first.select("i", F.explode("m").alias("k")), shingle, similarity, members)
    roots = components(sure.union(copies.select("a", "b")).union(alike))
    out = own.select("i").distinct().join(roots, F.col("i") == F.col("node"), "left").select("i", F.coalesce("root", "i").alias("component_id"))
    kept = (F.col("i") == F.col("component_id")).alias("kept")
    if named is None:
        return out.select(F.col("i").alias(id_col), F.lit(None).cast("long").alias("text_hash"), "component_id", kept)
    told = out.join(named.select(F.col("node").alias("i"), F.col("i").alias("own"), "v"), "i", "left")
    whose = named.select(F.col("node").alias("component_id"), F.col("i").alias("whose"))
    told = told.join(whose, "component_id", "left")
    return told.select(F.coalesce("own", "i").alias(id_col), F.col("v").alias("text_hash"), F.coalesce("whose", "component_id").alias("component_id"), kept)
