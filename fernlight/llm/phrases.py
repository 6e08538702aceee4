"""Phrase collocations of each language, mined by pivot partitioning as in MG-FSM.

* Frequencies. A first scan counts words by a hash of language and word in a table of 2^18 cells, whatever
  the input, which the driver hands to all tasks. A cell's count is never less than that of a word in
  it, so words in cells below the least frequency are left out rightly; words that share a cell
  only look more frequent than they are, which moves work and changes no count.
* Pivots. The pivot of a run of words is its rarest word by (cell count, hash), the leftmost among
  equals: a function of the run alone. A second scan rewrites each text, for every word that may be frequent,
  to the fragment around it that holds the runs it is the pivot of: up to `longest` - 1 words on each
  side, as far as these are less rare. Equal fragments of a block are counted, and fragments are routed
  to the partition of their language and pivot, packed to one row for each block, partition and quarter of it.
* Mining. A partition reads the fragments of one quarter at a time and adds up, in Arrow's
  hash aggregation over the phrases themselves, the runs that cover the pivot. No other partition counts
  those runs, so runs below the least frequency end there.
* Hot pivots. A word whose cell holds more than a quarter of a partition's even share is dealt to several
  partitions by a hash of the fragment; equal fragments still meet. Its partial counts are added by one
  small aggregate that all frequent runs pass. The more frequent a word is, the fewer words are more
  frequent still, so its fragments are short and mostly equal.

Counts of all runs up to `longest` words come from the same mining, single words included, and the parts
of a frequent run are frequent. Candidates are joined to the counts of their parts; scores are whole numbers
from products in decimals of 38 digits.

Cases: null texts are empty, a null language is `und`. Words of any length and texts of any length
are taken whole. An empty table gives no rows. Languages share nothing; a language without candidates has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed, chunks, column_bytes, mix64, ragged, run_hashes, span_hashes

CELL_BITS = 18
QUARTERS = 4
BLOCK_BYTES = 4 << 20
LEAST_SHARE = 1 << 15

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_ENDS_PIECE
_IS_WORD[[0x20, 0x09]] = False


def _words(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, the number of each one's piece, and the first word of each text. edges: offsets of the texts from 0."""
    word = np.concatenate([[False], _IS_WORD[raw], [False]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[edges] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
    piece = np.cumsum(_ENDS_PIECE[raw] | cut[:-1]) if len(raw) else np.zeros(0, np.int64)
    return starts, ends, piece[starts], np.searchsorted(starts, edges)


def _language_hashes(languages: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in languages], np.uint64)


class _Block:
    """The words of some texts: spans in folded bytes, pieces, languages and hashes."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, codes: np.ndarray, language: np.ndarray):
        self.raw = _FOLD[raw[at[0] : at[-1]]]
        self.starts, self.ends, self.piece, first = _words(self.raw, at - at[0])
        self.code = np.repeat(codes, np.diff(first))
        self.one = span_hashes(self.raw, self.starts, self.ends)
        self.key = mix64(self.one ^ language[self.code])
        self.cell = (self.key >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, _Block]]:
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        languages, codes = names.dictionary.to_pylist(), names.indices.to_numpy()
        raw, at = column_bytes(batch.column(1))
        hashes = _language_hashes(languages)
        for i, j in chunks(at, BLOCK_BYTES):
            yield languages, hashes, _Block(raw, at[i : j + 1], codes[i:j], hashes)


def _count_words(rows: DataFrame) -> DataFrame:
    """lang, b and n: words of each language (b is null) and of each cell (lang is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, totals = np.zeros(1 << CELL_BITS, np.int64), {}
        for languages, _, block in _blocks(batches):
            cells += np.bincount(block.cell, minlength=len(cells))
            for name, n in zip(languages, np.bincount(block.code, minlength=len(languages)).tolist(), strict=True):
                totals[name] = totals.get(name, 0) + n
        some = np.flatnonzero(cells)
        names = pa.array([*totals, *[None] * len(some)], pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array([*[None] * len(totals), *some.tolist()], pa.int32()), pa.array([*totals.values(), *cells[some].tolist()], pa.int64())], ["lang", "b", "n"])

    return rows.mapInArrow(run, "lang string, b int, n long").groupBy("lang", "b").agg(F.sum("n").alias("n"))


def _reach(key: np.ndarray, tie: np.ndarray, piece: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words in a row before (step -1) or behind (1) each word are less rare; to the right, equals count too."""
    n = len(key)
    out, going = np.zeros(n, np.int64), np.ones(n, bool)
    for d in range(1, most + 1):
        here, there = (np.arange(d, n), np.arange(n - d)) if step < 0 else (np.arange(n - d), np.arange(d, n))
        less = (key[there] > key[here]) | (key[there] == key[here]) & ((tie[there] > tie[here]) if step < 0 else (tie[there] >= tie[here]))
        fits = np.zeros(n, bool)
        fits[here] = less & (piece[there] == piece[here])
        going &= fits
        out += going
    return out


def _first_of(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of one row of each distinct (one, two), and how often each occurs."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(order) else np.zeros(0, np.int64)
    return order[edge], np.diff(np.append(edge, len(order)))


def _fragments(rows: DataFrame, cells: np.ndarray, total: int, parts: int, least: int, longest: int) -> DataFrame:
    """p, q, lang, hot, payload: packed fragments of the pivots of partition p, quarter q."""
    share = max(LEAST_SHARE, total // (4 * parts))
    shared = rows.sparkSession.sparkContext.broadcast(cells)  # 2^18 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for languages, hashes, block in _blocks(batches):
            count = cells[block.cell]
            left = _reach(count, block.key, block.piece, -1, longest - 1)
            right = _reach(count, block.key, block.piece, 1, longest - 1)
            pivot = np.flatnonzero(count >= least)
            if not len(pivot):
                continue
            # words one after the other, each followed by one blank: a fragment is a slice
            size = block.ends - block.starts
            begin = np.cumsum(size + 1) - (size + 1)
            flat = np.full(int(begin[-1] + size[-1] + 1), 0x20, np.uint8)
            flat[ragged(begin, size)] = block.raw[ragged(block.starts, size)]
            low, high, place = pivot - left[pivot], pivot + right[pivot] + 1, left[pivot].astype(np.uint64)
            salt = hashes[block.code[pivot]] + place
            second = span_hashes(block.raw, block.starts, block.ends, second=True)
            one = mix64(run_hashes(block.one, low, high) ^ salt)
            pick, n = _first_of(one, run_hashes(second, low, high) ^ salt)
            low, high, place, pivot, one = low[pick], high[pick], place[pick].astype(np.uint8), pivot[pick], one[pick]
            split = -(-count[pivot] // share)
            route = mix64(block.key[pivot] + one % np.maximum(split, 1).astype(np.uint64))
            route %= np.uint64(parts * QUARTERS)
            code, hot = block.code[pivot], split > 1
            order = np.lexsort((hot, code, route))
            route, code, hot, low, high, place, n = (x[order] for x in (route, code, hot, low, high, place, n))
            new = np.flatnonzero(np.concatenate([[True], (route[1:] != route[:-1]) | (code[1:] != code[:-1]) | (hot[1:] != hot[:-1])]))
            start, length = begin[low], begin[high - 1] + size[high - 1] - begin[low]
            text = flat[ragged(start, length)]
            cut = np.concatenate([[0], np.cumsum(length)])
            payloads = [_pack(place[a:b], n[a:b], length[a:b], text[cut[a] : cut[b]]) for a, b in zip(new, np.append(new[1:], len(route)), strict=True)]
            r = route[new].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(r // QUARTERS), pa.array(r % QUARTERS), pa.array([languages[c] for c in code[new]], pa.string()), pa.array(hot[new]), pa.array(payloads, pa.binary())], ["p", "q", "lang", "hot", "payload"])

    return rows.mapInArrow(run, "p int, q int, lang string, hot boolean, payload binary")


def _pack(place: np.ndarray, n: np.ndarray, length: np.ndarray, text: np.ndarray) -> bytes:
    return b"".join([np.uint32(len(place)).tobytes(), place.tobytes(), n.astype("<u4").tobytes(), length.astype("<u4").tobytes(), text.tobytes()])


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    m = int(np.frombuffer(payload, "<u4", 1)[0])
    return np.frombuffer(payload, np.uint8, m, 4), np.frombuffer(payload, "<u4", m, 4 + m), np.frombuffer(payload, "<u4", m, 4 + 5 * m), np.frombuffer(payload, np.uint8, -1, 4 + 9 * m)


def _runs(payloads: list[bytes], longest: int) -> pa.Table:
    """phrase and n of every run that covers its fragment's pivot, not yet added up."""
    place, n, length, text = (np.concatenate(x) for x in zip(*map(_unpack, payloads), strict=True))
    place, length = place.astype(np.int64), length.astype(np.int64)
    edge = np.cumsum(length)
    first = np.zeros(len(text), bool)
    first[edge - length] = True
    begins = np.flatnonzero(first | np.concatenate([[False], text[:-1] == 0x20]))
    last = np.zeros(len(text) + 1, bool)
    last[edge] = True
    finish = np.flatnonzero(last[1:] | np.concatenate([text[1:] == 0x20, [True]])) + 1
    at = np.searchsorted(begins, edge - length)
    words = np.diff(np.append(at, len(begins)))
    starts, sizes, counts = [], [], []
    for before in range(longest):
        for size in range(before + 1, longest + 1):
            k = np.flatnonzero((place >= before) & (place - before + size <= words))
            a = at[k] + place[k] - before
            starts.append(begins[a])
            sizes.append(finish[a + size - 1] - begins[a])
            counts.append(n[k])
    start, size = np.concatenate(starts), np.concatenate(sizes)
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = text[ragged(start, size)]
    phrase = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.table({"phrase": phrase, "n": np.concatenate(counts).astype(np.int64)})


def _add_up(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("phrase", use_threads=False).aggregate([("n", "sum")]).rename_columns(["phrase", "n"])


def _mine(fragments: DataFrame, parts: int, least: int, longest: int) -> DataFrame:
    """lang, phrase, n: runs of each quarter of a partition; those of unsplit pivots only if they are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, waiting, held, sums = None, [], 0, []

        def drain() -> None:
            nonlocal waiting, held, sums
            if waiting:
                sums = [_add_up([*sums, _runs(waiting, longest)])]
            waiting, held = [], 0

        def result() -> Iterator[pa.RecordBatch]:
            nonlocal sums
            drain()
            if sums:
                out = sums[0] if here[3] else sums[0].filter(pa.compute.greater_equal(sums[0]["n"], least))
                for part in out.to_batches(max_chunksize=50_000):
                    yield pa.RecordBatch.from_arrays([pa.array([here[2]] * part.num_rows, pa.string()), part.column(0).cast(pa.large_string()).cast(pa.string()), part.column(1)], ["lang", "phrase", "n"])
            sums = []

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True))
            for k, key in enumerate(keys):
                if key != here:
                    yield from result()
                    here = key
                waiting.append(batch.column(4)[k].as_py())
                held += len(waiting[-1])
                if held > BLOCK_BYTES:
                    drain()
        yield from result()

    own = fragments.repartitionById(parts, "p").sortWithinPartitions("p", "q", "lang", "hot")
    return own.mapInArrow(run, "lang string, phrase string, n long")


def frequent_runs(docs: DataFrame, *, least: int = 10, longest: int = 3, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """lang, phrase, f of all runs of up to `longest` words that occur `least` times within pieces; and lang, n: all words of each language. Both are checkpointed."""
    if longest < 1 or longest > 200:
        raise ValueError("longest must be 1 to 200")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("t"))
    counted = checkpointed(_count_words(rows))
    totals = counted.where("b is null").select("lang", "n")
    seen, cells = counted.where("b is not null").select("b", "n").toArrow(), np.zeros(1 << CELL_BITS, np.int64)
    cells[seen["b"].to_numpy()] = seen["n"].to_numpy()
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    mined = _mine(_fragments(rows, cells, int(cells.sum()), parts, least, longest), parts, least, longest)
    return checkpointed(mined.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)), totals


def _cuts(phrase: Column) -> Column:
    words = F.split(phrase, " ", -1)
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"), F.array_join(F.slice(words, k + 1, F.size(words)), " ").alias("right")))


def _inner(phrase: Column) -> Column:
    """All runs of two words or more inside the phrase, itself left out."""
    words = F.split(phrase, " ", -1)
    n = F.size(words)
    by_size = lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.array_join(F.slice(words, at, size), " "))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), n - 1), by_size)))


def scored(runs: DataFrame, *, percent: int = 50) -> DataFrame:
    """lang, phrase, a, l, r, score of candidates, by their lowest cut; those that a longer one mostly holds are left out."""
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    many = F.size(F.split("phrase", " ", -1))
    candidates = runs.where(F.instr("phrase", " ") > 0).withColumnRenamed("f", "a")
    cut = candidates.select("lang", "phrase", "a", F.explode(_cuts(F.col("phrase"))).alias("c")).select("lang", "phrase", "a", "c.*")
    part = runs.select(F.col("lang").alias("g"), F.col("phrase").alias("part"), "f")
    cut = cut.join(part.withColumnRenamed("f", "l"), (F.col("lang") == F.col("g")) & (F.col("left") == F.col("part"))).drop("g", "part")
    cut = cut.join(part.withColumnRenamed("f", "r"), (F.col("lang") == F.col("g")) & (F.col("right") == F.col("part"))).drop("g", "part")
    cut = cut.withColumns({"above": F.lit(1_000_000).cast("decimal(38,0)") * exact("a") * exact("a"), "below": exact("l") * exact("r")}).withColumn("score", F.expr("above div below"))
    best = cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    longer = candidates.where(many > 2).select("lang", F.explode(_inner(F.col("phrase"))).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = best.join(longer, ["lang", "phrase"], "left").where("most is null or 100 * most < " + str(int(percent)) + " * a")
    return kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def top(rows: DataFrame, totals: DataFrame, limit: int) -> DataFrame:
    """Each language's first rows, best scores first. A language is ranked in 32 parts first, so that one which holds all rows is not sorted by one task."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = rows.withColumn("s", F.pmod(F.xxhash64("phrase"), F.lit(32))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "s").orderBy(*order))).where(F.col("rank") <= limit).drop("s", "rank")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, least: int = 10, longest: int = 3, percent: int = 50, limit: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's strongest phrases of two to `longest` words."""
    runs, totals = frequent_runs(docs, least=least, longest=longest, text_col=text_col, lang_col=lang_col)
    return top(scored(runs, percent=percent), totals, limit)


def collocations_sql(*, least: int = 10, percent: int = 50, limit: int = 2000) -> str:
    """The same for phrases of two and three words."""
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 4) AS r(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM o GROUP BY ALL HAVING count(*) >= {least}),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM c),
y AS (SELECT x.lang, x.phrase, x.a, x.k, u.f AS l, v.f AS r, (1000000::HUGEINT * x.a * x.a // (u.f::HUGEINT * v.f))::BIGINT AS score
  FROM x JOIN f u ON u.lang = x.lang AND u.phrase = array_to_string(x.w[1:x.k], ' ') JOIN f v ON v.lang = x.lang AND v.phrase = array_to_string(x.w[x.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM y),
i AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE size = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE size = 3) GROUP BY ALL),
g AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE o = 1 AND (most IS NULL OR 100 * most < {percent} * a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM g)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN t USING (lang) WHERE rank <= {limit}
"""
