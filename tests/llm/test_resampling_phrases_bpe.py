"""Importance resampling, phrases and byte-pair encoding against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fernlight.llm import bpe, importance, phrases
from fernlight.llm.common import chunks, column_bytes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, i long, n int, p string, b int, at string"


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, g, 1, 2, "p", 3, "x") for i, t, g in rows], SCHEMA).repartition(parts)


def prose(seed, n=200):
    rng = random.Random(seed)
    vocabulary = ["Of", "the", "é", "Straße", "x9", "日本", *(f"w{k}" for k in range(40)), "long" * 30]
    weights = [30, 30, 5, 5, 5, 5, *([3] * 20), *([1] * 20), 1]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weights, k=rng.choice([0, 1, 2, 30, 90]))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "-", "; "]) for w in words)
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return [*rows, (n, None, "en"), (n + 1, "", "en"), (n + 2, " ,.\n", None), (3, rows[3][1], "en"), (3, "of the of the of the", "en"), (None, rows[5][1], "xx"), (None, rows[5][1], "xx"), (n + 3, "the " * 5000, "de"), (n + 4, "A" * 20000, "de")]


# --- importance resampling


def features(text, longest=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def plain_resample(rows, target, buckets=10_000, longest=2, percent=25, min_words=20, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    corpus, aim = Counter(), Counter()
    for _, t, _ in rows:
        corpus.update(map(bucket, features(t, longest)[1]))
    for t in target:
        aim.update(map(bucket, features(t, longest)[1]))
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))
    out = []
    for i, t, _ in rows:
        n, own = features(t, longest)
        weight = sum(map(gain, map(bucket, own))) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("options", [{}, {"buckets": 7, "longest": 3, "percent": 60, "min_words": 1}, {"longest": 1, "percent": 100, "seed": 8}])
def test_resampling(spark, options):
    rows = prose(1)
    target = [t for _, t, _ in prose(2, 20)]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame(spark, rows), aim, **options)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_resample(rows, target, **options)


def test_resampling_of_nothing(spark):
    none = frame(spark, [(1, "x", "en")]).where("false")
    some = frame(spark, [(1, "a b " * 20, "en"), (2, None, "en")])
    assert importance.resample(none, some).count() == 0
    assert sorted(tuple(r) for r in importance.resample(some, none).select("doc_id", "n_features", "rank").collect()) == [(1, 79, None), (2, 0, None)]
    for bad in ({"buckets": 0}, {"buckets": 1 << 17}, {"longest": 0}):
        with pytest.raises(ValueError):
            importance.resample(some, some, **bad)


def test_drawn_documents_are_whole(spark):
    rows = [(k, f"w{k} " * 30, "en") for k in range(40)]
    drawn = importance.drawn_documents(frame(spark, rows), frame(spark, rows[:5]), percent=50).collect()
    want = {i for i, *_, rank in plain_resample(rows, [t for _, t, _ in rows[:5]], percent=50) if rank}
    assert {r.doc_id for r in drawn} == want and len(drawn) == 20 and all(r.text == f"w{r.doc_id} " * 30 and r.p == "p" for r in drawn)


def test_crcs_of_runs():
    rng = random.Random(4)
    words = ["".join(rng.choices("ab0é", k=rng.choice([1, 2, 3, 64, 65, 66, 200]))).encode() for _ in range(300)]
    raw = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    ends = np.cumsum(size)
    one = importance.word_crcs(raw, ends - size, ends)
    assert one.tolist() == [zlib.crc32(w) for w in words]
    two = importance.joined_crcs(one[:-1], one[1:], raw, (ends - size)[1:], ends[1:])
    assert two.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:])]
    stream = np.array([5, 1, 5, 5, 0], np.uint16)
    assert [x.tolist() for x in importance.run_lengths(stream)] == [[0, 1, 5], [1, 1, 3]] and importance.run_lengths(stream[:0])[1].tolist() == []


# --- phrases


def plain_phrases(rows, least, longest=3, percent=50, limit=2000):
    counts, total = {}, Counter()
    for _, t, g in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[g or "und"] += len(words)
            own = counts.setdefault(g or "und", Counter())
            for n in range(1, longest + 1):
                own.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for g, f in counts.items():
        held, rows_of = Counter(), []
        for w, a in f.items():
            if a >= least and len(w) > 2:
                for n in range(2, len(w)):
                    for k in range(len(w) - n + 1):
                        held[w[k : k + n]] = max(held[w[k : k + n]], a)
        for w, a in f.items():
            if a >= least and len(w) > 1 and not (held[w] and 100 * held[w] >= percent * a):
                score, _, l, r = min((1_000_000 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
                rows_of.append((" ".join(w), a, l, r, total[g], score))
        rows_of.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(g, k + 1, *x) for k, x in enumerate(rows_of[:limit])]
    return sorted(out)


@pytest.mark.parametrize("options", [{"least": 10}, {"least": 2, "longest": 3, "limit": 7}, {"least": 3, "longest": 4, "percent": 80}, {"least": 1, "longest": 2}])
@pytest.mark.parametrize("share", [phrases.LEAST_SHARE, 5])
def test_phrases(spark, monkeypatch, options, share):
    """share 5: nearly all pivots are split."""
    monkeypatch.setattr(phrases, "LEAST_SHARE", share)
    rows = prose(3)
    got = phrases.collocations(frame(spark, rows), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, **options)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [(1, "a b", "en")]).where("false")).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, "en"), (2, "a b", None)])).count() == 0
    with pytest.raises(ValueError):
        phrases.frequent_runs(frame(spark, []), longest=0)


def test_scores_beyond_64_bits(spark):
    n = 3_000_000_000_000
    runs = spark.createDataFrame([("en", "a", n + 1), ("en", "b", n + 7), ("en", "a b", n)], "lang string, phrase string, f long")
    assert [tuple(r) for r in phrases.scored(runs).collect()] == [("en", "a b", n, n + 1, n + 7, 1_000_000 * n * n // ((n + 1) * (n + 7)))]


def test_a_run_has_one_owner():
    """Every window is covered by the fragment of one pivot, whatever the ties."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = 40
        key, tie = rng.integers(0, 4, n), rng.integers(0, 3, n).astype(np.uint64)
        piece = np.sort(rng.integers(0, 4, n))
        left, right = phrases._reach(key, tie, piece, -1, 2), phrases._reach(key, tie, piece, 1, 2)
        for size in (1, 2, 3):
            for s in range(n - size + 1):
                if piece[s] == piece[s + size - 1]:
                    owners = [i for i in range(s, s + size) if i - left[i] <= s and s + size <= i + right[i] + 1]
                    least = min(range(s, s + size), key=lambda i: (key[i], tie[i], i))
                    assert owners == [least]


# --- byte-pair encoding


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.DEFAULT_MODEL)


def ids_of(v, texts, store=None, limit=2 << 20):
    store = store or bpe.Store()
    raw, at = column_bytes(pa.array(texts, pa.string()))
    out = []
    for i, j in chunks(at, limit):
        ids, counts = bpe.encode_texts(v, raw, at[i : j + 1], store)
        edge = np.concatenate([[0], np.cumsum(counts)])
        out += [ids[a:b].tolist() for a, b in zip(edge[:-1], edge[1:])]
    return out


EDGES = [None, "", " ", "\n\n", "a", "it's", "'s's 're're'", "''s", "don't'll've", "<|endoftext|>x <|startoftext|><|endoftext|> a<|b <| end", "é", "ÀÉ×÷ß", "ΑΣ ς", "é x́", "a b c", "1234 a1b2", "x" * 500, "日本語" * 300, "ab" * 3000 + "'s " + "é" * 700, "\0 \0é\0", "ﬁ ² ٣"]


def test_ids_are_those_of_the_library(library):
    v, rng = bpe.read_vocabulary(bpe.DEFAULT_MODEL), random.Random(6)
    ascii_ = [chr(c) for c in range(128)]
    mixed = [*"abcdeést'rlmdv ,.1\n", "<|endoftext|>", "́", "ß", "İ", "Σ", "中", "​", " ", "ﬁ", "한", "ᄀ", "ᅡ", "𝔸", "²", "\u0085", "🙂", "É", "À"]
    wide = [chr(rng.randrange(0x80, 0x3000)) for _ in range(2000)] + list(" ab") * 200
    texts = [*EDGES, *("".join(rng.choices(a, k=rng.randrange(900))) for a in (ascii_, mixed, wide) for _ in range(250))]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert ids_of(v, texts) == want
    assert ids_of(v, texts, limit=1) == want


def test_chunks_are_shared_and_the_store_is_bounded(library):
    v, rng = bpe.read_vocabulary(bpe.DEFAULT_MODEL), random.Random(7)
    passage = "".join(rng.choices("abcdefgh  ,.'", k=5000))
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(200))) + passage + "tail" * rng.randrange(9) for _ in range(40)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    store = bpe.Store()
    assert ids_of(v, texts, store, limit=20_000) == want
    assert store.met > 0.8 * store.asked
    small = bpe.Store(limit=100)
    assert ids_of(v, texts, small, limit=20_000) == want and small.held < 20_000


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 4000, "é" * 3000, "x y" * 2000, ""])
def test_cuts_lie_apart_and_on_characters(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    cuts = bpe.cut_places(raw, np.array([0, len(raw)]))
    assert cuts[0] == 0 and cuts[-1] == len(raw) and (len(cuts) < 3 or np.diff(cuts)[:-1].min() >= bpe.GAP)
    assert all((raw[c] & 0xC0) != 0x80 for c in cuts[:-1] if c < len(raw))


def test_long_words_merge_as_short_ones():
    v, rng = bpe.read_vocabulary(bpe.DEFAULT_MODEL), random.Random(8)
    for _ in range(100):
        word = np.frombuffer("".join(rng.choices("theinaro", k=rng.randrange(2, 64))).encode(), np.uint8)
        ids, _ = bpe.merge_words(v, word, np.array([0]), np.array([len(word)]))
        assert ids.tolist() == bpe._merge_long(v, [*v.inner[word[:-1]].tolist(), int(v.last[word[-1]])])


def test_operator_and_digests(spark, library):
    rows = [(k, t, "en") for k, t in enumerate(EDGES)] + [(3, "again", "en"), (None, "no id", "en"), (None, "no id", "en")]
    docs = frame(spark, rows)
    coded = bpe.encode(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted((tuple(r) for r in coded.collect()), key=str) == sorted(((i, x, len(x)) for i, x, _ in want), key=str)
    back = bpe.decode(coded.withColumn("ids", F.when(F.col("n_tokens") > 0, F.col("ids"))))
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(((i, t) for i, _, t in want), key=str)
    digests = sorted((tuple(r) for r in bpe.encoded_digests(docs).collect()), key=str)
    assert digests == sorted(((i, len(x), sha(" ".join(map(str, x))), sha(t)) for i, x, t in want), key=str)
    assert bpe.encode(docs.where("false")).count() == 0


def test_query_is_the_library(spark, library):
    entry = pytest.importorskip("__spark_entry__")
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in entry.queries()["op13_bpe"](spark, sf).collect()) == sorted(want)


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.read_vocabulary("/opt/tokenizers/byte_bpe_50k.json")
