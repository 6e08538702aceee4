"""Very many terms at once against plain search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernlight.functions import features as X
from fernlight.functions.lexicon import BEARISH, BULLISH, RISK
from fernlight.operators import terms


def plain(words, texts):
    return sorted((i, k) for i, t in enumerate(texts) for k, w in enumerate(words) if w in t)


@pytest.mark.parametrize("seed", range(6))
def test_found_terms(seed, monkeypatch):
    monkeypatch.setattr(terms, "PIECE", 16)
    rng = random.Random(seed)
    make = lambda n: bytes(rng.choices(b"ab" if seed % 2 else bytes(range(256)), k=n))
    words = sorted({make(rng.randrange(1, 9)) for _ in range(rng.choice([1, 5, 60]))})
    texts = [b"", *(make(rng.randrange(300)) + b"".join(rng.choices(words, k=3)) for _ in range(40))]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, term = terms.found_in(terms.build(words), np.frombuffer(b"".join(texts), np.uint8), at)
    assert sorted(zip(text.tolist(), term.tolist())) == plain(words, texts)


def test_a_hundred_thousand_terms():
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdefghij", k=rng.randrange(3, 12))).encode() for _ in range(100_000)})
    texts = ["".join(rng.choices("abcdefghij ", k=3000)).encode() for _ in range(20)]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, term = terms.found_in(terms.build(words), np.frombuffer(b"".join(texts), np.uint8), at)
    short = {t[k : k + n] for t in texts[:3] for n in range(3, 12) for k in range(len(t))}
    assert sorted(zip(text.tolist(), term.tolist()))[: sum(1 for i in text.tolist() if i < 3)] == plain_few(words, texts[:3]) and len(short) > 1000


def plain_few(words, texts):
    place = {w: k for k, w in enumerate(words)}
    return sorted({(i, place[t[k : k + n]]) for i, t in enumerate(texts) for n in range(3, 12) for k in range(len(t)) if t[k : k + n] in place})


def test_lists_are_those_of_hits(spark):
    rng = random.Random(3)
    pieces = [*BULLISH, *BEARISH, *RISK, " ", "x", "é", "bull", "sure "]
    rows = [(k, None if k == 0 else "".join(rng.choices(pieces, k=rng.randrange(9))), "c") for k in range(200)]
    texts = spark.createDataFrame([*rows, (7, "buy " * 5000, "c")], "n int, low string, l string")
    lexicon = [(name, t, 1) for name, own in (("bull", BULLISH), ("bear", BEARISH), ("risk", RISK)) for t in own] + [("any", "", 3), ("any", None, 5), ("bull", "zz", None), (None, "buy", 1)]
    got = terms.term_hits(texts, spark.createDataFrame(lexicon, "list string, term string, weight long"), text_col="low")
    want = texts.select("*", *[F.when(F.col("low").isNull(), 0).otherwise(x).cast("long").alias(n) for n, x in (("any", F.lit(3)), ("bear", X.hits(F.col("low"), BEARISH)), ("bull", X.hits(F.col("low"), BULLISH)), ("risk", X.hits(F.col("low"), RISK)))])
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert terms.term_hits(texts, spark.createDataFrame([], "list string, term string, weight long"), text_col="low").columns == texts.columns
    assert terms.term_hits(texts.where("false"), spark.createDataFrame(lexicon, "list string, term string, weight long"), text_col="low").count() == 0


def test_limits(spark, monkeypatch):
    texts = spark.createDataFrame([("a",)], "low string")
    own = spark.createDataFrame([("low", "a", 1)], "list string, term string, weight long")
    with pytest.raises(ValueError):
        terms.term_hits(texts, own, text_col="low")
    monkeypatch.setattr(terms, "MOST_BYTES", 0)
    with pytest.raises(ValueError):
        terms.term_hits(texts, own.withColumn("list", F.lit("x")), text_col="low")
