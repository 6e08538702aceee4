"""Golden cases of text, number and feature functions."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fernlight.functions import features as X
from fernlight.functions import text as T
from fernlight.functions.numbers import compact_count
from fernlight.operators import sampling, search, signals, vectors
from fernlight.settings import DEFAULT_QUERIES, Settings, parse_queries
from fernlight.sources import synthetic


def one(spark, column, **values):
    types = {str: "string", int: "long", float: "double", type(None): "string", list: "array<string>", datetime: "timestamp"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "want"), [("1,234 Likes", 1234), ("2.5K", 2500), ("1.2M views", 1200000), (None, 0), ("", 0), ("none", 0), ("2.01K", 2009), ("5 mentions", 5000000), ("1.2.3", None), (",", None), ("3 K", 3000)])
def test_compact_count(spark, value, want):
    assert one(spark, compact_count(F.col("v")), v=value) == want


@pytest.mark.parametrize(("value", "want"), [("  बाजार​  में तेजी 🚀  ", "बाजार में तेजी 🚀"), ("a\rb", "ab"), ("a\u0085b", "ab"), ("a\tb\nc", "a b c"), ("ﬁ １２", "fi 12"), ("﻿ ‍", "")])
def test_normalize(spark, value, want):
    assert one(spark, T.normalize_text("v"), v=value) == want


def test_for_analysis(spark):
    assert one(spark, T.for_analysis("v"), v="See HTTPS://x.test/a?b NOW") == "see <url> now"


@pytest.mark.parametrize(("value", "want"), [("نيفتي", "unknown"), ("निफ्टी", "hi_or_indic"), ("nifty तेजी", "hinglish_or_mixed"), ("İ", "en_or_romanized"), ("été 5", "en_or_romanized"), ("é 5", "unknown")])
def test_language(spark, value, want):
    assert one(spark, T.language_hint("v"), v=value) == want


def test_tags(spark):
    assert one(spark, T.mentions("v"), v="@Bob mail@x.test @a_very_long_handle_indeed ;@bob") == ["a_very_long_han", "bob"]
    assert one(spark, T.hashtags("v"), v="#NIFTY50 x#no #तेजी ##two") == ["nifty50", "two", "तेजी"]
    assert one(spark, T.clean_tags("v", "#"), v=["#B", "##a", "b "]) == ["a", "b"]
    assert one(spark, T.clean_username("v"), v="@@Trader ") == "trader"


def test_fingerprints(spark):
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, T.fingerprint(F.lit("123"), F.lit("u"), F.col("t"), F.lit("x")), t=at) == "d75975a6b3cb22a5712b4379e5ae3f92ff6c58d3b75c838e7ed101e030e7d8c8"
    a = one(spark, T.fingerprint(F.lit(""), F.lit("U"), F.col("t"), F.lit("x")), t=at)
    assert a == one(spark, T.fingerprint(F.lit(None).cast("string"), F.lit("u"), F.col("t"), F.lit("x")), t=at.replace(second=59))


FEATURES = [
    ("#NIFTY50 breakout above support, looking bullish with target 24500", 5, 0, 1, 0), ("Bank Nifty में तेजी, buyers are strong today #banknifty", 4, 0, 1, 0),
    ("#NIFTY50 breakdown below support, bearish pressure increasing", 1, 2, -1 / 3, 0), ("Bank Nifty में गिरावट, sell on rise setup #banknifty", 0, 3, -1, 0),
    ("#intraday short setup; avoid aggressive buying in this volatility", 1, 1, 0, 0), ("SURE SHOT multibagger guaranteed double money #intraday", 0, 0, 0, 1),
    ("Operator stock upper circuit fixed target 100% #sensex", 1, 0, 1, 1), ("not buy", 0, 1, -1, 0), ("not buy not buy", 0, 2, -1, 0), ("not buy not buy never sell", 1, 2, -1 / 3, 0),
    ("not bullish", 1, 1, 0, 0), ("no breakout", 0, 1, -1, 0), ("not a buy", 1, 0, 1, 0), ("underperform outperform", 1, 1, 0, 0), ("expired", 0, 1, -1, 0), ("", 0, 0, 0, 0), (None, 0, 0, 0, 0),
]


def test_features(spark):
    df = spark.createDataFrame([(k, None if t is None else t.lower()) for k, (t, *_) in enumerate(FEATURES)], "k int, t string")
    for r in X.with_features(df, "t").collect():
        _, b, s, polarity, risk = FEATURES[r.k]
        assert (r.bullish_hits, r.bearish_hits) == (b, s) and r.polarity == pytest.approx(polarity) and r.manipulation_risk == pytest.approx(risk) and r.uppercase_ratio == 0


def test_capitals_raise_risk(spark):
    r = X.with_features(spark.createDataFrame([("BUY NOW!! ok",)], "t string"), "t").first()
    assert r.uppercase_ratio == pytest.approx(0.75) and r.manipulation_risk == pytest.approx(0.3) and r.exclamation_count == 2


def test_weights(spark):
    at = datetime(2024, 1, 2)
    df = spark.createDataFrame([(1.0, 0.0, at, 10, 100), (1.0, 0.5, datetime(2023, 1, 1), 10, 100), (-1.0, 0.0, at, 10**9, 10**9), (1.0, 0.0, datetime(2024, 1, 1, 4), None, -5)], "polarity double, manipulation_risk double, timestamp timestamp, engagement_total long, view_count long")
    a, b, c, d = X.with_signal(df, F.lit(at)).collect()
    assert a.weight == pytest.approx(1.896747, abs=1e-6) and a.signal == 1
    assert b.weight == 0.05 and b.signal == pytest.approx(0.675) and c.weight == 3 and d.weight == pytest.approx(2.718281828 ** (-20 / 12))


@pytest.mark.parametrize(("tags", "query", "want"), [(["SENSEX", "BankNifty"], "x", "banknifty"), (None, None, "other"), ([], "Intraday", "intraday"), (["nifty50"], "(#sensex OR x)", "nifty50")])
def test_market(spark, tags, query, want):
    df = spark.createDataFrame([(tags, query)], "t array<string>, q string")
    assert df.select(X.market(F.col("t"), F.col("q")).alias("x")).first().x == want


def test_windows(spark):
    at = datetime(2024, 1, 2, 10, 50, 3)
    assert [one(spark, X.iso(X.window_start(F.col("t"), n)), t=at)[11:16] for n in (45, 15, 7, 90)] == ["10:45", "10:45", "10:49", "10:00"]
    with pytest.raises(ValueError):
        X.window_start(F.col("t"), 0)


@pytest.mark.parametrize(("n", "kept"), [(1199, 1199), (1200, 600), (1, 1)])
def test_stride(spark, n, kept):
    df = spark.range(n).select(F.lit("m").alias("market"), F.col("id").alias("window_start"))
    assert sampling.stride_sample(df).count() == kept


def test_murmur3_is_the_public_one(spark):
    """Published values of the 32-bit x86 variant, seed 0."""
    import numpy as np

    known = {"": 0, "hello": 0x248BFA47, "hello, world": 0x149BBB7F, "The quick brown fox jumps over the lazy dog": 0x2E4FF723}
    raw = [k.encode() for k in known]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    assert (vectors.murmur3(np.frombuffer(b"".join(raw), np.uint8), at).astype(np.int64) & 0xFFFFFFFF).tolist() == list(known.values())
    df = spark.createDataFrame([("1", "aa bb aa", 5), ("2", "", 5), ("3", None, 5)], "tweet_id string, normalized_content string, bucket int")
    got = vectors.murmur3_features(df, features=1 << 30).collect()
    assert {r.tweet_id for r in got} == {"1"} and sorted(r.weight for r in got) == [0.377964, 0.377964, 0.377964, 0.755929]
    md5 = vectors.hashed_ngrams(df, features=1 << 30).collect()
    assert sorted(r.weight for r in md5) == sorted(r.weight for r in got) and vectors.murmur3_features(df.limit(0)).count() == 0


def test_ngrams_and_vectors(spark):
    assert one(spark, T.word_ngrams("v"), v="बाजार में तेजी nifty 5 #buy") == ["nifty", "buy", "nifty buy"]
    assert one(spark, T.word_ngrams("v"), v="") == [] and one(spark, T.word_ngrams("v"), v="one") == ["one"]
    df = spark.createDataFrame([("1", "aa bb aa"), ("2", ""), ("3", None)], "tweet_id string, normalized_content string")
    got = {r.tweet_id: r.vector for r in vectors.hashed_vectors(df, features=256).collect()}
    assert got["1"].norm(2) == pytest.approx(1) and got["2"].numNonzeros() == got["3"].numNonzeros() == 0
    assert vectors.vector_metadata(vectors.hashed_vectors(df), 256).first().asDict() == {"rows": 3, "batches": 1, "features": 256}


@pytest.mark.parametrize(("query", "text", "want"), [
    ("(#nifty OR x) buy", "buy #nifty now", True), ("(#nifty OR x) buy", "buy #nifty50 now", False), ('"bank nifty"', "the bank  nifty", True), ("nse OR bse", "bses", False),
    ("a b OR c", "c", True), ("a -b", "a b", False), ("तेजी", "में तेजी!", True), ('"M&M" since:2024-01-02 -filter:retweets', "m&m", True),
])
def test_search(spark, query, text, want):
    df = spark.createDataFrame([(text, datetime(2024, 1, 3))], "t string, at timestamp")
    assert df.where(search.compile_query(query, F.col("t"), F.col("at"))).count() == want


@pytest.mark.parametrize("query", ["(a", "a)", "a OR", "()"])
def test_search_errors(spark, query):
    with pytest.raises(ValueError):
        search.compile_query(query, F.col("t"))


def test_query_file():
    assert parse_queries('# comment\n\n#nifty50\n("Bank Nifty" OR #banknifty)\n #nifty50 \n') == ("#nifty50", '("Bank Nifty" OR #banknifty)')
    assert parse_queries("# only\n") == DEFAULT_QUERIES


def test_settings(tmp_path):
    (tmp_path / "q").write_text("#a\n")
    s = Settings.from_env({"FERNLIGHT_WINDOW_MINUTES": "30", "FERNLIGHT_EXCLUDE_REPOSTS": "no", "FERNLIGHT_QUERIES_FILE": str(tmp_path / "q")})
    assert (s.window_minutes, s.exclude_reposts, s.queries) == (30, False, ("#a",))
    for bad in ({"FERNLIGHT_WINDOW_MINUTES": "x"}, {"FERNLIGHT_WINDOW_MINUTES": "0"}, {"FERNLIGHT_RAW_CANDIDATE_MULTIPLIER": "0.5"}):
        with pytest.raises(ValueError):
            Settings.from_env(bad)


def test_invariants_of_a_run(spark):
    """Posts, windows and language counts add up to the same number."""
    as_of = F.lit(datetime(2024, 1, 2))
    posts = synthetic.clean_sample(spark, 120, 7, as_of)
    from fernlight.plans.runs import score

    rows = signals.signals(score(posts, as_of)).cache()
    one_row = signals.summary(rows, signals.language_counts(posts)).first()
    assert one_row.tweet_count == sum(r.tweet_count for r in rows.collect()) == sum(one_row.language_counts.values()) == 120
    for r in rows.collect():
        assert -1 <= r.ci95_lower <= r.composite_signal <= r.ci95_upper <= 1 and 0 <= r.confidence <= 1 and r.bullish_count + r.bearish_count + r.neutral_count == r.tweet_count
        if r.tweet_count == 1:
            assert r.confidence == 0.56125
    empty = signals.summary(rows.limit(0), signals.language_counts(posts.limit(0))).first()
    assert empty.tweet_count == 0 and empty.status == "no_data" and empty.overall_signal is None and empty.language_counts == {}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["not", "no", "buy", "sell", "rally", "weak", "x", "never"]), max_size=8))
def test_fold_is_the_plain_one(spark, words):
    from fernlight.functions.lexicon import BEARISH, BULLISH, NEGATIONS

    text = " ".join(words)
    b, s = (sum(t in text for t in terms) for terms in (BULLISH, BEARISH))
    for x, y in zip(words, words[1:]):
        if x in NEGATIONS and y in BULLISH:
            b, s = max(0, b - 1), s + 1
        elif x in NEGATIONS and y in BEARISH:
            b, s = b + 1, max(0, s - 1)
    r = X.with_features(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert (r.bullish_hits, r.bearish_hits) == (b, s)
