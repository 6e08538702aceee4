"""Many stored queries at once against compile_query one by one."""

import random

import pytest
from pyspark.sql import functions as F

from fernlight.operators import search

WORDS = ["buy", "sell", "nifty", "#nifty50", "@desk", "100%", "a.b", "तेजी", "c++", "'s", "%", "straße", "x\\Ey"]


def random_query(rng, depth=0):
    parts = []
    for _ in range(rng.randrange(1, 4)):
        kind = rng.random()
        if kind < 0.2 and depth < 2:
            parts.append(f"({random_query(rng, depth + 1)})")
        elif kind < 0.4:
            parts.append(f'"{rng.choice(WORDS)} {rng.choice(WORDS)}"')
        elif kind < 0.5:
            parts.append("-" + rng.choice(WORDS))
        elif kind < 0.55:
            parts.append(rng.choice(["-filter:retweets", "since:2024-01-02"]))
        else:
            parts.append(rng.choice(WORDS).upper() if rng.random() < 0.2 else rng.choice(WORDS))
        if rng.random() < 0.3:
            parts.append("OR")
    return " ".join(parts[:-1] if parts[-1] == "OR" else parts)


@pytest.mark.parametrize("with_time", [True, False])
def test_as_one_by_one(spark, with_time):
    rng = random.Random(7)
    queries = [random_query(rng) for _ in range(120)] + ["(buy", "OR", None, "", "-buy", 'buy ""']
    texts = [None, "", *(rng.choice(["", "x "]) + rng.choice([" ", "  ", "\t"]).join(rng.choices([*WORDS, "Buy", "buyers", "nifty50", "desk"], k=rng.randrange(1, 7))) + rng.choice(["", "!", "y"]) for _ in range(80))]
    posts = spark.createDataFrame([(k, t, f"2024-01-0{1 + k % 3}T00:00:00") for k, t in enumerate(texts)], "n long, text string, at string").withColumn("at", F.col("at").cast("timestamp"))
    stored = search.stored_queries(spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")).cache()
    told = {r.query_id: r for r in stored.collect()}
    assert told[120].error and told[121].error and told[124]["keys"] is None and told[124].error is None
    got = {(r.n, r.query_id) for r in search.match_many(posts, stored, id_col="n", text_col="text", timestamp_col="at" if with_time else None).collect()}
    low = F.lower("text")
    keyed = [k for k in range(len(queries)) if told[k]["keys"] is not None]
    plain = lambda q: q if with_time else q.replace("since:2024-01-02", "-filter:x")
    one = posts.select("n", *[search.compile_query(plain(queries[k]), low, F.col("at")).alias(f"q{k}") for k in keyed]).collect()
    assert got == {(r.n, k) for r in one for k in keyed if r[f"q{k}"]}
    assert len(keyed) > 80 and len(got) > 300


def test_keys():
    keys = lambda q: search._keys(search._tree(q))
    assert keys("a bcd -e") == {"bcd"} and keys("a OR b ccc") == {"a", "ccc"} and keys("(a OR b) since:2024-01-01") == {"a", "b"}
    assert keys("a OR -b") is None and keys("-a") is None and keys("(a OR b) ccc") == {"ccc"}


def test_no_posts_and_no_queries(spark):
    posts = spark.createDataFrame([(1, "buy")], "n long, text string")
    stored = search.stored_queries(spark.createDataFrame([(1, "buy")], "query_id int, query string"))
    go = lambda p, s: search.match_many(p, s, id_col="n", text_col="text").collect()
    assert [tuple(r) for r in go(posts, stored)] == [(1, 1)] and go(posts.where("false"), stored) == [] == go(posts, stored.where("false"))


def test_groups_of_posts_and_queries_and_no_regex_for_pairs(spark, monkeypatch):
    """Pairs of words are found by the index, not tried in the texts; small groups give what one group gives."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(12)]
    texts = [(i, rng.choice([" ", ", ", "\n ", "-"]).join(rng.choices(words, k=rng.randrange(1, 14)))) for i in range(120)]
    queries = [(k, '"{} {}" OR ({} {} -{})'.format(*rng.choices(words, k=5))) for k in range(60)]
    posts = spark.createDataFrame(texts, "n long, text string")
    stored = search.stored_queries(spark.createDataFrame(queries, "query_id int, query string")).cache()
    want = {(r.n, k) for r in posts.select("n", *[search.compile_query(q, F.lower("text")).alias(f"q{k}") for k, q in queries]).collect() for k, _ in queries if r[f"q{k}"]}
    for size in ({}, {"group_posts": 7, "group_queries": 5}):
        got = search.match_many(posts, stored, id_col="n", text_col="text", **size)
        assert "RLIKE(t#" not in got._jdf.queryExecution().optimizedPlan().toString()
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(set(rows)) > 500 and set(rows) == want
