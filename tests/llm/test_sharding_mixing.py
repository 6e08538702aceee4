"""Sharding against a walk of single documents, mixing against its targets."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fernlight.llm import mixing, sharding


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, source string, lang string, point int, shard string, rank int")




@pytest.mark.parametrize(("n", "shards"), [(0, 24), (1, 24), (23, 24), (500, 24), (501, 7)])
def test_rows_law(spark, n, shards):
    rows = [(k, None if k % 50 == 0 else "é" * (k % 17), "s", "en") for k in range(n)]
    got = sharding.assign_shards(docs(spark, rows), shards=shards, vnodes=16).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    counts = np.bincount([r.shard for r in got], minlength=shards)
    assert counts.max() - counts.min() <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    for r in got:
        raw = (rows[r.doc_id][1] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    if n == 500:
        assert sum(r.moved for r in got) < 0.35 * n


def test_overflow_goes_to_the_next_shard_with_room():
    owners = np.array([0, 1, 2, 0, 1, 2])
    counts = np.array([9, 0, 1, 0, 2, 0])  # 12 documents, room for 4 each
    runs = sharding.walk(counts, owners, 3)
    assert sorted(runs) == [(0, 0, 4, 0, 0), (0, 4, 6, 1, 2), (0, 6, 9, 2, 1), (2, 0, 1, 2, 0), (4, 0, 2, 1, 0)]


def test_assignment_is_that_of_a_walk_of_single_documents(spark):
    """Documents one by one in ring order, in plain Python: home while it has room, the rest clockwise behind."""
    shards, vnodes = 6, 8
    rows = [(k, f"text {k % 13}", "s", "en") for k in range(700)] + [(None, f"n{k}", "s", "en") for k in range(250)]
    frame = docs(spark, rows)
    order = frame.select("doc_id", "text", sharding.place(F.col("doc_id")).alias("at"), F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary")), F.octet_length("text").cast("long") + 8).alias("h")).collect()
    points = sorted((int(a), int(o)) for a, o in zip(*sharding.ring(shards, vnodes)))
    point_of = lambda at: next((k for k, (a, _) in enumerate(points) if a >= at), 0)
    at_point = np.bincount([point_of(r["at"]) for r in order], minlength=len(points))
    classes = [-(-int(n) * len(points) // len(order)) if n > sharding.HOT * len(order) / len(points) else 1 for n in at_point]
    assert sum(c > 1 for c in classes) == 1 and sum(classes) <= 2 * len(points)  # the rows without an id
    lined = sorted((point_of(r["at"]), r.h % classes[point_of(r["at"])], r["at"], -1 if r.doc_id is None else r.doc_id, zlib.crc32(r.text.encode()), len(r.text) + 8) for r in order)
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    want, over = {}, []
    for doc in lined:  # each takes a place at home while there is room
        home = points[doc[0]][1]
        if room[home]:
            room[home] -= 1
            want[doc] = home
        else:
            over.append(doc)
    for step in range(2 * len(points)):  # once around and once more: who passes a shard with room takes it, first come first served
        shard = points[step % len(points)][1]
        waiting = [d for d in over if d not in want and (d[0] < step)]
        for doc in waiting[: room[shard]]:
            want[doc] = shard
            room[shard] -= 1
    got = {}
    for r in sharding.assign_shards(frame, shards=shards, vnodes=vnodes).collect():
        got.setdefault((r.doc_id, r.text_crc32), r.shard)
    assert {(None if d[3] < 0 else d[3], d[4]): s for d, s in want.items()} == got


def test_one_more_shard_moves_few(spark):
    rows = [(k, "t", "s", "en") for k in range(6000)]
    a, b = ({r.doc_id: r.shard for r in sharding.assign_shards(docs(spark, rows), shards=n).select("doc_id", "shard").collect()} for n in (24, 25))
    assert sum(a[k] != b[k] for k in a) < 0.15 * len(a)


def test_assignment_repeats_whatever_the_partitions(spark):
    rows = [(k // 2 if k < 20 else k, f"t{k}", "s", "en") for k in range(300)] + [(None, "a", "s", "en")] * 40
    a = sharding.assign_shards(docs(spark, rows).repartition(5), shards=5).select("doc_id", "text_crc32", "shard", "slot").collect()
    b = sharding.assign_shards(docs(spark, rows).coalesce(1), shards=5).select("doc_id", "text_crc32", "shard", "slot").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def corpus():
    rows = []
    for k in range(4000):
        source = "hot" if k % 10 < 4 else f"s{k % 7}"
        rows.append((k, "word " * (1 + k * 7 % 180), None if k % 97 == 0 else source, ["en", "de", None][k // 10 % 3]))
    return [*rows, (4000, None, "empty", "en"), (4001, "", "empty", "en"), (4002, "a | b | c | d |", "s1", "en"), (5, "word again", "s1", "en")]


def cells_of(spark, rows):
    cells = docs(spark, rows).select(F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"), F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("topic"), mixing.tokens(F.coalesce("text", F.lit(""))).alias("n"))
    return cells.groupBy("source", "lang", "topic").agg(F.sum("n").alias("n")).coalesce(1)


def test_probabilities_meet_all_margins(spark):
    """Of p, the bounded probabilities: the raked targets without a bound would ask for more than 1."""
    cells = cells_of(spark, corpus())
    raked = mixing.rake(cells, {"source": 0.5, "lang": {"en": 0.5, "de": 0.3, "": 0.2}, "topic": 1.0}, 0.4)
    out = mixing.margins(raked).toPandas()
    assert raked.toPandas().p.between(0, 1).all() and np.allclose(out.expected, out.target, atol=1e-9)
    by = {(r.margin, r.value): r for r in out.itertuples()}
    assert [round(by["lang", x].target / 0.4, 9) for x in ("en", "de", "")] == [0.5, 0.3, 0.2]
    goal = {x: r.present**0.5 for (m, x), r in by.items() if m == "source" and r.present > 0}
    open_ = {x for x in goal if by["source", x].target < by["source", x].present - 1e-12}
    ratio = {by["source", x].target / goal[x] for x in open_}
    assert len(open_) > 1 and max(ratio) - min(ratio) < 1e-9


def test_a_value_gives_no_more_than_it_has(spark):
    rows = [(k, "word " * 10, "rare" if k % 20 == 0 else "hot", "en") for k in range(1000)]
    out = {r.value: r for r in mixing.margins(mixing.rake(cells_of(spark, rows), {"source": {"rare": 0.5, "hot": 0.5}, "lang": 1.0, "topic": 1.0}, 0.4)).collect() if r.margin == "source"}
    assert out["rare"].target == pytest.approx(0.05) and out["hot"].target == pytest.approx(0.35)
    assert out["rare"].expected == pytest.approx(0.05) and out["hot"].expected == pytest.approx(0.35)
    told = mixing.mixture(docs(spark, rows), targets={"source": {"rare": 0.5, "hot": 0.5}, "lang": 1.0, "topic": 1.0}, fraction=0.4).first()
    assert told.residual < 1e-9 and told.off_goal == pytest.approx(0.5 - 0.05 / 0.4)  # the goal is out of reach, and that is told


def test_targets_that_contradict_leave_a_residual(spark):
    rows = [(2 * k, "word " * 10, f"s{k % 2}", ["en", "de"][k % 2]) for k in range(100)]  # a source is a language
    told = mixing.mixture(docs(spark, rows), targets={"source": {"s0": 0.8, "s1": 0.2}, "lang": {"en": 0.2, "de": 0.8}}, fraction=0.5, rounds=5).select("residual").distinct().collect()
    assert len(told) == 1 and told[0].residual > 0.1
    assert mixing.mixture(docs(spark, rows), targets={"source": {"s0": 1.0, "s1": 0.0}}, fraction=0.5).agg(F.min("p")).first()[0] == mixing.LEAST
    assert mixing.mixture(docs(spark, rows), fraction=0.5).first().residual < 1e-9
    assert all(r.p == 1 and r.kept for r in mixing.mixture(docs(spark, rows), fraction=1.0).collect())


def test_sample_follows_the_rates(spark):
    rows = corpus()
    out = mixing.mixture(docs(spark, rows)).toPandas()
    assert len(out) == len(rows) and out.p.between(0, 1).all()
    expected = (out.p * out.tokens).sum() / out.tokens.sum()
    assert abs(expected - 0.8) < 0.02 and abs(out[out.kept].tokens.sum() / out.tokens.sum() - 0.8) < 0.05
    assert out[out.source == "hot"].kept.mean() < out[out.source == "s1"].kept.mean()
    assert out[out.doc_id == 4000].p.item() == 1.0
    left = mixing.sample_mixture(docs(spark, rows))
    assert left.columns == docs(spark, rows[:1]).columns and left.count() == out.kept.sum()


def test_many_cells_give_the_same(spark, monkeypatch):
    rows = corpus()
    one = {r.doc_id: (round(r.p, 9), r.kept) for r in mixing.mixture(docs(spark, rows[:300]), rounds=3).collect()}
    monkeypatch.setattr(mixing, "CELLS_IN_ONE", 0)
    assert {r.doc_id: (round(r.p, 9), r.kept) for r in mixing.mixture(docs(spark, rows[:300]), rounds=3).collect()} == one


def test_sql_gives_the_same(spark, tmp_path):
    docs(spark, corpus()[:-1]).select("doc_id", "text", "source", "lang").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = {r[0]: (r[3], r[4], round(r[5], 6), r[6]) for r in con.execute("SELECT doc_id, source, lang, topic, tokens, p, kept FROM (" + mixing.mixture_sql() + ")").fetchall()}
    assert {r.doc_id: (r.topic, r.tokens, round(r.p, 6), r.kept) for r in mixing.mixture(spark.read.parquet(str(tmp_path / "d"))).collect()} == want


def test_empty_tables(spark):
    assert mixing.mixture(docs(spark, [])).count() == 0
    assert mixing.mixture(docs(spark, [(1, None, None, None)])).first().kept
