"""Store, dedupe, runs, landing, streams and the command line."""

import json
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fernlight import cli
from fernlight.operators import dedupe, retention
from fernlight.plans import runs
from fernlight.sources import landing, posts, sinks, synthetic
from fernlight.sources.schema import POSTS, RAW, SIGNALS
from fernlight.sources.commits import Log
from fernlight.streaming import keyed_dedupe, posts_stream

AS_OF = datetime(2024, 1, 2, tzinfo=timezone.utc)


def test_store_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "store")
    assert posts.read_posts(spark, path).count() == 0
    made = synthetic.clean_sample(spark, 300, 1, F.lit(AS_OF)).cache()
    assert posts.write_posts(made, path, rows_per_file=50) == 300
    back = posts.read_posts(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in POSTS]
    assert back.exceptAll(made).count() == made.exceptAll(back).count() == 0
    since = AS_OF - timedelta(hours=3)
    recent = posts.read_posts(spark, path, since=since)
    assert recent.count() == made.where(F.col("timestamp") >= F.lit(since)).count()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "GreaterThanOrEqual(timestamp" in plan
    narrow = posts.post_ids(posts.read_posts(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<tweet_id:string>" in narrow


def test_first_wins_and_state(spark):
    df = spark.createDataFrame([("abc", "1", 1), ("abc", "1", 2), ("other", "1", 3), ("def", "2", 4), ("ghi", "", 5)], "fingerprint string, tweet_id string, n int")
    assert sorted(r.n for r in dedupe.first_wins(df, ["fingerprint"], [F.col("n")]).collect()) == [1, 3, 4, 5]
    seen = spark.createDataFrame([("def", ""), ("x", "1")], "fingerprint string, tweet_id string")
    assert [r.n for r in dedupe.new_only(df, seen).collect()] == [5]
    state, new = dedupe.seed_state(seen.limit(0), spark.createDataFrame([("1",), ("2",), ("2 ",), ("",), (None,)], "tweet_id string"))
    assert new.count() == state.count() == 2


def greedy(rows):
    prints, ids, out = set(), set(), {}
    for n, f, i in sorted(rows):
        ok = f not in prints and not (i and i in ids)
        if ok:
            prints.add(f)
            ids.add(i)
        out[n] = ok
    return out


def test_greedy_pairs(spark):
    rng = random.Random(3)
    for rows in ([(1, "abc", "1"), (2, "abc", "1"), (3, "different", "1"), (4, "def", "2")], [(n, f"f{rng.randrange(12)}", rng.choice(["", None, *map(str, range(12))])) for n in range(60)]):
        df = spark.createDataFrame(rows, "n int, fingerprint string, tweet_id string")
        assert {r.n: r.accepted for r in dedupe.greedy_pairs(df, "n").collect()} == greedy(rows)


def test_run_arithmetic():
    assert retention.raw_target(100, 2.5) == 600 and retention.raw_target(2000, 2.5) == 5000
    for bad in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            retention.check_run(*bad)


def test_ingest_resumes_to_its_target(spark, tmp_path):
    out = str(tmp_path / "posts")
    raw = synthetic.sample_posts(spark, 200, 5, F.lit(AS_OF))
    raw = raw.union(raw.limit(30)).cache()
    go = lambda target: runs.ingest(spark, raw, out, target=target, hours=25, as_of=AS_OF)
    first = go(120)
    assert (first["accepted_this_run"], first["total_unique"], first["remaining"], first["target_met"]) == (120, 120, 0, True)
    again = go(120)
    assert again["existing_unique"] == 120 and again["written_this_run"] == 0 and again["target_met"]
    rest = go(500)
    assert (rest["existing_unique"], rest["accepted_this_run"], rest["total_unique"], rest["target_met"]) == (120, 80, 200, False)
    stored = posts.read_posts(spark, out)
    assert stored.count() == stored.select("fingerprint").distinct().count() == 200


def test_analyze_and_command_line(spark, tmp_path, capsys):
    store, out = str(tmp_path / "s"), str(tmp_path / "o")
    cli.main(["generate-sample", "--count", "120", "--output", store, "--as-of", "2024-01-02T00:00:00"])
    assert json.loads(capsys.readouterr().out)["written"] == 120
    cli.main(["analyze", "--input", store, "--output", out, "--as-of", "2024-01-02T00:00:00"])
    got = json.loads(capsys.readouterr().out)
    assert got["summary"]["tweet_count"] == 120 and got["vectors"]["rows"] == 120
    rows = sinks.read_signals_csv(spark, f"{out}/signals_15m.csv")
    assert rows.schema == SIGNALS and got["summary"]["window_count"] == rows.count()
    keys = [(r.window_start, r.market) for r in rows.collect()]
    assert keys == sorted(keys)
    landed = str(tmp_path / "in")
    synthetic.sample_posts(spark, 40, 9, F.lit(AS_OF)).write.json(landed)
    (tmp_path / "in" / "bad.json").write_text("{not json\n")
    cli.main(["collect", "--input", landed, "--output", str(tmp_path / "c"), "--target", "25", "--as-of", "2024-01-02T00:00:00"])
    assert json.loads(capsys.readouterr().out)["written_this_run"] == 25


def test_ordered_map(spark):
    from fernlight.operators.mapping import ordered_map

    out = ordered_map(spark.range(0, 20, 1, 5), lambda x: x * x, column="id", result="square", result_type="long", order="id")
    assert [r.square for r in out.collect()] == [x * x for x in range(20)]


def test_plot(spark, tmp_path):
    import xml.etree.ElementTree as ET

    rows = spark.createDataFrame([("2024-01-01T00:00:00+00:00", "a<b", 1, 1, 1, 1, 0, 0, 0.5, 0.1, 0.9, 0.5, 0.0), ("2024-01-01T00:15:00+00:00", "a<b", 1, 1, 1, 1, 0, 0, -0.5, -0.9, -0.1, 0.5, 0.0)], SIGNALS)
    for k, df in enumerate((rows, rows.limit(0))):
        sinks.plot_signals(df, str(tmp_path / f"{k}.svg"))
        tree = ET.fromstring("\n".join(r.value for r in spark.read.text(str(tmp_path / f"{k}.svg")).collect()))
        assert len(tree.findall("{*}polyline")) == 1 - k


def test_collector_source(spark):
    class Three(landing.Collector):
        def collect(self, *, queries, cutoff, target):
            for k in range(3):
                yield {"tweet_id": f"{queries[0]}{k}", "timestamp": cutoff, "content": "x", "hashtags": ["a"]}

    spark.dataSource.register(landing.collector_source(Three(), ("q", "r"), AS_OF, 10))
    df = spark.read.format("collector").load()
    assert df.schema == RAW and sorted(r.tweet_id for r in df.collect()) == ["q0", "q1", "q2", "r0", "r1", "r2"]
    assert posts.clean(df).count() == 6


def test_rounds_end_without_progress():
    class Page(landing.RoundCollector):
        asked = 0

        def rounds(self, query, cutoff):
            for k in (0, 1, 1, 2, 2, 2, 2, 3):
                self.asked += 1
                yield [{"tweet_id": f"{query}{k}", "timestamp": cutoff}, {"tweet_id": f"old{query}{k}", "timestamp": datetime(2000, 1, 1, tzinfo=AS_OF.tzinfo)}]

    page = Page(patience=3)
    assert [r["tweet_id"] for r in page.collect(queries=("a", "b"), cutoff=AS_OF, target=9)] == ["a0", "a1", "a2", "b0", "b1", "b2"] and page.asked == 14
    assert [r["tweet_id"] for r in Page().collect(queries=("a", "b"), cutoff=AS_OF, target=2)] == ["a0", "a1"]
    with pytest.raises(ValueError):
        Page(patience=0)


def test_preview_csv(spark, tmp_path):
    synthetic.write_preview(spark, str(tmp_path / "p"), count=50, as_of=F.lit(AS_OF))
    rows = spark.read.option("header", True).csv(str(tmp_path / "p")).collect()
    assert len(rows) == 50 and {r.synthetic for r in rows} == {"true"} and [r.timestamp for r in rows] == sorted(r.timestamp for r in rows)
    assert {r.hashtags for r in rows} <= set(synthetic.TAGS)


def test_row_groups_have_their_size(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "g")
    one = synthetic.clean_sample(spark, 900, 1, F.lit(AS_OF)).withColumns({"event_date": F.lit("2024-01-01"), "event_hour": F.lit("00")})
    assert posts.write_posts(one, path, rows_per_file=600, rows_per_group=250) == 900
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/*/*/*.parquet")]
    assert sum(f.num_rows for f in files) == 900 and max(f.num_rows for f in files) <= 600
    assert max(f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)) <= 250
    assert {f.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_summary_in_one_pass(spark):
    from fernlight.operators import signals as S

    for n in (400, 0):
        made = synthetic.clean_sample(spark, n, 3, F.lit(AS_OF))
        scored = runs.with_signal(runs.with_features(made, "normalized_content"), F.lit(AS_OF))
        assert S.run_summary(scored).collect() == S.summary(S.signals(scored), S.language_counts(made)).collect()


def test_json_log_lines():
    import logging

    record = logging.LogRecord("fernlight", 20, "", 0, "done %d", (3,), None)
    record.count, record.secret = 5, 1
    out = json.loads(sinks.JsonLines().format(record))
    assert out["message"] == "done 3" and out["count"] == 5 and "secret" not in out


@pytest.fixture()
def landed(spark, tmp_path):
    raw = synthetic.sample_posts(spark, 150, 11, F.lit(AS_OF))
    for k, part in enumerate((raw, raw.limit(60))):
        part.coalesce(1).write.parquet(str(tmp_path / "raw" / f"{k}"))
    return str(tmp_path / "raw" / "*")


def test_stream_is_the_batch(spark, tmp_path, landed):
    source = posts_stream.read_raw(spark, landed, files_per_trigger=1)
    q = posts_stream.store_stream(source, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination()
    stored = spark.read.schema(POSTS).parquet(str(tmp_path / "out"))
    assert stored.count() == 150 == stored.select("fingerprint").distinct().count()


def test_upserts_do_not_repeat(spark, tmp_path, landed):
    for n in (1, 2):
        posts_stream.upsert_batches(posts_stream.read_raw(spark, landed, files_per_trigger=1), str(tmp_path / "out"), str(tmp_path / f"check{n}")).awaitTermination()
        assert posts.read_posts(spark, str(tmp_path / "out")).count() == 150


@pytest.mark.parametrize("start", [posts_stream.upsert_batches, keyed_dedupe.keyed_batches])
@pytest.mark.parametrize("after", [False, True])
def test_a_batch_that_is_tried_again_adds_its_posts_once(spark, tmp_path, landed, monkeypatch, start, after):
    """The stream breaks off before or after the commit of a batch, and goes on from its checkpoint."""
    real, puts = Log.put, []

    def put(self, base, entry):
        if entry.get("batches"):
            puts.append(1)
            if len(puts) == 1:
                if after:
                    real(self, base, entry)
                raise OSError("breaks off")
        return real(self, base, entry)

    monkeypatch.setattr(Log, "put", put)
    go = lambda: start(posts_stream.read_raw(spark, landed, files_per_trigger=1), str(tmp_path / "out"), str(tmp_path / "check"), buckets=4)
    with pytest.raises(StreamingQueryException):
        go().awaitTermination()
    assert posts.read_posts(spark, str(tmp_path / "out")).count() in ((150, 60) if after else (0,))
    go().awaitTermination()
    stored = posts.read_posts(spark, str(tmp_path / "out"))
    assert stored.count() == 150 == stored.select("fingerprint").distinct().count()


def test_keyed_state_is_the_upserts(spark, tmp_path, landed):
    """Beside files of others, an ingest of the same posts, and a restart with more input."""
    for name in ("a", "b"):
        posts.write_posts(posts.clean(spark.read.schema(RAW).parquet(landed).where("tweet_id < 'made-000000020'").dropDuplicates(["tweet_id"])), str(tmp_path / name))
    for name, start in (("a", posts_stream.upsert_batches), ("b", keyed_dedupe.keyed_batches)):
        go = lambda: start(posts_stream.read_raw(spark, landed, files_per_trigger=1), str(tmp_path / name), str(tmp_path / f"check-{name}"), buckets=4).awaitTermination()  # noqa: B023, E731
        go()
        assert posts.read_posts(spark, str(tmp_path / name)).count() == 150
    synthetic.sample_posts(spark, 190, 11, F.lit(AS_OF)).coalesce(1).write.parquet(str(tmp_path / "raw" / "2"))
    for name, start in (("a", posts_stream.upsert_batches), ("b", keyed_dedupe.keyed_batches)):
        report = runs.ingest(spark, synthetic.sample_posts(spark, 170, 11, F.lit(AS_OF)), str(tmp_path / name), target=1000, hours=25, as_of=AS_OF)
        assert report["accepted_this_run"] == 20  # what others commit after the stream joined
        start(posts_stream.read_raw(spark, landed, files_per_trigger=1), str(tmp_path / name), str(tmp_path / f"check-{name}"), buckets=4).awaitTermination()
    a, b = (sorted(r.fingerprint for r in posts.read_posts(spark, str(tmp_path / name)).collect()) for name in "ab")
    assert a == b and len(a) == len(set(a)) == 190


def test_keyed_state_takes_the_first_post_and_reads_no_store(spark, tmp_path, monkeypatch):
    at = lambda m: AS_OF - timedelta(minutes=m)
    rows = [("1", "b", at(5), "x"), ("1", "a", at(5), "y"), ("1", "c", at(4), "z"), (None, "u", at(3), "same"), (None, "u", at(3), "same"), ("", "u", at(3), "other"), (None, None, at(2), None)]
    df = spark.createDataFrame(rows, "tweet_id string, username string, timestamp timestamp, content string")
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW])
    full.coalesce(1).write.parquet(str(tmp_path / "raw"))
    monkeypatch.setattr(posts_stream, "read_state", lambda *_: pytest.fail("a batch alone in its store reads no state"))
    keyed_dedupe.keyed_batches(posts_stream.read_raw(spark, str(tmp_path / "raw")), str(tmp_path / "out"), str(tmp_path / "check"), buckets=4).awaitTermination()
    got = sorted((r.tweet_id or "", r.username, r.content) for r in posts.read_posts(spark, str(tmp_path / "out")).collect())
    assert got == [("", "", ""), ("", "u", "other"), ("", "u", "same"), ("1", "a", "y")]


def test_old_fingerprints_go_with_a_time_to_live(spark, tmp_path):
    raw = synthetic.sample_posts(spark, 30, 1, F.lit(AS_OF))
    raw.coalesce(1).write.parquet(str(tmp_path / "raw" / "0"))
    start = lambda **b: keyed_dedupe.keyed_batches(posts_stream.read_raw(spark, str(tmp_path / "raw" / "*")), str(tmp_path / "out"), str(tmp_path / "check"), ttl=timedelta(milliseconds=1), buckets=4, **b)
    with pytest.raises(ValueError):
        start(trigger={"availableNow": True})
    query = start(trigger={"processingTime": "1 second"})
    try:
        for k, n in enumerate((30, 60)):
            until = time.time() + 60
            while posts.read_posts(spark, str(tmp_path / "out")).count() < n and time.time() < until:
                time.sleep(1)
            if not k:
                raw.coalesce(1).write.parquet(str(tmp_path / "raw" / "1"))
    finally:
        query.stop()
    assert posts.read_posts(spark, str(tmp_path / "out")).count() == 60


@pytest.mark.parametrize("minutes", [15, 45, 60, 7, 90])
def test_closed_windows_of_streams_are_the_batch_ones(spark, tmp_path, minutes):
    """All columns, authors too; a late row far ahead closes every window."""
    made = synthetic.sample_posts(spark, 400, 4, F.lit(AS_OF)).withColumn("username", F.concat(F.lit("w"), F.col("view_count") % 9))
    ahead = made.limit(1).withColumns({"timestamp": F.lit(AS_OF + timedelta(days=9)), "tweet_id": F.lit("ahead")})
    for k, part in enumerate((made, ahead)):
        part.coalesce(1).write.parquet(str(tmp_path / "raw" / f"{k}"))
    name = f"sig{minutes}"
    clean = posts_stream.clean_stream(posts_stream.read_raw(spark, str(tmp_path / "raw" / "*"), files_per_trigger=1))
    posts_stream.signal_stream(clean, F.lit(AS_OF), minutes=minutes).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    from fernlight.operators.signals import signals

    plain = lambda r: tuple(round(x, 5) if isinstance(x, float) else x for x in r)
    want = sorted(plain(r) for r in signals(runs.score(posts.clean(made), F.lit(AS_OF)), minutes=minutes).collect())
    assert sorted(plain(r) for r in spark.table(name).collect()) == want and len(want) > 20


def test_stream_signals_are_the_batch_ones(spark, landed):
    clean = posts_stream.clean_stream(posts_stream.read_raw(spark, landed))
    q = posts_stream.signal_stream(clean, F.lit(AS_OF)).writeStream.format("memory").queryName("sig").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    from fernlight.operators.signals import signals

    raw = spark.read.schema(RAW).parquet(landed)
    one = dedupe.first_wins(posts.clean(raw), ["fingerprint"], [F.col("tweet_id")])
    batch = {(r.window_start, r.market): r for r in signals(runs.score(one, F.lit(AS_OF))).collect()}
    got = spark.table("sig").collect()
    for r in got:  # windows that the watermark has closed
        b = batch[r.window_start, r.market]
        assert r.tweet_count == b.tweet_count and r.unique_authors == b.unique_authors and r.composite_signal == pytest.approx(b.composite_signal, abs=2e-6)
    with pytest.raises(ValueError):
        posts_stream.signal_stream(clean, F.lit(AS_OF), minutes=0)
