"""The analyze and collect runs over a store."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.functions.features import with_features, with_signal
from fernlight.operators import retention, vectors
from fernlight.operators.dedupe import first_wins, known_of
from fernlight.operators.sampling import stride_sample
from fernlight.operators.signals import language_counts, signals_with_languages, summary, summary_of
from fernlight.settings import Settings
from fernlight.sources import posts as store
from fernlight.sources import sinks
from fernlight.sources.commits import OWN, Log
from fernlight.sources.schema import PARTITIONS, POSTS
from fernlight.sources.state import folder, snapshot_state, unknown, write_part


def score(posts: DataFrame, as_of: Column, *more: str) -> DataFrame:
    """Posts with features, signal and weight, read from the columns that these need, and more of their columns."""
    used = posts.select("timestamp", "normalized_content", "engagement_total", "view_count", "username", "hashtags", "query_tag", *more)
    return with_signal(with_features(used, "normalized_content").drop("normalized_content"), as_of)


def analyze(spark: SparkSession, source: str, out: str, *, minutes: int = 15, as_of: datetime | None = None, features: int = 1 << 14) -> dict[str, Any]:
    """Writes signals, summary and vectors of a store and returns summary and vector figures. Posts are read twice: for windows with their languages, and for vectors."""
    posts = store.read_posts(spark, source)
    at = F.lit(as_of or datetime.now(timezone.utc))
    windows = signals_with_languages(score(posts, at, "language_hint"), minutes=minutes).persist()
    sinks.write_signals_csv(windows.drop("languages"), f"{out}/signals_{minutes}m.csv")
    sinks.write_json(summary_of(windows), f"{out}/summary.json")
    windows.unpersist()
    rows = sinks.read_signals_csv(spark, f"{out}/signals_{minutes}m.csv")
    told = sinks.read_json(spark, f"{out}/summary.json")
    if sum(told["language_counts"].values()) < told["tweet_count"]:  # posts of others may have hints of their own
        sinks.write_json(summary(rows, language_counts(posts)), f"{out}/summary.json")
    sinks.write_vectors(vectors.hashed_vectors(posts, features=features), f"{out}/vectors")
    made = spark.read.parquet(f"{out}/vectors")
    sinks.write_json(vectors.vector_metadata(made, features), f"{out}/vectors_metadata.json")
    sinks.plot_signals(stride_sample(rows), f"{out}/signals.svg")
    return {"summary": sinks.read_json(spark, f"{out}/summary.json"), "vectors": sinks.read_json(spark, f"{out}/vectors_metadata.json")}


def ingest(spark: SparkSession, raw: DataFrame, out: str, *, target: int, hours: int, as_of: datetime, settings: Settings | None = None, tries: int = 20) -> dict[str, Any]:
    """Adds new posts of `raw` to the store until it holds `target` ids of the last hours; a report.

    Posts and their state become part of the store by one commit. A run that breaks off before it has changed
    nothing; two runs at once accept each post once, as the one whose commit comes second begins anew. Files that
    others have put into the store are read into the state once, by the first run that finds them.
    """
    retention.check_run(target, hours)
    for _ in range(tries):
        report = _ingest_once(spark, raw, out, target=target, hours=hours, as_of=as_of, settings=settings or Settings())
        if report is not None:
            return report
    raise RuntimeError(f"other writers came first {tries} times")


def _ingest_once(spark: SparkSession, raw: DataFrame, out: str, *, target: int, hours: int, as_of: datetime, settings: Settings) -> dict[str, Any] | None:
    at, mark, log = F.lit(as_of), str(uuid.uuid4()), Log(spark, out)
    seen = log.snapshot()
    foreign = log.unlogged(seen)
    have = store.read_files(spark, out, [*seen.files, *foreign], since=as_of - timedelta(hours=hours))
    existing = retention.recent_count(have, at, hours).first()[0]
    remaining = max(target - existing, 0)
    buckets = seen.buckets or settings.state_buckets
    entry: dict[str, Any] = {"buckets": buckets, "add": foreign, "parts": []}
    if foreign:
        write_part(known_of(store.read_files(spark, out, foreign)), out, f"{mark}-found", buckets)
        entry["parts"].append(f"{mark}-found")
    n = unique = written = 0
    files: dict[str, int] = {}
    if remaining:
        limit = retention.raw_target(remaining, settings.raw_candidate_multiplier)
        candidates = store.clean(retention.take_first(retention.recent(raw, at, hours), limit, [F.col("timestamp").desc(), F.col("tweet_id")])).persist()
        n = candidates.count()
        order = [F.col("timestamp").desc(), F.col("tweet_id"), F.col("username")]
        # the order is descending in time: min_by takes ascending keys
        one = first_wins(candidates, ["fingerprint"], [-F.unix_micros("timestamp"), F.col("tweet_id"), F.col("username")])
        fresh = unknown(one, snapshot_state(spark, out, seen, entry["parts"], buckets)).persist()
        unique = fresh.count()
        accepted = retention.take_first(fresh, remaining, order).persist()
        written, files = store.stage_posts(accepted, log, mark, rows_per_file=settings.rows_per_file)
        if files:
            write_part(accepted, out, mark, buckets)
            entry["add"] = foreign | files
            entry["parts"].append(mark)
        for df in (candidates, fresh, accepted):
            df.unpersist()
    if (files or foreign) and not log.put(seen, entry):
        log.remove([*files])
        return None
    return retention.report(existing, written, n - unique, written, target, folder(out))


def compact(spark: SparkSession, path: str, *, small: int = 64 << 20, goal: int = 256 << 20) -> int:
    """Packs the small files of each hour into files of about `goal` bytes; how many files went.

    Bins are filled largest file first. One commit swaps the files; who reads an earlier number still finds its files until
    `vacuum`. A commit that adds files does not stand in the way, one that removed some of these does.
    """
    log, mark = Log(spark, path), str(uuid.uuid4())
    seen = log.snapshot()
    bins = packed({n: size for n, size in seen.files.items() if size < small}, goal)
    if not bins:
        return 0
    names = [n for own in bins for n in own]
    plan = spark.createDataFrame([(*_hour_of(n), n.rpartition("/")[2], k) for k, own in enumerate(bins) for n in own], "event_date string, event_hour string, file_name string, bin int")
    rows = store.read_files(spark, path, names).select("*", "_metadata.file_name").join(F.broadcast(plan), ["event_date", "event_hour", "file_name"])
    staged = f"{log.path}/_staged/{mark}"
    dealt = rows.repartitionById(len(bins), "bin").select(*[f.name for f in POSTS])
    dealt.write.option("compression", "zstd").partitionBy(*PARTITIONS).parquet(staged)
    files = log.place(staged, mark)
    while not log.put(seen, {"add": files, "remove": names}):
        seen = log.snapshot()
        if not set(names) <= set(seen.files):
            log.remove([*files])
            return 0
    return len(names) - len(files)


def packed(sizes: dict[str, int], goal: int) -> list[list[str]]:
    """Files of one hour together, largest first into the first bin that has room; bins of one file are left out."""
    bins: dict[str, list[tuple[int, list[str]]]] = {}
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        own = bins.setdefault(name.rpartition("/")[0], [])
        k = next((k for k, (held, _) in enumerate(own) if held + size <= goal), None)
        if k is None:
            own.append((size, [name]))
        else:
            own[k] = (own[k][0] + size, [*own[k][1], name])
    return [names for own in bins.values() for _, names in own if len(names) > 1]


def _hour_of(name: str) -> tuple[str, str]:
    day, hour = name.split("/")[:2]
    return day.partition("=")[2], hour.partition("=")[2]


def vacuum(spark: SparkSession, path: str, *, older_than: timedelta = timedelta(days=1), now: datetime | None = None) -> int:
    """Removes files and state parts that no entry names any more, or never did, and that are older; how many.

    Younger ones may belong to a writer at work, or to readers of an earlier number.
    """
    log = Log(spark, path)
    if not log.exists():
        return 0
    seen = log.snapshot()
    before = ((now or datetime.now(timezone.utc)) - older_than).timestamp() * 1000
    old = lambda where: log.files.getFileStatus(log.at(where)).getModificationTime() <= before
    own = log.listed(log.path).where(F.element_at(F.split("path", "/"), -1).startswith(OWN)).select("path").toLocalIterator()
    gone = [f"{log.path}/{r.path}" for r in own if r.path not in seen.files]
    gone += [f"{folder(path)}/{n}" for n in log.names(folder(path)) if n not in seen.parts]
    gone += [f"{log.path}/_staged/{n}" for n in log.names(f"{log.path}/_staged")]
    gone = [g for g in gone if old(g)]
    for g in gone:
        log.files.delete(log.at(g), True)
    return len(gone)
