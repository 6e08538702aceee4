"""Collection in rounds: ids across queries, no progress, resume, targets."""

from datetime import datetime, timedelta, timezone

import pytest

from fernlight.sources import posts
from fernlight.streaming import rounds

CUTOFF = datetime(2024, 1, 1, tzinfo=timezone.utc)


def make_pages():
    """A local function, as executors can't import this file."""

    def pages(query, number, cutoff):
        """Pages 0 to 3 of two posts each; both queries share a post a page, and one post is too old."""
        new = [f"shared{number}", f"{query}{number}"] if number < 4 else [f"shared{k}" for k in range(3)]
        old = {"tweet_id": "old", "timestamp": cutoff - timedelta(seconds=1)}
        return [*({"tweet_id": i, "username": "u", "timestamp": cutoff + timedelta(minutes=number), "content": i} for i in new), old]

    return pages


def ids(spark, path):
    return sorted(r.tweet_id for r in posts.read_posts(spark, path).select("tweet_id").collect())


def go(spark, tmp_path, **options):
    return rounds.collect_rounds(spark, make_pages(), str(tmp_path / "out"), str(tmp_path / "check"), queries=("a", "b"), cutoff=CUTOFF, every="0 seconds", buckets=2, **options)


def test_rounds_end_resume_and_share_ids(spark, tmp_path):
    first = go(spark, tmp_path, target=4, patience=3)
    assert first["new_posts"] >= 4
    have = ids(spark, str(tmp_path / "out"))
    assert len(have) == len(set(have)) >= 4 and "old" not in have
    rest = go(spark, tmp_path, target=1000, patience=2)
    got = ids(spark, str(tmp_path / "out"))
    assert got == sorted([f"{q}{k}" for q in ("a", "b", "shared") for k in range(4)])
    # a batch may be stored after the target was reached and before the stream ended
    assert rest["new_posts"] <= 12 - first["new_posts"] and rest["rounds"] >= 2
    assert go(spark, tmp_path, target=1000, patience=1)["new_posts"] == 0 and ids(spark, str(tmp_path / "out")) == got


def test_progress():
    p = rounds.Progress(2, 10)
    for n in (3, 0, 2, 0):
        p.note(n)
        assert not p.over.is_set()
    p.note(0)
    assert p.over.is_set() and (p.rounds, p.new) == (5, 5)
    q = rounds.Progress(9, 5)
    q.note(6)
    assert q.over.is_set()
    with pytest.raises(ValueError):
        rounds.Progress(0, 1)


def test_pages_that_fail_are_told(spark, tmp_path):
    def broken(query, number, cutoff):
        raise OSError("no page")

    with pytest.raises(Exception, match="no page"):
        rounds.collect_rounds(spark, broken, str(tmp_path / "out"), str(tmp_path / "check"), queries=("a",), cutoff=CUTOFF, target=5, every="0 seconds", buckets=2)
