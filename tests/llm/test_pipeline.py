"""The pipeline's stages, one by one and together, and the registered queries against their SQL."""

import os
import re

import duckdb
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from fernlight.llm import mixing, pieces, quality, queries
from fernlight.llm.common import column_bytes

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "benchmark")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF) or not os.path.exists(pieces.DEFAULT_MODEL), reason="no test tables or vocabulary here")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    table = "pages" if name.startswith("op6") else "documents"
    if not name.startswith("op12"):  # a row for each phrase, not for each document
        assert len(got) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in entry.oracle_sql():
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        out = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in out.description]
        assert got == sorted((tuple(r[names.index(c)] for c in columns) for r in out.fetchall()), key=str)


def test_stages_keep_the_columns_and_act(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns and len(ids) < len(before)
        docs = after
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in pieces.decode(docs).collect():
        assert r.text == (texts[r.doc_id] or "")


def plain_good(spark, rows):
    """Each text scored by itself."""
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = [float(model.score(quality.features(*column_bytes(pa.array([r.text], pa.string()))))[0]) for r in rows]
    assert all(abs(x - 0.5) > 1e-6 for x in scores)
    return {r.doc_id for r, x in zip(rows, scores) if x >= 0.5}


def plain_exact(spark, rows):
    best = {}
    for r in rows:
        key = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        best[key] = max(best.get(key, r.doc_id), r.doc_id)
    return set(best.values())


def plain_near(spark, rows):
    """All pairs: fingerprints within four bits, or 0.8 of five-word shingles in common."""
    prints, sets = [], []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate({c: c + 32 for c in range(65, 91)}))
        cut = lambda n: [" ".join(words[k : k + n]).encode() for k in range(max(1, len(words) - n + 1))] if words else []  # noqa: B023, E731
        hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in cut(4)]
        prints.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
        sets.append(set(cut(5)))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if (prints[a] ^ prints[b]).bit_count() <= 4 or union and len(sets[a] & sets[b]) >= 0.8 * union:
                root[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        least[find(k)] = min(least.get(find(k), r.doc_id), r.doc_id)
    return set(least.values())


def plain_mix(spark, rows):
    con = duckdb.connect()
    con.register("documents", pa.table({c: [r[c] for r in rows] for c in ("doc_id", "text", "source", "lang")}))
    return {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({mixing.mixture_sql()})").fetchall() if kept}


def test_each_stage_keeps_what_a_plain_version_keeps(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (plain_good, plain_exact, plain_near, plain_mix)):
        rows = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert {r.doc_id for r in docs.collect()} == plain(spark, rows), name


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and 0 < out.count() < 200
    assert out.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    rows = [(k, t, "en", "s", 0) for k, t in enumerate([None, "", "a", "A", "x " * 50_000, "Plain words of some text. " * 20])] + [(2, "a", None, None, None), (None, "Plain words of some other text. " * 9, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for rows_in in (docs, docs.limit(0)):
        now = rows_in
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{rows_in is docs}-{name}")
            stage(spark, now, SF).write.parquet(path)
            now = spark.read.parquet(path)
        assert (now.count() > 0) == (rows_in is docs)
