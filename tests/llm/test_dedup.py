"""Substring, exact, near and line dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fernlight.llm import exact_dedup, line_dedup, simhash_dedup, substring_dedup
from fernlight.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, k string, d long, h long, w string, kept boolean"


def frame(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those that operators use."""
    return spark.createDataFrame([(i, t, "k", 7, 8, "w", None) for i, t in rows], SCHEMA).repartition(parts)


def passages(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.choice([49, 50, 51, 80, 120]))] for _ in range(5)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "ha " * 400), (n + 4, "ha " * 300), (n + 5, rows[3][1]), (n + 6, "x y " * 60), (3, rows[3][1])]


def brute_substring(rows, window):
    first = {}
    for i, t in rows:
        words = WORDS.findall(t or "")
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        words = WORDS.findall(t or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out)


@pytest.mark.parametrize(("window", "first"), [(50, 13), (50, 25), (48, 12), (20, 3)])
def test_substring(spark, window, first):
    rows = passages(window)
    out = substring_dedup.remove_repeats(frame(spark, rows), window=window, first=first)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect()) == brute_substring(rows, window)
    for r in out.collect():
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_removed


def test_substring_windows_at_the_ends_of_passages(spark):
    """Passages in other surroundings: windows that only share their anchor with a repeated one stay."""
    rng = random.Random(17)
    rows = []
    for k in range(300):  # once alone, once with words of its own around it
        passage = [f"s{k}.{n}" for n in range(rng.randrange(50, 60))]
        rows.append((2 * k, " ".join(passage)))
        rows.append((2 * k + 1, " ".join([f"o{k}.{n}" for n in range(30)] + passage + [f"p{k}.{n}" for n in range(30)])))
    for first in (13, 7):
        out = substring_dedup.remove_repeats(frame(spark, rows), window=50, first=first).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out) == brute_substring(rows, 50)


def test_substring_null_id_and_empty_table(spark):
    text = " ".join(f"a{k}" for k in range(60))
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame(spark, [(None, text), (5, text), (9, text)])).collect()}
    assert got == {None: 0, 5: 0, 9: 60}
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(frame(spark, []), window=1)


def test_substring_levels():
    assert substring_dedup.lengths_of(50) == [13, 25, 50]
    assert substring_dedup.lengths_of(50, 7) == [7, 13, 25, 50]
    assert substring_dedup.lengths_of(100) == [13, 25, 50, 100] and substring_dedup.lengths_of(4) == [2, 4]
    for window in range(2, 200):
        lengths = substring_dedup.lengths_of(window)
        assert lengths[-1] == window and all(a < b <= 2 * a for a, b in zip(lengths, lengths[1:]))


def test_substring_candidates_fall_by_level():
    """What repeats at one length alone is extended: a passage of 20 words repeats at 13 words and not at 25."""
    rng = random.Random(4)
    passage, rows = [f"p{k}" for k in range(20)], []
    for i in range(12):
        own = [f"d{i}.{rng.random()}" for _ in range(80)]
        rows.append(own[:40] + passage + own[40:] if i < 6 else own)
    lengths = [13, 25, 50]
    texts = [" ".join(r) for r in rows]
    import pyarrow as pa

    def level(k, alive):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array([alive] * len(texts), pa.list_(pa.int64()))], ["d", "t", "alive"])
        seen = {}
        for out in substring_dedup._anchor_level(lengths, k)(iter([batch])):
            for anchor, d in zip(out.column("k").to_pylist(), out.column("d").to_pylist()):
                seen.setdefault(anchor, set()).add(d)
        return len(seen), [a for a, ds in seen.items() if len(ds) > 1]

    first, alive = level(0, [])
    assert first > 24 and 1 <= len(alive) <= 8
    second, none = level(1, alive)
    assert 0 < second < first and none == []
    assert level(1, [])[0] == 0


def texts(seed):
    rng = random.Random(seed)
    base = ["", None, "Abc", "aBC", "abc", "ABC é", "abc É", "abc é", "x" * 5000, "x" * 4999 + "X", "İ", "i̇", " abc", "abc "]
    return [(i, rng.choice(base)) for i in range(120)] + [(7, "abc"), (7, "abc"), (None, "lonely"), (None, "abc")]


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("hot", [0, 300])
def test_exact(spark, keep, hot):
    rows = texts(1) + [(1000 + k, "Hot TEXT" if k % 2 else "hot text") for k in range(hot)]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(low), []).append(i)
    best = {t: (max if keep == "largest" else min)([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    out = exact_dedup.exact_groups(frame(spark, rows), keep=keep).collect()
    key = lambda x: tuple(str(v) for v in x)
    expected = sorted(((i, best[(t or "").translate(low)], len(groups[(t or "").translate(low)]), hashlib.sha256((t or "").translate(low).encode()).hexdigest()) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=key) == expected
    kept = [r for r in out if r.kept]
    assert len(kept) == len(groups) and {r.text_sha256 for r in kept} == {r.text_sha256 for r in out}
    left = exact_dedup.drop_exact_copies(frame(spark, rows), keep=keep)
    assert left.columns == frame(spark, []).columns and left.count() == len(groups)


def test_ranges_are_found_by_halving(spark):
    for edges in ([], [5], [1, 5, 9], list(range(0, 200, 3))):
        got = spark.range(-3, 210).select("id", exact_dedup._range_of(F.col("id"), edges).alias("p")).collect()
        assert all(r.p == sum(e < r.id for e in edges) for r in got)


def test_exact_empty_table(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def brute_fingerprint(text, n=4):
    words = [w.encode() for w in WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, radius=4):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    return [find(a) for a in range(len(prints))]


def near_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(400)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 300))]
        for _ in range(rng.randrange(1, 7)):
            words = base[:]
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words).title() if rng.random() < 0.3 else " ".join(words)))
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "one two"), (n + 4, "ONE two"), (n + 5, "É one two three"), (n + 6, "é one two three")]


@pytest.mark.parametrize("block", [1 << 15, 2])
def test_near(spark, block):
    rows = near_rows(3)
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints)
    smallest = {}
    for (i, _), r in zip(rows, roots):
        smallest[r] = min(smallest.get(r, i), i)
    out = {r.doc_id: r for r in simhash_dedup.near_groups(frame(spark, rows), block=block).collect()}
    for (i, _), f, r in zip(rows, prints, roots):
        assert out[i].fingerprint == f"{f:016x}" and out[i].component_id == smallest[r] and out[i].kept == (i == smallest[r]), i


@pytest.mark.parametrize("shingle", [1, 2, 4])
@pytest.mark.parametrize("distinct", [False, True])
def test_parts_of_long_texts_change_nothing(shingle, distinct):
    rng = random.Random(8)
    texts = [b"", b" ", b"x" * 90, b"a b", *(b" ".join(rng.choice([b"aa", b"Bb", b"c" * 30, b"dd\t"]) for _ in range(rng.randrange(200))) for _ in range(30))]
    whole = simhash_dedup.fingerprints(texts, shingle, distinct)
    for limit in (1, 7, 40):
        assert np.array_equal(whole, simhash_dedup.fingerprints(texts, shingle, distinct, limit=limit))


def test_near_empty_and_repeated_rows(spark):
    assert simhash_dedup.near_groups(frame(spark, [])).count() == 0
    got = simhash_dedup.near_groups(frame(spark, [(4, "a b c d"), (4, "a b c d"), (None, "q r s t")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.group_size, r.kept) for r in got) == [("4", "4", 2, True), ("4", "4", 2, True), ("None", "None", 1, True)]


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(5)
    f = rng.integers(0, 1 << 63, 400, dtype=np.int64).view(np.uint64)
    for bits in range(5):
        g = f.copy()
        for k in range(len(g)):
            for b in rng.choice(64, bits, replace=False):
                g[k] ^= np.uint64(1) << np.uint64(b)
        one, two = (set(zip(*(x.tolist() for x in simhash_dedup.bucket_keys(v)), strict=True)) for v in (f, g))
        assert {k for _, k in one & two} == set(range(400))


def test_golay_decodes_all_words_within_three():
    code = simhash_dedup.Golay()
    words = np.arange(1 << 23, dtype=np.uint32)[::37]
    index = code.index(words).astype(np.int64)
    codeword = (index << 11) ^ code._remainder(index << 11)
    assert np.bitwise_count(codeword.astype(np.uint32) ^ words).max() <= 3


def test_links_of_a_dense_group_are_a_tree():
    rng = np.random.default_rng(2)
    f = np.unique(rng.integers(0, 1 << 10, 700).astype(np.uint64))
    a, b = simhash_dedup.links(f)
    assert len(a) == len(f) - 1 and (np.bitwise_count(f[a] ^ f[b]) <= 4).all()


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1200)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: find(a) for e in edges if e[0] != e[1] for a in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    odd = [(1, None), (None, 2), (None, None), (3, 3), (4, 5), (5, 4), (4, 5)]
    assert {(r.node, r.root) for r in components(spark.createDataFrame(odd, "a long, b long")).collect()} == {(4, 4), (5, 4)}


def test_each_star_of_components_is_made_once(spark, monkeypatch):
    from fernlight.llm import components as module

    joins = []

    def told(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join Inner"))
        return checkpointed(df)

    checkpointed = module.checkpointed
    monkeypatch.setattr(module, "checkpointed", told)
    edges = spark.createDataFrame([(k, k // 3) for k in range(1, 200)], "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(k, 0) for k in range(200)}
    assert len(joins) > 4 and joins[0] == 0 and max(joins) == 1


def line_rows(seed):
    rng = random.Random(seed)
    stock = [f"line {k}" for k in range(25)] + ["", "same", "same"]
    blocks = [[rng.choice(stock) for _ in range(rng.randrange(2, 12))] for _ in range(6)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            lines += rng.choice(blocks) if rng.random() < 0.6 else [f"own {rng.randrange(999)}" for _ in range(rng.randrange(1, 5))]
        rows.append((i, "\n".join(lines)))
    return rows + [(50, None), (51, ""), (52, "\n\n\n"), (53, "same\n" * 200), (54, rows[2][1]), (55, "a\r\nb\nc")]


def brute_lines(rows, ends="048c"):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    cut = []
    for i, t in sorted(rows):
        lines = (t or "").split("\n")
        h = [md5(x) for x in lines]
        chunks, now = [], []
        for k, line in enumerate(lines):
            now.append(line)
            if k == len(lines) - 1 or md5((h[k - 1] if k else "") + h[k])[0] in ends:
                chunks.append(now)
                now = []
        cut.append((i, lines, chunks))
    seen, out = set(), []
    for i, lines, chunks in cut:
        kept, removed = [], 0
        for c in chunks:
            text = "\n".join(c)
            if len(c) >= 2 and text in seen:
                removed += len(c)
            else:
                kept.append(text)
            seen.add(text)
        out.append((i, len(lines), len(chunks), removed, "\n".join(kept)))
    return out


def test_lines(spark):
    rows = [(i, t) for i, t in line_rows(6)]
    rows = sorted(rows, key=lambda r: r[0])
    out = line_dedup.remove_repeated_chunks(frame(spark, [(i, t) for i, t in rows])).collect()
    got = sorted((r.doc_id, r.n_lines, r.n_chunks, r.n_removed, r.kept_text) for r in out)
    want = [(i, n, c, m, k) for i, n, c, m, k in brute_lines([(i, t or "") for i, t in rows])]
    assert got == want
    assert sum(r[3] for r in got) > 50


def test_lines_null_id_repeated_rows_and_empty_table(spark):
    text = "\n".join(f"row {k}" for k in range(30))
    got = line_dedup.remove_repeated_chunks(frame(spark, [(3, text), (3, text), (None, text)])).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.n_removed)
    assert by[None] == [0] and by[3][0] == by[3][1] > 0
    assert line_dedup.remove_repeated_chunks(frame(spark, [])).count() == 0


def test_near_copies_by_similarity(spark):
    rng = random.Random(12)
    vocabulary = [f"v{k}" for k in range(3000)]
    rows = []
    for _ in range(30):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(120, 300))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randrange(3)):
            words = base[:]
            for _ in range(rng.randrange(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    n = len(rows)
    rows += [(n, None), (n + 1, " "), (n + 2, "a b"), (n + 3, "a b c"), (None, rows[0][1]), (4, rows[4][1])]
    sets = {}
    for i, t in rows:
        words = WORDS.findall(t or "")
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            union = sets[a] | sets[b]
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(union):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.component_id, r.kept) for r in simhash_dedup.near_copies(frame(spark, rows)).collect()}
    assert got == {i: (find(i), find(i) == i) for i in ids}
    assert simhash_dedup.near_copies(frame(spark, [])).count() == 0


def test_near_copies_of_one_text_that_are_not_similar_to_each_other(spark):
    rng = random.Random(5)
    base = [f"b{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 61):
        words = base[:]
        for k in rng.sample(range(10, 190), 4):
            words[k] = f"n{i}-{k}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(196)} for _, t in rows]
    like = {i for i in range(1, 61) if len(sets[0] & sets[i]) >= 0.8 * len(sets[0] | sets[i])}
    for members in (256, 16):
        got = {r.doc_id: r.component_id for r in simhash_dedup.near_copies(frame(spark, rows), members=members).collect()}
        assert len(like) > 40 and {i for i in got if got[i] == 0} >= like


def test_similar_links_connect_as_all_pairs_do():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 40, rng.integers(0, 12))).astype(np.uint64) for _ in range(300)]
    a, b = simhash_dedup.similar_links(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 0.6)
    like = lambda x, y: len(np.intersect1d(sets[x], sets[y])) >= 0.6 * len(np.union1d(sets[x], sets[y]))
    assert all(like(x, y) for x, y in zip(a, b, strict=True))
    group = list(range(300))
    for x, y in zip(a, b, strict=True):
        group = [group[x] if g == group[y] else g for g in group]
    assert all(group[x] == group[y] for x in range(300) for y in range(x) if like(x, y)) and len(a) == 300 - len(set(group)) > 20


def test_pages_of_one_template_are_compared_by_their_rare_shingles(spark, monkeypatch):
    """Many pages at 0.7 to each other, some similar ones among them; every similar pair shares a prefix, unlike pages none."""
    rng = random.Random(12)
    template = [f"t{k}" for k in range(200)]
    rows = [(i, " ".join([*template[:100], *(f"w{rng.randrange(10**9)}" for _ in range(34)), *template[100:]])) for i in range(150)]
    for j in range(12):
        words = rows[7 * j][1].split()
        words[105 + j] = "changed"
        rows.append((200 + j, " ".join(words)))
    sets = {i: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)} for i, t in rows}
    similar = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert similar == {(7 * j, 200 + j) for j in range(12)}
    texts = spark.createDataFrame(rows, "i long, t string")
    whole = texts.mapInArrow(simhash_dedup._shingle_sets(5), "i long, s array<long>")
    held = simhash_dedup._prefixes(whole, 0.8).groupBy("i").agg(F.collect_set("k").alias("k"), F.collect_set(F.when(F.col("x"), F.col("k"))).alias("x")).collect()
    found = {(min(a.i, b.i), max(a.i, b.i)) for a in held for b in held if a.i != b.i and set(a.x) & set(b.k)}
    assert similar <= found and len(found) < 3 * len(similar)
    used = []
    real = simhash_dedup._prefixes
    monkeypatch.setattr(simhash_dedup, "_prefixes", lambda *a: used.append(1) or real(*a))
    keyed = texts.select("i", F.lit(1).cast("long").alias("k"))
    for members in (8, 40):
        links = simhash_dedup._similar_within(texts, keyed, 5, 0.8, members).distinct().collect()
        assert {tuple(sorted((r.a, r.b))) for r in links} == similar
    assert len(used) == 2


@pytest.mark.parametrize("similarity", [0.5, 0.65, 0.8])
def test_prefixes_find_all_similar_pairs(spark, similarity):
    """Texts of any sizes and similarities, hot shingles among them, in blocks of three."""
    rng = random.Random(13)
    base = [[f"b{k}-{j}" for j in range(60)] for k in range(3)]
    rows = []
    for i in range(90):
        words = list(rng.choice(base))[: rng.randrange(8, 60)]
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    sets = {i: {tuple(w[k : k + 5]) for w in [t.split()] for k in range(len(w) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for x in sets:
        for y in sets:
            if len(sets[x] & sets[y]) >= similarity * len(sets[x] | sets[y]):
                low, high = sorted((root[x], root[y]))
                root = {i: low if r == high else r for i, r in root.items()}
    texts = spark.createDataFrame(rows, "i long, t string")
    links = simhash_dedup._tried_by_prefix(texts, texts.select("i"), 5, similarity, 3).collect()
    for r in links:
        assert len(sets[r.a] & sets[r.b]) >= similarity * len(sets[r.a] | sets[r.b])
    got = {i: i for i in sets}
    for r in links:
        low, high = sorted((got[r.a], got[r.b]))
        got = {i: low if x == high else x for i, x in got.items()}
    assert got == root and len(set(root.values())) > 5


def test_near_copies_at_the_edge_of_the_similarity_are_found(spark):
    """Pairs of different texts at J 0.8 to 0.9, a changed word here and there."""
    rng = random.Random(21)
    rows, like = [], 0
    for p in range(150):
        words = [f"w{p}-{rng.randrange(10**6)}" for _ in range(150)]
        other = words[:]
        for k in rng.sample(range(5, 145), 3):
            other[k] = f"n{p}-{k}"
        one, two = ({tuple(w[k : k + 5]) for k in range(146)} for w in (words, other))
        if 0.8 <= len(one & two) / len(one | two) <= 0.9:
            rows += [(2 * p, " ".join(words)), (2 * p + 1, " ".join(other))]
            like += 1
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_copies(frame(spark, rows)).collect()}
    assert like > 100 and sum(got[i] != i for i in got) == like == sum(got[i] == i - 1 for i in got if i % 2)


def test_bands_meet_as_often_as_their_law_says():
    rng = np.random.default_rng(8)
    for similarity in (0.3, 0.5, 0.8):
        n, shared = 1500, round(2 * 90 * similarity / (1 + similarity))
        values = np.stack([rng.integers(0, 1 << 63, 90, dtype=np.int64).view(np.uint64) for _ in range(2 * n)]).reshape(n, 2, 90)
        values[:, 1, :shared] = values[:, 0, :shared]
        keys = simhash_dedup.band_keys(values.ravel(), np.arange(2 * n + 1) * 90).reshape(n, 2, simhash_dedup.BANDS)
        met = keys[:, 0] == keys[:, 1]
        j = shared / (180 - shared)
        assert abs(met.mean() - j**simhash_dedup.ROWS) < 0.02
        assert abs(met.any(axis=1).mean() - (1 - (1 - j**simhash_dedup.ROWS) ** simhash_dedup.BANDS)) < 0.04


def test_near_copies_of_an_id_with_several_texts(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    hashes = {t: spark.createDataFrame([(t,)], "t string").select(F.xxhash64("t")).first()[0] for t in (a, b)}
    for rows in ([(1, a), (5, a), (5, b), (7, f"{b} more")], [(1, b), (5, a), (5, b), (7, f"{a} more"), (5, a)]):
        near, far = rows[0][1], rows[-1][1] if rows[-1][0] == 5 else b
        got = simhash_dedup.near_copies(frame(spark, rows)).collect()
        by = {(r.doc_id, r.text_hash): (r.component_id, r.kept) for r in got}
        assert len(got) == 4 and by[1, None] == (1, True) and by[5, hashes[near]] == (1, False)
        low = min(hashes.values()) == hashes[far]  # else it is a node behind all ids
        assert by[5, hashes[far]] == ((5, True) if low else (7, False)) and by[7, None] == ((5, False) if low else (7, True))
    alone = simhash_dedup.near_copies(frame(spark, [(5, a), (5, b)])).collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in alone] == [(5, 5, True)] * 2


def test_near_copies_whose_passages_repeat_differently(spark):
    rows = []
    for c in range(30):
        p, q = ([f"{x}{c}-{k}" for k in range(120)] for x in "pq")
        rows += [(2 * c, " ".join(p + q)), (2 * c + 1, " ".join(p * (8 if c % 2 else 20) + q))]
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_copies(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i in got}
