"""Quality on held-out labels, pieces against a plain Viterbi and the library, page text against expected text."""

import itertools
import math
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fernlight.llm import html_text, pieces, quality
from fernlight.llm.common import column_bytes

# --- quality

GOOD = ["the", "house", "of", "and", "water", "is", "was", "green", "Tree", "river", "small", "over", "people", "stone,", "road.", "light"]


def corpus(n=1500, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD) for _ in range(rng.randrange(5, 120))]
        good = rng.random() < 0.8
        if not good:
            words = rng.choice([lambda w: [x + "$$$" for x in w], lambda w: [x.upper() + "!!" for x in w], lambda w: [w[0]] * len(w)])(words)
        docs.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, int(good)))
    return docs + [(n, None), (n + 1, ""), (n + 2, "x" * 300_000), (3, docs[3][1]), (None, "no id")], labels + [(None, 1), (n + 9, 1), (4, None)]


def frames(spark, docs, labels):
    return spark.createDataFrame([(*d, "s", 0.5, True) for d in docs], "doc_id long, text string, source string, score double, held_out boolean"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus()
    d, l = frames(spark, docs, labels)
    out = quality.score_quality(d, l).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    truth = {i: q for i, q in labels if i is not None and q is not None}
    judged = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(judged) > 150 and np.mean([a == b for a, b in judged]) > 0.97


def test_quality_learns_nothing_from_held_out_labels_or_zeros(spark):
    docs, labels = corpus(600)
    d, l = frames(spark, docs, labels)
    a = quality.train(d, l)
    b = quality.train(d, l.where(~quality.held_out(F.col("doc_id")) & (F.col("quality") == 1)))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_risk_and_gradient_are_those_of_a_plain_loop():
    rng = np.random.default_rng(6)
    p, u = rng.normal(0.5, 1, (9, 4)), rng.normal(0, 1, (13, 4))
    loss = lambda z: math.log1p(math.exp(-z))
    clamped = 0
    for trial in range(40):
        w, prior, decay = rng.normal(0, 2, 4), rng.uniform(0.2, 0.9), 0.01
        zp, zu = ([sum(a * b for a, b in zip(x, w)) for x in rows] for rows in (p, u))
        first = prior * sum(loss(z) for z in zp) / len(p)
        second = sum(loss(-z) for z in zu) / len(u) - prior * sum(loss(-z) for z in zp) / len(p)
        assert np.allclose(quality.risk_parts(w, p, u, prior), (first, second))
        clamped += second < 0

        def told(v):
            a, b = quality.risk_parts(v, p, u, prior)
            return (-b if second < 0 else a + b) + decay / 2 * (v @ v)

        steps = np.eye(4) * 1e-6
        assert np.allclose(quality.risk_gradient(w, p, u, prior, decay), [(told(w + s) - told(w - s)) / 2e-6 for s in steps], atol=1e-6)
    assert 5 < clamped < 35  # both branches


def test_fit_is_a_minimum_of_the_risk():
    rng = np.random.default_rng(7)
    good, bad = rng.normal(0.3, 0.2, (4000, 3)), rng.normal(-0.3, 0.2, (4000, 3))
    p, u = good[:2000], np.vstack([good[2000:3200], bad[:800]])
    m = quality.fit(p, u)
    w = np.append(m.weights, m.bias)
    risk = lambda v: (lambda a, b: a + max(0.0, b) + 5e-5 * (v @ v))(*quality.risk_parts(v, quality._with_one(p), quality._with_one(u), m.prior))
    assert abs(m.prior - 0.6) < 0.1 and all(risk(w + s) > risk(w) - 1e-3 for s in rng.normal(0, 0.3, (200, 4)))
    assert (m.score(good[2000:]) > 0.5).mean() > 0.95 and (m.score(bad) < 0.5).mean() > 0.95


def test_prior_is_near_the_truth():
    rng = np.random.default_rng(1)
    good, bad = (quality._with_one(rng.normal(m, 0.5, (3000, 6)).astype(np.float32)) for m in (1, -1))
    for share in (0.3, 0.6, 0.9):
        mixed = np.vstack([good[1500 : 1500 + int(1500 * share)], bad[: 1500 - int(1500 * share)]])
        assert abs(quality.estimate_prior(good[:1500], rng.permutation(mixed)) - share) < 0.08


def test_quality_without_rows(spark):
    d, l = frames(spark, [], [])
    assert quality.score_quality(d, l).count() == 0
    d, _ = frames(spark, [(1, "a"), (2, "b")], [])
    assert [r.score for r in quality.score_quality(d, l).collect()] == [0.5, 0.5]


# --- pieces


def small():
    normal = [("▁", -8.0), ("▁▁", -9.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁a", -2.0), ("▁ab", -5.5), ("aba", -6.0), ("é", -4.0), ("ba", -6.5), ("▁abab", -7.0)]
    return pieces.Pieces.build([(256 + k, p, s) for k, (p, s) in enumerate(normal)], list(range(256)), 256 + len(normal)), {p: (256 + k, s) for k, (p, s) in enumerate(normal)}


def plain(table, text, byte_ids, longest):
    if not text:
        return []
    least = min(s for _, s in table.values()) - pieces.UNKNOWN_PENALTY
    s = "▁" + text.replace("▁", "").replace(" ", "▁")
    best, back = [0.0] + [-1e300] * len(s), [None] * (len(s) + 1)
    for e in range(1, len(s) + 1):
        for k in range(min(longest, e), 0, -1):
            if (got := table.get(s[e - k : e])) and best[e - k] + got[1] > best[e]:
                best[e], back[e] = best[e - k] + got[1], (k, got[0])
        if s[e - 1] not in table and best[e - 1] + least > best[e]:
            best[e], back[e] = best[e - 1] + least, (1, None)
    out, e = [], len(s)
    while e:
        k, i = back[e]
        out += [i] if i is not None else [byte_ids[b] for b in reversed(s[e - 1].replace("", "▁").encode())]
        e -= k
    return out[::-1]


TEXTS = ["", " ", "a", "ab ab", "  abab  a", "é ▁x▁", "aba\nba\tc", "日本 \U0001f600", "b" * 50, " a" * 40, "ab", "ab"]


def encode(v, texts):
    raw, at = column_bytes(pa.array(texts, pa.string()))
    ids, counts = pieces.encode_texts(v, raw, at)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])], (ids, counts, raw, at)


def test_viterbi_is_the_plain_one():
    v, table = small()
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("ab  é\n▁c") for _ in range(rng.randrange(30))) for _ in range(300)]
    got, (ids, counts, raw, at) = encode(v, texts)
    assert got == [plain(table, t, v.byte_ids.tolist(), v.longest) for t in texts]
    back, edge = pieces.decode_ids(v, ids, counts)
    assert back.tobytes() == raw[at[0] : at[-1]].tobytes() and np.array_equal(edge, at - at[0])


@pytest.mark.skipif(not os.path.exists(pieces.DEFAULT_MODEL), reason="no vocabulary here")
def test_scores_are_the_best_for_a_real_vocabulary(spark):
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    v = pieces.read_model(pieces.DEFAULT_MODEL)
    table = {p.id_to_piece(i): (i, p.get_score(i)) for i in v.ids.tolist()}
    texts = ["Hello world, this is a test.", " It was   a bright cold day", "Größe und Übermut", "def f(x):\n\treturn x"]
    got, _ = encode(v, texts)
    for ids, t in zip(got, texts, strict=True):
        assert ids == plain(table, t, v.byte_ids.tolist(), v.longest)
        assert p.decode(ids) == t.removeprefix(" ") if not t.startswith(" ") else p.decode(ids).strip() == t.strip()
        bpe = p.encode(t)
        assert sum(p.get_score(i) for i in ids) >= sum(p.get_score(i) for i in bpe) or any(p.is_byte(i) for i in bpe)


def test_pieces_operators(spark):
    v, _ = small()
    rows = [(k, t, 1, "x") for k, t in enumerate([None, *TEXTS, "ab " * 100_000])] + [(1, "", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens string")
    encoded = pieces.encode(docs, model=v)
    assert sorted((r.doc_id, r.text) for r in pieces.decode(encoded, model=v).collect()) == sorted((i, t or "") for i, t, *_ in rows)
    out = pieces.encoded_digests(docs, model=v).collect()
    assert len(out) == len(rows) and all(r.round_trip for r in out)
    assert {r.doc_id: r.n_tokens for r in out} == {r.doc_id: len(r.ids) for r in encoded.collect()}
    assert pieces.encoded_digests(docs.limit(0), model=v).count() == 0


def test_bad_vocabularies():
    with pytest.raises(ValueError):
        pieces.Pieces.build([(256, "a▁b", -1.0)], list(range(256)), 257)


# --- pages

PAGES = [
    ("<p>One.</p><p>Two &amp; three&nbsp;four</p>", "One. Two & three four"),
    ("", ""),
    (None, ""),
    ("plain text only, a sentence of some length without a tag in it.", "plain text only, a sentence of some length without a tag in it."),
    ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav><article><header><h1>The   Title</h1></header><p>A <b>bold</b>ly set<br>text.</p><div class='ad'>Buy this.</div><aside>More</aside><p>End</p></article><footer>&copy; me</footer></body>", "The Title A boldly set text. End"),
    ("<body><header><h1>Site</h1><p>A site about all kinds of things, for all kinds of people.</p></header><main><p>Text that says something of interest, at length.</p><script>var a='<p>no</p>'</script><!-- <p>no</p> --><form><p>Your mail address, please.</p><input></form><p>More of it, as long as the first one.</p></main><section id='comments'><p>Great article, I liked it very much indeed!</p></section>", "Text that says something of interest, at length. More of it, as long as the first one."),
    ("<body><div class='cookie-notice'>We use cookies to make this site better for you.</div><div id='content'><h2>Head</h2><p>A paragraph with enough words to be one, surely.<p>Unclosed, and followed by a list that counts as well.<ul><li>First thing to know about it</li><li>Second thing to know about it</li></ul></div><div class='sidebar'><p>Popular: ten things you did not know.</p></div>", "Head A paragraph with enough words to be one, surely. Unclosed, and followed by a list that counts as well. First thing to know about it Second thing to know about it"),
    ("<article><p hidden>no</p><p style='display:none'>no</p><p>Seen, &#233;t&eacute; &lt;b&gt; &unknown; a &", "Seen, été <b> &unknown; a &"),
    ("<article><p>ok then, a text.</p><script>never ends", "ok then, a text."),
    ("<article><p>ok then, a text.</p><!-- never ends <p>no</p>", "ok then, a text."),
]


@pytest.mark.parametrize(("html", "want"), PAGES)
def test_main_text(html, want):
    assert html_text.main_text(html or "") == want


LONG = "This is a sentence of the article that is long enough to be one."
KINDS = [
    (f"<article><h1>Talk</h1><p>{LONG}</p><p>Yes.</p><p>ok</p><p>{LONG}</p><p>end</p></article><footer>&copy; x</footer>", f"Talk {LONG} Yes. ok {LONG} end"),
    ("<main>" + "".join(f"<p>{x}</p>" for x in ("roses are red", "violets are blue", "sugar")) + "</main>", "roses are red violets are blue sugar"),
    (f"<article><h2>Things</h2><ul><li>milk</li><li>bread</li></ul><p>{LONG}</p></article>", f"Things milk bread {LONG}"),
    (f"<article><p>{LONG}</p><table><tr><th>Year</th><td>1999</td></tr></table><p>{LONG}</p></article>", f"{LONG} Year 1999 {LONG}"),
    (f"<article><p>{LONG}</p><div class='ad'>{'Buy this product now, it is the best that there is. ' * 3}</div><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<main><p>{LONG}</p><section class='comments'>" + "<p>I liked this text very much indeed, it was a pleasure to read.</p>" * 30 + "</section></main>", LONG),
    (f"<main><div id='cookie-banner'><p>We use cookies to make this site better for all who read it.</p></div><p>{LONG}</p></main>", LONG),
    (f"<div><div><a href=x>Home</a> <a href=y>About</a></div><div><div>{LONG * 2}</div><div>Short one.</div><div>{LONG * 2}</div></div><div>Copyright 2024 Corp</div></div>", f"{LONG * 2} Short one. {LONG * 2}"),
    (f"<article><p><a href=x>A linked headline of the text here</a></p><p>{LONG}</p></article>", f"A linked headline of the text here {LONG}"),
]


@pytest.mark.parametrize("taught", [False, True])
@pytest.mark.parametrize(("html", "want"), KINDS)
def test_kinds_of_pages(html, want, taught):
    """Also with costs taught by pages of one template, whose short texts are all menus."""
    short, long = [html_text.shape_of(x) for x in ("menu", "Home", "about", "contact")], [html_text.shape_of(LONG * k) for k in (1, 2, 9)]
    costs = html_text.shape_costs(html_text.fit({k: (2000, 0) for k in short} | {k: (0, 2000) for k in long})) if taught else html_text.DEFAULT_COSTS
    assert html_text.main_text(html, costs) == want


def cut_value(costs, edges, side):
    return sum(abs(c) for c, s in zip(costs, side) if (c > 0) != s and c) + sum(w for a, b, w in edges if side[a] != side[b])


def test_minimum_cut_is_least():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 9)
        costs = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(rng.randrange(n), rng.randrange(n), rng.uniform(0, 2)) for _ in range(2 * n)]
        least = min(cut_value(costs, edges, s) for s in itertools.product([False, True], repeat=n))
        assert cut_value(costs, edges, html_text.minimum_cut(costs, edges)) == pytest.approx(least)


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.random()
        if kind < 0.35 and depth < 4:
            tag = rng.choice(["div", "section", "div class='sidebar'", "article", "ul", "td"])
            out.append(f"<{tag}>{random_page(rng, depth + 1)}</{tag.split()[0]}>")
        elif kind < 0.5:
            out.append(rng.choice(["bare text", "Bare text of a sentence, with an end."]))
        else:
            words = " ".join(rng.choice(["word", "other", "Thing"]) for _ in range(rng.choice([1, 2, 5, 12, 60])))
            out.append(rng.choice(["<p>{}.</p>", "<p>{}</p>", "<li>{}</li>", "<h2>{}</h2>", "<p><a href='x'>{}</a></p>"]).format(words))
    return "".join(out)


def graph_of(html):
    blocks = html_text.blocks_of(html)
    return [html_text.cost_of(x) + html_text.tie_of(x.node) for x in blocks], html_text.edges_of(blocks)


def test_page_labels_are_those_of_least_cost():
    rng, tried, moved = random.Random(11), 0, 0
    while tried < 150:
        costs, edges = graph_of(random_page(rng))
        if not 3 <= len(costs) <= 11:
            continue
        costs = [c + rng.uniform(-1, 1) for c in costs]
        best = min(itertools.product([False, True], repeat=len(costs)), key=lambda s: cut_value(costs, edges, s))
        got = html_text.minimum_cut(costs, edges)
        assert got == list(best)
        tried, moved = tried + 1, moved + sum((c > 0) != s for c, s in zip(costs, got))
    assert moved > 50  # labels that the neighbours decide


def test_elimination_leaves_nothing_of_a_page():
    rng = random.Random(12)
    for _ in range(200):
        costs, edges = graph_of(random_page(rng) + random_page(rng))
        near = [{} for _ in costs]
        for a, b, w in edges:
            near[a][b] = near[b][a] = near[a].get(b, 0.0) + w
        assert len(html_text._eliminate(costs, near)) == len(costs)


def test_undecided_blocks_take_linear_time():
    rng, n = random.Random(13), 50_000
    costs = [rng.uniform(-0.3, 0.3) for _ in range(n)]
    edges = [(k - 1, k, rng.uniform(0.5, 1.5)) for k in range(1, n)] + [(k - 2, k, 0.2) for k in range(2, n, 2)]
    start = time.monotonic()
    side = html_text.minimum_cut(costs, edges)
    assert time.monotonic() - start < 5 and sum((c > 0) != s for c, s in zip(costs, side)) > n // 10


def test_shapes_are_fitted(spark):
    counts = {html_text.shape_of("word " * 40 + "end."): (1, 30), html_text.shape_of("menu"): (50, 2), html_text.shape_of("Some words of text."): (3, 9)}
    w = html_text.fit(counts)

    def risk(w):
        total, rest = np.array(list(counts.values())).sum(axis=0), html_text.RIDGE / 2 * ((w - html_text.PRIOR) ** 2).sum()
        share = min(html_text.WEIGH_AS, total.min()) / total
        for shape, (bad, good) in counts.items():
            z = w[html_text._parts(shape)].sum()
            rest += np.log1p(np.exp(z)) * bad * share[0] + np.log1p(np.exp(-z)) * good * share[1]
        return rest

    for k in range(len(w)):
        step = np.eye(len(w))[k] * 1e-4
        assert abs(risk(w + step) - risk(w - step)) / 2e-4 < 1e-4
    assert html_text.fit({}).tolist() == html_text.PRIOR and html_text.fit({3: (5, 0)}).tolist() == html_text.PRIOR
    pages = spark.createDataFrame([(k, "u", "<nav><p>Menu</p></nav><article><p>A sentence that says something of interest, at some length.</p></article>") for k in [1, 2, 2, None]], "page_id long, url string, html string")
    assert html_text.train(pages, sample=2) == html_text.train(pages.where("page_id > 0")) != html_text.DEFAULT_COSTS
    assert html_text.train(pages.limit(0)) == html_text.DEFAULT_COSTS


def test_page_rows(spark):
    rows = [(k, f"u{k}", h, "x", 1) for k, (h, _) in enumerate(PAGES)] + [(0, None, PAGES[0][0], "x", 1), (99, "u", "<article>" + "<p>A long page, of many parts.</p>" * 5000, "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    out = html_text.extract_main_text(pages).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    by = {r.page_id: r.text for r in out}
    assert all(by[k] == want for k, (_, want) in enumerate(PAGES)) and by[99].count("many") == 5000
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def test_deep_and_unbalanced_pages_take_linear_time():
    text = "A sentence that is long enough to be part of the article."
    for page in ("<div>" * 30_000 + f"<p>{text}</p>" + "</section>" * 30_000, f"<article><p>{text}</p>" + "<li>x" * 20_000 + "</article>", "<" * 50_000 + f"<p>{text}</p>", f"<article><p>{text}</p>" + "<a href='" * 2_000):
        assert text in html_text.main_text(page)
