"""Quality, HTML extraction and language model against plain versions and held-out truth."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import class_lm, html_text, quality
from tests.llm.test_text_ops import awkward, docs_of

SMALL = "/root/testdata/sf0.001"
DATA = "/root/testdata/sf0.01"


# --- quality -----------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scores(docs, quality.fit(docs, labels)).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.95


def test_quality_does_not_read_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = [r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    other = spark.createDataFrame([(r["doc_id"], 1 - r["quality"] if r["doc_id"] in held else r["quality"], 0) for r in labels.collect()], "doc_id long, quality int, toxic int")
    assert held and np.allclose(quality.fit(docs, labels), quality.fit(docs, other))


def test_sparse_features_by_definition():
    index, value = quality.features("The the THE!! a1 | |")
    assert len(index) == len(value) == 6 + 5 + 6 + 5 + 4 and math.isclose(value[:6].sum(), 1.0)
    assert index[0] == index[1] and quality.shape("THE!!x9") == "A!a0"
    assert len(quality.features(None)[0]) == len(quality.features(" \n")[0]) == 0


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    w = quality.fit(awkward(spark), labels)
    rows = quality.scores(awkward(spark), w).collect()
    assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows) and next(r for r in rows if r["doc_id"] is None)["held_out"]
    assert quality.scores(docs_of(spark, []), w).count() == 0
    assert not quality.fit(docs_of(spark, []), labels).any()


# --- HTML --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>A title</title><style>p{}</style><script>var x = "</p><p>no</p>";</script></head>
<body><header><div class=logo>Site name</div></header><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice">We use cookies &amp; more.</div><div id='sidebar'><h3>Popular</h3><p>Something else that is read.</p></div>
<article><h1>The &quot;real&quot;   title</h1><p>First <b>bold</b>face &lt;tag&gt; para<br>graph, that goes on for some words.<p>Second one, not closed, with <a href="x">a link</a> inside it and more words.
<div class="ad">Buy this now.</div><p>Third&nbsp;paragraph of the text, with an <em>end</em>.</p><!-- <p>hidden</p> -->
<section class="comments"><p>bob: I liked that a lot, thank you.</p><p>eve: I did not.</p></section></article>
<form><label>Mail</label><input><button>Send</button></form><footer>&copy; Site. All rights.</footer></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_main_text(model):
    want = 'The "real" title First boldface <tag> para graph, that goes on for some words. Second one, not closed, with a link inside it and more words. Third paragraph of the text, with an end.'
    assert html_text.main_text(model, PAGE) == want


def test_pages_against_markup(spark, model):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extracted(pages, model).collect()}
    for r in pages.collect():
        found = html_text.blocks(r["html"])
        want = " ".join(b.text for b in found if "article" in b.tags)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_made_pages_held_out(model):
    rng, wrong, total = random.Random(1234), 0, 0
    for _ in range(150):
        found = html_text.blocks(html_text.template_page(rng))
        want = [b.label == "1" for b in found]
        got = html_text.decode(model, html_text.features(found))
        wrong, total = wrong + sum(a != b for a, b in zip(want, got, strict=True)), total + len(want)
    assert wrong / total < 0.05


def test_viterbi_is_the_best_sequence():
    rng = random.Random(3)
    for _ in range(50):
        m = html_text.Model({f"f{i}": rng.uniform(-2, 2) for i in range(6)}, np.array([[rng.uniform(-1, 1) for _ in "ab"] for _ in "ab"]))
        names = [[f"f{rng.randrange(6)}" for _ in range(2)] for _ in range(7)]

        def worth(y, m=m, names=names):
            return sum(sum(m.weights[x] for x in f) for f, on in zip(names, y) if on) + sum(m.moves[a, b] for a, b in zip(y, y[1:]))

        best = max(([i >> j & 1 for j in range(7)] for i in range(128)), key=worth)
        assert math.isclose(worth([int(x) for x in html_text.decode(m, names)]), worth(best))


def test_html_edges(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (3, "u", "no tags at all"), (4, "u", "<div" * 3000), (5, "u", "<article>" + "<p>word word." * 20_000), (None, "u", "<article><p>x y z.</p></article>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, x string").toDF("page_id", "url", "html", "text")
    out = html_text.extracted(df, model).collect()
    assert len(out) == 7 and out[0]["text"] == out[1]["text"] == "" and out[5]["n_chars"] == 20_000 * 11 - 1
    assert html_text.extracted(df.limit(0), model).count() == 0
    assert html_text.train([]).weights == {}


# --- language model ------------------------------------------------------------

def tokens(text):
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    return (text or "").encode().translate(low).split()


def test_base_scores(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in class_lm.corpus_scores(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter()
    for i, t in texts.items():
        if i not in held:
            counts.update([*tokens(t), None])     # None: the end
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        row, r = [*tokens(t), None], rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(row), sum(counts[w] > 0 for w in row), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in row), rel_tol=1e-9)
    some = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some)   # classes tell more than counts


def test_scores_do_not_depend_on_where_words_are_held(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = []
    for known in (1_200, 10**6):      # most words met in the join, or none
        model, counts = class_lm.fit(docs, known=known)
        out.append({r["doc_id"]: r["score"] for r in class_lm.scores(docs, model, counts).collect()})
    assert all(math.isclose(out[0][i], out[1][i], rel_tol=1e-9) for i in out[0])


def likelihood(pairs, of):
    n = max(of) + 1
    table = np.zeros((n, n))
    np.add.at(table, (np.repeat(of, len(of)), np.tile(of, len(of))), pairs.ravel())
    return class_lm._xlogx(table).sum() - class_lm._xlogx(table.sum(0)).sum() - class_lm._xlogx(table.sum(1)).sum()


def test_exchange_moves_uphill_and_ends_at_the_top():
    rng = np.random.default_rng(5)
    pairs = rng.poisson(0.3, (26, 26)).astype(float)
    pairs[:12, 12:24] += rng.poisson(3, (12, 12))       # two kinds of words that alternate
    pairs[12:24, :12] += rng.poisson(3, (12, 12))
    of = class_lm.exchange(pairs, 24, 3, sweeps=30)
    assert list(of[24:]) == [3, 4]
    best = likelihood(pairs, of)
    assert best > likelihood(pairs, np.concatenate([np.arange(24) % 3, [3, 4]]))
    for w in range(24):
        for c in range(3):
            other = of.copy()
            other[w] = c
            assert likelihood(pairs, other) <= best + 1e-6


def test_words_behind_the_core_move_uphill():
    rng = np.random.default_rng(9)
    groups, words_, counted = 4, 30, []
    pairs = rng.poisson(0.6, (words_, words_)).astype(float)
    of = np.concatenate([np.arange(12) % groups, np.full(words_ - 13, groups), [groups + 1]])     # 12 placed, 17 not yet, the end
    np.fill_diagonal(pairs, 0)
    table = np.zeros((groups + 2, groups + 2))
    np.add.at(table, (np.repeat(of, words_), np.tile(of, words_)), pairs.ravel())
    for w in range(12, 29):
        after, before = np.bincount(of, pairs[w], groups + 2), np.bincount(of, pairs[:, w], groups + 2)
        counted += [(w - 12, c, n) for c, n in enumerate([*after, *before]) if n]
    got = class_lm.best_classes(table, groups, *(np.array(x) for x in zip(*counted)))
    for w, c in zip(range(12, 29), got):
        worth = [likelihood(pairs, np.where(np.arange(words_) == w, b, of)) for b in range(groups)]
        assert worth[c] >= max(worth) - 1e-5


def test_scores_equal_a_plain_class_model(spark):
    """Classes as found; transitions, emissions and scores counted word by word."""
    texts = {r["doc_id"]: tokens(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    learnt = {i: t for i, t in texts.items() if i % 4}
    df = spark.createDataFrame([(i, b" ".join(t).decode()) for i, t in texts.items()], "doc_id long, text string")
    model, rest = class_lm.fit(df.filter("doc_id % 4 <> 0"), frequent=300, classes=8, known=900)
    of = {w: int(model.word_class[i]) for w, i in model.words.known.items()}
    of |= {bytes(r["word"]): r["class"] for r in rest.collect()}
    counts = Counter(w for t in learnt.values() for w in t)
    assert set(of) == set(counts) and len(model.words.known) < len(of) and set(of.values()) <= set(range(8))   # every known word has a Brown class
    once, n = sum(c == 1 for c in counts.values()), sum(counts.values()) + len(learnt)
    table = np.zeros((10, 10))
    for t in learnt.values():
        row = [9, *(of[w] for w in t), 9]
        np.add.at(table, (row[:-1], row[1:]), 1)
    table[:, 8], table[8] = table.sum(1) * once / n, table.sum(0) * once / n
    table[8, 8] = once * once / n
    moves = (table + 0.5) / (table + 0.5).sum(1, keepdims=True)
    sizes = Counter()
    for w, c in counts.items():
        sizes[of[w]] += c + 0.5
    scored = {r["doc_id"]: r["score"] for r in class_lm.scores(df, model, rest).collect()}
    for i, t in texts.items():
        row = [9, *(of.get(w, 8) for w in t), 9]
        words_ = [(counts[w] + 0.5) / sizes[of[w]] if w in of else 1 / (once + 1) for w in t]
        plain = sum(map(math.log10, words_)) + sum(math.log10(moves[a, b]) for a, b in zip(row, row[1:]))
        assert math.isclose(scored[i], plain, rel_tol=1e-9)


def test_probabilities_add_up(spark):
    model, _ = class_lm.fit(docs_of(spark, ["a b c a b", "b c a", None, "d"]), frequent=2, classes=2, known=3)
    assert np.allclose((10 ** model.moves).sum(1), 1)


def test_lm_edges(spark):
    rows = class_lm.corpus_scores(awkward(spark)).collect()
    assert len(rows) == 8 and all(r["n_tokens"] >= 1 and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert class_lm.corpus_scores(docs_of(spark, [])).count() == 0
    model, counts = class_lm.fit(docs_of(spark, []))
    alone = class_lm.scores(docs_of(spark, ["a b"]), model, counts).collect()[0]
    assert alone["base_score"] == 0 and alone["n_known"] == 0 and alone["train_tokens"] == 0


def test_html_elements_do_not_swallow_what_follows():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    for tag in ("<svg-icon name='x'></svg-icon>", "<object-x>", "<template-card/>", "<svg width='1'/>", "<math/>", "<object data='x'>", "<canvas id=c>", "<script src='x'/>", "<style-box>", "<script async/>"):
        assert "the whole article" in " ".join(texts(f"<article>{tag}<p>the whole article</p></article>")), tag
    assert texts("<p>a</p><script>x < 1 </p></script ><style media=a>b</style><p>c</p>") == ["a", "c"]
    assert texts("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold</p>") == ["let x=1 hold"]
    found = html_text.blocks("<noscript><p>plain</p></noscript><object><p>instead</p></object><svg><path d='M0'/><text>icon</text></svg><p>after</p>")
    assert [b.text for b in found] == ["plain", "instead", "icon", "after"]
    assert [[t for t in b.tags if t != "p"] for b in found] == [["noscript"], ["object"], ["svg", "text"], []]
    assert "in=svg" in html_text.features(found)[2]


def test_html_names_that_training_never_saw(model):
    """Comments, notices and sidebars go by where they stand and how they repeat; a list of links in the article stays."""
    text = ["The title of it", "First paragraph of the article that goes on for a number of words here.", "Second paragraph, also of some length, and with words.",
            "One further reading", "Another page", "Third."]
    inner = (f"<h1>{text[0]}</h1><p>{text[1]}</p><p>{text[2]}</p><ul><li><a href=/x>{text[3]}</a></li><li><a href=/y>{text[4]}</a></li></ul><p>{text[5]}</p>")
    flat = "<p>bob: I liked that a lot, thank you.</p><p>eve: I did not like it, no.</p>"
    parts = "<div class=one><b>bob</b><p>I liked that a lot, thank you.</p></div><div class=one><b>eve</b><p>I did not.</p></div>"
    top = "<body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
    for name in ("story-reactions", "thread", "user-posts", "qx3", "kommentare"):
        for wrap in ("<article>{}</article>", "<main>{}</main>", "<div class='content'>{}</div>", "<div class='zz'>{}</div>"):
            for said in (flat, parts):
                page = f"{top}{wrap.format(inner)}<div class='{name}'>{said}</div><footer>&copy; Site</footer></body>"
                assert html_text.main_text(model, page) == " ".join(text), (name, wrap, said)
        for wrap in ("<article>{}</article>", "<main>{}</main>"):
            page = f"{top}<div class='{name}'>This site keeps small files on your device.</div>{wrap.format(inner)}<div class='{name}'><h3>Also</h3><p>Something else to read here.</p></div></body>"
            assert html_text.main_text(model, page) == " ".join(text), (name, wrap)


@pytest.mark.parametrize("part", ["<div>a", "<b>x", "<a ", "<ul><li>x<div>", "<p title=\"a'>", "<script ", "</i>x</em>", "<!--", "<x-{}>a", "<div class='n{} m'>a"])
def test_html_time_grows_with_the_page(part):
    """Deep nesting, tags that never end and stray end tags: no more than in proportion, and nothing is lost."""
    def seconds(n):
        page = "".join(part.replace("{}", str(i)) for i in range(n))
        start = time.process_time()
        found = html_text.blocks(page)
        html_text.features(found)
        return time.process_time() - start, found

    small, _ = seconds(10_000)
    large, found = seconds(80_000)
    assert large < 8 * 4 * max(small, 0.05)
    if part in ("<div>a", "<x-{}>a"):
        assert [b.text for b in found] == ["a"] * 80_000


def test_html_unfinished_comment_and_script_go_to_the_end():
    assert [b.text for b in html_text.blocks("<p>a</p><!-- <p>b</p> and so on")] == ["a"]
    assert [b.text for b in html_text.blocks("<p>a</p><script>x > 1; and so on")] == ["a"]
    assert [b.text for b in html_text.blocks("<p>a</p> and so on < 3")] == ["a", "and so on < 3"]


def test_html_trains_on_whole_pages():
    names = [["a"]] * 400 + [["b"]] * 40
    model = html_text.train([(names, [0] * 400 + [1] * 40), ([["a"]] * 3, [0, 0, 0])])
    assert html_text.decode(model, names) == [False] * 400 + [True] * 40
