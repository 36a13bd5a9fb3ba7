"""Quality CRF, language id, HTML tree model: held-out accuracy, exact inference, edge cases."""
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdant.llm import html_tree as H, langid as G, quality_crf as Q
from verdant.llm.common import fold_bucket, table

SF = "/root/testdata/sf0.01"


# -- quality -------------------------------------------------------------------

def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 2, 5])
    unary, trans = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    good, expected = Q.forward_backward(unary, trans, lengths)
    at, want, pairs = 0, [], np.zeros((2, 2))
    for n in lengths:
        total, marg, pair = 0.0, np.zeros(n), np.zeros((2, 2))
        for ys in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(unary[at + i] * y for i, y in enumerate(ys)) + sum(trans[a, b] for a, b in zip(ys, ys[1:])))
            total += w
            marg += w * np.array(ys)
            for a, b in zip(ys, ys[1:]):
                pair[a, b] += w
        want += list(marg / total)
        pairs += pair / total
        at += n
    assert np.allclose(good, want) and np.allclose(expected, pairs)


def test_quality_on_the_held_out_fold(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = Q.fit(docs, labels, fold_bucket(F.col("doc_id"), 5) != 0)
    rows = (Q.with_score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
            .filter(fold_bucket(F.col("doc_id"), 5) == 0).select("quality", "score").collect())
    assert len(rows) > 50
    assert np.mean([(r.score >= 0.3) == bool(r.quality) for r in rows]) >= 0.95
    assert Q.fit(docs, labels, fold_bucket(F.col("doc_id"), 5) != 0).weights == pytest.approx(model.weights)


def test_quality_learns_from_lines_past_a_clean_lead(spark):
    """Junk that starts at line 61 is seen by the fit, and a long document's score has its own calibration."""
    rng = random.Random(4)

    def clean(n):
        return [" ".join(rng.choice(["river", "stone", "walks", "under", "early", "light"]) for _ in range(9)) + "."
                for _ in range(n)]

    def junk(n):
        return ["#### $$ ## %% @@ " + "~" * rng.randint(3, 30) for _ in range(n)]

    rows = [(i, "\n".join(clean(60) + (junk(120) if i % 2 else clean(120))), 1 - i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = Q.fit(docs, labels, F.lit(True))
    score = {r.doc_id: r.score for r in Q.with_score(docs, model).collect()}
    assert min(score[i] for i in range(0, 60, 2)) > 0.9 and max(score[i] for i in range(1, 60, 2)) < 0.1
    lines = model.scores(["\n".join(junk(50)), "\n".join(clean(50))])
    assert lines[0] < 0.1 < lines[1]


def test_letters_of_every_script_are_letters():
    classes = Q._classes()
    for line in ("\u65e5\u672c\u8a9e\u306e\u6587\u7ae0\u3067\u3059\u3001\u306f\u3044\u3002",
                 "\ud55c\uad6d\uc5b4 \ubb38\uc7a5", "\u4e2d\u6587\u53e5\u5b50", "\U00020000\U00020001"):
        own = Q.features(line, classes)[0][0]
        assert own[Q.OWN.index("symbols")] == 0 and not own[Q.OWN.index("many_symbols")]
        assert not own[Q.OWN.index("no_letters")]
    assert Q.features("\U0001f600\U0001f600", classes)[0][0][Q.OWN.index("no_letters")]
    # code points below 0x3000 have the classes that they had
    assert [int(classes[ord(c)]) for c in "aA1 #.\u00c9\u00e9\u20ac"] == [0, 1, 2, 3, 4, 5, 1, 0, 4]


def test_quality_edge_rows_and_columns(spark):
    labels = table(spark, SF, "labels")
    model = Q.fit(table(spark, SF, "documents"), labels, F.lit(True))
    schema = "doc_id long, text string, score string, __score int, id int"
    rows = [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (2, "", "x", 1, 1), (None, "\n \n", None, None, None),
            (3, "word " * 100_000, "x", 1, 1), (4, "A!! " * 500 + "\n" + "\n".join(["b"] * 3000), "x", 1, 1)]
    df = spark.createDataFrame(rows, schema)
    out = Q.with_score(df, model)
    got = out.collect()
    assert len(got) == 6 and sorted(out.columns) == sorted(df.columns) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len({round(x, 9) for x in empty}) == 1
    assert Q.with_score(df.limit(0), model).count() == 0


def test_quality_without_or_with_one_kind_of_label(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, quality int")
    s = [r.score for r in Q.with_score(docs, Q.fit(docs, none, F.lit(True))).collect()]
    assert s == pytest.approx([0.5, 0.5])
    assert all(r.score > 0.99 for r in Q.with_score(docs, Q.fit(docs, ones, F.lit(True))).collect())


# -- language -------------------------------------------------------------------

def test_language_on_the_held_out_fold(spark):
    docs = table(spark, SF, "documents")
    held = fold_bucket(F.col("doc_id"), 4) == 2
    out = G.predict(docs, G.fit(docs, ~held)).join(docs.select("doc_id", "lang"), "doc_id").filter(held).collect()
    assert len(out) > 200 and np.mean([r.lang == r.lang_pred for r in out]) >= 0.97


def test_kernel_scores_equal_the_unfolded_product():
    """P (L^T (K^-1/2 W)) is K(x, L) K^-1/2 W: the ridge fit in dual form gives the same margins."""
    flags = np.zeros(G.BINS, bool)
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdef ", k=80)) for _ in range(12)] + ["".join(rng.choices("uvwxyz ", k=80)) for _ in range(12)]
    bins = [G.ngram_bins(t, flags) for t in texts]
    assert not flags.any()
    model = G.train(bins, ["one"] * 12 + ["two"] * 12, landmarks=12)
    kernel = np.array([[len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for b in bins] for a in bins])
    gram = kernel / 12 @ kernel + 1e-2 * kernel  # all texts are landmarks: (K K/n + rK) a = K y/n
    y = np.where(np.array([0] * 12 + [1] * 12)[:, None] == np.arange(2), 1.0, -1.0)
    dual = np.linalg.solve(gram, kernel @ y / 12)
    assert np.allclose(model.scores(texts), kernel @ dual, atol=2e-2)


def test_presence_of_whole_long_texts(monkeypatch):
    flags = np.zeros(G.BINS, bool)
    text = "".join(random.Random(1).choices("abcdefgh éß日", k=5000))
    whole = G.ngram_bins(text, flags)
    monkeypatch.setattr(G, "CHUNK", 64)
    assert np.array_equal(G.ngram_bins(text, flags), whole)
    assert len(G.ngram_bins("", flags)) == 0


def test_language_fit_in_tasks_equals_one_process(spark, monkeypatch):
    """Sums of the tasks give the model of one process; many languages share the landmarks."""
    rng = random.Random(5)
    letters = [chr(0x100 + i) for i in range(400)]
    rows = [(i, "".join(rng.choices(letters[i % 40 * 10:i % 40 * 10 + 10] + [" "], k=60)), f"l{i % 40:02d}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(G, "MAX_LANDMARKS", 80)
    assert G.marked([r[2] for r in rows]).sum() == 80 and G.marked(["a", "b"] * 100, 3).sum() == 6
    model = G.fit(docs, F.lit(True))
    order = {r.doc_id: r.o for r in docs.select("doc_id", F.xxhash64("doc_id").alias("o")).collect()}
    rows.sort(key=lambda r: (r[2], order[r[0]]))
    flags = np.zeros(G.BINS, bool)
    alone = G.train([G.ngram_bins(r[1], flags) for r in rows], [r[2] for r in rows])
    assert model.languages == alone.languages and np.array_equal(model.bins, alone.bins)
    assert np.allclose(model.weights, alone.weights, atol=1e-4)
    assert [r.lang_pred == r.lang for r in G.predict(docs, model).join(docs, "doc_id").collect()].count(False) == 0


def test_language_rows_of_one_id(spark):
    """An id of very many rows teaches one text a language."""
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("the words "), F.col("id")).alias("text"),
                                    F.lit("en").alias("lang"))
    other = spark.createDataFrame([(2, "les mots", "fr")], "doc_id long, text string, lang string")
    model = G.fit(docs.union(other), F.lit(True))
    assert model.languages == ["en", "fr"] and len(model.bins) < 60


def test_language_edge_rows(spark):
    docs = spark.createDataFrame(
        [(1, "hello the world", "en", 1), (2, "bonjour le monde été", "fr", 1), (3, None, "en", 1), (4, "", None, 1),
         (5, "123 !?", "en", 1), (None, "the hello", None, 1), (1, "hello the world", "en", 1), (6, "the " * 90_000, None, 1)],
        "doc_id long, text string, lang string, score int")
    got = G.predict(docs, G.fit(docs, F.lit(True))).collect()
    assert len(got) == 8
    by = {r.doc_id: r for r in got}
    assert by[3].lang_pred == by[4].lang_pred == by[5].lang_pred == "und" and by[3].score == 0
    assert by[None].lang_pred == by[6].lang_pred == "en" and by[2].lang_pred == "fr"
    nothing = G.fit(docs, F.lit(False))
    assert {r.lang_pred for r in G.predict(docs, nothing).collect()} == {"und"}
    assert G.predict(docs.limit(0), nothing).count() == 0


# -- html -------------------------------------------------------------------------

def test_sum_product_equals_enumeration():
    rng = np.random.default_rng(3)
    parent = np.array([-1, 0, 0, 1, 1, 2, -1, 6])
    depth = np.array([0, 1, 1, 2, 2, 2, 0, 1])
    unary, edge = rng.normal(size=8), rng.normal(size=(2, 2))
    got, expected = H.sum_product(unary, edge, parent, depth)
    total, marg, pairs = 0.0, np.zeros(8), np.zeros((2, 2))
    for ys in itertools.product((0, 1), repeat=8):
        w = np.exp(sum(u * y for u, y in zip(unary, ys)) + sum(edge[ys[p], ys[i]] for i, p in enumerate(parent) if p >= 0))
        total += w
        marg += w * np.array(ys)
        for i, p in enumerate(parent):
            if p >= 0:
                pairs[ys[p], ys[i]] += w
    assert np.allclose(got, marg / total) and np.allclose(expected, pairs / total)


@pytest.fixture(scope="module")
def html_model():
    return H.train(H.labelled_pages())


def test_labels_of_unseen_layouts(html_model):
    pages = H.labelled_pages(120, 4321)
    trees = [H.parse(p)[0] for p in pages]
    x, parent, depth = H._forest(trees)
    y = np.array([bool(H.MARK.search(v.attrs)) for t in trees for v in t])
    assert ((html_model.marginals(x, parent, depth) > .5) == y).mean() >= 0.97


def article(head, paras):
    return "\n\n".join([head, *paras])


def test_pages_with_everything_around_the_article(html_model):
    paras = ["First paragraph with some words, and more of them.", "Ok.", "A & B < C — done."]
    body = "".join(f"<p>{p}</p>" for p in ("First paragraph\n with <b>some</b>\twords, and more of them.", "Ok.",
                                           "A &amp; B &lt; C &#8212; done."))
    noise = ["<nav><ul><li><a href=/a>Home</a></li></ul></nav>", "<header class='site-header'><p>Site name.</p></header>",
             "<aside class=sidebar><p>Other stories you may like today.</p></aside>",
             "<div class='cookie-notice'><p>We use cookies to improve this site for you.</p></div>",
             "<div class=advert><p>Buy our product now, it is very cheap.</p></div>",
             "<form action=/s><p>Search the site</p><input></form>", "<script>var p = '</p><p>no';</script>",
             "<section id=comments><h2>Comments</h2><div class=comment><p>I liked reading this article a lot.</p></div></section>",
             "<style>p{color:red}</style>", "<!-- <p>not this</p> -->", "<footer>&copy; 2020 by the site. All rights.</footer>"]
    for seed in range(6):
        rng = random.Random(seed)
        rng.shuffle(noise)
        for tag in ("article", "article class=post"):
            page = f"<html><head><title>T</title></head><body>{''.join(noise[:6])}<{tag}><h1>Head</h1>{body}</article>{''.join(noise[6:])}</body></html>"
            assert H.extract([page], html_model) == [article("Head", paras)], (seed, tag, page)


def test_given_pages_give_their_articles(spark, html_model):
    import html as entities
    import re
    rows = table(spark, SF, "pages").collect()
    out = {r.page_id: r for r in H.main_text(table(spark, SF, "pages"), html_model, ["page_id", "url"]).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert out[r.page_id].text == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<p><p><p>", "<script>", "<!--", "</div></div>", "<a <b <c" * 200,
                                  "<div>" * 3000 + "x", "<p title=\"a>b\">t</p>", "&nbsp;&bogus;", "<head><p>x", "<select><option>x"])
def test_broken_markup_does_not_fail(html_model, page):
    assert isinstance(H.extract([page], html_model)[0], str)


def test_html_null_repeated_empty_and_clashing(spark, html_model):
    df = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<article><p>Some text here.</p></article>", "t")],
                               "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.text) for r in H.main_text(df, html_model, ["page_id", "url"]).collect())
    assert got == [("1", ""), ("1", ""), ("None", "Some text here.")]
    assert H.main_text(df.limit(0), html_model, ["page_id"]).count() == 0


# -- pages that are not like the given ones -----------------------------------------

ARTICLE = ("The first paragraph of the article says what it is about, in a full sentence.",
           "A second paragraph goes on with details, numbers and a conclusion of its own.")
PAGES = {
    "implied": "<html><head><title>T</title><p>{0}</p><p>{1}</p>",
    "implied_article": "<html><head><title>T</title><meta charset=utf-8><article><p>{0}</p><p>{1}</p></article>",
    "button": "<body><article><p>{0}</p><button>Share<p>{1}</p></article></body>",
    "button_in_p": "<body><article><p>{0} <button>Share</p><p>{1}</p></article><p><button>x</button></p></body>",
    "svg": "<body><article><p>{0}</p><p>{1}<svg><title>i</title><path d='x'/></svg></p></article></body>",
}
NOISE = ["<section id=comments><p>I do not agree with this at all, said a reader.</p></section>",
         '<div class="advert"><p>Buy our product now, it is cheap and very good.</p></div>',
         '<div class="newsletter"><p>Sign up and get news in your mail every week.</p></div>',
         '<div class="related"><p><a href="/x">Another story that you may like</a></p></div>',
         '<div class="comments"><p>Nice text, thank you for writing it.</p><p>I liked it as well.</p></div>',
         "<aside><p>A box that stands beside the text of the page.</p></aside>"]


@pytest.fixture(scope="module")
def html_model():
    from verdant.llm import html_tree as H
    return H.train(H.labelled_pages())


@pytest.mark.parametrize("kind", PAGES)
def test_pages_with_implied_or_missing_tags(html_model, kind):
    from verdant.llm import html_tree as H
    assert H.extract([PAGES[kind].format(*ARTICLE)], html_model) == ["\n\n".join(ARTICLE)]


@pytest.mark.parametrize("noise", NOISE)
def test_noise_inside_the_article(html_model, noise):
    from verdant.llm import html_tree as H
    head = "<html><body><nav><a href=/>Home</a></nav><article><h1>A title</h1>"
    pages = [f"{head}<p>{ARTICLE[0]}</p>{noise}<p>{ARTICLE[1]}</p></article></body></html>",
             f"{head}<p>{ARTICLE[0]}</p><p>{ARTICLE[1]}</p>{noise}</article><footer>&copy; x</footer></body></html>"]
    assert H.extract(pages, html_model) == ["\n\n".join(("A title", *ARTICLE))] * 2


@pytest.mark.parametrize("page", ["<a" * 20_000, '<p x="' * 20_000, "<p x='\">" * 20_000, "<div>" * 20_000 + "</p>" * 20_000,
                                  "<ul><li><ul>" + "<blockquote>" * 20_000 + "<li>" * 20_000, "<!--" * 50_000, "<" * 200_000,
                                  "<table><tr><table>" + "<div>" * 20_000 + "<tr>" * 20_000, "<script>" * 20_000,
                                  "<button>" * 20_000 + "</button>", "<p>a" * 100_000, "</button>" * 50_000, "<title x='" * 20_000])
def test_hostile_pages_take_linear_time(page):
    import time

    from verdant.llm import html_tree as H
    began = time.monotonic()
    H.parse(page)
    assert time.monotonic() - began < 5
