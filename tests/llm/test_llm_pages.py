"""Main text of pages and toxicity scores."""

import random
import zlib
from pathlib import Path

import numpy as np
import plain
import pytest

from sediment.llm import html_text, queries, toxicity

FOLDER = "/root/testdata/sf0.001"

ARTICLE = "<article><h1>A  title</h1><p>One &amp; <b>two</b>three<br>four &lt;x&gt;<p>five<!-- no --><ul><li>six<li>seven</ul></article>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "given, want",
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        (page(ARTICLE), "A title One & twothree four <x> five six seven"),
        (page(f"<nav><a>menu</a></nav><header>head</header>{ARTICLE}<footer>&copy; f</footer>"), "A title One & twothree four <x> five six seven"),
        (page('<article><p>in</p><div class="ad box">buy</div><aside>s</aside><form>f</form><div id=comments><p>c</div></article>'), "in"),
        (page('<article><script>var t="</p>";x(1<2)</script><p a="1>2" b=\'"\'>text</p></article>'), "text"),
        (page('<div class="cookie-notice">ok?</div><p>no article</p><section role="complementary">s</section>'), "no article"),
        ("<article><p>cut off <b>here", "cut off here"),
        ("<article><p>a < b && c</p></article>", "a < b && c"),
        ("<article><p>x</p><p class=\"adult\">y</p></article><p>after</p>", "x y"),
        ("<main><p>m</p></main><div>rest</div>", "m"),
        ("<article><p>one\n\ttwo&nbsp;three</p>\n\n</article><!-- open", "one two three"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><pre> d\n e </pre></article>", "a b c d e"),
    ],
)
def test_main_text(given, want):
    assert html_text.main_text(given) == want


@pytest.mark.parametrize("wrapper", ["div class='container has-sidebar'", "div class=no-sidebar", "div class='layout-with-menu'", "body class=share-enabled", "div class=widget", "form method=post"])
def test_what_holds_the_page_stays(wrapper):
    tag = wrapper.split()[0]
    rest = "<div class=sidebar>aside</div><nav>menu</nav><div id=comments>first! " + "blah " * 50 + "</div>"
    for text in ("<article><p>the text</p></article>", "<main>the text</main>", "<p>the text</p>"):
        assert html_text.main_text(f"<{wrapper}>{text}{rest}</{tag}><footer>f</footer>") == "the text"


@pytest.mark.parametrize("section", ["section id=discussion", "section id='related-work'", "div class='page-header'", "section id=notice", "section id='has-menu'"])
def test_sections_of_an_article_stay(section):
    given = f"<article><p>one</p><{section}><p>two</p></{section.split()[0]}><p>three</p></article>"
    assert html_text.main_text(given) == "one two three"


@pytest.mark.parametrize("name", ["ad", "cookie-notice", "sidebar-left", "x comment-list", "comment-12", "site-footer", "share-buttons", "post_comments"])
def test_names_of_other_parts_go(name):
    assert html_text.main_text(f"<div class='{name}'>a <b>b</b></div><p>the whole text of this page</p>") == "the whole text of this page"
    assert html_text.main_text(f"<article><p>the whole text</p><div class='{name}'>long " + "words " * 9 + "</div></article>") == "the whole text"


TEXT = "<p>" + "a long story " * 20 + "</p>"
STORY = ("a long story " * 20).strip()


@pytest.mark.parametrize(
    "given, want",
    [
        (f"<div class=content>{TEXT}</div><article class=comment>nice</article><article id=comment-7 class='by-guest'>me too</article>", STORY),
        (f"<div class=content>{TEXT}</div><article class=card><h3>Read also</h3></article>", STORY + " Read also"),
        (f"<article>{TEXT}<article class='comment depth-1'>nice</article></article><p>after</p>", STORY),
        (f"<article>{TEXT}</article><article class='comment'>{TEXT}{TEXT}</article>", STORY),
        (f"<article class='post has-comments'>{TEXT}</article><div><a>{STORY} {STORY}</a></div>", STORY),
        (f"<main><p>short</p></main><div>{TEXT}</div>", "short"),
        (f"<div><p>before</p></div><article role=complementary>{TEXT[:30]}</article><article>{TEXT}</article>", STORY),
    ],
)
def test_articles_that_are_comments_or_cards(given, want):
    assert html_text.main_text(page(given)) == want


def test_templates_of_a_site_go_and_articles_stay(spark, frame):
    rows = []
    for i in range(40):
        teaser = "<div><p>Read our magazine</p><span>every week</span></div>"
        body = f"{teaser}<div><p>story {i} of this site</p></div><div><p>same line</p></div>"
        rows.append((i, f"https://User@News.example.com:80/{i}", page(body)))
        rows.append((100 + i, f"http://other.example.com/{i}", page(f"<article><p>common opening</p><p>text {i}</p><div>more of this site</div></article>")))
    rows += [(200 + i, "http://copies.example.com/", page("<div><p>copied page</p></div>")) for i in range(30)]
    rows += [(300, None, page("<p>no host</p>")), (301, "not a url", None), (300, None, page("<p>no host</p>"))]
    df = frame("page_id long, url string, html string, host string, text string", *((*r, "h", "t") for r in rows))
    got = {}
    for r in html_text.extract_text(df).collect():
        got.setdefault(r.page_id, []).append((r.url, r.text))
        assert r.n_chars == len(r.text)
    assert len(got) == 40 + 40 + 30 + 2 and len(got[300]) == 2
    assert got[7][0][1] == "story 7 of this site"
    # Inside an article only what looks like a widget goes.
    assert got[107][0][1] == "common opening text 7"
    # Copies of one page are one page.
    assert got[200][0][1] == "copied page" and got[300][0] == (None, "no host") and got[301][0] == ("not a url", "")
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_recurring_inline_elements_headings_and_paragraphs_stay(spark, frame):
    rows = []
    for i in range(40):
        note = "<div><p>read on</p></div>" if i % 8 == 0 else ""
        text = f'<h2>Ingredients</h2><p>He did <em>not</em> go to <a href="/x">Rome</a> {i}</p><p>Serve <code>hot</code>.</p>{note}'
        rows.append((i, f"http://cook.example.com/{i}", page(f"<div>our site</div><div id=content>{text}</div>")))
    got = {r.page_id: r.text for r in html_text.extract_text(frame("page_id long, url string, html string", *rows)).collect()}
    # A container on a few pages stays too, one on all of them is the site's.
    assert got == {i: f"Ingredients He did not go to Rome {i} Serve hot." + " read on" * (i % 8 == 0) for i in range(40)}


def test_a_long_broken_page_takes_linear_time():
    assert html_text.main_text("<a href='" * 20_000 + "x") is not None
    deep = html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000)
    assert deep == "deep"


def labelled(n, seed):
    r = random.Random(seed)
    syllables = "ta ri mo ke lu san der vi po wen".split()
    made = []
    for i in range(n):
        text = ["".join(r.choice(syllables) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(1, 150))]
        toxic = r.random() < 0.3
        for _ in range(r.randrange(1, 4) if toxic else 0):
            text.insert(r.randrange(len(text) + 1), r.choice(["grumbelfink", "Schnarkzoid", "blorptwit"]))
        made.append((i, " ".join(text), int(toxic)))
    return made


def test_toxicity_of_unseen_texts_and_misspellings(spark, frame):
    made = labelled(1500, 1)
    df = frame("doc_id long, text string, score string, held_out int", *((i, t, "s", 1) for i, t, _ in made), (5000, None, "s", 1), (5001, "", "s", 1), (5001, "", "s", 1))
    labels = frame("doc_id long, quality int, toxic int", *((i, 1, y) for i, _, y in made), (None, 1, 1), (7, 1, None), (9000, 1, 1))
    got = toxicity.score_toxicity(df, labels).collect()
    assert len(got) == 1503
    truth = {i: y for i, _, y in made}
    out = [r for r in got if r.held_out and r.doc_id in truth]
    assert 200 < len(out) < 400
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    empty = {r.score for r in got if r.doc_id >= 5000}
    assert len(empty) == 1 and empty.pop() < 0.5
    model = toxicity.train([t for _, t, _ in made], [y for *_, y in made])
    odd, fine = model.score(["ta ri grumbelfinnk mo", "tari vipowen moke"])
    assert odd > 20 * fine
    # The same rows give the same scores again.
    again = {r.doc_id: r.score for r in toxicity.score_toxicity(df.repartition(7), labels).collect()}
    assert all(again[r.doc_id] == r.score for r in got)


def test_toxicity_without_both_classes(spark, frame):
    df = frame("doc_id long, text string", (1, "a"), (2, None))
    labels = frame("doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(df, labels).collect()} == {0.5}
    assert toxicity.score_toxicity(df.limit(0), labels).count() == 0


def test_the_sample_is_of_labels_with_a_usable_text(spark, frame):
    params = toxicity.ToxicityParams(sample_per_class=20, sample_max_chars=100)
    # Of 2,000 labels, 100 have a document, and half of those are too long.
    df = frame("doc_id long, text string", *((i, "word " * (50 if i % 40 else 5)) for i in range(0, 2000, 20)))
    labels = frame("doc_id long, toxic int", *((i, i // 40 % 2) for i in range(2000)))
    found = toxicity.training_sample(df, labels, params, "doc_id", "text", "toxic")
    assert all(len(t) <= 100 for t, _ in found)
    usable = [i // 40 % 2 for i in range(0, 2000, 40) if zlib.crc32(str(i).encode()) % 5]
    assert [sum(y == v for _, y in found) for v in (0, 1)] == [min(20, usable.count(v)) for v in (0, 1)]
    assert min(usable.count(v) for v in (0, 1)) > 10


def test_words_are_the_same_in_training_and_scoring():
    params = toxicity.ToxicityParams()
    found = ["Ab c-d éÜ\x00x 12", "", "...", "a" * 500]
    grams, word, text = toxicity.word_grams(found, params)
    corpus = toxicity.Corpus(found, params)
    assert np.bincount(text, minlength=4).tolist() == corpus.counts.tolist()
    sizes = np.bincount(word, minlength=len(text))
    assert sizes.tolist() == corpus.sizes[corpus.words].tolist()
    assert grams[word == 0].tolist() == corpus.grams[: corpus.begin[1]].tolist()


@pytest.mark.parametrize(("page", "want"), [
    ("<html><head><title>t</title><body><article><p>Hello there</article>", "Hello there"),
    ("<html><head><meta charset=u><link x>Words first<p>and then", "Words first and then"),
    ("<head><style>a {}</style><div>no body tag</div>", "no body tag"),
    ("<svg/><article><p>Some text</p></article>", "Some text"),
    ('<article><p>a <svg viewBox="0"/> b</p><p>c</article>', "a b c"),
    ("<article>x<svg><path d=1/><g/><text>gone</text></svg>y</article>", "xy"),
    ("<article><div/>stays in</div> and out</article>", "stays in and out"),
    ("<article><!-->one<!--->two<!-- a --!>three<!-- b -->four</article>", "onetwothreefour"),
    ("<article><math><mi>x</mi></math> <label>l</label></article>", "x l"),
])
def test_markup_by_the_rules_of_the_standard(page, want):
    assert html_text.main_text(page) == want


def made_page(r):
    """A page with what the plain version knows of, end tags left out where it may be."""
    say = lambda n: " ".join(r.choice(["word", "é", "a&amp;b", "&lt;x&gt;", "<b>bold</b>", "<a href='#'>link</a>", "<br>", "\n", "&#8212;"]) for _ in range(n))
    junk = lambda: r.choice(["<nav>menu</nav>", "<aside>side</aside>", "<script>if (a < b) x</script>", "<div class='ad'>buy</div>", "<form>f</form>", "<!-- c -->", "<svg><path/></svg>"])
    blocks = []
    for _ in range(r.randrange(1, 9)):
        blocks.append(r.choice([lambda: f"<p>{say(9)}</p>", lambda: f"<p>{say(5)}", lambda: f"<h2>{say(2)}</h2>", lambda: f"<ul><li>{say(3)}<li>{say(2)}</ul>", lambda: f"<div class='x y'>{say(6)}</div>", lambda: f"<pre>{say(4)}</pre>", lambda: f"<table><tr><td>{say(2)}</td></tr></table>", junk])())
    frame = r.choice(["<html><head><title>t</title>{}</html>", "<html><head><meta a='b'></head><body>{}</body></html>", "{}"])
    body = f"<header>top</header>{junk()}<article>{''.join(blocks)}<p>The last words of it</p></article><footer>end</footer>"
    return frame.format(f"<body>{body}</body>" if "<body>" not in frame else body)


def test_made_pages_equal_the_plain_version():
    r = random.Random(7)
    for _ in range(500):
        page = made_page(r)
        assert html_text.main_text(page) == plain.article_text(page), page


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables")
def test_the_query_equals_the_plain_version(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op3_html_extraction(spark, FOLDER).collect()}
    texts = {p.page_id: plain.article_text(p.html) for p in pages}
    assert got == {p.page_id: (p.url, texts[p.page_id], len(texts[p.page_id])) for p in pages}


def test_extra_columns_and_very_long_pages(spark, frame):
    long = "<article>" + "".join(f"<p>paragraph {i} of it</p>" for i in range(30_000)) + "</article>"
    df = frame("page_id long, url string, html string, text string, host string, template string", (1, "http://a/x", long, "t", "h", "p"), (2, None, None, None, None, None))
    got = {r.page_id: (r.n_chars, r.text[:14]) for r in html_text.extract_text(df).collect()}
    assert got == {1: (len(" ".join(f"paragraph {i} of it" for i in range(30_000))), "paragraph 0 of"), 2: (0, "")}


def test_toxicity_of_a_very_long_text_and_extra_columns(spark, frame):
    docs = [(i, ("you awful stinker " if i % 2 else "a quiet day at sea ") * 3, "s", 0.5, True) for i in range(40)]
    docs += [(100, "a quiet day at sea " * 100_000 + "you awful stinker", "s", 0.1, False), (101, None, None, None, None)]
    df = frame("doc_id long, text string, toxic string, score double, held_out boolean", *docs)
    labels = frame("doc_id long, toxic int", *((i, i % 2) for i in range(40)))
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert len(got) == 42 and got[100].predicted == 1 and got[100].score > got[101].score
