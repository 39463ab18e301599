"""Main text of pages against the articles they were built from."""

import html
import random
import re
import zlib

import pytest

from clipstat.llm import templates
from tests.llm.helpers import load, needs_tables

SCHEMA = "page_id long, url string, html string"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()


def article(rng, n=4):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 30))) for _ in range(n)]


def page(rng, blocks, rest=""):
    nav = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in rng.sample(WORDS, 4))
    return (f"<!DOCTYPE html><html><head><title>x &amp; y</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<header class='site'><h2>Our site</h2></header><nav><ul>{nav}</ul></nav><div class=\"ad\">Buy {rng.choice(WORDS)}</div>"
            f"<div id='cookie-notice'>We use cookies</div>" + rest.replace("ARTICLE", "".join(f"<p>{html.escape(b)}" for b in blocks)) +
            "<aside>See also</aside><form><input name=q><button>Go</button></form>"
            "<div class='comments'><p>First!</p></div><footer>&copy; us</footer></body></html>")


def texts(spark, rows, **options):
    return {r["page_id"]: r["text"] for r in templates.extract(spark.createDataFrame(rows, SCHEMA), **options).collect()}


@pytest.mark.parametrize("shell", ["<article>ARTICLE</article>", "<main><div>ARTICLE</div></main>", "<div class='body'>ARTICLE</div>",
                                   "<div itemprop='articleBody'>ARTICLE</div>"])
def test_article_of_every_page(spark, shell):
    rng = random.Random(1)
    blocks = {i: article(rng) for i in range(30)}
    rows = [(i, f"http://h{i % 2}.org/{i}", page(rng, b, shell)) for i, b in blocks.items()]
    assert texts(spark, rows) == {i: "\n".join(b) for i, b in blocks.items()}


def test_one_page_or_equal_pages_lose_nothing(spark):
    rng = random.Random(2)
    b = article(rng)
    source = page(rng, b, "<article>ARTICLE</article>")
    rows = [(0, "http://one.org/", source)] + [(i, "http://same.org/", source) for i in range(1, 9)]
    assert set(texts(spark, rows).values()) == {"\n".join(b)}


def test_shared_paragraphs_stay(spark):
    rng = random.Random(3)
    shared = "this passage is on every page of the host"
    blocks = {i: [shared, *article(rng), shared] for i in range(12)}
    rows = [(i, "http://h.org/", page(rng, b, "<article>ARTICLE</article>")) for i, b in blocks.items()]
    assert texts(spark, rows) == {i: "\n".join(b) for i, b in blocks.items()}


def test_template_words_outside_an_article_go(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(10):
        b = article(rng)
        want[i] = "\n".join(b)
        rows.append((i, "http://h.org/", page(rng, b, "<div class='x'>Welcome dear reader</div><div class='y'>ARTICLE</div>")))
    assert texts(spark, rows) == want


def test_blocks_of_the_host_inside_main_go_whatever_their_class(spark):
    rng = random.Random(6)
    blocks = {i: article(rng) for i in range(20)}
    shell = ("<main><div class='c1'><ul><li>Start</li><li>Arkiv</li></ul></div><div class='x7f3'>Kjøp nå</div><div class='c2'>ARTICLE</div>"
             "<div class='c1'>Kontakt</div></main>")
    rows = [(i, "http://h.org/", page(rng, b, shell)) for i, b in blocks.items()]
    assert texts(spark, rows) == {i: "\n".join(b) for i, b in blocks.items()}


def test_section_of_one_article_stays_under_a_listed_word(spark):
    rng = random.Random(8)
    blocks = {i: article(rng) for i in range(20)}
    rows = [(i, "http://h.org/", page(rng, b, f"<article>ARTICLE{'<section class=related>Own section</section>' if i == 3 else ''}"
                                      f"<div class='share'>Send {i}</div></article>")) for i, b in blocks.items()]
    assert texts(spark, rows) == {i: "\n".join(b + ["Own section"] * (i == 3)) for i, b in blocks.items()}


def test_references_and_white_space(spark):
    body = "<article><h1>A &amp;amp; B</h1><p>x&nbsp;&nbsp;y\n\t z<b>w</b>v<br>u &lt;p&gt; &#233;&#x1F600; &copy &unknown;</p><p> </p><p>a < b</article>"
    assert texts(spark, [(1, "http://h.org/", body)]) == {1: "A &amp; B\nx y zwv u <p> é😀 © &unknown;\na < b"}


AWKWARD = [(1, None, None), (2, "http://a.org/", ""), (3, "", "no tags at all"), (4, "http://a.org/", "<article"), (5, "http://a.org/", "<p>open <div"),
           (6, "http://a.org/", "</div></p><article>x</div></article>"), (7, None, "<script>never closed"), (8, "x", "<!-- never closed"),
           (9, "http://a.org/", "<nav><article>in an open nav</article>"), (10, "http://a.org/", "<article>" + "<div>" * 3000 + "deep"),
           (None, "http://a.org/", "<article>no id</article>"), (11, "http://b.org/", "<article>" + "long words " * 100_000 + "</article>")]


def test_awkward_pages(spark):
    df = spark.createDataFrame(AWKWARD * 2, SCHEMA).repartition(3)
    got = templates.extract(df.withColumnRenamed("html", "html").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS _host", "4 AS _lot")).collect()
    assert len(got) == 2 * len(AWKWARD)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == by_id[4] == by_id[7] == by_id[8] == "" and by_id[3] == "no tags at all" and by_id[6] == "x"
    assert by_id[9] == "in an open nav" and by_id[10] == "deep" and by_id[None] == "no id" and len(by_id[11]) == 11 * 100_000 - 1
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_empty_table(spark):
    assert templates.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("group", [8, 20, 128])
def test_groups_give_the_same_articles(spark, group):
    """Also where the article has no element of its own: each group is large enough for a template."""
    for shell in ("<article>ARTICLE</article>", "<main><div class='q'>Alltid her</div><div>ARTICLE</div></main>", "<div class='y'>ARTICLE</div>"):
        rng = random.Random(5)
        blocks = {i: article(rng) for i in range(80)}
        rows = [(i, "http://hot.org/", page(rng, b, shell)) for i, b in blocks.items()]
        assert texts(spark, rows, group_pages=group) == {i: "\n".join(b) for i, b in blocks.items()}


def test_length_and_partitions_do_not_choose_the_template(spark):
    """Very long pages of a host lose its menu and copyright line like short ones, whatever the partitions."""
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(8):
        b = [" ".join(rng.choice(WORDS) + str(rng.randrange(10 ** 6)) for _ in range(40_000))]
        want[i] = b[0]
        rows.append((i, "http://long.org/", page(rng, b, "<div class='m'>Meny og kontakt</div><div class='y'>ARTICLE</div><div class='z'>Copyright us</div>")))
    old, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(texts(spark, rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == want


LISTED = "<ul><li>first point</li><li>second point</li></ul><table><tr><td>7</td></tr></table>"


def test_lists_of_the_article_stay(spark):
    """On half of the pages and on all of them, with the same text."""
    for every in (1, 2):
        rng = random.Random(10)
        blocks = {i: article(rng) for i in range(12)}
        rows = [(i, "http://h.org/", page(rng, b, f"<article>ARTICLE{LISTED if i % every == 0 else ''}</article>")) for i, b in blocks.items()]
        assert texts(spark, rows) == {i: "\n".join(b + ["first point", "second point", "7"] * (i % every == 0)) for i, b in blocks.items()}


def test_sections_on_half_of_the_pages_stay(spark):
    rng = random.Random(11)
    blocks = {i: article(rng) for i in range(12)}
    rows = [(i, "http://h.org/", page(rng, b, f"<article>ARTICLE{'<section><p>method as before</p></section><div>data as before</div>' if i % 2 else ''}</article>"))
            for i, b in blocks.items()]
    assert texts(spark, rows) == {i: "\n".join(b + ["method as before", "data as before"] * (i % 2)) for i, b in blocks.items()}


def test_menus_with_changing_links_go_without_a_listed_word(spark):
    rng = random.Random(12)
    rows, want = [], {}
    for i in range(12):
        b = article(rng)
        links = "".join(f"<li><a href=/{w}>{w} {i}</a></li>" for w in rng.sample(WORDS, 3))
        want[i] = "\n".join([*b, f"with a link {i} inside"])
        rows.append((i, "http://h.org/", page(rng, b, f"<main><div class=k9><ul>{links}</ul></div><div class=t>ARTICLE<p>with a <a href=/x>link {i}</a> inside</div></main>")))
    assert texts(spark, rows) == want


def test_without_the_template_neutral_pages_keep_their_menu(spark, monkeypatch):
    """The deduced template is what drops: with none in its place the same pages keep all of the main region."""
    rng = random.Random(13)
    blocks = [article(rng) for _ in range(10)]
    shell = "<main><div class='c1'><ul><li>Start</li><li>Arkiv</li></ul></div><div class='c2'>ARTICLE</div></main>"
    sources = [zlib.compress(page(rng, b, shell).encode()) for b in blocks]
    assert list(templates.extract_group(sources)) == ["\n".join(b) for b in blocks]
    monkeypatch.setattr(templates, "template", lambda pages: (set(), set()))
    assert list(templates.extract_group(sources)) == ["\n".join(["Start", "Arkiv", *b]) for b in blocks]


def plain_template(pages):
    """Tokens on every page exactly once whose order is the same on all pages, by pairs; and of the others none
    that is on fewer than half of the pages."""
    every = [t for t in dict.fromkeys(pages[0]) if all(p.count(t) == 1 for p in pages)]
    agree = {t: sum(all((p.index(t) < p.index(u)) == (pages[0].index(t) < pages[0].index(u)) for p in pages) for u in every) for t in every}
    return {t for t in every if agree[t] == len(every)}, {t for p in pages for t in p if 2 * sum(t in q for q in pages) >= len(pages)}


@pytest.mark.parametrize("seed", range(10))
def test_template_against_pairs(seed):
    rng = random.Random(seed)
    pages = []
    for i in range(6):
        tokens = [f"s{k}" for k in range(8)]
        if seed % 2 and i == 3:
            a = rng.randrange(7)
            tokens[a], tokens[a + 1] = tokens[a + 1], tokens[a]
        for _ in range(rng.randrange(12)):
            tokens.insert(rng.randrange(len(tokens) + 1), f"w{rng.randrange(30)}{i}")
        for _ in range(i % 3):
            tokens.insert(rng.randrange(len(tokens) + 1), "again")
        pages.append(tokens)
    known, steady = templates.template(pages)
    sure, half = plain_template(pages)
    assert sure <= known <= half
    assert steady == {t for t in set(pages[0]) if len({p.count(t) for p in pages}) == 1}


def test_classes_are_ordered_and_nested():
    pages = [[(0, "<a"), (0, "<b"), (0, f"w{i}"), (0, "<c"), (0, "stop"), (0, "<d")] + [(0, "<li"), (0, f"x{i}"), (0, "</li")] * (i + 1) for i in range(4)]
    pages[3][0], pages[3][1] = pages[3][1], pages[3][0]  # <a and <b change places on one page
    known, _ = templates.template(pages)
    assert {(0, "<c"), (0, "stop"), (0, "<d"), (0, "<li"), (0, "</li")} <= known
    assert not {(0, "<a"), (0, "<b")} <= known and not any(t[1].startswith(("w", "x")) for t in known)


@needs_tables
def test_whole_table(spark):
    """The generator's pages hold one article each; its text by a regular expression."""
    df = load(spark, "pages")
    got = {r["page_id"]: r["text"] for r in templates.extract(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
