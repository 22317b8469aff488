import random
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tillwise.llm import html_text

LONG = "The quick brown fox jumps over the lazy dog and it is the end of that story for all of us, as it was before."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <header>Site</header><nav><a href=x>Home</a></nav><!-- ad --><div class="ad">Buy the best of it now and be happy with it for all of your life, as we are.</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>First&nbsp; part.<br>{LONG}<p>Short.</p><aside>Read also: {LONG}</aside>
    <form><label>Name</label><input></form><ul><li>One<li>Two</ul><section class="comments"><p>{LONG}</p></section></article>
    <div id="cookie-notice">{LONG}</div><footer>&copy; all</footer></body></html>"""
    assert html_text.main_text(page) == f"Head & line\nFirst part. {LONG}\nShort.\nOne\nTwo"


def test_page_without_article_uses_text_and_neighbours():
    links = "".join(f"<a href='/{i}'>The link to page {i} of the list</a> " for i in range(9))
    page = f"<div><p>{links}</p><p>x</p><p>Title</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p><p>{links}</p><p>end</p></div>"
    assert html_text.main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"


def test_odd_markup():
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<![odd[x]]> <article>a &lt;b&gt; &#8364; &am <p>c") == "a <b> € &am\nc"
    assert html_text.main_text("<article><p>" + "word " * 50_000 + "</article>") == ("word " * 50_000).strip()
    assert html_text.main_text("<div>" * 3000 + f"<article>{LONG}") == LONG
    assert html_text.main_text("<main><p>a<p hidden>b<p style='display: none'>c<p>d</main>") == "a\nd"


def test_query_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", f"<article>é {LONG}</article>"), (None, None, None), (1, "u", "")], "page_id long, url string, html string"
    ).withColumn("text", F.lit("clash"))
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", f"é {LONG}", len(LONG) + 2), (None, None, "", 0), (1, "u", "", 0)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_names_only_weigh():
    for page in (
        f"<body class='has-sidebar'><p>{LONG}</p></body>", f"<body class='no-sidebar'><p>{LONG}</p></body>",
        f"<body><div id='content' class='with-widget'><p>{LONG}</p></div></body>", f"<article class='post related-3'><p>{LONG}</p></article>",
        f"<div class='comment-free'><p>{LONG}</p></div>",
    ):
        assert html_text.main_text(page) == LONG, page
    side = f"<div class='side'><p>Title</p><p>{LONG} <b>Bold</b> end.</p><p>{LONG}</p></div>"
    assert html_text.main_text(side) == f"Title\n{LONG} Bold end.\n{LONG}"
    assert html_text.main_text(f"<div class='sidebar'><p>{LONG}</p></div><p>{LONG} Text.</p>") == f"{LONG} Text."
    assert html_text.main_text(f"<main><p>{LONG}</p></main>{side}") == LONG


def test_other_languages(spark):
    polish = "W domu nie ma nikogo i nie wiem, czy to jest to, co się stało na ulicy, gdy się do niej zbliżał."
    japanese = "これは長い段落です。" * 12
    rows = [(i, "u", f"<html lang=pl-PL><p>{polish}</p><p>{'Kup teraz tanie buty zimowe ' * 4}</p></html>") for i in range(100)]
    rows += [(200, "u", f"<html lang=ja><p>{japanese}</p></html>"), (201, "u", f"<p>{japanese}</p>"), (202, "u", f"<p>{polish}</p>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith(polish) for i in range(100))
    assert got[200] == got[201] == japanese and got[202] == polish


def test_markup_that_never_ends():
    for end in ("<!-- hidden note", "<div class='x", "<a href=\"y>z</a>", "</div", "<!doctype", "<?php echo 1;", "<![if x", "<script>var x = '</p"):
        assert html_text.main_text(f"<article><p>{LONG}{end}") == LONG, end
    assert html_text.main_text("<article>a<![CDATA[x > y]]>b<!-->c<!--->d<!-- e --!>f<!-- g -->h") == "abcdfh"
    assert html_text.main_text("<article>a < b, c <3 d") == "a < b, c <3 d"


@pytest.mark.parametrize("part", ["<!--", "<![CDATA[", "<a ", "</", "<!", "<?", "<div>", "<svg>", "<b>", "<p><svg>", "<a href='x'>"])
def test_pages_are_read_in_linear_time(part):
    times = []
    for n in (20_000, 80_000):
        start = time.perf_counter()
        html_text.blocks_of(part * n)
        times.append(time.perf_counter() - start)
    assert times[1] < 12 * times[0] + 0.5


def test_hidden_elements_split_no_sentence():
    formula = "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>"
    page = f"<article><p>Let {formula} be <svg class='social-icon'><path d=1 /><title>t</title><g></svg>it<script>x</script> <span hidden>y</span>now.<p>End</article>"
    assert html_text.main_text(page) == "Let x=1 be it now.\nEnd"
    # a block's end tag also ends what was left open in it
    assert html_text.main_text(f"<article><p>a <svg><g></p><p>{LONG}</p></article>") == f"a\n{LONG}"
    assert html_text.main_text(f"<head><title>T</title><body><p>{LONG}</p>") == LONG
    assert html_text.main_text(f"<title>T</title><p>{LONG}</p>") == LONG


def test_links_and_comments_in_an_article():
    assert html_text.main_text(f"<article><blockquote><a href=x>{LONG}</a></blockquote></article>") == LONG
    links = "".join(f"<a href={i}>The link to page {i}</a> " for i in range(20))
    assert html_text.main_text(f"<main><p>{LONG}</p><p>{links}</p></main>") == LONG
    for name in ("reader-discussion", "reactions", "user-feedback"):
        assert html_text.main_text(f"<main><p>{LONG}</p><section class='{name}'><p>{LONG}</p></section></main>") == LONG


def test_two_passes_match_a_plain_version():
    rng = random.Random(5)
    for _ in range(300):
        blocks = [
            (
                " ".join(rng.choice(["the", "of", "stone", "river,", "and."]) for _ in range(rng.choice([2, 5, 30, 60]))),
                rng.choice([0, 0, 0, 60]), rng.random() < 0.2, rng.choice([0, 0, 1, 2]), 0,
            )
            for _ in range(rng.randrange(1, 25))
        ]
        stops = rng.choice([None, frozenset(["the", "of", "and"])])
        first = [html_text.first_pass(*b[:4], stops) for b in blocks]
        want = brute.labels(blocks, stops)
        assert html_text.second_pass(first, [b[3] for b in blocks]) == want
        inside = any(good and b[3] for b, good in zip(blocks, want, strict=True))
        text = "\n".join(b[0] for b, good in zip(blocks, want, strict=True) if good and (b[3] or not inside))
        assert html_text.text_of(blocks, "xx", {"xx": stops}) == text


def test_frequent_words_match_a_plain_count(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").toPandas()["html"]
    rows = [(language, *map(list, zip(*[b[:3] for b in blocks], strict=True))) for language, blocks in map(html_text.blocks_of, pages) if blocks]
    counts = {}
    for language, texts, linked, bad in rows:
        own = counts.setdefault(language, {})
        for t, n, b in zip(texts, linked, bad, strict=True):
            if not b and len(t) >= html_text.LONG and n <= html_text.LINKS * len(t):
                for w in t.lower().split():
                    own[w.strip(".,;:!?")] = own.get(w.strip(".,;:!?"), 0) + 1
    got = html_text.frequent_words(spark.createDataFrame(rows, "lang string, texts array<string>, linked array<int>, bad array<boolean>").repartition(3))
    assert set(got) == {language for language, own in counts.items() if own}
    for language in set(got) - {""}:
        own = {w for w, n in counts[language].items() if w and len(w) <= html_text.WORD and n >= html_text.FREQUENT * sum(counts[language].values())}
        told = sum(counts[language].values()) >= html_text.EVIDENCE and sum(counts[language][w] for w in own) >= 2 * html_text.STOPS * sum(counts[language].values())
        fixed = html_text.STOP_WORDS if told or language in html_text.FIXED else None
        assert got[language] == (frozenset(fixed | own) if told else fixed and frozenset(fixed))


def test_empty_pages_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text int")
    assert html_text.extract(empty).collect() == []
