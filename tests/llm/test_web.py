"""Page extraction and archives."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import pages, warc

ARTICLE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav>x<ul><li>a</nav><div id="cookie-notice">We use</div>
<div class="ad">buy<main><article class="post post-12"><header><h1>Title &amp; more</h1><p class=byline>By me</p></header>
<p>One <b>two</b><br>three, &nbsp; four &lt;x&gt;<p>Five<aside>side</aside><div class="share-buttons">tw</div><ul><li>i1<li>i2</ul>
<form><input name=q>search</form><blockquote>quote "x" < 3 </blockquote><script>if(a<b){"</p>"}</script><!-- c -->
<section class="comments"><article><p>nice</p></article></section><p>Last</article></main><footer>f</footer>"""


def test_furniture_goes_and_text_stays():
    text = pages.extract(pages.parse(ARTICLE))[0]
    assert text.split("\n\n") == ["Title & more", "One two three, four <x>", "Five", "i1", "i2", 'quote "x" < 3', "Last"]


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""), ("plain text", "plain text"), ("<p>only", "only"), ("<a href=\"x>y</a> z", "y z"), ("<div><p>a</div></p><p>b", "a\n\nb"),
        ("<" * 50, "<" * 50), ("&eacute;&#233;&#xe9; &unknown; a&amp;b", "ééé &unknown; a&b"), ("<p>a \n b</p><p> </p>", "a b"),
        ("<script>never closed", ""), ("<!-- never closed", ""), ("<nav>a</nav><article><p>b</p></article>", "b"),
    ],
)
def test_odd_pages(source, text):
    assert pages.extract(pages.parse(source))[0] == text


def page(template, i):
    body = "".join(f"<p>Paragraph {k} of page {i}, with some words, and more of them.</p>" for k in range(4))
    short = f"<p>Tiny {i}.</p>"
    if template == "a":
        return f'<body><div class="menu">m</div><div class="story s{i}">{body}</div><div class="teasers">{short}</div></body>'
    return f'<body><div class="teasers"><p>{"Very long teaser, again, and again, " * 9}</p></div><div class="story s{i}">{short}</div></body>'


def test_a_host_votes_for_its_path(spark):
    """Pages whose own best container is not the text follow their host's."""
    rows = [(i, "https://user@News.example.com:80/x", page("a", i)) for i in range(9)] + [(20, "http://news.example.com", page("b", 20))]
    rows += [(30, None, "<p>free</p>"), (31, "odd", None), (31, "odd", None), (None, "http://z/", "<article><p>t</p></article>")]
    table = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = pages.main_text(table).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[20].text == "Tiny 20." and by_id[20].path == "/body/div.s#.story"
    assert by_id[3].text.count("\n\n") == 3 and "Tiny" not in by_id[3].text
    assert (by_id[30].text, by_id[31].text, by_id[None].text) == ("free", "", "t")
    assert pages.main_text(table.limit(0)).count() == 0


def test_two_templates_keep_both_articles(spark):
    long = "".join(f"<p>Part {k}, of a long read, with commas, and words.</p>" for k in range(9))
    rows = [(i, "http://h/", f'<body><div class="post"><p>Post {i}, with text, and more text.</p><p>Again, more.</p></div></body>') for i in range(9)]
    rows.append((9, "http://h/", f'<body><div class="longread">{long}</div><div class="post"><p>Read also: another post.</p></div></body>'))
    rows += [(10 + i, url, f"<div class=x{i}><p>Alone {i}, and own.</p></div>") for i, url in enumerate([None, "odd", "odd2"])]
    got = {r.page_id: r for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9].text.startswith("Part 0") and "Read also" not in got[9].text and got[9].path == "/body/div.longread"
    assert all(got[i].text == f"Post {i}, with text, and more text.\n\nAgain, more." for i in range(9))
    assert [got[10 + i].text for i in range(3)] == [f"Alone {i}, and own." for i in range(3)]


@pytest.mark.parametrize("unit", ['<div class="abc">', "<div>text, and more ", "<b>x</i>", "<b><div></div>", "<p><b>t", "<li><nav>", "<article><nav>", '<a href="'])
def test_deep_pages_take_time_in_proportion(unit):
    import time
    import tracemalloc

    source = unit * ((1 << 20) // len(unit)) + "<p>the end"
    tracemalloc.start()
    start = time.process_time()
    pages.extract(pages.parse(source))
    assert time.process_time() - start < 60 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_pages_of_the_table_lose_nothing(spark, sf_dir):
    """Brute force: the article element's text, cut at tags."""
    import html

    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in table.collect()}
    got = pages.main_text(table).collect()
    assert len(got) == len(source)
    for r in got:
        inner = source[r.page_id].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        assert r.text.split() == html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()
        assert "\n" not in r.text.replace("\n\n", "") and not r.text.startswith("\n")


# ---------------------------------------------------------------- archives


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(k):
    r = random.Random(k)
    runs = [sorted((r.randint(0, 30), r.randint(0, 3)) for _ in range(r.randint(0, 20))) for _ in range(k)]
    assert [line for _, line in warc.LoserTree([iter(x) for x in runs])] == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("HTTPS://www.Foo.Bar.com:8080/A/b?x=1#f") == "com,bar,foo:8080)/a/b?x=1"
    assert warc.url_key("http://[bad/x") == "http://[bad/x" and warc.url_key("") == ")/"


def rows_of_pages():
    r = random.Random(1)
    rows = [(i, f"http://h{i % 3}.com/{r.randint(0, 9)}", r.choice(["<p>a</p>", "é", "", None, f"own {i}"])) for i in range(120)]
    return rows + [(500, None, "x\r\n\r\ny"), (501, "a\r\nb", "x\r\n\r\ny"), (None, "u", "x\r\n\r\ny"), (None, "u", "alone"), (7, "v", "twice"), (7, "v", "twice")]


@pytest.mark.parametrize("least", [0, 3])
def test_histories(spark, tmp_path, monkeypatch, least):
    rows = rows_of_pages()
    table = spark.createDataFrame([(*x, "d", "a") for x in rows], "page_id long, url string, html string, sha string, archive string").repartition(5)
    when = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") % 50)
    got = warc.capture_histories(spark, table, str(tmp_path / "w"), when, least).collect()
    largest = {}
    for i, _, text in rows:
        if i is not None:
            largest[text or ""] = max(i, largest.get(text or "", i))

    def expected(i, text):
        raw = (text or "").encode()
        keeper = largest.get(text or "") if len(raw) >= least else None
        again = keeper is not None and keeper != i
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        return (i, len(raw), digest, "revisit" if again else "response", keeper if again else None)

    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=str) == sorted((expected(i, t) for i, _, t in rows), key=str)
    history = [(r.urlkey, r.captured) for r in sorted(got, key=lambda r: (r.part, r.seq))]
    assert history == sorted(history)
    assert len({(r.part, r.seq) for r in got}) == len(rows)


def test_no_pages_no_archives(spark, tmp_path):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.capture_histories(spark, table, str(tmp_path / "w"), F.timestamp_seconds("page_id")).count() == 0


def test_archives_are_gzip_members_with_their_runs(spark):
    import gzip

    table = spark.createDataFrame(rows_of_pages(), "page_id long, url string, html string")
    for row in warc.archives(table, F.timestamp_seconds("page_id")).collect():
        assert gzip.decompress(row.content).count(b"WARC/1.1\r\n") == len(row.run)
        lines = [(x.urlkey, x.captured, x.offset) for x in row.run]
        assert lines == sorted(lines)
        for x in row.run:
            warc.parse_record(gzip.decompress(row.content[x.offset : x.offset + x.length]))
