"""Archives and main texts of pages."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import page_difference, warc_segments


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200), st.integers(5, 40))
def test_chunked_payloads_come_back(text, size):
    payload = (text + warc_segments.VERSION + text).encode()
    framed = warc_segments.chunked(payload, size)
    assert warc_segments.unchunked(framed) == payload
    assert warc_segments.VERSION.encode() not in framed


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(5, 40), st.integers(1, 6))
def test_chunks_never_end_in_the_version(text, size, times):
    for payload in ((text + "WARC/1.1" * times).encode(), ("WARC/1.1" * times + text).encode()):
        framed = warc_segments.chunked(payload, size)
        assert warc_segments.unchunked(framed) == payload
        assert warc_segments.VERSION.encode() not in framed


def test_pages_with_the_version_at_their_cuts_come_back(spark, tmp_path):
    rows = [(i, f"http://w/{i}/WARC/1.1", "x" * i + "WARC/1.1" * 5000, None) for i in range(12)]
    rows += [(20, "http://v/", "WARC/1.1", None), (21, "http://v/", "<p>" + "WARC/1.1" * 500, None)]
    read, told = round_trip(spark, rows, tmp_path)
    assert len(told) == len(rows) and all(r.damage is None for r in told)
    assert {r.page_id: r.payload_bytes for r in told} == {i: len(html) for i, _, html, _ in rows}
    assert {bytes(r.payload).decode() for r in read.collect()} == {html for _, _, html, _ in rows}


def test_broken_framing_is_an_error():
    for body in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabcX\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc_segments.unchunked(body)


def round_trip(spark, rows, folder):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    warc_segments.write_archive(pages, f"{folder}/warc", f"{folder}/copies")
    read = warc_segments.reassemble(warc_segments.read_records(spark, f"{folder}/warc"))
    return read, warc_segments.with_revisits(warc_segments.page_report(read), f"{folder}/pages").collect()


def test_archives_of_odd_pages_come_back(spark, tmp_path):
    same = "é" * 700
    rows = [(1, "http://a/x y", "<p>one", "d"), (2, None, None, None), (3, "", "", None), (None, "http://b/", "<p>null id", None),
            (4, "http://c/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 3000, None), (5, "http://d/", "漢字🙂" * 40_000, None),
            (6, "http://e/", same, None), (7, "http://e/", same, None), (9, "http://f/", same, None), (8, "u", "short", None),
            (10, "u", "short", None), (11, "http://g/\r\nWARC/1.1\r\n", "\r\n\r\n\r\n", None), (1, "http://a/x y", "<p>one", "d")]
    read, told = round_trip(spark, rows, tmp_path)
    assert len(told) == len(rows) and all(r.damage is None for r in told)
    by_id = {r.page_id: r for r in told}
    for page, _, html, _ in rows:
        data = (html or "").encode()
        assert (by_id[page].payload_bytes, by_id[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {i: (by_id[i].record_type, by_id[i].refers_to) for i in (6, 7, 8, 9, 10)} == {
        6: ("revisit", 9), 7: ("revisit", 9), 9: ("response", None), 8: ("response", None), 10: ("response", None)}
    payloads = {bytes(r.payload).decode() for r in read.where("kind = 'response'").collect()}
    assert payloads == {html or "" for _, _, html, _ in rows}
    assert spark.read.text(f"{tmp_path}/warc", lineSep=warc_segments.VERSION).where("value LIKE '%Segment-Number%'").count() > 10


def test_an_empty_archive(spark, tmp_path):
    assert round_trip(spark, [], tmp_path)[1] == []


def test_damaged_segments_are_named(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 100_000, None)], "page_id long, url string, html string, digest string")
    warc_segments.write_archive(pages, f"{tmp_path}/warc", f"{tmp_path}/copies")
    records = warc_segments.read_records(spark, f"{tmp_path}/warc")
    last = records.agg(F.max("segment")).first()[0]
    cases = {"a segment is missing or there twice": records.where("segment <> 2"),
             "the last segment is missing": records.where(f"segment <> {last}"),
             "the total length differs": records.withColumn("total", F.col("total") + 1),
             "a record is cut short": records.withColumn("whole", F.col("segment") != 3)}
    for damage, some in cases.items():
        assert [(r.damage, r.payload) for r in warc_segments.reassemble(some).collect()] == [(damage, None)]
    assert warc_segments.reassemble(records.unionByName(records.where("segment = 2"))).first().damage == next(iter(cases))


def longest_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12), st.sampled_from([4, 1 << 28]))
def test_alignment_is_a_longest_common_subsequence(one, other, bits):
    kept, page_difference.BITS = page_difference.BITS, bits
    try:
        places = page_difference.common_lines(one, other)
    finally:
        page_difference.BITS = kept
    rest = iter(other)
    assert places == sorted(set(places)) and all(one[i] in rest for i in places)
    assert len(places) == longest_common(one, other)


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header>
<nav><ul><li>Home<li>Menu</ul></nav><!-- <p>no --><div class="ad">Buy</div><p class=notice>Cookies<p>Out<script>"</p>"</script>
<article><header><h1>The &amp; title</h1></header><p>First  <b>bo</b>ld<br>line<p>Second&nbsp;one<aside>Side</aside>
<form><p>Mail?</form><p>Third</article><section id="comments"><article class="comment"><p>Me too</article></section>
<footer>&copy; all"""


@pytest.mark.parametrize("opened", [
    '<div class="content no-sidebar">', '<article class="post comments-open">', '<main class="has-comments">',
    '<div class="layout-no-sidebar"><article>', '<div class="post social-share-enabled"><article>', '<div class="widget">',
    '<div class="sidebar"><div class="widget">', '<div id="menu"><div class="promo"><div class="related">'])
def test_a_word_of_a_class_does_not_take_an_article(opened):
    html = f'<nav>Home</nav><div class="ad">Buy</div>{opened}<p>One, at some length.</p><h2 id="x">Two</h2>'
    assert [line for line, _ in page_difference.page_lines(html)] == ["One, at some length.", "Two"]


@pytest.mark.parametrize("name", ["ad", "ads", "site-footer", "sidebar left", "comment-list", "post-comments", "cookie-notice", "mainMenu",
                                  "share-buttons", "related_posts", "ad-slot-3"])
def test_whole_names_take_an_element(name):
    for html in (f'<article><p>Text</p><div class="{name}">Not <b>this</b></div></article>', f'<div>Text</div><div id="{name}">Not</div>'):
        assert [line for line, _ in page_difference.page_lines(html)] == ["Text"]


def test_headings_and_paragraphs_of_an_article_stay():
    html = '<article><h2 id="related">Related work</h2><p class="social">Social</p><p class="ad">Buy</p><div class="related">More</div>'
    assert [line for line, _ in page_difference.page_lines(html)] == ["Related work", "Social"]
    many = "".join(f"<p>Comment {i}, quite long.</p>" for i in range(50))
    assert page_difference.page_lines(f'<div>Short</div><section id="comments">{many}</section>') == [("Short", False)]
    nested = '<div class="widget">x' * 5000  # no name is believed where names outweigh again
    assert len(page_difference.page_lines(nested)) == 5000


def test_a_story_beside_a_longer_card_stays(spark):
    page = lambda i: (f"<div>Site name</div><div>Story {i} is short.</div>"  # noqa: E731
                      f"<article><p>{'A card with many more characters. ' * 9}</p></article><div>Imprint</div>")
    rows = [(i, f"http://s.org/{i}", page(i)) for i in range(6)]
    found = page_difference.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    card = ("A card with many more characters. " * 9).strip()
    assert {r.page_id: r.text for r in found.collect()} == {i: f"Story {i} is short.\n{card}" for i in range(6)}


def test_marked_lines_are_the_text(spark):
    rows = [(1, "http://a.org/x/1", ARTICLE), (2, "http://a.org/x/2", ARTICLE), (3, "http://a.org/x/3", None), (4, None, ""),
            (None, "no url", "<p>alone"), (5, "http://a.org/x/2", "<main>" + "<p>w" * 50_000 + "</main><p>x"), (1, "http://a.org/x/1", ARTICLE),
            (6, "http://cut.org/", "<article><p>begun <b>&amp; cut &am")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    found = page_difference.main_text(pages).collect()
    assert len(found) == len(rows)
    told = {r.page_id: r.text for r in found}
    assert told[1] == told[2] == "The & title\nFirst bold line\nSecond one\nThird"
    assert told[3] == told[4] == "" and told[None] == "alone" and told[6] == "begun & cut &am"
    assert told[5] == "\n".join(["w"] * 50_000)
    assert page_difference.main_text(pages.limit(0)).count() == 0


def test_shared_lines_of_nearest_pages_are_deleted(spark):
    frame = lambda body: f"<div>Site name</div><div>Latest news</div>{body}<div>About us</div><div>Imprint</div>"
    rows = [(i, f"http://h{i % 3}.org/a{i % 2}/{i}", frame(f"<p>Page {i} has this.</p><p>And that of {i}, at some length.</p>"))
            for i in range(60)]
    rows += [(100, "http://copy.org/1", frame("<p>Same")), (101, "http://copy.org/2", frame("<p>Same")),
             (102, "http://single.org/", frame("<p>Only"))]
    found = page_difference.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7))
    told = {r.page_id: r.text for r in found.collect()}
    assert all(told[i] == f"Page {i} has this.\nAnd that of {i}, at some length." for i in range(60))
    assert told[100] == told[101] == "Site name\nLatest news\nSame\nAbout us\nImprint"
    assert told[102] == "Site name\nLatest news\nOnly\nAbout us\nImprint"


def test_a_marked_teaser_is_not_the_whole_text(spark):
    body = lambda i: "".join(f"<div>Sentence {k} of page {i}, told at some length.</div>" for k in range(6))
    frame = lambda i, inside: f"<div>Site name</div>{inside}<article><p>Teaser {i % 2}</p></article><div>Imprint</div>"
    rows = [(i, f"http://t.org/{i}", frame(i, body(i))) for i in range(8)]
    rows += [(20 + i, f"http://m.org/{i}", f"<div>Site</div><main>{body(i)}</main><div>Advert {i}</div>") for i in range(4)]
    found = page_difference.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    told = {r.page_id: r.text.split("\n") for r in found.collect()}
    sentences = lambda i: [f"Sentence {k} of page {i}, told at some length." for k in range(6)]
    assert all(told[i] == [*sentences(i), f"Teaser {i % 2}"] for i in range(8))
    assert all(told[20 + i] == sentences(i) for i in range(4))


def test_copies_and_short_pages_lose_what_is_the_sites(spark):
    frame = lambda body: f"<div>{'Name of the site ' * 6}</div>{body}<div>{'Imprint and terms ' * 6}</div>"
    words = lambda i, k: f"<p>Sentence {k} of article {i}, which is told at length.</p>"
    text = lambda i: "".join(words(i, k) for k in range(8))
    short = [(i, f"http://short.org/{i:02}", frame(f"<p>Short {i}")) for i in range(9)]
    same = [(100 + 10 * i + k, f"http://same.org/{i}?v={k}", frame(text(i))) for i in range(5) for k in range(4)]
    near = [(200 + 10 * i + k, f"http://near.org/{i}/{k}", frame(text(i) + f"<p>Read {10 * i + k} times")) for i in range(5) for k in range(7)]
    found = page_difference.main_text(spark.createDataFrame(short + same + near, "page_id long, url string, html string").repartition(5))
    told = {r.page_id: r.text for r in found.collect()}
    plain = lambda html: "\n".join(x for x, _ in page_difference.page_lines(html))
    assert all(told[i] == f"Short {i}" for i in range(9))
    assert all(told[i] == plain(text((i - 100) // 10)) for i, *_ in same)
    assert all(told[i] == plain(text((i - 200) // 10) + f"<p>Read {i - 200} times") for i, *_ in near)


def test_neighbours_are_those_of_one_sorted_list(spark):
    rows = [(i, f"h{i * 7 % 5}", f"/{'abc'[i % 3]}/{i * 13 % 50}/x") for i in range(200)]
    found = {r.row: r.near for r in page_difference.nearest(
        spark.createDataFrame(rows, "row long, host string, path string").repartition(5)).collect()}
    ordered, expected = sorted(rows, key=lambda r: (r[1], r[2], r[0])), {}
    def shared(a, b):
        n = 0
        for x, y in zip(a.split("/"), b.split("/")):
            if x != y:
                break
            n += 1
        return n
    for k, row in enumerate(ordered):
        sides = [ordered[j] if 0 <= j < len(ordered) and ordered[j][1] == row[1] else None for j in (k - 1, k + 1)]
        scores = [-1 if s is None else shared(row[2], s[2]) for s in sides]
        expected[row[0]] = sides[0 if scores[0] >= scores[1] else 1][0]
    assert found == expected
