"""Main text of odd and large pages, and the operator on Spark tables."""

import time

import pytest

from civicspark.llm import html_extract

PARAGRAPHS = [f"Paragraph {i} tells a longer story, with commas and points. It goes on for a while." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)


@pytest.mark.parametrize("page", [
    "<" * 1_000_000, "<div>" * 10_000 + "deep text, here." + "</div>" * 10_000, "<div>one, two.\n" * 10_000,
    "</b></div>" * 40_000 + "<p>end, here.", "<p>a, b. " * 30_000, "<!-- " + "x" * 2_000_000, "<svg>" * 5_000 + "t"])
def test_time_follows_the_page(page):
    start = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - start < 10


def test_text_outside_all_elements():
    assert html_extract.main_text("plain text, no tags.") == "plain text, no tags."
    page = f"before, it all. {BODY} after, the end."
    assert [p for p in PARAGRAPHS if p not in html_extract.main_text(page)] == []


def test_deep_article_keeps_every_block():
    page = "<div>" * 3_000 + "<article>" + BODY + "</article>" + "</div>" * 3_000 + "<footer>imprint</footer>"
    assert html_extract.main_text(page) == "\n".join(PARAGRAPHS)


def test_extract_on_tables(spark):
    page = f"<nav><a>Home</a></nav><article>{BODY}</article><div class=ad>Buy now</div>"
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (2, None, None, "y", 1), (3, "v", "", None, None), (None, "w", page, "z", 2),
            (4, "q", "<p>" + "long words, here. " * 200_000, "t", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    want = "\n".join(PARAGRAPHS)
    assert got.count() == 6 and out[1, "u"] == out[None, "w"] == (want, len(want))
    assert out[2, None] == out[3, "v"] == ("", 0) and out[4, "q"][1] == 200_000 * 18 - 1
    assert html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<p>Press <button type=button>OK</button>to go on<button>x<div>y</div></button>, if you like.</p>", "Press to go on , if you like."),
    ("<p>one <button>never closed</p><p>two, three.</p>", "one\ntwo, three."),
    ("<ul><li>one <button>never closed<li>two, three.</ul>", "one\ntwo, three."),
    ("<p>one, two. <button>never closed to the end", "one, two."),
    ("<p>one, two. <nav>menu</nav> three, four.", "one, two.\nthree, four."),
    ("<div>a<select><option>1<option>2</select>b</div>", "a b"),
    ("<p>one <label>name<input></label></p><p>two, three.</p>", "one\ntwo, three."),
    ("<button><div>menu</div></button>", "")])
def test_controls_stand_inside_a_line(page, want):
    assert html_extract.main_text(f"<article>{page}</article>") == want
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize("menu", ["", "<div class=top>" + "".join(f"<div><a>Link {i}</a></div>" for i in range(10)) + "</div>"])
@pytest.mark.parametrize("size", [20, 5_000, 100_000])
def test_a_long_block_leaves_the_paragraphs_beside_it(menu, size):
    code = "call(a, b); " * size
    page = f"<body>{menu}<div>{BODY}</div><div><pre>{code}</pre></div></body>"
    assert html_extract.main_text(page) == "\n".join([*PARAGRAPHS, code.strip()])
