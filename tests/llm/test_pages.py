"""The page labeller on layouts that its tables do not hold."""

import pytest

from sightline.llm import block_labeller

WORD = "<p>The council met on Tuesday evening, and after a long debate it agreed on the plan. Work begins in spring.</p>"
TEXT = WORD.removeprefix("<p>").removesuffix("</p>")
HEAD = "<h1>Head line here</h1>"
PAGE = (
    "<html><head><title>x</title></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul>"
    "</nav>{}<footer>&copy; example.net</footer></body></html>"
)
COMMENTS = "<section class='comments'><div class='comment'><p>Great post, I agree!</p></div></section>"
PLAIN = (
    "<html><body><div{0}><a href='/a'>Home</a> <a href='/b'>News</a></div><div{1}>{2}</div>"
    "<div{3}>&copy; example.net</div></body></html>"
)
LAYOUTS = {
    "comments in the article": PAGE.format(f"<article>{HEAD}{WORD}{WORD}{COMMENTS}</article>"),
    "comments after it": PAGE.format(f"<article>{HEAD}{WORD}{WORD}</article>{COMMENTS}"),
    "comments as articles": PAGE.format(
        f"<main><article class='post'>{HEAD}{WORD}{WORD}<section class='comments'><article class='comment'>{WORD}"
        "</article></section></article></main>"
    ),
    "comment as long as the text": PAGE.format(
        f"<article>{HEAD}{WORD}{WORD}<div id='comments'><ul><li class='comment'>{WORD}</li></ul></div></article>"
    ),
    "aside inside": PAGE.format(f"<article>{HEAD}{WORD}<aside><p>Sponsored words</p></aside>{WORD}</article>"),
    "advert inside": PAGE.format(f"<article>{HEAD}{WORD}<div class='ad'>Buy now, for less.</div>{WORD}</article>"),
    "form inside": PAGE.format(f"<article>{HEAD}{WORD}{WORD}<form><label>Subscribe</label><input></form></article>"),
    "named divs": PLAIN.format(" class='nav'", " class='content'", HEAD + WORD + WORD, " class='footer'"),
    "plain divs": PLAIN.format("", "", HEAD + WORD + WORD, ""),
    "telling names": PAGE.format(
        f"<article class='post no-sidebar'><h1 class='entry-title'>Head line here</h1>{WORD}{WORD}</article>"
    ),
}


@pytest.fixture(scope="module")
def model(spark):
    return block_labeller.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_layouts(spark, model):
    pages = spark.createDataFrame(list(LAYOUTS.items()), "page_id string, html string").selectExpr("*", "page_id as url")
    got = {r["page_id"]: r["text"] for r in block_labeller.extract(pages, model).collect()}
    assert got == dict.fromkeys(LAYOUTS, f"Head line here\n\n{TEXT}\n\n{TEXT}")


def test_every_word_of_a_block_counts():
    path = (("article", ()), ("p", ()))
    short = [(path, " ".join(["same"] * 300), 0)]
    other = [(path, " ".join(["same"] * 299 + ["last"]), 0)]
    assert (block_labeller.vectors(short) != block_labeller.vectors(other)).any()


def test_sample_is_of_distinct_pages(spark):
    pages = spark.range(3000).selectExpr("if(id % 3 = 0, '<p>hot</p>', concat('<p>', id, '</p>')) as html")
    found = block_labeller.sample(pages.repartition(7))
    assert len(found) == len(set(found)) == block_labeller.FIT_PAGES
    assert block_labeller.sample(pages.repartition(2)) == found


def test_tables_without_pages_and_repeated_rows(spark, model):
    kinds = "page_id long, url string, html string, text string, label string, hash long"
    empty = spark.createDataFrame([], kinds)
    assert block_labeller.extract(empty).count() == 0
    row = (1, None, LAYOUTS["form inside"], "clash", "clash", 5)
    got = block_labeller.extract(spark.createDataFrame([row, row, (None, "u", None, None, None, None)], kinds), model).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 18 + 2 * len(TEXT), 18 + 2 * len(TEXT)]
