"""Pages whose wrappers are named after what is beside them, and pages without an article element."""

import re

import pyarrow.parquet as pq
import pytest

from tickframe.llm import html_extract

PARAGRAPHS = [f"{'Some long sentence of an article that goes on and on. ' * 6}{i}." for i in range(12)]
BODY = "".join(f"<p>{x}</p>" for x in PARAGRAPHS)


@pytest.mark.parametrize("name", ["container has-sidebar", "layout no-sidebar", "content-wrapper skip-link", "post share-enabled", "article-header", "with-comments", "is-menu-open"])
def test_a_wrapper_is_not_what_it_is_named_after(name):
    page = f"<body><div class='site-nav'><a href=x>Home</a></div><div class='{name}'>{BODY}</div><div class='share-box'>Share this with your friends now.</div></body>"
    assert html_extract.main_text(page).split("\n") == PARAGRAPHS


@pytest.mark.parametrize("name", ["comments", "comment-list", "sidebar", "share-box", "cookie-banner", "footer"])
def test_parts_go(name):
    page = f"<body><div>{BODY}</div><div class='{name}'><p>What a nice article that was, thank you very much for it.</p></div></body>"
    assert html_extract.main_text(page).split("\n") == PARAGRAPHS


def test_long_remarks_are_no_article():
    page = f"<body><div>{BODY}</div><div class='comment-section'>{BODY.replace('article', 'remark') * 3}</div></body>"
    assert html_extract.main_text(page).split("\n") == PARAGRAPHS


def test_names():
    assert [html_extract.names_part(x) for x in ("sidebar", "Site-Nav", "no-sidebar", "comments-area", "post", "", "has-menu share")] == [2, 1, 0, 2, 0, 0, 2]


def test_the_sums_find_most_of_what_elements_tell():
    """With article and main turned into div, the lines that are left are the same lines, and nearly all of them."""
    whole = left = 0
    for r in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).to_pylist():
        page = r["html"] or ""
        want, got = html_extract.main_text(page).split("\n"), html_extract.main_text(re.sub(r"(</?)(article|main)\b", r"\1div", page)).split("\n")
        assert set(got) <= {*want, ""}
        whole, left = whole + len(want), left + len(got)
    assert left > 0.92 * whole
