"""Names that put an element outside of a page's text, and those that do not."""

from __future__ import annotations

import time

import pytest

from lotflow.llm.html_text import extract
from lotflow.llm.markup import LEVELS, Block, read

TEXT = "The river runs over the old stones and under the bridge of the town. " * 8


@pytest.mark.parametrize("attributes", ['class="content has-sidebar"', 'class="no-sidebar"', 'class="comments-open"', 'class="post social-policy"', 'id="legal-news"'])
@pytest.mark.parametrize("inner", ["<article><p>%s</p></article>", "<p>%s</p>"])
def test_names_within_others_keep_the_text(attributes, inner):
    side = '<div class="sidebar">more to read</div><div class="ad-slot">buy</div><div class="page__sidebar-left">x</div>'
    html = f"<html><body><div {attributes}>{inner % TEXT}</div>{side}</body></html>"
    assert extract(html, None, []) == TEXT.strip()


@pytest.mark.parametrize("around", ["<form>%s</form>", '<div class="widget">%s</div>', '<div class="social"><form>%s</form></div>'])
def test_what_holds_the_page_is_not_outside(around):
    body = f'<article><p>{TEXT}</p><div class="comments">so it is</div></article>'
    html = f"<html><body><nav>home</nav>{around % body}</body></html>"
    assert extract(html, None, []) == TEXT.strip()
    assert TEXT.strip() in extract(f"<html><body><nav>home</nav>{around % f'<p>{TEXT}</p>'}</body></html>", None, [])


def test_named_parts_beside_the_article_stay_outside():
    html = f'<html><body><article><p>{TEXT}</p></article><div class="related"><article><p>{TEXT * 30}</p></article></div><form>{TEXT}</form></body></html>'
    assert extract(html, None, []) == TEXT.strip()


BROKEN = {
    "open": "<a " * 340_000,
    "double quotes": "<a \"" * 200_001 + "><p>end</p>",
    "single quotes": "<a ' " * 200_001 + '"><p>end</p>',
    "names": "<a" * 400_000 + ' "<p>end</p>',
    "declarations": "<!x " * 250_000,
    "signs": "<" * 1_000_000,
    "nested": "<div>" * 150_000 + "end",
    "closed": "<div>" * 50_000 + "</x>" * 100_000 + "end",
}


@pytest.mark.parametrize("html", BROKEN.values(), ids=BROKEN)
def test_broken_markup_takes_linear_time(html):
    started = time.process_time()
    read(html)
    assert time.process_time() - started < 20  # a few seconds; the time of a quadratic reader is hours


def test_a_sign_that_begins_no_tag_is_text():
    blocks = [b.text for b in read('<p>1 < 2 <b x="1>2">and</b> <a "open <i>so</i></p><p>it goes</p>') if isinstance(b, Block)]
    assert blocks == ['1 < 2 and <a "open so', "it goes"]


def test_text_below_the_levels_is_kept():
    blocks = [b for b in read("<div>" * (LEVELS + 50) + "deep<p>er</p>") if isinstance(b, Block)]
    assert [b.text for b in blocks] == ["deep", "er"]
    assert all(b.path.count("/") == LEVELS for b in blocks)
