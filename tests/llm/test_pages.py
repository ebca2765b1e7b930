"""Main text of awkward pages: attributes, class words, long broken markup, page tables with repeated and long rows."""

from __future__ import annotations

import random
import time

import pytest

from tidemark.llm import mincut_html

LINE = "A sentence of the article that says something at length. "


@pytest.mark.parametrize("tag", ['<img alt="a > b" src=x>', "<img alt='a > b' src=x>", "<span title = \"x>y>z\">", "<!-->", "<!-- a > b --!>", "<br data-x=\"1>2\"/>", "<i it's>", "<input value=\">\" / >"])
def test_no_markup_gets_into_the_text(tag):
    want = f"{LINE * 3}Before and after it.".strip()
    assert mincut_html.main_text(f"<body><article><p>{LINE * 3}Before {tag}and after it.</p></article></body>") == want


def test_a_quote_that_is_never_closed_ends_with_its_tag():
    assert mincut_html.main_text(f'<article><p class="x>{LINE * 3}</p><p>{LINE}</p></article>') == "\n".join([(LINE * 3).strip(), LINE.strip()])


def test_raw_text_ends_at_its_own_end_tag():
    page = f'<article><script data-a="x>y">var a = "</p></scripts>";</script foo><p>{LINE * 3}</p><title>No</title ></article>'
    assert mincut_html.main_text(page) == (LINE * 3).strip()


@pytest.mark.parametrize("reference, text", [("&#" + "9" * 9000 + ";", "�"), ("&#" + "0" * 9000 + "65;", "A"), ("&#" + "0" * 30 + ";", "�"), ("&#65;&#x42;", "AB")])
def test_long_references(reference, text):
    assert mincut_html.main_text(f"<article><p>{LINE * 3}{reference}</p></article>") == LINE * 3 + text


@pytest.mark.parametrize("name", "related-work social-history search-engines legal-analysis comment-essay tags-explained".split())
def test_a_qualifying_class_word_drops_no_section(name):
    part = f'<section class="{name}"><p>{LINE * 6}</p></section>'
    assert mincut_html.main_text(f"<body><article><h1>Title</h1>{part}<p>{LINE * 2}</p></article></body>").count("something") == 8


@pytest.mark.parametrize("name", "related-posts social-links search-box comment-list tags promo-text ad-slot share-buttons cookie-banner comments werbung".split())
def test_a_naming_class_word_does(name):
    part = f'<div class="{name}"><p>{"Words that are no part of it. " * 4}</p></div>'
    assert "no part" not in mincut_html.main_text(f"<body><article><h1>Title</h1><p>{LINE * 6}</p>{part}<p>{LINE * 4}</p></article>{part}</body>")


LONG = {
    "spans": "<span>" * 120_000 + "</i>" * 70_000,
    "rows": "<table>" + "<tr><td>x" * 110_000,
    "items": "<ul>" + "<li><p>x" * 120_000,
    "lists": "<dl><dt>x<dd>y" * 70_000,
    "buttons": "<button>" * 100_000 + "</i>" * 50_000,
    "quotes": '<a title="' * 100_000,
    "equals": "<a " + "= " * 500_000,
    "signs": "<" * 1_000_000,
    "comments": "<!--" * 250_000,
    "scripts": "</script " * 110_000,
    "depth": "<div>" * 100_000 + "x</div>" * 70_000,
}


@pytest.mark.parametrize("kind", LONG)
def test_a_megabyte_of_broken_markup_takes_seconds(kind):
    start = time.process_time()
    mincut_html.main_text(LONG[kind])
    assert time.process_time() - start < 6  # 1.5 at most here; the quadratic parse took minutes


def _least(score, edges):
    """Least cost of a chain by dynamic programming (edges join neighbours only)."""
    keep, drop = max(0.0, -score[0]), max(0.0, score[0])
    for i in range(1, len(score)):
        w = edges[i - 1][2]
        keep, drop = max(0.0, -score[i]) + min(keep, drop + w), max(0.0, score[i]) + min(drop, keep + w)
    return min(keep, drop)


def test_long_chains_are_cut_least_and_fast():
    r = random.Random(3)
    score = [r.uniform(-0.3, 0.3) for _ in range(20_000)]
    edges = [(i - 1, i, r.uniform(0, 2)) for i in range(1, len(score))]
    start = time.process_time()
    label = mincut_html.min_cut(score, edges)
    assert time.process_time() - start < 20
    cost = sum(abs(s) for s, k in zip(score, label, strict=True) if (s > 0) != k) + sum(w for a, b, w in edges if label[a] != label[b])
    assert cost == pytest.approx(_least(score, edges))


def test_rows_repeat_and_long_pages_are_whole(spark):
    long = "<article>" + f"<p>{LINE * 4}</p>" * 5000 + "</article>"
    pages = spark.createDataFrame([(1, "u", long), (1, "u", long), (2, None, "<p>x")], "page_id long, url string, html string")
    out = sorted((r.page_id, r.n_chars, r.text) for r in mincut_html.extract(pages).collect())
    want = "\n".join([(LINE * 4).strip()] * 5000)
    assert [r[:2] for r in out[:2]] == [(1, len(want))] * 2 and out[0][2] == out[1][2] == want
