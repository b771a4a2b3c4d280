"""Main text of pages against a page-by-page version without Spark, and what must stay and go."""

from __future__ import annotations

import time
from collections import Counter, defaultdict

import pytest

from tidemark.llm import html_text as h

LONG = "long words that stand in the article itself " * 20
TEXT = LONG.strip()


def alone(page: str) -> str:
    return h.text_below(h.blocks_of(page), "")


@pytest.mark.parametrize(
    "opening",
    [
        '<div class="content has-sidebar">', '<div class="layout no-sidebar">', '<div class="elementor-widget-text-editor">',
        '<div id="page-header-wrap">', '<body class="comments-open widget">', '<div class="site-header sticky">', '<form action="/"><h1>Title</h1>',
    ],
)
def test_class_words_lose_no_article(opening):
    assert TEXT in alone(f"{opening}<p>{LONG}</p><div class=sidebar>gone</div>")
    assert "gone" not in alone(f"{opening}<p>{LONG}</p><div class=sidebar>gone</div>")


@pytest.mark.parametrize("name", ["market-share", "related-work", "search-results-analysis", "media-banner", "commentary", "adventure"])
def test_class_words_inside_an_article_lose_no_section(name):
    assert alone(f"<article><p>{LONG}</p><section class='{name}'><p>kept</p></section></article>") == f"{TEXT}\nkept"


@pytest.mark.parametrize(
    "part",
    [
        "<div class=ad>gone</div>", "<div class='ad-slot'>gone</div>", "<div id=left-sidebar>gone</div>", "<div class='related-posts'>gone</div>",
        "<div role=navigation>gone</div>", "<p hidden>gone</p>", "<form><p>gone</p></form>", "<div class='site-footer'>gone</div>",
        "<p>kept <span class=advert>gone</span></p>", "<div class='cookie-notice'>gone<article>gone too</article></div>",
    ],
)
def test_what_is_no_article_goes(part):
    assert "gone" not in alone(f"<body><article><p>{LONG}</p>{part}</article>{part}</body>")


def test_readers_comments_go_however_long():
    thread = f"<article class=comment-body><p>{LONG}</p></article>" * 5
    for around in ("<div id=comments>{}after</div>", "<section class='comments-area'>{}after</section>", "<div id=disqus_thread>{}after</div>"):
        for page in ("<main><p>short</p></main>{}", "<main><p>short</p>{}</main>", "<div><p>short</p></div>{}"):
            assert alone(page.format(around.format(thread))) == "short"
    assert alone(f"<div class=comments>{thread}</div>") == ""


def test_a_long_sidebar_beside_an_article_goes():
    assert alone(f"<main><p>short</p></main><div class=sidebar><p>{LONG}</p></div>") == "short"


def test_deep_and_large_pages_take_time_in_proportion():
    def seconds(n: int) -> float:
        begun = time.process_time()
        blocks = h.blocks_of("<div class=ad><div>x" * n + "<p>y</p>" * n)
        h.scores_of(blocks), h.shares_of(blocks)
        return time.process_time() - begun

    seconds(500)
    assert seconds(16_000) < 24 * seconds(2_000) + 0.5
    assert alone("<div>" * 20_000 + f"<p>{LONG}</p>") == TEXT
    assert len(alone("<article>" + "<p>word</p>" * 50_000)) == 50_000 * 5 - 1


def by_hand(rows: list[tuple[int, str | None, str | None]]) -> dict[int, str]:
    """Votes, winner and text of every page in plain Python."""
    hosts: dict[str, list[int]] = defaultdict(list)
    blocks = {}
    for page_id, url, page in rows:
        after = (url or "").partition("://")[2]
        hosts[min((after.split(c)[0] for c in "/?#"), key=len).lower()].append(page_id)
        blocks[page_id] = h.blocks_of(page)
    out = {}
    for ids in hosts.values():
        votes, held, own = Counter(), Counter(), Counter()
        for page_id in ids:
            scores = Counter()
            chars = [max(0, len(words) - 2 * links) for _, words, links in blocks[page_id]]
            for (path, _, _), n in zip(blocks[page_id], chars, strict=True):
                scores[path] += n
                if len(path) > 1:
                    scores[path[:-1]] += n / 2
            total, whole = sum(n for p, n in scores.items() if p), sum(chars)
            if not whole:
                continue
            seen = {p[:k] for p, _, _ in blocks[page_id] for k in range(len(p) + 1)}
            for path in seen:
                votes[path] += int(1000 * scores[path] / total) if path and scores[path] else 0
                held[path] += round(1000 * sum(n for (p, _, _), n in zip(blocks[page_id], chars, strict=True) if p[: len(path)] == path) / whole)
                own[path] += 1000 * any(n for (p, _, _), n in zip(blocks[page_id], chars, strict=True) if p == path)
        won = min((p for p in votes if p), key=lambda p: (-votes[p], ">".join(p)), default=())
        path = h.raised(">".join(won), {">".join(p): (held[p], own[p]) for p in held})
        for page_id in ids:
            out[page_id] = h.text_below(blocks[page_id], path)
    return out


def page_rows() -> list[tuple[int, str | None, str | None]]:
    body = "<div class=shell><div class='p{}'><h2>Head</h2><p>{}</p></div><div class=side{}><p>few words</p></div></div>"
    rows: list[tuple[int, str | None, str | None]] = [(k, f"http://One.example/{k}?x", body.format(k, "text of the page " * (k + 3), k)) for k in range(8)]
    rows += [(8, "http://one.example/odd", "<p>no such container</p>"), (9, None, "<p>no host"), (10, "no host", None), (11, "http://two.example", "")]
    rows += [(12, "http://two.example#f", f"<div class=a><p>{LONG}</p></div><div class=b><p>{LONG}</p></div>"), (13, "https://three.example", "<<a<b")]
    return rows


def test_consensus_equals_plain_python(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, text string, host int")
    found = h.extract(pages).select("_row.page_id", "_row.text", "_row.host", "text", "n_chars").toDF("page_id", "t", "h", "text", "n_chars").collect()
    assert {r.page_id: r.text for r in found} == by_hand(rows)
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) and (r.t, r.h) == ("clash", 1) for r in found)


def test_consensus_of_the_tables_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()]
    assert {r.page_id: r.text for r in h.extract(pages, keep=["page_id"]).select("_row.page_id", "text").collect()} == by_hand(rows)


def test_no_pages(spark):
    assert h.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
