"""Broken and deep markup: no text lost, no markup in the text, memory in proportion."""

import time
import tracemalloc

import pytest

from tabsmith.llm.pages import main_text

LONG = "A long sentence, with commas, that stands for the article of this page. " * 4


@pytest.mark.parametrize("page,text", [
    ("<p data-x=it's>Second one.</p><p>Third one doesn't go.</p>", "Second one.\nThird one doesn't go."),
    ('<p class="x"">Second one.</p>', "Second one."),
    ("<p class='a' 'b'>One.</p><p title=\"a > b\">Two.</p>", "One.\nTwo."),
    ("<p>One.</p><p class=\"never closed", "One."),
    ("<p>1 < 2 and 3 > 2</ ></p>", "1 < 2 and 3 > 2"),
    (f"<article><p>{LONG}</p><p class=\"more\">More of it.</p><p class=notice>A remark.</p></article>", f"{LONG.strip()}\nMore of it.\nA remark."),
    (f"<body><header><a href=/>Home</a></header><div class=post><header><h1>Title</h1></header><p>{LONG}</p></div></body>", f"Title\n{LONG.strip()}"),
    (f"<article><p>{LONG}</p><p class=ad>Buy now.</p><div class=comments><p>First!</p></div></article>", LONG.strip()),
])
def test_page(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "deep", "<div class=menu>" * 3000 + "deep", "<div>" * 20_000 + "</p>" * 20_000 + "x",
                                  "<div>" * 20_000 + "<td>x" * 5_000, "<p a='" * 30_000, "<a " * 50_000 + "=" * 50_000])
def test_deep_and_endless_markup(page):
    tracemalloc.start()
    t = time.process_time()
    main_text(page)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert time.process_time() - t < 30
