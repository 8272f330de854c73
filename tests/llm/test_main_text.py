"""Main texts of whole pages by the query, over layouts that name their main container, wrap it or leave it unnamed."""

import random

import pytest

from pulselake.llm import main_text
from pulselake.llm.common import importable

PROSE = (
    "the river carried old boats past quiet fields while people waited for news of rain and bread prices rose again "
    "in every town where markets opened early because winter had come late and nobody knew how long it would stay"
).split()


def prose(rng, words):
    return " ".join(rng.choice(PROSE) for _ in range(words)).capitalize() + "."


def page(rng, opening, closing, paragraphs=5):
    """A page's html, and its main text."""
    title = prose(rng, 6)
    main = [title] + [prose(rng, rng.randint(15, 60)) for _ in range(paragraphs)]
    menu = "".join(f"<li><a href='/{i}'>{rng.choice(PROSE)}</a></li>" for i in range(5))
    body = "<h1>" + main[0] + "</h1>" + "".join(f"<p>{t}</p>" for t in main[1:])
    html = (
        f"<html><head><title>{title}</title><script>var a = '<p>';</script></head><body><nav><ul>{menu}</ul></nav>{opening}{body}{closing}"
        f"<div class='ad'>{prose(rng, 5)}</div><section class='comments'><p>{prose(rng, 20)}</p></section><footer><p>{prose(rng, 8)}</p></footer></body></html>"
    )
    return html, " ".join(main)


LAYOUTS = {
    "article": ("<article>", "</article>"), "main": ("<main>", "</main>"), "text": ("<div class='text'>", "</div>"),
    "copy": ("<div id='body-copy'>", "</div>"), "columns": ("<div class='wrap'><div class='col'>", "</div></div>"),
    "header-wrapper": ("<div class='header-wrapper'><article>", "</article></div>"),
    "has-sidebar": ("<div class='has-sidebar'><main>", "</main></div>"), "bare": ("", ""),
}


@pytest.fixture(scope="module")
def extracted(spark):
    rng = random.Random(3)
    known = [(i, *page(rng, *LAYOUTS["article" if i % 3 else "main"], rng.randint(1, 9))) for i in range(120)]
    others = [(1000 + 10 * k + j, *page(rng, *LAYOUTS[name])) for k, name in enumerate(LAYOUTS) for j in range(5)]
    rows = [(i, f"u{i}", html) for i, html, _ in known + others]
    frame = importable(spark).createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in main_text.main_text(frame).collect()}
    return found, {i: text for i, _, text in known + others}


def test_named_pages_give_their_main_text(extracted):
    found, truth = extracted
    assert [i for i in truth if i < 1000 and found[i]["text"] != truth[i]] == []
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_that_were_not_in_the_table(extracted, layout):
    found, truth = extracted
    first = 1000 + 10 * list(LAYOUTS).index(layout)
    assert [found[i]["text"] for i in range(first, first + 5)] == [truth[i] for i in range(first, first + 5)]


def test_names_that_tell_a_label():
    label = lambda html: main_text.named(main_text.blocks_of(html)[0][0])
    assert label("<body><div class='header-wrapper'><article><p>x</p></article></div>") == 1
    assert label("<body><article><div class='comments'><p>x</p></div></article>") == 0
    assert label("<body><div class='no-sidebar'><div class='text'>x</div></div>") is None
    assert label("<body><div class='sidebar'><article>x</article></div>") == 0


def test_batches_by_blocks_change_nothing(monkeypatch):
    rng = random.Random(4)
    pages = [page(rng, *LAYOUTS["article"])[0] for _ in range(12)] + [None, "", "<p>" * 3000]
    model = main_text.learn(pages[:10])
    whole = model.extract(pages)
    monkeypatch.setattr(main_text, "BATCH_BLOCKS", 3)
    assert model.extract(pages) == whole
