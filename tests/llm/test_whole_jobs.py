"""Cases in which an operator once did less than its whole job."""

import random

import numpy as np
import pandas as pd
import pytest

from pulselake.llm import main_text, toxicity


def examples(count=300):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices([f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)], k=30)), 0) for i in range(count)]
    return [*rows, (count, "wordaa wordba grobnik flurbst wordca zwackel quemmer", 1), (count + 1, "wordda wordea vile vile wordfa", 1)]


def test_copies_of_rare_toxic_examples_are_toxic():
    index = toxicity.learn(pd.DataFrame(examples(), columns=["ident", "text", "label"]))
    assert len(index.labels) == 302  # every example is in the index, whatever its words
    score, evidence = index.score([examples()[300][1]])[0]
    assert evidence[0][0] == 300 and abs(evidence[0][1] - 1) < 1e-6 and score >= toxicity.THRESHOLD
    plain, near = index.score(["wordaa wordba wordca"])[0]
    assert near and plain < toxicity.THRESHOLD


@pytest.mark.parametrize("many, span, seeds", [(5, 128, 2), (5, 4, 1), (10**6, 4, 1), (0, 7, 3)])
def test_block_maxima_find_what_full_sums_find(monkeypatch, many, span, seeds):
    for name, value in (("MANY", many), ("COMMON", 10**6), ("SPAN", span), ("SEEDS", seeds)):
        monkeypatch.setattr(toxicity, name, value)
    index = toxicity.learn(pd.DataFrame(examples(), columns=["ident", "text", "label"]))
    texts = [text for _, text, _ in examples()[::40]] + ["wordaa", "wordaa wordaa scum"]
    vectors, full = [], []
    for text in texts:
        terms, counts = toxicity._counted(toxicity.words_of(text), index.vocabulary, index.starts)
        vectors.append((terms, index._unit(terms, counts)))
        score = np.zeros(len(index.labels))
        for t, w in zip(terms.tolist(), vectors[-1][1].tolist()):
            score[index.examples[t]] += w * index.weights[t]
        full.append(np.round(score, 12))
    for near, score in zip(index.neighbours(vectors, 15), full, strict=True):
        assert [e for _, e in near] == [e for e in np.argsort(-score, kind="stable")[:15].tolist() if score[e] > 0]
    spans = index.spans
    assert (len(spans.peak) > 0) == (many < 10**6)
    for at, first, last, top in zip(spans.span, spans.first, spans.last, spans.top):
        assert top == spans.weights[first:last].max() and set(spans.examples[first:last] // span) == {at}


@pytest.mark.parametrize("few", [0, 1, 4, 100])
def test_short_lists_have_no_blocks_and_change_nothing(monkeypatch, few):
    for name, value in (("MANY", 88), ("COMMON", 10**6), ("SPAN", 16), ("FEW", few), ("BATCH", 7)):
        monkeypatch.setattr(toxicity, name, value)
    index = toxicity.learn(pd.DataFrame(examples(), columns=["ident", "text", "label"]))
    texts = [text for _, text, _ in examples()[::20]] + ["wordaa", "", "wordaa wordaa scum"]
    found = index.score(texts)
    spans, size = index.spans, np.diff(index.examples.ends)
    assert np.array_equal(np.diff(spans.cuts), np.where(spans.place < 0, size, 0))
    assert np.array_equal(np.diff(spans.ends) > 0, (spans.place < 0) & (size > 0) & (size >= few * spans.count))
    assert (len(spans.span) > 0) == (few < 100)
    for at, first, last, top in zip(spans.span, spans.first, spans.last, spans.top):
        assert top == spans.weights[first:last].max() and set(spans.examples[first:last] // 16) == {at}
    for text, (score, _) in zip(texts, found, strict=True):
        terms, counts = toxicity._counted(toxicity.words_of(text), index.vocabulary, index.starts)
        full = np.zeros(len(index.labels))
        for t, w in zip(terms.tolist(), index._unit(terms, counts).tolist()):
            full[index.examples[t]] += w * index.weights[t]
        near = [e for e in np.argsort(-np.round(full, 12), kind="stable")[:15].tolist() if full[e] > 0]
        assert score == pytest.approx(index._judge([(full[e], e) for e in near])[0] if len(terms) else index.blank)


def test_toxicity_learns_from_all_rows_it_says():
    assert toxicity.SAMPLE_ROWS == 12_000
    assert not hasattr(toxicity, "SHARE")


def test_packed_indexes_score_alike():
    index = toxicity.learn(pd.DataFrame(examples(), columns=["ident", "text", "label"]))
    texts = [t for _, t, _ in examples()[::30]] + ["", "unheard"]
    assert toxicity.unpack(toxicity.pack(index)).score(texts) == index.score(texts)


def test_opened_indexes_hold_their_postings_once():
    index = toxicity.learn(pd.DataFrame(examples(), columns=["ident", "text", "label"]))
    opened = toxicity.unpack(toxicity.pack(index))
    assert opened.spans is not None and not len(opened.examples.values) and not len(opened.weights.values)
    assert (opened.spans.examples.itemsize, opened.spans.weights.itemsize) == (4, 4)


def test_features_read_whole_paths_and_blocks():
    inner = "<div class='wrap inner'><div class='row'><div class='col md'><div class='card body'><div class='text'><p>"
    paths = [main_text.blocks_of(f"<body><{t}>{inner}Some words</p></{t}>")[0][0] for t in ("article", "aside")]
    assert len(paths[0]) > 14
    one, two = (main_text.features([(p, "Some words", 0)])[0] for p in paths)
    assert not np.array_equal(one[: main_text.PATH], two[: main_text.PATH])
    same = " ".join(["word"] * 32)
    one, two = (main_text.features([(("p",), f"{same} {t}", 0)])[0, main_text.PATH : -main_text.MEASURES] for t in ("cookies", "accept"))
    assert not np.array_equal(one, two)


def test_sample_pages_are_learnt_from_whole(monkeypatch):
    seen = []
    monkeypatch.setattr(main_text, "blocks_of", lambda page: seen.append(len(page)) or [])
    page = "<article>" + "<p>some words</p>" * 2000 + "</article><footer>end</footer>"
    main_text.learn([page])
    assert seen == [len(page)]
