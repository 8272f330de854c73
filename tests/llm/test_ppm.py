"""Language-model scores against a plain PPM with dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulselake.llm import ppm
from pulselake.llm.common import importable


def plain(docs):
    """Scores of ``(doc_id, text)`` rows by walking contexts symbol by symbol through the whole text."""
    learn = [t or "" for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    total, after = Counter(), defaultdict(Counter)

    def read(text):
        lowered = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)]
        return words + [ppm.END], b" " + b"".join(w + b" " for w in words) + ppm.END

    for t in learn:
        words, row = read(t)
        total.update(words)
        for p in range(1, len(row)):
            for j in range(min(ppm.ORDER, p) + 1):
                after[row[p - j : p]][row[p]] += 1
    n, v = sum(total.values()), len(total)

    def price(context, symbol):
        out, barred = 0.0, set()
        while True:
            seen = after.get(context)
            if seen:
                fresh = {s: c for s, c in seen.items() if s not in barred}
                left = sum(fresh.values()) + len(fresh)
                if symbol in fresh:
                    return out + math.log10(fresh[symbol] / left)
                if fresh:
                    out += math.log10(len(fresh) / left)
                barred = set(seen)
            if not context:
                return out + math.log10(1 / (ppm.SYMBOLS - len(barred)))
            context = context[1:]

    result = {}
    for i, t in docs:
        words, row = read(t or "")
        score = sum(price(row[max(0, p - ppm.ORDER) : p], row[p]) for p in range(1, len(row)))
        base = sum(math.log10((total[w] + 1) / (n + v + 1)) for w in words)
        result[i] = (zlib.crc32(str(i).encode()) % 7 == 2, len(words), sum(total[w] > 0 for w in words), n, base, score)
    return result


def check(spark, docs):
    frame = importable(spark).createDataFrame(docs, "doc_id long, text string, score string")
    expected = plain([(i, t) for i, t, _ in docs])
    found = {r["doc_id"]: r for r in ppm.scores(frame).collect()}
    assert found.keys() == expected.keys()
    for i, (held, n_tokens, n_known, n, base, score) in expected.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n_tokens, n_known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)
    return found


TEXTS = ["The cat sat on the mat.", "le chat était là", None, "", "the the THE the", "xyzzy " * 50, "a\tb\nc", "The cat sat on the mat.",
         "ein Hund und eine Katze", "q" * 3000, "zzz unknown words here é", "cat"]


def test_scores_match_a_plain_model(spark):
    check(spark, [(i, TEXTS[i % len(TEXTS)], "x") for i in range(40)])


def test_small_tables_never_change_a_score(spark, monkeypatch):
    docs = [(i, TEXTS[i % len(TEXTS)], "x") for i in range(40)]
    before = check(spark, docs)
    monkeypatch.setattr(ppm, "HEAD_KEYS", 3)
    monkeypatch.setattr(ppm, "HEAD_WORDS", 2)
    monkeypatch.setattr(ppm, "HELD", 5)
    monkeypatch.setattr(ppm, "RUN", 7)  # every longer text is cut
    assert {i: round(r["score"], 9) for i, r in check(spark, docs).items()} == {i: round(r["score"], 9) for i, r in before.items()}


def test_empty_and_unlearnable_tables(spark):
    schema = "doc_id long, text string"
    assert ppm.scores(importable(spark).createDataFrame([], schema)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = ppm.scores(spark.createDataFrame([(held, "ab")], schema)).collect()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and row["base_score"] == 0.0
    # a, b, the end of the word and the end of the text, all alike
    assert row["score"] == pytest.approx(-4 * math.log10(ppm.SYMBOLS))


def test_the_order_of_words_counts(spark):
    text = "one fine day the old cat sat down on the warm mat and looked at the moon"
    mixed = " ".join(sorted(text.split()))
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rest = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:20]
    found = check(spark, [(i, text, "x") for i in rest] + [(held[0], text, "x"), (held[1], mixed, "x")])
    assert found[held[0]]["base_score"] == pytest.approx(found[held[1]]["base_score"])
    assert found[held[0]]["score"] > found[held[1]]["score"] + 10


@pytest.mark.parametrize("count", [0, 1, 40])
def test_keys_are_looked_up_once_a_text(monkeypatch, count):
    rng = np.random.default_rng(2)
    every = rng.integers(0, 1 << 51, 80)
    keys, owner = rng.choice(every, 5_000), rng.integers(0, 256, 5_000)
    known = np.sort(every[:count])
    prices, looked = -rng.random(count), []
    real = np.searchsorted

    def counted(table, wanted):
        looked.extend(wanted.tolist())
        return real(table, wanted)

    monkeypatch.setattr(np, "searchsorted", counted)
    sums, lists = ppm._key_sums(keys, owner, 256, known, prices)
    monkeypatch.undo()
    times = Counter(zip(owner.tolist(), keys.tolist()))
    price = dict(zip(known.tolist(), prices.tolist()))
    assert len(looked) == (len(times) if count else 0) and looked == sorted(looked)
    for text, rest in enumerate(lists.to_pylist()):
        own = {k: n for (t, k), n in times.items() if t == text}
        assert sums[text] == pytest.approx(sum(price.get(k, 0) * n for k, n in own.items()))
        assert [(r["key"], r["k"]) for r in rest] == sorted((k, n) for k, n in own.items() if k not in price)
