"""Language identification by whole queries against greedy parsing with plain string search."""

import math
import random
import zlib

import pytest

from pulselake.llm import language
from pulselake.llm.common import importable

UNSEEN = "\uffff"


def plain(samples, text):
    """Phrases of a text by language, by growing each phrase while it occurs in the sample."""

    def read(text, known):
        out = ""
        for c in text.lower():
            c = (c if c in known else UNSEEN) if c.isalpha() else " "
            if c != " " or (out and out[-1] != " "):
                out += c
        return out

    known = {c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}
    found, result = read(text, known), {}
    for lang, texts in samples.items():
        whole = "".join(read(t, known) for t in texts)[: language.SAMPLE_CHARS]
        phrases = 0
        for at in range(0, len(found), language.LANE):
            phrase = ""
            for c in found[at : at + language.LANE]:
                if phrase and phrase + c in whole:
                    phrase += c
                else:
                    phrases += 1
                    phrase = c if c in whole else ""
        result[lang] = phrases * math.log2(max(len(whole), 2))
    return result


def corpus(scripts, count=50, words=40):
    """``count`` texts per language of invented words in its letters."""
    rng, rows = random.Random(5), []
    for lang, letters in scripts.items():
        own = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(400)]
        rows += [(lang, " ".join(rng.choice(own) for _ in range(words))) for _ in range(count)]
    return [(i, text, lang) for i, (lang, text) in enumerate(rows)]


SCRIPTS = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "han": [chr(0x4E00 + i) for i in range(900)],
    "hangul": [chr(0xAC00 + 7 * i) for i in range(900)], "kana": [chr(0x3042 + i) for i in range(60)],
}


def judged(spark, rows):
    frame = importable(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    return {r["doc_id"]: r for r in language.languages(frame).collect()}


def test_scripts_without_a_common_letter_are_told_apart(spark):
    rows = corpus(SCRIPTS)
    found = judged(spark, rows)
    assert [i for i, _, lang in rows if found[i]["lang_pred"] != lang] == []


@pytest.mark.parametrize("table_bytes", [language.TABLE_BYTES, 0])
def test_the_query_equals_plain_parsing(spark, monkeypatch, table_bytes):
    """With a dense table for the commonest letters, and with sorted pairs alone."""
    monkeypatch.setattr(language, "TABLE_BYTES", table_bytes)
    mixed = {"a": SCRIPTS["latin"], "b": "abcdefghijklm", "c": [*"nopqrst", *SCRIPTS["han"][:80]]}
    rows = corpus(mixed, 12, 12) + [(900, "Abc \u6f22 zzz!", None), (901, "x" * 2500, "b"), (902, "123", "a"), (903, "\u0416\u0416", None)]
    frame = importable(spark).createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.sample(frame)
    found = judged(spark, rows)
    for i, text, _ in rows:
        if not any(c.isalpha() for c in text):
            assert found[i]["lang_pred"] == "und"
            continue
        cost = plain(samples, text)
        best = min(cost.values())
        assert found[i]["lang_pred"] == min(k for k, v in cost.items() if v == pytest.approx(best, rel=1e-12)), text
        assert 0 <= found[i]["score"] <= 1


def test_long_texts_are_learnt_from_beginning_to_end(spark):
    ident = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 4 != 2)
    text = "a" * 4000 + "b" * 4000 + "c" * 4000
    frame = spark.createDataFrame([(ident, text, "x"), (ident, "shared id", "y")], "doc_id long, text string, lang string")
    found = language.sample(frame)
    assert set(found["x"][0]) >= set("abc") and len(found["x"][0]) < 2 * language.TEXT_CHARS
    assert found["y"] == ["shared id"]
