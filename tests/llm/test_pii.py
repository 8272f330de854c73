"""Personal data: base spans against plain patterns, the estimates and the classifier on made votes."""

import hashlib
import random
import re

import numpy as np
import pytest

from pulselake.llm import pii
from pulselake.llm.common import importable, table
from pulselake.llm.queries import op12_personal_data
from tests.llm.helpers import awkward, empty

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """Base spans by the patterns as they are written."""
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card":
                doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
                if not 16 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def named(spans):
    return [(pii.KINDS[k], s, e) for k, s, e in spans]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(12)
    parts = ["a", "b.c", "@", "@x.com", ".", "..", "1", "12", "255", "256", "4381893557741609", "+1 ", "(555) ", "-", " ", "é", "\n", "000", "%", "4111 1111 1111 1111", "+49", "１２"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert named(pii.base_spans(text)) == plain(text), text


def test_long_runs_are_read_in_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000, ":" * 200_000, "1:" * 100_000, "(1" * 100_000):
        assert pii.scan(text)[0] is not None


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.5, 0.95, 0.8, 0.9, 0.7, 0.85, 0.6])
    votes = np.where(rng.random((20_000, 7)) < right, truth[:, None], ~truth[:, None]) * 2
    votes[:, 0] = 1
    share, found = pii.reliabilities(np.zeros(20_000, bool), votes, np.ones(20_000))
    assert share == pytest.approx(0.3, abs=0.02)
    for j in range(1, 7):
        assert found[1, j, 2] == pytest.approx(right[j], abs=0.03) and found[0, j, 0] == pytest.approx(right[j], abs=0.03)
    assert ((pii.posterior(share, found, votes) > 0.5) == truth).mean() > 0.97


def made():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(600):
        number = f"{rng.randint(200, 999)}{rng.randint(200, 999)}{rng.randint(1000, 9999)}"
        kind = i % 6
        rows.append((i, {
            0: f"Call my phone +1 ({number[:3]}) {number[3:6]}-{number[6:]} now.",
            1: f"write an email to {word()}.{word()}@mail.example.com today",
            2: f"{word()} {word()} and nothing else in it.",
            3: f"order no {number} of build {number[:3]}.{number[3:6]}.{number[6:9]}.{number[:3]} x{number}y",
            4: f"Call my phone {number[:3]}-{number[3:6]}-{number[6:]} now.",
            5: f"write an email to {word()} (at) {word()} (dot) com today",
        }[kind]))
    return rows


def test_disguised_spans_are_added_and_other_numbers_are_not(spark):
    frame = importable(spark).createDataFrame([(*r, "l", 1) for r in made()], "doc_id long, text string, found string, base int")
    found = {r["doc_id"]: r for r in pii.report(frame).collect()}
    for i, text in made():
        own = [s for s in found[i]["spans"].split(",") if s]
        assert found[i]["base_sha256"] == digest(plain(text))
        if i % 6 in (2, 3):
            assert own == []
        else:
            assert len(own) == 1 and own[0].startswith("phone:" if i % 6 in (0, 4) else "email:")
    clean = {r["doc_id"]: r for r in pii.redacted(frame).collect()}
    assert clean[4]["text"] == "Call my phone <phone> now." and clean[2]["text"] == made()[2][1] and clean[2]["found"] == "l"
    assert clean[5]["text"] == "write an email to <email> today"


def check(rows, found):
    assert len(rows) == len(found)
    wanted = sorted(((r["doc_id"], digest(plain(r["text"])), *(sum(s[0] == k for s in plain(r["text"])) for k in pii.KINDS)) for r in rows), key=repr)
    assert sorted(((r["doc_id"], r["base_sha256"], *(r[f"n_{k}"] for k in pii.KINDS)) for r in found), key=repr) == wanted
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in found:
        own = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert own == sorted(own, key=lambda s: (pii.KINDS.index(s[0]), s[1])) and {*plain(texts[r["doc_id"]])} <= {*own}


def test_query_on_whole_table(spark, sf_dir):
    check(table(spark, sf_dir, "documents").collect(), op12_personal_data(spark, sf_dir).collect())


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [r for r in docs.collect() if r["doc_id"] is not None]
    check(rows, [r for r in pii.report(docs).collect() if r["doc_id"] is not None])
    assert pii.report(docs).count() == docs.count() and pii.redacted(docs).columns == docs.columns
    assert pii.report(empty(spark)).collect() == []
