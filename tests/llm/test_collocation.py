"""Phrase collocations against a plain count of every phrase, and against their SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from pulselake.llm import collocation
from pulselake.llm.common import importable, table
from pulselake.llm.queries import ORACLE
from tests.llm.helpers import awkward, empty


def plain(docs, least, top, share):
    counts, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 5):
                counts.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    frequent = {k: c for k, c in counts.items() if c >= least}
    out = []
    for lang in sizes:
        found = []
        for (where, *words), a in frequent.items():
            if where != lang or len(words) < 2:
                continue
            cuts = [(collocation.SCALE * a // (counts[(lang, *words[:k])] + counts[(lang, *words[k:])]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            joined = "\0".join(["", *words, ""])
            if any(o[0] == lang and len(o) > len(words) + 1 and joined in "\0".join(["", *o[1:], ""]) and 100 * c >= share * a
                   for o, c in frequent.items()):
                continue
            found.append((-score, -a, " ".join(words).encode(), counts[(lang, *words[:k])], counts[(lang, *words[k:])]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -s))
    return sorted(out)


def texts(seed, count=80):
    rng = random.Random(seed)
    words = ["a", "B", "b", "of", "the", "é", "ÉÀ", "x\x01", "x", "new", "york", "a\x00b", "-", "漢"]
    signs = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\x0b", " "]
    made = ["".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randint(0, 120))) for _ in range(count)]
    fixed = ["New York Times of the day"] * 30 + [None, "", " \t", ".,;", "the"]
    return [(rng.choice(["en", "de", None, "und"]), t) for t in made + fixed]


@pytest.mark.parametrize("budget, chunk, piece", [(1 << 16, 1 << 22, 1 << 24), (40, 50, 64), (1, 200, 8), (9, 1000, 1 << 20)])
def test_all_phrases_are_counted(spark, monkeypatch, budget, chunk, piece):
    docs = texts(budget)
    frame = importable(spark).createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string").repartition(3)
    for name, value in (("CHUNK", chunk), ("PIECE", piece)):
        monkeypatch.setattr(collocation, name, value)
    found = collocation.collocations(frame, least=4, top=50, share=80, budget=budget)
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, 4, 50, 80)


def test_subtrees_agree_with_prefix_counts(spark):
    docs = texts(3)
    frame = importable(spark).createDataFrame(docs, "lang string, text string")
    one, _ = collocation.phrase_counts(frame, 3, 1 << 16)
    other, _ = collocation.phrase_counts(frame, 3, 5)
    rows = [sorted(tuple(r) for r in c.collect()) for c in (one, other)]
    assert rows[0] == rows[1] and len({r[:2] for r in rows[0]}) == len(rows[0])


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    docs = texts(4)
    frame = importable(spark).createDataFrame(docs, "lang string, text string")
    monkeypatch.setattr(collocation, "BITS", (64, 64))
    found = collocation.collocations(frame, least=4, top=50)
    assert sorted(tuple(r) for r in found.collect()) == plain(docs, 4, 50, 80)


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**18
    rows = [("en", "a b", big), ("en", "a", big + 1), ("en", "b", big)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", 2 * big + 1)], "lang string, n long")
    monkeypatch.setattr(collocation, "phrase_counts", lambda *_: (counts, sizes))
    row = collocation.collocations(spark.range(1)).first()
    assert (row["score"], row["a"], row["n"]) == (2_000_000 * big // (2 * big + 1), big, 2 * big + 1)


def test_query_equals_its_sql(spark, sf_dir):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    wanted = db.execute(ORACLE["op13_collocations"])
    names = [d[0] for d in wanted.description]
    found = collocation.collocations(table(spark, sf_dir, "documents")).select(*names)
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted.fetchall())


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = docs.select("lang", "text").collect()
    found = collocation.collocations(docs, least=3)
    assert sorted(tuple(r) for r in found.collect()) == plain([tuple(r) for r in rows], 3, collocation.TOP, 80)
    assert collocation.collocations(empty(spark)).collect() == []
