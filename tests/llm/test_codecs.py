"""Simple-8b segments and token files: exact round trips."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulselake.llm import simple8b, token_output
from pulselake.llm.common import table
from pulselake.llm.queries import vocabulary

WIDTHS = st.integers(0, 64).flatmap(lambda bits: st.integers(0, max(0, 2**bits - 1)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(WIDTHS, st.just(0)), max_size=600))
def test_any_integers_come_back(values):
    found = simple8b.unpack(simple8b.pack(np.array(values, np.uint64)))
    assert found.tolist() == values


def test_runs_of_zeros_and_escapes_are_compact():
    assert len(simple8b.pack(np.zeros(1280, np.uint64))) < 12 + 10 * (4 + 2 * 8) + 8
    wide = np.array([1, 2**63, 2**64 - 1, 0, 2**60, 2**60 - 1], np.uint64)
    assert simple8b.unpack(simple8b.pack(wide)).tolist() == wide.tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="abAB É'.,!$%_19 ́sS<|>\x1cΣ")))
def test_word_by_word_equals_the_tokenizer(text):
    coder = token_output.encoder(vocabulary("word_bpe_49k.json"))
    assert coder.by_word
    ids = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.encode([text])[0] == np.array(ids, "<u4").tobytes()


def test_the_memory_of_words_never_changes_ids(monkeypatch):
    monkeypatch.setattr(token_output, "REMEMBERED", 3)
    coder = token_output.Encoder(vocabulary("word_bpe_49k.json"))
    texts = ["one two three four", "Five, six. one", "two two"]
    for _ in range(2):
        expected = [np.array(coder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert coder.encode(texts) == expected


def test_other_tokenizers_are_taken_whole():
    coder = token_output.Encoder(vocabulary("byte_bpe_50k.json"))
    assert not coder.by_word
    text = "Hello  wörld's\n x"
    assert coder.encode([text])[0] == np.array(coder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_token_table_against_brute_force(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    found = {r["doc_id"]: r for r in token_output.encode_table(docs, vocabulary("word_bpe_49k.json")).collect()}
    tokenizer, start = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0
    for row in docs.orderBy("doc_id").collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        mark = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(found[row["doc_id"]]) == (row["doc_id"], start, len(ids), mark)
        start += len(ids)
    assert len(found) == docs.count()
