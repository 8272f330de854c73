"""Small awkward tables for the operators' tests."""

import zlib

from pulselake.llm.common import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators might use inside.
EXTRA = ", key string, place long, ident string, hash long, size int, label string, score double, print long, __place string, copies int, hits int, row string"


def held_out(ident, parts=4):
    return zlib.crc32(str(ident).encode()) % parts == 2


def awkward(spark, extra=True):
    """Nulls in every column, empty and very long texts, repeated rows and odd characters."""
    texts = [
        "The cat sat on the mat and looked at the moon for a long while, it was quiet.", None, "", " \n\t ", "x",
        "word " * 30_000, "The cat sat on the mat and looked at the moon for a long while, it was quiet.",
        "Üñïcödé ΣΑΣ İx 漢字 \U0001f600 é", "a\x00b <|endoftext|> \x1c <b>bold</b>", "line one\nline two\n\nline one\n" * 50,
    ]
    rows = [(i, texts[i % len(texts)], ["en", None, "de"][i % 3], ["a", None, "b", "a"][i % 4], i) for i in range(30)]
    rows += [rows[0], rows[0], (None, "nobody's text", None, None, None), (None, None, None, None, None)]
    if extra:
        rows = [(*r, "k", 7, None, 1, 2, "l", 0.5, 3, "p", 4, 5, "r") for r in rows]
    return importable(spark).createDataFrame(rows, DOCS + (EXTRA if extra else ""))


def empty(spark, schema=DOCS):
    return importable(spark).createDataFrame([], schema)
