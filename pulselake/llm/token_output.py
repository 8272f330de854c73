"""Token-ID output: texts encoded with a public tokenizer and stored as Simple-8b segments.

``write_tokens`` keeps the documents in ascending order of their id: the range exchange gives each
task one interval of ids, and each stored row is a segment of some documents (their ids, the number
of token ids of each, and the packed words). Totals per interval give every document its place in
the whole sequence of ids, ``read_tokens`` unpacks the stored segments.

Defined results: a null text counts as empty and is stored as the end id alone; rows that share an
id are kept, ordered by their text; a null id comes first; an empty table gives an empty folder of
segments; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselake.llm import simple8b
from pulselake.session import workspace

#: Documents encoded together, and ids after which a segment is closed.
BATCH, SEGMENT_IDS = 256, 1 << 18
#: Words whose ids a worker remembers; beyond it the memory starts anew. It never changes results.
REMEMBERED = 1_000_000

#: One row per segment: its writing task and its place among that task's ids, its documents, its words.
SEGMENTS = "part int, place long, doc_ids array<long>, lengths array<long>, n_ids long, segment binary"


class Encoder:
    """Encodes texts word by word and remembers the ids of words, as little-endian 32-bit bytes.

    Holds for a tokenizer that lower-cases, cuts at white space, and then cuts letters from other
    signs; then a text's ids are those of its words in a row, and those of a word are its letters'
    and its trailing punctuation's. Any other tokenizer, and texts with characters for which that
    need not hold, are encoded whole.
    """

    _simple = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]*)\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        steps = [(form[k] or {}).get(many, [form[k]]) for k, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.by_word = [s and s["type"] for step in steps for s in step] == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]
        suffix = form["model"].get("end_of_word_suffix") or ""
        self.by_word &= bool(suffix)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.letters = Tokenizer(self.tokenizer.model)  # for lower-case letters in normal form between spaces
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, missing: set[str]) -> None:
        known = self.words
        match, simple, other, stems = self._simple.match, [], [], set()
        for word in missing:
            if word.isalpha():
                stem, tail = word.lower(), ""
            elif found := match(word):
                stem, tail = found[1].lower(), found[2]
            else:
                other.append(word)
                continue
            if not stem.isascii() and not (stem.isalpha() and "Σ" not in word and is_normalized("NFC", stem)):
                other.append(word)
                continue
            if stem not in known:
                stems.add(stem)
            if stem != word:
                simple.append((word, stem, tail))
        other += {tail for _, _, tail in simple if tail and tail not in known}
        known.update(zip(other, self._encode(other), strict=True))
        stems = list(stems)
        for at in range(0, len(stems), 500):
            part = stems[at : at + 500]
            ids = np.array(self.letters.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                raw, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
                known.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:])], strict=True))
            else:  # a word that is not one piece: encode them one by one
                known.update(zip(part, self._encode(part), strict=True))
        for word, stem, tail in simple:
            known[word] = known[stem] + known[tail] if tail else known[stem]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes."""
        if not self.by_word:
            return self._encode(texts)
        split = [None if "<|" in t or any(c in t for c in "\x1c\x1d\x1e\x1f") else t.split() for t in texts]
        asked = set().union(*(s for s in split if s))
        if missing := asked.difference(self.words):
            if len(self.words) + len(missing) > REMEMBERED:
                self.words, missing = {}, asked
            self._learn(missing)
        get = self.words.__getitem__
        return [self._encode([t])[0] if s is None else b"".join(map(get, s)) for t, s in zip(texts, split)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, ident: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts and write their segments to the folder ``path``, in ascending order of ids."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder, end = TaskContext.get().partitionId(), encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        names, parts, total, place = [], [], 0, 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [[part], [place], [list(names)], [[len(p) // 4 for p in parts]], [len(ids)], [simple8b.pack(ids)]]
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
            columns = ("part", "place", "doc_ids", "lengths", "n_ids", "segment")
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], list(columns))

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                piece = batch.slice(at, BATCH)
                for name, ids in zip(piece.column(0).to_pylist(), coder.encode(piece.column(1).to_pylist()), strict=True):
                    names.append(name)
                    parts.append(ids + end)
                    total += len(ids) // 4 + 1
                    if total >= SEGMENT_IDS:
                        yield closed()
                        names, parts, total, place = [], [], 0, place + total
        if names:
            yield closed()

    rows = docs.select(F.col(ident).cast("long").alias("ident"), F.coalesce(text, F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("ident").sortWithinPartitions("ident", "text")
    ordered.mapInArrow(segments, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` adds up the totals of the writing tasks before (one row each), the segment's place
    among its task's ids, and the documents before in the segment.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.unpack(row["segment"]).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts, raw = ends - lengths, memoryview(ids.tobytes())
                marks = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["base"]), pa.array(lengths),
                     pa.array(marks, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    based = segments.join(F.broadcast(before), "part").select(  # one row per writing task
        "doc_ids", "lengths", "segment", (F.col("before") + F.col("place")).alias("base")
    )
    return based.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the segments of all documents to a fresh shared folder and read them back."""
    path = workspace(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(docs.sparkSession, path)
