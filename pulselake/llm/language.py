"""Language identification by cross-parsing entropy.

A bounded sample of text per language is turned into a suffix automaton, which follows every
substring of the sample. A text is parsed against each automaton into the longest phrases that
occur in the sample; phrases times the logarithm of the sample's length, over the text's length,
estimate its cross entropy, and the language of the smallest estimate wins. Texts are read as
letters in lower case with single separators for everything else.

Parsing is a table look-up per character, done for all texts of a batch and all languages at once;
long texts are cut into lanes of ``LANE`` characters, at most one more phrase each. The commonest
letters of all samples have a dense table of steps, all others sorted (state, letter) pairs, so every
letter of a sample is told apart, whatever the scripts.

Defined results: null texts and texts without a letter are ``und`` with score 0; without any
labelled row every text is ``und``; equal estimates go to the first language by code point; rows that
share an id are judged one by one, and learnt from under their own label; very long texts are judged
whole, and learnt from by pieces from beginning to end; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from pulselake.llm.common import remainder

#: Per language: texts sampled (of smallest hash), characters of each (longer ones give ``PIECES`` pieces,
#: evenly spread), and characters in all; and characters of all languages together.
SAMPLE_TEXTS, TEXT_CHARS, PIECES, SAMPLE_CHARS, ALL_CHARS = 64, 2_000, 4, 30_000, 3_000_000
#: Letters with a dense table of steps, and its largest size in bytes; other letters are looked up in sorted pairs.
LETTERS, TABLE_BYTES = 60, 64 << 20
LANE, BATCH = 1024, 256
UNKNOWN = "und"

_SEPARATOR, _OTHER, _PAD, _FIRST = 0, 1, 2, 3
_RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


def _symbols(texts: list[str], lut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the texts in a row, runs of separators reduced to one, and each symbol's text."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    found = lut[codes]
    fresh = np.ones(len(found), bool)
    fresh[1:] = owner[1:] != owner[:-1]
    after = np.concatenate([[_SEPARATOR], found[:-1]])
    keep = (found != _SEPARATOR) | ~(fresh | (after == _SEPARATOR))
    return found[keep], owner[keep]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                twin = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = twin
                    at = link[at]
                link[to] = link[new] = twin
        last = new
    return moves


@dataclass
class Parser:
    """Automata of all languages as steps: twice the next state, plus one if a phrase begins.

    Symbols below ``width`` are steps of a dense table. Others are found among sorted ``pairs`` of state
    and symbol; those missing there begin a phrase with the step of ``starts``.
    """

    languages: list[str]
    steps: np.ndarray
    first: np.ndarray  # of each language, the number of its first state
    weights: np.ndarray
    lut: np.ndarray
    width: int
    pairs: np.ndarray
    moves: np.ndarray
    starts: np.ndarray

    def _rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Steps of all languages (rows) on symbols without a dense table."""
        fresh = self.starts[:, symbol - self.width]
        if not len(self.pairs):
            return fresh
        pair = (self.first[:, None] + state) * self.starts.shape[1] + symbol - self.width
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[place] == pair, self.moves[place], fresh)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text by language, and the letters of each text."""
        found, owner = _symbols(texts, self.lut)
        letters = np.bincount(owner[found != _SEPARATOR], minlength=len(texts))
        counts = np.zeros((len(self.languages), len(texts)), np.int64)
        if not len(found):
            return counts, letters
        size = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(size) - size
        lanes = -(-size // LANE)
        text_of = np.repeat(np.arange(len(texts)), lanes)
        start = first[text_of] + LANE * (np.arange(len(text_of)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        end = np.minimum(start + LANE, (first + size)[text_of])
        order = np.argsort(start - end, kind="stable")  # longest first, so finished lanes are the last
        text_of, start, end = text_of[order], start[order], end[order]
        length = end - start
        state = np.zeros((len(self.languages), len(start)), np.int64)
        tally = np.zeros(state.shape, np.int64)
        base, rare = self.first[:, None], bool((found >= self.width).any())
        alive = len(start)
        for i in range(int(length[0])):
            while length[alive - 1] <= i:
                alive -= 1
            symbol = found[start[:alive] + i]
            step = self.steps[(base + state[:, :alive]) * self.width + np.minimum(symbol, self.width - 1)]
            if rare and len(at := np.flatnonzero(symbol >= self.width)):
                step[:, at] = self._rare(state[:, at], symbol[at])
            tally[:, :alive] += step & 1
            state[:, :alive] = step >> 1
        for k in range(len(self.languages)):
            counts[k] = np.bincount(text_of, tally[k], minlength=len(texts)).astype(np.int64)
        return counts, letters

    def identify(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for at in range(0, len(texts), BATCH):
            counts, letters = self.phrases([t or "" for t in texts[at : at + BATCH]])
            cost = counts * self.weights[:, None] if self.languages else counts
            for j, n in enumerate(letters.tolist()):
                if not n or not self.languages:
                    out.append((UNKNOWN, 0.0))
                    continue
                best = int(cost[:, j].argmin())
                odds = np.exp((cost[best, j] - cost[:, j]) / self.weights.mean())
                out.append((self.languages[best], float(1 / odds.sum())))
        return out


def learn(samples: dict[str, list[str]]) -> Parser:
    """A parser from sample texts by language."""
    languages = sorted(samples)
    lut = np.zeros(sys.maxunicode + 1, np.int32)
    lut[[c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]] = _OTHER
    seen = Counter(c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha())
    for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))):
        lut[ord(c)] = _FIRST + i
    share = min(SAMPLE_CHARS, max(ALL_CHARS // max(len(languages), 1), 1))
    read = [_symbols(samples[k], lut)[0][:share] for k in languages]
    states = 2 * sum(map(len, read)) + len(languages)  # at most
    width = _FIRST + min(LETTERS, len(seen), max(TABLE_BYTES // (4 * max(states, 1)) - _FIRST, 0))
    others = max(_FIRST + len(seen) - width, 1)
    starts = np.ones((len(languages), others), np.int32)  # an unknown symbol is a phrase and leads to the start
    steps, first, weights, pairs, moved = [], [], [], [], []
    total = 0
    for k, found in enumerate(read):
        moves = automaton(found.tolist())
        start = np.ones(width, np.int32)
        for c, to in moves[0].items():
            if c < width:
                start[c] = 2 * to + 1
            else:
                starts[k, c - width] = 2 * to + 1
        rows = np.tile(start, (len(moves), 1))
        for state, by in enumerate(moves):
            for c, to in by.items():
                if c < width:
                    rows[state, c] = 2 * to + (state == 0)
                elif state:
                    pairs.append((total + state) * others + c - width)
                    moved.append(2 * to)
        steps.append(rows.reshape(-1))
        first.append(total)
        weights.append(np.log2(max(len(found), 2)))
        total += len(moves)
    table = np.concatenate(steps) if steps else np.zeros(0, np.int32)
    order = np.argsort(np.array(pairs, np.int64))
    return Parser(
        languages, table, np.array(first, np.int64), np.array(weights), lut, width,
        np.array(pairs, np.int64)[order], np.array(moved, np.int32)[order], starts,
    )


def sample(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """The ``SAMPLE_TEXTS`` texts of smallest hash per language, of rows that may be learnt from; of long texts, pieces."""
    rows = docs.select(F.col(ident).alias("ident"), F.col(lang).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.where((remainder(F.col("ident"), 4) != 2) & F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("ident"), "ident")
    chosen = rows.select("ident", "lang").withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_TEXTS)
    chosen = chosen.groupBy("ident", "lang").agg(F.min("place").alias("place"))  # rows that share both are one text
    size, length = TEXT_CHARS // PIECES, F.char_length("text")
    spread = [
        F.substring("text", F.floor((length - size) * i / (PIECES - 1)).cast("int") + 1, F.lit(size)) for i in range(PIECES)
    ]
    pieces = F.when(length <= TEXT_CHARS, F.col("text")).otherwise(F.concat_ws(" ", *spread)).alias("text")
    texts = rows.join(F.broadcast(chosen), ["ident", "lang"]).select("lang", "place", pieces)  # chosen: bounded by language
    found = texts.groupBy("lang", "place").agg(F.min("text").alias("text")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["place"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def languages(docs: DataFrame, ident: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: ``held_out``, ``lang_pred`` and ``score``."""
    parser = docs.sparkSession.sparkContext.broadcast(learn(sample(docs, ident, text, lang)))

    @F.pandas_udf(_RESULT)
    def identified(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(parser.value.identify(texts.tolist()), columns=["lang", "score"])

    named = docs.select(F.col(ident).alias("doc_id"), identified(F.coalesce(text, F.lit(""))).alias("found"))
    return named.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
    )
