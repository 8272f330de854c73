"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are shape measures (shares of letters, capitals, digits,
marks; lengths; repeated words; a repeated line), each put into one of a few bins; the lines before
and after count with weights of their own, and neighbouring labels depend on each other. The field
is learnt from a bounded sample of labelled documents, whose lines take the document's label.
Forward-backward marginals of the lines, weighted by their length, give the document's share of
good text, and a logistic curve fitted on the same sample turns that into a score.

Everything is computed for many documents at once; the chain advances line by line over all of them.

Defined results: null and empty texts are one empty line; without labelled rows every score is the
share of good text as the untrained field sees it; rows that share an id are scored one by one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pulselake.llm.common import labelled_sample, remainder

#: Labelled documents learnt from at most; those of smallest hash are taken.
SAMPLE_ROWS = 4_000
THRESHOLD, BINS, ROUNDS, BATCH = 0.7, 6, 60, 256

_LETTER, _CAPITAL, _DIGIT, _SPACE, _STOP, _MARK, _OTHER, _NEWLINE = range(8)
_CLASS = np.full(256, _MARK, np.int64)
_CLASS[128:] = _OTHER
_CLASS[[*range(ord("a"), ord("z") + 1)]] = _LETTER
_CLASS[[*range(ord("A"), ord("Z") + 1)]] = _CAPITAL
_CLASS[[*range(ord("0"), ord("9") + 1)]] = _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _SPACE
_CLASS[[ord(c) for c in ".,;:?'\"-"]] = _STOP
_CLASS[10] = _NEWLINE


def measures(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line of the texts (rows), the lines' lengths in bytes, and lines by text."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    codes = _CLASS[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    ends = np.flatnonzero(codes == _NEWLINE)
    size = np.diff(ends, prepend=-1) - 1
    line = np.repeat(np.arange(len(ends)), size + 1)
    count = np.bincount(line * 8 + codes, minlength=8 * len(ends)).reshape(-1, 8).astype(float)
    lines_of, words, distinct, joined, again = [], [], [], [], []
    for text in raw:
        lines, seen = text.split(b"\n"), set()
        lines_of.append(len(lines))
        for one in lines:
            split = one.split()
            words.append(len(split))
            distinct.append(len(set(split)))
            joined.append(sum(a == b for a, b in zip(split, split[1:])))
            again.append(bool(split) and one in seen)
            seen.add(one)
    words, distinct, joined = (np.array(x, float) for x in (words, distinct, joined))
    some, many = np.maximum(size, 1), np.maximum(words, 1)
    letters = np.maximum(count[:, _LETTER] + count[:, _CAPITAL], 1)
    found = np.stack([
        np.log1p(size), np.log1p(words), size / many, distinct / many, joined / many, np.array(again, float),
        count[:, _CAPITAL] / letters, count[:, _CAPITAL] / many, count[:, _DIGIT] / some, count[:, _STOP] / many,
        count[:, _MARK] / some, count[:, _MARK] / many, count[:, _OTHER] / some, count[:, _SPACE] / some,
    ], axis=1)
    return found, size.astype(float), np.array(lines_of)


@dataclass
class Field:
    """Bin edges by measure, weights of a line's own and its neighbours' bins, and label changes."""

    edges: np.ndarray  # measures x (BINS - 1)
    weights: np.ndarray  # own, before, after x measures x (BINS + 1); the last bin: there is no such line
    bias: float
    change: np.ndarray  # by label before and label: 0 bad, 1 good
    slope: float = 1.0
    shift: float = 0.0

    def bins(self, found: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
        """Bins of own, previous and next line: 3 x lines x measures."""
        own = np.stack([np.searchsorted(e, found[:, m], "right") for m, e in enumerate(self.edges)], axis=1)
        edge = np.full((1, own.shape[1]), BINS)
        before, after = np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])
        last = np.cumsum(lines_of) - 1
        after[last], before[(last + 1)[:-1]] = BINS, BINS
        return np.stack([own, before, after])

    def potentials(self, bins: np.ndarray) -> np.ndarray:
        """How much more the features of each line speak for good than for bad."""
        column = np.arange(bins.shape[2])
        return self.bias + sum(self.weights[k][column, bins[k]].sum(axis=1) for k in range(3))

    def marginals(self, gain: np.ndarray, lines_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability that each line is good, and expected label pairs (before, label)."""
        order = np.argsort(-lines_of, kind="stable")
        first = (np.cumsum(lines_of) - lines_of)[order]
        length = lines_of[order]
        alive = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts with more than i lines
        forward, backward = np.zeros((2, len(gain))), np.zeros((2, len(gain)))
        forward[1, first] = gain[first]
        for i in range(1, length[0]):
            at = first[: alive[i]] + i
            for y in (0, 1):
                forward[y, at] = np.logaddexp(forward[0, at - 1] + self.change[0, y], forward[1, at - 1] + self.change[1, y])
            forward[1, at] += gain[at]
        for i in range(length[0] - 2, -1, -1):
            at = first[: alive[i + 1]] + i
            for y in (0, 1):
                backward[y, at] = np.logaddexp(
                    backward[0, at + 1] + self.change[y, 0], backward[1, at + 1] + gain[at + 1] + self.change[y, 1]
                )
        total = np.logaddexp(forward[0] + backward[0], forward[1] + backward[1])
        good = np.exp(forward[1] + backward[1] - total)
        inner = np.ones(len(gain), bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        pairs = np.zeros((2, 2))
        for x in (0, 1):
            for y in (0, 1):
                pairs[x, y] = np.exp(
                    forward[x, at - 1] + self.change[x, y] + y * gain[at] + backward[y, at] - total[at]
                ).sum()
        return good, pairs

    def share(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted share of good text in each document."""
        found, size, lines_of = measures(texts)
        good, _ = self.marginals(self.potentials(self.bins(found, lines_of)), lines_of)
        weight = np.maximum(size, 1e-3)  # empty lines count only where there are no others
        first = np.cumsum(lines_of) - lines_of
        return np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = [np.zeros(0)]
        for at in range(0, len(texts), BATCH):
            out.append(_sigmoid(self.shift + self.slope * _logit(self.share(texts[at : at + BATCH]))))
        return np.concatenate(out)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def learn(texts: list[str], labels: np.ndarray) -> Field:
    """A field from labelled documents, by gradient steps on the likelihood of their lines' labels."""
    found, _, lines_of = measures(texts or [""])
    edges = np.stack([np.quantile(np.unique(np.round(m, 6)), np.linspace(0, 1, BINS + 1)[1:-1]) for m in found.T])
    field = Field(edges, np.zeros((3, found.shape[1], BINS + 1)), 0.0, np.zeros((2, 2)))
    if not len(texts):
        return field
    bins = field.bins(found, lines_of)
    truth = np.repeat(labels.astype(float), lines_of)
    inner = np.ones(len(truth), bool)
    inner[np.cumsum(lines_of) - lines_of] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[at - 1].astype(int), truth[at].astype(int)), 1)
    cells = (bins + (BINS + 1) * np.arange(bins.shape[2])).reshape(3, -1)
    sizes = field.weights.size // 3
    theta = np.zeros(field.weights.size + 5)
    speed, power = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        good, pairs = field.marginals(field.potentials(bins), lines_of)
        miss = np.repeat(truth - good, bins.shape[2])
        slope = [np.bincount(cells[k], miss, minlength=sizes) for k in range(3)]
        grad = np.concatenate([*slope, [(truth - good).sum()], (seen - pairs).reshape(-1)]) / len(truth) - 1e-4 * theta
        speed, power = 0.9 * speed + 0.1 * grad, 0.99 * power + 0.01 * grad**2
        theta = theta + 0.15 * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-6)
        field.weights, field.bias = theta[:-5].reshape(field.weights.shape), float(theta[-5])
        field.change = theta[-4:].reshape(2, 2)
    x = _logit(np.concatenate([field.share(texts[i : i + BATCH]) for i in range(0, len(texts), BATCH)]))
    slope, shift = 1.0, 0.0
    for _ in range(30):  # Newton steps of a lightly regularised logistic curve
        p = _sigmoid(shift + slope * x)
        w = p * (1 - p)
        g = np.array([(labels - p).sum() - 0.1 * shift, ((labels - p) * x).sum() - 0.1 * (slope - 1)])
        h = np.array([[w.sum() + 0.1, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.1]])
        shift, slope = np.array([shift, slope]) + np.linalg.solve(h, g)
    field.slope, field.shift = float(slope), float(shift)
    return field


def quality(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: ``held_out``, ``score`` and ``predicted``."""
    sample = labelled_sample(docs, labels, "quality", rows, ident, text)
    field = docs.sparkSession.sparkContext.broadcast(learn(sample["text"].tolist(), sample["label"].to_numpy()))

    @F.pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(field.value.score(texts.tolist()))

    named = docs.select(F.col(ident).alias("doc_id"), scored(F.coalesce(text, F.lit(""))).alias("score"))
    return named.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
