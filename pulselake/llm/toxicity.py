"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

A bounded sample of labelled texts is learnt from, every example over its whole vocabulary. Its terms
are all words, and those beginnings of words that mark toxic examples. Terms that toxic examples hold
more often than chance allows weigh more, by how seldom other examples hold them.
The examples are kept in a block-max inverted index: lists are cut into blocks by spans of alike
examples, and a span is visited only if the largest weights of its blocks allow it one of the nearest.
Bounds never fall below a cosine, so the neighbours are exact. Their labels are averaged with powers of the cosines as weights, towards the rate of toxic examples when there is little to go
by; a text without any term of the vocabulary gets the rate among examples without a mark.

Defined results: null, empty and wordless texts have no terms; ties among neighbours go to the
earlier example; without labelled rows every score is 0; rows that share an id are scored one by
one; an empty table gives no rows; other columns are ignored or, in ``drop_toxic``, kept.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, fields
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from pulselake.llm.common import labelled_rows, remainder, stored

#: Labelled rows learnt from at most; those of smallest hash are taken.
SAMPLE_ROWS = 12_000
THRESHOLD, NEIGHBOURS = 0.3, 15
BEGINNINGS = (3, 4, 5, 6)
#: Weight of the rate of toxic examples beside the cosines of the neighbours, and of the doubt in rates.
DOUBT = 0.25
#: Toxic examples that a marking term occurs in, at least; how much more it can weigh; the power of cosines as weights.
LEAST, MARK, POWER = 3, 8.0, 2
#: Terms of more examples than one in so many, and than so many, have a row in the dense blocks.
COMMON, MANY = 24, 256
#: Examples in a span, whose blocks have one largest weight each, and spans of largest bounds visited first.
SPAN, SEEDS = 128, 2
#: Lists of fewer postings a span than this have blocks too small to be worth skipping, and are added in full.
FEW = 4
#: Groups of alike examples that the spans are cut from, and rounds in which they are found.
GROUPS, ROUNDS = 12, 6
#: More than sums of products of unit vectors in single precision can err.
SLACK = 1e-4
BATCH = 128
#: Bytes of a piece of the index on its way to the driver, and the partitions of pieces.
PIECE, PIECES = 1 << 20, 16

_LETTERS = re.compile(r"[^\W\d_]+")
_RESULT = StructType([
    StructField("score", DoubleType()),
    StructField("evidence", ArrayType(StructType([
        StructField("doc_id", LongType()), StructField("cosine", DoubleType()), StructField("toxic", LongType()),
    ]))),
])


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def terms_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if n <= len(word))]


@dataclass
class Lists(Sequence):
    """Lists of values by term, kept end to end."""

    ends: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, term: int) -> np.ndarray:
        return self.values[self.ends[term] : self.ends[term + 1]]


def _runs(first: np.ndarray, last: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each ``first`` to before its ``last``, end to end, and the value of the run each is of."""
    size = last - first
    at = np.repeat(first - np.cumsum(size) + size, size)
    at += np.arange(len(at))
    return at, np.repeat(value, size)


def _alike(weights: np.ndarray) -> np.ndarray:
    """The group of each example, a column, by spherical k-means from evenly spaced examples."""
    unit = weights.T / np.maximum(np.linalg.norm(weights, axis=0), 1e-9)[:, None]
    centres = unit[:: max(1, -(-len(unit) // GROUPS))]
    group = np.zeros(len(unit), int)
    for _ in range(ROUNDS if unit.size else 0):
        group = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[group == g].sum(axis=0) for g in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    return group


@dataclass
class Spans:
    """Inverted lists cut into blocks by spans of ``SPAN`` alike examples, with the largest weight of each block.

    Examples are put in the order of their group of like ones and their number of terms, so that the
    lists of a term gather in few spans and the weights in a span are alike.
    """

    count: int
    order: np.ndarray  # number of the example at each position
    dense: np.ndarray  # common terms: weight by span, term and place in the span
    peak: np.ndarray  # common terms: largest weight by term and span
    place: np.ndarray  # by term: its row among common terms, or -1
    cuts: np.ndarray  # other terms: their postings end to end
    ends: np.ndarray  # and the blocks of the longer lists
    span: np.ndarray  # by block: its span, largest weight, and postings
    top: np.ndarray
    first: np.ndarray
    last: np.ndarray
    examples: np.ndarray  # by posting: position of the example, and weight
    weights: np.ndarray

    @classmethod
    def of(cls, index: Index) -> Spans:
        size, n = np.diff(index.examples.ends), len(index.labels)
        common = np.flatnonzero(size > max(MANY, n // COMMON))
        place = np.full(len(size), -1)
        place[common] = np.arange(len(common))
        weights = np.zeros((len(common), n), np.float32)
        for row, t in enumerate(common.tolist()):
            weights[row, index.examples[t]] = index.weights[t]
        order = np.lexsort((np.bincount(index.examples.values, minlength=n), _alike(weights)))
        count = max(1, -(-n // SPAN))
        position = np.empty(n, np.int32)
        position[order] = np.arange(n)
        dense = np.zeros((count, len(common), SPAN), np.float32)
        for at in range(count):
            own = weights[:, order[at * SPAN : (at + 1) * SPAN]]
            dense[at, :, : own.shape[1]] = own
        # Postings of the other terms by term and position; a block is a term's run of postings in one span.
        term = np.repeat(np.arange(len(size), dtype=np.int32), size)
        rare = place[term] < 0
        term, at, w = term[rare], position[index.examples.values[rare]], index.weights.values[rare].astype(np.float32)
        sort = np.lexsort((at, term))
        at, w = at[sort], w[sort]  # terms are in order already
        cuts = np.concatenate([[0], np.cumsum(np.where(place < 0, size, 0))])
        key = term * np.int64(count) + at // SPAN
        first = np.flatnonzero(np.diff(key, prepend=-1))
        last = np.append(first[1:], len(term))
        top = np.maximum.reduceat(w, first) if len(first) else w
        long = size[term[first]] >= FEW * count
        first, last, top = first[long], last[long], top[long]
        return cls(
            count, order, dense, np.ascontiguousarray(dense.max(axis=2, initial=0).T), place, cuts,
            np.searchsorted(term[first], np.arange(len(size) + 1)), at[first] // SPAN, top, first, last, at, w,
        )


@dataclass
class Index:
    """Examples as unit vectors in an inverted index."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    idents: np.ndarray
    labels: np.ndarray
    examples: Lists  # by term: numbers of the examples, ascending; needed to make the spans only
    weights: Lists
    prior: float
    blank: float  # score of a text without terms
    starts: frozenset[str]  # first letters of the marking beginnings
    spans: Spans | None = field(default=None, repr=False)  # made on first use

    def neighbours(self, parts: list[tuple[np.ndarray, np.ndarray]], count: int) -> Iterator[list[tuple[float, int]]]:
        """For each vector, as terms and weights, the ``count`` examples of largest positive cosine; ties to the earlier one.

        Short lists are added up first. The bound of a span of examples is its largest sum of these, and the
        sum over all other terms of the vector's weight and the span's largest weight of the term. Spans are
        visited from the largest bound on, until the bounds of the others show that they hold none of the nearest.
        """
        if self.spans is None:
            self.spans = Spans.of(self)
        spans = self.spans
        wide = np.zeros((len(parts), len(spans.peak)), np.float32)
        exact = np.zeros((len(parts), spans.count, SPAN))  # sums over all terms but the common ones
        split, blocks = [], []
        for i, (terms, w) in enumerate(parts):
            row = spans.place[terms]
            rare, wide[i, row[row >= 0]] = row < 0, w[row >= 0]
            split.append((row[row >= 0], w[row >= 0]))
            terms, w = terms[rare], w[rare]
            long = spans.ends[terms + 1] > spans.ends[terms]
            short = terms[~long]
            found, added = _runs(spans.cuts[short], spans.cuts[short + 1], w[~long])
            added *= spans.weights[found]
            exact[i] = np.bincount(spans.examples[found], added, exact[i].size).reshape(-1, SPAN)
            held, w = _runs(spans.ends[terms[long]], spans.ends[terms[long] + 1], w[long])
            blocks.append((held, w, spans.span[held]))
        bounds = wide @ spans.peak + exact.max(axis=2)
        for i, (held, w, span) in enumerate(blocks):
            if len(held):
                bounds[i] += np.bincount(span, spans.top[held] * w, spans.count)
        guess = np.full(exact.shape, -1.0, np.float32)

        def visit(todo: np.ndarray) -> None:
            """Add up the cosines with all examples of the spans marked for each vector."""
            for i, (held, w, span) in enumerate(blocks):
                inside = todo[i][span]
                if inside.any():
                    found, added = _runs(spans.first[held[inside]], spans.last[held[inside]], w[inside])
                    added *= spans.weights[found]
                    exact[i] += np.bincount(spans.examples[found], added, exact[i].size).reshape(-1, SPAN)
            for at in np.flatnonzero(todo.any(axis=0)).tolist():
                who = np.flatnonzero(todo[:, at])
                guess[who, at] = wide[who] @ spans.dense[at] + exact[who, at]

        seeds = np.argpartition(bounds, -min(SEEDS, spans.count), axis=1)[:, -min(SEEDS, spans.count):]
        todo = np.zeros(bounds.shape, bool)
        np.put_along_axis(todo, seeds, True, axis=1)
        visit(todo)
        reached = np.take_along_axis(guess, seeds[:, :, None], axis=1).reshape(len(parts), -1)
        least = np.full(len(parts), -1.0)
        if reached.shape[1] > count:
            least = np.partition(reached, -count, axis=1)[:, -count] - 2 * SLACK
        visit(~todo & (bounds >= least[:, None]) & (bounds > 0))
        for i, (common, w) in enumerate(split):
            # Sums in single precision only tell which examples can be among the nearest.
            rough = guess[i].ravel()
            found = np.flatnonzero((rough >= least[i]) & (rough > 0))
            if len(found) > count:
                found = found[rough[found] >= np.partition(rough[found], -count)[-count] - 2 * SLACK]
            score = exact[i].ravel()[found]
            if len(common):
                score = score + w @ spans.dense[found[:, None] // SPAN, common, found[:, None] % SPAN].T.astype(float)
            # Sums in another order differ in their last digits, which must not part ties.
            score, number = np.round(score, 12), spans.order[found]
            number, score = number[score > 0], score[score > 0]
            order = np.lexsort((number, -score))[:count]
            yield list(zip(score[order].tolist(), number[order].tolist()))

    def nearest(self, vector: dict[int, float], count: int) -> list[tuple[float, int]]:
        """The ``count`` examples of largest positive cosine, with their numbers; ties to the smaller number."""
        terms, weights = np.fromiter(vector, np.int64, len(vector)), np.fromiter(vector.values(), float, len(vector))
        return next(self.neighbours([(terms, weights)], count))

    def vector(self, counts: Counter) -> dict[int, float]:
        terms = np.array(sorted(counts), np.int64)
        weights = self._unit(terms, np.array([counts[t] for t in terms.tolist()]))
        return dict(zip(terms.tolist(), weights.tolist()))

    def _unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        raw = (1 + np.log(counts)) * self.idf[terms]
        return raw / math.sqrt(raw @ raw) if len(raw) else raw

    def _judge(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[int, float, int]]]:
        weight = sum(s**POWER for s, _ in near)
        toxic = sum(s**POWER * self.labels[e] for s, e in near)
        score = (toxic + DOUBT * self.prior) / (weight + DOUBT)
        return float(score), [(int(self.idents[e]), float(s), int(self.labels[e])) for s, e in near[:3]]

    def vote(self, counts: Counter) -> tuple[float, list[tuple[int, float, int]]]:
        """A text's score, and its nearest examples with cosine and label."""
        return self._judge(self.nearest(self.vector(counts), NEIGHBOURS)) if counts else (self.blank, [])

    def score(self, texts: list[str | None]) -> list[tuple[float, list]]:
        out = []
        for at in range(0, len(texts), BATCH):
            found = [_counted(words_of(t), self.vocabulary, self.starts) for t in texts[at : at + BATCH]]
            rows = self.neighbours([(t, self._unit(t, n)) for t, n in found if len(t)], NEIGHBOURS)
            out += [self._judge(next(rows)) if len(t) else (self.blank, []) for t, _ in found]
        return out


def _counted(words: list[str], vocabulary: dict[str, int], starts: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of the vocabulary among words, ascending, and how often each occurs."""
    terms = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
    begun = [t for w in words if w[: BEGINNINGS[0]] in starts for b in terms_of(w)[1:] if (t := vocabulary.get(b)) is not None]
    if begun:
        terms = np.concatenate([terms, begun])
    distinct, total = np.unique(terms, return_counts=True)
    return (distinct[1:], total[1:]) if len(distinct) and distinct[0] < 0 else (distinct, total)


def _first_copies(split: list[list[str]]) -> list[int]:
    """Positions without near copies of earlier ones, by the smallest hashes of their word triples."""
    seen: Counter = Counter()
    kept = []
    for i, words in enumerate(split):
        text = [w.encode() for w in words]
        sketch = sorted({zlib.crc32(b" ".join(three)) for three in zip(text, text[1:], text[2:])})[:8]
        if len(sketch) < 8 or sum(h in seen for h in sketch) < 4:
            kept.append(i)
            seen.update(sketch)
    return kept


def learn(sample: pd.DataFrame) -> Index:
    """An index of the examples ``ident``, ``text`` and ``label`` (1: toxic)."""
    one: dict[str, str] = {}  # one object per distinct word
    split = [[one.setdefault(w, w) for w in words_of(t)] for t in sample["text"]]
    toxic = sample["label"].to_numpy() > 0
    rows = _first_copies(split)
    n, n_toxic = len(rows), int(toxic[rows].sum())
    # Terms in fewer than LEAST toxic examples are never counted by name: most fall to counts by hash.
    rough = np.zeros(1 << 22, np.uint16)
    for i in rows:
        if toxic[i]:
            rough[np.unique([hash(t) & (1 << 22) - 1 for w in set(split[i]) for t in terms_of(w)]).astype(np.int64)] += 1
    frequent = bytearray((rough >= LEAST).view(np.uint8))
    held: Counter = Counter()
    for i in rows:
        if toxic[i]:
            held.update({t for w in set(split[i]) for t in terms_of(w) if frequent[hash(t) & (1 << 22) - 1]})
    held = Counter({t: n for t, n in held.items() if n >= LEAST})
    also: Counter = Counter()
    for i in rows:
        if not toxic[i]:
            also.update({t for w in set(split[i]) for t in terms_of(w) if t in held})

    def excess(term: str) -> float:
        """The log-likelihood ratio of the term among toxic examples, 0 if it is not more frequent there."""
        a, b = held[term], also[term]
        expected = (a + b) * n_toxic / n
        if a <= expected:
            return 0.0
        return 2 * (a * math.log(a / expected) + (b * math.log(b / (a + b - expected)) if b else 0))

    least = 2 * math.log(max(np.count_nonzero(rough), 2))
    marks = {t for t in held if excess(t) >= least}
    begun = {t for t in marks if t[-1] == "-"}
    starts = frozenset(t[: BEGINNINGS[0]] for t in begun)
    vocabulary = {t: i for i, t in enumerate(sorted({*one, *begun}))}
    # In how many examples each term occurs, and its weight.
    within = np.zeros(len(vocabulary), np.int64)
    for i in rows:
        within[_counted(split[i], vocabulary, starts)[0]] += 1
    idf = np.log((1 + n) / (1 + within)) + 1
    for t in marks:
        rate, usual = held[t] / (held[t] + also[t]), n_toxic / n
        idf[vocabulary[t]] *= 1 + MARK * (rate - usual) / (1 - usual) if usual < 1 else 1
    marked = np.zeros(len(vocabulary), bool)
    marked[[vocabulary[t] for t in marks]] = True
    prior = float(toxic.mean()) if len(sample) else 0.0
    none = Lists(np.zeros(1, np.int64), np.zeros(0))
    index = Index(vocabulary, idf, np.zeros(0), np.zeros(0, int), none, none, prior, 0.0, starts)
    full, terms, weights, bare, toxic_bare = [], [], [], 0, 0
    for i, words in enumerate(split):
        found, counts = _counted(words, vocabulary, starts)
        if not marked[found].any():
            bare, toxic_bare = bare + 1, toxic_bare + int(toxic[i])
        if len(found):
            full.append(i)
            terms.append(found.astype(np.int32))
            weights.append(index._unit(found, counts).astype(np.float32).astype(float))  # as the dense table holds them
        split[i] = []
    index.blank = (toxic_bare + DOUBT * prior) / (bare + DOUBT)
    index.idents, index.labels = sample["ident"].to_numpy()[full], toxic[full].astype(int)
    flat = np.concatenate([np.zeros(0, np.int32), *terms])
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(len(full), dtype=np.int32), [len(t) for t in terms])
    ends = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(vocabulary)))])
    index.examples = Lists(ends, owner[order])
    index.weights = Lists(ends, np.concatenate([np.zeros(0), *weights])[order])
    return index


def pack(index: Index) -> bytes:
    """What scoring needs of an index, the spans made ready, in few bytes; each part can be opened by itself."""
    spans = index.spans or Spans.of(index)
    terms = sorted(index.vocabulary, key=index.vocabulary.__getitem__)
    parts = (
        "\n".join(terms), (index.idf, index.idents, index.labels, index.prior, index.blank, index.starts),
        *(getattr(spans, f.name) for f in fields(Spans)),
    )
    return pickle.dumps([zlib.compress(pickle.dumps(part), 1) for part in parts])


def unpack(packed: bytes) -> Index:
    """The index for scoring: its lists by term are empty, the spans hold them."""
    parts = pickle.loads(packed)
    for i, part in enumerate(parts):
        parts[i] = pickle.loads(zlib.decompress(part))
    terms, (idf, idents, labels, prior, blank, starts), *held = parts
    vocabulary = {t: i for i, t in enumerate(terms.split("\n") if terms else [])}
    none = Lists(np.zeros(1, np.int64), np.zeros(0))
    return Index(vocabulary, idf, idents, labels, none, none, prior, blank, starts, Spans(*held))


@dataclass
class Packed:
    """An index as bytes, opened once per worker; the driver only passes it on."""

    packed: bytes
    opened: Index | None = None

    def index(self) -> Index:
        if self.opened is None:
            self.opened, self.packed = unpack(self.packed), b""
        return self.opened


def _scorer(index: Broadcast) -> object:
    @F.pandas_udf(_RESULT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        found = index.value.index().score(texts.tolist())
        evidence = [[{"doc_id": i, "cosine": c, "toxic": y} for i, c, y in e] for _, e in found]
        return pd.DataFrame({"score": [s for s, _ in found], "evidence": evidence})

    return judged


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> object:
    """A function from a text column to ``score`` and ``evidence``, learnt from labelled rows."""

    def train(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = pd.concat([pd.DataFrame({"ident": [], "label": [], "text": []}), *parts]).sort_values("ident", ignore_index=True)
        packed = pack(learn(sample))
        for at in range(0, len(packed), PIECE):
            yield pd.DataFrame({"place": [at], "piece": [packed[at : at + PIECE]]})

    # The sample is bounded and learnt from in one task; its index comes to the driver in pieces, a few at a time.
    found = labelled_rows(docs, labels, "toxic", rows).coalesce(1).mapInPandas(train, "place long, piece binary")
    pieces = stored(found.repartition(PIECES), "index").toLocalIterator()
    packed = b"".join(piece for _, piece in sorted((r["place"], bytes(r["piece"])) for r in pieces))
    packed = packed or pack(learn(pd.DataFrame({"ident": [], "text": [], "label": []})))  # no task, no row, without a label
    return _scorer(spark.sparkContext.broadcast(Packed(packed)))


def toxicity(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: ``held_out``, ``score``, ``predicted`` and ``evidence`` (the nearest examples)."""
    judged = fitted(docs.sparkSession, docs, labels, rows)
    named = docs.select(F.col(ident).alias("doc_id"), judged(F.coalesce(text, F.lit(""))).alias("found"))
    return named.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("found.score").alias("score"),
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("found.evidence").alias("evidence"),
    )


def is_toxic(judged, text: str = "text") -> Column:
    return judged(F.coalesce(text, F.lit("")))["score"] >= THRESHOLD


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that are not predicted toxic, all columns kept."""
    judged = fitted(docs.sparkSession, docs if learn_from is None else learn_from, labels, rows)
    return docs.where(~is_toxic(judged))
