"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Strict patterns give the base spans, which always stay. Looser patterns add candidates: disguised
addresses, numbers in other notations, version 6 addresses. Seven labelers vote for, against or not at
all on every span: a notation's own regular expressions, gazetteers (domains, calling codes, card
issuers, reserved networks) and the words and signs around it. Expectation-maximisation over the counts
of all vote patterns of the corpus estimates how each labeler votes on real and on false spans, with
base spans known to be real. Its posteriors train the final span classifier, a logistic regression
over votes and shape; candidates it is sure of are added where they overlap no base span.

Each text is scanned once, as a whole; tasks pass on counts of vote patterns, of which there are at
most ``2 * 4 * 3 ** 7``, and the classifier is fitted on the ``PATTERNS`` most frequent patterns of
votes and shape.

Defined results: null texts are empty, empty texts have no spans; rows that share an id are judged one
by one; of overlapping candidates the likelier, then the earlier stays; without any candidate nothing
is added; an empty table gives no rows; other columns are ignored or, in ``redacted``, kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from pulselake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Patterns of votes and shape the classifier is fitted on, and the probability from which a span is added.
PATTERNS, SURE = 20_000, 0.9
ROUNDS = 40
#: Characters before and after a span in which context words count.
BEFORE, AFTER = 32, 16

#: The base patterns. A match starts where its run of signs starts, which the look-behinds state.
BASE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
BASE_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
BASE_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
BASE_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"\x20?@\x20?|\x20?[(\[{]\x20?at\x20?[)\]}]\x20?|\x20at\x20(?=[a-z0-9-]{1,63}\x20dot\x20)", re.I)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?|\x20dot\x20)[A-Za-z0-9-]+)+", re.I)
_NUMBER = re.compile(r"\(?[0-9]+(?:[\x20.()/-]{1,2}[0-9]+)*+")
_SIX = re.compile(r"(?<![\w:])(?=[0-9A-Fa-f:]{2,39}(?![\w:]))(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![\w:])")

#: Gazetteers: top-level domains, calling codes, words beside each kind, words beside other numbers.
DOMAINS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv uk de fr es it nl be at ch pt ie se no dk fi pl cz sk hu ro"
    " bg gr ru ua tr il in cn jp kr tw hk sg my th vn id ph au nz za ng ke eg ma ar br cl mx pe ca us eu cat".split()
)
CALLING = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91"
    " 92 93 94 95 98 212 213 216 218 234 254 351 352 353 354 355 356 357 358 359 370 371 372 380 381 385 386 420 421 852 886 971 972".split()
)
WORDS = (
    frozenset("email e-mail mail mailto contact write correo courriel kontakt contacto an".split()),
    frozenset("ip host server address client remote adresse dirección serveur servidor peer from".split()),
    frozenset("card visa mastercard amex credit debit karte kreditkarte tarjeta carte paid payment".split()),
    frozenset("phone tel telephone call mobile cell fax telefon teléfono téléphone anruf llame appelez whatsapp".split()),
)
OTHER = frozenset(
    "version v ver release order invoice isbn issn page section chapter id no nr num number ticket case doi rfc build total"
    " bestellung rechnung seite pedido factura página commande facture year copyright".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _runs(text: str, at_sign: re.Pattern, domain: re.Pattern, run: frozenset = _LOCAL) -> Iterator[tuple[int, int]]:
    """Addresses: the run of signs before an at-sign, and a domain after it."""
    done = 0
    for at in at_sign.finditer(text):
        start = at.start()
        while start > done and text[start - 1] in run:
            start -= 1
        if start < at.start() and (found := domain.match(text, at.end())):
            yield start, found.end()
            done = found.end()


_SIGN, _STRICT_DOMAIN = re.compile("@"), re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the spans of the base patterns that pass their checks."""
    out = []
    if "@" in text:  # ``BASE_EMAIL``, tried at at-signs only
        out += [(EMAIL, s, e) for s, e in _runs(text, _SIGN, _STRICT_DOMAIN)]
    if not _DIGIT.search(text):
        return out
    for m in BASE_IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((IP, *m.span()))
    for m in BASE_CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 64 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((CARD, *m.span()))
    if "+" in text:
        for m in BASE_PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append((PHONE, *m.span()))
    return out


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates of the looser patterns."""
    if "@" in text or _AT.search(text):
        yield from ((EMAIL, s, e) for s, e in _runs(text, _AT, _DOMAIN))
    if ":" in text:
        yield from ((IP, *m.span()) for m in _SIX.finditer(text))
    if not _DIGIT.search(text):
        return
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7 or m.end() - m.start() > 64:
            continue
        span = m[0]
        count = len(_digits(span))
        start = m.start() + (span[0] == "(" and ")" not in span)
        if span.count(".") == 3 and span.replace(".", "").isdigit() and 4 <= count <= 12:
            yield IP, start, m.end()
        if 13 <= count <= 19:
            yield CARD, start, m.end()
        if 7 <= count <= 15:
            yield PHONE, start, m.end()


def votes_of(text: str, kind: int, start: int, end: int, near: int, strict: bool) -> list[int]:
    """The labelers' votes: 1 for, -1 against, 0 none. ``near`` spans share the line."""
    span = text[start:end]
    digits = _digits(span)
    lower = span.lower()
    groups = re.split(r"[^0-9]+", span.strip("()+ "))
    if kind == EMAIL:
        top = re.split(r"[.\s()\[\]{}]+", lower.rstrip(")]} "))[-1]
        check = 1 if top.isalpha() and len(top) >= 2 else -1
        shape = 1 if "@" in span and " " not in span else 0
        listed = 1 if top in DOMAINS else -1
    elif kind == IP:
        parts = span.split(".")
        check = 1 if ":" in span or all(int(p or 999) <= 255 for p in parts) else -1
        shape = 0 if ":" in span else 1 if all(p == "0" or p[:1] != "0" for p in parts) else -1
        listed = 0 if ":" in span else 1 if 1 <= int(parts[0]) <= 223 else -1
    elif kind == CARD:
        check = 1 if luhn(digits) else -1
        shape = 1 if len(groups) == 1 or all(len(g) == 4 for g in groups[:-1]) else -1
        issuer = digits[0] == "4" or "51" <= digits[:2] <= "55" or digits[:2] in ("34", "37", "65", "35", "36", "38") or digits[:4] == "6011"
        listed = 1 if issuer else -1
    else:
        check = 1 if 8 <= len(digits) <= 15 else -1
        signs = {c for c in span if not c.isdigit() and c not in "+() "}
        shape = -1 if len(signs) > 1 or any(len(g) > 6 for g in groups) and len(groups) > 1 else 1 if len(groups) > 2 else 0
        plus = span[0] == "+" or text[start - 1 : start] == "+" or digits[:2] == "00"
        listed = (1 if any(digits.removeprefix("00")[:n] in CALLING for n in (1, 2, 3)) else -1) if plus else 0
    around = [w.lower() for w in _WORD.findall(text[max(0, start - BEFORE) : start])[-4:] + _WORD.findall(text[end : end + AFTER])[:1]]
    told = 1 if any(w in WORDS[kind] for w in around) else -1 if any(w in OTHER for w in around) else 0
    sides = text[max(0, start - 1) : start] + text[end : end + 1]
    edges = -1 if any(c.isalnum() or c in "_=#$/\\<>@-" for c in sides) else 1
    return [1 if strict else 0, check, shape, listed, told, edges, -1 if near > 3 else 0]


LABELERS = 7


def shape_of(span: str) -> int:
    """Digits, length and signs of a span, packed in a small number."""
    digits = min(sum(c.isdigit() for c in span), 23)
    signs = sum(1 << k for k, group in enumerate((" ", "-", ".", "()[]{}", "+", "@:")) if any(c in span for c in group))
    return digits * 256 + min(len(span) // 8, 3) * 64 + signs


def scan(text: str) -> tuple[list[int], list[int]]:
    """Base spans and further candidates, five numbers each: kind, start, end, votes, shape."""
    base = base_spans(text)
    taken = [(s, e) for _, s, e in base]
    more = [c for c in _loose(text) if not any(s < c[2] and c[1] < e for s, e in taken)] if len(taken) < 64 else _apart(_loose(text), taken)
    out: tuple[list[int], list[int]] = ([], [])
    lines: dict[int, int] = {}
    placed = [(c, i, text.rfind("\n", 0, c[1])) for i, part in enumerate((base, more)) for c in part]
    for _, _, line in placed:
        lines[line] = lines.get(line, 0) + 1
    for (kind, start, end), i, line in placed:
        code = 0
        for vote in votes_of(text, kind, start, end, lines[line], i == 0):
            code = 3 * code + vote + 1
        out[i].extend((kind, start, end, code, shape_of(text[start:end])))
    return out


def _apart(spans: Iterator[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The spans that overlap none of many taken ones."""
    starts = np.array(sorted(taken))
    ends = np.maximum.accumulate(starts[:, 1])
    found = list(spans)
    before = np.searchsorted(starts[:, 0], [e for _, _, e in found]) - 1
    return [c for c, k in zip(found, before) if k < 0 or ends[k] <= c[1]]


FOUND = StructType([StructField(name, ArrayType(IntegerType())) for name in ("base", "more")])


@F.pandas_udf(FOUND)
def _scanned(texts: pd.Series) -> pd.DataFrame:
    found = [scan(t) for t in texts]
    return pd.DataFrame({"base": [f[0] for f in found], "more": [f[1] for f in found]})


def _unpacked(code: np.ndarray) -> np.ndarray:
    """Votes as columns of 0 (against), 1 (none), 2 (for)."""
    return np.stack([code // 3**k % 3 for k in range(LABELERS - 1, -1, -1)], axis=1)


def reliabilities(strict: np.ndarray, votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Expectation-maximisation for one kind: the share of real spans among candidates, and P(vote | real or not)
    by labeler, as an array (2, labelers, 3). Base spans are real; votes are independent given the truth."""
    real = np.where(strict, 1.0, 1 / (1 + np.exp(-1.5 * (votes[:, 1:] - 1).sum(axis=1))))
    share, table = 0.5, np.full((2, LABELERS, 3), 1 / 3)
    for _ in range(ROUNDS):
        for truth, weight in enumerate((counts * (1 - real), counts * real)):
            for j in range(LABELERS):
                seen = np.bincount(votes[:, j], weight, 3) + 1
                table[truth, j] = seen / seen.sum()
        loose = counts * ~strict
        share = ((loose * real).sum() + 1) / (loose.sum() + 4)
        real = np.where(strict, 1.0, posterior(share, table, votes))
    return float(share), table


def posterior(share: float, table: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """The probability that spans of these votes are real; the first labeler only tells base spans apart."""
    logs = np.log(table[:, np.arange(1, LABELERS), votes[:, 1:]]).sum(axis=2)
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log(1 - share) - np.log(share), -60, 60)))


def features(votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Votes but the first, and the parts of the shape, as indicators."""
    parts = [np.ones((len(votes), 1))]
    parts += [np.eye(3)[votes[:, j]] for j in range(1, LABELERS)]
    parts += [np.eye(24)[shapes // 256], np.eye(4)[shapes // 64 % 4], (shapes[:, None] >> np.arange(6)) & 1]
    return np.concatenate(parts, axis=1).astype(float)


@dataclass
class Model:
    """Weights of the span classifier by kind; a kind without candidates has none."""

    weights: dict[int, np.ndarray]
    tables: dict[int, tuple[float, np.ndarray]]

    def probability(self, kind: int, votes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        if kind not in self.weights:
            return np.zeros(len(votes))
        return 1 / (1 + np.exp(-np.clip(features(votes, shapes) @ self.weights[kind], -60, 60)))


def fit(rows: pd.DataFrame, all_votes: pd.DataFrame) -> Model:
    """Reliabilities from the counts of all votes, the classifier from patterns of votes and shape."""
    weights, tables = {}, {}
    for kind, own in all_votes.groupby("kind"):
        strict, votes = own["strict"].to_numpy(bool), _unpacked(own["votes"].to_numpy())
        tables[kind] = share, table = reliabilities(strict, votes, own["n"].to_numpy(float))
        mine = rows[rows["kind"] == kind]
        votes = _unpacked(mine["votes"].to_numpy())
        label = np.where(mine["strict"].to_numpy(bool), 1.0, posterior(share, table, votes))
        x, n = features(votes, mine["shape"].to_numpy()), np.sqrt(mine["n"].to_numpy(float))
        w = np.zeros(x.shape[1])
        for _ in range(30):  # Newton's steps with a ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (n * (label - p)) - 0.1 * w
            bend = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            step = np.linalg.solve(bend, slope)
            w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-9:
                break
        weights[int(kind)] = w
    return Model(weights, tables)


def learn(scanned: DataFrame) -> Model:
    """The model of a table with the column ``found``."""

    def spans(part: str, strict: bool) -> DataFrame:
        flat = F.col(f"found.{part}")
        at = F.explode(F.expr(f"transform(sequence(0, size(found.{part}) div 5 - 1), i -> i * 5)"))
        each = scanned.where(F.size(flat) > 0).select(flat.alias("flat"), at.alias("i"))
        return each.select(
            F.lit(strict).alias("strict"), F.expr("flat[i]").alias("kind"), F.expr("flat[i + 3]").alias("votes"), F.expr("flat[i + 4]").alias("shape")
        )

    counts = spans("base", True).union(spans("more", False)).groupBy("strict", "kind", "votes", "shape").agg(F.count("*").alias("n"))
    counts = stored(counts, "patterns")
    every = counts.groupBy("strict", "kind", "votes").agg(F.sum("n").alias("n")).orderBy("strict", "kind", "votes").toPandas()
    most = counts.orderBy(F.desc("n"), "strict", "kind", "votes", "shape").limit(PATTERNS).toPandas()
    return fit(most, every)


def decided(base: list[int], more: list[int], model: Model, sure: float = SURE) -> list[tuple[int, int, int, float]]:
    """All spans as kind, start, end and probability, by kind and start."""
    out = [(*base[i : i + 3], 1.0) for i in range(0, len(base), 5)]
    own = np.array(more, np.int64).reshape(-1, 5)
    scored = []
    for kind in np.unique(own[:, 0]).tolist():
        mine = own[own[:, 0] == kind]
        scores = model.probability(kind, _unpacked(mine[:, 3]), mine[:, 4])
        scored += [(-p, s, e, kind) for p, (_, s, e, _, _) in zip(scores.tolist(), mine.tolist()) if p >= sure]
    taken: list[tuple[int, int]] = []
    for p, start, end, kind in sorted(scored):
        if not any(s < end and start < e for s, e in taken):
            taken.append((start, end))
            out.append((kind, start, end, -p))
    return sorted(out, key=lambda s: s[:3])


def _text(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def redacted(docs: DataFrame, text: str = "text", sure: float = SURE) -> DataFrame:
    """All rows and columns, each span of ``text`` replaced by its kind in angle brackets."""
    model = learn(stored(docs.select(_scanned(_text(text)).alias("found")), "scanned"))

    @F.pandas_udf(StringType())
    def replaced(texts: pd.Series) -> pd.Series:
        out = []
        for value in texts:
            if value is not None:
                done = len(value) + 1
                for kind, start, end, _ in sorted(decided(*scan(value), model, sure), key=lambda s: -s[1]):
                    if end <= done:
                        value = f"{value[:start]}<{KINDS[kind]}>{value[end:]}"
                        done = start
            out.append(value)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, replaced(text))


def _digest(model: Model, sure: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def told(spans: list) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, *_ in spans)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for ident, base, more in zip(frame["ident"], frame["base"], frame["more"]):
                base = [int(v) for v in base]
                own = sorted(tuple(base[i : i + 3]) for i in range(0, len(base), 5))
                counts = [sum(s[0] == kind for s in own) for kind in range(4)]
                spans = decided(base, list(more), model, sure) if len(more) else own
                out.append((ident, *counts, hashlib.sha256(told(own).encode()).hexdigest(), told(spans)))
            yield pd.DataFrame(out, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]).astype({"doc_id": "Int64"})

    return run


def report(docs: DataFrame, ident: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """Per document: base spans by kind and their hash, and ``spans``, the base ones and those added."""
    scanned = stored(docs.select(F.col(ident).cast("long").alias("ident"), _scanned(_text(text)).alias("found")), "scanned")
    model = learn(scanned)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return scanned.select("ident", "found.base", "found.more").mapInPandas(
        _digest(model, sure), f"doc_id long, {counts}, base_sha256 string, spans string"
    )
