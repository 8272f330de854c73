"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is lower-cased in A-Z and read as its words, each closed by a space, and one end sign, the
same events that the word-count base prices. A byte is predicted from up to ``ORDER`` bytes before it,
across words, from the longest context that was seen: escape by method C, with the symbols of longer
contexts excluded in shorter ones, down to all symbols alike. The space before a text's first word is
context only. ``score`` is the logarithm of a proper probability of the sequence.

The price of a byte depends on its context and itself only. So tasks count such keys (numpy sorts
them in runs of ``RUN`` bytes) and pass sums on, shorter contexts are summed from the distinct longest
ones, and each distinct key is priced once. The commonest keys and the commonest words go to the
scoring tasks as bounded tables that serve most look-ups on the spot; every other look-up is a join
with the complete tables, so these bounds never change a result.

Keys are exact: order and bytes of the context are packed into one long, with the symbol in its low byte.

Defined results: null texts count as empty, an empty text is the end sign alone; without learnable
rows all symbols are alike; very long texts are read whole, run by run; rows that share an id are
scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import heaviest, remainder, stored

ORDER, SYMBOLS = 5, 252  # all bytes but six white spaces, the end of a word and of the text
#: Keys and words whose prices are broadcast; all others are joined.
HEAD_KEYS, HEAD_WORDS = 1_000_000, 60_000
#: Bytes worked on at once, and distinct keys or words a counting task holds before it passes them on.
RUN, HELD = 2_000_000, 300_000
#: Rows of a piece at most, whose number takes so many bits beside a key of 51.
TEXT_BITS = 8
ROWS = 1 << TEXT_BITS
END = b"\n"

_BYTES = (1 << 8 * ORDER) - 1


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def stream(words: list[bytes]) -> bytes:
    """The bytes of a text: a space that is context only, each word and a space, the end."""
    return b" ".join([b"", *words, END])


def keys_of(parts: list[bytes], skips: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the bytes of each part from ``skips`` on, with all context up to ``ORDER``, and their part."""
    size = np.array([len(p) for p in parts])
    row = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    context = np.zeros(len(row), np.int64)
    for j in range(1, ORDER + 1):
        context[j:] |= row[:-j] << 8 * (j - 1)
    order = np.minimum(place, ORDER)
    context &= (np.int64(1) << 8 * order) - 1  # nothing of the part before
    own = place >= np.array(skips)[owner]
    return ((order << 8 * ORDER | context) << 8 | row)[own], owner[own]


def runs(streams: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of all bytes and the number of their text, in runs of about ``RUN`` bytes; longer texts are cut."""
    parts: list[bytes] = []
    skips: list[int] = []
    texts: list[int] = []
    held = 0

    def out() -> tuple[np.ndarray, np.ndarray]:
        keys, owner = keys_of(parts, skips)
        return keys, np.array(texts)[owner]

    for i, whole in enumerate(streams):
        for at in range(1, len(whole), RUN):
            skip = min(at, ORDER)
            parts.append(whole[at - skip : at + RUN])
            skips.append(skip)
            texts.append(i)
            held += len(parts[-1])
            if held >= RUN:
                yield out()
                parts, skips, texts, held = [], [], [], 0
    if parts:
        yield out()


def _batch(names: list[str], *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names)


def _texts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Pieces of at most ``ROWS`` rows with the words of their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            yield piece, [words_of(t) for t in piece.column(column).to_pylist()]


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` and its count ``c`` in the column ``text``, one end a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return _batch(["word", "c"], pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64()))

        for _, found in _texts(batches):
            for words in found:
                counts.update(words)
            counts[END] += len(found)
            if len(counts) > HELD:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return texts.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def count_keys(texts: DataFrame) -> DataFrame:
    """``key`` and count ``c`` of every byte with its longest context."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*held))
        flat, place = np.unique(keys, return_inverse=True)
        return flat, np.bincount(place, counts, len(flat)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        streams = (stream(words) for _, found in _texts(batches) for words in found)
        for keys, _ in runs(streams):
            held.append(np.unique(keys, return_counts=True))
            if sum(len(k) for k, _ in held) > 5 * HELD:
                held = [merged(held)]
                if len(held[0][0]) > 3 * HELD:
                    yield _batch(["key", "c"], *map(pa.array, held.pop()))
        if held:
            yield _batch(["key", "c"], *map(pa.array, merged(held)))

    return texts.select("text").mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _order(node: Column) -> Column:
    return F.shiftright(node, 8 * ORDER)


def _at_order(node: Column, order: Column) -> Column:
    """The context of the last ``order`` bytes of a context."""
    kept = F.lit(_BYTES).bitwiseAND(node).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (8 * order).cast("int")) - 1)
    return F.shiftleft(order.cast("long"), 8 * ORDER).bitwiseOR(kept)


def _symbol(key: Column) -> Column:
    return key.bitwiseAND(F.lit(255).cast("long"))


def all_orders(keys: DataFrame) -> DataFrame:
    """``key`` and ``c`` for contexts of all lengths, from those of the longest."""
    rows = keys.select("c", F.shiftright("key", 8).alias("whole"), _symbol(F.col("key")).alias("symbol"))
    rows = rows.withColumn("order", F.explode(F.sequence(F.lit(0), _order(F.col("whole")).cast("int"))))
    key = F.shiftleft(_at_order(F.col("whole"), F.col("order")), 8).bitwiseOR(F.col("symbol"))
    return rows.select(key.alias("key"), "c").groupBy("key").agg(F.sum("c").alias("c"))


def seen_prices(pairs: DataFrame) -> DataFrame:
    """``key``, ``c`` and ``price`` (log10) of the pairs whose context is as long as it can be."""
    order, context = _order(F.col("node")), F.col("node")
    first = F.call_function("shiftright", context, (8 * (order - 1)).cast("int")).bitwiseAND(F.lit(255).cast("long"))
    rows = pairs.withColumn("node", F.shiftright("key", 8)).where((order == ORDER) | ((order > 0) & (first == 32)))
    after = Window.partitionBy("node")  # at most one row per symbol
    rows = rows.select("key", "c", F.sum("c").over(after).alias("total"), F.count("*").over(after).alias("d"))
    return rows.select("key", "c", F.log10(F.col("c") / (F.col("total") + F.col("d"))).alias("price"))


def nodes_of(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per ``wanted`` context: ``total`` and number ``d`` of symbols, ``shorter`` (their total after the next shorter context), ``after``."""
    rows = pairs.select("key", "c", F.shiftright("key", 8).alias("node"), _symbol(F.col("key")).alias("symbol"))
    rows = rows.join(wanted, "node", "left_semi")
    order = _order(F.col("node"))
    shorter = F.when(order > 0, F.shiftleft(_at_order(F.col("node"), order - 1), 8).bitwiseOR(F.col("symbol")))
    lower = pairs.select(F.col("key").alias("shorter"), F.col("c").alias("lower"))
    joined = rows.withColumn("shorter", shorter).join(lower, "shorter", "left")
    return joined.groupBy("node").agg(
        F.sum("c").alias("total"), F.count("*").alias("d"), F.coalesce(F.sum("lower"), F.lit(0)).alias("shorter"),
        F.map_from_entries(F.collect_list(F.struct("symbol", "c"))).alias("after"),  # at most one per byte
    )


def unseen_prices(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """``key`` and ``price`` by escapes through shorter contexts."""
    rows = keys.select("key", F.shiftright("key", 8).alias("whole"), _symbol(F.col("key")).alias("symbol"))
    rows = rows.withColumn("order", F.explode(F.sequence(F.lit(0), _order(F.col("whole")).cast("int"))))
    rows = rows.withColumn("node", _at_order(F.col("whole"), F.col("order")))
    rows = rows.join(stored(nodes_of(pairs, rows.select("node").distinct()), "nodes"), "node", "left")
    step = F.struct(
        (-F.col("order")).alias("place"), "total", "d", "shorter", F.element_at("after", F.col("symbol")).alias("c")
    )
    steps = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("total").isNotNull(), step))).alias("steps"))

    def descend(state: Column, s: Column) -> Column:
        fresh = s["d"] - state["out_d"]
        left = s["total"] - state["out_total"] + fresh
        price = F.when(s["c"].isNotNull(), F.log10(s["c"] / left)).when(fresh > 0, F.log10(fresh / left)).otherwise(0.0)
        moved = F.struct(
            (state["price"] + price).alias("price"), s["shorter"].alias("out_total"), s["d"].alias("out_d"),
            s["c"].isNotNull().alias("done"),
        )
        return F.when(state["done"], state).otherwise(moved)

    zero = F.struct(
        F.lit(0.0).alias("price"), F.lit(0).cast("long").alias("out_total"), F.lit(0).cast("long").alias("out_d"), F.lit(False).alias("done")
    )
    last = F.aggregate("steps", zero, descend)
    return steps.withColumn("last", last).select(
        "key", F.when(F.col("last.done"), F.col("last.price"))
        .otherwise(F.col("last.price") - F.log10(F.lit(SYMBOLS) - F.col("last.out_d"))).alias("price"),
    )


def _lists(owner: np.ndarray, rows: int, fields: list[tuple[str, pa.Array]]) -> pa.Array:
    """One list of structs per row, from fields in the order of their owners."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([f for _, f in fields], [n for n, _ in fields]))


def _key_sums(keys: np.ndarray, owner: np.ndarray, rows: int, known: np.ndarray, prices: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """By text the summed prices of known keys, and lists of the other keys with their counts.

    Keys are sorted together with their text, so each is looked up once a text, and ascending.
    """
    pairs = np.sort(keys << TEXT_BITS | owner)
    at = np.flatnonzero(np.diff(pairs, prepend=-1))
    times, pairs = np.diff(at, append=len(pairs)), pairs[at]
    keys, text = pairs >> TEXT_BITS, pairs & ROWS - 1
    if len(known):
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        there = known[place] == keys
        sums = np.bincount(text[there], prices[place[there]] * times[there], rows).astype(float)
    else:
        there, sums = np.zeros(len(keys), bool), np.zeros(rows)
    rest = np.flatnonzero(~there)
    rest = rest[np.argsort(text[rest].astype(np.uint8), kind="stable")]
    return sums, _lists(text[rest], rows, [("key", pa.array(keys[rest])), ("k", pa.array(times[rest].astype(np.int64)))])


def scores(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    spark = docs.sparkSession
    held = remainder(F.col(ident), 7) == 2
    rows = docs.select(
        F.monotonically_increasing_id().alias("place"), F.col(ident).alias("doc_id"), (~held | held.isNull()).alias("learn"),
        F.coalesce(text, F.lit("")).cast("binary").alias("text"),
    )
    learn = rows.where("learn").select("text")
    counts = stored(count_words(learn), "words")
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = totals[0] or 0, totals[1]
    scale = math.log10(n + v + 1)
    pairs = stored(all_orders(count_keys(learn)), "pairs")
    seen = stored(seen_prices(pairs), "prices")

    head = heaviest(seen, "c", HEAD_KEYS).select("key", "price").toArrow()
    keys, prices = head["key"].to_numpy(), head["price"].to_numpy()
    order = np.argsort(keys)
    common = heaviest(counts, "c", HEAD_WORDS).toArrow()
    base = {w: math.log10(c + 1) - scale for w, c in zip(common["word"].to_pylist(), common["c"].to_pylist())}
    shared = spark.sparkContext.broadcast((keys[order], prices[order], base))
    names = ["place", "doc_id", "n_tokens", "n_known", "base_score", "score", "words", "keys"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, prices, base = shared.value
        for piece, found in _texts(batches, 2):
            place, doc, size = piece.column(0), piece.column(1), piece.num_rows
            own, sums, rest, times, owner = np.zeros(size, np.int64), np.zeros(size), [], [], []
            for i, words in enumerate(found):
                own[i] = len(words) + 1
                total = 0.0
                for w, k in Counter([*words, END]).items():
                    price = base.get(w)
                    if price is None:
                        rest.append(w)
                        times.append(k)
                        owner.append(i)
                    else:
                        total += k * price
                sums[i] = total
            tails = _lists(np.array(owner, np.int64), size, [("word", pa.array(rest, pa.binary())), ("k", pa.array(times, pa.int64()))])
            missed = np.bincount(np.array(owner, np.int64), times, size).astype(np.int64)
            blank = _lists(np.zeros(0, np.int64), size, [("key", pa.array([], pa.int64())), ("k", pa.array([], pa.int64()))])
            yield _batch(names, place, doc, pa.array(own), pa.array(own - missed), pa.array(sums), pa.array(np.zeros(size)), tails, blank)

            zero, none = np.zeros(size, np.int64), _lists(np.zeros(0, np.int64), size, [("word", pa.array([], pa.binary())), ("k", pa.array([], pa.int64()))])
            for keys, texts in runs(map(stream, found)):
                sums, tails = _key_sums(keys, texts, size, known, prices)
                lo, hi = int(texts[0]), int(texts[-1]) + 1
                columns = (place, doc, pa.array(zero), pa.array(zero), pa.array(zero.astype(float)), pa.array(sums), none, tails)
                yield _batch(names, *(c.slice(lo, hi - lo) for c in columns))

    kind = docs.schema[ident].dataType.simpleString()
    first = stored(rows.select("place", "doc_id", "text").mapInArrow(
        score, f"place long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double, "
        "words array<struct<word: binary, k: long>>, keys array<struct<key: long, k: long>>",
    ), "scores")
    words = first.select("place", F.explode("words").alias("r")).select("place", "r.word", "r.k").join(counts, "word", "left")
    rest = first.select("place", F.explode("keys").alias("r")).select("place", "r.key", "r.k")
    missing = stored(rest.select("key").distinct().join(seen, "key", "left_anti"), "missing")
    priced = seen.select("key", "price").union(unseen_prices(missing, pairs))
    nothing, none = F.lit(0).cast("long"), F.lit(None).cast(kind).alias("doc_id")
    by_word = words.select(
        "place", none, nothing, F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0),
        F.col("k") * (F.log10(F.coalesce("c", nothing) + 1) - scale), F.lit(0.0),
    )
    by_key = rest.join(priced, "key").select("place", none, nothing, nothing, F.lit(0.0), F.col("k") * F.col("price"))
    every = first.select("place", "doc_id", "n_tokens", "n_known", "base_score", "score").union(by_word).union(by_key)
    out = every.groupBy("place").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score"))
    )
    return out.select(
        "doc_id", (remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )
