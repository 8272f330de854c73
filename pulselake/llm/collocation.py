"""Phrase collocations from depth-truncated suffix trees, partitioned vertically by word prefixes.

The occurrences of every prefix are counted level by level, and only prefixes above the memory
budget are extended by their next word. The prefixes that remain are packed into groups of about one
budget; each group gathers the suffixes that start with its prefixes, cut to four words, builds their
subtree on its own and reads the count of each phrase from the totals of the leaves below it.

Tasks work on chunks of texts with word numbers of their own and pass on distinct entries with
counts, so copies and frequent phrases shrink before any shuffle. A phrase that occurs ``least``
times holds only words and pairs that do; a bitmap of their hashes, of bounded size, keeps most other
positions from being shipped. What passes it by chance is counted exactly all the same.

Defined results: a null text is empty, a null language ``und``; rows that share an id count one by
one; very long texts are cut into chunks between their pieces; ties are ordered as the contract says;
an empty table, or one without frequent phrases, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import LOWER, UPPER, stored

LEAST, DEPTH, TOP, SHARE, SCALE = 30, 4, 2000, 80, 2_000_000
#: Occurrences that the prefixes of one group hold; it grows where more prefixes than this would exceed it.
BUDGET, PREFIXES = 1 << 16, 1_000_000
#: Words counted together in a task, bytes of a piece of a long text, and rows of a batch that leaves it.
CHUNK, PIECE, ROWS = 3 << 19, 1 << 23, 1 << 15
#: Parts of a language that are ranked on their own before the whole.
SHARES = 64
#: Least and most bits of the bitmap of frequent words or pairs.
BITS = (1 << 20, 1 << 28)

#: The signs that end a piece; they are read as the word ``.``, which no word can be.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(UPPER.encode() + ENDS, LOWER.encode() + b"." * len(ENDS))
_SPLIT = re.compile(rb"\.")
COUNTS = "lang string, phrase string, f long"


class _Numbers(dict):
    """Numbers words in the order they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``PIECE`` bytes, cut where a piece ends."""
    text = text.translate(_TABLE)
    at = 0
    while len(text) - at > PIECE and (end := _SPLIT.search(text, at + PIECE)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:] if at else text


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """Language, words and word numbers of up to ``CHUNK`` words, with 0 between pieces and texts."""
    numbers: dict[str, _Numbers] = {}
    found: dict[str, list[np.ndarray]] = {}
    held = 0

    def closed() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang in list(found):
            ids = np.concatenate([*found.pop(lang), np.zeros(DEPTH, np.int32)])
            yield lang, list(numbers.pop(lang)), ids

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = numbers.setdefault(lang, _Numbers({b".": 0}))
            for part in _parts(text.as_py()):
                words = part.replace(b".", b" . ").split()
                words.append(b".")
                found.setdefault(lang, []).append(np.fromiter(map(own.__getitem__, words), np.int32, len(words)))
                held += len(words)
                if held >= CHUNK:
                    yield from closed()
                    own, held = numbers.setdefault(lang, _Numbers({b".": 0})), 0
    yield from closed()


def _emitted(
    lang: str, words: list[bytes], columns: list[np.ndarray], counts: np.ndarray, **more: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Batches of phrases, given as columns of word numbers, with their counts."""
    known = pa.array(words, pa.binary()).cast(pa.string())
    for at in range(0, len(counts), ROWS):
        part = slice(at, at + ROWS)
        phrase = _phrases(known, [c[part] for c in columns])
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(phrase), pa.string()), "phrase": phrase,
            **{name: values[part] for name, values in more.items()}, "f": counts[part],
        })


def _phrases(known: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    """The words of some columns of numbers, space-joined; 0 ends a phrase."""
    joined = known.take(columns[0])
    for column in columns[1:]:
        longer = pc.binary_join_element_wise(joined, known.take(column), " ")
        joined = pc.if_else(pa.array(column > 0), longer, joined)
    return joined


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second ^ (second >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _bitmap(phrases: DataFrame, words: int) -> np.ndarray:
    """A bitmap of the hashes of single words or of pairs (``words``); its bits grow with their number up to a bound."""
    rows = phrases.count()
    bits = min(max(1 << (16 * rows).bit_length(), BITS[0]), BITS[1])
    shift = np.uint64(64 - bits.bit_length() + 1)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [phrase.encode().split(b" ") for phrase in batch.column(1).to_pylist()]
            seeds = [xxhash.xxh32_intdigest(lang) for lang in batch.column(0).to_pylist()]
            ends = [np.fromiter((xxhash.xxh64_intdigest(w[k], x) for w, x in zip(split, seeds)), np.uint64, len(split)) for k in (0, -1)]
            mixed = ends[0] if words == 1 else _pair_hashes(*ends)
            yield pa.RecordBatch.from_pydict({"slot": (mixed >> shift).astype(np.int64)})

    found = phrases.select("lang", "phrase").mapInArrow(slots, "slot long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))
    held = found.groupBy(F.expr("slot div 64").alias("at")).agg(F.bit_or(bit).alias("held")).toPandas()  # at most bits / 64
    lists = np.zeros(bits // 64, np.uint64)
    lists[held["at"].to_numpy()] = held["held"].to_numpy().view(np.uint64)
    return lists


def _within(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slots = hashes >> np.uint64(64 - (64 * len(bitmap)).bit_length() + 1)
    return (bitmap[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) > 0


def _totals(texts: DataFrame, run: Callable, schema: str = COUNTS) -> DataFrame:
    rows = texts.mapInArrow(run, schema)
    return rows.groupBy(*[c for c in rows.columns if c != "f"]).agg(F.sum("f").alias("f"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` and ``f`` of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _chunks(batches):
            counts = np.bincount(ids, minlength=len(words))
            yield from _emitted(lang, words, [np.arange(1, len(words))], counts[1:])

    return _totals(texts, run)


def _pairs_within(bitmap: np.ndarray, lang: str, words: list[bytes], ids: np.ndarray) -> np.ndarray:
    """At which positions a pair of words starts that the bitmap holds."""
    hashes = _hashes(lang, words)
    out = np.zeros(len(ids), bool)
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    out[at] = _within(bitmap, _pair_hashes(hashes[ids[at]], hashes[ids[at + 1]]))
    return out


def _distinct(ids: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``width`` numbers from each position on, 0 beyond its length, and their counts."""
    codes, base, steps = ids[at].astype(np.int64), int(ids.max(initial=0)) + 1, []
    for k in range(1, width):
        codes *= base
        codes += np.where(lengths > k, ids[at + k], 0)
        if k < width - 1:
            values, codes = np.unique(codes, return_inverse=True)
            steps.append(values)
    codes, counts = np.unique(codes, return_counts=True)
    columns = [codes % base]
    for values in reversed(steps):
        codes = values[codes // base]
        columns.append(codes % base)
    return [codes // base, *columns[::-1]], counts


def pair_counts(texts: DataFrame, words_held: Broadcast) -> DataFrame:
    """Counts of the pairs whose words the bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _chunks(batches):
            known = _within(words_held.value, _hashes(lang, words))
            known[0] = False
            at = np.flatnonzero(known[ids[:-1]] & known[ids[1:]])
            columns, counts = _distinct(ids, at, np.full(len(at), 2), 2)
            yield from _emitted(lang, words, columns, counts)

    return _totals(texts, run)


def _heads(lang: str, words: list[bytes], columns: list[np.ndarray], over: dict[int, dict[str, set[bytes]]]) -> np.ndarray:
    """How many words the prefix of each row has: up to the first prefix that is not above the budget."""
    single, pairs = (over[level].get(lang, set()) for level in (1, 2))
    heads = 1 + np.fromiter((w in single for w in words), bool, len(words))[columns[0]].astype(np.int32)
    for row in np.flatnonzero(heads == 2) if pairs else ():
        heads[row] += words[columns[0][row]] + b" " + words[columns[1][row]] in pairs
    return heads


def suffixes(texts: DataFrame, pairs_held: Broadcast, over: Broadcast) -> DataFrame:
    """Distinct suffixes of two to four words with counts ``f``, cut at the first pair the bitmap lacks.

    ``head`` words form the prefix; a suffix that ends above its prefix adds to no subtree and is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _chunks(batches):
            held = _pairs_within(pairs_held.value, lang, words, ids)
            lengths, more = 1 + held, held
            for k in range(1, DEPTH - 1):
                more = more & np.roll(held, -k)
                lengths = lengths + more
            at = np.flatnonzero(held)
            columns, counts = _distinct(ids, at, lengths[at], DEPTH)
            heads = _heads(lang, words, columns, over.value)
            keep = sum((c > 0).astype(np.int32) for c in columns) >= heads
            columns, counts, heads = [c[keep] for c in columns], counts[keep], heads[keep]
            yield from _emitted(lang, words, columns, counts, head=heads)

    return _totals(texts, run, "lang string, phrase string, head int, f long")


def subtree(rows: pa.Table, least: int) -> pa.Table:
    """The nodes at or below their prefix of one group's suffix tree, each with the total of its leaves.

    Sorted suffixes are the leaves in order; a node of some depth is a run of equal beginnings.
    """
    split = pc.split_pattern(rows["phrase"].combine_chunks(), " ")
    known = split.flatten().dictionary_encode()
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    leaves = np.full((rows.num_rows, DEPTH), -1, np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    leaves[np.repeat(np.arange(rows.num_rows), sizes), within] = known.indices.to_numpy()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy()
    order = np.lexsort((*leaves.T[::-1], lang))
    leaves, lang, counts = leaves[order], lang[order], rows["f"].to_numpy()[order]
    head = rows["head"].to_numpy()[order]
    fresh = np.append(True, lang[1:] != lang[:-1])
    out: list[pa.Table] = []
    for depth in range(1, DEPTH + 1):
        fresh = fresh | np.append(True, leaves[1:, depth - 1] != leaves[:-1, depth - 1])
        starts = np.flatnonzero(fresh)
        totals = np.add.reduceat(counts, starts)
        keep = (leaves[starts, depth - 1] >= 0) & (totals >= least) & (depth >= np.maximum(head[starts], 2))
        starts, totals = starts[keep], totals[keep]
        phrase = known.dictionary.take(leaves[starts, 0])
        for k in range(1, depth):
            phrase = pc.binary_join_element_wise(phrase, known.dictionary.take(leaves[starts, k]), " ")
        out.append(pa.table({"lang": langs.dictionary.take(lang[starts]), "phrase": phrase, "f": totals}))
    return pa.concat_tables(out)


def _collected(counts: DataFrame, budget: int) -> dict[str, set[bytes]]:
    """The prefixes above the budget by language: at most ``PREFIXES``, as their occurrences are disjoint."""
    found: dict[str, set[bytes]] = {}
    for row in counts.where(F.col("f") > budget).select("lang", "phrase").toLocalIterator():
        found.setdefault(row["lang"], set()).add(row["phrase"].encode())
    return found


def _packed(levels: dict[int, DataFrame], budget: int) -> DataFrame:
    """The ``group`` of every prefix that is not extended: about one budget of occurrences in each.

    Prefixes are dealt to as many buckets as there are budgets in all, and the running sum in a
    bucket opens a new group whenever it has filled a budget; no prefix alone exceeds one.
    """
    parts = []
    for level, counts in levels.items():
        small = counts.where(F.col("f") <= budget)
        if level > 1:
            large = levels[level - 1].where(F.col("f") > budget).select("lang", F.col("phrase").alias("before"))
            small = small.withColumn("before", F.substring_index("phrase", " ", level - 1)).join(large, ["lang", "before"], "left_semi")
        parts.append(small.select("lang", F.col("phrase").alias("prefix"), "f"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    whole = stored(whole, "prefixes")
    buckets = (whole.agg(F.sum("f")).first()[0] or 0) // budget + 1
    dealt = whole.withColumn("bucket", F.pmod(F.xxhash64("lang", "prefix"), F.lit(buckets)))
    before = F.sum("f").over(Window.partitionBy("bucket").orderBy("lang", "prefix")) - F.col("f")
    part = F.expr(f"before div {budget}").alias("part")
    return dealt.withColumn("before", before).select("lang", "prefix", F.struct("bucket", part).alias("group"))


def phrase_counts(
    docs: DataFrame, least: int = LEAST, budget: int = BUDGET, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``f`` of all phrases of up to four words that occur ``least`` times, and ``lang``, ``n``."""
    spark = docs.sparkSession
    cast = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), cast)
    words = stored(word_counts(texts), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    budget = max(budget, (words.agg(F.sum("f")).first()[0] or 0) // PREFIXES)
    levels = {1: words.where(F.col("f") >= least)}
    words_held = spark.sparkContext.broadcast(_bitmap(levels[1], 1))
    levels[2] = stored(pair_counts(texts, words_held).where(F.col("f") >= least), "pairs")
    pairs_held = spark.sparkContext.broadcast(_bitmap(levels[2], 2))
    over = {level: _collected(counts, budget) for level, counts in levels.items()}
    found = suffixes(texts, pairs_held, spark.sparkContext.broadcast(over)).withColumn("prefix", F.expr("substring_index(phrase, ' ', head)"))
    whole = levels[1].union(levels[2].where(F.col("f") > budget))
    if over[2]:  # prefixes of three words are counted on the suffixes, which hold their occurrences summed up
        found = stored(found, "suffixes")
        deep = found.where("head = 3")
        counted = deep.groupBy("lang", "prefix").agg(F.sum("f").alias("f")).select("lang", F.col("prefix").alias("phrase"), "f")
        levels[3] = stored(counted.where(F.col("f") >= least), "prefix-counts")
        large = levels[3].where(F.col("f") > budget)
        leaves = deep.where((F.size(F.split("phrase", " ", -1)) == DEPTH) & (F.col("f") >= least))  # a suffix of full depth is a leaf
        leaves = leaves.join(large.select("lang", F.col("phrase").alias("prefix")), ["lang", "prefix"], "left_semi")
        whole = whole.union(large).union(leaves.select("lang", "phrase", "f"))
    grown = found.join(_packed(levels, budget), ["lang", "prefix"]).groupBy("group").applyInArrow(lambda rows: subtree(rows, least), COUNTS)
    whole = whole.union(grown)
    return stored(whole, "phrases"), sizes


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, budget: int = BUDGET,
    text: str = "text", lang: str = "lang",
) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts, sizes = phrase_counts(docs, least, budget, text, lang)
    words = F.split("phrase", " ", -1)
    candidates = counts.select("lang", "phrase", F.col("f").alias("a"), F.size(words).alias("size")).where("size > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cuts.withColumns({
        "first": F.expr("substring_index(phrase, ' ', k)"), "rest": F.expr("substring_index(phrase, ' ', k - size)"),
    })
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    )
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "explode(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),"
        " s -> array_join(slice(words, s, m), ' ')))))"
    )
    inside = candidates.where("size > 2").withColumn("words", words).select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    largest = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    absorbed = F.coalesce(_exact(F.col("longer")) * 100 >= _exact(F.col("a")) * share, F.lit(False))
    kept = lowest.join(largest, ["lang", "phrase"], "left").where(~absorbed)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.row_number().over(shares))
    ranked = ranked.where(F.col("rank") <= top)  # at most ``SHARES * top`` rows of a language are ranked in one task
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
n AS (SELECT lang, sum(len(words))::bigint AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
      FROM w, unnest(range(1, {DEPTH + 1})) AS s(m), unnest(range(1, len(words) - m + 2)) AS t(i)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m > 1),
cut AS (SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
               (({SCALE}::hugeint * c.a) // (x.f::hugeint + y.f))::bigint AS score
        FROM c, unnest(range(1, c.m)) AS t(k)
        JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:k], ' ')
        JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[k + 1:c.m], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrase AS (SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, max(a) AS longer
          FROM c, unnest(range(2, m)) AS u(s), unnest(range(1, m - s + 2)) AS t(i) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inner_phrase b USING (lang, phrase)
         WHERE b.longer IS NULL OR 100::hugeint * b.longer < {SHARE}::hugeint * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n, score
FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
