"""Benchmark decontamination: word windows of benchmark items looked up in a broadcast hash set.

All on built-in functions. The hashes of the items' windows are a hash set that each task carries, by a
broadcast join on the hash alone, in passes of ``HASHES`` entries at most. Every window of every text is
tested against it where the text is read, and a window that passes is verified by joining its words.
Neither texts nor the windows that fail the test are shuffled, whatever the size of the benchmark.

Defined results: null or wordless texts have no words and no hits, null or wordless items no
windows; an item of fewer words than a window is one window; null item ids are ignored; rows that
share a document id are judged one by one; empty tables are allowed on either side; other columns
are ignored or, in the functions that remove, kept.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import LOWER, UPPER, keyed, lower_ascii, stored

WINDOW = 10
#: Hashes in a broadcast hash set, some 40 bytes each; a larger benchmark takes several passes.
HASHES = 4_000_000
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, lower-cased in A-Z."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``hash``, ``window`` (their words), ``size`` and ``items`` that hold them."""
    items = benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("words")).where("size(words) > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))))
    cut = items.select("item_id", "words", starts.alias("start")).select(
        "item_id", F.slice("words", F.col("start"), F.lit(window)).alias("window")
    )
    found = cut.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return found.select(F.xxhash64("window").alias("hash"), "window", F.size("window").alias("size"), "items")


def _every(size: int) -> str:
    return f"CASE WHEN size(words) >= {size} THEN sequence(1, size(words) - {size - 1}) ELSE array() END"


def _hashes(size: int) -> str:
    return f"transform({_every(size)}, i -> named_struct('start', i, 'size', {size}, 'hash', xxhash64(slice(words, i, {size}))))"


def _candidates(split: DataFrame, windows: DataFrame, sizes: list[int], own: list[str], pieces: int) -> DataFrame:
    """Candidate windows by a broadcast hash set of ``HASHES`` entries at most, one pass for each such piece.

    Only hashes are compared as the texts stream by; the words of a window are cut out where its hash is
    known. A row of start null stands for each document.
    """
    every = F.concat(F.expr("array(named_struct('start', cast(null as int), 'size', cast(null as int), 'hash', cast(null as bigint)))"),
                     *[F.expr(_hashes(n)) for n in sizes])
    split = stored(split, "words") if pieces > 1 else split  # each pass then sees the same places
    found = []
    for piece in range(pieces):
        known = windows.where(F.pmod("hash", F.lit(pieces)) == piece).select("hash").distinct().withColumn("known", F.lit(True))
        rows = split.select(*own, "words", F.explode(every if piece == 0 else F.slice(every, 2, 1 << 30)).alias("tried"))
        rows = rows.select(*own, "words", "tried.*").join(F.broadcast(known), "hash", "left").where("known or start is null")
        found.append(rows.select(*own, "start", F.expr("slice(words, start, size)").alias("window")))
    return functools.reduce(DataFrame.union, found)


def marked(
    docs: DataFrame, benchmark: DataFrame, text: Column, place: Column, window: int = WINDOW, hashes: int = HASHES,
    ident: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its ``place``, ``n_words``, verified ``hits`` (start and size) and ``items``,
    with the column ``ident`` if one is asked for.

    ``place`` tells rows apart. Whoever joins on it needs one that is the same in every scan, as
    ``keyed`` gives it.
    """
    windows = stored(benchmark_windows(benchmark, window), "windows")
    sizes = [r["size"] for r in windows.select("size").distinct().orderBy("size").collect()]  # 1 to ``window``
    pieces = max(1, -(-windows.count() // hashes))
    own = ["place", *([] if ident is None else ["ident"]), "n_words"]
    named = [] if ident is None else [ident.alias("ident")]
    split = docs.select(place.alias("place"), *named, words(text).alias("words")).withColumn("n_words", F.size("words"))
    tried = _candidates(split, windows, sizes, own, pieces)
    # Rows without a window match nothing; by their place they spread over all tasks of a shuffled join.
    verified = tried.withColumn("hash", F.when(F.col("window").isNull(), F.xxhash64("place")).otherwise(F.xxhash64("window"))).join(
        windows.select("hash", "window", "size", "items"), ["hash", "window"], "left"
    )
    hit = F.when(F.col("size").isNotNull(), F.struct("start", "size"))
    return verified.groupBy(*own).agg(
        F.collect_set(hit).alias("hits"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )


def covered(hits: Column) -> Column:
    """How many words lie in at least one hit."""
    inside = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))
    return F.size(F.array_distinct(F.flatten(inside))).cast("long")


def report(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    found = marked(docs, benchmark, F.col(text), F.monotonically_increasing_id(), ident=F.col(ident), **options)
    return found.select(
        F.col("ident").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without any hit, all columns kept."""
    rows = keyed(docs)
    dirty = _dirty(rows, benchmark, text, **options).select("place")
    return rows.join(dirty, "place", "left_anti").select("row.*")


def _dirty(rows: DataFrame, benchmark: DataFrame, text: str, **options) -> DataFrame:
    """``place`` and ``hits`` of the rows with hits."""
    return marked(rows, benchmark, F.col("row")[text], F.col("place"), **options).where("size(hits) > 0").select("place", "hits")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows and columns; where a text has hits, its lower-cased words outside them, space-joined, replace it."""
    rows = keyed(docs)
    joined = rows.join(_dirty(rows, benchmark, text, **options), "place", "left").withColumn("old", F.col("row")[text])
    inside = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))))
    split = joined.withColumns({"words": F.when(F.col("hits").isNotNull(), words(F.col("old"))), "inside": inside})
    rest = F.filter("words", lambda w, i: ~F.array_contains("inside", i + 1))
    cleaned = F.when(F.col("hits").isNotNull(), F.array_join(rest, " ")).otherwise(F.col("old"))
    return split.select(F.col("row").withField(text, cleaned).alias("row")).select("row.*")


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w
      FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, CASE WHEN len(w) < {WINDOW} THEN w ELSE w[i:i + {WINDOW - 1}] END AS win
       FROM b, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item_id::varchar)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
       coalesce(len(items), 0)::bigint AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""
