"""Mixing sources to target weights: a min-cost flow over membership patterns, then seeded documents.

Documents are added up by the set of sources they belong to (their pattern). A flow routes words
from patterns to the sources' quotas; a pattern offers its words once for free and again, up to
``REPEATS`` times in all, at a cost that grows with each repetition, so overlapping sources share
repetition evenly. What a pattern sends out fixes how often all its documents are taken and how
many words more: these come from its documents in the order of a seeded hash, up to the key at which
the quota is reached, and from the one or two later documents that best fill what is left.

The key at which a quota ends is found digit by digit, by the sums of sixteen children per pattern, first
over sums of buckets of keys and then inside the one bucket where the quota ends, so no source is ever
sorted in one task; the outcome is the same as for one running sum. Only totals by pattern and
thresholds by pattern meet on the driver.

Defined results: null texts have size 0, a null source is a source of its own (the last), rows
that share an id are taken or left together, rows of size 0 add nothing, an empty table gives no
rows; other columns are ignored or, in ``mixed``, kept.
"""

from __future__ import annotations

import json
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.common import WORD, importable, stored

SEED, REPEATS = 42, 3
WEIGHTS = (1, 2, 3)
#: Documents in a bucket of keys, on average, and documents added to fill what the cut leaves.
BUCKET, CLOSING = 4096, 2
DIGITS = "0123456789abcdef"


def size_of(text: Column) -> Column:
    """How many words a text has."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def shares(sizes: dict, weights: dict) -> dict:
    """The target of each source: all words by weight, at most ``REPEATS`` times its size.

    Sources are stopped in the order in which a rising level meets their bound, and the others
    share the rest by weight. Comparisons are between integers.
    """
    order = sorted(sizes, key=lambda s: (REPEATS * sizes[s] / weights[s], s is None, s or ""))
    rest, weight, stopped = sum(sizes.values()), sum(weights.values()), {}
    for s in order:
        if REPEATS * sizes[s] * weight >= rest * weights[s]:
            break
        stopped[s] = float(REPEATS * sizes[s])
        rest, weight = rest - REPEATS * sizes[s], weight - weights[s]
    return {s: stopped[s] if s in stopped else float(rest) * weights[s] / weight for s in sizes}


def route(patterns: dict[tuple, int], quotas: dict) -> dict[tuple, dict]:
    """Words of each pattern for each of its sources, at the least total cost of repetition.

    Successive cheapest paths: patterns offer ``REPEATS`` layers of their size, layer k at cost k,
    and a word may be moved from one source to another of the same pattern to make room.
    """
    flow = {p: dict.fromkeys(p, 0) for p in patterns}
    used, sent = dict.fromkeys(patterns, 0), dict.fromkeys(quotas, 0)
    while True:
        layer = {p: used[p] // n for p, n in patterns.items() if n and used[p] < REPEATS * n}
        best: dict = {}  # source: (cost of one more word, pattern that gives it, source it is taken from)
        for p in sorted(layer, key=lambda p: (layer[p], repr(p))):
            for s in p:
                if s not in best:
                    best[s] = (layer[p], p, None)
        changed = True
        while changed:  # a pattern can move words from one of its sources, which is refilled, to another
            changed = False
            for p, by in flow.items():
                for s in p:
                    for t in p:
                        if s != t and by[t] > 0 and t in best and (s not in best or best[t][0] < best[s][0]):
                            best[s], changed = (best[t][0], p, t), True
        open_ = [s for s in best if sent[s] < quotas[s]]
        if not open_:
            return flow
        target = min(open_, key=lambda s: (best[s][0], s is None, s or ""))
        path, s, amount = [], target, quotas[target] - sent[target]
        while True:
            _, p, moved_from = best[s]
            path.append((p, s, moved_from))
            if moved_from is None:
                amount = min(amount, (layer[p] + 1) * patterns[p] - used[p])
                break
            amount = min(amount, flow[p][moved_from])
            s = moved_from
        for p, s, moved_from in path:
            flow[p][s] += amount
            if moved_from is None:
                used[p] += amount
            else:
                flow[p][moved_from] -= amount
        sent[target] += amount


def plan(sizes: dict[tuple, int], weights: dict | None = None) -> tuple[dict, dict, dict]:
    """Sizes and targets by source, and words taken by pattern, from the words of each pattern."""
    by_source: dict = {}
    for p, n in sizes.items():
        for s in p:
            by_source[s] = by_source.get(s, 0) + n
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    weights = weights or {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    targets = shares(by_source, weights)
    flow = route(sizes, {s: int(t) for s, t in targets.items()})
    return by_source, targets, {p: sum(by.values()) for p, by in flow.items()}


def _pattern(members: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(members)))


def _key(ident: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"))


def descend(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """``edge`` one digit further: in each pattern, the child of ``bucket`` where the sums pass ``left``.

    Sixteen sums by pattern, added up map-side, so no pattern's keys are ever sorted in one task.
    """
    below = rows.join(F.broadcast(edge), "pattern").where(F.startswith("key", "bucket"))  # one row per pattern
    digit = F.expr("substring(key, length(bucket) + 1, 1)")
    sums = below.groupBy("pattern", "bucket", "left").agg(*[F.sum(F.when(digit == d, F.col("size")).otherwise(0)).alias(f"n{d}") for d in DIGITS])
    before, children = F.lit(0), []
    for d in DIGITS:
        upto = before + F.col(f"n{d}")
        found = F.struct(F.concat("bucket", F.lit(d)).alias("bucket"), (F.col("left") - before).alias("left"))
        children.append(F.when(upto > F.col("left"), found))
        before = upto
    return sums.select("pattern", F.coalesce(*children).alias("e")).where("e is not null").select("pattern", "e.bucket", "e.left")


def thresholds(rows: DataFrame, taken: dict[str, tuple[int, int]], bucket: int = BUCKET) -> DataFrame:
    """``pattern``, ``copies``, ``cut`` and ``closing``: a document is taken once more if its key is at most
    ``cut`` or among ``closing``. ``rows`` has ``pattern``, ``key`` and ``size``; ``taken`` copies and quota by pattern."""
    spark = rows.sparkSession
    keyed = stored(rows.groupBy("pattern", "key").agg(F.sum("size").alias("size")), "keys")
    digits = max(1, -(-(keyed.count() // bucket).bit_length() // 4))
    plans = F.broadcast(spark.createDataFrame(  # one row per pattern
        [(p, c, q) for p, (c, q) in taken.items()], "pattern string, copies long, quota long"
    ))
    sums = stored(keyed.groupBy("pattern", F.substring("key", 1, digits).alias("key")).agg(F.sum("size").alias("size")), "sums")
    edge = plans.select("pattern", F.lit("").alias("bucket"), F.col("quota").alias("left"))
    for _ in range(digits):
        edge = descend(sums, edge)
    edge = stored(edge, "edges")
    inside = stored(keyed.join(F.broadcast(edge.select("pattern", "bucket")), "pattern").where(F.startswith("key", "bucket")).drop("bucket"), "edge-keys")
    for _ in range(-(-(bucket - 1).bit_length() // 4)):  # to about one key per pattern
        edge = descend(inside, edge)
    edge = stored(edge, "edges")
    last = inside.join(F.broadcast(edge), "pattern").where(F.startswith("key", "bucket"))
    last = last.withColumn("upto", F.sum("size").over(Window.partitionBy("pattern").orderBy("key"))).where("upto <= left")
    reached = last.groupBy("pattern").agg(F.max("key").alias("key"), F.max("upto").alias("upto"))
    cut = plans.join(edge, "pattern", "left").join(reached, "pattern", "left").select(
        "pattern", "copies", F.coalesce("key", "bucket", F.lit("g")).alias("cut"),  # "g" is above any key
        (F.col("left") - F.coalesce("upto", F.lit(0))).alias("gap"), F.array().cast("array<string>").alias("closing"),
    )
    cut = stored(cut, "cuts")
    for _ in range(CLOSING):
        fits = (F.col("key") > F.col("cut")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
        found = keyed.join(F.broadcast(cut), "pattern").where(fits & ~F.array_contains("closing", F.col("key")))
        best = found.groupBy("pattern").agg(F.min(F.struct((-F.col("size")).alias("less"), "key")).alias("best"))
        cut = stored(cut.join(best, "pattern", "left").select(
            "pattern", "copies", "cut", (F.col("gap") + F.coalesce("best.less", F.lit(0))).alias("gap"),
            F.when(F.col("best").isNull(), F.col("closing")).otherwise(F.array_append("closing", F.col("best.key"))).alias("closing"),
        ), "cuts")
    return cut


def counted(
    docs: DataFrame, members: Column, ident: str = "doc_id", text: str = "text", seed: int = SEED,
    weights: dict | None = None, bucket: int = BUCKET,
) -> tuple[DataFrame, dict, dict]:
    """Each row as ``row`` with its ``size``, ``pattern`` and ``copies``, and the sizes and targets by source."""
    spark = importable(docs.sparkSession)
    tagged = docs.select(  # rows as one value, so that no column can clash
        F.struct("*").alias("row"), size_of(F.col(text)).alias("size"), _pattern(members).alias("pattern"),
        _key(F.col(ident), seed).alias("key"),
    )
    rows = stored(tagged.select("pattern", "key", "size"), "sizes")
    totals = {r["pattern"]: r["n"] for r in rows.groupBy("pattern").agg(F.sum("size").alias("n")).collect()}
    names = {tuple(json.loads(p)): p for p in totals}
    sizes, targets, words = plan({k: totals[p] for k, p in names.items()}, weights)
    taken = {p: divmod(words[k], totals[p]) if totals[p] else (0, 0) for k, p in names.items()}
    if not taken:
        return tagged.withColumn("copies", F.lit(0).cast("long")), sizes, targets
    cuts = thresholds(rows, taken, bucket).select("pattern", "copies", "cut", "closing")
    again = (F.col("key") <= F.col("cut")) | F.array_contains("closing", F.col("key"))
    out = tagged.join(F.broadcast(cuts), "pattern")
    return out.select("row", "size", "pattern", (F.col("copies") + again.cast("long")).alias("copies")), sizes, targets


def mixture(docs: DataFrame, source: str = "source", **options) -> DataFrame:
    """Per document: ``size``, ``source_size``, ``target`` of its source, and ``taken``."""
    docs = docs.select("doc_id", "text", F.col(source).alias("source"))
    out, sizes, targets = counted(docs, F.array(F.col("source").cast("string")), **options)
    per = [(json.dumps([s], ensure_ascii=False, separators=(",", ":")), n, targets[s]) for s, n in sizes.items()]
    named = docs.sparkSession.createDataFrame(per, "name string, source_size long, target double")
    keyed = named.withColumn("pattern", _pattern(F.from_json("name", "array<string>")))
    return out.join(F.broadcast(keyed), "pattern").select(  # one row per source
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, members: Column | None = None, **options) -> DataFrame:
    """The mixture itself: each row as often as it is taken, all columns kept."""
    members = F.array(F.col("source").cast("string")) if members is None else members
    out, _, _ = counted(docs, members, **options)
    return out.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint AS size,
                  md5(concat('{SEED}:', coalesce(doc_id::varchar, ''))) AS key FROM documents),
s AS (SELECT source, sum(size)::bigint AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT source, n, w,
             sum(n) OVER () - coalesce(sum({REPEATS} * n) OVER (ORDER BY {REPEATS} * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY {REPEATS} * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM s),
c AS (SELECT source, n, w, {REPEATS} * n * weight < rest * w AS stopped FROM o),
u AS (SELECT sum(n) - coalesce(sum({REPEATS} * n) FILTER (stopped), 0) AS rest, sum(w) FILTER (NOT stopped) AS weight FROM c),
t AS (SELECT source, n, CASE WHEN stopped THEN ({REPEATS} * n)::double ELSE rest::double * w / weight END AS target FROM c, u),
q AS (SELECT source, n, target, CASE WHEN n = 0 THEN 0 ELSE floor(target)::bigint // n END AS copies,
             CASE WHEN n = 0 THEN 0 ELSE floor(target)::bigint % n END AS quota FROM t),
k AS (SELECT source, key, sum(size)::bigint AS size FROM d GROUP BY source, key),
r AS (SELECT k.*, quota, sum(k.size) OVER (PARTITION BY k.source ORDER BY key) <= quota AS picked
      FROM k JOIN q ON k.source IS NOT DISTINCT FROM q.source),
g AS (SELECT source, max(quota) - coalesce(sum(size) FILTER (picked), 0) AS gap FROM r GROUP BY source),
a AS (SELECT r.source, key, size, gap, row_number() OVER (PARTITION BY r.source ORDER BY size DESC, key) AS place
      FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source WHERE NOT picked AND size > 0 AND size <= gap),
b AS (SELECT x.source, x.key, row_number() OVER (PARTITION BY x.source ORDER BY x.size DESC, x.key) AS place
      FROM a x JOIN a f ON x.source IS NOT DISTINCT FROM f.source AND f.place = 1
      WHERE x.place > 1 AND x.size <= f.gap - f.size),
more AS (SELECT source, key FROM r WHERE picked UNION ALL SELECT source, key FROM a WHERE place = 1
         UNION ALL SELECT source, key FROM b WHERE place = 1)
SELECT d.doc_id, d.size, q.n AS source_size, q.target,
       (d.size * (q.copies + CASE WHEN more.key IS NULL THEN 0 ELSE 1 END))::bigint AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
LEFT JOIN more ON d.source IS NOT DISTINCT FROM more.source AND d.key = more.key
"""
