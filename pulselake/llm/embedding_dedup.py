"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits by random directions, at medians of a bounded sample; vectors close to a split go
to both sides. What shares a leaf of any tree is compared, exactly and in double precision.

Copies come first: inside each leaf of the first tree (without overlap), vectors within ``RADIUS``
of a common centre form a class. Two members of a class are always linked, as twice the radius is
below the angle of a link, so classes stand for all their pairs. A leaf with very many vectors is
dealt to several tasks and their classes are merged afterwards. Only classes go through the
forest; for two classes the angle of their centres and how far their members reach usually tell
that all or none of their members are linked, and otherwise members are compared.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; shorter vectors count as filled up with zeros; rows that share an id are vectors of their
own, and a group's id is its smallest non-null one; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import smallest_hash, stored
from pulselake.llm.components import connected_components

COSINE = 0.95
LINK = math.acos(COSINE)
RADIUS = LINK / 2 - 1e-4
TREES, LEAF, SAMPLE, SUPPORT = 10, 200, 4096, 16
#: Half the width of the overlap at a split, in standard deviations of the projections.
SPILL = 0.12
#: Vectors compared in one task; larger leaves are dealt out in blocks.
BLOCK = 4096
SEED = 20
HAIR = 1e-9


@dataclass
class Forest:
    """Directions by tree and level, and thresholds by tree, level and node (of the sampled depth)."""

    directions: np.ndarray
    thresholds: list[list[np.ndarray]]
    widths: np.ndarray
    sampled: int

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def _node(self, path: np.ndarray, level: int) -> np.ndarray:
        return path >> max(0, level - self.sampled)

    def home(self, x: np.ndarray, tree: int = 0) -> np.ndarray:
        """The one leaf of each vector without overlap."""
        path = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            at = x @ self.directions[tree, level] - self.thresholds[tree][level][self._node(path, level)]
            path = 2 * path + (at >= 0)
        return path

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``x`` and all leaves that they reach, over all trees."""
        rows, out = [], []
        for tree in range(len(self.directions)):
            row, path = np.arange(len(x)), np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (x @ self.directions[tree, level])[row] - self.thresholds[tree][level][self._node(path, level)]
                right, left = at >= -self.widths[tree, level], at < self.widths[tree, level]
                row, path = np.concatenate([row[left], row[right]]), np.concatenate([2 * path[left], 2 * path[right] + 1])
            rows.append(row)
            out.append(path + (tree << 40))
        return np.concatenate(rows), np.concatenate(out)


def grow(sample: np.ndarray, count: int, seed: int = SEED) -> Forest:
    """A forest for ``count`` vectors, its splits at medians of the sample's unit vectors."""
    rng = np.random.default_rng(seed)
    depth = max(0, math.ceil(math.log2(max(count / LEAF, 1))))
    sampled = min(depth, max(0, int(math.log2(max(len(sample) / SUPPORT, 1)))))
    width = sample.shape[1] if sample.ndim == 2 and len(sample) else 1
    directions = rng.standard_normal((TREES, depth, width))
    directions /= np.maximum(np.linalg.norm(directions, axis=2, keepdims=True), 1e-12)
    thresholds, widths = [], np.zeros((TREES, depth))
    for tree in range(TREES):
        path, levels = np.zeros(len(sample), np.int64), []
        for level in range(depth):
            at = sample @ directions[tree, level]
            widths[tree, level] = SPILL * at.std()
            node = path if level <= sampled else path >> (level - sampled)
            cuts = np.zeros(1 << min(level, sampled))
            for k in np.unique(node):
                cuts[k] = np.median(at[node == k])
            levels.append(cuts)
            path = 2 * path + (at >= cuts[node])
        thresholds.append(levels)
    return Forest(directions, thresholds, widths, sampled)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def classes_of(x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[float]]:
    """Groups of points that, with all within their ``reach``, lie within ``RADIUS`` of a centre.

    The group of each point, and centre and reach of each group. A point starts a group with all that
    might belong, their mean is the centre, and those too far from it wait for a later group.
    """
    group = np.full(len(x), -1)
    centres, reaches = [], []
    for i in range(len(x)):
        if group[i] >= 0:
            continue
        free = np.flatnonzero(group < 0)
        near = free[x[free] @ x[i] >= math.cos(2 * RADIUS)]
        own, centre, far = np.array([i]), x[i], reach[i : i + 1]
        if len(near) > 1:
            mean = x[near].sum(axis=0)
            mean /= np.linalg.norm(mean)
            away = _angle(x[near] @ mean) + reach[near] + HAIR
            close = away <= RADIUS
            if close[near == i].any() and close.sum() > 1:  # a point alone is its own centre
                own, centre, far = near[close], mean, away[close]
        group[own] = len(centres)
        centres.append(centre)
        reaches.append(float(far.max()))
    return group, centres, reaches


def _salted(rows: DataFrame, key: str, ident: str, block: int) -> DataFrame:
    """``rows`` with ``parts``, in how many tasks each key's rows are dealt, and ``part``."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    return rows.join(sizes, key).withColumn("part", F.pmod(F.xxhash64(ident), F.col("parts")).cast("int"))


def _grouped(x: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A task that groups points: each row's class, and centre, reach and size on one row per class."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        group, centres, reaches = classes_of(np.stack(rows[x].to_list()), rows["reach"].to_numpy())
        weight = rows["size"].to_numpy()
        first = pd.Series(group).drop_duplicates().index
        out = pd.DataFrame({"node": rows["node"], "leaf": rows["leaf"], "parts": rows["parts"]})
        out["class"] = rows["node"].to_numpy()[first][group]
        out["centre"] = None
        out["centre"] = out["centre"].astype(object)
        for k, at in enumerate(first):
            out.at[at, "centre"] = centres[k]
        out["reach"] = np.array(reaches)[group]
        out["size"] = np.bincount(group, weight)[group].astype(np.int64)
        return out

    return run


def near_embeddings(vectors: DataFrame, ident: str = "vec_id", embedding: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size(embedding))).first()[0] or 0
    base = vectors.select(F.monotonically_increasing_id().alias("node"), F.col(ident).alias("vec_id"), F.col(embedding).cast("array<double>").alias("raw"))
    form = f"node long, vec_id {vectors.schema[ident].dataType.simpleString()}, x array<double>"

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column(2).to_pylist():
                x = np.zeros(max(width, 1))
                if raw and None not in raw:
                    x[: len(raw)] = raw
                top = np.abs(x).max()
                x = x / top if np.isfinite(top) and top > 0 else np.zeros(1)
                length = np.linalg.norm(x)
                out.append(x / length if length > 0 and np.isfinite(length) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([None if x is None else x.tolist() for x in out], pa.list_(pa.float64()))],
                ["node", "vec_id", "x"],
            )

    every = stored(base.mapInArrow(unit, form), "vectors")
    valid = every.where("x is not null")
    count = valid.count()
    chosen = smallest_hash(valid, "node", SAMPLE)
    picked = valid.select("node", "x").join(F.broadcast(chosen), "node").collect()
    picked = sorted(picked, key=lambda r: r["node"])
    forest = spark.sparkContext.broadcast(grow(np.array([r["x"] for r in picked]), count))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.value.home(x)), batch.column(1)], ["node", "leaf", "x"])

    housed = valid.select("node", "x").mapInArrow(homes, "node long, leaf long, x array<double>")
    housed = housed.withColumns({"reach": F.lit(0.0), "size": F.lit(1).cast("long")})
    class_form = "node long, leaf long, parts int, class long, centre array<double>, reach double, size long"
    members = _salted(housed, "leaf", "node", block).groupBy("leaf", "part").applyInPandas(_grouped("x"), class_form)
    members = stored(members, "members")
    leads = members.where("centre is not null")
    hot = leads.where("parts > 1").select("node", "leaf", "parts", "centre", "reach", "size")
    merged = stored(hot.groupBy("leaf").applyInPandas(_grouped("centre"), class_form), "merged")
    again = merged.select(F.col("node").alias("class"), F.col("class").alias("merged"))
    belongs = stored(members.join(again, "class", "left").select("node", F.coalesce("merged", "class").alias("class")), "belongs")
    classes = stored(
        leads.where("parts = 1").union(merged.where("centre is not null")).select("class", "centre", "reach", "size"), "classes"
    )

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                row, leaf = forest.value.leaves(np.stack(batch.column(1).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *(c.take(pa.array(row)) for c in batch.columns)], ["leaf", *batch.schema.names])

    reached = classes.mapInArrow(routed, "leaf long, class long, centre array<double>, reach double, size long")
    dealt = _salted(reached, "leaf", "class", block)
    meets = F.explode(F.transform(  # block a meets block b: the rows of part p go to (p, q) and (q, p), ordered
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda q: F.struct(F.least("part", q).alias("one"), F.greatest("part", q).alias("two")),
    ))
    dealt = dealt.withColumn("meet", meets).select("leaf", "meet.one", "meet.two", "part", "class", "centre", "reach", "size")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("class", ignore_index=True)
        ids, reach, size = (rows[c].to_numpy() for c in ("class", "reach", "size"))
        x, part = np.stack(rows["centre"].to_list()), rows["part"].to_numpy()
        across = rows["one"].iloc[0] != rows["two"].iloc[0]
        found = []
        for at in range(0, len(x), 512):
            angle = _angle(x[at : at + 512] @ x.T)
            some = angle <= LINK + reach[at : at + 512, None] + reach[None, :] + HAIR
            some &= np.arange(at, at + len(angle))[:, None] < np.arange(len(x))[None, :]
            i, j = np.nonzero(some)
            found.append((i + at, j, angle[i, j]))
        i, j, angle = (np.concatenate(c) for c in zip(*found))
        if across:
            keep = part[i] != part[j]
            i, j, angle = i[keep], j[keep], angle[keep]
        alone = (size[i] == 1) & (size[j] == 1)
        exact = np.einsum("ij,ij->i", x[i], x[j]) >= COSINE
        whole = np.where(alone, exact, angle + reach[i] + reach[j] <= LINK - HAIR)
        out = pd.DataFrame({"p": ids[i], "q": ids[j], "size_p": size[i], "size_q": size[j], "whole": whole})
        return out[exact | ~alone]

    pairs = dealt.groupBy("leaf", "one", "two").applyInPandas(compare, "p long, q long, size_p long, size_q long, whole boolean")
    pairs = stored(pairs.dropDuplicates(["p", "q"]), "pairs")

    whole, split = pairs.where("whole"), pairs.where("not whole")
    by_class = whole.select(F.col("p").alias("class"), F.col("size_q").alias("n")).union(whole.select("q", "size_p"))
    by_class = by_class.groupBy("class").agg(F.sum("n").alias("class_links"))
    sides = split.select("p", "q").union(split.select(F.col("q").alias("p"), F.col("p").alias("q")))
    inside = belongs.join(valid.select("node", "x"), "node")
    away = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _dot(F.col("x"), F.col("centre")))))
    tried = sides.join(inside.select(F.col("class").alias("p"), "node", "x"), "p").join(
        classes.select(F.col("class").alias("q"), "centre", "reach", "size"), "q"
    ).withColumn("away", away)
    tried = stored(tried.where(F.col("away") <= LINK + F.col("reach") + HAIR).drop("centre"), "tried")
    every_one = F.col("away") + F.col("reach") <= LINK - HAIR
    sure = tried.where(every_one).select("p", "q", "node", F.col("size").alias("n"))
    other = inside.select(F.col("class").alias("q"), F.col("x").alias("y"))
    unsure = tried.where(~every_one).select("p", "q", "node", "x").join(other, "q").where(_dot(F.col("x"), F.col("y")) >= COSINE)
    unsure = unsure.groupBy("p", "q", "node").agg(F.count("*").alias("n"))
    links = stored(sure.union(unsure.select("p", "q", "node", "n")), "links")
    by_node = links.groupBy("node").agg(F.sum("n").alias("node_links"))

    edges = whole.select(F.col("p").alias("a"), F.col("q").alias("b")).union(links.select("p", "q"))
    found = connected_components(edges).withColumnRenamed("node", "class")
    sizes = classes.select("class", "size").join(by_class, "class", "left").join(found, "class", "left")
    told = belongs.join(sizes, "class").join(by_node, "node", "left").select(
        "node", (F.col("size") - 1 + F.coalesce("class_links", F.lit(0)) + F.coalesce("node_links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("component"),
    )
    full = stored(every.select("node", "vec_id").join(told, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "node").alias("component"),
    ), "told")
    lowest = full.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return full.join(lowest, "component").select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
