"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits form four blocks of 16. Two fingerprints that differ in at most two bits
agree in at least two blocks, so each fingerprint is listed under its six pairs of blocks, the lists
are joined on the pair, and the Hamming distance of each meeting is verified. Documents of equal
fingerprint are one entry throughout.

A pair of blocks that many fingerprints share would pair them all. Its members are listed
once more instead, under every value that is at most one bit away outside the shared blocks:
members at distance two or less meet there, at most 33 share a value, and all that do are links.

Defined results: null and empty texts have fingerprint zero and link like any other; rows that
share an id are kept; a null id is never the smallest of its group unless all are null; an empty
table gives no rows; other columns are ignored or, in ``drop_near_copies``, kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pulselake.llm.common import keyed, stored
from pulselake.llm.components import connected_components

SEED, SHINGLE, DISTANCE = 42, 3, 2
#: Pairs of blocks with more fingerprints than this are resolved by one-bit neighbours.
PAIRED = 64

#: Masks of the four blocks, and the pairs of them that agree.
BLOCKS = tuple(0xFFFF << (16 * i) for i in range(4))
AGREE = tuple((i, j) for i in range(4) for j in range(i + 1, 4))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint_of(text: bytes | None) -> int:
    """The signed fingerprint of one text in UTF-8."""
    words = (text or b"").lower().split()  # on bytes: A-Z, and white space as in the contract
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % three for three in zip(words, words[1:], words[2:])]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column, as a signed long."""
    return _fingerprints(F.coalesce(text, F.lit("")).cast("binary"))


def fingerprint_links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Links ``a``, ``b`` between the nodes of distinct fingerprints ``print``, enough to connect all that are close."""
    keys = F.explode(F.array(*(
        F.struct(F.lit(n).alias("agree"), F.col("print").bitwiseAND(F.lit(_signed(BLOCKS[i] | BLOCKS[j]))).alias("value"))
        for n, (i, j) in enumerate(AGREE)
    )))
    listed = prints.select("print", "node", keys.alias("key")).select("print", "node", "key.*")
    sizes = listed.groupBy("agree", "value").agg(F.count("*").alias("members")).where("members > 1")
    shared = stored(listed.join(sizes, ["agree", "value"]), "blocks")
    few = shared.where(F.col("members") <= paired).drop("members")
    other = few.select("agree", "value", F.col("print").alias("other_print"), F.col("node").alias("other"))
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("other_print"))) <= DISTANCE
    met = few.join(other, ["agree", "value"]).where((F.col("node") < F.col("other")) & close)
    flips = F.explode(F.filter(
        F.array(F.lit(0), *(F.lit(_signed(1 << i)) for i in range(64))),
        lambda bit: bit.bitwiseAND(F.element_at(F.array(*(F.lit(_signed(BLOCKS[i] | BLOCKS[j])) for i, j in AGREE)), F.col("agree") + 1)) == 0,
    ))
    many = shared.where(F.col("members") > paired).select("agree", "print", "node", flips.alias("bit"))
    many = many.select("agree", "node", F.col("print").bitwiseXOR(F.col("bit")).alias("near"))
    lowest = many.groupBy("agree", "near").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    close_by = many.join(lowest, ["agree", "near"]).where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    return met.select(F.col("node").alias("a"), F.col("other").alias("b")).union(close_by).distinct()


def components_of(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``print`` and ``component`` for all fingerprints of the rows ``node``, ``print``."""
    distinct = stored(prints.groupBy("print").agg(F.min("node").alias("node")), "fingerprints")
    found = connected_components(fingerprint_links(distinct.where("node is not null"), paired))
    return distinct.join(found, "node", "left").select("print", F.coalesce("component", "node").alias("component"))


def near_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", paired: int = PAIRED) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row."""
    prints = stored(docs.select(F.col(ident).cast("long").alias("node"), fingerprint(F.col(text)).alias("print")), "prints")
    joined = prints.join(components_of(prints, paired), "print")
    return joined.select(
        F.col("node").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of the row of smallest id in each group of near copies; of equal rows, one."""
    rows = keyed(docs)
    own = rows.select(F.col("row")[ident].cast("long").alias("ident"), "place", fingerprint(F.col("row")[text]).alias("print"))
    prints = stored(own, "prints")
    groups = prints.join(components_of(prints.select(F.col("ident").alias("node"), "print")), "print")
    first = F.min(F.struct(F.col("ident").isNull().alias("unknown"), "ident", "place")).alias("first")
    alone = F.when(F.col("component").isNull(), F.col("print"))  # null ids have no group beyond their fingerprint
    kept = groups.groupBy("component", alone.alias("alone")).agg(first).select("first.place")
    return rows.join(kept, "place", "left_semi").select("row.*")
