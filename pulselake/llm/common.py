"""Reading tables, storing intermediate results and splitting labelled rows, shared by the operators."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.session import workspace

#: The white space between words, as the contracts name it.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the library from where the driver did.

    On a cluster install the package or pass it with ``--py-files``; the path then does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the running stage, and readers share one copy.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """Each row as one value ``row``, so that no column can clash, beside its ``place``, which no scan changes.

    Rows read straight from files are named by file and position. Any other rows are stored once with
    their number: numbers given while a table is scanned differ from scan to scan when its splits do,
    as they may when executors come or go.
    """
    where = ("_metadata.file_path", "_metadata.row_index")
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("a column of that name")
        return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.struct(*where).alias("place"))
    except AnalysisException:
        numbered = docs.select(F.struct("*").alias("row"), F.struct(F.monotonically_increasing_id()).alias("place"))
        return stored(numbered, "rows")


def remainder(ident: Column, parts: int) -> Column:
    """``crc32(id as text) mod parts``, the split between learning and held-out rows."""
    return F.crc32(ident.cast("string").cast("binary")) % parts


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def smallest_hash(rows: DataFrame, ident: str, count: int) -> DataFrame:
    """``ident`` of the ``count`` rows of smallest hash: a bounded sample that stays the same from run to run.

    Hashes far above the expected cut are dropped first, so tasks do not each pass on ``count`` rows.
    """
    marks, total = F.xxhash64(ident), rows.count()
    names = rows.select(ident)
    if total > 4 * count:
        names = names.where(marks < int((1 << 64) * 2 * count / total) - (1 << 63))
    return names.orderBy(marks, ident).limit(count)


def heaviest(rows: DataFrame, weight: str, count: int) -> DataFrame:
    """The rows of largest ``weight``, at most ``count``: all above a level, in steps of a twelfth of an octave."""
    level = F.floor(F.log2(F.col(weight) + 1) * 12)
    cut, held = None, 0
    for r in sorted(rows.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):  # at most 12 * 64
        held += r["count"]
        if held > count:
            break
        cut = r["level"]
    return rows.where(level >= cut) if cut is not None else rows.limit(0)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A bounded sample of labelled texts: the ``rows`` documents of smallest hash, with their label.

    Only labelled rows outside the held-out quarter (remainder 2 of 4) count; null labels are left
    out, a document labelled twice takes its larger label. Columns: ``ident``, ``label``, ``text``.
    The identifiers are chosen first, so texts are read only for the chosen rows.
    """
    labelled = labels.where((remainder(F.col(ident), 4) != 2) & F.col(label).isNotNull())
    each = labelled.groupBy(F.col(ident).alias("ident")).agg(F.max(label).alias("label"))
    chosen = each.join(F.broadcast(smallest_hash(each, "ident", rows)), "ident")
    texts = docs.select(F.col(ident).alias("ident"), F.coalesce(text, F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "ident")  # at most ``rows`` identifiers
    return found.groupBy("ident", "label").agg(F.min("text").alias("text"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, ident: str = "doc_id", text: str = "text"
) -> pd.DataFrame:
    """The rows of ``labelled_rows`` on the driver, by ``ident``."""
    return labelled_rows(docs, labels, label, rows, ident, text).toPandas().sort_values("ident", ignore_index=True)
