"""Rows that are dropped or changed stay the right ones when the splits of a table differ between scans."""

import pytest

from pulselake.llm import common, decontaminate, simhash
from pulselake.llm.common import importable, keyed


@pytest.fixture
def shifting(spark, monkeypatch):
    """Every stored result changes how the next scan is split, as executors that come or go do."""
    names = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    state, real = {"n": 4}, common.stored

    def stored(df, label):
        out = real(df, label)
        state["n"] = 11 if state["n"] == 4 else 4
        spark.conf.set(names[0], str(state["n"]))
        return out

    spark.conf.set(names[0], "4")
    spark.conf.set(names[1], "1024")
    for module in (common, simhash, decontaminate):
        monkeypatch.setattr(module, "stored", stored)
    yield state
    for name in names:
        spark.conf.unset(name)


def texts(spark, folder, count):
    importable(spark)
    rows = spark.range(count).selectExpr("id as doc_id", "concat('text ', id div 2, ' has the words ', sha2(string(id div 2), 256), ' ', sha2(string(id div 2 + 7), 256)) as text", "'p' as place")
    rows.repartition(7).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("derived", [False, True])
def test_near_copies_keep_one_of_each(spark, folder, shifting, derived):
    docs = texts(spark, folder, 40_000)
    if derived:  # rows that are not read straight from files
        docs = docs.groupBy("doc_id", "text", "place").count().drop("count")
    kept = simhash.drop_near_copies(docs).collect()
    assert len(kept) == len({r["text"] for r in kept}) == 20_000 and all(r["doc_id"] % 2 == 0 for r in kept)


@pytest.mark.parametrize("derived", [False, True])
def test_contaminated_rows_are_the_ones_that_go(spark, folder, shifting, derived):
    docs = texts(spark, folder, 5_000)
    if derived:
        docs = docs.distinct()
    items = docs.where("doc_id % 10 = 0").selectExpr("doc_id as item_id", "text")
    kept = decontaminate.drop_contaminated(docs, items).collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i in range(5_000) if i % 10 > 1]
    cleaned = decontaminate.remove_spans(docs, items).collect()
    assert len(cleaned) == 5_000 and all((r["text"] == "") == (r["doc_id"] % 10 <= 1) for r in cleaned)


def test_rows_with_a_column_named_like_the_metadata(spark, folder):
    docs = texts(spark, folder, 10).withColumnRenamed("place", "_metadata")
    assert keyed(docs).select("row.*").columns == docs.columns and keyed(docs).select("place").distinct().count() == 10
