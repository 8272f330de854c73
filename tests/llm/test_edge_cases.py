"""Every operator and stage on awkward and on empty tables."""

import pytest

import corpus_pipeline
from pulselake.llm import decontaminate, embedding_dedup, language, main_text, mixing, ppm, quality, simhash, token_output, toxicity
from pulselake.llm.queries import vocabulary
from tests.llm.helpers import DOCS, awkward, empty

LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(20)] + [(3, None, None), (None, 1, 1), (1, 0, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, LABELS)


def benchmark(spark):
    return spark.createDataFrame([(1, "sat on the mat and looked at the moon for a long"), (2, None), (3, ""), (None, "a b"), (4, "unknown item"), (4, "unknown item")], BENCHMARK)


OPERATORS = {
    "token_output": lambda s, d, r: token_output.encode_table(d, vocabulary("word_bpe_49k.json")),
    "toxicity": lambda s, d, r: toxicity.toxicity(d, labels(s) if r else empty(s, LABELS)),
    "decontaminate": lambda s, d, r: decontaminate.report(d, benchmark(s) if r else empty(s, BENCHMARK)),
    "language": lambda s, d, r: language.languages(d),
    "simhash": lambda s, d, r: simhash.near_copies(d),
    "mixing": lambda s, d, r: mixing.mixture(d),
    "ppm": lambda s, d, r: ppm.scores(d),
    "quality": lambda s, d, r: quality.quality(d, labels(s) if r else empty(s, LABELS)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_documents(spark, name):
    docs = awkward(spark)
    found = OPERATORS[name](spark, docs, True).collect()
    assert len(found) == docs.count()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == sorted([*range(30), 0, 0])
    same = [tuple(r) for r in found if r["doc_id"] == 0]
    if name != "token_output":  # there each row has a place of its own
        assert same[0] == same[1] == same[2]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](spark, empty(spark), False).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "decontaminate", "quality"])
def test_documents_without_reference_rows(spark, name):
    assert OPERATORS[name](spark, awkward(spark), False).count() == 34


@pytest.fixture(scope="module")
def small(tmp_path_factory, spark):
    base = str(tmp_path_factory.mktemp("small"))
    for part, rows in (("full", True), ("none", False)):
        (labels(spark) if rows else empty(spark, LABELS)).write.parquet(f"{base}/{part}/labels.parquet")
        (benchmark(spark) if rows else empty(spark, BENCHMARK)).write.parquet(f"{base}/{part}/benchmark.parquet")
        (awkward(spark, extra=False) if rows else empty(spark)).write.parquet(f"{base}/{part}/documents.parquet")
        awkward(spark).write.parquet(f"{base}/{part}/awkward.parquet")
    return base


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
@pytest.mark.parametrize("part", ["full", "none"])
def test_stages(spark, small, k, part):
    name, stage = corpus_pipeline.STAGES[k]
    sf_dir = f"{small}/{part}"
    for table in ("documents", "awkward"):
        docs = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        out = stage(spark, docs, sf_dir)
        found = out.collect()
        if name != "token_output":
            assert out.columns == docs.columns
        if part == "none" and table == "documents":
            assert found == []
        if name == "near_dedup" and found:
            assert [r["doc_id"] for r in found].count(0) == 1 and 6 not in {r["doc_id"] for r in found}
        if name == "decontamination" and part == "full":
            kept = {r["doc_id"] for r in found}
            assert not kept & {0, 6, 10, 16} and {1, 2, 3, 4, 5, 7} <= kept


def test_run_is_the_stages_in_order(spark, small):
    sf_dir = f"{small}/full"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(path := f"{small}/by-hand-{k}")
        docs = spark.read.parquet(path)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect(), key=key) == sorted(docs.collect(), key=key)


def test_awkward_pages(spark):
    pages = ["<article><p>Main text&amp;more <b>here</p></article><footer>no</footer>", None, "", "<", "plain", "<p" * 5000,
             "<script>var x = '<p>no</p>'", "<article>" + "<p>word</p>" * 3000, "<!-- open", "<p title='x>y", "&#xd800; &bogus; <td>"]
    rows = [(i, f"u{i}", p, "x", 1) for i, p in enumerate(pages)] + [(None, None, None, None, None)] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = {r["page_id"]: r for r in main_text.main_text(frame).collect()}
    assert len(found) == len(pages) + 1 and all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert found[1]["text"] == found[2]["text"] == found[8]["text"] == ""
    none = main_text.main_text(empty(spark, "page_id long, url string, html string"))
    assert none.collect() == []


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [1.0, None]),
            (8, [1e-30, 0.0]), (9, [1.0]), (9, [1.0]), (None, [0.0, 1.0]), (12, [0.0, -3.0]), (13, [1e38, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, node int, class int")
    found = sorted(tuple(r) for r in embedding_dedup.near_embeddings(frame).fillna(-1).collect())
    linked = [(i, 6 - 1 + (0 if i != 9 else 0), 0, i == 0) for i in (0, 1, 8, 9, 9, 13)]
    alone = [(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 12)]
    assert [r for r in found if r[0] >= 0] == sorted(linked + alone)
    assert embedding_dedup.near_embeddings(empty(spark, "vec_id long, embedding array<float>")).collect() == []


def test_documents_schema_is_the_tables(spark, sf_dir):
    assert spark.read.parquet(f"{sf_dir}/documents.parquet").columns == [c.split()[0] for c in DOCS.split(", ")]
