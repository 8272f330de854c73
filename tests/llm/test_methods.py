"""The methods' cores against plain versions, and queries against their SQL."""

import itertools
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from pulselake.llm import decontaminate, language, main_text, mixing, quality, toxicity
from pulselake.llm.common import heaviest, importable, smallest_hash, table
from pulselake.llm.queries import ORACLE


def same_as_sql(df, sql, sf_dir):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    wanted = db.execute(sql).fetchdf()
    columns = sorted(wanted.columns)
    found = df.toPandas()[columns].sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(found, wanted[columns].sort_values("doc_id", ignore_index=True), check_dtype=False, check_exact=True)


@pytest.mark.parametrize("options", [{}, {"hashes": 700}])
def test_decontamination_by_hash_sets_of_any_size(spark, sf_dir, options):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    same_as_sql(decontaminate.report(docs, benchmark, **options), ORACLE["op4_benchmark_decontamination"], sf_dir)


def test_spans_are_removed(spark):
    docs = importable(spark).createDataFrame([(1, "Keep a b c d e f g h i j, this"), (2, "A b c stays")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "A B C D E F G H I J"), (2, "q r")], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.remove_spans(docs, items).collect()) == [(1, "keep this"), (2, "A b c stays")]


@pytest.mark.parametrize("bucket", [4096, 2])
def test_mixing_by_buckets_equals_one_running_sum(spark, sf_dir, bucket):
    same_as_sql(mixing.mixture(table(spark, sf_dir, "documents"), bucket=bucket), ORACLE["op7_mixing"], sf_dir)


def test_flow_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(60):
        names = ["a", "b", "c"]
        patterns = {p: rng.randint(0, 3) for p in [("a",), ("a", "b"), ("b", "c"), ("c",)]}
        quotas = {s: rng.randint(0, 4) for s in names}
        flow = mixing.route(patterns, quotas)
        edges = [(p, s) for p in patterns for s in p]
        best = None
        for amounts in itertools.product(range(5), repeat=len(edges)):
            use, sent = Counter(), Counter()
            for (p, s), n in zip(edges, amounts):
                use[p] += n
                sent[s] += n
            if any(use[p] > 3 * patterns[p] for p in patterns) or any(sent[s] > quotas[s] for s in names):
                continue
            cost = sum(k // patterns[p] for p in patterns if patterns[p] for k in range(use[p]))
            value = (sum(sent.values()), -cost)
            best = value if best is None or value > best else best
        use = {p: sum(by.values()) for p, by in flow.items()}
        cost = sum(k // patterns[p] for p in patterns if patterns[p] for k in range(use[p]))
        assert (sum(use.values()), -cost) == best


def test_nearest_examples_are_exact():
    rng = random.Random(4)
    words = ["nice"] * 5 + [f"word{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=12) + (rng.sample(["scumbag", "vequest", "vequal", "idiotic"], 2) if i % 5 == 0 else [])), int(i % 5 == 0)) for i in range(400)]
    index = toxicity.learn(pd.DataFrame(rows, columns=["ident", "text", "label"]))
    assert index.vocabulary
    for text in ("scumbag vequal nice", "vequest vequest idiotic word1", "vequence"):
        counts = Counter(index.vocabulary[t] for w in toxicity.words_of(text) for t in toxicity.terms_of(w) if t in index.vocabulary)
        vector, score = index.vector(counts), np.zeros(len(index.labels))
        for t, w in vector.items():
            score[index.examples[t]] += w * index.weights[t]
        wanted = sorted((-s, e) for e, s in enumerate(score.tolist()) if s > 0)[: toxicity.NEIGHBOURS]
        assert [e for _, e in index.nearest(vector, toxicity.NEIGHBOURS)] == [e for _, e in wanted]
        assert index.vote(counts)[0] > 0.5
    assert index.score(["a clean text", None, ""])[0][0] < 0.1


def test_phrases_are_the_longest_matches():
    rng = random.Random(6)
    parser = language.learn({"x": ["abab cab bca"], "y": ["dede fed"]})
    for _ in range(50):
        text = "".join(rng.choices("abcdef z", k=rng.randint(0, 40)))
        (counts,), (letters,) = [c[:, 0] for c in [parser.phrases([text])[0]]], [parser.phrases([text])[1][0]]
        spaced = " ".join(text.split())
        spaced = spaced + " " if text.rstrip() != text and spaced else spaced
        for k, sample in enumerate(("abab cab bca", "dede fed")):
            phrases, at = 0, 0
            while at < len(spaced):
                end = at + 1
                if spaced[at] not in sample:
                    phrases, at = phrases + 1, end
                    continue
                while end < len(spaced) and spaced[at : end + 1] in sample:
                    end += 1
                phrases, at = phrases + 1, end
            # after an unknown symbol the next phrase is counted with it
            unknown = sum(c not in sample for c in spaced)
            assert phrases - unknown <= counts[k] <= phrases
        assert letters == sum(c.isalpha() for c in text)


def test_marginals_are_sums_over_all_labellings():
    rng = np.random.default_rng(3)
    field = quality.learn([], np.zeros(0))
    field.change = rng.standard_normal((2, 2))
    lines = np.array([3, 1, 4])
    gain = rng.standard_normal(8)
    good, _ = field.marginals(gain, lines)
    at = 0
    for n in lines:
        weight, total = np.zeros(n), 0.0
        for labels in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum(y * gain[at + i] for i, y in enumerate(labels)) + sum(field.change[a, b] for a, b in zip(labels, labels[1:])))
            total += w
            weight += w * np.array(labels)
        assert good[at : at + n] == pytest.approx(weight / total)
        at += n


def test_blocks_and_their_gradients():
    page = "<html><head><title>T</title></head><body><nav><ul><li><a href='/x'>Home</a><li>Two</ul></nav><article><h1>A&amp;B</h1><p>one <b>two</b>\n three<br>four<p>five</article><script>var t='</p>'</script>"
    assert [(p[-1], t) for p, t, _ in main_text.blocks_of(page)] == [("title", "T"), ("a", "Home"), ("li", "Two"), ("h1", "A&B"), ("p", "one two three"), ("p", "four"), ("p", "five")]
    model = main_text.Labeller.fresh(1)
    for weights in (*model.inputs, *model.recurrent):
        weights *= 0.5
    x = main_text.features(main_text.blocks_of(page) * 2)
    sizes, truth = np.array([9, 5]), np.array([0, 0, 0, 1, 1, 1, 1] * 2, np.float32)

    def loss():
        p = np.clip(model.scores(x, sizes).astype(float), 1e-9, 1 - 1e-9)
        return float(-(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean())

    gradients = model.gradients(x, sizes, truth)
    for weights, gradient in zip([*model.inputs, *model.recurrent, model.output], gradients):
        k = int(np.abs(gradient).argmax())
        old = weights.flat[k]
        weights.flat[k] = old + 1e-2
        up = loss()
        weights.flat[k] = old - 1e-2
        down = loss()
        weights.flat[k] = old
        assert (up - down) / 2e-2 == pytest.approx(float(gradient.flat[k]), rel=0.05, abs=1e-4)


def test_bounded_choices(spark):
    rows = importable(spark).range(5000).selectExpr("id", "id % 100 as n")
    assert {r["id"] for r in smallest_hash(rows, "id", 20).collect()} == {r["id"] for r in rows.selectExpr("id", "xxhash64(id) h").orderBy("h").limit(20).collect()}
    assert 0 < heaviest(rows, "n", 600).count() <= 600 and heaviest(rows, "n", 3).count() == 0
    low = heaviest(rows, "n", 600).agg({"n": "min"}).first()[0]
    assert heaviest(rows, "n", 600).count() == rows.where(f"n >= {low}").count()
