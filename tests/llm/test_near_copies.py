"""SimHash, components and embeddings against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from pulselake.llm import embedding_dedup, simhash
from pulselake.llm.common import importable, table
from pulselake.llm.components import connected_components


def groups(n, linked):
    """The smallest member of each element's component."""
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(a) for a in range(n)]


def test_components_of_random_graphs_and_paths(spark):
    rng = random.Random(3)
    for edges in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)],
                  [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(5, 5), (7, 8), (8, 7)]):
        found = {r["node"]: r["component"] for r in connected_components(importable(spark).createDataFrame(edges, "a long, b long")).collect()}
        expected = groups(200, edges)
        nodes = {x for a, b in edges if a != b for x in (a, b)}
        assert found == {n: expected[n] for n in nodes}


def plain_print(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    prints = [plain_print(r["text"]) for r in rows]
    low = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_copies(docs).collect()}
    assert found == {r["doc_id"]: (f"{p:016x}", rows[c]["doc_id"]) for r, p, c in zip(rows, prints, low)}


@pytest.mark.parametrize("paired", [64, 1])
def test_crowded_blocks_lose_no_link(spark, paired):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = [base]
    for _ in range(150):  # chains of one to three changed bits around one fingerprint, and some alone
        prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    prints = list(dict.fromkeys(prints + [rng.getrandbits(64) for _ in range(20)]))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = importable(spark).createDataFrame(list(enumerate(signed)), "node long, print long")
    found = {r["print"]: r["component"] for r in simhash.components_of(frame, paired).collect()}
    low = groups(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    assert found == dict(zip(signed, low))


def plain_vectors(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    return linked.sum(axis=1).tolist(), groups(len(x), np.argwhere(linked).tolist())


@pytest.mark.parametrize("block", [4096, 40])
def test_embeddings_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    parts = [rng.standard_normal((150, 24))]
    for size, noise in ((120, 0.01), (60, 0.05), (80, 0.045), (2, 0.03), (3, 0.0)):  # tight, loose and borderline groups
        centre = rng.standard_normal(24)
        parts.append(centre / np.linalg.norm(centre) + noise * rng.standard_normal((size, 24)))
    x = np.concatenate(parts)[rng.permutation(415)].astype(np.float32)
    links, low = plain_vectors(x.astype(float))
    frame = importable(spark).createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    found = sorted(embedding_dedup.near_embeddings(frame, block=block).collect())
    right = sum(r["n_links"] == n for r, n in zip(found, links))
    assert sum(r["n_links"] for r in found) >= 0.98 * sum(links) and right >= 0.97 * len(x)
    assert all(r["n_links"] <= n for r, n in zip(found, links))
    assert sum(r["component_id"] == c for r, c in zip(found, low)) >= 0.97 * len(x)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
