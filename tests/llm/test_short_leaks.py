"""Problem 9: the shortest leaks are found whatever their cosine."""

import random

import numpy as np

from foreglass.llm.leaks import LEAST_WORDS, Clusters, Items, Searcher, aligned, item_blocks, leaks


def test_search_against_alignment_of_everything():
    rng = random.Random(7)
    terms = {f"w{i}": i for i in range(1, 201)}
    words = [np.array([rng.randrange(1, 201) for _ in range(rng.randrange(LEAST_WORDS, 60))], np.int32) for _ in range(20)]
    items = Items(list(range(20)), words, terms)
    texts = []
    for _ in range(300):
        item = words[rng.randrange(20)].tolist()
        size = min(len(item), rng.choice([10, 11, 12, 12, 12, 16, 17]))
        a = rng.randrange(len(item) - size + 1)
        part = item[a:a + size]
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(part))
            part[at:at + rng.randrange(2)] = [rng.randrange(201)] * rng.randrange(2)
        around = [[rng.choice([0, 0, rng.randrange(1, 201)]) for _ in range(rng.randrange(30))] for _ in range(2)]
        texts.append(np.array(around[0] + part + around[1], np.int32))
    expected = [(t, i) for t, text in enumerate(texts) for i in range(20) if aligned([text], [words[i]])[0]]
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((201, 8)))[0]
    searcher = Searcher(items, np.ones(201), basis)
    assert len(expected) > 100 and searcher.search(texts) == expected
    assert searcher.search([]) == searcher.search([np.zeros(30, np.int32)]) == searcher.search([words[0][:5], np.zeros(3, np.int32)]) == []


def test_blocks_of_items_find_the_same_leaks(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(12, 60)))) for i in range(25)] + [(99, " ".join(rng.choices(words, k=900))), (99, "too short"), (5, None), (None, " ".join(words))]
    texts, expected = [], set()
    for d in range(120):
        i, item = items[rng.randrange(26)]
        own = item.split()
        a = rng.randrange(len(own) - 11)
        part = own[a:a + 12]
        part[rng.randrange(12)] = "changed"
        texts.append((d, " ".join(rng.choices(["x", "y", "z"], k=20) + part + rng.choices(["x", "y"], k=5))))
        expected.add((d, i))
    documents, table = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r) for r in leaks(documents, "doc_id", "text", table, "item_id", "text").collect()}
    assert one >= expected
    blocks = list(item_blocks(table, "item_id", "text", 130, 200, chunk=3000))
    assert len(blocks) > 2 and all(b.size <= 131 and sum(len(w) // 2 + 1 for w in b.words) <= 200 for b in blocks)
    assert {tuple(r) for r in leaks(documents, "doc_id", "text", table, "item_id", "text", 130, 200).collect()} == one


def test_clusters_find_most_of_what_lies_near():
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((900, 32)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    x = vectors[rng.integers(0, 900, 400)] + 0.08 * rng.standard_normal((400, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, members = Clusters(vectors).near(x, 0.8)
    true = set(zip(*np.nonzero(x @ vectors.T >= 0.8)))
    found = set(zip(rows.tolist(), members.tolist()))
    assert found <= true and len(found) >= 0.9 * len(true)
    rows, members = Clusters(vectors).near(x, 0.8, probes=900)
    assert set(zip(rows.tolist(), members.tolist())) == true
    assert len(Clusters(vectors[:0]).near(x, 0.8)[0]) == 0
