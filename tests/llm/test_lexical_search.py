from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from itemstats.llm import common, lexical_search, terms
from itemstats.llm.lexical_search import Tree, Vocabulary
from tests.llm.test_terms import lower


def words_of(text):
    return [lower(t) for t in re.findall(terms.pattern(True), text or "")]


def brute(docs, items, k=10):
    own = [(i, Counter(words_of(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in own]
    documents, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in own for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words_of(t))
    out = []
    for item, query in wanted.items():
        found = []
        for (i, c), n in zip(own, lengths):
            score = 0
            for t in query & c.keys():
                m = 100 - 90 + (90 * n * documents) // total
                score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def corpus(seed, n=600):
    rnd = random.Random(seed)
    words = [*(f"w{i}" for i in range(60)), "The", "the", "été", "日本語日本語日本語", "x" * 9, "x" * 16, "x" * 17, "y" * 200, "a_b", "42"]
    line = lambda most: " ".join(words[min(len(words) - 1, int(rnd.expovariate(0.08)))] for _ in range(rnd.randrange(most)))
    docs = [(i, None if rnd.random() < 0.03 else line(60)) for i in range(n)]
    docs += [(7, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), *docs[:30], (5000, "the w9 " * 30000), (5001, ""), (5002, "x" * 100_000)]
    docs += [(9000 + i, "w30 w31 same") for i in range(40)]  # more ties than places
    items = [(i, line(25)) for i in range(25)] + [(100, "w30 same"), (101, None), (102, ""), (103, "unheard"), (None, "w5"), (100, "w31"), (3, "w50"), (104, "x" * 100_000)]
    return docs, items


@pytest.fixture
def frames(spark):
    def make(docs, items):
        d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
        i = spark.createDataFrame(items, "item_id long, text string")
        for name in ("n", "m", "dims", "tf", "term", "rank", "score", "block"):
            d, i = d.selectExpr("*", f"1 AS `{name}`"), i.selectExpr("*", f"1 AS `{name}`")
        return d, i

    return make


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(frames):
    docs, items = corpus(1)
    got = lexical_search.search(*frames(docs, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and rows(got) == brute(docs, items)


def test_items_in_blocks(frames, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    docs, items = corpus(2, 100)
    assert rows(lexical_search.search(*frames(docs, items), k=3)) == brute(docs, items, 3)


def random_tree(seed, n, leaf, monkeypatch, scale=10**10):
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    rnd = np.random.default_rng(seed)
    size = rnd.integers(1, 12, n)
    topic = rnd.integers(0, 4, n)
    dims = [np.sort(rnd.choice(np.arange(20 * t, 20 * t + 30), s, replace=False)) for s, t in zip(size, topic)]
    y = rnd.integers(0, scale, size.sum())
    return Tree(np.concatenate([[0], np.cumsum(size)]), np.concatenate(dims).astype(np.int32), y), dims, np.split(y, np.cumsum(size)[:-1])


@pytest.mark.parametrize("leaf", [1, 7, 64])
def test_tree_equals_all_scores_and_bounds_hold(leaf, monkeypatch):
    tree, dims, y = random_tree(leaf, 500, leaf, monkeypatch)
    rnd = np.random.default_rng(5)
    for _ in range(30):
        query = np.sort(rnd.choice(95, rnd.integers(1, 12), replace=False)).astype(np.int32)
        scores = [int(v[np.isin(d, query)].sum()) for d, v in zip(dims, y)]
        best = []
        tree.search(query, 10, best, list(range(500)))
        want = sorted(((s, -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
        # every node's bound is above all scores below it
        under = {}
        for at, node in enumerate(tree.nodes):
            children, below = node[4], node[5]
            under[at] = list(below[0]) if below else under[children[0]] + under[children[1]]
            assert tree.bound(at, query, math.sqrt(len(query))) >= max(scores[i] for i in under[at])


def test_tree_leaves_out_subtrees(monkeypatch):
    tree, _, _ = random_tree(1, 2000, 16, monkeypatch)
    seen = tree.search(np.array([0, 1, 2, 3], np.int32), 5, [], list(range(2000)))
    assert seen < sum(n[5] is not None for n in tree.nodes) / 2


def test_equal_vectors(monkeypatch):
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    tree = Tree(np.arange(0, 303, 3), np.tile(np.array([1, 5, 9], np.int32), 100), np.tile(np.array([3, 2, 10**10]), 100))
    best = []
    tree.search(np.array([5, 9], np.int32), 10, best, [None, *range(99, 0, -1)])
    assert sorted(best, reverse=True) == [(10**10 + 2, -i) for i in range(1, 11)]


def test_vocabulary_finds_every_known_term():
    known = ["a", "abcdefgh", "abcdefghi", "x" * 16, "x" * 17, "é" * 40, "zz9"]
    found = terms.split(pa.array(["a b abcdefgh abcdefghi abcdefghj", None, "x" * 16 + " " + "x" * 17 + " " + "x" * 18, "É" * 40 + " " + "é" * 40 + " ZZ9"]), lexical_search.CHARACTERS)
    at, number = Vocabulary([k.encode() for k in known]).numbers(found)
    got = sorted((int(found.row[i]), known[k]) for i, k in zip(at, number))
    assert got == [(0, "a"), (0, "abcdefgh"), (0, "abcdefghi"), (2, "x" * 16), (2, "x" * 17), (3, "zz9"), (3, "é" * 40)]
    assert [len(x) for x in Vocabulary([]).numbers(found)] == [0, 0]


def test_empty_tables(frames):
    docs, items = corpus(3, 20)
    for d, i in (([], items), (docs, []), ([(1, None)], items), ([], [])):
        assert lexical_search.search(*frames(d, i)).collect() == []


def test_both_passes_take_batches_bounded_by_bytes(spark, monkeypatch):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(limit, None)
    rare = F.when(F.col("id") % 1000 == 0, "rare").otherwise("")
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), 2000), rare).alias("text"))
    items = spark.createDataFrame([(1, "rare")], "item_id long, text string")
    plain, seen = type(docs).mapInArrow, []

    def watched(self, run, schema):
        def bounded(batches):
            def each():
                for b in batches:
                    assert b.nbytes < 2 * common.BATCH_BYTES
                    yield b

            return run(each())

        seen.append(schema)
        return plain(self, bounded, schema)

    monkeypatch.setattr(type(docs), "mapInArrow", watched)
    try:
        spark.conf.unset(limit)
        got = rows(lexical_search.search(docs, items, k=3))
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    assert seen == [lexical_search.VECTORS, lexical_search.FOUND]
    assert [r[:3] for r in got] == [(1, 1, 0), (1, 2, 1000), (1, 3, 2000)]


def test_items_of_one_block_are_not_written(frames, monkeypatch):
    plain, written = common.Scratch.write, []

    def write(self, df, *partition_by):
        written.append(df.columns)
        return plain(self, df, *partition_by)

    monkeypatch.setattr(common.Scratch, "write", write)
    docs, items = corpus(4, 100)
    assert rows(lexical_search.search(*frames(docs, items))) == brute(docs, items)
    assert written == [["doc_id", "n", "dims", "tf"], ["item_id", "doc_id", "score"]]


def test_tree_holds_one_level_at_a_time():
    rnd = np.random.default_rng(6)
    docs, size = 4096, 64
    dims = np.concatenate([np.sort(rnd.choice(3000, size, replace=False)) for _ in range(docs)]).astype(np.int32)
    y = rnd.integers(1, 10**9, docs * size)
    tracemalloc.start()
    try:
        Tree(np.arange(0, docs * size + 1, size), dims, y)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 75 * docs * size
