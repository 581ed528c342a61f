from __future__ import annotations

import random
import re

import numpy as np
import pytest

from itemstats.llm import ngram_join


def brute(rows):
    """Every pair of distinct texts compared on its whole shingle sets."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: (len(sets[i]), low[root(i)]) for i, (d, _) in enumerate(rows)}


def corpus(seed, n=160):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["Été", "ÉTÉ", "A\u00a0b"]
    line = " ".join(rnd.choice(vocabulary) for _ in range(12))
    rows, texts = [], []
    for i in range(n):
        if texts and rnd.random() < 0.6:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.randrange(0, 1 + len(w) // 20 + 2)):
                k = rnd.randrange(len(w))
                w[k : k + rnd.randrange(2)] = [rnd.choice(vocabulary)]
            t = " ".join(w)
        else:
            t = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 150)))
            t = line + "\n" + t if rnd.random() < 0.5 else t
        if rnd.random() < 0.1:
            t = t.upper() + "\t"
        texts.append(t)
        rows.append((i, t))
    return rows + [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "ONE  two"), (905, "word " * 30_000), (906, "word " * 20_000), (907, "x" * 50_000)]


@pytest.mark.parametrize("seed,star,block,frequent", [(1, 32, 1000, 200_000), (2, 2, 7, 3), (3, 4, 1000, 0)])
def test_against_brute_force(spark, documents, monkeypatch, seed, star, block, frequent):
    monkeypatch.setattr(ngram_join, "STAR", star)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = corpus(seed)
    rows += [(1000 + i, rows[5][1]) for i in range(30)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(rows)).collect()}
    assert got == brute(rows)


def test_tree_finds_all_links():
    rnd = random.Random(9)
    for _ in range(30):
        base = [np.unique(np.array([rnd.randrange(60) for _ in range(rnd.randrange(1, 40))], np.uint64)) for _ in range(4)]
        sets = []
        for _ in range(25):
            s = set(rnd.choice(base).tolist()) ^ {rnd.randrange(60) for _ in range(rnd.randrange(3))}
            sets.append(np.array(sorted(s or {1}), np.uint64))
        ids = np.arange(25)
        e = ngram_join.tree_links(ids, sets)
        half = np.array([i % 2 == 0 for i in range(25)])
        e2 = ngram_join.tree_links(ids[half], [s for s, h in zip(sets, half) if h]) + ngram_join.tree_links(ids[~half], [s for s, h in zip(sets, half) if not h])
        e2 += ngram_join.tree_links(ids, sets, half)

        def closure(edges):
            comp = list(range(25))
            for _ in range(25):
                for a, b in edges:
                    comp[a] = comp[b] = min(comp[a], comp[b])
            return comp

        want = []
        for i in range(25):
            for j in range(i):
                o = len(set(sets[i].tolist()) & set(sets[j].tolist()))
                if 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
                    want.append((i, j))
        assert closure(e) == closure(e2) == closure(want)


def test_edges(spark, documents):
    assert ngram_join.join(documents([])).collect() == []
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None), (3, "")]
    got = sorted(((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(rows)).collect()), key=str)
    assert got == sorted([(7, 2, 7), (7, 2, 7), (0, 2, 7), (0, 0, None), (3, 0, 3)], key=str)


def test_rows_are_documents_whatever_their_ids(spark, documents):
    one = " ".join(f"a{k}" for k in range(60))
    near, other, far = one + " more", " ".join(f"b{k}" for k in range(60)), " ".join(f"c{k}" for k in range(60))
    rows = [(5, one), (5, other), (3, other), (5, one), (None, near), (None, near), (None, far), (None, far + " x"), (None, far + " x"), (9, far + " y"), (4, None)]
    rows += [(None, "no other " * 9)]
    got = ngram_join.join(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault((r["component"], r["component_id"]), []).append(r["doc_id"])
    groups = sorted((c[1], sorted(v, key=str)) for c, v in by.items() if c[0] is not None and c[1] is not None)
    assert groups == [(3, [3, 5]), (5, [5, 5, None, None]), (9, [9, None, None, None])]
    assert sorted((c is None, i, v) for (c, i), v in by.items() if c is None or i is None) == [(False, None, [None]), (True, 4, [4])]


def test_shared_shingles_are_counted_over_batches(spark):
    option = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(option, None)
    texts = [f"one two three four five {w}" for w in ("a", "b", "c", "c", "d")] + [None, "alone"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, text_key long").coalesce(1)
    try:
        spark.conf.set(option, "1")  # every batch holds one text
        rows = ngram_join._digests(docs).collect()
    finally:
        spark.conf.unset(option) if before is None else spark.conf.set(option, before)
    assert sorted(r["doc_id"] for r in rows if r["n"] is not None) == list(range(7))
    common_one = np.intersect1d(*map(ngram_join.shingles, texts[:2])).view(np.int64).tolist()
    assert [(r["token"], r["times"]) for r in rows if r["token"] is not None] == [(common_one[0], 4)]


def test_a_common_passage_makes_no_group(spark, monkeypatch):
    """Long documents that share one passage, more of them than STAR, are no candidates of each other; near copies are."""
    monkeypatch.setattr(ngram_join, "STAR", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT", 0)
    rnd = random.Random(5)
    passage = " ".join(f"common{k}" for k in range(30))
    texts = [passage + " " + " ".join(f"w{i}x{k}" for k in range(rnd.randrange(700, 900))) for i in range(20)]
    texts += [t + " end" for t in texts[:2]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    grades = np.zeros(ngram_join.WORD_BUCKETS, np.int64)
    postings = ngram_join._postings(docs, np.zeros(0, [("token", np.uint64), ("place", np.int64)]), grades)
    scratch = ngram_join.common.Scratch(spark, "test")
    edges = {frozenset(e) for e in ngram_join._candidates(scratch, postings).collect()}
    assert len(edges) == 2 and len(set().union(*edges)) == 4


def test_what_tasks_get_grows_with_a_group_of_near_copies(spark):
    """Sets sent to the tasks of a group: thrice its size where one component holds nearly all, not its square."""
    blocks = 40
    rows = [(1, i, i, i, i % blocks, blocks, 7 if i % 400 else i) for i in range(4000)]
    large = spark.createDataFrame(rows, "component long, one long, row long, text_key long, block int, blocks int, linked long")
    assert ngram_join._first_tasks(large).count() <= 3 * len(rows)
    assert ngram_join._other_tasks(large).count() <= 2 * len(rows)
    assert ngram_join._other_tasks(large.withColumn("linked", large["component"])).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_large_groups_of_blocks_against_brute_force(spark, documents, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "STAR", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(90):  # a chain of drifting copies: links, but not between all
        if i % 3 == 0:
            base[rnd.randrange(40)] = f"v{i}"
        own = list(base)
        own[rnd.randrange(40)] = f"u{rnd.randrange(4)}"
        rows.append((i, " ".join(own[: rnd.randrange(34, 41)])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(rows)).collect()}
    assert got == brute(rows)
