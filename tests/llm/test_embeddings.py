from __future__ import annotations

import numpy as np
import pytest

from itemstats.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, n int, id int, cell int"


def brute(rows):
    ok = [(i, np.array(v, dtype=np.float32).astype(float), la) for i, v, la in rows
          if la is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {k: set() for k in range(len(ok))}, list(range(len(ok)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for p in range(len(ok)):
        for q in range(p):
            a, b = ok[p], ok[q]
            if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.98:
                links[p].add(q)
                links[q].add(p)
                parent[max(root(p), root(q))] = min(root(p), root(q))
    low = {}
    for k in range(len(ok)):
        low[root(k)] = min(low.get(root(k), ok[k][0]), ok[k][0])
    good = {ok[k][0]: (len(links[k]), low[root(k)]) for k in range(len(ok))}
    return {i: good.get(i, (0, i)) for i, _, _ in rows}


@pytest.mark.parametrize("block,cell,held", [(2000, 1000, 10**6), (7, 5, 10**6), (7, 5, 0)])
def test_against_brute_force(spark, monkeypatch, block, cell, held):
    monkeypatch.setattr(embeddings, "CENTRE_NUMBERS", held)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "CELL", cell)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    rows = []
    for i in range(160):
        v = base[i % 12] + rng.normal(size=8) * rng.choice([0.0, 0.1, 0.25, 1.0])
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 3))))
    same = [1.0] + [0.0] * 7
    rows += [(200 + i, same, 1) for i in range(40)]
    rows += [(300, None, 1), (301, same, None), (302, [0.0] * 8, 1), (303, [float("nan")] + [1.0] * 7, 1), (304, [None] + [1.0] * 7, 1), (305, [], 1),
             (306, [float("inf")] + [1.0] * 7, 1), (307, [-0.0 if x == 0 else x for x in same], 1), (308, [2.0] + [0.0] * 7, 1), (309, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], SCHEMA)
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    want = brute(rows)
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(5, [1.0, 2.0], 1, 1, 1, 1)] * 3, SCHEMA)
    assert [(r["vec_id"], r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df).collect()] == [(5, 2, 5)] * 3
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("numbers", [16_000_000, 100])
def test_slices_of_large_labels_against_brute_force(spark, monkeypatch, numbers):
    monkeypatch.setattr(embeddings, "BLOCK", 6)
    monkeypatch.setattr(embeddings, "SLICE", 4)
    monkeypatch.setattr(embeddings, "CELL", 5)
    monkeypatch.setattr(embeddings, "NUMBERS", numbers)
    monkeypatch.setattr(embeddings, "STRIP", (16, 4))
    rng = np.random.default_rng(8)
    base = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in base[i % 5] + rng.normal(size=8) * rng.choice([0.0, 0.08, 0.12])], int(i % 9 == 0)) for i in range(90)]
    rows += [(100 + i, [1.0 + i, 2.0], 0) for i in range(3)]
    df = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_vectors_are_stored_once(spark, monkeypatch, tmp_path):
    """However many cells a vector is compared with, it is written once, and not by a shuffle per cell."""
    monkeypatch.setattr(embeddings, "BLOCK", 10)
    monkeypatch.setattr(embeddings, "CELL", 10)
    made = []
    write = embeddings.common.Scratch.write
    monkeypatch.setattr(embeddings.common.Scratch, "write", lambda self, df, *a, **b: made.append(write(self, df, *a, **b)) or made[-1])
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)], 1, 1, 1, 1) for i in range(200)], SCHEMA)
    assert embeddings.near_duplicates(df).count() == 200
    assert sum(t.count() for t in made if "embedding" in t.columns) == 200
