from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

from itemstats.llm import sharding


def minimal_capacity(sizes, k):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, bins, run = (lo + hi) // 2, 1, 0
        for s in sizes:
            if run + s > mid:
                bins, run = bins + 1, 0
            run += s
        lo, hi = (lo, mid) if bins <= k else (mid + 1, hi)
    return lo


def check(rows, out, k):
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert set(by) <= set(range(k))
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    groups = defaultdict(set)
    sizes = defaultdict(int)
    load = defaultdict(int)
    for r in out:
        load[r["shard"]] += r["size"]
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in out:
        t = texts[r["doc_id"]][0]
        if len(texts[r["doc_id"]]) == 1:
            assert r["size"] == len((t or "").encode()) + 16
            assert r["text_crc32"] == (None if t is None else zlib.crc32(t.encode()))
            groups[t if t is not None else ("null", r["doc_id"])].add(r["shard"])
    assert all(len(v) == 1 for v in groups.values())
    for i, t in rows:
        sizes[sha256((t if t is not None else f"\0null:{i}").encode()).digest()] += len((t or "").encode()) + 16
    rest, ordered_sizes = k, [sizes[g] for g in sorted(sizes)]
    total = sum(ordered_sizes)
    for s in sorted(sizes.values(), reverse=True):
        if rest > 1 and s * rest > total:
            ordered_sizes.remove(s)
            total, rest = total - s, rest - 1
        else:
            break
    if ordered_sizes:
        opens = [load[s] for s in load if s < rest]
        assert max(opens) == minimal_capacity(ordered_sizes, rest)


def test_minimax_against_brute_force(spark, documents):
    rnd = random.Random(3)
    pool = ["w" * rnd.randrange(1, 900) + str(i) for i in range(180)]
    rows = [(i, rnd.choice(pool)) for i in range(400)] + [(500, None), (501, None), (502, ""), (503, "")]
    check(rows, sharding.shard(documents(rows), 7).collect(), 7)


def test_refinement_gives_the_same(spark, documents, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, "x" * rnd.randrange(1, 400) + str(i)) for i in range(300)]
    monkeypatch.setattr(sharding, "BLOCKS", 8)
    check(rows, sharding.shard(documents(rows), 5).collect(), 5)


def test_giant_group_leaves_the_others_balanced(spark, documents):
    rows = [(i, "same text " * 40) for i in range(200)] + [(1000 + i, f"text {i} " * 20) for i in range(200)]
    out = sharding.shard(documents(rows), 6).collect()
    check(rows, out, 6)
    assert len({r["shard"] for r in out}) == 6


def test_edges(spark, documents):
    assert sharding.shard(documents([]), 4).collect() == []
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, None)]
    out = sharding.shard(documents(rows), 4).collect()
    assert len(out) == 4 and {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}
