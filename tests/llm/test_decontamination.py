from __future__ import annotations

import random
import re

from itemstats.llm import decontamination as d


def brute(docs, items):
    """Every window of every item against every window of every document."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for i, t in docs:
        w = split(t)
        for k, u in items:
            v = split(u)
            width = min(13, len(v))
            allowed = 2 if width >= 13 else 0 if width < 5 else min(2, width // 5)
            for p in range(len(v) - width + 1 if width else 0):
                for q in range(len(w) - width + 1):
                    if sum(a != b for a, b in zip(v[p : p + width], w[q : q + width])) <= allowed:
                        out.add((i, k))
    return out


def corpus(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(60)] + ["Été", "naïve", "x_y"]
    say = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(n))) for k, n in enumerate([13, 14, 20, 30, 40, 12, 9, 6, 4, 2, 1])] + [(50, None), (51, ""), (52, "!!"), (0, "same id other text here and now")]
    docs = []
    for i in range(120):
        w = say(rnd.randrange(40))
        if rnd.random() < 0.7:
            own = rnd.choice(items[:9])[1].split(" ")
            for _ in range(rnd.randrange(5)):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                own = own[rnd.randrange(4) :]
            w += [x.upper() + "," for x in own] + say(10)
        docs.append((i, " ".join(w)))
    return docs + [(900, None), (901, ""), (902, "?"), (903, "word1 " * 50_000)], items


def run(spark, documents, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS item")
    return documents(docs), bench


def test_against_brute_force(spark, documents, monkeypatch):
    docs, items = corpus()
    small = docs[:-1]
    a, b = run(spark, documents, small, items)
    want = brute(small, items)
    assert {(r["doc_id"], r["item_id"]) for r in d.leaks(a, b).collect()} == want
    clean = {r["doc_id"] for r in d.clean(a, b).collect()}
    assert clean == {i for i, _ in small} - {i for i, _ in want}
    monkeypatch.setattr(d, "SEED_LIMIT", 400)  # blocks of items
    assert {(r["doc_id"], r["item_id"]) for r in d.leaks(a, b).collect()} == want
    assert {r["doc_id"] for r in d.clean(a, b).collect()} == clean


def test_masks_leave_one_untouched():
    for width in range(5, 14):
        keeps = [set(m) for m in d.masks(width)]
        c = d.changeable(width)
        for a in range(width):
            for b in range(width if c == 2 else 1):
                assert any(not {a, b if c == 2 else a} & k for k in keeps), width


def test_edges(spark, documents):
    docs, items = corpus()
    a, b = run(spark, documents, docs[-4:] + [(903, "x"), (None, items[0][1])], items[:9])
    assert {r["doc_id"] for r in d.leaks(a, b).collect()} == {None}
    assert d.clean(a, b).count() == 5
    assert d.leaks(a.limit(0), b).collect() == [] and d.leaks(a, b.limit(0)).collect() == []
    assert d.clean(a, b.limit(0)).count() == 6 and d.clean(a, b).columns == a.columns


def test_short_overlaps_are_flagged_and_removed_by_least_only(spark, documents):
    eight, nine, ten = "p q r s t u v w", "a1 a2 a3 a4 a5 a6 a7 a8 a9", "b1 b2 b3 b4 b5 b6 b7 b8 b9 b10"
    items = [(1, "Yes"), (2, "What is it"), (3, eight), (4, nine), (5, ten), (6, " ".join(f"c{k}" for k in range(13)))]
    docs = [(1, "oh yes, what is it then"), (2, f"so {eight} on"), (3, f"so {eight.replace('s', 'x')} on"), (4, nine.replace("a4", "x")), (5, ten.replace("b4", "x").replace("b7", "x")), (6, "nothing")]
    docs += [(7, items[5][1].replace("c3", "x").replace("c8", "x"))]
    a, b = run(spark, documents, docs, items)
    got = {(r["doc_id"], r["item_id"]): (r["fewest_changed"], r["short"]) for r in d.leaks(a, b).collect()}
    assert got == {(1, 1): (0, True), (1, 2): (0, True), (2, 3): (0, False), (3, 3): (1, True), (4, 4): (1, False), (5, 5): (2, False), (7, 6): (2, False)}
    assert sorted(r["doc_id"] for r in d.clean(a, b, least=d.MIN_EQUAL).collect()) == [1, 3, 6]
    assert sorted(r["doc_id"] for r in d.clean(a, b).collect()) == [6]
