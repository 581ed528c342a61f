from __future__ import annotations

import random
import zlib

import numpy as np

from itemstats.llm import language_id
from itemstats.llm.common import table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in held} == {i for i, r in got.items() if r["held_out"]}
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) / len(held)
    assert right > 0.97, right


def brute_mixture(text, model, k):
    """Penalised likelihood over all language sets by direct expectation-maximisation."""
    from itertools import combinations

    found, n = language_id.counts(text)
    best = None
    for size in range(1, k + 1):
        for own in combinations(range(k), size):
            p, pi = np.exp(model[found][:, own]), np.full(size, 1 / size)
            for _ in range(200):
                r = p * pi
                pi = (r / r.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
            value = (n * np.log((p * pi).sum(1))).sum() - size * language_id.PENALTY * np.log1p(n.sum())
            if best is None or value > best[0]:
                best = value, own
    return set(best[1])


def test_language_sets_against_all_subsets(spark):
    rnd = random.Random(2)
    words = {"a": ["kati", "kota", "kiko", "tako"], "b": ["zuru", "zoro", "ruzu"], "c": ["wewi", "wiwe", "hewi"]}
    say = lambda la, n: " ".join(rnd.choice(words[la]) for _ in range(n))
    rows = [(i, say(la, 30), la) for i, la in enumerate("abc" * 20)]
    tests = [(100, say("a", 40) + ". " + say("b", 40), None), (101, say("c", 60), None), (102, say("a", 30) + say("b", 30) + say("c", 30), None)]
    df = spark.createDataFrame(rows + tests, "doc_id long, text string, lang string")
    langs, model = language_id.train(df, "text", "lang", df["doc_id"] < 100, df["doc_id"])
    got = {r["doc_id"]: r["languages"] for r in language_id.predict(df, langs, model, keep=[df["doc_id"]]).collect()}
    for i, t, _ in tests:
        assert {x.split(":")[0] for x in got[i].split(",")} == {langs[j] for j in brute_mixture(t, model, 3)}


def test_edges(spark, documents):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the thing"), (4, "the thing"), (None, "word"), (5, "ab " * 600_000)]
    got = language_id.identify(documents(rows)).collect()
    pred = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert len(got) == len(rows)
    assert pred[1] == pred[2] == pred[3] == ("und", 0.0) and pred[4][0] == pred[5][0] == "en"
    assert language_id.identify(documents([])).collect() == []
    assert {r["lang_pred"] for r in language_id.identify(documents(rows, lang=None)).collect()} == {"und"}


def test_slices_give_the_same_counts(monkeypatch):
    text = "one two three " * 50
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "SLICE", 64)
    sliced = language_id.counts(text)
    assert (whole[0] == sliced[0]).all() and (whole[1] == sliced[1]).all()
