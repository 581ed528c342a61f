from __future__ import annotations

import importlib.util
import os
import random

import numpy as np

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


pipeline = load("corpus_pipeline", f"{ROOT}/corpus_pipeline.py")
here = os.path.dirname(os.path.abspath(__file__))


def leaking(docs, items):
    """Documents with a window of 13 words equal to one of an item in all but two places."""
    import re

    split = lambda t: np.array(re.findall(r"[^\W_]+", (t or "").lower()), dtype=object)
    windows = lambda w: np.stack([w[k : len(w) - 12 + k] for k in range(13)], 1) if len(w) > 12 else np.zeros((0, 13), object)
    wanted = [v for t in items for v in windows(split(t))]
    out = set()
    for i, t in docs:
        own = windows(split(t))
        if any(((own != v).sum(1) <= 2).any() for v in wanted):
            out.add(i)
    return out


def test_every_stage_against_brute_force(spark):
    lines = load("test_line_dedup", f"{here}/test_line_dedup.py")
    ngrams = load("test_ngram_join", f"{here}/test_ngram_join.py")
    packing = load("test_packing", f"{here}/test_packing.py")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    junk = spark.createDataFrame([(10_001, "12 34 !!", None, "s", 8), (10_002, None, "en", "s", 0), (10_003, "", "en", "s", 0)], docs.schema)
    docs, before, results = docs.unionByName(junk), None, {}
    for name, stage in pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        out = stage(spark, docs, SF)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns
        rows = out.collect()
        after = sorted((r["doc_id"], r["text"]) for r in rows) if "text" in out.columns else rows
        if name == "language ID":
            assert after == sorted((i, t) for i, t in before if i < 10_000)
        elif name == "line dedup":
            want = lines.brute(before, 51)
            assert after == sorted((i, t) for i, t, n, gone in want if not gone or gone < n)
            assert all(r["n_chars"] == len(r["text"]) for r in rows if dict(before)[r["doc_id"]] != r["text"])
            assert len(after) < len(before)
        elif name == "n-gram Jaccard join":
            want = ngrams.brute(before)
            assert after == sorted((i, t) for i, t in before if want[i][1] == i)
        elif name == "benchmark decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = leaking(before, items)
            assert gone and after == sorted((i, t) for i, t in before if i not in gone)
        else:
            used = packing.check(before, rows, 2048)
            assert used <= 1.03 * sum(r["length"] for r in rows) / 2048 + 1
        docs = spark.createDataFrame(rows, out.schema)
    assert len(pipeline.STAGES) == 5


def test_run_is_the_chain_of_stages_and_empty_input(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0
    assert pipeline.run(spark, SF).count() > 0


def near_copies(rows):
    """Rows to stay by brute force: of every group of linked rows (pairs compared on whole sets) the one with
    the smallest (doc_id, text key)."""
    import regex
    import xxhash

    key = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64 if xxhash.xxh64_intdigest(t.encode(), 42) >> 63 else 0)
    sets = []
    for _, t in rows:
        w = regex.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for k, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[k] = min(group[i], group[k])
    stay = {}
    for i, (d, t) in enumerate(rows):
        own = (d is None, d or 0, key(t or ""), t or "")
        if not sets[i]:
            stay[("none", i)] = (d, t)
        elif group[i] not in stay or own < stay[group[i]][0]:
            stay[group[i]] = (own, (d, t))
    return sorted((v if k[0] == "none" else v[1] for k, v in ((k if isinstance(k, tuple) else (k,), v) for k, v in stay.items())), key=str)


def test_near_duplicates_with_repeated_and_null_ids(spark, documents):
    rnd = random.Random(4)
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(80))
    rows = [(5, text(1)), (5, text(2)), (3, text(2)), (5, text(3)), (6, text(3)), (6, text(4))]  # unique texts under shared ids
    for _ in range(90):
        t = text(rnd.randrange(5, 20)) + " more" * rnd.randrange(3)
        rows.append((rnd.choice([None, *range(20)]), t))
    rows += [(None, text(30)), (None, text(30)), (None, text(31)), (7, text(32)), (7, text(32)), (7, text(32)), (1, None), (1, None), (None, ""), (2, " ")]
    got = pipeline.near_duplicates(spark, documents(rows), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == near_copies(rows)


def test_near_duplicates_keep_columns_of_any_name(spark):
    names = ["_id", "_likely", "_b", "row", "id", "of", "stays", "n", "component", "text_key"]
    rows = [(i, f"a b c d e f {i // 2}" + " x" * 30, *[f"{n}-{i}" for n in names]) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = pipeline.near_duplicates(spark, df, SF)
    assert got.columns == df.columns and all(r[n] == f"{n}-{r['doc_id']}" for r in got.collect() for n in names)


def test_common_short_items_leave_clean_documents(spark, documents, tmp_path):
    long = " ".join(f"word{k}" for k in range(16))
    items = [(1, "Yes"), (2, "What is it"), (3, "Which of these is it"), (4, long)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "yes it is"), (2, "so what is it"), (3, "which of those is it now"), (4, f"and {long}"), (5, "no")]
    assert sorted(r["doc_id"] for r in pipeline.decontaminated(spark, documents(rows), str(tmp_path)).collect()) == [1, 2, 3, 5]


def test_mixed_languages_and_no_labelled_row(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {}
    for r in docs.orderBy("doc_id").collect():
        if r["lang"] and len(r["text"] or "") > 1500:
            texts.setdefault(r["lang"], r["text"])
    a, b, c = sorted(texts)[:3]
    mixed = " ".join([texts[a][:1200], texts[b][:900], texts[c][:900]])
    extra = spark.createDataFrame([(10_001, mixed, None, "s", len(mixed)), (10_002, "1 2", None, "s", 3)], docs.schema)
    kept = lambda df: {r["doc_id"] for r in pipeline.language(spark, df, SF).select("doc_id").collect()}
    assert {10_001, 10_002} & kept(docs.unionByName(extra)) == {10_001}
    assert kept(extra) == {10_001}  # nothing to learn from
    monkeypatch.setattr(pipeline, "WANTED", (a, b))
    assert 10_001 in kept(docs.unionByName(extra))
    monkeypatch.setattr(pipeline, "WANTED", (c,))
    assert 10_001 not in kept(docs.unionByName(extra))


def test_documents_in_languages_of_no_labelled_row_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    greek = "η γλώσσα αυτή δεν υπάρχει στις γραμμές που έχουν ετικέτα και το έγγραφο πρέπει να φύγει " * 5
    known = next(r["text"] for r in docs.orderBy("doc_id").collect() if r["lang"] == "en" and len(r["text"] or "") > 1500)
    rows = [(10_001, greek), (10_002, known[:900] + greek[:300]), (10_003, known[:150] + greek), (10_004, greek.upper())]
    extra = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in rows], docs.schema)
    kept = {r["doc_id"] for r in pipeline.language(spark, docs.unionByName(extra), SF).select("doc_id").collect()}
    assert {i for i, _ in rows} & kept == {10_002} and len(kept) == docs.count() + 1


def test_packed_sequences_hold_their_ids(spark, documents):
    packing = load("test_packing", f"{here}/test_packing.py")
    rows = [(1, "some words " * 3000), (2, None), (3, "a few more"), (4, "naïve text\n" * 900)]
    got = {}
    for r in sorted(pipeline.packed(spark, documents(rows), SF).collect(), key=lambda r: (r["doc_id"], r["piece"])):
        assert len(r["ids"]) == r["length"]
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    assert got == {i: packing.reference(t) for i, t in rows}
