from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from itemstats.llm import divergence, terms
from tests.llm.test_terms import lower


def brute(rows):
    """rows: (text, lang, source) -> the audit, term by term over every kept term."""
    occ, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        own = [lower(t) for t in re.findall(terms.pattern(False), text or "")]
        occ[lang, source].update(own)
        df[lang].update(set(own))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in df[lang].items() if n >= divergence.MIN_DOCS]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + divergence.UNIT * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(occ[lang, s]) for s in sources}
        q = shares(sum((occ[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum((p[s][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h) for h in sources if h != s]
            own = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if occ[lang, s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", own, divergence.TOP)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:top]
                out += [(lang, s, part, t, v, k + 1) for k, (v, t) in enumerate(ranked)]
    return sorted(out)


def corpus(seed, n=250, sources=7):
    rnd = random.Random(seed)
    words = ["a", "The", "the", "été", "x" * 20, "y" * 100, "日本語日本語", "mid-dle", "abcdefgh", "abcdefghi", "n0", *[f"w{chr(97 + i)}" for i in range(26)]]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice([None, *[f"s{i}" for i in range(sources)]])
        rows.append((None if rnd.random() < 0.05 else " ".join(rnd.choice(words) for _ in range(rnd.randrange(30))), lang, source))
    rows += rows[:20]  # repeated rows are documents each
    rows += [("one two", "xx", "alone"), ("", "xx", "none"), (None, "yy", None), ("the " * 20000, "en", "s1")]
    return rows


@pytest.fixture
def frame(spark):
    def make(rows):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
        for name in ("term", "n", "df", "p", "q", "block", "value", "rank", "item"):
            df = df.selectExpr("*", f"1 AS `{name}`")
        return df.repartition(5)

    return make


def test_against_brute_force(frame):
    rows = corpus(1)
    assert sorted(tuple(r) for r in divergence.audit(frame(rows)).collect()) == brute(rows)


def test_many_blocks_and_deals(frame, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "ROWS", 8)
    rows = corpus(2, sources=12)
    assert sorted(tuple(r) for r in divergence.audit(frame(rows)).collect()) == brute(rows)


def test_a_source_without_any_kept_term(frame):
    rows = [("one two", "en", "a"), (None, "en", "b"), ("", None, None)]
    got = sorted(tuple(r) for r in divergence.audit(frame(rows)).collect())
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)] == brute(rows)


def test_counter_gives_up_its_runs(monkeypatch):
    monkeypatch.setattr(divergence, "RUNS", 30)
    monkeypatch.setattr(terms, "SLICE_BYTES", 40)
    rows = corpus(3, 120)
    columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
    whole = pa.RecordBatch.from_arrays(columns, names=["text", "lang", "source"])
    got, n_batches = defaultdict(lambda: [0, 0]), 0
    for b in divergence._count(iter([whole[:50], whole[50:]])):
        n_batches += 1
        for r in b.to_pylist():
            if r["term"] is not None:
                got[r["lang"], r["source"], r["term"].decode()][0] += r["n"]
                got[r["lang"], r["source"], r["term"].decode()][1] += r["df"]
    want = defaultdict(lambda: [0, 0])
    for text, lang, source in rows:
        own = Counter(lower(t) for t in re.findall(terms.pattern(False), text or ""))
        for t, n in own.items():
            want[lang or "", source or "", t][0] += n
            want[lang or "", source or "", t][1] += 1
    assert got == want and n_batches > 10


def test_shares_beyond_64_bits(spark):
    n, total = 123_456_789_012_345, 987_654_321_098_765
    got = spark.range(1).select(divergence._share(divergence.F.lit(n), divergence.F.lit(total))).first()[0]
    assert got == 1 + divergence.UNIT * (n + 1) // total


def test_empty_table(frame):
    assert divergence.audit(frame([])).collect() == []
