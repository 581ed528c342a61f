from __future__ import annotations

import random

import duckdb
import pytest
import regex

from itemstats.llm import line_dedup
from itemstats.llm.common import table


def brute(rows, least):
    """Longest run at every place that starts earlier in the corpus, on whole texts."""
    docs = sorted({(i if i is not None else -1, t or "") for i, t in rows})
    seqs = [[(k, x.strip(" \t\r")) for k, x in enumerate(t.split("\n")) if x.strip(" \t\r")] for _, t in docs]
    out = {}
    for a, sa in enumerate(seqs):
        gone = set()
        for p in range(len(sa)):
            for b, sb in enumerate(seqs[: a + 1]):
                for q in range(len(sb) if b < a else p):
                    n = 0
                    while p + n < len(sa) and q + n < len(sb) and sa[p + n][1] == sb[q + n][1]:
                        n += 1
                    if sum(max(1, len(regex.findall(r"[^\t\n\x0b\f\r \p{Z}]+", x))) for _, x in sa[p : p + n]) >= least:
                        gone |= {k for k, _ in sa[p : p + n]}
        out[docs[a]] = gone
    want = []
    for i, t in rows:
        gone = out[(i if i is not None else -1, t or "")]
        lines = (t or "").split("\n")
        text = None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
        want.append((i, text, sum(bool(x.strip(" \t\r")) for x in lines), len(gone)))
    return sorted(want, key=str)


def get(df):
    return sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in df.collect()], key=str)


@pytest.mark.parametrize("seed,least", [(1, 7), (2, 12), (3, 1)])
def test_against_brute_force(spark, documents, seed, least):
    rnd = random.Random(seed)
    pool = ["one", "two words", "three more words", "now four of them", " padded line\t", "", "  ", "Ünï code", "x " * 9 + "x", "a" + " " * 60 + "b", "tab\tby\ttab\u00a0and more", "\u00a0", "a\x0bb\x0cc"]
    rows = []
    for i in range(40):
        t = "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 14)))
        if rows and rnd.random() < 0.4:
            t = (rnd.choice(rows)[1] + "\n" + t) if rnd.random() < 0.5 else rnd.choice(rows)[1]
        rows.append((i, t))
    rows += [(100, None), (101, ""), (3, rows[3][1]), (None, rows[5][1]), (102, "same\n" * 60)]
    assert get(line_dedup.dedup(documents(rows), least)) == brute(rows, least)


def test_columns_of_any_name_are_kept(spark):
    names = ["_id", "_th", "_text", "_lines", "_deleted", "_i", "_t", "_likely", "_b", "_word", "_bits", "row", "seq", "pos", "h", "w", "first", "name", "runs"]
    rows = [(i, "same words here\n" * 20, *[f"{n}-{i}" for n in names]) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = line_dedup.dedup(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    for r in got.collect():
        assert all(r[n] == f"{n}-{r['doc_id']}" for n in names)
        assert r["n_removed"] == (19 if r["doc_id"] == 0 else 20) and r["n_lines"] == 20


def test_oracle_on_the_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    got = get(line_dedup.dedup(table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = sorted(con.execute(f"SELECT doc_id, text, n_lines, n_removed FROM ({line_dedup.ORACLE})").fetchall(), key=str)
    assert got == want and any(r[3] for r in want)


def test_edges_and_native_plan(spark, documents):
    df = documents([])
    out = line_dedup.dedup(df)
    assert out.collect() == [] and out.columns == [*df.columns, "n_lines", "n_removed"]
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
