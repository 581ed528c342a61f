"""Source divergence audit (operator 12): how the terms of each source differ from those of the other
sources of its language, and from the language as a whole.

Counting is length-bucketed packing (:mod:`itemstats.llm.terms`): terms of up to 16 bytes become one or two
uint64 words that are radix-sorted together with the code of their (lang, source) and run-counted in
numpy; longer terms are byte-sorted in buckets of their own.  A task keeps its runs merged and gives
them up when they reach ``RUNS``, so its memory does not follow its input.

A language keeps the ``V`` terms that at least ``MIN_DOCS`` of its documents hold.  With ``N`` a group's
occurrences of kept terms, ``p = 1 + floor(UNIT * (count + 1) / (N + V))`` and the divergence of p from
q is ``floor((p - q)^2 / q)``; all of it in whole numbers.  Part ``pair`` sums it over all kept terms for every
two sources of a language, part ``term`` lists a source's terms that are above the language's p.

The pair sums are taken without the terms that neither source has: with p0 a group's value at count 0,

    sum over all V of F(p, q) = V F(p0, q0) + sum over g's terms of [F(p, q0) - F(p0, q0)]
        + sum over h's terms of [F(p0, q) - F(p0, q0)]
        + sum over their common terms of [F(p, q) - F(p, q0) - F(p0, q) + F(p0, q0)],

so the work is one step per two sources that share a term, done in numpy and summed there; a task
holds at most two blocks of ``BLOCK`` sources and about ``ROWS`` counts (terms dealt by hash), and one sum a
pair leaves it.

Defined cases: null text, lang and source are the empty string; every row is a document, also a repeated
one; a group without terms is listed; with V = 0 the values are 0; equal values rank by item (bytes);
a very long text is counted whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemstats.functions import sizing
from itemstats.llm import terms
from itemstats.llm.common import Scratch

#: Fixed values of the audit: documents that must hold a term, unit of the shares, ranks of part ``term``.
MIN_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
#: Runs that a task holds before it gives them up.
RUNS = 1 << 20
#: Sources in a block, and counts in a task of the pair sums.
BLOCK = 512
ROWS = 200_000
COUNTS = "lang string, source string, term binary, n long, df long"
PAIRS = "lang string, source string, item string, value long"


class Counter:
    """Run-counted terms of a task: per bucket, columns (group, words) with occurrences and documents."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.held: dict[int, list[tuple[list[np.ndarray], np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def code(self, langs: list, sources: list) -> np.ndarray:
        own = self.groups
        keys = ((a or "", b or "") for a, b in zip(langs, sources))
        return np.fromiter((own.setdefault(k, len(own)) for k in keys), np.uint32, len(langs))

    def add(self, texts: pa.Array, group: np.ndarray) -> None:
        found = terms.split(texts, LETTERS)
        for width, at, words in found.buckets():
            columns = [group[found.row[at]], *words]
            order = terms.order_of(columns)
            columns, row = [c[order] for c in columns], found.row[at][order]
            first = terms.runs(columns)
            # rows ascend within a run: a document is counted where its row is new
            new = np.ones(len(row), bool)
            new[1:] = row[1:] != row[:-1]
            new[first] = True
            n = np.diff(np.append(first, len(row)))
            self.held.setdefault(width, []).append(([c[first] for c in columns], n, np.add.reduceat(new, first, dtype=np.int64)))
            self.size += len(first)

    def full(self) -> bool:
        """Whether the runs are to be given up: even merged they are many."""
        if self.size > RUNS:
            self.merge()
        return self.size > RUNS // 2

    def merge(self) -> None:
        self.size = 0
        for width, parts in self.held.items():
            columns = [np.concatenate(c) for c in zip(*[p[0] for p in parts])]
            order = terms.order_of(columns)
            columns = [c[order] for c in columns]
            first = terms.runs(columns)
            n, df = (np.add.reduceat(np.concatenate([p[k] for p in parts])[order], first) for k in (1, 2))
            self.held[width] = [([c[first] for c in columns], n, df)]
            self.size += len(first)

    def take(self) -> Iterator[pa.RecordBatch]:
        """All runs; the counter holds none afterwards."""
        self.merge()
        held, self.held, self.size = self.held, {}, 0
        langs, sources = self.names()
        for [(columns, n, df)] in held.values():
            for a in range(0, len(n), 1 << 17):
                part = [c[a : a + (1 << 17)] for c in columns]
                code = pa.array(part[0].astype(np.int64))
                values = [langs.take(code), sources.take(code), terms.as_binary(part[1:])]
                yield batch([*values, pa.array(n[a : a + (1 << 17)]), pa.array(df[a : a + (1 << 17)])])

    def names(self) -> tuple[pa.Array, pa.Array]:
        return tuple(pa.array([k[i] for k in self.groups], pa.string()) for i in (0, 1))

    def groups_seen(self) -> pa.RecordBatch:
        """A row with a null term per group."""
        langs, sources = self.names()
        zero = pa.array([0] * len(langs), pa.int64())
        return batch([langs, sources, pa.nulls(len(langs), pa.binary()), zero, zero])


def batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in COUNTS.split(", ")])


LETTERS = terms.alphabet(digits=False)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = Counter()
    for b in batches:
        group = own.code(b.column(1).to_pylist(), b.column(2).to_pylist())
        for start, end in terms.slices(b.column(0)):
            own.add(b.column(0)[start:end], group[start:end])
            if own.full():
                yield from own.take()
    yield from own.take()
    yield own.groups_seen()


def counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, df``: occurrences of every term and documents that hold it; one row with a
    null term per group."""
    own = docs.select(*[F.col(c).cast("string").alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))])
    found = own.mapInArrow(_count, COUNTS)
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / total), exact beyond 64 bits; null where the total is 0."""
    part = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), total.cast("decimal(20,0)"))
    return F.when(total > 0, part + 1)


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: parts ``pair`` (other sources) and ``term``."""
    scratch = Scratch(docs.sparkSession, "divergence")
    found = scratch.write(counts(docs, text, lang, source))
    # one shuffle settles which terms are kept: a term has at most one row per source here
    term = W.partitionBy("lang", "term")
    kept = found.filter("term IS NOT NULL").select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("n_lang"), F.sum("df").over(term).alias("df"),
        (F.min("source").over(term) == F.col("source")).alias("first"),
    )
    kept = scratch.write(kept.filter(F.col("df") >= MIN_DOCS).drop("df"))
    groups = _groups(found, kept)
    pair = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_sums(scratch, kept, groups).withColumn("rank", F.row_number().over(pair))
    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    listed = _terms(kept, groups).withColumn("rank", F.row_number().over(pair)).filter(F.col("rank") <= TOP)
    return out.unionByName(listed.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _groups(found: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per group: its total, the language's total and V, p of count 0, block; broadcast if small."""
    langs = kept.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.count_if("first").alias("v"), F.count(F.lit(1)).alias("rows"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = found.filter("term IS NULL").select("lang", "source")
    sizes = named.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    out = named.join(own, ["lang", "source"], "left").join(sizes.join(langs, "lang", "left"), "lang")
    out = out.na.fill(0, ["total", "total_lang", "v", "rows"])
    blocks = F.ceil(F.col("sources") / BLOCK).cast("int")
    out = out.withColumn("p0", F.coalesce(_share(F.lit(0), F.col("total") + F.col("v")), F.lit(0)))
    out = out.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("source"), blocks).cast("int"))
    out = out.withColumn("deals", F.greatest(F.lit(1), F.ceil(F.col("rows") / (ROWS * blocks))).cast("int"))
    return sizing.small_side(out.drop("rows", "sources"))


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    rows = kept.join(groups, ["lang", "source"])
    rows = rows.withColumn("p", _share(F.col("n"), F.col("total") + F.col("v"))).withColumn("q", _share(F.col("n_lang"), F.col("total_lang") + F.col("v")))
    return rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))


def pair_sums(scratch: Scratch, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two different sources of a language."""
    rows = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total") + F.col("v")))
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("term"), F.col("deals")).cast("int"))
    every = groups.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    every = every.withColumn("term", F.lit(None).cast("string")).withColumn("p", F.lit(None).cast("long"))
    # a block meets every block, itself included: the lower one is named first
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    names = ["lang", "source", "term", "p", "p0", "v", "block", "deal"]
    dealt = rows.select(*names, "blocks").unionByName(every.select(*names, "blocks")).select(*names, other.alias("other"))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    found = dealt.groupBy("lang", "low", "high", "deal").applyInArrow(_pair_block, PAIRS)
    return scratch.write(found).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _pair_block(rows: pa.Table) -> pa.Table:
    """The sums of one task: all pairs of a source of the low and one of the high block, both ways."""
    c = {n: rows.column(n).combine_chunks() for n in ("source", "term", "p", "p0", "v", "block")}
    lang, low, high, deal = (rows.column(n)[0].as_py() for n in ("lang", "low", "high", "deal"))
    whole = np.asarray(c["term"].is_null())
    names = c["source"].dictionary_encode()
    code = names.indices.to_numpy(zero_copy_only=False)
    size = len(names.dictionary)
    p0, block = np.zeros(size, np.int64), np.zeros(size, np.int64)
    p0[code[whole]] = c["p0"].to_numpy(zero_copy_only=False)[whole]
    block[code[whole]] = c["block"].to_numpy(zero_copy_only=False)[whole]
    v = c["v"][0].as_py()
    total = np.zeros((size, size), np.int64)
    if v:
        base = _f(p0[:, None], p0[None, :])
        if deal == 0:  # once for all terms of the language
            total += v * base
        own, p = code[~whole], c["p"].to_numpy(zero_copy_only=False)[~whole].astype(np.int64)
        term = c["term"].dictionary_encode().indices.to_numpy(zero_copy_only=False)[~whole].astype(np.int64)
        _single(total, own, p, p0, base)
        _common(total, own, p, term, p0, base)
    both = (block[:, None] == low) & (block[None, :] == high)
    both |= both.T
    np.fill_diagonal(both, False)
    g, h = np.nonzero(both)
    own = [pa.array([lang] * len(g), pa.string()), names.dictionary.take(pa.array(g)), names.dictionary.take(pa.array(h)), pa.array(total[g, h])]
    return pa.Table.from_arrays([own[0], own[1].cast(pa.string()), own[2].cast(pa.string()), own[3]], names=["lang", "source", "item", "value"])


def _single(total: np.ndarray, own: np.ndarray, p: np.ndarray, p0: np.ndarray, base: np.ndarray) -> None:
    """Terms of one source against the other's value at count 0, each distinct (source, p) once."""
    kinds, n = np.unique(np.stack([own, p], axis=1), axis=0, return_counts=True)
    step = max(1, (1 << 20) // max(1, len(p0)))
    for a in range(0, len(kinds), step):
        g, value, times = kinds[a : a + step, 0], kinds[a : a + step, 1][:, None], n[a : a + step][:, None]
        np.add.at(total, g, times * (_f(value, p0[None, :]) - base[g]))
        np.add.at(total.T, g, times * (_f(p0[None, :], value) - base.T[g]))


def _common(total: np.ndarray, own: np.ndarray, p: np.ndarray, term: np.ndarray, p0: np.ndarray, base: np.ndarray) -> None:
    """Terms that two sources share, a bounded number of (source, source) steps at a time."""
    order = np.argsort(term, kind="stable")
    own, p, term = own[order], p[order], term[order]
    first = terms.runs([term])
    length = np.diff(np.append(first, len(term)))
    start, width = np.repeat(first, length), np.repeat(length, length)
    size, flat = len(p0), total.reshape(-1)
    steps = np.cumsum(width)
    a = 0
    while a < len(own):
        b = max(a + 1, int(np.searchsorted(steps, (steps[a - 1] if a else 0) + (1 << 20), side="right")))
        w = width[a:b]
        i = np.repeat(np.arange(a, b), w)
        j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(start[a:b], w)
        g, h = own[i], own[j]
        value = _f(p[i], p[j]) - _f(p[i], p0[h]) - _f(p0[g], p[j]) + base[g, h]
        np.add.at(flat, g * size + h, value)
        a = b


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
tokens AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '{terms.pattern(False)}')), '{_UPPER}', '{_LOWER}') AS term FROM docs
),
kept AS (SELECT lang, term, count(*) AS n FROM tokens GROUP BY ALL HAVING count(DISTINCT d) >= {MIN_DOCS}),
langs AS (
  SELECT l.lang, count(k.term)::HUGEINT AS v, coalesce(sum(k.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM docs) l LEFT JOIN kept k USING (lang) GROUP BY l.lang
),
groups AS (SELECT DISTINCT lang, source FROM docs),
own AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (
  SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS total FROM groups g LEFT JOIN own o USING (lang, source) GROUP BY ALL
),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(o.n, 0) AS n,
         1 + ({UNIT}::HUGEINT * (coalesce(o.n, 0) + 1)) // (t.total + l.v) AS p,
         1 + ({UNIT}::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN own o ON o.lang = t.lang AND o.source = t.source AND o.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
