"""Ranked lexical search (operator 13): the best documents of each item by an exact inner product, found
in sparse ball trees.

A document is a sparse vector over the items' terms, ``y = w * ((UNIT * tf) div (SCALE * tf + SATURATION * m))``
with ``w`` the weight of a term and ``m`` the document's length factor; an item is the set of its
distinct terms, so a score is the sum of y over them.  All of y is whole numbers, and scores are added as such.

1. One pass over the texts (:mod:`itemstats.llm.terms`) gives every document's number of terms and its counts of
   item terms; the numbers of documents and terms and the document frequencies are aggregated from that table.
2. Each task takes the vectors where they lie, in blocks of ``TREE_DOCS``.  A block becomes a ball tree: a
   node has the mean of its documents, their largest distance from it and, per coordinate, their largest
   excess over it, and is halved along the line between two far documents down to ``LEAF`` documents.  An
   item visits nodes best-first by the bound ``<q, mean> + min(|q| radius, excess over q's terms)`` (the
   second radius knows that a query is in few coordinates), adds up exact scores at the leaves and stops when
   the best remaining bound is below its k-th score; it carries its best documents from block to block.  Distances and bounds are rounded
   up by more than the error of their sums (``SLACK``), so no document is lost to rounding; a bound equal
   to the k-th score is followed, so ties are settled by ``doc_id``.
3. The tasks' best are ranked once more, k a task and item.

Items are a query set: ``BLOCK_TERMS`` (item, term) rows of it are held by a task, and more are taken in
blocks cut by their measured sizes, each a pass over the documents.  What goes to the driver is one block
of items with one number a term.

Defined cases: null and empty texts have no terms and are never found, nor counted in N; an item without terms
or without a document gives no row; rows of one item_id (also null) are one item with all their terms; every
row of the documents is one of its own, also with a repeated or null doc_id (null is last among ties); a very
long text is taken whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from itemstats.llm import terms
from itemstats.llm.common import Scratch, map_in_arrow, offsets, ordered, with_part_values

#: Fixed values of the ranking function.
WEIGHT = 1000
UNIT, SCALE, SATURATION = 1_000_000_000, 1000, 8
LENGTH_SHARE = 90
TOP = 10
#: Documents and stored counts of a tree, documents of a leaf.
TREE_DOCS = 8192
TREE_COUNTS = 1 << 21
LEAF = 128
#: Relative error allowed to sums of doubles; that of 2^20 terms is below 2^-32.
SLACK = 1e-9
#: Bytes of text split at a time, at about 11 times their size; a longer text is taken by itself, whole.
TEXT_BYTES = 1 << 20
#: (item, term) rows held by a task.
BLOCK_TERMS = 1_000_000
VECTORS = "doc_id long, n long, dims array<int>, tf array<long>"
FOUND = "item_id long, doc_id long, score long"
CHARACTERS = terms.alphabet(digits=True)


class Vocabulary:
    """Numbers of terms by their words: a mixed 64-bit key is looked up and all words are compared."""

    def __init__(self, words: list[bytes]):
        found = terms.split(pa.array(words, pa.binary()), CHARACTERS)
        assert len(found.row) == len(words)
        self.by_width = {}
        for width, at, _ in found.buckets():
            own = found.words(at, width // terms.WORD)
            odd = 0x9E3779B97F4A7C15
            while len(np.unique(key := self._mix(own, odd))) < len(at):
                odd = (odd * 3) % (1 << 64)
            order = np.argsort(key)
            self.by_width[width] = (odd, key[order], [w[order] for w in own], found.row[at][order])

    @staticmethod
    def _mix(words: list[np.ndarray], odd: int) -> np.ndarray:
        key = np.zeros(len(words[0]), np.uint64)
        for w in words:
            key = (key ^ w) * np.uint64(odd)
            key ^= key >> np.uint64(29)
        return key

    def numbers(self, found: terms.Terms) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``found``, numbers) of the terms that the vocabulary has."""
        at_all, number_all = [], []
        low = 0
        for width in sorted(self.by_width):
            odd, keys, words, number = self.by_width[width]
            low = 0 if width == terms.WORD else width // 2
            at = np.flatnonzero((found.length > low) & (found.length <= width))
            own = found.words(at, width // terms.WORD)
            k = np.minimum(np.searchsorted(keys, self._mix(own, odd)), len(keys) - 1)
            same = np.ones(len(at), bool)
            for w, v in zip(own, words):
                same &= v[k] == w
            at_all.append(at[same])
            number_all.append(number[k[same]])
        return (np.concatenate(at_all), np.concatenate(number_all)) if at_all else (np.zeros(0, np.int64),) * 2


def vectors(docs: DataFrame, vocabulary: list[bytes], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n, dims, tf`` of every row: its number of terms and its counts of the vocabulary's."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [f.split()[0] for f in VECTORS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(shared.value)
        size = max(1, len(shared.value))
        for b in batches:
            for start, end in terms.slices(b.column(1), TEXT_BYTES):
                found = terms.split(b.column(1)[start:end], CHARACTERS)
                at, number = known.numbers(found)
                cells, tf = np.unique(found.row[at] * size + number, return_counts=True)
                row = cells // size
                bounds = pa.array(np.searchsorted(row, np.arange(end - start + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in ((cells % size).astype(np.int32), tf.astype(np.int64))]
                n = pa.array(np.bincount(found.row, minlength=end - start).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0)[start:end], n, *lists], names=names)

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_in_arrow(own, run, VECTORS)


def weight(documents: int, holding: int) -> int:
    return math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * holding + 1)))


class Tree:
    """A ball tree over rows of sparse whole-number vectors (``indptr``, ``dims``, ``y``)."""

    def __init__(self, indptr: np.ndarray, dims: np.ndarray, y: np.ndarray):
        self.indptr, self.dims, self.y = indptr, dims, y
        self.yf = y.astype(np.float64)
        self.norm = self._sums(self.yf * self.yf, indptr)
        self.nodes: list[tuple] = []  # (radius, dims of the mean, mean, excess, children, leaf)
        self.root = self._build(np.arange(len(indptr) - 1))

    @staticmethod
    def _sums(values: np.ndarray, indptr: np.ndarray) -> np.ndarray:
        """Sums of consecutive non-empty stretches."""
        return np.add.reduceat(values, indptr[:-1]) if len(indptr) > 1 else np.zeros(0)

    def _cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the rows' cells, and where each row's start among them."""
        length = self.indptr[rows + 1] - self.indptr[rows]
        start = np.concatenate([[0], np.cumsum(length)])
        return np.arange(start[-1]) + np.repeat(self.indptr[rows] - start[:-1], length), start

    def _build(self, rows: np.ndarray) -> int:
        cells, start = self._cells(rows)
        of, place = np.unique(self.dims[cells], return_inverse=True)
        y = self.yf[cells]
        mean = np.bincount(place, y, len(of)) / len(rows)
        own = float(mean @ mean)
        norm = self.norm[rows]
        far = norm - 2 * self._sums(y * mean[place], start) + own
        far += SLACK * (norm + own)  # rounded up
        radius = math.sqrt(max(0.0, float(far.max()))) * (1 + SLACK)
        excess = np.zeros(len(of))
        np.maximum.at(excess, place, y)
        excess -= mean
        if len(rows) <= LEAF:
            order = np.argsort(place, kind="stable")
            doc = np.repeat(np.arange(len(rows)), np.diff(start))[order]
            bounds = np.searchsorted(place[order], np.arange(len(of) + 1))
            below = (rows, bounds, doc, self.y[cells][order])
            kind = None
        else:
            line = np.zeros(len(of))
            a = int(far.argmax())
            line[place[start[a] : start[a + 1]]] = y[start[a] : start[a + 1]]
            away = norm - 2 * self._sums(y * line[place], start)
            b = int(away.argmax())
            line[place[start[b] : start[b + 1]]] -= y[start[b] : start[b + 1]]
            half = np.argsort(self._sums(y * line[place], start), kind="stable")
            middle = len(rows) // 2
            left, right = np.sort(rows[half[:middle]]), np.sort(rows[half[middle:]])
            del rows, cells, start, place, y, norm, far, line, away, half  # not held while the halves are built
            kind = (self._build(left), self._build(right))
            below = None
        self.nodes.append((radius, of, mean, excess, kind, below))
        return len(self.nodes) - 1

    def bound(self, node: int, query: np.ndarray, length: float) -> float:
        """Above every score in the node: ``<q, mean>`` and the smaller radius, rounded up."""
        radius, of, mean, excess, _, _ = self.nodes[node]
        at = of.searchsorted(query)
        at[at == len(of)] = 0
        at = at[of[at] == query]
        return float(mean[at].sum() + min(length * radius, excess[at].sum())) * (1 + SLACK)

    def leaf(self, node: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a leaf and their exact scores."""
        _, of, _, _, _, (rows, bounds, doc, y) = self.nodes[node]
        at = of.searchsorted(query)
        at[at == len(of)] = 0
        at = at[of[at] == query]
        length = bounds[at + 1] - bounds[at]
        start = np.cumsum(length) - length
        cells = np.arange(length.sum()) + np.repeat(bounds[at] - start, length)
        scores = np.zeros(len(rows), np.int64)
        np.add.at(scores, doc[cells], y[cells])
        return rows, scores

    def search(self, query: np.ndarray, k: int, best: list[tuple[int, int]], ids: list[int | None]) -> int:
        """Merge the block's documents into ``best``, a heap of the k highest (score, -id); leaves seen."""
        length = math.sqrt(len(query))
        ahead = [(-self.bound(self.root, query, length), self.root)]
        seen = 0
        while ahead:
            over, node = heapq.heappop(ahead)
            if len(best) == k and -over < best[0][0]:
                break
            kind = self.nodes[node][4]
            if kind is not None:
                for child in kind:
                    b = self.bound(child, query, length)
                    if b >= (best[0][0] if len(best) == k else 1):
                        heapq.heappush(ahead, (-b, child))
                continue
            seen += 1
            rows, scores = self.leaf(node, query)
            for i in np.flatnonzero(scores >= max(1, best[0][0] if len(best) == k else 1)).tolist():
                own = ids[rows[i]]
                entry = (int(scores[i]), NULL_LAST if own is None else -own)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return seen


#: Stands for a null id: below the negative of every 64-bit number.
NULL_LAST = -(1 << 64)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, m, indptr, dims, tf) of about TREE_DOCS documents that hold item terms."""
    held, docs, counts = [], 0, 0
    for b in batches:
        length = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
        end = np.cumsum(length)
        at = 0
        while at < len(length):
            room = np.searchsorted(end, (end[at - 1] if at else 0) + TREE_COUNTS - counts, side="right")
            to = min(len(length), at + TREE_DOCS - docs, max(int(room), at + 1))
            part = b.slice(at, to - at)
            held.append(part)
            docs, counts, at = docs + to - at, counts + int(length[at:to].sum()), to
            if docs >= TREE_DOCS or counts >= TREE_COUNTS:
                yield _joined(held)
                held, docs, counts = [], 0, 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = [i for p in parts for i in p.column(0).to_pylist()]
    m = np.concatenate([p.column(1).to_numpy(zero_copy_only=False) for p in parts])
    length = np.concatenate([p.column(2).value_lengths().to_numpy(zero_copy_only=False) for p in parts])
    dims, tf = (np.concatenate([p.column(c).flatten().to_numpy(zero_copy_only=False) for p in parts]) for c in (2, 3))
    return ids, m, np.concatenate([[0], np.cumsum(length)]).astype(np.int64), dims, tf


def _search_task(shared, k: int):
    """Function over Arrow batches of ``doc_id, m, dims, tf``: the best k documents of each item in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        for ids, m, indptr, dims, tf in blocks_of(batches):
            y = (UNIT * tf) // (SCALE * tf + SATURATION * np.repeat(m, np.diff(indptr)))
            tree = Tree(indptr, dims, weights[dims] * y)
            for own, (_, query) in zip(best, items):
                tree.search(query, k, own, ids)
        rows = [(item, None if i == NULL_LAST else -i, s) for own, (item, _) in zip(best, items) for s, i in own]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in FOUND.split(", ")])

    return run


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``item_id, term``."""
    found = F.regexp_extract_all(F.col(text).cast("string"), F.lit(terms.pattern(digits=True)), F.lit(0))
    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.explode(found).alias("term"))
    return own.select("item_id", F.translate("term", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("term")).distinct()


def _blocks(scratch: Scratch, wanted: DataFrame) -> Iterator[list]:
    """The (item, term) rows in blocks of about BLOCK_TERMS, an item in one of them; written only for several blocks."""
    rows = wanted.limit(BLOCK_TERMS + 1).collect()
    if len(rows) <= BLOCK_TERMS:
        yield rows
        return
    del rows
    wanted = scratch.write(wanted)
    sizes = ordered(scratch, wanted.groupBy("item_id").agg(F.count(F.lit(1)).alias("rows")), ["item_id"])
    before = W.partitionBy("part").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    sums = {r["part"]: r["rows"] for r in sizes.groupBy("part").agg(F.sum("rows").alias("rows")).collect()}
    sizes = with_part_values(sizes.withColumn("earlier", F.coalesce(F.sum("rows").over(before), F.lit(0))), {"base": offsets(sums)})
    block = F.floor((F.col("earlier") + F.col("base")) / BLOCK_TERMS).cast("int").alias("block")
    dealt = scratch.write(wanted.join(sizes.select(F.col("item_id").alias("own"), block), F.col("item_id").eqNullSafe(F.col("own"))).drop("own"))
    for [k] in sorted(tuple(r) for r in dealt.select("block").distinct().collect()):
        yield dealt.filter(F.col("block") == k).select("item_id", "term").collect()


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k highest-scoring documents of each item."""
    scratch = Scratch(docs.sparkSession, "search")
    out = None
    for rows in _blocks(scratch, item_terms(items, item_id, item_text)):
        found = scratch.write(_search(scratch, docs, rows, k, text, doc_id))
        out = found if out is None else out.unionByName(found)
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search(scratch: Scratch, docs: DataFrame, rows: list, k: int, text: str, doc_id: str) -> DataFrame:
    words = sorted({r["term"].encode() for r in rows})
    number = {w: i for i, w in enumerate(words)}
    queries: dict[int | None, list[int]] = {}
    for r in rows:
        queries.setdefault(r["item_id"], []).append(number[r["term"].encode()])
    items = [(i, np.array(sorted(q), np.int32)) for i, q in queries.items()]
    own = scratch.write(vectors(docs, words, text, doc_id))
    documents, length = own.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = own.select(F.explode("dims").alias("dim")).groupBy("dim").agg(F.count(F.lit(1)).alias("df")).collect()  # at most one row a term
    weights = np.zeros(len(words), np.int64)
    for r in holding:
        weights[r["dim"]] = weight(documents, r["df"])
    # exact beyond 64 bits
    factor = F.call_function("div", F.col("n").cast("decimal(19,0)") * F.lit(LENGTH_SHARE * documents).cast("decimal(18,0)"), F.lit(max(1, length)).cast("decimal(19,0)"))
    ready = own.filter(F.size("dims") > 0).select("doc_id", (factor + (100 - LENGTH_SHARE)).alias("m"), "dims", "tf")
    shared = docs.sparkSession.sparkContext.broadcast((items, weights))
    return map_in_arrow(ready, _search_task(shared, k), FOUND)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = f"translate(unnest(regexp_extract_all(text, '{terms.pattern(True)}')), '{_UPPER}', '{_LOWER}') AS term"
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, text FROM documents),
tokens AS (SELECT d, doc_id, {_TERMS} FROM docs),
lengths AS (SELECT d, any_value(doc_id) AS doc_id, count(*)::HUGEINT AS n FROM tokens GROUP BY d),
corpus AS (SELECT count(*)::HUGEINT AS documents, sum(n)::HUGEINT AS length FROM lengths),
items AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)),
held AS (SELECT d, term, count(*)::HUGEINT AS tf FROM tokens WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor({WEIGHT} * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w FROM held, corpus GROUP BY term, documents
),
scores AS (
  SELECT i.item_id, l.d, l.doc_id,
         sum(w.w * (({UNIT} * h.tf) // ({SCALE} * h.tf + {SATURATION} * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * l.n * c.documents) // c.length)))) AS score
  FROM items i JOIN weights w USING (term) JOIN held h USING (term) JOIN lengths l USING (d), corpus c
  GROUP BY ALL HAVING score > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score::BIGINT AS score
FROM scores QUALIFY rank <= {TOP}
"""
