"""Benchmark decontamination by spaced-seed hashing (operator 6).

Words are lower-cased runs of letters and digits.  A window of ``WINDOW`` words leaks when a window of
a benchmark item equals it in all but at most ``CHANGED`` places.  The places are dealt into four
groups; a mask keeps two of them and ignores the other places, and six masks keep every pair of
groups, so two changed places always leave one mask untouched: no such window is missed.  Hashes of
the masked windows of documents and benchmark are joined, and around every hit the aligned words are
compared, which settles the number of changed places.  An item with fewer words than a window is
one window of its own length (with a fifth of its places changeable, none below five words).  Such a
window can be a phrase of everyday text: ``leaks`` flags as ``short`` what holds no window with
``MIN_EQUAL`` equal words, and ``clean`` removes a document only for ``least`` equal words in a window.

Scale: the benchmark is the query set.  Its masked hashes are joined in memory where the documents
lie, behind a bounded bitmap that settles almost every window; documents are never shuffled.  The
size of the benchmark is checked: over ``SEED_LIMIT`` characters it is taken in blocks under that
bound, each against all documents.

Defined cases: null texts and texts without words leak nothing, and items without words match
nothing; texts are scanned whole; repeated rows are scanned each; an empty documents table gives an
empty result, an empty benchmark leaves all documents clean; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemstats.llm import common

WINDOW, CHANGED = 13, 2
#: Equal words of one window from which a leak is no everyday phrase (a full window has 11 at least).
MIN_EQUAL = 8
GROUPS = 4
#: Characters of benchmark text a task may hold the masked windows of (under 30 bytes a character).
SEED_LIMIT = 2_000_000
BITMAP = 1 << 22
WORD = regex.compile(r"[\p{L}\p{N}]+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text."""
    if not text:
        return np.zeros(0, np.uint64)
    if text.isascii():
        own = text.lower().encode().translate(SEPARATE).split()
    else:
        own = [w.encode("utf-8", "surrogatepass") for w in WORD.findall(text.lower())]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))


SEPARATE = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def masks(width: int) -> list[tuple[int, ...]]:
    """The kept places of every mask of a window; one mask keeping all where nothing may change."""
    if changeable(width) == 0:
        return [tuple(range(width))]
    groups = [tuple(range(g, width, GROUPS)) for g in range(GROUPS)]
    return [tuple(sorted(a + b)) for a, b in combinations(groups, 2)]


def changeable(width: int) -> int:
    return CHANGED if width >= WINDOW else 0 if width < 5 else min(CHANGED, width // 5)


def masked(h: np.ndarray, width: int, keep: tuple[int, ...], salt: int) -> np.ndarray:
    """Hash of every window of ``width`` words under one mask."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(width * 64 + salt))
    for k in keep:
        out = (out ^ h[k : k + n]) * MULTIPLIER
        out ^= out >> np.uint64(31)
    return out


def seeds(items: pd.DataFrame) -> pd.DataFrame:
    """(hash, width, item row, place) of every masked window of the items."""
    out = []
    for row, h in enumerate(items["words"]):
        width = min(WINDOW, len(h))
        for salt, keep in enumerate(masks(width) if width else []):
            m = masked(h, width, keep, salt)
            out.append(pd.DataFrame({"hash": m, "width": width, "item": row, "place": np.arange(len(m))}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"hash": np.zeros(0, np.uint64), "width": 0, "item": 0, "place": 0})


class Index:
    """The items' words and masked windows, and a bitmap that settles most document windows."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        self.words = [words(t) for t in texts]
        s = seeds(pd.DataFrame({"words": self.words})).sort_values("hash", kind="stable")
        self.hash, self.item, self.place = s["hash"].to_numpy(np.uint64), s["item"].to_numpy(), s["place"].to_numpy()
        self.widths = sorted(set(s["width"].tolist()), reverse=True)
        self.bits = np.zeros(BITMAP, bool)
        self.bits[(self.hash >> np.uint64(20)) & np.uint64(BITMAP - 1)] = True

    def spans(self, h: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """Per item row the verified windows: (first word, end, changed places, place in the item)."""
        out: dict[int, set] = {}
        for width in self.widths:
            allowed = changeable(width)
            for salt, keep in enumerate(masks(width)):
                m = masked(h, width, keep, salt)
                at = np.flatnonzero(self.bits[(m >> np.uint64(20)) & np.uint64(BITMAP - 1)]) if len(m) else m
                if not len(at):
                    continue
                first, last = np.searchsorted(self.hash, m[at], "left"), np.searchsorted(self.hash, m[at], "right")
                hit = first < last
                at, first, last = at[hit], first[hit], last[hit]
                for p, a, b in zip(at.tolist(), first.tolist(), last.tolist()):
                    for k in range(a, b):
                        row, place = int(self.item[k]), int(self.place[k])
                        own = self.words[row][place : place + width]
                        if len(own) == width == min(WINDOW, len(self.words[row])):
                            changed = int((own != h[p : p + width]).sum())
                            if changed <= allowed:
                                out.setdefault(row, set()).add((p, p + width, changed, place))
        return {row: sorted(v) for row, v in out.items()}


def merge(spans: list[tuple[int, int, int, int]]) -> tuple[int, int, int]:
    """First word, end and words covered by the windows of one item."""
    covered, end = 0, 0
    for a, b, _, _ in spans:
        covered += max(0, b - max(a, end))
        end = max(end, b)
    return spans[0][0], end, covered


def equal(spans: list[tuple[int, int, int, int]]) -> int:
    """Equal words of the best window."""
    return max(b - a - changed for a, b, changed, _ in spans)


def leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id, item_id, first_word, end_word, words_covered, fewest_changed, short`` per document and
    item whose windows it holds; ``short`` where none of them has ``MIN_EQUAL`` equal words."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if size > SEED_LIMIT:  # more characters than the limit of hashes: in blocks of items, each a scan
        return _in_blocks(own, items, size)
    return _scan(own, items.orderBy("item_id", "text").collect())  # at most SEED_LIMIT characters


def _in_blocks(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """A benchmark over the limit is a query set taken in blocks: the hash of an item deals it to a
    block, and every block is scanned against all documents."""
    blocks = -(-2 * size // SEED_LIMIT)
    out = None
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = _scan(docs, part.orderBy("item_id", "text").collect())
        out = found if out is None else out.unionByName(found)
    return out


RESULT = "doc_id long, item_id long, first_word long, end_word long, words_covered long, fewest_changed long, short boolean"


def _scan(docs: DataFrame, items: list) -> DataFrame:
    ids, texts = [r["item_id"] for r in items], [r["text"] for r in items]
    index = docs.sparkSession.sparkContext.broadcast((ids, texts))
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(*index.value)
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                for row, spans in own.spans(words(t.as_py())).items() if own.widths else ():
                    out.append((i, own.ids[row], *merge(spans), min(s[2] for s in spans), equal(spans) < MIN_EQUAL))
            if out:
                *numbers, short = zip(*out)
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in numbers], pa.array(short, pa.bool_())], names=names)

    found = common.map_in_arrow(docs, run, RESULT)
    # several items may share an id or a text: one row per document and id
    return found.groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.max("words_covered").alias("words_covered"),
        F.min("fewest_changed").alias("fewest_changed"), F.bool_and("short").alias("short"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", least: int = 1) -> DataFrame:
    """``docs`` without the rows whose own text leaks with at least ``least`` equal words in one window
    (1: every leak, also of an item of one word).  Rows are judged where they lie: no join."""
    items = benchmark.select(F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // SEED_LIMIT) if size > SEED_LIMIT else 1)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else items
        docs = _keep(docs, [r["text"] for r in part.distinct().orderBy("text").collect()], text, least)
    return docs


def _keep(docs: DataFrame, texts: list[str | None], text: str, least: int) -> DataFrame:
    # an item of fewer words has no window with as many equal
    index = docs.sparkSession.sparkContext.broadcast([t for t in texts if len(words(t)) >= least])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index(list(range(len(index.value))), index.value)
        for b in batches:
            ok = []
            for t in b.column(b.schema.get_field_index(text)):
                found = own.spans(words(t.as_py())).values() if own.widths else ()
                ok.append(all(equal(spans) < least for spans in found))
            yield b.filter(pa.array(ok, pa.bool_()))

    return common.map_in_arrow(docs, run, docs.schema)
