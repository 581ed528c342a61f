"""Best-two-fit packing of documents into token sequences (operator 7).

A document's tokens are its ids followed by one separator.  Documents longer than a sequence are cut
into full pieces after a shorter first one.  Pieces of equal length are interchangeable, so the
packing is decided on the histogram of piece lengths (at most ``max_tokens`` counts, whatever the
input size): a bin is filled greedily with the longest pieces that fit, then its smallest piece is
exchanged for two unpacked ones that fill the widened gap more tightly; the pattern found is used as
often as the counts allow.  Pieces get their place by their rank in one range sort by length.

Texts are tokenised in Arrow batches; the ids are those of the ``tokenizers`` file.

Defined cases: null text is empty, an empty text is the separator alone; rows repeated with the same
doc_id are packed once each; a null doc_id is carried along; an empty table gives an empty result;
extra columns are ignored.  Ids, when asked for, are returned per piece.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.llm import common

MAX_TOKENS = 2048
SEPARATOR = 0
# fixed value: the split pattern of byte-level BPE
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Ids of pieces handed on at once, so that a batch of long texts stays within memory.
IDS_AT_ONCE = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, by a byte-level BPE ``tokenizers`` file.

    The file's vocabulary is handed to ``tiktoken``, whose ids are the same and several times cheaper
    (a merge's rank is its id, which is checked); texts that contain a special token's string, texts
    whose runs of white space overflow ``tiktoken``'s split (about a million), and files of another
    kind, are encoded by ``tokenizers`` itself."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.fast, self.special = Tokenizer.from_file(path), None, []
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and not spec.get("normalizer")
        if plain and self.merges_by_id(model["vocab"], model["merges"]):
            import tiktoken

            self.special = [t["content"] for t in spec.get("added_tokens", [])]
            to_byte = {c: b for b, c in byte_letters().items()}
            ranks = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def merges_by_id(vocab: dict[str, int], merges: list) -> bool:
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        return all(a < b for a, b in zip(made, made[1:]))

    def __call__(self, text: str) -> bytes:
        if self.fast is None or any(t in text for t in self.special):
            return self.whole(text)
        try:
            return np.asarray(self.fast.encode_to_numpy(text), "<u4").tobytes()
        except ValueError:  # its split backtracks over the whole of an unbroken run of white space
            return self.whole(text)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(own))
    return out


@cache
def encoder(path: str) -> Encoder:
    """One per worker process."""
    return Encoder(path)


def pieces(docs: DataFrame, text: str, doc_id: str, tokenizer: str, max_tokens: int, with_ids: bool) -> DataFrame:
    schema = T._parse_datatype_string(PIECES + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = encoder(tokenizer), np.asarray([SEPARATOR], "<u4").tobytes()

        def batch(out: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, type=t) for c, t in zip(zip(*out), ARROW[: len(out[0])])]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for b in batches:
            out: list[tuple] = []
            held = 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(t.as_py() or "") + tail
                n = len(ids) // 4
                start, end, k = 0, n % max_tokens or max_tokens, 0
                while start < n:
                    own = ids[4 * start : 4 * end]
                    row = (i, k, start, end - start, zlib.crc32(own))
                    out.append((*row, np.frombuffer(own, "<i4")) if with_ids else row)
                    held += end - start if with_ids else 0
                    start, end, k = end, end + max_tokens, k + 1
                    if held > IDS_AT_ONCE:
                        yield batch(out)
                        out, held = [], 0
            if out:
                yield batch(out)

    return common.map_in_arrow(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, schema)


ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]


def patterns(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Best-two-fit over a histogram of lengths: (lengths of one bin in place order, number of bins)."""
    left = np.zeros(size + 1, "int64")
    for length, n in counts.items():
        left[length] = n
    out = []
    while left.any():
        bin_, gap = [], size
        while gap and (fit := np.flatnonzero(left[: gap + 1])).size:  # greedy: the longest that fits
            use = int(fit[-1])
            times = min(int(left[use]), gap // use)
            left[use] -= times
            gap -= use * times
            bin_ += [use] * times
        if gap:
            smallest = bin_[-1]
            if two := best_two(left, smallest, gap + smallest):
                left[smallest] += 1
                left[two[0]] -= 1
                left[two[1]] -= 1
                bin_ = [*bin_[:-1], *two]
        used = Counter(bin_)
        more = min(int(left[u]) // n for u, n in used.items())
        for u, n in used.items():
            left[u] -= more * n
        out.append((bin_, more + 1))
    return out


def best_two(left: np.ndarray, smallest: int, room: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum is over ``smallest`` and as near ``room`` as can be."""
    have = np.flatnonzero(left[:room])
    if not have.size:
        return None
    # for each first length, the longest second one that still fits
    other = np.searchsorted(have, room - have, "right") - 1
    first = np.arange(have.size)
    alone = (other == first) & (left[have] < 2)
    other = np.where(alone, other - 1, other)
    ok = other >= 0
    if not ok.any():
        return None
    total = np.where(ok, have + have[np.maximum(other, 0)], 0)
    best = int(np.argmax(total))
    if total[best] <= smallest:
        return None
    a, b = int(have[best]), int(have[other[best]])
    return max(a, b), min(a, b)


def intervals(plan: list[tuple[list[int], int]]) -> list[np.ndarray]:
    """Global ranks (by length, then rank in the length) cut into runs with one place each: first
    rank of the run, first sequence, offset; consecutive ranks take consecutive sequences."""
    runs, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            runs.append((length, times, sequence, offset))
            offset += length
        sequence += times
    runs.sort(key=lambda r: r[0])
    first = np.concatenate([[0], np.cumsum([r[1] for r in runs])[:-1]]) if runs else np.zeros(0)
    return [first.astype("int64"), np.array([r[2] for r in runs], "int64"), np.array([r[3] for r in runs], "int64")]


def pack(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    text: str = "text",
    doc_id: str = "doc_id",
    tokenizer: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) per piece."""
    scratch = common.Scratch(docs.sparkSession, "pack")
    cut = pieces(docs, text, doc_id, tokenizer or default_tokenizer(), max_tokens, with_ids)
    if with_ids:  # the ids stay out of the sort and of the workers, and are joined by key to their places
        stored = scratch.write(cut.withColumn("key", F.monotonically_increasing_id()))
        cut = stored.drop("ids")
    else:
        stored = cut = scratch.write(cut)
    rows = common.ordered(scratch, cut, ["length", "doc_id", "piece", "ids_crc32"])
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most max_tokens rows
    totals = {r[0]: r[1] for r in rows.groupBy("part").count().collect()}  # one row per partition
    first, sequence, offset = intervals(patterns(counts, max_tokens))
    before = common.offsets(totals)
    names = cut.columns
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, row = b.column("part").to_numpy(zero_copy_only=False), b.column("row").to_numpy()
            rank = row + np.array([before[p] for p in part], "int64") if len(part) else row
            run = np.searchsorted(first, rank, "right") - 1
            keep = [b.column(c) for c in names]
            keep += [pa.array(sequence[run] + rank - first[run]), pa.array(offset[run])]
            yield pa.RecordBatch.from_arrays(keep, names=[*names, "sequence_id", "offset"])

    placed = rows.mapInArrow(place, schema)
    if not with_ids:
        return placed
    return placed.join(stored.select("key", "ids").hint("merge"), "key").select(*stored.drop("key", "ids").columns, "sequence_id", "offset", "ids")
