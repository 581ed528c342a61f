"""Secret scan (operator 3): an Aho-Corasick pass over the lower-cased bytes of a text finds keywords,
anchored regular expressions run only at the hits, and tokens that embed a checksum are kept only
if it is right.

Kinds ``assign``, ``access`` and ``hex`` are the base.  A hexadecimal run has no keyword; its
prefilter is the same automaton search on every fourth byte's class: a run of 24 covers six of them
in a row.  The method adds ``github`` and ``npm`` tokens (prefix, 30 characters, base-62 CRC-32 of
those) and ``private_key`` blocks.  Offsets are code points, end exclusive.

Defined cases: null and empty texts have no spans; a very long text is scanned whole, in linear
time; repeated rows are scanned each; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "github", "npm", "private_key")
# fixed values: the base patterns
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_CHARS = 6
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_CHARS = 20
HEX_CHARS = 24
HEX = b"0123456789abcdef"
# the method's own
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
KEY_BLOCK = re.compile(rb"-----BEGIN (?P<kind>[A-Z ]{0,40}PRIVATE KEY)-----")
KEY_END = re.compile(rb"(?=-----END (?P<kind>[A-Z ]{0,40}PRIVATE KEY)-----)")
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
    "-----begin ": "private_key",
}
STRIDE = 4
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CLASSES = bytes(ord("h") if c in HEX else ord(".") for c in range(256))
RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def automaton(words: dict[str, str]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for w, kind in words.items():
        a.add_word(w, (len(w), kind))
    a.make_automaton()
    return a


def checksum_ok(body: bytes, check: bytes) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value = zlib.crc32(body)
    for c in reversed(check):
        value, digit = divmod(value, 62)
        if BASE62[digit] != c:
            return False
    return value == 0


def hex_runs(raw: bytes, search) -> Iterator[tuple[int, int]]:
    need = HEX_CHARS // STRIDE
    end = 0
    for hit, _ in search.iter(raw.translate(CLASSES)[::STRIDE].decode("latin-1")):
        at = (hit - need + 1) * STRIDE
        if at < end:
            continue
        start = at
        while start > end:  # widen to the whole run, a block at a time
            block = raw[max(end, start - 64) : start]
            left = len(block.rstrip(HEX))
            start -= len(block) - left
            if left:
                break
        end = at
        while end < len(raw):
            block = raw[end : end + 64]
            right = len(block.lstrip(HEX))
            end += len(block) - right
            if right:
                break
        if end - start >= HEX_CHARS:
            yield start, end


def block_ends(raw: bytes) -> dict[bytes, list[int]]:
    """Where the last lines of private keys start, by the name of the key: one pass over the text."""
    out: dict[bytes, list[int]] = {}
    for m in KEY_END.finditer(raw):
        out.setdefault(m["kind"], []).append(m.start())
    return out


def scan(text: str, words, hexes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start and then kind as listed, in code points."""
    raw = text.encode("utf-8", "surrogatepass")
    hits = sorted((e - n + 1, kind) for e, (n, kind) in words.iter(raw.lower().decode("latin-1")))
    found = [(a, b, "hex") for a, b in hex_runs(raw, hexes)]
    done = dict.fromkeys(KINDS, 0)
    ends = None
    for at, kind in hits:
        if at < done[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(raw, at)
            good = m and len(m[2]) >= ASSIGN_CHARS
        elif kind == "access":
            m = ACCESS.match(raw, at)
            good = m and len(m[0]) >= ACCESS_CHARS
        elif kind == "private_key":
            m = KEY_BLOCK.match(raw, at)
            good = m is not None
        else:
            m = CHECKED.match(raw, at)
            good = m and not (at and raw[at - 1 : at].isalnum()) and checksum_ok(m[1], m[2])
        if m:
            end = m.end()
            if kind == "private_key":
                ends = block_ends(raw) if ends is None else ends
                own = ends.get(m["kind"], [])
                k = bisect.bisect_left(own, end)
                end = own[k] + len(b"-----END -----") + len(m["kind"]) if k < len(own) else end
            done[kind] = end
            if good:
                found.append((at, end, kind))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    if found and len(raw) != len(text):  # bytes to code points
        starts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
        point = lambda b: int(starts[b - 1]) if b else 0
        found = [(point(a), point(b), k) for a, b, k in found]
    return found


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: counts of the base kinds, SHA-256 of the base spans, and all spans ``kind:start:end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hexes = automaton(KEYWORDS), automaton({"h" * (HEX_CHARS // STRIDE): "hex"})
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for t in b.column(1):
                spans = scan(t.as_py() or "", words, hexes)
                text_of = [f"{k}:{a}:{e}" for a, e, k in spans]
                kinds = [k for _, _, k in spans]
                base = ",".join(s for s, k in zip(text_of, kinds) if k in KINDS[:3])
                row = [*[kinds.count(k) for k in KINDS[:3]], hashlib.sha256(base.encode()).hexdigest(), ",".join(text_of)]
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.int64()] * 3 + [pa.string()] * 2
            names = [f.split()[0] for f in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, type=t) for c, t in zip(cols, types)]], names=names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, RESULT)


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mask: str = "[REDACTED]") -> DataFrame:
    """The documents with every span of the scan replaced by ``mask`` (overlapping spans by one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, hexes = automaton(KEYWORDS), automaton({"h" * (HEX_CHARS // STRIDE): "hex"})
        for b in batches:
            at = b.schema.get_field_index(text)
            out = []
            for t in b.column(at).to_pylist():
                if t is not None:
                    parts, end = [], 0
                    for a, e, _ in scan(t, words, hexes):
                        if a >= end:
                            parts += [t[end:a], mask]
                        end = max(end, e)
                    t = "".join(parts) + t[end:]
                out.append(t)
            yield b.set_column(at, b.schema.field(at), pa.array(out, type=b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
