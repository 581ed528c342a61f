from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from itemstats.llm import terms

BITS = ["a", "Z", "é", "😀", " ", "1", "-", "\n", "ß", "Hello", "x" * 17, "y" * 40, "ÀÈ", "_", "", "q" * 8, "r" * 16, "\x7f", "\x00", "A" * 300]


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def texts(seed, n=1500):
    rnd = random.Random(seed)
    return [None if rnd.random() < 0.05 else "".join(rnd.choice(BITS) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("digits", [False, True])
def test_terms_are_those_of_the_pattern(digits):
    rows = texts(1)
    found = terms.split(pa.array([*rows[:3], *rows])[3:], terms.alphabet(digits))  # a sliced array
    want = [(i, lower(m)) for i, s in enumerate(rows) for m in re.findall(terms.pattern(digits), s or "")]
    assert [(r, bytes(found.raw[a : a + n]).decode()) for r, a, n in zip(found.row, found.start, found.length)] == want
    got = {}
    for width, at, words in found.buckets():
        values = terms.as_binary(words).to_pylist()
        assert all(len(x) <= width and (width == 8 or 2 * len(x) > width) for x in values)
        order = terms.order_of(words)
        assert [values[i] for i in order] == sorted(values)
        got.update(zip(at.tolist(), values))
    assert [got[i].decode() for i in range(len(want))] == [t for _, t in want]


def test_radix_order_is_stable_and_unsigned():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 4, 5000).astype(np.uint32)
    b = rnd.choice(np.array([0, 1, 1 << 15, 1 << 63, (1 << 64) - 1, 1 << 32], np.uint64), 5000)
    got = terms.radix_order([a, b]).tolist()
    assert got == sorted(range(5000), key=lambda i: (a[i], b[i], i))
    assert terms.radix_order([a[:0], b[:0]]).tolist() == []


def test_slices_cover_every_row(monkeypatch):
    monkeypatch.setattr(terms, "SLICE_BYTES", 50)
    rows = pa.array(texts(2, 100) + ["z" * 500, None, ""])
    parts = list(terms.slices(rows))
    assert [i for a, b in parts for i in range(a, b)] == list(range(len(rows)))
    assert all(b - a == 1 or sum(len((x or "").encode()) for x in rows[a:b].to_pylist()) <= 50 for a, b in parts)


def test_nothing():
    for rows in ([], [None], ["", None, "  "]):
        found = terms.split(pa.array(rows, pa.string()), terms.alphabet(True))
        assert len(found.start) == 0 and list(found.buckets()) == []
