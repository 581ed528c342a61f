"""Chosen files read by blocks, and the stored list of batch files."""

from __future__ import annotations

import io
import os
import random
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from itemstats.sources import batches, blocks, catalogue


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def _line(student, paper, score):
    return f'{{"stuCode":"{student}","paperCode":"{paper}","item1":{{"i1":{score}}}}}\n'.encode()


def _aged(root):
    """Set the folders' time of change back, so that their listing is settled."""
    for folder, _, _ in os.walk(root):
        os.utime(folder, (1_000_000_000, 1_000_000_000))


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_every_line_lies_in_one_block(monkeypatch, chunk):
    monkeypatch.setattr(blocks, "CHUNK", chunk)
    rnd = random.Random(chunk)
    for _ in range(300):
        data = b"".join(rnd.choice([b"a", b"bc", b"\n", b"\r", b"\r\n"]) for _ in range(rnd.randrange(1, 25)))
        size = rnd.randrange(1, 12)
        got = [x for s in range(0, len(data), size) for x in blocks.block_lines(io.BytesIO(data), s, min(s + size, len(data)))]
        want, at = [], 0
        for line in data.splitlines(True):
            want.append((at, line.rstrip(b"\r\n")))
            at += len(line)
        assert got == want, (data, size)


def test_blocks_equal_the_text_scan(spark):
    root = tempfile.mkdtemp(prefix="itemstats-blocks-")
    rnd = random.Random(4)
    for k in range(6):
        data = "".join(rnd.choice(["word", "é", "\n", "\r\n", "\r", "", "漢字 "]) for _ in range(200 * k))
        _write(f"{root}/P {k}%20+ü/data.{k}", (b"\xef\xbb\xbf" if k == 3 else b"") + data.encode() + (b"\xff" if k == 2 else b""))
    files = batches.list_batches(spark, root)
    got = blocks.read_lines(files, block=37)
    want = spark.read.option("recursiveFileLookup", "true").text(root).select("value", F.col("_metadata.file_path").alias("uri"))
    assert sorted(map(tuple, got.select("value", "uri").collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("start > 0").count() > 0


def test_chosen_files_by_their_table(spark):
    root = tempfile.mkdtemp(prefix="itemstats-many-")
    for p in ("P A", "q[1]%20", "ü+"):
        _write(f"{root}/{p}/data.100", _line("old", p, 1))
        _write(f"{root}/{p}/data.200", _line("s", p, 2) + _line("s", p, 1) + b"junk\n")
    req = spark.createDataFrame([("P A", "150"), ("P A", "160"), ("q[1]%20", "150"), ("ü+", "050"), ("none", "1")], "paper_code string, submit_time string")
    at = tempfile.mkdtemp(prefix="itemstats-cat-") + "/c"
    catalogue.update(spark, root, at)
    listed = sorted(map(tuple, batches.list_batches(spark, root).select("paper_code", "ts", "length").collect()))
    assert sorted(map(tuple, catalogue.files(spark, at).select("paper_code", "ts", "length").collect())) == listed
    want = sorted(map(tuple, batches.read_requested(spark, root, req).collect()))
    assert len(want) == 2 + 2 + 2 + 1
    for more in ({"few_files": 0}, {"files": catalogue.files(spark, at)}):
        assert sorted(map(tuple, batches.read_requested(spark, root, req, **more).collect())) == want
    rejects = {r.reason: r.n for r in batches.requested_rejects(spark, root, req, files=catalogue.files(spark, at)).groupBy("reason").agg(F.sum("n").alias("n")).collect()}
    assert rejects == {"malformed line": 3, "no file": 1}


def test_second_update_lists_changed_folders_only(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="itemstats-land-")
    at = tempfile.mkdtemp(prefix="itemstats-cat-") + "/c"

    def names():
        return sorted((r.paper_code, r.ts, r.length) for r in catalogue.files(spark, at).collect())

    def listed():
        return sorted((r.paper_code, r.ts, r.length) for r in batches.list_batches(spark, root).collect())

    assert catalogue.update(spark, root, at) == {"folders": 0, "added": 0, "gone": 0} and names() == []
    for p, ts in (("1", 10), ("1", 20), ("2", 10), ("3", 5)):
        _write(f"{root}/{p}/data.{ts}", b"x" * ts)
    _write(f"{root}/1/data.30.tmp", b"y")
    _write(f"{root}/_logs/data.1", b"y")
    _aged(root)
    assert catalogue.update(spark, root, at) == {"folders": 3, "added": 4, "gone": 0}
    assert names() == [x for x in listed() if x[0] != "_logs"]
    assert catalogue.update(spark, root, at) == {"folders": 0, "added": 0, "gone": 0}
    # a new file in one folder, a folder that vanishes: one listed, the other dropped
    _write(f"{root}/2/data.40", b"z")
    shutil.rmtree(f"{root}/3")
    assert catalogue.update(spark, root, at) == {"folders": 2, "added": 1, "gone": 1}
    assert names() == [("1", "10", 10), ("1", "20", 20), ("2", "10", 10), ("2", "40", 1)]
    # folder 2 changed just now, so it is listed again until its time is settled
    assert catalogue.update(spark, root, at) == {"folders": 1, "added": 0, "gone": 0}
    os.utime(f"{root}/2", (1_000_000_500, 1_000_000_500))
    assert catalogue.update(spark, root, at)["folders"] == 1
    assert catalogue.update(spark, root, at)["folders"] == 0
    # a run that dies between the names and the marks is done again without a name twice
    os.remove(f"{root}/1/data.10")
    _write(f"{root}/1/data.50", b"w")
    os.utime(f"{root}/1", (1_000_000_900, 1_000_000_900))
    shutil.copytree(f"{at}/folders", f"{at}-before")
    assert catalogue.update(spark, root, at) == {"folders": 1, "added": 1, "gone": 1}
    shutil.rmtree(f"{at}/folders")
    shutil.copytree(f"{at}-before", f"{at}/folders")
    spark.catalog.refreshByPath(f"{at}/folders")
    assert catalogue.update(spark, root, at) == {"folders": 1, "added": 0, "gone": 0}
    assert names() == [("1", "20", 20), ("1", "50", 1), ("2", "10", 10), ("2", "40", 1)]
    # the folder that vanished comes back
    _write(f"{root}/3/data.5", b"12345")
    assert catalogue.update(spark, root, at)["added"] == 1
    assert ("3", "5", 5) in names()
