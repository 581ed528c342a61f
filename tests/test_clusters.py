"""Clustering: k-means per batch, relabelling, profiles."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import blueprint, responses
from itemstats.functions.students import code_parts, join_code
from itemstats.operators import clusters, reshape

BP = [("P", 1, "subjective", 2, 10)]


def _sheets(spark, pts, paper="P"):
    rows = []
    for i, (x, y) in enumerate(pts):
        rows += [(paper, f"0101{i:04d}", 1, x), (paper, f"0101{i:04d}", 2, y)]
    return reshape.answer_sheets(responses(spark, rows))


def test_kmeans_finds_separated_groups_and_is_deterministic(spark):
    pts = [(1, 1), (1, 2), (2, 1), (9, 9), (9, 8), (8, 9), (1, 9), (2, 9), (9, 1), (9, 2)]
    items = reshape.blueprint_items(blueprint(spark, BP))
    sheets = _sheets(spark, pts)
    prof, assigned = clusters.run(sheets, items, k=4)
    a = {r.stu_code: r.cluster for r in assigned.collect()}
    groups = {}
    for i, p in enumerate(pts):
        groups.setdefault(a[f"0101{i:04d}"], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, [
        {(1, 1), (1, 2), (2, 1)}, {(9, 9), (9, 8), (8, 9)}, {(1, 9), (2, 9)}, {(9, 1), (9, 2)}]))
    assert a[f"0101{0:04d}"] == 0 and a[f"0101{3:04d}"] == 3          # numbered by mean score
    _, again = clusters.run(sheets.repartition(3), items, k=4)
    assert {r.stu_code: r.cluster for r in again.collect()} == a
    sizes = {r.cluster: r.size for r in clusters.summary(assigned).collect()[0]["sizes"]}
    assert sorted(sizes.values()) == [2, 2, 3, 3]


def test_fewer_students_than_k_and_incomplete(spark):
    items = reshape.blueprint_items(blueprint(spark, BP))
    rows = [("P", "a", 1, 5), ("P", "a", 2, 5), ("P", "b", 1, 5), ("P", "b", 2, 5), ("P", "c", 1, 3)]
    sheets = reshape.answer_sheets(responses(spark, rows))
    prof, assigned = clusters.run(sheets, items, k=4)
    assert assigned.count() == 2 and {r.cluster for r in assigned.collect()} == {0}
    assert [r.stu_code for r in clusters.incomplete(sheets, items).collect()] == ["c"]


def test_profile_good_and_bad_items(spark):
    bp = [("P", 1, "objective", 1, 10), ("P", 2, "subjective", 2, 10)]
    items = reshape.blueprint_items(blueprint(spark, bp))
    rows = []
    for s, (a, b, c) in {"x": (7, 2, 5), "y": (8, 3, 5)}.items():
        rows += [("P", s, 1, a), ("P", s, 2, b), ("P", s, 3, c)]
    feats = clusters.features(reshape.answer_sheets(responses(spark, rows)), items)
    given = feats.withColumn("cluster", F.lit(0))
    got = {r.stu_code: (r.good_item, r.bad_item, r.centers) for r in clusters.profile(given, items).collect()}
    # P(item1) = 0.75, P(item2) = 0.25, P(item3) = 0.5
    assert got == {"x": ("1", "2", 0), "y": ("1", "2", 0)}


def test_code_parts_round_trip(spark):
    df = spark.createDataFrame([("01020304",), ("10070809",), ("ab020304",)], "stu_code string")
    rows = code_parts(df).withColumn("back", join_code(*[F.col(c) for c in ("gc", "mc", "cc", "nc")])).collect()
    got = {r.stu_code: (r.gc, r.mc, r.cc, r.nc, r.back) for r in rows}
    assert got["01020304"] == (1, 2, 3, 4, "01020304")
    assert got["10070809"] == (10, 7, 8, 9, "10070809")
    assert got["ab020304"][0] is None and got["ab020304"][4] is None


def test_code_parts_as_features(spark):
    items = reshape.blueprint_items(blueprint(spark, BP))
    rows = [("P", "01020304", 1, 5), ("P", "01020304", 2, 6), ("P", "0x020304", 1, 1), ("P", "0x020304", 2, 1)]
    feats = clusters.features(reshape.answer_sheets(responses(spark, rows)), items, include_code=True).collect()
    assert [(r.stu_code, r.features, r.scores) for r in feats] == [("01020304", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [5.0, 6.0])]


def test_centers_by_item(spark):
    items = reshape.blueprint_items(blueprint(spark, BP))
    feats = clusters.features(_sheets(spark, [(1, 2), (3, 4), (9, 9)]), items)
    given = feats.withColumn("cluster", F.when(F.col("stu_code") == "01010002", 1).otherwise(0))
    got = {(r.cluster, r.item_id): r.center for r in clusters.centers_by_item(given, items).collect()}
    assert got == {(0, 1): 2.0, (0, 2): 3.0, (1, 1): 9.0, (1, 2): 9.0}


def test_parallel_seeds(spark, monkeypatch):
    """As good as k-means++ seeds, the same for any partitioning, passes over the samples independent of k."""
    rnd = random.Random(4)
    pts = [(min(10, max(0, round(rnd.gauss(x, 1)))), min(10, max(0, round(rnd.gauss(y, 1))))) for x, y in [(2, 2), (8, 8), (2, 8), (8, 2)] for _ in range(60)]
    items = reshape.blueprint_items(blueprint(spark, BP))
    feats = clusters.features(_sheets(spark, pts), items).cache()
    passes, assign = [], clusters.assign
    monkeypatch.setattr(clusters, "assign", lambda df, *a, **k: (passes.append("stu_code" in df.columns), assign(df, *a, **k))[1])

    def cost(cents):
        return assign(feats, cents).agg(F.sum("distance")).first()[0]

    for k in (2, 6):
        passes.clear()
        got = clusters.parallel_seeds(feats, k)
        assert sum(passes) == clusters.ROUNDS + 1 and got.count() == k
    assert cost(got) <= 1.02 * cost(clusters.seeds(feats, 6))
    again = clusters.parallel_seeds(feats.repartition(5), 6)
    rounded = lambda df: sorted((r["cluster"], [round(x, 9) for x in r["center"]]) for r in df.collect())
    assert rounded(again) == rounded(got)
    few = feats.limit(0).unionByName(feats.filter("features = array(2.0D, 2.0D)"))
    assert clusters.parallel_seeds(few, 4).count() == 1 and clusters.parallel_seeds(feats.limit(0), 4).count() == 0
    feats.unpersist()
