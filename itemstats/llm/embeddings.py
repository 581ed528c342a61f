"""Embedding near-duplicates by spherical k-means cells and blocked cosine products (operator 5).

Vectors are compared only under equal, non-null labels.  Equal vectors of a label are merged first
into one representative with a count, so a vector repeated by a third of all rows is one row.  A
spherical k-means (fitted on a bounded sample of the representatives of each label) assigns
representatives to their nearest cell.  No link is lost at a cell border: linked vectors are at most
``sqrt(2 - 2 * cosine)`` apart, so one of another cell lies at most that far beyond the plane between
the two centres, and a vector is compared with every cell whose plane is that near.

Vectors are stored once and never copied per cell.  A label of up to ``BLOCK`` representatives is compared in
one task.  A larger one is cut into slices of bounded size; round by round a slice, ordered by cells, is sent
to all tasks, which read the label's vectors of this slice and the later ones where they are stored.  Products are single
precision; those near the threshold are decided in double precision.  A task returns partial link counts and
a spanning forest of its links, never all pairs; components follow from the forests.

Defined cases: null labels, null or zero vectors, and vectors with a null or non-finite component
link with nothing and are kept; vectors of different lengths under one label are compared within
their length; repeated rows with one vec_id count as vectors of their own; a null vec_id
is linked like any other but never names a component; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itemstats.llm import common

COSINE = 0.98
#: Representatives of a label compared in one task; blocks per slice of a larger label.
BLOCK, SLICE = 20_000, 12
#: Numbers in the vectors of a block or slice, and in all slices of a round (64 MB in single precision).
NUMBERS = 16_000_000
#: Representatives per cell aimed at, cells per label at most, and sample rows per cell for the fit.
CELL, CELLS, FIT = 1000, 2048, 20
ROUNDS = 8
#: Numbers in the centres of all labels of a round (32 MB), if it has several.
CENTRE_NUMBERS = 4_000_000
#: Rows of either side of a product.
STRIP = 4096, 1024
FOUND = "a long, b long, n long"


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of an Arrow column of lists without nulls, all of ``width`` numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_cells(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means centres of unit rows, seeded by farthest-first choice; centres have length 1."""
    centres = [x[0]]
    near = x @ centres[0]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(near.argmin())])
        near = np.maximum(near, x @ centres[-1])
    c = np.stack(centres)
    for _ in range(ROUNDS):
        own = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[at : at + 1024] @ c.T).argmax(axis=1) for at in range(0, len(x), 1024)])


def forest(a: np.ndarray, b: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """The pairs that join two sets of a union-find over the ids seen so far."""

    def root(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = i = parent.setdefault(up, up)
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        p, q = root(i), root(j)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((i, j))
    return out


class Cells:
    """Vectors in the order of their cells (one without centres), searched by rows of any vectors."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, n: np.ndarray, centres: np.ndarray | None):
        self.centres = centres
        self.between = None if centres is None else np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        home = np.zeros(len(x), np.int64)
        self.single = np.empty(x.shape, np.float32)
        for at in range(0, len(x), STRIP[0]):
            u = unit(x[at : at + STRIP[0]])
            self.single[at : at + STRIP[0]] = u
            if centres is not None:
                home[at : at + STRIP[0]] = nearest(u, centres)
        order = np.argsort(home, kind="stable")
        self.x, self.single, self.ids, self.n = x[order], self.single[order], ids[order], n[order]
        self.starts = np.searchsorted(home[order], np.arange((1 if centres is None else len(centres)) + 1))
        self.links = np.zeros(len(x), np.int64)
        self.parent = np.arange(len(x))

    def visits(self, u: np.ndarray, cosine: float) -> np.ndarray:
        """Per cell the rows of ``u`` that may link with a vector in it."""
        if self.centres is None:
            return np.ones((1, len(u)), bool)
        out = np.empty((len(self.centres), len(u)), bool)
        reach = np.sqrt(2 - 2 * cosine)
        for at in range(0, len(u), 1024):
            near = u[at : at + 1024] @ self.centres.T
            home = near.argmax(axis=1)
            out[:, at : at + 1024] = (near.max(axis=1, keepdims=True) - near <= reach * self.between[home] + 1e-7).T
        return out

    def find(self, nodes: np.ndarray) -> np.ndarray:
        root = self.parent[nodes]
        while not np.array_equal(up := self.parent[root], root):
            root = up
        self.parent[nodes] = root
        return root

    def join(self, hit: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        """Hits (row, column) that join two sets of the union-find over the nodes ``x`` and ``y``."""
        out = []
        while len(rows := np.flatnonzero((differ := hit & (self.find(x)[:, None] != self.find(y))).any(axis=1))):
            for i, j in zip(rows.tolist(), differ[rows].argmax(axis=1).tolist()):
                p, q = (int(self.find(v[k : k + 1])[0]) for v, k in ((x, i), (y, j)))
                if p != q:
                    self.parent[max(p, q)] = min(p, q)
                    out.append((i, j))
        return out

    def search(self, x: np.ndarray, n: np.ndarray, cosine: float, nodes: np.ndarray | None = None, keys: tuple[np.ndarray, np.ndarray] | None = None):
        """Link counts of the rows ``x`` and a forest (row, position) of their links; adds to ``links``.  ``nodes``: their
        positions, if they are of these vectors; ``keys``: of both sides, only pairs of rising keys count."""
        u = unit(x)
        single, counts, out = u.astype(np.float32), np.zeros(len(x), np.int64), []
        unsure = (x.shape[1] + 8) * 2e-7
        if nodes is None:  # new nodes after all others, so no root lies among them later
            nodes = np.arange(len(self.x), len(self.x) + len(x))
            self.parent = np.concatenate([self.parent[: len(self.x)], nodes])
        for cell, near in enumerate(self.visits(u, cosine)):
            start, end = self.starts[cell : cell + 2]
            if start == end or keys is not None and keys[1][start:end].max() <= keys[0].min():
                continue
            rows = np.flatnonzero(near)
            if not len(rows):
                continue
            own = single[rows]
            for at in range(start, end, STRIP[1]):
                product = own @ self.single[at : min(at + STRIP[1], end)].T
                hit = product >= cosine - unsure
                if not hit.any():
                    continue
                left, right = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                hit, product = hit[np.ix_(left, right)], product[np.ix_(left, right)]
                left, right = rows[left], at + right
                if keys is not None:
                    hit &= keys[0][left][:, None] < keys[1][right]
                i, j = np.nonzero(hit & (product < cosine + unsure))
                for k in range(0, len(i), 16_384):
                    p, q = i[k : k + 16_384], j[k : k + 16_384]
                    hit[p, q] = (u[left[p]] * unit(self.x[right[q]])).sum(axis=1) >= cosine
                weight = hit.astype(np.float64)
                counts[left] += (weight @ self.n[right]).astype(np.int64)
                self.links[right] += (n[left] @ weight).astype(np.int64)
                out += [(left[i], right[j]) for i, j in self.join(hit, nodes[left], right)]
        return counts, np.array(out, np.int64).reshape(-1, 2)


def found(ids: np.ndarray, links: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    """Partial counts (b null) and forest edges (n null)."""
    some, none = links > 0, pa.nulls(len(edges), pa.int64())
    k = int(some.sum())
    columns = [np.concatenate([ids[some], edges[:, 0]]), pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(edges[:, 1], pa.int64())])]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), columns[1], pa.concat_arrays([pa.array(links[some], pa.int64()), none])], names=["a", "b", "n"])


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``."""
    spark = vectors.sparkSession
    scratch = common.Scratch(spark, "vectors")
    e = F.col("embedding")
    good = (
        F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        & F.exists(e, lambda v: v != 0)
    )
    given = vectors.schema[embedding].dataType
    kind = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast(f"array<{kind}>").alias("embedding")
    ).withColumn("embedding", F.transform("embedding", lambda v: v + F.lit(0.0).cast(kind)))  # -0.0 and 0.0 are one value
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    rows = rows.withColumn("key", F.when(F.col("good"), F.unhex(F.sha2(F.to_json(F.struct("label", "embedding")), 256))))
    copies = (
        rows.filter("good").groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first(F.struct("label", "embedding")).alias("v"))
    )  # one label and vector per key
    reps = copies.select("key", "rep", "n", "v.label", "v.embedding", F.size("v.embedding").alias("width"), F.xxhash64("key").alias("id"))
    # by label in small row groups, so that a round reads the rows of its labels only
    reps = scratch.write(reps.sortWithinPartitions("label", "width"), options={"parquet.block.size": 1 << 20, "parquet.enable.dictionary": False})
    rows = scratch.write(rows.select("vec_id", "key"))
    hits = _links(scratch, reps, cosine)
    counts = hits.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    comps = common.components(scratch, hits.filter("b is not null").select("a", "b"))
    # components over hashed ids; their name is the smallest vec_id of their copies
    named = reps.select("key", "rep", "n", "id").join(comps.withColumnRenamed("node", "id"), "id", "left")
    named = scratch.write(named.withColumn("component", F.coalesce("component", "id")).join(counts, "id", "left"))
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("size"))
    named = common.join_keyed(named, names, "component", "size", reps.count())
    out = common.join_keyed(rows.select("vec_id", "key"), named.select("key", "component_id", F.col("links"), F.col("n").alias("copies"), "n"), "key", "n", rows.count())
    own = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), (F.col("vec_id").eqNullSafe(own)).alias("kept"),
    )


def _links(scratch: common.Scratch, reps: DataFrame, cosine: float) -> DataFrame:
    """Partial counts (b null) and forest edges (n null) of all labels."""
    spark, path = scratch.spark, f"{scratch.root}/found"
    held = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(NUMBERS) / F.col("width"))))
    sizes = reps.groupBy("label", "width").count()
    large = sizes.filter(F.col("count") > held).orderBy("label", "width").collect()  # each holds over BLOCK rows or NUMBERS numbers
    small = reps
    if large:
        names = spark.createDataFrame([(r["label"], r["width"]) for r in large], "label string, width int")
        small = reps.join(F.broadcast(names), ["label", "width"], "left_anti")

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        x, ids, n = matrix(rows["embedding"], rows["width"][0].as_py()), rows["id"].to_numpy(), rows["n"].to_numpy()
        k = min(CELLS, -(-len(x) // CELL))
        cells = Cells(x, ids, n, fit_cells(unit(x[: k * FIT]), k) if k > 1 else None)
        edges, place = [], np.arange(len(x))
        for at in range(0, len(x), STRIP[0]):
            part = slice(at, at + STRIP[0])
            counts, own = cells.search(cells.x[part], cells.n[part], cosine, place[part], (place[part], place))
            cells.links[part] += counts
            edges.append(np.stack([cells.ids[at + own[:, 0]], cells.ids[own[:, 1]]], 1))
        return pa.Table.from_batches([found(cells.ids, cells.links, np.concatenate(edges))])

    small = small.select("label", "width", "id", "n", "embedding").groupBy("label", "width").applyInArrow(compare, FOUND)
    small.write.option("compression", "zstd").parquet(path)
    if large:
        centres = _centres(scratch, reps, large)
        for units in _rounds(large):
            _round(reps, centres, units, cosine, path)
    return spark.read.schema(FOUND).parquet(path)


def _cell_count(count: int) -> int:
    return min(CELLS, -(-count // CELL))


def _rounds(large: list) -> list[list[tuple]]:
    """Slices (label, width, slices, slice) of the rounds: bounded numbers, and one slice of a label."""
    out, size, centres = [], 0, 0
    for r in large:
        slices = -(-r["count"] // max(1, min(SLICE * BLOCK, NUMBERS // r["width"])))
        own, fit = r["count"] * r["width"] // slices, _cell_count(r["count"]) * r["width"]
        for s in range(slices):
            if not out or s or size + own > NUMBERS or centres + fit > CENTRE_NUMBERS:
                out.append([])
                size = centres = 0
            out[-1].append((r["label"], r["width"], slices, s))
            size, centres = size + own, centres + fit
    return out


def _centres(scratch: common.Scratch, reps: DataFrame, large: list) -> DataFrame:
    """Centres of the cells of the large labels, each fitted in a task on at most CELLS * FIT rows or so."""
    sizes = scratch.spark.createDataFrame([(r["label"], r["width"], r["count"], _cell_count(r["count"])) for r in large], "label string, width int, count long, k int")
    position = F.col("id").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    sample = reps.join(F.broadcast(sizes), ["label", "width"]).filter(position < F.col("k") * FIT * 1.0 / F.col("count"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        c = fit_cells(unit(np.stack(pdf["embedding"])), int(pdf["k"].iloc[0]))
        return pd.DataFrame({"label": pdf["label"].iloc[0], "width": pdf["width"].iloc[0], "cell": range(len(c)), "centre": list(c)})

    sample = sample.select("label", "width", "k", "id", "embedding")
    return scratch.write(sample.groupBy("label", "width").applyInPandas(fit, "label string, width int, cell int, centre array<double>"))


def _round(reps: DataFrame, centres: DataFrame, units: list[tuple], cosine: float, path: str) -> None:
    """Adds to ``path`` what the slices ``units`` link to in themselves and in the later slices of their labels."""
    spark = reps.sparkSession
    labels = F.col("label").isin([u[0] for u in units])
    wanted = F.broadcast(spark.createDataFrame(units, "label string, width int, slices int, slice int"))
    rows = reps.filter(labels).join(wanted, ["label", "width"]).withColumn("own", F.pmod("id", "slices"))
    table = rows.filter("own = slice").select("label", "width", "id", "n", "embedding").toArrow()
    fitted = centres.filter(labels).join(wanted, ["label", "width"]).orderBy("label", "width", "cell").select("label", "width", "centre").toArrow()

    def parts(t: pa.Table) -> dict[tuple, np.ndarray]:
        return t.select(["label", "width"]).to_pandas().groupby(["label", "width"], sort=False).indices

    own, held = parts(fitted), {}
    for key, at in parts(table).items():
        t, c = table.take(at), fitted["centre"].take(own[key]) if key in own else None
        held[key] = [matrix(t["embedding"], key[1]), t["id"].to_numpy(), t["n"].to_numpy(), None if c is None else unit(matrix(c, key[1]))]
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[tuple, Cells] = {}
        for b in batches:
            keys = b.select(["label", "width", "same"]).to_pandas().groupby(["label", "width", "same"], sort=False).indices
            for (label, width, same), rows in keys.items():
                for at in range(0, len(rows), STRIP[0]):
                    part = b.take(pa.array(rows[at : at + STRIP[0]]))
                    if (label, width) not in cells:
                        cells[label, width] = Cells(*shared.value[label, width])
                    y, ids, n = cells[label, width], part["id"].to_numpy(), part["n"].to_numpy()
                    counts, edges = y.search(matrix(part["embedding"], width), n, cosine, keys=(ids, y.ids) if same else None)
                    yield found(ids, counts, np.stack([ids[edges[:, 0]], y.ids[edges[:, 1]]], 1))
        for y in cells.values():
            yield found(y.ids, y.links, np.zeros((0, 2), np.int64))

    scan = rows.filter("own >= slice").select("label", "width", (F.col("own") == F.col("slice")).alias("same"), "id", "n", "embedding")
    hits = common.map_in_arrow(scan.coalesce(3 * spark.sparkContext.defaultParallelism), run, FOUND)
    hits.write.option("compression", "zstd").mode("append").parquet(path)
    shared.destroy()
