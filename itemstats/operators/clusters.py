"""Student clustering and cluster profiles.

k-means runs for every batch at once as DataFrame work: a Lloyd step is one
join of the students with their batch's (at most ``k``) centroids, a
nearest-centroid choice inside the row, and one ``groupBy(batch, cluster,
position)`` with partial aggregation for the new centroids.  Nothing is
collected; the centroid table is checkpointed every step to cut lineage.

Seeding is k-means++ per batch, also as aggregation: each next seed is the
student with the largest ``ln(u) / d^2`` (weighted sampling by squared
distance to the seeds so far), where ``u`` is a hash of the student key and
the seed, so the choice is reproducible and independent of partitioning.  The
reference used MLlib's randomly seeded k-means||, so its clusters changed from
run to run (D13).  Clusters are finally numbered by ascending mean score.
:func:`parallel_seeds` is k-means|| with the same reproducible draws: its passes over the
samples do not grow with ``k``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemstats.defaults import BAD, CANDIDATE_STEP, GOOD, K, MAX_ITER, RECLUSTER_STEPS, ROUNDS, SEED, TOL
from itemstats.functions.sizing import BROADCAST_BYTES, measured, small_side, stored
from itemstats.functions.students import PARTS, code_parts
from itemstats.operators.reshape import cell, with_papers
from itemstats.session import ensure_checkpoint_dir
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS


def features(sheets: DataFrame, items: DataFrame, include_code: bool = False, missing: str = "propagate") -> DataFrame:
    """Per complete sample: ``scores array<double>`` in item order and ``features``.

    ``features`` is ``scores``, or the four code parts followed by the scores
    with ``include_code=True`` (the reference's vector, D16).  A missing cell
    counts 0 with ``missing="zero"``; otherwise such samples are left out, as are
    those whose code has no numeric parts (:func:`left_out` lists both).
    """
    s = with_papers(sheets, items)
    scores = F.transform("item_ids", lambda i: cell(F.col("cells"), i).cast("double"))
    if missing == "zero":
        scores = F.transform(scores, lambda x: F.coalesce(x, F.lit(0.0)))
    s = s.withColumn("scores", scores).filter(F.forall("scores", lambda x: x.isNotNull()))
    if include_code:
        s = code_parts(s)
        feats = F.concat(F.array(*[F.col(p).cast("double") for p in PARTS]), F.col("scores"))
        s = s.filter(F.col("gc").isNotNull() & F.col("mc").isNotNull() & F.col("cc").isNotNull() & F.col("nc").isNotNull())
    else:
        feats = F.col("scores")
    return s.select(*STUDENT_KEYS, "scores", feats.alias("features"))


def incomplete(sheets: DataFrame, items: DataFrame) -> DataFrame:
    """Samples left out of clustering because a cell is missing."""
    s = with_papers(sheets, items)
    return s.filter(F.exists("item_ids", lambda i: cell(F.col("cells"), i).isNull())).select(*STUDENT_KEYS)


def left_out(sheets: DataFrame, items: DataFrame, include_code: bool = False, missing: str = "propagate") -> DataFrame:
    """Samples without a cluster and why: ``(paper_code, create_time, stu_code, attempt, reason)``,
    reason ``missing cell``, ``no numeric code`` or ``unknown paper``."""
    known = items.select("paper_code").distinct()
    out = sheets.join(small_side(known), "paper_code", "left_anti").select(*STUDENT_KEYS, F.lit("unknown paper").alias("reason"))
    if missing != "zero":
        out = out.unionByName(incomplete(sheets, items).withColumn("reason", F.lit("missing cell")))
    if include_code:
        parts = code_parts(with_papers(sheets, items).select(*STUDENT_KEYS))
        bad = parts.filter(F.col("gc").isNull() | F.col("mc").isNull() | F.col("cc").isNull() | F.col("nc").isNull())
        out = out.unionByName(bad.select(*STUDENT_KEYS, F.lit("no numeric code").alias("reason")))
    return out


def score_bands(df: DataFrame, k: int = K, score: Column | None = None) -> DataFrame:
    """Add ``cluster``: the band of the score sum among ``k`` equal-width bands of the batch,
    ``least(k-1, floor(k * (s - min) / (max - min + 1)))``."""
    s = score if score is not None else F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    df = df.withColumn("_s", s)
    lim = small_side(df.groupBy(*BATCH_KEYS).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi")))
    band = F.floor(F.lit(k) * (F.col("_s") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1))
    return df.join(lim, BATCH_KEYS).withColumn("cluster", F.least(F.lit(k - 1), band).cast("int")).drop(
        "_s", "_lo", "_hi"
    )


def centroids(assigned: DataFrame, vec: str = "features") -> DataFrame:
    """Mean vector of each (batch, cluster): ``(paper_code, create_time, cluster, center, size)``.

    One aggregation with partial sums per vector; papers may have any number of items."""
    agg = assigned.withColumn("_v", array_to_vector(vec)).groupBy(*BATCH_KEYS, "cluster").agg(
        Summarizer.mean(F.col("_v")).alias("_m"), F.count(F.lit(1)).alias("size")
    )
    return agg.select(*BATCH_KEYS, "cluster", vector_to_array("_m").alias("center"), "size")


def _sqdist(x: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def assign(feats: DataFrame, cents: DataFrame, vec: str = "features", digits: int | None = None,
           small: bool | None = None) -> DataFrame:
    """Add ``cluster`` and ``distance`` (squared Euclidean) of the nearest centroid of the batch;
    ties go to the smaller cluster id.  ``digits`` rounds distances before the choice.

    The centroid list (one row per batch) is broadcast after a size check, or as
    ``small`` says when the caller already knows its bound."""
    per_batch = cents.groupBy(*BATCH_KEYS).agg(F.collect_list(F.struct("cluster", "center")).alias("_cs"))
    if small is None:
        per_batch = small_side(per_batch)
    elif small:
        per_batch = F.broadcast(per_batch)

    def dist(c: Column) -> Column:
        d = _sqdist(F.col(vec), c["center"])
        return F.round(d, digits) if digits is not None else d

    best = F.array_min(F.transform("_cs", lambda c: F.struct(dist(c).alias("d"), c["cluster"].alias("c"))))
    return (
        feats.join(per_batch, BATCH_KEYS)
        .withColumn("_best", best)
        .select(*feats.columns, F.col("_best.c").alias("cluster"), F.col("_best.d").alias("distance"))
    )


def _hashed(*columns: str, seed: int, step: int) -> Column:
    """A reproducible uniform number in (0, 1) per row, seed and step: 48 bits of an MD5 digest of
    ``columns``, the same in any engine."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)), F.lit(str(step)))
    h = F.conv(F.substring(F.md5(text), 1, 12), 16, 10)
    return (h.cast("double") + 0.5) / float(1 << 48)


def _uniform(seed: int, step: int) -> Column:
    return _hashed("stu_code", "attempt", seed=seed, step=step)


def _centroids_small(cents: DataFrame) -> bool:
    """Whether the first step's centroids, times the ``K`` there may be, stay under the broadcast bound."""
    return measured(cents)[1] * K <= BROADCAST_BYTES


def seeds(feats: DataFrame, k: int = K, seed: int = SEED, vec: str = "features") -> DataFrame:
    """k-means++ seeding for every batch at once: ``(paper_code, create_time, cluster, center)``.

    Each step is one pass: distance of every sample to the nearest seed so far,
    then ``max_by(features, ln(u) / d^2)`` per batch (partial aggregation, no
    batch gathered in one task).  Samples equal to a seed are never picked, so
    a batch with fewer than ``k`` distinct points gets fewer seeds.
    """
    first = feats.withColumn("_key", _uniform(seed, 0)).groupBy(*BATCH_KEYS).agg(
        F.max_by(vec, "_key").alias("center")
    )
    cents = stored(first.withColumn("cluster", F.lit(0)))
    small = _centroids_small(cents)
    for j in range(1, k):
        d = assign(feats, cents, vec, small=small).filter(F.col("distance") > 0)
        nxt = d.withColumn("_key", F.log(_uniform(seed, j)) / F.col("distance")).groupBy(*BATCH_KEYS).agg(
            F.max_by(vec, "_key").alias("center")
        )
        cents = stored(cents.unionByName(nxt.withColumn("cluster", F.lit(j))))
    return cents


def _candidates(feats: DataFrame, k: int, seed: int, vec: str) -> DataFrame:
    """Candidate seeds of every batch, ``(paper_code, create_time, cluster, center)``, by oversampling.

    From one sample, each round takes every sample with probability ``2 k d^2 / cost`` on its own, so
    a batch has about ``2 k ROUNDS + 1`` candidates; equal vectors are one candidate."""
    first = feats.withColumn("_key", _uniform(seed, 0)).groupBy(*BATCH_KEYS).agg(F.max_by(vec, "_key").alias("center"))
    found = stored(first)
    for r in range(1, ROUNDS + 1):
        near = assign(feats, _numbered(found), vec).filter(F.col("distance") > 0)
        cost = small_side(near.groupBy(*BATCH_KEYS).agg(F.sum("distance").alias("_cost")))
        drawn = near.join(cost, BATCH_KEYS).filter(_uniform(seed, r) < F.lit(float(2 * k)) * F.col("distance") / F.col("_cost"))
        found = stored(found.unionByName(drawn.select(*BATCH_KEYS, F.col(vec).alias("center"))).distinct())
    return _numbered(found)


def _numbered(centers: DataFrame) -> DataFrame:
    order = Window.partitionBy(*BATCH_KEYS).orderBy("center")  # the candidates of one batch
    return centers.withColumn("cluster", (F.row_number().over(order) - 1).cast("int"))


def parallel_seeds(feats: DataFrame, k: int = K, seed: int = SEED, vec: str = "features") -> DataFrame:
    """k-means|| seeding for every batch at once: ``(paper_code, create_time, cluster, center)``.

    ``ROUNDS`` rounds of oversampling (:func:`_candidates`) and one pass that weighs each candidate with
    the samples nearest to it: ``2 ROUNDS + 2`` passes over the samples for any ``k``.  The weighted
    candidates, a table of a few rows a batch, are then clustered: k-means++ by weight and squared
    distance, and ``RECLUSTER_STEPS`` weighted Lloyd steps.  A batch with fewer than ``k`` candidates
    gets fewer seeds."""
    ensure_checkpoint_dir(feats.sparkSession)
    cand = stored(_candidates(feats, k, seed, vec))
    weights = assign(feats, cand, vec).groupBy(*BATCH_KEYS, "cluster").agg(F.count(F.lit(1)).cast("double").alias("w"))
    points = cand.join(weights, [*BATCH_KEYS, "cluster"])
    points = stored(points.select(*BATCH_KEYS, F.col("cluster").alias("id"), F.col("center").alias("point"), "w"))

    def draw(step: int) -> Column:
        return F.log(_hashed(*BATCH_KEYS, "id", seed=seed, step=CANDIDATE_STEP + step))

    cents = points.groupBy(*BATCH_KEYS).agg(F.max_by("point", draw(0) / F.col("w")).alias("center"))
    cents = stored(cents.withColumn("cluster", F.lit(0)))
    for j in range(1, k):
        d = assign(points, cents, "point").filter(F.col("distance") > 0)
        nxt = d.groupBy(*BATCH_KEYS).agg(F.max_by("point", draw(j) / (F.col("w") * F.col("distance"))).alias("center"))
        cents = stored(cents.unionByName(nxt.withColumn("cluster", F.lit(j))))
    for _ in range(RECLUSTER_STEPS):
        own = assign(points, cents, "point").withColumn("_v", array_to_vector("point"))
        mean = own.groupBy(*BATCH_KEYS, "cluster").agg(Summarizer.mean(F.col("_v"), F.col("w")).alias("_m"))
        cents = stored(mean.select(*BATCH_KEYS, "cluster", vector_to_array("_m").alias("center")))
    return cents


#: Ways to choose the first centroids.
SEEDINGS = {"++": seeds, "||": parallel_seeds}


def fit(feats: DataFrame, k: int = K, max_iter: int = MAX_ITER, tol: float = TOL, seed: int = SEED, init: str = "++") -> DataFrame:
    """Lloyd's k-means per batch; returns the centroids ``(batch, cluster, center, size)``.

    ``init``: ``"++"`` (k-means++, a pass per seed) or ``"||"`` (k-means||, for many clusters).

    Stops when no centroid moves more than ``tol`` (Euclidean) or after
    ``max_iter`` steps.  Each step's centroids are stored below the
    session's ``spark.checkpoint.dir``.
    """
    ensure_checkpoint_dir(feats.sparkSession)
    cents = SEEDINGS[init](feats, k, seed)
    small = _centroids_small(cents.filter("cluster = 0"))
    for _ in range(max_iter):
        # a step's centroids are stored with their move; a cluster that appeared or emptied moved infinitely far
        old = cents.select(*BATCH_KEYS, "cluster", F.col("center").alias("_old"))
        new = centroids(assign(feats, cents, small=small)).join(old, [*BATCH_KEYS, "cluster"], "full_outer")
        far = F.sqrt(_sqdist(F.col("center"), F.col("_old")))
        new = new.withColumn("_move", F.when(F.col("center").isNull() | F.col("_old").isNull(), F.lit(float("inf"))).otherwise(far))
        new = stored(new.drop("_old"))
        shift = new.agg(F.max("_move")).first()[0]
        cents = new.filter(F.col("center").isNotNull()).drop("_move")
        if shift is None or shift <= tol:
            break
    return cents


def relabel(assigned: DataFrame) -> DataFrame:
    """Renumber clusters 0.. within each batch by ascending mean score sum (ties: old id)."""
    s = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    stats = assigned.withColumn("_s", s).groupBy(*BATCH_KEYS, "cluster").agg(F.avg("_s").alias("_mean"))
    order = Window.partitionBy(*BATCH_KEYS).orderBy("_mean", "cluster")  # at most k rows per batch
    mapping = small_side(stats.withColumn("_new", (F.row_number().over(order) - 1).cast("int")).drop("_mean"))
    return assigned.join(mapping, [*BATCH_KEYS, "cluster"]).withColumn("cluster", F.col("_new")).drop("_new")


def profile(assigned: DataFrame, items: DataFrame, good: tuple[float, float] = GOOD,
            bad: tuple[float, float] = BAD) -> DataFrame:
    """The ``t_item_cluster`` rows: per sample its cluster's strong and weak items.

    Per (batch, cluster, item) ``P = sum(score) / (full mark * cluster size)``;
    ``good_item`` lists ids with ``good[0] <= P <= good[1]``, ``bad_item`` those
    with ``bad[0] <= P <= bad[1]``, ascending and comma-joined; ``centers`` is the
    cluster number.  ``assigned`` carries ``scores`` (item order) and ``cluster``.
    """
    pos_items = items.select("paper_code", "item_id", "full_mark").withColumn(
        "_pos", (F.row_number().over(Window.partitionBy("paper_code").orderBy("item_id")) - 1).cast("int")
    )
    cells = assigned.select(*BATCH_KEYS, "cluster", F.posexplode("scores").alias("_pos", "_x"))
    per_item = cells.groupBy(*BATCH_KEYS, "cluster", "_pos").agg(F.sum("_x").alias("_sum"), F.count("_x").alias("_n"))
    p = per_item.join(pos_items, ["paper_code", "_pos"]).withColumn(
        "_p", F.col("_sum") / (F.col("full_mark") * F.col("_n"))
    )

    def ids(lo: float, hi: float) -> Column:
        return F.array_join(
            F.array_sort(F.collect_list(F.when(F.col("_p").between(lo, hi), F.col("item_id")))).cast("array<string>"), ","
        )

    lists = small_side(p.groupBy(*BATCH_KEYS, "cluster").agg(ids(*good).alias("good_item"), ids(*bad).alias("bad_item")))
    return assigned.select(*STUDENT_KEYS, "cluster").join(lists, [*BATCH_KEYS, "cluster"]).select(
        *STUDENT_KEYS, "good_item", "bad_item", F.col("cluster").alias("centers")
    )


def run(sheets: DataFrame, items: DataFrame, k: int = K, max_iter: int = MAX_ITER, tol: float = TOL,
        include_code: bool = False, seed: int = SEED, missing: str = "propagate", init: str = "++") -> tuple[DataFrame, DataFrame]:
    """Features -> k-means -> relabelled assignment -> profile.  Returns ``(profile, assigned)``."""
    ensure_checkpoint_dir(sheets.sparkSession)
    feats = stored(features(sheets, items, include_code, missing))
    cents = fit(feats, k, max_iter, tol, seed, init)
    assigned = relabel(assign(feats, cents, small=_centroids_small(cents.filter("cluster = 0"))))
    return profile(assigned, items), assigned


def centers_by_item(assigned: DataFrame, items: DataFrame) -> DataFrame:
    """Cluster centres as rows ``(paper_code, create_time, cluster, item_id, center)``: the
    mean score of every item in every cluster (M11), from the final assignment."""
    pos_items = small_side(
        items.select("paper_code", "item_id").withColumn(
            "_pos", (F.row_number().over(Window.partitionBy("paper_code").orderBy("item_id")) - 1).cast("int")
        )
    )
    cells = assigned.select(*BATCH_KEYS, "cluster", F.posexplode("scores").alias("_pos", "_x"))
    means = cells.groupBy(*BATCH_KEYS, "cluster", "_pos").agg(F.avg("_x").alias("center"))
    return means.join(pos_items, ["paper_code", "_pos"]).select(*BATCH_KEYS, "cluster", "item_id", "center")


def summary(assigned: DataFrame) -> DataFrame:
    """Per batch: number of clusters found and their sizes."""
    sizes = assigned.groupBy(*BATCH_KEYS, "cluster").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("clusters"),
        F.array_sort(F.collect_list(F.struct("cluster", "size"))).alias("sizes"),
    )
