"""Set-similarity self-join of documents on word shingles by prefix trees (operator 1).

A document's set holds its distinct ``words``-word shingles (the whole word sequence if it has fewer
words).  Two documents link when the Jaccard similarity of their sets is at least the threshold.

1. One pass over the texts gives per document the set size and a 128-bit digest of the set, and per
   run of sets the shingles that several distinct sets share.  Documents with equal digests are one class,
   named by half of the digest; one document of a class, that with the smallest id, goes on.  Two bounded tables fix
   the global order: shingles of rarer words first (by the counts of ``WORD_BUCKETS`` buckets of words), then by hash,
   and the ``FREQUENT`` shingles shared most at the end by rising count.  They only order; any tables give the same result.
2. A second pass emits the prefix of every class: by the prefix filter, sets of sizes n <= m that link
   share at least ``extra(n)`` shingles among the first ``n - ceil(t n) + extra(n)`` of either.
   Classes meeting in a shingle become candidate pairs, counted over all shingles they meet in.  A
   shingle with more than ``STAR`` classes is never expanded into its pairs: where its classes hold so many of
   such shingles that a link could consist of them, each is tied to the smallest one of its band of sizes, and
   connected whatever the count; any other class must meet its links in the remaining ones too, and is counted there.
   So documents that only have a passage in common fall into no group.
3. Candidates fall into connected groups.  The sets of a group, globally ordered, are stored in a
   prefix tree whose chains are folded; every set walks the tree level by level from the root, shares
   the overlap counted so far among all sets below a node, and drops a subtree when even its longest
   remainder could not reach the needed overlap.  Groups over ``BLOCK`` sets are split into blocks: each is walked by
   itself and against the first one; then sets outside the largest component so far are walked against all
   others.  In a group of near copies these are few, so what is sent to tasks grows with the group, not with its
   square.  Only a spanning forest of the links leaves a task.
4. Components of the links, joined back to the classes, then to all documents.

Word hashes are 64 bits; two shingles are taken as equal when the combined hashes are.

Defined cases: a null text and one without words have size 0 and link with nothing, nor with each
other; long texts are handled whole; every row is a document of its own, also one of several with a doc_id (their
texts link only by their sets); a component without any doc_id has a null component_id; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemstats.llm import common
from itemstats.llm.embeddings import forest

WORDS = 5
#: The threshold as a fraction, so that every comparison is exact.
OVER, UNDER = 80, 100
#: Shingles ordered last (a bounded table of the most shared ones).
FREQUENT = 200_000
STAR = 32
#: Prefix shingles that linked sets share at least, as far as they are that large; a twentieth of the set comes on top.
LEAST = 4
#: Shingles and sets over which shared ones are counted, and prefix shingles returned at once, in a task.
SHARED_TOKENS, SHARED_SETS, POSTINGS = 2_000_000, 10_000, 250_000
#: Classes with heavy shingles up to which they are broadcast (16 bytes each).
BROADCAST = 500_000
#: Buckets of words, by the highest bits of their hashes, whose counts grade the shingles.
WORD_BUCKETS, WORD_SHIFT = 1 << 16, np.uint64(48)
#: Sets per tree walk.
BLOCK = 1000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str) -> np.ndarray:
    """Hash of every word: A-Z lower-cased, words split at blank, tab, line and page breaks."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _windows(h: np.ndarray, words: int) -> np.ndarray:
    """Shingle hashes by place, of at least one word."""
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return _distinct(word_hashes(text) if text else np.zeros(0, np.uint64), words)


def _distinct(h: np.ndarray, words: int = WORDS) -> np.ndarray:
    if not len(h):
        return h
    out = _windows(h, words)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def graded(text: str | None, grades: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text and the sum of the grades of each one's words."""
    h = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(h):
        return h, np.zeros(0, np.int64)
    out = _windows(h, words)
    own = grades[h >> WORD_SHIFT]
    total = sum(own[i : i + len(out)] for i in range(min(words, len(h))))
    order = np.argsort(out, kind="stable")
    out = out[order]
    first = np.concatenate([[True], out[1:] != out[:-1]])
    return out[first], total[order][first]


def need(n: int | np.ndarray, m: int | np.ndarray):
    """Smallest overlap with which sets of sizes n and m link."""
    return -(-(OVER * (n + m)) // (OVER + UNDER))


def extra(n: int) -> int:
    """Prefix shingles that a linked set of size n must share: the plain prefix filter asks for 1."""
    return min(LEAST + n // 20, -(-OVER * n // UNDER))


def prefix_size(n: int) -> int:
    return min(n, n - -(-OVER * n // UNDER) + extra(n))


def rank(tokens: np.ndarray, grade: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Positions that sort ``tokens`` globally: by the grade of their words, then by hash; the frequent ones
    last, by their place there."""
    at = np.searchsorted(frequent["token"], tokens)
    at[at == len(frequent)] = 0
    known = frequent["token"][at] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    place = np.where(known, frequent["place"][at] + 1, 0) if len(frequent) else np.zeros(len(tokens), np.int64)
    return np.lexsort((tokens, np.where(place > 0, 0, grade), place))


def _digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_key, n, digest halves; rows (token, count) of shared shingles; and rows
    (word, count) of the buckets of words that a task meets more often than the mean bucket."""

    names = ["doc_id", "text_key", "n", "one", "two", "token", "times", "word"]

    def batch(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], pa.int64()) if c in columns else pa.nulls(size, pa.int64()) for c in names], names=names)

    def shared(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate(held)
        tokens.sort()
        # all but the last two of each run: only tokens of more than two sets
        tokens, times = np.unique(tokens[:-2][tokens[2:] == tokens[:-2]], return_counts=True)
        return batch(token=tokens.view(np.int64), times=times + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0  # over several batches, whatever their rows
        words, counted = [], np.zeros(WORD_BUCKETS, np.int64)
        for b in batches:
            n, one, two = [], [], []
            for t in b.column(1):
                h = word_hashes(t) if (t := t.as_py()) else np.zeros(0, np.uint64)
                s = _distinct(h)
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                one.append((digest >> 64) - (1 << 63))
                two.append((digest & ((1 << 64) - 1)) - (1 << 63))
                if digest not in seen:
                    seen.add(digest)
                    held.append(s)
                    size += len(s)
                    words.append((h >> WORD_SHIFT).astype(np.uint16))
                    if size > SHARED_TOKENS or len(held) >= SHARED_SETS:
                        yield shared(held)
                        counted += np.bincount(np.concatenate(words), minlength=WORD_BUCKETS)
                        seen, held, size, words = set(), [], 0, []
            yield batch(doc_id=b.column(0), text_key=b.column(2), n=n, one=one, two=two)
        if held:
            yield shared(held)
            counted += np.bincount(np.concatenate(words), minlength=WORD_BUCKETS)
        often = np.flatnonzero(counted * WORD_BUCKETS > counted.sum())
        yield batch(word=often, times=counted[often])

    return common.map_in_arrow(docs.select("doc_id", "text", "text_key"), run, ", ".join(f"{c} long" for c in names))


def _frequent(rows: DataFrame) -> np.ndarray:
    top = rows.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    top = top.orderBy(F.desc("times"), "token").limit(FREQUENT).toPandas()  # bounded by FREQUENT
    out = np.zeros(len(top), [("token", np.uint64), ("place", np.int64)])
    out["token"], out["place"] = top["token"].to_numpy(np.int64).view(np.uint64), np.arange(len(top), 0, -1)
    out.sort(order="token")
    return out


def _grades(rows: DataFrame) -> np.ndarray:
    """Per bucket of words how common it is: the binary logarithm of its share over that of the mean bucket,
    0 for the others.  Shares don't depend on the number of documents, so neither does the order."""
    often = rows.filter("word is not null").groupBy("word").agg(F.sum("times").alias("times")).toPandas()  # at most WORD_BUCKETS
    out, times = np.zeros(WORD_BUCKETS, np.int64), often["times"].to_numpy(np.float64)
    out[often["word"].to_numpy(np.int64)] = 1 + np.log2(np.maximum(times * WORD_BUCKETS / max(times.sum(), 1), 1))
    return out


class Tree:
    """Ordered sets in a prefix tree with folded chains: nodes in breadth-first order."""

    def __init__(self, sets: list[np.ndarray]):
        # sets hold local token numbers in global order, sorted lexicographically
        self.sets = sets
        current = [(0, len(sets), 0, -1)]  # sets [a, b) share their first ``depth`` tokens
        nodes = []  # parent, first set, last set, from depth, to depth
        while current:
            following = []
            for a, b, depth, parent in current:
                while a < b and len(sets[a]) == depth:
                    a += 1  # ends at the parent
                while a < b:
                    token, c = sets[a][depth], a + 1
                    c = self.last(a, b, depth, token)
                    end = self.common(sets[a], sets[c - 1], depth)
                    nodes.append((parent, a, c, depth, end))
                    if c - a > 1 or end < len(sets[a]):
                        following.append((a, c, end, len(nodes) - 1))
                    a = c
            current = following
        self.parent, self.first, self.last_, self.start, self.end = (np.array(x, np.int64) for x in zip(*nodes))
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.longest = np.array([self.sizes[a:b].max() for a, b in zip(self.first, self.last_)], np.int64)
        self.shortest = np.array([self.sizes[a:b].min() for a, b in zip(self.first, self.last_)], np.int64)
        self.tokens = np.concatenate([sets[a][i:j] for a, i, j in zip(self.first, self.start, self.end)])
        width = self.end - self.start
        self.offset = np.concatenate([[0], np.cumsum(width)])
        kids: dict[int, list[int]] = {}
        for i, p in enumerate(self.parent.tolist()):
            kids.setdefault(p, []).append(i)
        self.kids = {p: np.array(v) for p, v in kids.items()}

    def last(self, a: int, b: int, depth: int, token: int) -> int:
        """End of the run of sets in [a, b) with ``token`` at ``depth``."""
        low, high = a + 1, b
        while low < high:
            mid = (low + high) // 2
            if self.sets[mid][depth] == token:
                low = mid + 1
            else:
                high = mid
        return low

    @staticmethod
    def common(x: np.ndarray, y: np.ndarray, depth: int) -> int:
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[depth:n] != y[depth:n])
        return depth + int(differ[0]) if len(differ) else n

    def walk(self, own: np.ndarray, mark: np.ndarray, after: int) -> list[int]:
        """Sets (numbers over ``after``) that link with the set ``own``; ``mark`` is a scratch array
        over all tokens, false everywhere."""
        mark[own] = True
        rank_of = len(own)
        found = []
        nodes, overlap = self.kids.get(-1, np.zeros(0, np.int64)), None
        overlap = np.zeros(len(nodes), np.int64)
        while len(nodes):
            live = self.last_[nodes] - 1 > after
            nodes, overlap = nodes[live], overlap[live]
            if not len(nodes):
                break
            lens = self.end[nodes] - self.start[nodes]
            at = np.repeat(self.offset[nodes] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
            overlap = overlap + np.add.reduceat(mark[self.tokens[at]].astype(np.int64), np.concatenate([[0], np.cumsum(lens)[:-1]]))
            # the rest of the subtree adds at most its longest remainder, and at most what is left of the own set
            most = np.minimum(overlap + self.longest[nodes] - self.end[nodes], rank_of)
            keep = most >= need(rank_of, self.shortest[nodes])
            nodes, overlap = nodes[keep], overlap[keep]
            following, shared = [], []
            for node, o in zip(nodes.tolist(), overlap.tolist()):
                a, b, end = self.first[node], self.last_[node], self.end[node]
                while a < b and self.sizes[a] == end:
                    if a > after and o >= need(rank_of, int(end)):
                        found.append(int(a))
                    a += 1
                if (kids := self.kids.get(node)) is not None:
                    following.append(kids)
                    shared.append(np.full(len(kids), o))
            nodes = np.concatenate(following) if following else np.zeros(0, np.int64)
            overlap = np.concatenate(shared) if shared else nodes
        mark[own] = False
        return found


def tree_links(ids: np.ndarray, sets: list[np.ndarray], probes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links among the sets; with ``probes`` (a mask), of the links between
    the sets outside it, which form the tree, and those inside it.

    Order in the tree: shingles of most sets first, so that near copies share long paths."""
    tokens, times = np.unique(np.concatenate(sets), return_counts=True)
    place = np.empty(len(tokens), np.int32 if len(tokens) < 1 << 31 else np.int64)
    place[np.lexsort((tokens, -times))] = np.arange(len(tokens))
    local = [np.sort(place[np.searchsorted(tokens, s)]) for s in sets]  # set by set: no copy of all at once
    order = sorted(range(len(sets)), key=lambda i: local[i].astype(">u4").tobytes())
    mark, parent = np.zeros(len(tokens), bool), {}
    out: list[tuple[int, int]] = []
    if probes is None:
        tree = Tree([local[i] for i in order])
        for k, i in enumerate(order):
            hits = tree.walk(local[i], mark, k)
            out += forest(np.full(len(hits), ids[i]), ids[[order[h] for h in hits]] if hits else np.zeros(0, np.int64), parent)
        return out
    stored = [i for i in order if not probes[i]]
    if not stored:
        return out
    tree = Tree([local[i] for i in stored])
    for i in np.flatnonzero(probes).tolist():
        hits = tree.walk(local[i], mark, -1)
        out += forest(np.full(len(hits), ids[i]), ids[[stored[h] for h in hits]] if hits else np.zeros(0, np.int64), parent)
    return out


def text_key(text: Column) -> Column:
    """Name of a text in the results of :func:`join`."""
    return F.xxhash64(text.cast("string"))


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key, component`` per row of ``docs``; ``component`` names
    its group also where no row of it has a doc_id (null without words)."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "ngrams")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    docs = docs.withColumn("text_key", text_key(F.col("text")))
    first = scratch.write(_digests(docs))
    frequent = _frequent(first)
    rows = first.filter("n is not null").select("doc_id", "text_key", "n", F.struct("one", "two").alias("set"))
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("rep")
    classes = rows.filter("n > 0").groupBy("set", "n").agg(rep, F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    classes = scratch.write(classes.withColumn("one", F.col("set.one")))
    candidates = _candidates(scratch, _postings(docs, frequent, _grades(first)))
    groups = common.components(scratch, candidates).withColumnRenamed("node", "one")
    reps = groups.join(classes.select("one", "rep.doc_id", "rep.text_key"), "one").distinct()
    links = scratch.write(_links(scratch, docs, scratch.write(reps)))
    linked = scratch.write(common.components(scratch, links).withColumnRenamed("node", "one").join(classes.select("one", "low"), "one"))
    lowest = scratch.write(linked.groupBy("component").agg(F.min("low").alias("least"), F.count("*").alias("members")))
    linked = common.join_keyed(linked, lowest, "component", "members", linked.count()).select("one", "component", "least")
    named = classes.join(linked, "one", "left")
    least = F.when(F.col("component").isNull(), F.col("low")).otherwise(F.col("least"))
    named = scratch.write(named.select("set", least.alias("component_id"), F.coalesce("component", "one").alias("component"), "copies"))
    keyed = rows.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("set")).alias("set"))
    out = common.join_keyed(keyed, named, "set", "copies", rows.count())
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", "component")


def _postings(docs: DataFrame, frequent: np.ndarray, grades: np.ndarray) -> DataFrame:
    """(token, class, n) for every prefix shingle of every class, once per task and class."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, grades))  # at most FREQUENT and WORD_BUCKETS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            held, size = [], 0
            for t in b.column(0):
                s, grade = graded(t.as_py(), shared.value[1])
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                if len(s) and digest not in seen:
                    seen.add(digest)
                    prefix = s[rank(s, grade, shared.value[0])[: prefix_size(len(s))]].view(np.int64)
                    held.append((prefix, (digest >> 64) - (1 << 63), len(s)))
                    size += len(prefix)
                    if size > POSTINGS:
                        yield pack(held)
                        held, size = [], 0
            if held:
                yield pack(held)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        lens = [len(p) for p, _, _ in held]
        columns = [np.concatenate([p for p, _, _ in held]), np.repeat([c for _, c, _ in held], lens), np.repeat([n for _, _, n in held], lens)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["token", "class", "n"])

    return common.map_in_arrow(docs.select("text"), run, "token long, class long, n long")


def _candidates(scratch: common.Scratch, postings: DataFrame) -> DataFrame:
    """Edges (a, b) such that linked classes are in one connected group.  One shuffle by token."""
    n = max(common.partitions(scratch.spark), 1)
    own = postings.repartition(n, "token").distinct()
    by = own.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1")
    met = scratch.write(own.join(by.hint("merge"), "token"))
    # of a class: its shingles shared by more than STAR classes, and whether a link could consist of them
    heavy = scratch.write(met.filter(F.col("times") > STAR).groupBy("class").agg(F.count("*").alias("heavy")))
    heavy = F.broadcast(heavy) if heavy.count() <= BROADCAST else heavy.hint("merge")
    rows = met.join(heavy, "class", "left").withColumn("heavy", F.coalesce("heavy", F.lit(0)))
    rows = rows.withColumn("tied", F.col("heavy") >= _extra(F.ceil(F.col("n") * OVER / UNDER)))
    few = rows.filter(F.col("times") <= STAR).groupBy("token").agg(F.sort_array(F.collect_list(F.struct("class", "n", "heavy", "tied"))).alias("g"))  # at most STAR
    pairs = (
        few.select(F.posexplode("g").alias("at", "x"), "g")
        .select("x", F.explode(F.slice("g", F.col("at") + 2, STAR)).alias("y"))
        .select(
            F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.least("x.n", "y.n").alias("lo"), F.greatest("x.n", "y.n").alias("hi"),
            # heavy shingles they may share unlisted; two tied classes that share one are connected by it
            F.when(F.col("x.tied") & F.col("y.tied"), 0).otherwise(F.least("x.heavy", "y.heavy")).alias("unseen"),
        )
        .filter((F.col("a") != F.col("b")) & (F.col("lo") * UNDER >= F.col("hi") * OVER))
    )
    plain = pairs.groupBy("a", "b", "lo", "unseen").count().filter(F.col("count") >= _extra(F.col("lo")) - F.col("unseen")).select("a", "b")
    star = rows.filter((F.col("times") > STAR) & F.col("tied"))
    star = star.withColumn("band", F.explode(F.array(_band("n"), _band("n") + 1)))
    low = star.groupBy("token", "band").agg(F.min("class").alias("low"))
    star = star.join(low.hint("merge"), ["token", "band"]).filter(F.col("class") != F.col("low"))
    return plain.unionByName(star.select(F.col("low").alias("a"), F.col("class").alias("b")).distinct())


def _extra(n: Column) -> Column:
    """:func:`extra` of a column."""
    return F.least(LEAST + F.floor(n / 20), F.ceil(n * OVER / UNDER))


def _band(n: str) -> Column:
    """Band of a set's size: sets that link are of the same or of adjacent bands."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(UNDER / OVER)) * (1 - 1e-9))


def _links(scratch: common.Scratch, docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) among the classes of each candidate group (component, one, doc_id, text_key)."""
    # the row whose text stands for a class: its doc_id, or without one the name of its text
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    placed = common.join_keyed(groups, sizes.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")), "component", "members", groups.count())
    placed = placed.withColumn("block", F.pmod(F.xxhash64("one"), F.col("blocks")).cast("int")).withColumn("row", F.coalesce("doc_id", "text_key")).drop("doc_id")
    placed = scratch.write(placed)
    links = scratch.write(_walked(docs, _first_tasks(placed)))
    large = placed.filter("blocks > 1")
    if large.isEmpty():
        return links
    found = common.components(scratch, links).select(F.col("node").alias("one"), F.col("component").alias("linked"))
    large = scratch.write(large.join(found, "one", "left").withColumn("linked", F.coalesce("linked", "one")))
    return links.unionByName(_walked(docs, _other_tasks(large)))


def _first_tasks(placed: DataFrame) -> DataFrame:
    """Tasks (component, i, j): every block by itself, and (probes) against the first one."""
    other = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0), F.col("block")))
    return placed.withColumn("other", F.explode(other)).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("probe"), "one", "row", "text_key"
    )


def _other_tasks(large: DataFrame) -> DataFrame:
    """Tasks of groups of several blocks: the sets outside a group's largest component (``linked``), in blocks
    of their own, as probes against all blocks but the first.  Sets of one component need no comparison."""
    most = large.groupBy("component", "linked").agg(F.count("*").alias("n")).groupBy("component").agg(F.max(F.struct("n", "linked")).alias("most"), F.sum("n").alias("all"))
    most = most.select("component", F.col("most.linked").alias("most"), F.ceil((F.col("all") - F.col("most.n")) / BLOCK).cast("int").alias("rest"))
    own = large.join(F.broadcast(most.filter("rest > 0")), "component")  # a row per group of over BLOCK sets
    probes = own.filter(F.col("linked") != F.col("most")).withColumn("i", F.col("blocks") + F.pmod(F.xxhash64("one"), F.col("rest")).cast("int"))
    probes = probes.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    stored = own.filter("block > 0").withColumn("i", F.explode(F.sequence(F.col("blocks"), F.col("blocks") + F.col("rest") - 1))).withColumn("j", F.col("block"))
    columns = ["component", "i", "j", "probe", "one", "row", "text_key"]
    return probes.withColumn("probe", F.lit(True)).select(columns).unionByName(stored.withColumn("probe", F.lit(False)).select(columns))


def _walked(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Links (a, b) found in each task (component, i, j): among its sets where i = j, else of probes and others."""
    key = F.coalesce("doc_id", "text_key")
    # texts that no candidate needs stay out of the shuffle, repeated rows meet before it
    wanted = tasks.select(F.xxhash64("row", "text_key").alias("key"))
    likely = common.likely(docs.select(key.alias("row"), "text_key", "text"), F.xxhash64("row", "text_key"), wanted).filter("_likely")
    texts = likely.groupBy("row", "text_key").agg(F.first("text").alias("text")).join(tasks.hint("merge"), ["row", "text_key"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [shingles(t) for t in pdf["text"]]
        probes = None if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf["probe"].to_numpy(bool)
        e = tree_links(pdf["one"].to_numpy(), own, probes) if len(own) > 1 else []
        return pd.DataFrame(np.array(e, "int64").reshape(-1, 2), columns=["a", "b"])

    return texts.select("component", "i", "j", "probe", "one", "text").groupBy("component", "i", "j").applyInPandas(walk, "a long, b long")
