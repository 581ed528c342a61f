"""URL filters (operator 11): every URL is expanded into host-suffix and path-prefix expressions, which
are joined to the rules on a short prefix of their SHA-256; the full digests confirm a hit and the
most specific rule wins.

A rule is (host, path, verdict).  It fits its host and all subdomains, where the URL's path starts with
the rule's.  The longest ``host + path`` wins; of equally long ones the one with the longer host; of one
expression with two verdicts, block.  A URL that no rule fits gets the default verdict.

Only expressions of a shape some rule has are built (as many host labels; a path of as many directories,
or, where a rule's path does not end in a slash, of as many characters), so a long URL makes no more
expressions than the rules have shapes.  The shapes are numbers bounded by the longest rule.  Rules are
broadcast when they measure under ``sizing.BROADCAST_BYTES``; beyond, expressions are joined by shuffle and
short prefixes shared by many URLs (such as that of a top-level domain) by broadcast of the few rules
that they belong to.  What is regrouped is one row per URL that a rule fits, aggregated before the shuffle.

Defined cases: a null URL and one without ``://`` have an empty host and path and get the default (or
a rule with an empty host and path); null fields of a rule are empty, a rule whose verdict is neither
``allow`` nor ``block`` is ignored; repeated rules count once; repeated rows of pages are judged each; an empty
table gives an empty result, an empty rule table defaults; other columns of the pages are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemstats.functions import sizing
from itemstats.llm.common import Scratch, join_keyed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*)([^?#]*)"
#: Hexadecimal digits of a digest that the join compares.
SHORT = 8
ALLOW, BLOCK = "allow", "block"
#: The rules of the registered query.
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]
RULE_SCHEMA = "host string, path string, verdict string"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """A host holds no slash and no line break is added to it, so a break separates it from the path."""
    return F.sha2(F.concat(F.length(host).cast("string"), F.lit("\n"), host, path).cast("binary"), 256)


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _directories(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def prepared(rules: DataFrame) -> DataFrame:
    """One row per expression: its digest, the digest's short prefix, its text, rank and verdict."""
    host = F.translate(F.coalesce(F.col("host").cast("string"), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    one = rules.filter(F.col("verdict").isin(ALLOW, BLOCK)).select(host.alias("host"), path.alias("path"), "verdict")
    one = one.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block of both
    digest = _digest(F.col("host"), F.col("path"))
    # the path of a rule, printed with its host, keeps the slash that starts it
    return one.select(
        F.substring(digest, 1, SHORT).alias("short"), digest.alias("digest"), "host", "path", "verdict",
        F.concat("host", "path").alias("rule"),
    )


def shapes(rules: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """Numbers of host labels, of directories (paths that are empty or end in a slash) and of characters
    (other paths) that the rules have: at most as many as the longest rule has characters."""
    closed = (F.col("path") == "") | F.col("path").endswith("/")
    got = rules.agg(
        F.collect_set(F.size(_labels(F.col("host")))).alias("labels"),
        F.collect_set(F.when(closed, _directories(F.col("path")))).alias("directories"),
        F.collect_set(F.when(~closed, F.length("path"))).alias("characters"),
    ).first()
    return sorted(got["labels"]), sorted(got["directories"]), sorted(got["characters"])


def expressions(host: Column, path: Column, labels: list[int], directories: list[int], characters: list[int]) -> Column:
    """Array of the digests of all host suffixes and path prefixes of these shapes."""
    parts, steps = _labels(host), F.split(path, "/", -1)
    longest = lambda ns: F.lit(ns).cast("array<int>")
    suffix = lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
    hosts = F.transform(F.filter(longest(labels), lambda n: n <= F.size(parts)), suffix)
    # n directories: the first n pieces between slashes, each with its slash
    folder = lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/")))
    folders = F.transform(F.filter(longest(directories), lambda n: n < F.size(steps)), folder)
    starts = F.transform(F.filter(longest(characters), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    paths = F.concat(folders, starts)
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: _digest(h, p))))


def best(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict`` of the winning rule, one row per distinct host and path it fits."""
    scratch = Scratch(urls.sparkSession, "urls")
    table = scratch.write(prepared(rules))
    count, size = sizing.measured(table)
    if not count:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    found = urls.withColumn("digest", F.explode(expressions(F.col("host"), F.col("path"), *shapes(table))))
    found = found.withColumn("short", F.substring("digest", 1, SHORT))
    own = table.select("short", F.struct(F.col("digest").alias("full"), "host", "rule", "verdict").alias("of"))
    if size <= sizing.BROADCAST_BYTES:
        hits = found.join(F.broadcast(own), "short")
    else:
        hits = _shuffled(scratch, found, own)
    hits = hits.filter(F.col("digest") == F.col("of.full"))
    rank = F.struct(F.length("of.rule").alias("length"), F.length("of.host").alias("host"), F.col("of.rule").alias("rule"), F.col("of.verdict").alias("verdict"))
    return hits.groupBy("host", "path").agg(F.max(rank).alias("won")).select("host", "path", "won.rule", "won.verdict")


def _shuffled(scratch: Scratch, found: DataFrame, rules: DataFrame) -> DataFrame:
    """The join for rules too large to broadcast: a short prefix is counted before it is shuffled, those of
    many URLs are joined by broadcast (their rules are as few as they are) and the rest by shuffle."""
    found = scratch.write(found)
    lists = rules.groupBy("short").agg(F.collect_list("of").alias("of"))  # collisions of 32 bits only
    counts = found.groupBy("short").agg(F.count(F.lit(1)).alias("n"))
    keyed = scratch.write(lists.join(counts, "short"))
    joined = join_keyed(found, keyed, "short", "n", found.count())
    return joined.filter(F.col("of").isNotNull()).withColumn("of", F.explode("of"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id", default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``."""
    link = F.col(url).cast("string")
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"))
    won = best(rows.select("host", "path"), rules)
    out = rows.join(won, ["host", "path"], "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def keep(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``pages``, with all their columns, whose URL is allowed."""
    row = pages.select(F.struct(*pages.columns).alias("row"), F.col(url).alias("link"))
    row = row.select("row", host_of(F.col("link")).alias("host"), path_of(F.col("link")).alias("path"))
    won = best(row.select("host", "path"), rules)
    refused = won.filter(F.col("verdict") != default).select("host", "path")
    if default == ALLOW:
        return row.join(refused, ["host", "path"], "left_anti").select("row.*")
    return row.join(refused, ["host", "path"], "left_semi").select("row.*")


_HOST = f"translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}')"
ORACLE = f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(repr(r) for r in RULES)}),
parts AS (
  SELECT page_id, {_HOST} AS host, coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path FROM pages
),
urls AS (SELECT DISTINCT host, path FROM parts),
fits AS (
  SELECT u.host, u.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.host, u.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS k
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, '{ALLOW}') AS verdict
FROM parts p LEFT JOIN fits f ON f.host = p.host AND f.path = p.path AND f.k = 1
"""
