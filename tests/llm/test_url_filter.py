from __future__ import annotations

import random
import re

import duckdb
import pytest

from itemstats.functions import sizing
from itemstats.llm import queries, url_filter

URLS = [
    None, "", "no link", "://", "http://", "HTTP://A.Example.NET", "http://a.example.net/", "http://example.net/en/x", "http://example.net/en",
    "https://b.EXAMPLE.com/de/1?x=/fr/#y", "https://badexample.com/de/1", "http://x.org/fr/?q", "http://org/fr/", "http://x.org#/fr/", "http://a.net?x",
    "http://net/", "ftp://u@h.net:80/en/", "http://a..net/b", "http://a.net./b", "http://é.net/ü/", "x://y://z.net/", "http://a.b.c.d.e.f.net//en//",
    "http://a.net/\nb", "http://h.net" + "/a" * 5000, "http://" + "l." * 3000 + "net/en/",
]


def brute(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    won = max(fit, default=None)
    return host, path, won and won[2], won[3] if won else default


@pytest.fixture
def pages(spark):
    def make(urls):
        rows = [(i, u, "<p>", "h", "p", "r", 1) for i, u in enumerate(urls)]
        return spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, rule string, short int")

    return make


def check(spark, pages, urls, rules):
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages(urls), url_filter.rule_table(spark, rules)).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u


def test_rules_of_the_query(spark, pages):
    check(spark, pages, URLS, url_filter.RULES)


def random_case(seed):
    rnd = random.Random(seed)
    part = lambda: rnd.choice(["a", "b", "net", "com", "é", ""])
    host = lambda n: ".".join(part() for _ in range(rnd.randrange(1, n)))
    path = lambda n: "".join(rnd.choice(["/", "/", "x", "y", "en"]) for _ in range(rnd.randrange(n)))
    rules = list({(h, p): (h, p, rnd.choice(["allow", "block"])) for h, p in ((host(4), path(5)) for _ in range(60))}.values())
    urls = ["s://" + host(6) + rnd.choice(["/", ""]) + path(8) + rnd.choice(["", "?q", "#f"]) for _ in range(400)] + URLS
    return urls, rules


def test_random_rules_against_brute_force(spark, pages):
    check(spark, pages, *random_case(1))


def test_rules_too_large_to_broadcast(spark, pages, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    check(spark, pages, *random_case(2))


def test_two_verdicts_repeats_and_bad_rules(spark, pages):
    rules = [("a.net", "/", "allow"), ("a.net", "/", "block"), ("a.net", "/", "block"), ("b.net", "/", "maybe"), (None, None, "block"), ("B.NET", "/x", "block")]
    urls = ["http://a.net/1", "http://a.net/1", "http://b.net/1", "http://b.net/x", None]
    got = sorted(tuple(r) for r in url_filter.judge(pages(urls), url_filter.rule_table(spark, rules)).collect())
    assert [r[3:] for r in got] == [("a.net/", "block"), ("a.net/", "block"), (None, "allow"), ("b.net/x", "block"), ("", "block")]


def test_keep_has_every_column(spark, pages):
    urls = ["http://a.net/en/1", "http://example.net/en/1", None, "http://example.com/de/", "http://x.org/fr/"]
    rules, table = url_filter.rule_table(spark, url_filter.RULES), pages(urls)
    kept = url_filter.keep(table, rules)
    assert kept.columns == table.columns and sorted(r["page_id"] for r in kept.collect()) == [1, 2, 4]
    assert sorted(r["page_id"] for r in url_filter.keep(table, rules, default="block").collect()) == [1, 4]


def test_empty_tables(spark, pages):
    assert url_filter.judge(pages([]), url_filter.rule_table(spark, url_filter.RULES)).collect() == []
    got = url_filter.judge(pages(["http://a.net/"]), url_filter.rule_table(spark, [])).collect()
    assert [tuple(r) for r in got] == [(0, "a.net", "/", None, "allow")]


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in queries.op11_url_filters(spark, sf).select("page_id", "host", "path", "rule", "verdict").collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert got == sorted(con.sql(url_filter.ORACLE).fetchall()) and {r[4] for r in got} == {"allow", "block"}


def test_rules_small_enough_are_joined_without_a_shuffle(spark, pages):
    plan = url_filter.judge(pages(URLS), url_filter.rule_table(spark, url_filter.RULES))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [digest" in plan and "SortMergeJoin [digest" not in plan
