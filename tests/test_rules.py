"""FP-Growth over many batches equals brute force per batch."""

from __future__ import annotations

import itertools
import math
import random

from conftest import blueprint, responses
from itemstats.operators import discretize, itemsets, knowledge, reshape, rules


def _brute(tx_by_batch, support, confidence):
    out = set()
    for b, txs in tx_by_batch.items():
        n = len(txs)
        mc = math.ceil(support * n)
        labels = sorted({x for t in txs for x in t})
        freq = {}
        for size in range(1, len(labels) + 1):
            for combo in itertools.combinations(labels, size):
                f = sum(1 for t in txs if set(combo) <= t)
                if f >= mc:
                    freq[combo] = f
        for s, f in freq.items():
            if len(s) < 2:
                continue
            for c in s:
                ante = tuple(x for x in s if x != c)
                conf = f / freq[ante]
                if conf >= confidence:
                    out.add((b, ante, c, round(conf, 9), round(f / n, 9)))
    return out


def _tx_df(spark, tx_by_batch):
    rows = [(p, "t", f"s{i}", 1, sorted(t)) for p, txs in tx_by_batch.items() for i, t in enumerate(txs)]
    return spark.createDataFrame(rows, "paper_code string, create_time string, stu_code string, attempt int, items array<string>")


def test_rules_equal_brute_force_per_batch(spark):
    rnd = random.Random(7)
    labels = ["1t", "2t", "3t", "4f", "5f"]
    tx = {
        "A": [{x for x in labels if rnd.random() < 0.7} for _ in range(23)],
        "B": [{x for x in labels if rnd.random() < 0.5} for _ in range(9)],
        "C": [{x for x in labels[:3] if rnd.random() < 0.8} for _ in range(70)],
    }
    got_df = rules.mine(_tx_df(spark, tx), 0.3, 0.6)
    got = {(r.paper_code, tuple(r.antecedent), r.consequent, round(r.confidence, 9), round(r.support, 9))
           for r in got_df.collect()}
    assert got == _brute(tx, 0.3, 0.6)
    assert any(len(a) >= 2 for _, a, *_ in got)                 # longer antecedents too


def test_frequent_itemsets_counts(spark):
    tx = {"A": [{"a", "b"}, {"a"}, {"a", "b", "c"}, {"b"}]}
    sets = {(tuple(r["items"]), r.freq) for r in rules.frequent_itemsets(_tx_df(spark, tx), 0.5).collect()}
    assert sets == {(("a",), 3), (("b",), 3), (("a", "b"), 2)}


def test_order_filter_int_and_string(spark):
    df = spark.createDataFrame([(["9h"], "12h"), (["12h"], "9h"), (["1h", "3l"], "2h")], "antecedent array<string>, consequent string")
    split = rules.split_tags(df)
    as_int = {(tuple(r.pre_ids), r.suf_id) for r in rules.order_filter(split, "int").collect()}
    as_str = {(tuple(r.pre_ids), r.suf_id) for r in rules.order_filter(split, "string").collect()}
    assert as_int == {((9,), 12)}
    assert as_str == {((12,), 9)}                                # '12' < '9' as text


def test_format_rules_drops_labels(spark):
    df = spark.createDataFrame([("P", "t", ["3t", "1f"], "5t", 0.9), ("P", "t", ["3t"], "5f", 0.86)],
                               "paper_code string, create_time string, antecedent array<string>, consequent string, confidence double")
    got = sorted(tuple(r) for r in rules.format_rules(rules.split_tags(df)).collect())
    assert got == [("P", "t", "1,3", "5", 0.9), ("P", "t", "3", "5", 0.86)]


def test_labels_and_knowledge_transactions(spark):
    bp = blueprint(spark, [("P", 1, "objective", 2, 2), ("P", 2, "subjective", 2, 5)])
    items = reshape.blueprint_items(bp)
    r = responses(spark, [("P", "a", 1, 1), ("P", "a", 2, 0), ("P", "a", 3, 3, 2), ("P", "a", 4, 2, 2)])
    sheets = reshape.answer_sheets(r)
    tx = discretize.item_transactions(sheets, items).collect()[0]["items"]
    assert tx == ["1t", "2f", "3t", "4f"]                          # partial credit right; 2.5 cut is strict
    ik = spark.createDataFrame([("P", 9, 1), ("P", 9, 3), ("P", 12, 2), ("P", 12, 4), ("P", 12, 5)],
                               "paper_code string, kl_id int, item_id int")
    ks = {r.kl_id: (r.kl_score, r.full_mark, r.label) for r in knowledge.labels(knowledge.scores(sheets, ik, items)).collect()}
    assert ks == {9: (4, 7, "h"), 12: (2, 7, "l")}                 # item 5 is not in the blueprint
    ktx = knowledge.transactions(sheets, ik, items).collect()[0]["items"]
    assert ktx == ["12l", "9h"]
    drop = spark.createDataFrame([("P", "t1", 2)], "paper_code string, create_time string, item_id int")
    assert discretize.item_transactions(sheets, items, drop).collect()[0]["items"] == ["1t", "3t", "4f"]


def test_null_knowledge_label_left_out(spark):
    bp = blueprint(spark, [("P", 1, "objective", 2, 2)])
    items = reshape.blueprint_items(bp)
    sheets = reshape.answer_sheets(responses(spark, [("P", "a", 1, 2)]))
    ik = spark.createDataFrame([("P", 1, 1), ("P", 2, 2)], "paper_code string, kl_id int, item_id int")
    assert knowledge.transactions(sheets, ik, items).collect()[0]["items"] == ["1h"]
    assert knowledge.transactions(sheets, ik, items, missing="zero").collect()[0]["items"] == ["1h", "2l"]


def _sets(df):
    return {(r.paper_code, tuple(r["items"]), r.freq, r.n) for r in df.collect()}


def test_itemsets_of_blocks_equal_fits_and_brute_force(spark, monkeypatch):
    rnd = random.Random(11)
    labels = [f"{i}{x}" for i in range(9) for x in "tf"]
    tx = {"one": [], "hot": [], "tiny": [set()], "lone": [{"1t"}]}
    for name, n in (("one", 12), ("hot", 400)):
        tx[name] = [{rnd.choice([f"{i}t", f"{i}t", f"{i}t", f"{i}f"]) for i in range(9) if rnd.random() < 0.9} for _ in range(n)]
    df = _tx_df(spark, tx).repartition(4)

    def brute(support):
        out = set()
        for b, txs in tx.items():
            least = max(1, math.ceil(support * len(txs)))
            for size in range(1, 10):
                found = {(b, c, f, len(txs)) for c in itertools.combinations(sorted(labels), size) if (f := sum(set(c) <= t for t in txs)) >= least} if size < 4 else set()
                out |= found
        return out

    for support in (0.3, 0.62):
        want = brute(support)
        assert _sets(rules.fitted_itemsets(df, support)) == _sets(rules.frequent_itemsets(df, support))
        for rows in (1, 50):  # blocks of a batch: many, several
            with monkeypatch.context() as m:
                m.setattr(itemsets, "ROWS", rows)
                got = _sets(rules.frequent_itemsets(df, support))
            assert {g for g in got if len(g[1]) < 4} == want
            assert got == _sets(rules.frequent_itemsets(df, support))


def test_itemsets_of_empty_and_odd_transactions(spark):
    schema = "paper_code string, create_time string, items array<string>"
    assert rules.frequent_itemsets(spark.createDataFrame([], schema), 0.5).collect() == []
    rows = [("A", "1", ["b", "a", "a", None]), ("A", "1", None), ("A", "1", []), ("A", "2", ["a"])]
    got = {(r.create_time, tuple(r["items"]), r.freq, r.n) for r in rules.frequent_itemsets(spark.createDataFrame(rows, schema), 0.3).collect()}
    assert got == {("1", ("a",), 1, 3), ("1", ("b",), 1, 3), ("1", ("a", "b"), 1, 3), ("2", ("a",), 1, 1)}


def test_many_batches_are_mined_in_a_bounded_number_of_jobs(spark):
    ids = spark.range(2000)
    tx = ids.selectExpr("concat('p', id % 500) AS paper_code", "'1' AS create_time", "array('1t', concat(id % 3, 'f')) AS items")
    group = "itemsets-jobs"
    spark.sparkContext.setJobGroup(group, group)
    assert rules.frequent_itemsets(tx, 0.5).filter("array_size(items) = 1 AND items[0] = '1t'").count() == 500
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25
    spark.sparkContext.setJobGroup("", "")
