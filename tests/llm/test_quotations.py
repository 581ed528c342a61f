from __future__ import annotations

import random
import re

from itemstats.llm import quotations

SCHEMA = "conv_id long, turn long, role string, text string, mid long, path string, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2) for r in rows], SCHEMA)


def norm(t):
    return re.sub(r"[\W_]+", " ", t.lower()).strip()


def sentences(t):
    return re.split(r"(?<=[.!?…])\s+|\n\s*\n", t)


def brute(rows):
    """Conversation by conversation: latest earlier holder of each quoted line or sentence, then a preorder walk."""
    out = {}
    for conv in {r[0] for r in rows}:
        own, parent, count = [], [], []
        for m, (_, _, _, text) in enumerate(sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])):
            levels = []
            for x in (text or "").split("\n"):
                marks = re.match(r"^\s{0,3}((?:>\s?)+)", x)
                levels.append((marks[1].count(">") if marks else 0, x[marks.end() :] if marks else x))
            body = [b for k, (lv, b) in enumerate(levels) if lv == 0 and not (b.endswith("wrote:") and k + 1 < len(levels) and levels[k + 1][0] > 0)]
            own.append("\n".join(body).strip())
            passages = {}
            last, number = None, 0
            for lv, b in levels:
                number += lv != last
                last = lv
                if lv:
                    passages.setdefault((number, lv), []).append(b)
            found = []
            for (number, lv), lines in passages.items():
                whole = "\n".join(lines)
                for t in {norm(x) for x in [*lines, *sentences(whole), whole]} - {""}:
                    for p in range(m - 1, -1, -1):
                        if t in {norm(x) for x in [*own[p].split("\n"), *sentences(own[p]), own[p]]}:
                            found.append((lv, p, t.count(" ") + 1))
                            break
            count.append(len(found))
            low = min((f[0] for f in found), default=0)
            words = {}
            for lv, p, n in found:
                if lv == low:
                    words[p] = words.get(p, 0) + n
            parent.append(max(words, key=lambda p: (words[p], p)) if words else None)
        kids = {}
        for m in range(len(own)):
            kids.setdefault(parent[m] if parent[m] is not None else m - 1, []).append(m)
        order, todo = [], [0]
        while todo:
            m = todo.pop()
            order.append(m)
            todo += sorted(kids.get(m, []), reverse=True)
        for place, m in enumerate(order):
            out[conv, m] = (own[m], parent[m] if parent[m] is not None else (m - 1 if m else None), count[m], place)
    return out


def test_against_brute_force(spark):
    rnd = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta"]
    rows = []
    for conv in range(40):
        texts = []
        for turn in range(rnd.randrange(1, 12)):
            t = "\n".join(" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(1, 4)))
            if texts and rnd.random() < 0.6:
                quote = rnd.choice(texts)
                lead = "On Monday, x wrote:\n" if rnd.random() < 0.5 else ""
                t = lead + "\n".join("> " + x.upper() for x in quote.split("\n")) + "\n" + t
            texts.append(t)
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", t))
    got = {(r["conv_id"], r["turn"]): (r["text"], r["reply_to"], r["n_links"], r["position"]) for r in quotations.reply_order(frame(spark, rows)).collect()}
    assert got == brute(rows)
    assert sum(v[2] > 0 for v in got.values()) > 20


def test_nested_levels_and_attribution(spark):
    rows = [(1, 0, "a", "Shall we meet?\nAt noon."), (1, 1, "b", "> Shall we meet?\nYes, gladly."), (1, 2, "c", "No time."),
            (1, 3, "a", "On Tuesday, b wrote:\n>> Shall we meet?\n> yes,  GLADLY\n\nThen at noon.")]
    got = {r["turn"]: r for r in quotations.reply_order(frame(spark, rows)).collect()}
    assert got[3]["reply_to"] == 1 and got[3]["text"] == "Then at noon." and got[3]["n_links"] == 2
    assert got[1]["reply_to"] == 0 and got[1]["text"] == "Yes, gladly."
    assert [t for t in sorted(got, key=lambda t: got[t]["position"])] == [0, 1, 2, 3]


def test_edges(spark):
    assert quotations.reply_order(frame(spark, [])).collect() == []
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "u", "> x"), (None, 3, "u", "hi"), (None, 4, "u", "> hi"), (2, 0, "u", "")]
    got = quotations.reply_order(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    places = {}
    for r in got:
        places.setdefault(r["conv_id"], []).append(r["position"])
    assert all(sorted(v) == list(range(len(v))) for v in places.values())
    assert [r["reply_to"] for r in got if r["conv_id"] is None and r["turn"] == 4] == [0]


def test_one_conversation_over_many_partitions(spark):
    rows = [(5, i, "u", f"line {i}" if i % 10 else f"> line {i - 7}\nanswer {i}") for i in range(300)] + [(6, 0, "u", "x")]
    got = {(r["conv_id"], r["turn"]): (r["text"], r["reply_to"], r["n_links"], r["position"]) for r in quotations.reply_order(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_part_of_a_message_with_new_line_breaks(spark):
    first = "We looked at the old bridge on\nThursday. It is safe for walkers, but\nnot for lorries! Shall we close it?"
    rows = [(1, 0, "a", first), (1, 1, "b", "I was away."), (1, 2, "c", "> It is safe for\n> walkers, but not for lorries!\nThen close it.")]
    got = {r["turn"]: r for r in quotations.reply_order(frame(spark, rows)).collect()}
    assert got[2]["reply_to"] == 0 and got[2]["n_links"] == 1 and got[2]["text"] == "Then close it."


def jobs_of(spark, run):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quotations", "")
    before = len(tracker.getJobIdsForGroup("quotations"))
    out = run()
    jobs = len(tracker.getJobIdsForGroup("quotations")) - before
    spark.sparkContext._jsc.clearJobGroup()
    return out, jobs


def test_deep_threads_in_few_jobs(spark):
    """Every message quotes the one before, the one two or three before, or one of the first."""
    quote = {1: lambda i: i - 1, 2: lambda i: i - 2, 3: lambda i: i - 3, 4: lambda i: i % 3}
    rows = [(c, i, "u", (f"> say {of(i)} here\n" if i >= 3 else "") + f"say {i} here") for c, of in quote.items() for i in range(800 if c == 2 else 200)]
    out, jobs = jobs_of(spark, lambda: quotations.reply_order(frame(spark, rows)).collect())
    got = {(r["conv_id"], r["turn"]): (r["text"], r["reply_to"], r["n_links"], r["position"]) for r in out}
    assert got == brute(rows)
    depth = {}
    for (conv, m), (_, parent, _, _) in sorted(got.items()):
        depth[conv, m] = 0 if m == 0 else depth[conv, parent] + (parent != m - 1)
    assert {(r["conv_id"], r["turn"]): r["depth"] for r in out} == depth and max(depth.values()) > 300
    assert 0 < jobs < 200
