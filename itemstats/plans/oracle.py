"""Oracle SQL (DuckDB) for the registered queries.

Each string builds the fixture with the common table expressions of
:mod:`itemstats.sources.fixture` and computes, in plain SQL with windows and
self joins, the rows the Spark query of the same key computes.  Doubles are
rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from itemstats.defaults import BAD, CANDIDATE_STEP, GOOD, K, MAX_ITER, RECLUSTER_STEPS, ROUNDS, SEED
from itemstats.sources.fixture import ORACLE_BATCHES, oracle

_TOTALS = """
pitems AS (SELECT paper_code, COUNT(DISTINCT item_id) AS n_items FROM items GROUP BY paper_code),
t AS (
  SELECT r.paper_code, r.create_time, r.stu_code, r.attempt,
         CAST(CASE WHEN COUNT(r.score) = MAX(p.n_items) THEN SUM(r.score) END AS INT) AS total_propagate,
         CAST(SUM(r.score) AS INT) AS total_zero
  FROM responses r JOIN items i ON r.paper_code = i.paper_code AND r.item_id = i.item_id
  JOIN pitems p ON r.paper_code = p.paper_code
  GROUP BY r.paper_code, r.create_time, r.stu_code, r.attempt)"""


def _groups(mode: str) -> str:
    total = f"total_{mode}"
    return f"""
g AS (
  SELECT paper_code, create_time, stu_code, attempt, {total} AS total_score,
    ROW_NUMBER() OVER (PARTITION BY paper_code, create_time
                       ORDER BY {total} DESC NULLS LAST, stu_code, attempt) AS rh,
    ROW_NUMBER() OVER (PARTITION BY paper_code, create_time
                       ORDER BY {total} ASC NULLS FIRST, stu_code, attempt) AS rl,
    COUNT(*) OVER (PARTITION BY paper_code, create_time) AS n,
    CAST(ROUND(0.27 * COUNT(*) OVER (PARTITION BY paper_code, create_time)) AS INT) AS pg
  FROM t)"""


_GRID = """
students AS (SELECT DISTINCT paper_code, create_time, stu_code, attempt FROM responses),
grid AS (
  SELECT s.paper_code, s.create_time, s.stu_code, s.attempt, i.item_id, i.kind, i.full_mark, r.score
  FROM students s JOIN items i ON i.paper_code = s.paper_code
  LEFT JOIN responses r ON r.paper_code = s.paper_code AND r.create_time = s.create_time
       AND r.stu_code = s.stu_code AND r.attempt = s.attempt AND r.item_id = i.item_id)"""


def _item_index(mode: str = "propagate") -> str:
    score = "COALESCE(r.score, 0)" if mode == "zero" else "r.score"
    return f"""
ii AS (
  SELECT r.paper_code, r.create_time, r.item_id,
    MAX({score}) AS max_score, MIN({score}) AS min_score,
    AVG({score}) AS avg_score, VAR_POP({score}) AS fc_score, STDDEV_POP({score}) AS bzc_score,
    CAST(SUM({score}) AS DOUBLE) / MAX(r.full_mark) / MAX(g.n) AS nandu,
    CAST(SUM(CASE WHEN g.rh <= g.pg THEN {score} END)
         - SUM(CASE WHEN g.rl <= g.pg THEN {score} END) AS DOUBLE)
      / NULLIF(MAX(g.pg), 0)
      / CASE WHEN MAX(r.kind) = 'objective' THEN MAX(r.full_mark)
             ELSE NULLIF(MAX({score}) - MIN({score}), 0) END AS qufendu
  FROM grid r
  JOIN g ON r.paper_code = g.paper_code AND r.create_time = g.create_time
        AND r.stu_code = g.stu_code AND r.attempt = g.attempt
  GROUP BY r.paper_code, r.create_time, r.item_id)"""


def r6(*cols: str) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in cols)


def total_score(mode: str) -> str:
    return oracle(
        f"SELECT paper_code, create_time, stu_code, attempt, total_{mode} AS total_score FROM t", _TOTALS
    )


def high_low_groups(mode: str = "propagate") -> str:
    return oracle(
        """SELECT paper_code, create_time, stu_code, attempt, total_score,
  rh <= pg AS is_high, rl <= pg AS is_low FROM g""",
        _TOTALS,
        _groups(mode),
    )


def group_sizes() -> str:
    return oracle(
        """SELECT paper_code, create_time, CAST(COUNT(*) AS BIGINT) AS n,
  CAST(ROUND(0.27 * COUNT(*)) AS INT) AS pg FROM t GROUP BY paper_code, create_time""",
        _TOTALS,
    )


def item_index(mode: str = "propagate") -> str:
    return oracle(
        f"""SELECT paper_code, create_time, item_id, max_score, min_score,
  {r6("avg_score", "fc_score", "bzc_score", "nandu", "qufendu")} FROM ii""",
        _TOTALS,
        _groups(mode),
        _GRID,
        _item_index(mode),
    )


def paper_index(mode: str = "propagate", rounded: bool = False) -> str:
    def v(c: str) -> str:
        return f"ROUND({c}, 3)" if rounded else c

    return oracle(
        f"""SELECT p.paper_code, p.create_time, p.max_score, p.min_score,
  {r6("p.avg_score", "p.fc_score", "p.bzc_score").replace("AS p.", "AS ")},
  ROUND(a.nandu, 6) AS nandu, ROUND(a.qufendu, 6) AS qufendu,
  ROUND(CAST(k.n_items AS DOUBLE) / NULLIF(k.n_items - 1, 0) * (1 - a.sum_var / NULLIF(p.fc_score, 0)), 6) AS xindu
FROM (SELECT paper_code, create_time, MAX(total_score) AS max_score, MIN(total_score) AS min_score,
             AVG(total_score) AS avg_score, VAR_POP(total_score) AS fc_score, STDDEV_POP(total_score) AS bzc_score
      FROM g GROUP BY paper_code, create_time) p
JOIN (SELECT paper_code, create_time, AVG({v("nandu")}) AS nandu, AVG({v("qufendu")}) AS qufendu,
             SUM({v("fc_score")}) AS sum_var
      FROM ii GROUP BY paper_code, create_time) a
  ON p.paper_code = a.paper_code AND p.create_time = a.create_time
JOIN pitems k ON p.paper_code = k.paper_code""",
        _TOTALS,
        _groups(mode),
        _GRID,
        _item_index(mode),
    )


_LABELS = """
labels AS (
  SELECT paper_code, create_time, stu_code, attempt, item_id, score,
    CASE WHEN (CASE WHEN kind = 'objective' THEN score > 0 ELSE score > full_mark / 2.0 END) THEN 't' ELSE 'f' END AS label
  FROM grid)"""

_KL = """
kl AS (SELECT k.paper_code, k.kl_id, i.item_id, i.full_mark
       FROM (SELECT DISTINCT paper_code, kl_id, item_id FROM item_knowledge) k
       JOIN items i ON i.paper_code = k.paper_code AND i.item_id = k.item_id),
klp AS (SELECT paper_code, kl_id, COUNT(*) AS n_kl, CAST(SUM(full_mark) AS INT) AS full_mark FROM kl GROUP BY paper_code, kl_id),
ks AS (
  SELECT g.paper_code, g.create_time, g.stu_code, g.attempt, kl.kl_id,
    CAST(CASE WHEN COUNT(g.score) = MAX(p.n_kl) THEN SUM(g.score) END AS INT) AS kl_score, MAX(p.full_mark) AS full_mark
  FROM grid g JOIN kl ON kl.paper_code = g.paper_code AND kl.item_id = g.item_id
  JOIN klp p ON p.paper_code = kl.paper_code AND p.kl_id = kl.kl_id
  GROUP BY g.paper_code, g.create_time, g.stu_code, g.attempt, kl.kl_id),
kls AS (
  SELECT *, CASE WHEN kl_score >= full_mark / 2.0 THEN 'h' WHEN kl_score < full_mark / 2.0 THEN 'l' END AS label FROM ks)"""


def _nb(support: float) -> str:
    return f"""
nb AS (SELECT paper_code, create_time, COUNT(*) AS n, CAST(CEIL(CAST({support} AS DOUBLE) * COUNT(*)) AS BIGINT) AS mc
       FROM students GROUP BY paper_code, create_time)"""


_SAME = "a.paper_code = b.paper_code AND a.create_time = b.create_time AND a.stu_code = b.stu_code AND a.attempt = b.attempt"
_STU = "paper_code, create_time, stu_code, attempt"


def responses_long() -> str:
    return oracle("SELECT paper_code, create_time, stu_code, attempt, section, item_id, score FROM responses")


def json_sheets() -> str:
    return oracle("SELECT paper_code, create_time, stu_code, attempt, item_id, score FROM responses")


def json_fractional() -> str:
    return oracle("SELECT paper_code, create_time, stu_code, attempt, section, item_id, CAST(score AS DOUBLE) / 2 AS score FROM responses")


def rejected() -> str:
    lines = """
st AS (SELECT create_time, stu_code, paper_code, right(stu_code, 1) AS d, bool_or(item_id = 1) AS first
       FROM responses GROUP BY create_time, stu_code, paper_code)"""
    return oracle(
        """SELECT create_time, reason, COUNT(*) AS n FROM (
  SELECT create_time, CASE WHEN d = '3' THEN 'malformed line' WHEN d = '5' THEN 'no stuCode'
    WHEN d = '7' AND first THEN 'unreadable score' WHEN d = '9' THEN 'other paperCode' END AS reason FROM st)
WHERE reason IS NOT NULL GROUP BY create_time, reason""",
        lines,
    )


def blueprint_items() -> str:
    return oracle("SELECT paper_code, section, kind, item_id, full_mark FROM items")


def responses_complete() -> str:
    return oracle(f"SELECT {_STU}, item_id, score FROM grid", _GRID)


def responses_marked() -> str:
    return oracle("""SELECT r.paper_code, r.create_time, r.stu_code, r.attempt, r.section, r.item_id, r.score, i.kind, i.full_mark
FROM responses r JOIN items i ON r.paper_code = i.paper_code AND r.item_id = i.item_id""")


def select_batch() -> str:
    return oracle(
        """SELECT r.paper_code, r.submit_time,
  COALESCE((SELECT MIN(f.ts) FROM files f WHERE f.paper_code = r.paper_code AND f.ts >= r.submit_time),
           (SELECT MAX(f.ts) FROM files f WHERE f.paper_code = r.paper_code)) AS create_time
FROM requests r""",
        ORACLE_BATCHES,
    )


def item_labels() -> str:
    return oracle(f"SELECT {_STU}, item_id, score, label, CAST(item_id AS VARCHAR) || label AS tag FROM labels", _GRID, _LABELS)


_EXTREME = "(nandu > 0.7 OR nandu < 0.45)"


def extreme_items() -> str:
    return oracle(
        f"SELECT paper_code, create_time, item_id, ROUND(nandu, 6) AS nandu FROM ii WHERE {_EXTREME}",
        _TOTALS, _groups("propagate"), _GRID, _item_index(),
    )


def kept_items() -> str:
    return oracle(
        f"SELECT paper_code, create_time, item_id FROM ii WHERE NOT COALESCE({_EXTREME}, FALSE)",
        _TOTALS, _groups("propagate"), _GRID, _item_index(),
    )


def knowledge_full_marks() -> str:
    return oracle(
        """SELECT paper_code, kl_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS kl_items,
  CAST(SUM(full_mark) AS INT) AS full_mark FROM kl GROUP BY paper_code, kl_id""",
        _GRID, _KL, knowledge=True,
    )


def knowledge_scores() -> str:
    return oracle(f"SELECT {_STU}, kl_id, kl_score, full_mark FROM ks", _GRID, _KL, knowledge=True)


def knowledge_scores_zero() -> str:
    return oracle(
        f"""SELECT g.paper_code, g.create_time, g.stu_code, g.attempt, kl.kl_id,
  CAST(SUM(COALESCE(g.score, 0)) AS INT) AS kl_score, MAX(p.full_mark) AS full_mark
FROM grid g JOIN kl ON kl.paper_code = g.paper_code AND kl.item_id = g.item_id
JOIN klp p ON p.paper_code = kl.paper_code AND p.kl_id = kl.kl_id
GROUP BY g.paper_code, g.create_time, g.stu_code, g.attempt, kl.kl_id""",
        _GRID, _KL, knowledge=True,
    )


def knowledge_labels() -> str:
    return oracle(
        f"SELECT {_STU}, kl_id, kl_score, full_mark, label, CAST(kl_id AS VARCHAR) || label AS tag FROM kls",
        _GRID, _KL, knowledge=True,
    )


def item_transactions() -> str:
    return oracle(
        f"""SELECT {_STU}, string_agg(CAST(item_id AS VARCHAR) || label, ',' ORDER BY CAST(item_id AS VARCHAR) || label) AS items
FROM labels GROUP BY {_STU}""",
        _GRID, _LABELS,
    )


def knowledge_transactions() -> str:
    return oracle(
        f"""SELECT {_STU}, COALESCE(string_agg(CAST(kl_id AS VARCHAR) || label, ',' ORDER BY CAST(kl_id AS VARCHAR) || label), '') AS items
FROM kls GROUP BY {_STU}""",
        _GRID, _KL, knowledge=True,
    )


def frequent_itemsets_le3(support: float = 0.3) -> str:
    tx = f"""
tx AS (SELECT {_STU}, CAST(item_id AS VARCHAR) || label AS tag FROM labels),
s1 AS (SELECT paper_code, create_time, tag AS items, COUNT(*) AS freq FROM tx GROUP BY paper_code, create_time, tag),
s2 AS (SELECT a.paper_code, a.create_time, a.tag || ',' || b.tag AS items, COUNT(*) AS freq
       FROM tx a JOIN tx b ON {_SAME} AND a.tag < b.tag GROUP BY 1, 2, 3),
s3 AS (SELECT a.paper_code, a.create_time, a.tag || ',' || b.tag || ',' || c.tag AS items, COUNT(*) AS freq
       FROM tx a JOIN tx b ON {_SAME} AND a.tag < b.tag
       JOIN tx c ON a.paper_code = c.paper_code AND a.create_time = c.create_time AND a.stu_code = c.stu_code
                 AND a.attempt = c.attempt AND b.tag < c.tag
       GROUP BY 1, 2, 3)"""
    return oracle(
        """SELECT s.paper_code, s.create_time, s.items, s.freq
FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) s
JOIN nb ON nb.paper_code = s.paper_code AND nb.create_time = s.create_time WHERE s.freq >= nb.mc""",
        _GRID, _LABELS, _nb(support), tx,
    )


def _rules_1(tx: str, support: float, confidence: float, order: str | None, *ctes: str, knowledge: bool = False) -> str:
    pairs = f"""
txr AS ({tx}),
f1 AS (SELECT paper_code, create_time, tag, COUNT(*) AS f FROM txr GROUP BY paper_code, create_time, tag),
f2 AS (SELECT a.paper_code, a.create_time, a.tag AS ante, b.tag AS cons, COUNT(*) AS f
       FROM txr a JOIN txr b ON {_SAME} AND a.tag <> b.tag GROUP BY 1, 2, 3, 4)"""
    cond = ""
    if order == "int":
        cond = (" AND CAST(regexp_extract(f2.ante, '^([0-9]+)', 1) AS INT)"
                " < CAST(regexp_extract(f2.cons, '^([0-9]+)', 1) AS INT)")
    elif order == "string":
        cond = " AND regexp_extract(f2.ante, '^([0-9]+)', 1) < regexp_extract(f2.cons, '^([0-9]+)', 1)"
    conf = "CAST(f2.f AS DOUBLE) / fa.f"
    return oracle(
        f"""SELECT f2.paper_code, f2.create_time, f2.ante AS antecedent, f2.cons AS consequent,
  ROUND({conf}, 6) AS confidence, ROUND(CAST(f2.f AS DOUBLE) / nb.n, 6) AS support,
  ROUND(({conf}) / (CAST(fc.f AS DOUBLE) / nb.n), 6) AS lift
FROM f2
JOIN f1 fa ON fa.paper_code = f2.paper_code AND fa.create_time = f2.create_time AND fa.tag = f2.ante
JOIN f1 fc ON fc.paper_code = f2.paper_code AND fc.create_time = f2.create_time AND fc.tag = f2.cons
JOIN nb ON nb.paper_code = f2.paper_code AND nb.create_time = f2.create_time
WHERE f2.f >= nb.mc AND {conf} >= {confidence}{cond}""",
        *ctes, _nb(support), pairs, knowledge=knowledge,
    )


_ITEM_TX = f"""SELECT l.paper_code, l.create_time, l.stu_code, l.attempt, CAST(l.item_id AS VARCHAR) || l.label AS tag
  FROM labels l WHERE NOT EXISTS (
    SELECT 1 FROM ii WHERE ii.paper_code = l.paper_code AND ii.create_time = l.create_time
      AND ii.item_id = l.item_id AND (ii.nandu > 0.8 OR ii.nandu < 0.2))"""
_KL_TX = f"SELECT {_STU}, CAST(kl_id AS VARCHAR) || label AS tag FROM kls WHERE label IS NOT NULL"


def item_rules_1(support: float = 0.3, confidence: float = 0.6) -> str:
    return _rules_1(_ITEM_TX, support, confidence, None, _TOTALS, _groups("propagate"), _GRID, _item_index(), _LABELS)


def _all_itemsets(tx: str) -> str:
    """Every itemset that reaches its batch's count, by brute force: each transaction's subsets are
    enumerated (a recursive CTE: include or skip each label in turn) and counted."""
    return f"""
txr AS ({tx}),
txl AS (SELECT {_STU}, list_sort(list(tag)) AS items FROM txr GROUP BY {_STU}),
sub AS (
  SELECT {_STU}, items, CAST([] AS VARCHAR[]) AS s, 0 AS i FROM txl
  UNION ALL
  SELECT {_STU}, items, CASE WHEN c.b = 1 THEN list_append(s, items[i + 1]) ELSE s END AS s, i + 1 AS i
  FROM sub CROSS JOIN (VALUES (0), (1)) AS c(b) WHERE i < len(items)),
fs AS (
  SELECT x.paper_code, x.create_time, x.s AS items, COUNT(*) AS f
  FROM sub x WHERE x.i = len(x.items) AND len(x.s) >= 1
  GROUP BY x.paper_code, x.create_time, x.s),
fq AS (SELECT fs.* FROM fs JOIN nb ON nb.paper_code = fs.paper_code AND nb.create_time = fs.create_time WHERE fs.f >= nb.mc)"""


def frequent_itemsets(support: float = 0.3) -> str:
    tx = f"SELECT {_STU}, CAST(item_id AS VARCHAR) || label AS tag FROM labels"
    return oracle(
        "SELECT paper_code, create_time, array_to_string(items, ',') AS items, f AS freq FROM fq",
        _GRID, _LABELS, _nb(support), _all_itemsets(tx), recursive=True,
    )


def _rules_all(tx: str, support: float, confidence: float, order: str | None, *ctes: str, knowledge: bool = False,
               fpg: bool = False) -> str:
    """Every rule of any antecedent size, from all frequent itemsets."""
    sets = _all_itemsets(tx) + """,
cand AS (
  SELECT paper_code, create_time, items, f, UNNEST(items) AS cons FROM fq WHERE len(items) >= 2)"""
    cond = ""
    if order == "int":
        cond = (" AND list_max(list_transform(list_filter(c.items, lambda x: x <> c.cons), "
                "lambda x: CAST(regexp_extract(x, '^([0-9]+)', 1) AS INT)))"
                " < CAST(regexp_extract(c.cons, '^([0-9]+)', 1) AS INT)")
    elif order == "string":
        cond = (" AND list_max(list_transform(list_filter(c.items, lambda x: x <> c.cons), "
                "lambda x: regexp_extract(x, '^([0-9]+)', 1))) < regexp_extract(c.cons, '^([0-9]+)', 1)")
    conf = "CAST(c.f AS DOUBLE) / a.f"
    ids = "list_sort(list_transform(list_filter(c.items, lambda x: x <> c.cons), lambda x: CAST(regexp_extract(x, '^([0-9]+)', 1) AS INT)))"
    if fpg:   # the reference's t_item_fpg shape: ids without labels
        cols = (f"array_to_string({ids}, ',') AS pre_order, regexp_extract(c.cons, '^([0-9]+)', 1) AS suf_order, "
                f"ROUND({conf}, 6) AS confidence")
    else:
        cols = (f"array_to_string(list_filter(c.items, lambda x: x <> c.cons), ',') AS antecedent, c.cons AS consequent, "
                f"ROUND({conf}, 6) AS confidence, ROUND(CAST(c.f AS DOUBLE) / nb.n, 6) AS support, "
                f"ROUND(({conf}) / (CAST(s.f AS DOUBLE) / nb.n), 6) AS lift")
    return oracle(
        f"""SELECT c.paper_code, c.create_time, {cols}
FROM cand c
JOIN fq a ON a.paper_code = c.paper_code AND a.create_time = c.create_time AND a.items = list_filter(c.items, lambda x: x <> c.cons)
JOIN fq s ON s.paper_code = c.paper_code AND s.create_time = c.create_time AND s.items = [c.cons]
JOIN nb ON nb.paper_code = c.paper_code AND nb.create_time = c.create_time
WHERE {conf} >= {confidence}{cond}""",
        *ctes, _nb(support), sets, knowledge=knowledge, recursive=True,
    )


def item_rules(support: float = 0.3, confidence: float = 0.6) -> str:
    return _rules_all(_ITEM_TX, support, confidence, None, _TOTALS, _groups("propagate"), _GRID, _item_index(), _LABELS)


def knowledge_rules(support: float = 0.45, confidence: float = 0.85, fpg: bool = False, compare: str = "int") -> str:
    return _rules_all(_KL_TX, support, confidence, compare, _GRID, _KL, knowledge=True, fpg=fpg)


def item_fpg(support: float = 0.3, confidence: float = 0.6) -> str:
    return _rules_all(_ITEM_TX, support, confidence, None, _TOTALS, _groups("propagate"), _GRID, _item_index(), _LABELS,
                      fpg=True)


def knowledge_rules_1(support: float = 0.45, confidence: float = 0.85, compare: str = "int") -> str:
    return _rules_1(_KL_TX, support, confidence, compare, _GRID, _KL, knowledge=True)


def incomplete_sheets() -> str:
    return oracle(f"SELECT {_STU} FROM grid GROUP BY {_STU} HAVING COUNT(score) < COUNT(*)", _GRID)


def latest_attempt() -> str:
    return oracle("""SELECT r.* FROM responses r
JOIN (SELECT paper_code, create_time, stu_code, MAX(attempt) AS a FROM responses
      GROUP BY paper_code, create_time, stu_code) m
  ON r.paper_code = m.paper_code AND r.create_time = m.create_time AND r.stu_code = m.stu_code AND r.attempt = m.a""")


def student_code_parts() -> str:
    return oracle(
        f"""SELECT {_STU}, gc, mc, cc, nc,
  LPAD(CAST(gc AS VARCHAR), 2, '0') || LPAD(CAST(mc AS VARCHAR), 2, '0')
  || LPAD(CAST(cc AS VARCHAR), 2, '0') || LPAD(CAST(nc AS VARCHAR), 2, '0') AS rebuilt
FROM (SELECT {_STU}, TRY_CAST(SUBSTR(stu_code, 1, 2) AS INT) AS gc, TRY_CAST(SUBSTR(stu_code, 3, 2) AS INT) AS mc,
             TRY_CAST(SUBSTR(stu_code, 5, 2) AS INT) AS cc, TRY_CAST(SUBSTR(stu_code, 7, 2) AS INT) AS nc
      FROM students) p""",
        _GRID,
    )


_BANDS = f"""
comp AS (SELECT {_STU}, CAST(SUM(score) AS DOUBLE) AS s FROM grid GROUP BY {_STU} HAVING COUNT(score) = COUNT(*)),
lim AS (SELECT paper_code, create_time, MIN(s) AS lo, MAX(s) AS hi FROM comp GROUP BY paper_code, create_time),
band AS (SELECT c.paper_code, c.create_time, c.stu_code, c.attempt,
                CAST(LEAST(3, FLOOR(4 * (c.s - l.lo) / (l.hi - l.lo + 1))) AS INT) AS cluster
         FROM comp c JOIN lim l ON c.paper_code = l.paper_code AND c.create_time = l.create_time),
bg AS (SELECT b.cluster, g.* FROM band b JOIN grid g ON b.paper_code = g.paper_code AND b.create_time = g.create_time
         AND b.stu_code = g.stu_code AND b.attempt = g.attempt)"""


def cluster_profile_given() -> str:
    p = """
pi AS (SELECT paper_code, create_time, cluster, item_id,
              CAST(SUM(score) AS DOUBLE) / (MAX(full_mark) * COUNT(score)) AS p
       FROM bg GROUP BY paper_code, create_time, cluster, item_id),
lists AS (SELECT paper_code, create_time, cluster,
  COALESCE(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FILTER (WHERE p BETWEEN 0.7 AND 0.8), '') AS good_item,
  COALESCE(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FILTER (WHERE p BETWEEN 0.2 AND 0.3), '') AS bad_item
  FROM pi GROUP BY paper_code, create_time, cluster)"""
    return oracle(
        """SELECT b.paper_code, b.create_time, b.stu_code, b.attempt, l.good_item, l.bad_item, b.cluster AS centers
FROM band b JOIN lists l ON b.paper_code = l.paper_code AND b.create_time = l.create_time AND b.cluster = l.cluster""",
        _GRID, _BANDS, p,
    )


def cluster_nearest_given() -> str:
    d = f"""
cent AS (SELECT paper_code, create_time, cluster, item_id, AVG(CAST(score AS DOUBLE)) AS c
         FROM bg GROUP BY paper_code, create_time, cluster, item_id),
d AS (SELECT g.paper_code, g.create_time, g.stu_code, g.attempt, c.cluster,
             ROUND(SUM((g.score - c.c) * (g.score - c.c)), 9) AS dist
      FROM bg g JOIN cent c ON c.paper_code = g.paper_code AND c.create_time = g.create_time AND c.item_id = g.item_id
      GROUP BY g.paper_code, g.create_time, g.stu_code, g.attempt, c.cluster)"""
    return oracle(
        f"""SELECT {_STU}, cluster FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {_STU} ORDER BY dist, cluster) AS rn FROM d) x WHERE rn = 1""",
        _GRID, _BANDS, d,
    )


def cluster_centers_given() -> str:
    return oracle(
        """SELECT paper_code, create_time, cluster, item_id, ROUND(AVG(CAST(score AS DOUBLE)), 6) AS center
FROM bg GROUP BY paper_code, create_time, cluster, item_id""",
        _GRID, _BANDS,
    )


_DIST = "list_sum(list_transform(list_zip(s.v, c.center), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
_ON_BATCH = "c.paper_code = s.paper_code AND c.create_time = s.create_time"


def _uniform(step: int) -> str:
    """48 bits of an MD5 digest as a number in (0, 1), one per sample and step."""
    text = f"s.stu_code || '|' || CAST(s.attempt AS VARCHAR) || '|{SEED}|{step}'"
    return f"((CAST(CAST('0x' || substr(md5({text}), 1, 12) AS UBIGINT) AS DOUBLE) + 0.5) / {float(1 << 48)!r})"


def _kmeans(rounds: int) -> list[str]:
    """k-means++ seeding and ``rounds`` Lloyd steps, unrolled: c0 are the seeds, c<r> the centres of step r."""
    vectors = f"""
vec AS MATERIALIZED (SELECT {_STU}, list(CAST(score AS DOUBLE) ORDER BY item_id) AS v FROM grid
        GROUP BY {_STU} HAVING COUNT(score) = COUNT(*)),
k0 AS MATERIALIZED (SELECT s.paper_code, s.create_time, 0 AS cluster, arg_max(s.v, {_uniform(0)}) AS center
       FROM vec s GROUP BY s.paper_code, s.create_time)"""
    out = [vectors]
    for j in range(1, K):
        out.append(f"""
d{j} AS (SELECT s.paper_code, s.create_time, s.stu_code, s.attempt, any_value(s.v) AS v, MIN({_DIST}) AS d
        FROM vec s JOIN k{j - 1} c ON {_ON_BATCH} GROUP BY s.paper_code, s.create_time, s.stu_code, s.attempt),
k{j} AS MATERIALIZED (SELECT * FROM k{j - 1} UNION ALL
        SELECT s.paper_code, s.create_time, {j}, arg_max(s.v, ln({_uniform(j)}) / s.d) FROM d{j} s WHERE s.d > 0
        GROUP BY s.paper_code, s.create_time)""")
    out.append(f"\nc0 AS (SELECT * FROM k{K - 1})")
    for r in range(1, rounds + 1):
        out.append(f"""
a{r} AS MATERIALIZED ({_nearest(f"c{r - 1}")}),
c{r} AS MATERIALIZED (SELECT paper_code, create_time, cluster, list(m ORDER BY pos) AS center FROM (
        SELECT paper_code, create_time, cluster, pos, AVG(x) AS m FROM (
          SELECT paper_code, create_time, cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{r})
        GROUP BY paper_code, create_time, cluster, pos) GROUP BY paper_code, create_time, cluster)""")
    return out


def _nearest(centers: str) -> str:
    return f"""SELECT paper_code, create_time, stu_code, attempt, any_value(v) AS v, MIN(struct_pack(d := dist, c := cluster)).c AS cluster
        FROM (SELECT s.*, c.cluster, {_DIST} AS dist FROM vec s JOIN {centers} c ON {_ON_BATCH})
        GROUP BY paper_code, create_time, stu_code, attempt"""


def _centers(rounds: int) -> str:
    return oracle(
        f"""SELECT paper_code, create_time, CAST(cluster AS INT) AS cluster, CAST(pos - 1 AS INT) AS pos, ROUND(x, 6) AS x
FROM (SELECT paper_code, create_time, cluster, unnest(center) AS x, generate_subscripts(center, 1) AS pos FROM c{rounds})""",
        _GRID, *_kmeans(rounds),
    )


def kmeans_seeds() -> str:
    return _centers(0)


def kmeans_steps() -> str:
    return _centers(3)


def kmeans_parallel_seeds() -> str:
    """k-means|| unrolled: rounds of oversampling, candidates weighed by their samples, k-means++ and Lloyd on them."""
    batch = "paper_code, create_time"
    out = [_kmeans(0)[0], f"\nq0 AS (SELECT {batch}, center FROM k0)"]
    for r in range(1, ROUNDS + 1):
        out.append(f"""
r{r} AS MATERIALIZED (SELECT s.paper_code, s.create_time, s.stu_code, s.attempt, any_value(s.v) AS v, MIN({_DIST}) AS d
        FROM vec s JOIN q{r - 1} c ON {_ON_BATCH} GROUP BY s.paper_code, s.create_time, s.stu_code, s.attempt),
f{r} AS (SELECT {batch}, SUM(d) AS cost FROM r{r} GROUP BY {batch}),
q{r} AS MATERIALIZED (SELECT * FROM q{r - 1} UNION SELECT s.paper_code, s.create_time, s.v
        FROM r{r} s JOIN f{r} c ON {_ON_BATCH} WHERE s.d > 0 AND {_uniform(r)} < {2.0 * K!r} * s.d / c.cost)""")
    text = "s.paper_code || '|' || s.create_time || '|' || CAST(s.id AS VARCHAR)"
    draw = {j: "ln((CAST(CAST('0x' || substr(md5(" + text + f" || '|{SEED}|{CANDIDATE_STEP + j}'), 1, 12) AS UBIGINT) AS DOUBLE) + 0.5) / {float(1 << 48)!r})" for j in range(K)}
    out.append(f"""
cand AS MATERIALIZED (SELECT {batch}, center, ROW_NUMBER() OVER (PARTITION BY {batch} ORDER BY center) - 1 AS cluster FROM q{ROUNDS}),
wt AS (SELECT {batch}, cluster, CAST(COUNT(*) AS DOUBLE) AS w FROM ({_nearest("cand")}) GROUP BY {batch}, cluster),
pts AS MATERIALIZED (SELECT s.paper_code, s.create_time, s.cluster AS id, s.center AS v, c.w
        FROM cand s JOIN wt c ON {_ON_BATCH} AND c.cluster = s.cluster),
s0 AS MATERIALIZED (SELECT {batch}, 0 AS cluster, arg_max(s.v, {draw[0]} / s.w) AS center FROM pts s GROUP BY {batch})""")
    for j in range(1, K):
        out.append(f"""
s{j} AS MATERIALIZED (SELECT * FROM s{j - 1} UNION ALL SELECT {batch}, {j}, arg_max(s.v, {draw[j]} / (s.w * s.d)) FROM (
        SELECT s.paper_code, s.create_time, s.id, any_value(s.v) AS v, any_value(s.w) AS w, MIN({_DIST}) AS d
        FROM pts s JOIN s{j - 1} c ON {_ON_BATCH} GROUP BY s.paper_code, s.create_time, s.id) s WHERE s.d > 0 GROUP BY {batch})""")
    for t in range(RECLUSTER_STEPS):
        before = f"s{K - 1}" if t == 0 else f"l{t}"
        out.append(f"""
l{t + 1} AS MATERIALIZED (SELECT {batch}, cluster, list(m ORDER BY pos) AS center FROM (
        SELECT {batch}, cluster, pos, SUM(w * x) / SUM(w) AS m FROM (
          SELECT {batch}, cluster, w, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM (
            SELECT {batch}, id, any_value(v) AS v, any_value(w) AS w, MIN(struct_pack(d := dist, c := cluster)).c AS cluster
            FROM (SELECT s.*, c.cluster, {_DIST} AS dist FROM pts s JOIN {before} c ON {_ON_BATCH}) GROUP BY {batch}, id))
        GROUP BY {batch}, cluster, pos) GROUP BY {batch}, cluster)""")
    return oracle(
        f"""SELECT {batch}, CAST(cluster AS INT) AS cluster, CAST(pos - 1 AS INT) AS pos, ROUND(x, 6) AS x
FROM (SELECT {batch}, cluster, unnest(center) AS x, generate_subscripts(center, 1) AS pos FROM l{RECLUSTER_STEPS})""",
        _GRID, *out,
    )


def clusters_summary() -> str:
    return oracle(
        """SELECT paper_code, create_time, COUNT(*) AS clusters, string_agg(CAST(size AS VARCHAR), ',' ORDER BY cluster) AS sizes
FROM (SELECT paper_code, create_time, cluster, COUNT(*) AS size FROM band GROUP BY paper_code, create_time, cluster)
GROUP BY paper_code, create_time""",
        _GRID, _BANDS,
    )


def student_clusters() -> str:
    """All steps of the fit, the final assignment, clusters renumbered by mean total, their item lists."""
    final = f"""
own AS MATERIALIZED ({_nearest(f"c{MAX_ITER}")}),
ord AS (SELECT paper_code, create_time, cluster,
          CAST(ROW_NUMBER() OVER (PARTITION BY paper_code, create_time ORDER BY AVG(list_sum(v)), cluster) - 1 AS INT) AS centers
        FROM own GROUP BY paper_code, create_time, cluster),
mine AS (SELECT o.paper_code, o.create_time, o.stu_code, o.attempt, r.centers FROM own o JOIN ord r
         ON r.paper_code = o.paper_code AND r.create_time = o.create_time AND r.cluster = o.cluster),
p AS (SELECT m.paper_code, m.create_time, m.centers, g.item_id, CAST(SUM(g.score) AS DOUBLE) / (MAX(g.full_mark) * COUNT(g.score)) AS p
      FROM mine m JOIN grid g ON g.paper_code = m.paper_code AND g.create_time = m.create_time
       AND g.stu_code = m.stu_code AND g.attempt = m.attempt GROUP BY m.paper_code, m.create_time, m.centers, g.item_id),
lists AS (SELECT paper_code, create_time, centers,
  COALESCE(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FILTER (WHERE p BETWEEN {GOOD[0]} AND {GOOD[1]}), '') AS good_item,
  COALESCE(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) FILTER (WHERE p BETWEEN {BAD[0]} AND {BAD[1]}), '') AS bad_item
  FROM p GROUP BY paper_code, create_time, centers)"""
    return oracle(
        """SELECT m.paper_code, m.create_time, m.stu_code, m.attempt, l.good_item, l.bad_item, m.centers
FROM mine m JOIN lists l ON l.paper_code = m.paper_code AND l.create_time = m.create_time AND l.centers = m.centers""",
        _GRID, *_kmeans(MAX_ITER), final,
    )


def item_index_narrow() -> str:
    cols = ", ".join(f"CAST(TRY_CAST({c} AS DECIMAL(4,3)) AS DOUBLE) AS {c}" for c in ("avg_score", "fc_score", "bzc_score", "nandu", "qufendu"))
    return oracle(
        f"SELECT paper_code, create_time, item_id, max_score, min_score, {cols} FROM ii",
        _TOTALS, _groups("propagate"), _GRID, _item_index(),
    )


def registry() -> dict[str, str]:
    return {
        "total_score_propagate": total_score("propagate"),
        "total_score_zero": total_score("zero"),
        "group_sizes": group_sizes(),
        "high_low_groups": high_low_groups("propagate"),
        "item_index": item_index("propagate"),
        "item_index_zero": item_index("zero"),
        "paper_index": paper_index("propagate"),
        "paper_index_zero": paper_index("zero"),
        "paper_index_rounded": paper_index("propagate", rounded=True),
        "item_index_grown": item_index("propagate"),
        "paper_index_grown": paper_index("propagate"),
        "responses_long": responses_long(),
        "json_sheets": json_sheets(),
        "json_fractional": json_fractional(),
        "rejected": rejected(),
        "result_round_trip": item_index("propagate"),
        "results_at_once": item_index("propagate"),
        "blueprint_items": blueprint_items(),
        "responses_complete": responses_complete(),
        "responses_marked": responses_marked(),
        "select_batch": select_batch(),
        "item_labels": item_labels(),
        "extreme_items": extreme_items(),
        "kept_items": kept_items(),
        "knowledge_full_marks": knowledge_full_marks(),
        "knowledge_scores": knowledge_scores(),
        "knowledge_scores_zero": knowledge_scores_zero(),
        "knowledge_labels": knowledge_labels(),
        "item_transactions": item_transactions(),
        "knowledge_transactions": knowledge_transactions(),
        "frequent_itemsets_le3": frequent_itemsets_le3(),
        "frequent_itemsets": frequent_itemsets(),
        "item_rules_1": item_rules_1(),
        "knowledge_rules_1": knowledge_rules_1(),
        "knowledge_rules_1_text": knowledge_rules_1(compare="string"),
        "item_rules": item_rules(),
        "knowledge_rules": knowledge_rules(),
        "knowledge_rules_text": knowledge_rules(compare="string"),
        "item_fpg": item_fpg(),
        "knowledge_fpg": knowledge_rules(fpg=True),
        "incomplete_sheets": incomplete_sheets(),
        "latest_attempt": latest_attempt(),
        "student_code_parts": student_code_parts(),
        "cluster_profile_given": cluster_profile_given(),
        "cluster_nearest_given": cluster_nearest_given(),
        "cluster_centers_given": cluster_centers_given(),
        "item_index_narrow": item_index_narrow(),
        "kmeans_seeds": kmeans_seeds(),
        "kmeans_parallel_seeds": kmeans_parallel_seeds(),
        "kmeans_steps": kmeans_steps(),
        "clusters_summary": clusters_summary(),
        "student_clusters": student_clusters(),
    }
