"""The whole analysis for many papers and batches in one Spark application (F1, F9, §3).

Steps, as the reference's ``executorStep`` digits:

* ``"1"`` statistics: ``t_score_total``, ``t_item_index``, ``t_paper_index``;
* ``"2"`` association rules between knowledge points (and between items with
  ``item_rules=True``, the reference's commented-out variant): ``t_item_fpg``;
* ``"3"`` student clusters: ``t_item_cluster``.

The long responses are shuffled once into answer sheets, which are written as
Parquet below the session's ``spark.checkpoint.dir`` (a shared folder on a
cluster), so every result reads only its columns of the same sheets and a lost
executor costs a re-read, not a recomputation from the raw files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from itemstats import defaults
from itemstats.functions.sizing import stored
from itemstats.operators import clusters, item_stats, paper_stats, reshape, rules, totals
from itemstats.schema import BATCH_KEYS, STUDENT_KEYS
from itemstats.session import ensure_checkpoint_dir
from itemstats.sinks import external, store
from itemstats.sinks import results as sinks


@dataclass
class Options:
    missing: str = "propagate"
    fraction: float = defaults.GROUP_FRACTION
    rounded: bool = False
    item_support: float = defaults.ITEM_SUPPORT
    knowledge_support: float = defaults.KNOWLEDGE_SUPPORT
    confidence: float = defaults.CONFIDENCE
    order_compare: str = "int"
    extreme_lo: float = defaults.EXTREME_LO
    extreme_hi: float = defaults.EXTREME_HI
    item_rules: bool = False
    k: int = defaults.K
    max_iter: int = defaults.MAX_ITER
    include_code: bool = False
    narrow: bool = False


def analyse(responses: DataFrame | None, blueprint: DataFrame, item_knowledge: DataFrame | None = None,
            steps: str = "123", requests: DataFrame | None = None, options: Options | None = None,
            sheets: DataFrame | None = None) -> dict[str, DataFrame]:
    """Build the result DataFrames of the requested steps (MLlib fits run eagerly).

    Input is the long ``responses`` or, from :func:`itemstats.sources.responses.read_sheets`,
    ready ``sheets``.  ``requests(paper_code, create_time)`` restricts the run to
    those batches (a semi join); by default every batch is analysed.
    """
    o = options or Options()
    sheets, items = _inputs(responses, blueprint, requests, sheets)
    return _results(sheets, items, item_knowledge, steps, o)


def _inputs(responses: DataFrame | None, blueprint: DataFrame, requests: DataFrame | None,
            sheets: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Stored answer sheets of the batches asked for, and the blueprint's items."""
    src = sheets if sheets is not None else responses
    if src is None:
        raise ValueError("give responses or sheets")
    ensure_checkpoint_dir(src.sparkSession)
    if requests is not None:
        src = src.join(requests.select(*BATCH_KEYS).distinct(), BATCH_KEYS, "left_semi")
    items = reshape.blueprint_items(blueprint)
    sheets = stored(src if sheets is not None else reshape.answer_sheets(src))
    return sheets, items


def _results(sheets: DataFrame, items: DataFrame, item_knowledge: DataFrame | None, steps: str, o: Options) -> dict[str, DataFrame]:
    out: dict[str, DataFrame] = {}
    ii = None
    if "1" in steps or ("2" in steps and o.item_rules):
        t = totals.total_score(sheets, items, o.missing)
        grouped = stored(totals.high_low_groups(t, o.fraction))
        ii = item_stats.from_groups(grouped, items)
        if "1" in steps:
            out["t_score_total"] = grouped.select(*STUDENT_KEYS, "total_score")
            out["t_item_index"] = ii
            out["t_paper_index"] = paper_stats.compute(grouped, ii, items, rounded=o.rounded)
    if "2" in steps:
        fpg = []
        if item_knowledge is not None:
            kr = rules.knowledge_rules(sheets, item_knowledge, items, o.knowledge_support, o.confidence,
                                       o.order_compare, o.missing)
            fpg.append(rules.format_rules(kr))
        if o.item_rules:
            ir = rules.item_rules(sheets, items, ii, o.item_support, o.confidence, o.extreme_lo, o.extreme_hi, o.rounded)
            fpg.append(rules.format_rules(ir))
        if fpg:
            res = fpg[0]
            for f in fpg[1:]:
                res = res.unionByName(f)
            out["t_item_fpg"] = res
    if "3" in steps:
        prof, _ = clusters.run(sheets, items, o.k, o.max_iter, include_code=o.include_code, missing=o.missing)
        out["t_item_cluster"] = prof
    if o.narrow:
        out = {name: sinks.narrow(df, name) for name, df in out.items()}
    return out


def run(responses: DataFrame | None, blueprint: DataFrame, target: str, item_knowledge: DataFrame | None = None,
        steps: str = "123", requests: DataFrame | None = None, options: Options | None = None,
        as_table: bool = False, sheets: DataFrame | None = None, jdbc: dict[str, str] | None = None,
        at_once: bool = False) -> dict[str, DataFrame]:
    """:func:`analyse`, then write every result under ``target`` (``<target>/<table>`` or
    ``<target>.<table>`` with ``as_table``, created where missing), replacing only the batches
    analysed, also where they now give no row.  With ``at_once`` the tables of the batches are replaced
    together by one commit of :mod:`itemstats.sinks.store` under ``target``, so a failure between two of
    them leaves the old rows in all.  With ``jdbc`` (``url``, connection properties and optionally ``epoch``) the
    batches are replaced in database tables of the same names as well, in one transaction
    (:func:`itemstats.sinks.external.commit_jdbc`).  Step 3 also writes ``t_left_out``, the samples
    without a cluster and why."""
    o = options or Options()
    if at_once and as_table:
        raise ValueError("at_once keeps its own folders: give a path")
    if as_table:
        sinks.ensure_tables((responses if responses is not None else sheets).sparkSession, target)
    sheets, items = _inputs(responses, blueprint, requests, sheets)
    res = _results(sheets, items, item_knowledge, steps, o)
    analysed = reshape.batches(sheets)
    report = {"t_left_out": clusters.left_out(sheets, items, o.include_code, o.missing)} if "3" in steps else {}
    if at_once:
        store.commit(res | report, target, analysed)
    else:
        for name, df in (res | report).items():
            sinks.write_result(df, f"{target}.{name}" if as_table else f"{target.rstrip('/')}/{name}", as_table, analysed)
    if jdbc:
        properties = {k: v for k, v in jdbc.items() if k not in ("url", "epoch")}
        external.commit_jdbc(res, jdbc["url"], properties, analysed=analysed, epoch=jdbc.get("epoch"))
    return res
