"""Plan checks: pruned scans, no single-partition exchange, sheets never shuffled for a join."""

from __future__ import annotations

import os
import re

import pytest

from conftest import SF_SMALL
from itemstats.operators import item_stats, reshape, totals
from itemstats.sources import fixture

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables missing")


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns(spark):
    r = fixture.responses(spark, SF_SMALL)
    plan = r._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in schemas
    assert all("l_comment" not in s and "l_shipdate" not in s for s in schemas)


def test_item_stats_do_not_shuffle_sheets(spark):
    items = reshape.blueprint_items(fixture.blueprint(spark, SF_SMALL))
    sheets = reshape.answer_sheets(fixture.responses(spark, SF_SMALL)).checkpoint()
    grouped = totals.high_low_groups(totals.total_score(sheets, items))
    plan = _final_plan(item_stats.from_groups(grouped, items))
    assert "SinglePartition" not in plan
    # every join against the per-paper tables and the histogram is a broadcast after its size check
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan
