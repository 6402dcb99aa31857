"""What the plans must look like, whatever the data size."""

from __future__ import annotations

import pytest

from conftest import plan_of
from tallyline.operators.compact import latest_per_key
from tallyline.operators.decode import decode_changes
from tallyline.operators.indicators import with_indicators
from tallyline.operators.merge import merge_state
from tallyline.plans import derived
from tallyline.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
# These run jobs when called; the tolerant form is Python by design.
OTHER = ("snapshot", "stream", "csv", "table_load", "change_log_text", "html_statement_tolerant")
LAZY = [n for n in REGISTRY if not n.startswith(OTHER)]


@pytest.mark.parametrize("name", LAZY)
def test_no_query_leaves_the_jvm_or_crosses(spark, name):
    plan = plan_of(REGISTRY[name][0](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def test_documents_are_parsed_once(spark):
    plan = plan_of(decode_changes(derived.change_log(spark, SF), derived.EVENT_ROW, derived.EVENT_KEYS))
    assert plan.count("from_json(") == 1


def test_latest_rows_are_reduced_before_the_shuffle(spark):
    events = decode_changes(derived.change_log(spark, SF), derived.EVENT_ROW, derived.EVENT_KEYS)
    plan = plan_of(latest_per_key(events, derived.EVENT_KEYS, method="aggregate"))
    assert "partial_max_by" in plan.split("Exchange")[1]
    plan = plan_of(latest_per_key(events, derived.EVENT_KEYS, method="window"))
    assert "Partial" in plan.split("Exchange")[1]


def test_statement_scan_reads_needed_columns_only(spark):
    plan = plan_of(derived.statements(spark, SF, measures=["sales"]))
    lines = [x for x in plan.splitlines() if "FileScan" in x and "lineitem" in x]
    assert len(lines) == 1 and "l_shipdate" not in lines[0] and "l_discount" not in lines[0]
    plan = plan_of(derived.statements(spark, SF, "F"))
    assert "EqualTo(l_linestatus,F)" in plan


def test_merge_is_one_exchange_per_side(spark):
    accounts = derived.stored_accounts(spark, SF)
    plan = plan_of(merge_state(accounts, accounts, derived.EVENT_KEYS))
    assert plan.count("Exchange hashpartitioning") == 2


def test_indicators_share_one_window(spark):
    plan = plan_of(with_indicators(derived.statements(spark, SF)))
    assert plan.count("Window [") == 1
