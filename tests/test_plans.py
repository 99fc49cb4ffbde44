"""Plan shape: no Python UDFs, no Cartesian products, pushed filters, pruned
scans, partial aggregation before every shuffle of raw rows."""

import pytest

import __spark_entry__ as entry
from roadpulse.plans import registry
from tests.conftest import SF001

registry.load_all()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_udf_no_cartesian(spark, name):
    p = plan_text(QUERIES[name](spark, SF001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"


def test_day_filter_pushed_to_scan(spark):
    p = plan_text(QUERIES["day_scan"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_scan_is_column_pruned(spark):
    p = plan_text(QUERIES["volume_by_hour"](spark, SF001))
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "props" not in schema and "event_type" not in schema and "event_id" not in schema


@pytest.mark.parametrize("name", ["latest_status", "daily_report", "peak_hour_analysis", "tumbling_5min",
                                  "dataset_extent"])
def test_partial_aggregation_before_shuffle(spark, name):
    p = plan_text(QUERIES[name](spark, SF001))
    assert "partial_" in p


# Operators a shuffle may sit on without moving raw rows: aggregates (the
# partial side of a two-phase aggregation) and per-group limits/windows over
# already aggregated input.
REDUCING = ("HashAggregate", "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit", "Window", "Expand")
PASS_THROUGH = ("Project", "Filter", "WholeStageCodegen", "InputAdapter", "ColumnarToRow", "Sort",
                "Generate", "Union", "BroadcastHashJoin", "SortMergeJoin")


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _raw_feeds(node):
    """True when rows reach ``node`` from a file scan with no aggregate or
    window in between."""
    name = node.nodeName()
    if name.startswith("Scan") or "FileScan" in name or name.startswith("BatchScan"):
        return True
    if any(name.startswith(r) for r in REDUCING):
        return False
    if name.startswith("ShuffleExchange") or name.startswith("Exchange") or name.startswith("BroadcastExchange"):
        return False  # checked on its own
    return any(_raw_feeds(c) for c in _children(node))


def _hash_exchanges(node, out):
    """Hash-partitioned shuffles and broadcasts in a physical plan."""
    kind = node.getClass().getSimpleName()
    if kind == "ShuffleExchangeExec":
        if node.outputPartitioning().getClass().getSimpleName() == "HashPartitioning":
            out.append(node)
    elif kind == "BroadcastExchangeExec":
        out.append(node)
    for c in _children(node):
        _hash_exchanges(c, out)
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_raw_rows_shuffled_by_key(spark, name):
    """Every hash shuffle and every broadcast carries aggregated rows: a hot
    key never ships its raw rows, and no raw table is broadcast."""
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    for ex in _hash_exchanges(plan, []):
        assert not _raw_feeds(_children(ex)[0]), f"{name}: raw rows moved by {ex.nodeName()}"


def _find(node, simple_name, out):
    if node.getClass().getSimpleName() == simple_name:
        out.append(node)
    for c in _children(node):
        _find(c, simple_name, out)
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_expansion_of_raw_rows(spark, name):
    """Distinct counts and rollups expand rows (Expand); that must happen on
    aggregated rows only, never on the raw scan."""
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.initialPlan()
    for node in _find(plan, "ExpandExec", []):
        assert not _raw_feeds(_children(node)[0]), f"{name}: Expand over raw rows"


@pytest.mark.parametrize("name", ["latest_status", "daily_report", "peak_hour_analysis", "tumbling_5min",
                                  "summary_metrics", "dq_profile", "hourly_resample", "hour_grid"])
def test_aggregates_run_in_whole_stage_codegen(spark, name):
    df = QUERIES[name](spark, SF001)
    df.collect()   # the adaptive plan is final only after this DataFrame ran
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    aggregates = [ln for ln in final.split("\n") if "Aggregate(" in ln]
    assert aggregates and all("*(" in ln for ln in aggregates), aggregates
