"""Plan audit over every registered query: no cartesian product or nested-loop
join anywhere, and a single-partition exchange only where the data reaching
it is bounded (global aggregates merge one partial row per task; the
category order and the archive index gather one row per category / day)."""
import __spark_entry__ as entry
from quire.plans import registry

SF = "/root/testdata/sf0.001"
SINGLE_PARTITION_OK = {"a5_dedup_report", "a5_dedup_report_docs", "a5_dedup_report_empty_day",
                       "a6_filter_report", "f12_empty_guard", "f18_date_ceiling", "o1_category_order",
                       "s12_archive_index",
                       # the check's own numbering of a few presented rows
                       "o4_newest_first", "o7_chronological"}


def test_no_cross_products_and_bounded_single_partitions(spark):
    problems = {}
    entry.queries()
    for name, fn in sorted(registry.QUERIES.items()):
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        if "SinglePartition" in plan and name not in SINGLE_PARTITION_OK:
            hits.append("SinglePartition")
        if hits:
            problems[name] = hits
    assert not problems, problems


def test_filters_reach_the_scan(spark):
    plan = entry.queries()["j1_lookback_antijoin"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
