"""Plan lint over every registered query: the physical plans must stay
JVM-side and avoid the operators that do not scale."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF001

FORBIDDEN = (
    "BroadcastNestedLoopJoin",  # a range join left to Spark
    "CartesianProduct",  # cross join
    "BatchEvalPython",  # row-at-a-time Python UDF
    "ArrowEvalPython",  # pandas UDF (none needed here)
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


@pytest.mark.parametrize("name", sorted(entry._reference_queries()))
def test_plan_has_no_unscalable_operators(spark, name):
    df = entry.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_written_plans_have_no_unscalable_operators(spark, monkeypatch):
    """The plans of what the jobs write, not only of what they return."""
    from pyspark.sql import DataFrameWriter

    seen = []

    def spy(method):
        def run(self, *args, **options):
            seen.append(self._df._jdf.queryExecution().executedPlan().toString())
            return method(self, *args, **options)

        return run

    for method in ("save", "insertInto", "json", "parquet"):
        monkeypatch.setattr(DataFrameWriter, method, spy(getattr(DataFrameWriter, method)))
    for name in ("scan_partitioned_day", "sink_parquet_rerun", "sink_table_rerun", "report_upsert", "etl_reports_day"):
        entry.queries()[name](spark, SF001)
    assert len(seen) >= 10
    for plan in seen:
        assert not any(op in plan for op in (*FORBIDDEN, "REPARTITION_BY_NUM")), plan


def test_day_queries_push_the_day_to_the_scan(spark):
    for name in ("region_distribution_day", "region_kpi_strict_day", "city_map_feed_day"):
        plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
        assert any("GreaterThanOrEqual(ts" in p and "LessThan(ts" in p for p in pushed), name


def test_kpi_plan_shape(spark):
    df = entry.queries()["region_kpi_strict"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # broadcast hash range join, partial + final aggregation, no sort
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "partial_sum" in plan
    assert "SortMergeJoin" not in plan and "Sort [" not in plan
