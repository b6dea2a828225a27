"""Plan-shape checks: no Python evaluation, single scan/shuffle for tracks, pushdown to the scan."""

import pytest

from skylens import registry

SF = "/root/testdata/sf0.001"


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_evaluation(spark, name):
    if name.startswith(("stream_", "epoch_")):
        pytest.skip("streams run their own queries")
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_movement_scans_and_shuffles_once(spark):
    plan = _final_plan(registry.queries()["movement_segments"](spark, SF)).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_range_filter_reaches_scan(spark, tmp_path):
    from pyspark.sql import functions as F
    from skylens.plans.analytics import in_range
    from skylens.plans.lake import build_lake
    from skylens.sources.events import state_rows, table
    build_lake(spark, state_rows(table(spark, SF, "events")), str(tmp_path / "lake"))
    silver = in_range(spark.read.parquet(str(tmp_path / "lake/silver")), "snapshot_time", 1704067200, 1704153600)
    plan = silver.select("icao24")._jdf.queryExecution().executedPlan().toString()
    import re
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "GreaterThanOrEqual(snapshot_time" in pushed and "LessThan(snapshot_time" in pushed
    assert "event_date" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in read.split(",")) == ["icao24", "snapshot_time"]
