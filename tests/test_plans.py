"""Plan checks: no Python UDFs anywhere, no cartesian products except the one
static-threshold row, filters pushed to the scans."""

import pytest

from terrascore import catalog

SF = "/root/testdata/sf0.001"
SKIP = {"sink_append", "sink_append_overlap", "sink_ledger", "sink_append_duplicates", "sink_replace", "src_geojson", "src_geojson_default_id",
        "src_polygons_table", "pipeline_build_all"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in catalog.QUERIES if k not in SKIP))
def test_no_python_udf_no_cartesian(spark, key):
    plan = _plan(catalog.QUERIES[key](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in plan, f"{key}: {bad}"
    # nested-loop joins only as the broadcast one-row static-threshold cross join
    import re
    assert plan.count("BroadcastNestedLoopJoin") == len(re.findall(r"BroadcastNestedLoopJoin BuildRight, Cross", plan)), key


def test_band_and_date_filters_reach_the_scan(spark):
    plan = _plan(catalog.QUERIES["job_ndvi"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)" in plan or "EqualTo(l_returnflag,A)" in plan
