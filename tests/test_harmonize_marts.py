import datetime as dt

from pyspark.sql import functions as F

from terrascore.plans.harmonize import harmonize, series_by_month, series_by_month_unique
from terrascore.plans.marts import assessment_dataset, dim_date, dim_location
from terrascore.plans.scoring import fact_suitability
from terrascore.operators.aggregates import field_season_averages, pivot_seasons, pivot_seasons_direct
from terrascore.sources.tables import seed_thresholds

D1, D2, D9 = dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 9, 1)


def _series(spark, name, rows):
    return spark.createDataFrame(rows, f"field_id string, date date, {name} double")


def _soil(spark, rows):
    return spark.createDataFrame(
        rows, "field_id string, lat double, lon double, soil_ph double, soil_cec double, clay double, "
              "silt double, sand double")


def test_full_outer_keeps_one_sided_and_null_keys(spark):
    n = _series(spark, "ndvi", [("a", D1, 0.5), ("x", None, 0.1)])
    t = _series(spark, "temperature", [("b", D1, 20.0), ("y", None, 15.0)])
    r = _series(spark, "rainfall", [("c", D2, 80.0), ("a", D1, 60.0)])
    md = series_by_month(n, t, r)
    rows = {(x.field_id, x.date): x for x in md.collect()}
    assert len(rows) == 5                      # a, b, c, and two null-date rows that do not merge
    assert rows[("a", D1)].rainfall == 60.0 and rows[("a", D1)].temperature is None
    assert rows[("c", D2)].agricultural_period == "germination_early_growth"
    assert rows[("x", None)].agricultural_period == "other_period"


def test_duplicate_keys_multiply(spark):
    rows = lambda name: _series(spark, name, [("a", D1, 1.0), ("a", D1, 2.0)])
    assert series_by_month(rows("ndvi"), rows("temperature"), rows("rainfall")).count() == 8


def test_unique_fast_path_equals_join_on_unique_keys(spark):
    n = _series(spark, "ndvi", [("a", D1, 0.5), ("b", D2, 0.2), ("n", None, 0.3)])
    t = _series(spark, "temperature", [("a", D1, 20.0), ("c", D9, 11.0)])
    r = _series(spark, "rainfall", [("b", D2, 80.0), ("n", None, 9.0)])
    a = sorted(map(tuple, series_by_month(n, t, r).collect()), key=repr)
    b = sorted(map(tuple, series_by_month_unique(n, t, r).select(*series_by_month(n, t, r).columns).collect()), key=repr)
    assert a == b


def test_soil_only_field_absent_and_missing_soil_null(spark):
    n = _series(spark, "ndvi", [("a", D1, 0.5)])
    empty_t, empty_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    soil = _soil(spark, [("z", 30.0, -8.0, 6.5, 20.0, 30.0, 40.0, 45.0)])
    h = harmonize(n, empty_t, empty_r, soil)
    assert [r.field_id for r in h.collect()] == ["a"]
    assert h.first().soil_ph is None
    assert dim_location(soil).count() == 1


def test_other_period_field_keeps_row_of_nulls(spark):
    n = _series(spark, "ndvi", [("sep", D9, 0.5), ("jan", D1, 0.2)])
    empty_t, empty_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    soil = _soil(spark, [("jan", 30.0, -8.0, 6.5, 20.0, 30.0, 40.0, 45.0)])
    h = harmonize(n, empty_t, empty_r, soil)
    fact = fact_suitability(h, seed_thresholds(spark))
    a = {r.field_id: r for r in assessment_dataset(fact, dim_location(soil)).collect()}
    assert set(a) == {"sep", "jan"}
    sep = a["sep"].asDict()
    assert all(v is None for k, v in sep.items() if k != "field_id")
    assert a["jan"].ndvi_score_germination_early_growth == 1.0
    # other_period rows: seasonal scores 0, so total <= 0.1; no soil row -> soil scores 0
    f = {r.field_id: r for r in fact.collect()}
    assert f["sep"].total_suitability_score == 0.0
    assert f["jan"].total_suitability_score <= 1.0


def test_pivot_direct_equals_two_step(spark):
    from terrascore import catalog
    fact = catalog.fact(spark, "/root/testdata/sf0.001")
    two = pivot_seasons(field_season_averages(fact))
    one = pivot_seasons_direct(fact).select(*two.columns)
    r = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.collect())
    assert r(two) == r(one)


def test_dim_date_sorted_and_unique(spark):
    n = _series(spark, "ndvi", [("a", D2, 0.5), ("b", D1, 0.2), ("c", D1, 0.3)])
    e_t, e_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    d = dim_date(harmonize(n, e_t, e_r, _soil(spark, []))).collect()
    assert [r.date for r in d] == [D1, D2]
    assert d[0].year == 2020 and d[0].month == 1


def test_null_keys_are_dealt_evenly(spark):
    """Many null keys neither multiply nor meet in one task, and each frame is read once."""
    n = _series(spark, "ndvi", [("a", D1, 0.5), *[(None, D1, 0.1)] * 40, *[("n", None, 0.2)] * 40])
    t = _series(spark, "temperature", [("a", D1, 20.0), *[(None, D1, 9.0)] * 40])
    md = series_by_month(n, t, _series(spark, "rainfall", [(None, None, 1.0)]))
    assert md.count() == 1 + 40 + 40 + 40 + 1
    plan = md._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Union" not in plan and plan.count("hashpartitioning(field_id") >= 3
    assert all("_deal" in line for line in plan.splitlines() if "hashpartitioning(field_id" in line)


def test_several_threshold_rows_fail_alike(spark):
    import pytest
    from terrascore import schemas
    n = _series(spark, "ndvi", [("a", D1, 0.2)])
    e_t, e_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    h = harmonize(n, e_t, e_r, _soil(spark, [("a", 30.0, -8.0, 6.5, 20.0, 30.0, 40.0, 45.0)]))
    seed = seed_thresholds(spark)
    for feature, period in (("ndvi", "germination_early_growth"), ("clay", "static")):
        twice = seed.union(spark.createDataFrame([(feature, period, 1.0, 2.0, 0.0, 3.0)], schemas.THRESHOLDS))
        with pytest.raises(Exception, match="several threshold rows"):
            fact_suitability(h, twice).collect()


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    from terrascore.functions.exact import exact_mean, exact_sum
    values = [0.1, 0.2, 0.3, 1e9, -1e9, float("nan"), None]
    one = spark.createDataFrame([(x,) for x in values], "v double")
    two = spark.createDataFrame([(x,) for x in reversed(values)], "v double").repartition(5)
    a, b = (f.agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).first() for f in (one, two))
    assert a == b and a.s == 0.6 and a.m == 0.12


def test_sums_keep_values_that_decimals_cannot_hold(spark):
    from terrascore.functions.exact import exact_mean, exact_sum
    groups = {"small": [2e-13, 4e-13], "large": [1e30, 3e30], "many": [9e24] * 40, "infinite": [1.0, float("inf")], "zero": [0.0, 0.0], "mixed": [1e-13, 0.5]}
    frame = spark.createDataFrame([(g, x) for g, values in groups.items() for x in values], "g string, v double")
    got = {r.g: (r.s, r.m) for r in frame.groupBy("g").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()}
    assert got["infinite"] == (float("inf"), float("inf")) and got["zero"] == (0.0, 0.0) and got["mixed"] == (0.5, 0.25)
    for g in ("small", "large", "many"):
        want = sum(groups[g])
        assert abs(got[g][0] / want - 1) < 1e-12 and abs(got[g][1] * len(groups[g]) / want - 1) < 1e-12


def test_trends_keep_rows_without_a_date(spark):
    from terrascore.plans.reports import report_trends
    n = _series(spark, "ndvi", [("a", D1, 0.2), ("b", None, 0.4)])
    e_t, e_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    fact = fact_suitability(harmonize(n, e_t, e_r, _soil(spark, [])), seed_thresholds(spark))
    assert {(r.year, r.n_rows, r.avg_ndvi) for r in report_trends(fact).collect()} == {(2020, 1, 0.2), (None, 1, 0.4)}


def test_checks_find_and_raise(spark):
    import pytest
    from terrascore.plans.quality import ChecksFailed, quality_checks, raise_on_failures
    n = _series(spark, "ndvi", [("a", D1, 0.2), ("a", D1, 0.3), (None, D1, 0.4)])
    e_t, e_r = _series(spark, "temperature", []), _series(spark, "rainfall", [])
    fact = fact_suitability(harmonize(n, e_t, e_r, _soil(spark, [])), seed_thresholds(spark))
    checks = quality_checks(fact, seed_thresholds(spark), dim_location(_soil(spark, [])))
    found = {r["check"]: r["failing"] for r in checks.collect()}
    assert found["fact_unique_field_date"] == 1 and found["fact_not_null_keys"] == 1 and found["fact_field_in_dim_location"] == 2
    with pytest.raises(ChecksFailed, match="fact_unique_field_date"):
        raise_on_failures(found)
    raise_on_failures({k: 0 for k in found})
