import math

import pytest
from pyspark.sql import functions as F

from terrascore.functions.scoring import season_label, trapezoid_score, weighted_index
from terrascore.plans.scoring import total_score


def _scores(spark, values, bounds):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = df.select(trapezoid_score(F.col("v"), *[F.lit(b).cast("double") for b in bounds]).alias("s"))
    return [r.s for r in out.collect()]


def test_trapezoid_hand_vectors(spark):
    vals = [0.39, 0.4, 0.5, 0.6, 0.8, 0.85, 0.9, 0.91, None, math.nan]
    got = _scores(spark, vals, (0.6, 0.8, 0.4, 0.9))
    want = [0, 0.5, 0.75, 1, 1, 0.75, 0.5, 0, 0, 0]
    assert [round(g, 6) for g in got] == want


def test_trapezoid_null_bounds_score_zero(spark):
    assert _scores(spark, [0.5, 10.0, None], (None, None, None, None)) == [0.0, 0.0, 0.0]


def test_trapezoid_empty_ramp_no_division_error(spark):
    # optimal_min == acceptable_min: the rising ramp is empty, nothing divides by zero
    assert _scores(spark, [5.0, 4.0, 8.0], (5.0, 7.0, 5.0, 7.0)) == [1.0, 0.0, 0.0]


def test_scores_in_zero_or_half_to_one(spark):
    vals = [x / 10 for x in range(-20, 130)]
    for s in _scores(spark, vals, (6.0, 7.5, 5.5, 8.0)):
        assert s == 0 or 0.5 <= s <= 1


def test_season_labels(spark):
    months = [1, 2, 3, 5, 6, 8, 9, 10, 11, 12, None]
    df = spark.createDataFrame([(m,) for m in months], "m long")
    got = [r.p for r in df.select(season_label("m").alias("p")).collect()]
    g, v, s, o = "germination_early_growth", "vegetative_growth", "sugar_accumulation", "other_period"
    assert got == [g, g, v, v, s, s, o, o, g, g, o]


@pytest.mark.parametrize("ones,period_score,expected", [(True, 1.0, 1.0), (True, 0.0, 0.1)])
def test_total(spark, ones, period_score, expected):
    cols = {f"{n}_score": period_score for n in ("ndvi", "temperature", "rainfall")}
    cols.update({f"{n}_score": 1.0 for n in ("soil_ph", "soil_cec", "clay", "silt", "sand")})
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} double" for k in cols))
    assert df.select(total_score().alias("t")).first().t == pytest.approx(expected)


def test_weighted_index_order(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert df.select(weighted_index([("a", 0.5), ("b", 0.25)]).alias("x")).first().x == 1.0
