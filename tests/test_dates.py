import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrascore.functions.dates import parse_date_lenient, parse_date_strict
from terrascore.operators.raster import month_grid


def test_strict_parse_ok_and_null(spark):
    df = spark.createDataFrame([("2020-01-01",), (None,)], "d string")
    assert [r.x for r in df.select(parse_date_strict("d").alias("x")).collect()] == [dt.date(2020, 1, 1), None]


def test_strict_parse_rejects_bad_text(spark):
    df = spark.createDataFrame([("bad",)], "d string")
    with pytest.raises(Exception):
        df.select(parse_date_strict("d")).collect()


def test_lenient_parse(spark):
    df = spark.createDataFrame([("bad",), ("2020-02-03",)], "d string")
    assert [r.x for r in df.select(parse_date_lenient("d").alias("x")).collect()] == [None, dt.date(2020, 2, 3)]


def test_month_grid_default_run_has_60_months(spark):
    assert month_grid(spark, "2020-01-01", "2024-12-31").count() == 60


def test_month_grid_mid_month_start(spark):
    got = [r.month_str for r in month_grid(spark, "2020-01-15", "2020-03-10").orderBy("month").collect()]
    assert got == ["2020-02-01", "2020-03-01"]


def test_month_grid_empty(spark):
    assert month_grid(spark, "2020-01-15", "2020-01-31").count() == 0
