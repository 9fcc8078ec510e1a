"""Post-build checks: one row per check with the number of failing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import OTHER_PERIOD, SCORE_COLUMNS, SEASONS


def _dupes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("failing"))


class ChecksFailed(RuntimeError):
    """Some check found failing rows; ``failing`` has them by name."""

    def __init__(self, failing: dict[str, int]):
        super().__init__("checks failed: " + ", ".join(f"{k} ({v} rows)" for k, v in sorted(failing.items())))
        self.failing = failing


def raise_on_failures(checks: dict[str, int]) -> None:
    failing = {k: v for k, v in checks.items() if v}
    if failing:
        raise ChecksFailed(failing)


def threshold_checks(thresholds: DataFrame) -> DataFrame:
    return _dupes(thresholds, ["feature", "period"]).select(F.lit("thresholds_unique_feature_period").alias("check"), "failing")


def quality_checks(fact: DataFrame, thresholds: DataFrame, location: DataFrame) -> DataFrame:
    """``check string, failing long``; one row per check, on empty input too.

    The row checks and the key check of the fact share one pass: rows are
    counted per key with how many of them fail each check, and these counts are
    added up. The fact is read once more for its distinct fields."""
    in_range = F.lit(True)
    for c in SCORE_COLUMNS + ("total_suitability_score",):
        in_range = in_range & F.col(c).between(0.0, 1.0)
    rules = {
        "fact_not_null_keys": F.col("field_id").isNull() | F.col("date").isNull(),
        "fact_season_accepted": ~F.coalesce(F.col("agricultural_period").isin(*SEASONS, OTHER_PERIOD), F.lit(False)),
        "fact_scores_in_unit_range": ~F.coalesce(in_range, F.lit(False)),
    }
    by_key = fact.groupBy("field_id", "date").agg(
        (F.count(F.lit(1)) - 1).alias("fact_unique_field_date"), *[F.count(F.when(cond, 1)).alias(name) for name, cond in rules.items()])
    names = ["fact_unique_field_date", *rules]
    sums = by_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])
    fact_rows = sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failing")) for n in names])).alias("c")).select("c.*")
    missing = (fact.select("field_id").distinct().join(location.select("field_id"), "field_id", "left_anti")
               .agg(F.count(F.lit(1)).cast("long").alias("failing")))
    parts = [fact_rows, missing.select(F.lit("fact_field_in_dim_location").alias("check"), "failing"), threshold_checks(thresholds),
             _dupes(location, ["field_id"]).select(F.lit("dim_location_unique_field").alias("check"), "failing")]
    return reduce(DataFrame.unionByName, parts)
