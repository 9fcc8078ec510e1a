"""Join operators: chained full outer joins on coalesced keys and the
threshold lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BOUNDS = ("optimal_min", "optimal_max", "acceptable_min", "acceptable_max")


def full_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``f1 FULL JOIN f2 USING (keys) FULL JOIN f3 USING (keys) ...``.

    The ``USING`` form yields one coalesced column per key, so the next join
    matches on ``coalesce(f1.k, f2.k)``. Duplicate keys multiply rows (no
    dedupe). Rows with a null key match nothing, and would all land on one
    reducer, which a full outer join can't split: they get a hash of their row as a
    further join key (0 for all others), so each frame is read once and they are dealt evenly."""
    key = "_deal"

    def dealt(f: DataFrame) -> DataFrame:
        loose = F.lit(False)
        for k in keys:
            loose = loose | F.col(k).isNull()
        return f.withColumn(key, F.when(loose, F.xxhash64(*f.columns)).otherwise(F.lit(0).cast("long")))

    out = dealt(frames[0])
    for f in frames[1:]:
        out = out.join(dealt(f), [*keys, key], "full_outer")
    return out.drop(key)


MAX_THRESHOLDS = 10_000


def unique_thresholds(thresholds: DataFrame) -> DataFrame:
    """The threshold rows; the query fails when a (feature, period) has several, or
    when there are more than MAX_THRESHOLDS (they are broadcast)."""
    one = thresholds.groupBy("feature", "period").agg(*[F.first(b).alias(b) for b in BOUNDS], F.count(F.lit(1)).alias("_n"))
    many = F.concat(F.lit("several threshold rows for "), F.coalesce("feature", F.lit("null")), F.lit(" / "), F.coalesce("period", F.lit("null")))
    sized = one.limit(MAX_THRESHOLDS + 1).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    checked = F.when(F.col("_n") > 1, F.raise_error(many)).when(F.col("_rows") > MAX_THRESHOLDS, F.raise_error(F.lit("too many threshold rows")))
    return sized.withColumn("feature", F.coalesce(checked.cast("string"), F.col("feature"))).select("feature", "period", *BOUNDS)


def seasonal_bounds(thresholds: DataFrame, feature: str, prefix: str | None = None) -> DataFrame:
    """Threshold rows of one feature keyed by period (the join's constant
    condition ``feature = '...'`` applied before the join)."""
    p = f"{prefix}_" if prefix else ""
    return thresholds.filter(F.col("feature") == feature).select(
        F.col("period").alias(f"{p}period"), *[F.col(b).alias(f"{p}{b}") for b in BOUNDS]
    )


def static_bounds_row(thresholds: DataFrame, features: Sequence[str], period: str = "static") -> DataFrame:
    """Collapse the static rows of several features into ONE wide row
    (``<feature>_<bound>`` columns). A global aggregate returns one row even on
    empty input (all nulls), so a cross join with it keeps every left row —
    the same rows as the ``LEFT JOIN ... ON period = 'static' AND feature = f``
    chain, as (feature, period) is unique (``unique_thresholds``), in one
    broadcast instead of five nested-loop joins."""
    static = thresholds.filter(F.col("period") == period)
    aggs = [
        F.max(F.when(F.col("feature") == f, F.col(b))).alias(f"{f}_{b}")
        for f in features
        for b in BOUNDS
    ]
    return static.groupBy().agg(*aggs)


def attach_static_bounds(df: DataFrame, thresholds: DataFrame, features: Sequence[str],
                         period: str = "static") -> DataFrame:
    """Left-join every row of ``df`` to the static bounds of ``features``. The
    right side is one row by construction, so the broadcast is size-proven."""
    return df.crossJoin(F.broadcast(static_bounds_row(thresholds, features, period)))


def attach_seasonal_bounds(df: DataFrame, thresholds: DataFrame, feature: str,
                           period_col: str = "agricultural_period") -> DataFrame:
    """``LEFT JOIN thresholds t ON df.period = t.period AND t.feature = f``;
    bound columns come out as ``<feature>_<bound>``. The right side has one row
    per period and MAX_THRESHOLDS at most (``unique_thresholds``), so it is
    broadcast."""
    b = seasonal_bounds(thresholds, feature, prefix=feature)
    return df.join(F.broadcast(b), df[period_col] == b[f"{feature}_period"], "left").drop(f"{feature}_period")
