"""Threshold seed, pixel tables, raw tables and the two load sinks."""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import THRESHOLD_SEED


# ---- thresholds -----------------------------------------------------------

def read_thresholds_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV with a header; explicit schema so integer-looking bounds stay
    double."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schemas.THRESHOLDS).csv(path)


def seed_thresholds(spark: SparkSession) -> DataFrame:
    """The built-in seed (14 rows) as a DataFrame."""
    return spark.createDataFrame(list(THRESHOLD_SEED), schemas.THRESHOLDS)


def write_thresholds_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


# ---- pixel tables (stand-ins for image collections) ----------------------

def read_pixels(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                band: str | None = None) -> DataFrame:
    """A time-indexed pixel table restricted to ``[start, end)`` and one band.
    Both filters reach the Parquet scan; a month-partitioned layout prunes
    whole partitions."""
    from ..operators.raster import date_range
    df = spark.read.parquet(path)
    if band is not None:
        df = df.filter(F.col("band") == band)
    if start is not None or end is not None:
        df = date_range(df, start or "0001-01-01", end or "9999-12-31")
    return df


def read_static_pixels(spark: SparkSession, path: str, bands: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.filter(F.col("band").isin(*bands)) if bands else df


def write_pixels(df: DataFrame, path: str) -> None:
    """Layout for time-indexed pixels: partitioned by band and month, so a
    date-range scan of one band reads only its partitions. The rebalance
    hint groups rows by partition (few files per folder) and lets AQE split a
    band-month that exceeds the advisory partition size across many tasks."""
    (df.withColumn("month", F.trunc(F.col("image_date"), "MM"))
       .hint("rebalance", "band", "month")
       .write.mode("overwrite").partitionBy("band", "month").parquet(path))


# ---- raw tables and sinks ------------------------------------------------

def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A raw table by catalog name (``db.table``) or by Parquet path."""
    if _is_path(name_or_path):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def write_replace(df: DataFrame, name_or_path: str) -> None:
    """Replace the whole table (soil, polygons)."""
    if _is_path(name_or_path):
        df.write.mode("overwrite").parquet(name_or_path)
    else:
        df.write.mode("overwrite").saveAsTable(name_or_path)


@dataclass(frozen=True)
class Load:
    """What a run loads into a series table: the months of one polygon set from ``start`` on and before ``end``.

    The run owns these months whatever period earlier runs asked for: it replaces all that
    is there of them, also where it has no rows, and leaves other months and other sets
    alone. ``only`` narrows it to some of its months."""

    polygon_set: str
    start: str
    end: str
    only: tuple[str, ...] | None = None

    @property
    def folder(self) -> str:
        return re.sub(r"[^A-Za-z0-9_.-]+", "_", self.polygon_set)

    def months(self) -> list[str]:
        first, end = _dt.date.fromisoformat(self.start), _dt.date.fromisoformat(self.end)
        n = first.year * 12 + first.month - 1 + (first.day > 1)  # a start that is no first day begins at the next month
        out = []
        while (month := _dt.date(n // 12, n % 12 + 1, 1)) < end:
            out.append(month.isoformat())
            n += 1
        return out if self.only is None else [m for m in out if m in self.only]


def load_name(polygon_set: str, start: str, end: str) -> Load:
    """The load of one polygon set over one period."""
    return Load(polygon_set, start, end)


#: The polygon set of rows that were appended without a load.
APPENDED = "appended"
#: Folder of a series table that holds its ledger; readers of the table pass over it.
LEDGER = "_loads"
LEDGER_SCHEMA = "run string, polygon_set string, start string, end string, month string, rows long, written_at timestamp"


def _is_path(name_or_path: str) -> bool:
    return "/" in name_or_path or name_or_path.startswith("file:")


def table_folder(spark: SparkSession, name_or_path: str) -> str:
    """The folder of a series table given by path or by catalog name."""
    if _is_path(name_or_path):
        return name_or_path.rstrip("/")
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name_or_path}").where("col_name = 'Location'").first()
    return found["data_type"].rstrip("/")


def read_ledger(spark: SparkSession, name_or_path: str) -> DataFrame:
    """What each run wrote: run, polygon_set, start, end, month, rows (0: the run owns the month and has none), written_at."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{table_folder(spark, name_or_path)}/{LEDGER}")


def month_owners(ledger: DataFrame) -> DataFrame:
    """polygon_set, month, and the run that owns it (the last one), with its rows."""
    last = F.max_by(F.struct("run", "rows"), F.struct("written_at", "run"))
    return ledger.groupBy("polygon_set", "month").agg(last.alias("last")).select("polygon_set", "month", "last.run", "last.rows")


def _create_series_table(df: DataFrame, name: str, partition_col: str) -> None:
    """The empty partitioned table, from the schema alone: ``df`` doesn't run for it."""
    empty = df.sparkSession.createDataFrame([], df.schema).withColumn("polygon_set", F.lit(APPENDED)).limit(0)
    empty.write.partitionBy("polygon_set", partition_col).saveAsTable(name)


def write_append(df: DataFrame, name_or_path: str, load: Load | None = None,
                 partition_col: str = "date") -> None:
    """Load a monthly series into a table partitioned by polygon set and month.

    With ``load`` its months are replaced, each whole: reruns, and runs over longer,
    shorter or overlapping periods, leave the rows that one run over all of them gives. A row of a month that is not
    the load's fails the write. The overwrite mode is an option of the write itself and months
    without rows are dropped by name, so no session setting matters. What the run wrote
    is added to the ledger (``read_ledger``) at the end; a run that dies before is to be repeated, and replaces its own rows then.
    Without a load the rows are appended (a rerun duplicates them, as the original loader does)."""
    spark, is_path = df.sparkSession, _is_path(name_or_path)
    if not is_path and not spark.catalog.tableExists(name_or_path):
        _create_series_table(df, name_or_path, partition_col)
    columns = [c for c in df.columns if c != partition_col]
    if load is None:
        # Group rows by month before the partitioned write (a few files per month
        # instead of one per task and month); AQE splits an oversized month.
        named = df.hint("rebalance", partition_col).withColumn("polygon_set", F.lit(APPENDED))
        if is_path:
            named.write.mode("append").partitionBy("polygon_set", partition_col).parquet(name_or_path)
        else:
            named.select(*columns, "polygon_set", partition_col).write.insertInto(name_or_path)
        return
    months, folder = load.months(), table_folder(spark, name_or_path)
    month = F.col(partition_col).cast("string")
    strange = F.raise_error(F.concat(F.lit("a row of a month that the load does not own: "), F.coalesce(month, F.lit("null")))).cast("string")
    seen = Observation()
    rows = (df.withColumn(partition_col, F.when(month.isin(months), month).otherwise(strange))
            .observe(seen, F.collect_set(partition_col).alias("months")))
    own = f"{folder}/polygon_set={load.folder}"
    (rows.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(own))
    filled = _observed_months(seen)
    if not is_path:
        spark.sql(f"ALTER TABLE {name_or_path} RECOVER PARTITIONS")
    for m in months:
        if m not in filled:
            _drop_month(spark, name_or_path, f"{own}/{partition_col}={m}", load.folder, partition_col, m)
    spark.catalog.refreshByPath(folder)
    if not is_path:
        spark.catalog.refreshTable(name_or_path)
    _record(spark, folder, own, load, months, filled, partition_col)


def _observed_months(seen: Observation) -> set[str]:
    """The months the write had rows of. Of an input that the optimizer found to be empty Spark has no metrics to give."""
    try:
        return set(seen.get["months"])
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return set()


def _drop_month(spark: SparkSession, name_or_path: str, folder: str, polygon_set: str, partition_col: str, month: str) -> None:
    if not _is_path(name_or_path):
        spark.sql(f"ALTER TABLE {name_or_path} DROP IF EXISTS PARTITION (polygon_set = '{polygon_set}', {partition_col} = '{month}')")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _record(spark: SparkSession, folder: str, own: str, load: Load, months: list[str], filled: set[str], partition_col: str) -> None:
    """One ledger row for each month the run owns; the rows are counted from the files' footers."""
    if not months:
        return
    grid = spark.createDataFrame([(m,) for m in months], "month string")  # the months of one run
    if filled:
        counts = spark.read.schema(f"`{partition_col}` string").parquet(own).groupBy(F.col(partition_col).alias("month")).agg(F.count(F.lit(1)).alias("rows"))
        grid = grid.join(counts, "month", "left")
    else:
        grid = grid.withColumn("rows", F.lit(None).cast("long"))
    run = uuid.uuid4().hex
    (grid.select(F.lit(run).alias("run"), F.lit(load.folder).alias("polygon_set"), F.lit(load.start).alias("start"), F.lit(load.end).alias("end"),
                 "month", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.current_timestamp().alias("written_at"))
     .coalesce(1).write.mode("append").parquet(f"{folder}/{LEDGER}"))


def replace_months(df: DataFrame, path: str, load: Load, months: list[str], partition_col: str = "date") -> None:
    """Replace some months of a load, of which ``df`` has the rows."""
    write_append(df, path, replace(load, only=tuple(months)), partition_col)
