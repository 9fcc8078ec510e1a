"""Incremental monthly loads with Structured Streaming.

The original loader appends a batch of months per run. Here new pixel files
arriving in a pixel-table folder drive the load: each micro-batch finds the
months it touches, recomputes those months from the whole pixel table (a
month's composite needs every image of the month, not only the new ones),
and overwrites exactly those months of its polygon set in the raw series
table (a month that has no rows any more goes), with an entry in the table's ledger.

* the stream's progress lives in a checkpoint under the shared
  ``spark.checkpoint.dir``; a replayed batch rewrites the same partitions
  from the files that lie in the folder then (at least once, with the same or
  newer rows);
* the pixel folder is listed anew for each batch, so a stream that runs for
  long sees the files that came since it started;
* the only thing taken to the driver is the short list of months a batch
  touches; it becomes a partition filter on the month-partitioned layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PipelineConfig, SourceSpec
from ..operators.spatial import SpatialIndex
from ..plans.extract import extract_series
from ..session import ensure_checkpoint_dir
from ..sources.tables import load_name, replace_months


def refresh_months(spark: SparkSession, touched: DataFrame, pixels: DataFrame, index: SpatialIndex,
                   spec: SourceSpec, cfg: PipelineConfig, target: str) -> None:
    """Recompute the series of the months of the images in ``touched`` and
    overwrite those month partitions of ``target``."""
    # The months of one micro-batch: a short list (bounded by the months a
    # batch can span), taken to the driver so the scan prunes statically.
    months = sorted(r[0] for r in touched.select(F.trunc(F.col("image_date"), "MM")).distinct().collect())
    if not months:
        return
    if "month" in pixels.columns:               # month-partitioned layout: partition pruning
        scoped = pixels.filter(F.col("month").isin(months))
    else:                                       # plain layout: row-group pruning on the date range
        lo, hi = F.lit(months[0]), F.add_months(F.lit(months[-1]), 1)
        scoped = pixels.filter((F.col("image_date") >= lo) & (F.col("image_date") < hi)
                               & F.trunc(F.col("image_date"), "MM").isin(months))
    rows = extract_series(spark, scoped, index, spec, cfg)
    replace_months(rows, target, load_name(cfg.polygon_set, cfg.start_date, cfg.end_date), [m.isoformat() for m in months])


def start_series_stream(spark: SparkSession, pixel_dir: str, index: SpatialIndex, spec: SourceSpec,
                        cfg: PipelineConfig, target: str, checkpoint: str | None = None,
                        available_now: bool = True, interval: str = "1 minute"):
    """Start the stream over ``pixel_dir`` (Parquet files with the pixel
    schema). Returns the StreamingQuery."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/terrascore-stream/{spec.name}"
    stream = spark.readStream.schema(schemas.PIXELS).parquet(pixel_dir).filter(F.col("band") == spec.band)

    def on_batch(batch: DataFrame, _epoch: int) -> None:
        pixels = spark.read.parquet(pixel_dir)     # listed now; picks up a month partition column if present
        refresh_months(spark, batch, pixels, index, spec, cfg, target)

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def read_series(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.parquet(target).select("field_id", name, F.col("date").cast("string").alias("date"))
