"""Command line: run the whole build from stored inputs.

    spark-submit --py-files terrascore.zip -m terrascore build \\
        --polygons s3://…/fields/ --pixels s3://…/pixels/ --static-pixels s3://…/soil/ \\
        --thresholds s3://…/dim_thresholds.csv --start 2020-01-01 --end 2024-12-31 [--root s3://…/tables]

Without ``--root`` the tables go to the catalog databases of the config.
The series sources and soil bands are the config defaults (the three public
collections' band names); pass ``--series name:band:temporal:zonal:scale:offset``
to override.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import PipelineConfig, SourceSpec
from .plans.pipeline import build_all
from .sources.geojson import read_geojson
from .sources.tables import read_thresholds_csv, seed_thresholds


def _spec(text: str) -> SourceSpec:
    name, band, temporal, zonal, scale, offset = text.split(":")
    return SourceSpec(name, band, temporal, zonal, float(scale), float(offset))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="terrascore")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="raw loads, seed, models and checks")
    b.add_argument("--polygons", required=True, help="GeoJSON FeatureCollection file(s) or folder")
    b.add_argument("--pixels", required=True, help="time-indexed pixel table (Parquet)")
    b.add_argument("--static-pixels", required=True, help="undated soil pixel table (Parquet)")
    b.add_argument("--thresholds", help="threshold seed CSV (default: built-in seed)")
    b.add_argument("--start", default=PipelineConfig.start_date)
    b.add_argument("--end", default=PipelineConfig.end_date)
    b.add_argument("--root", help="shared folder for the tables (default: catalog databases)")
    b.add_argument("--cell-deg", type=float, default=PipelineConfig.cell_deg)
    b.add_argument("--append", action="store_true", help="plain appends instead of idempotent loads")
    b.add_argument("--series", action="append", type=_spec, help="name:band:temporal:zonal:scale:offset")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("terrascore").getOrCreate()
    cfg = PipelineConfig(start_date=args.start, end_date=args.end, cell_deg=args.cell_deg,
                         idempotent_loads=not args.append)
    if args.series:
        cfg = cfg.with_(series=tuple(args.series))
    thresholds = read_thresholds_csv(spark, args.thresholds) if args.thresholds else seed_thresholds(spark)
    report = build_all(spark, cfg, read_geojson(spark, args.polygons), spark.read.parquet(args.pixels),
                       spark.read.parquet(args.static_pixels), thresholds, root=args.root)
    summary = {k: v for k, v in report.items() if k != "layout"}
    print(json.dumps(summary, default=str))
    return summary


if __name__ == "__main__":
    main()
