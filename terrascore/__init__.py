"""terrascore — Spark-native agronomic site-suitability analytics.

Layers:
  sources/    GeoJSON polygons, threshold seed, pixel tables, raw tables, sinks
  functions/  Column expressions (scores, season labels, dates, geometry)
  operators/  DataFrame operators (raster composites, spatial join, zonal
              statistics, joins, aggregates)
  plans/      the model: staging, harmonize, scoring, marts, extract jobs,
              reports, quality checks, the end-to-end build
  streaming/  incremental refresh of the monthly series with Structured Streaming
"""

__version__ = "0.1.0"
