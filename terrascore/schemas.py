"""Explicit schemas of every table. No inference anywhere: seed columns such
as ``10,20,5,25`` must stay double, and raw dates stay text until staging."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, DT = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# GeoJSON. ``coordinates`` is kept as raw JSON text at read time and parsed
# per geometry type afterwards, so Polygon and MultiPolygon share one reader.
GEOMETRY_RAW = _struct(("type", S), ("coordinates", S))
FEATURE_RAW = _struct(("type", S), ("properties", T.MapType(S, S)), ("geometry", GEOMETRY_RAW))
FEATURE_COLLECTION = _struct(("type", S), ("features", T.ArrayType(FEATURE_RAW)))
POLYGON_COORDS = T.ArrayType(T.ArrayType(T.ArrayType(D)))
MULTIPOLYGON_COORDS = T.ArrayType(POLYGON_COORDS)

POINT = _struct(("x", D), ("y", D))
EDGE = _struct(("x1", D), ("y1", D), ("x2", D), ("y2", D))

CROPLAND_POLYGONS = _struct(("field_id", S), ("geometry", S))

THRESHOLDS = _struct(
    ("feature", S), ("period", S),
    ("optimal_min", D), ("optimal_max", D), ("acceptable_min", D), ("acceptable_max", D),
)

# Raw tables as the loaders write them (date as yyyy-MM-dd text).
NDVI_RAW = _struct(("field_id", S), ("ndvi", D), ("date", S))
TEMPERATURE_RAW = _struct(("field_id", S), ("temperature", D), ("date", S))
RAINFALL_RAW = _struct(("field_id", S), ("rainfall", D), ("date", S))
SOIL_RAW = _struct(
    ("field_id", S), ("soil_ph", D), ("soil_cec", D), ("clay", D), ("silt", D), ("sand", D),
    ("lat", D), ("lon", D),
)

# Pixel tables: our stand-in for image collections and static images.
PIXELS = _struct(
    ("image_date", DT), ("band", S), ("ix", L), ("iy", L), ("lon", D), ("lat", D), ("value", D),
)
STATIC_PIXELS = _struct(("band", S), ("ix", L), ("iy", L), ("lon", D), ("lat", D), ("value", D))


def series_raw(name: str) -> T.StructType:
    return _struct(("field_id", S), (name, D), ("date", S))
