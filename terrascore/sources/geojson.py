"""GeoJSON polygon source and sinks.

A GeoJSON FeatureCollection is one JSON document, so one file is one read
task; many files are read in parallel. The reader never infers a schema:
``coordinates`` is taken as raw JSON text and parsed per geometry type later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas

ID_PROPERTY = "field_id"


def read_geojson(spark: SparkSession, path: str | list[str], id_property: str = ID_PROPERTY) -> DataFrame:
    """One row per feature:
    ``region_id bigint, file string, feature_index int, field_id string,
    properties map<string,string>, geom_type string, coordinates string``.

    Id rule, per file: if no feature of the file carries ``id_property``,
    every feature gets ``field_<0-based position>``; otherwise the property is
    used as text and features without it keep a null id. ``region_id`` is a
    64-bit hash of the file and the position in it, for one file as for many.
    A broken file fails the read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    # The decision "does any feature carry an id" is per file; a file is one
    # row here (the whole collection), so it is an array predicate: no shuffle.
    has_id = F.exists(F.coalesce(F.col("features"), F.array()),
                      lambda f: F.coalesce(F.map_contains_key(f["properties"], id_property), F.lit(False)))
    per_file = raw.select(F.input_file_name().alias("file"), has_id.alias("_has_id"), "features")
    feats = per_file.select("file", "_has_id", F.posexplode("features").alias("feature_index", "f"))
    field_id = F.when(F.col("_has_id"), F.col("f.properties").getItem(id_property).cast("string")).otherwise(
        F.concat(F.lit("field_"), F.col("feature_index").cast("string"))
    )
    return feats.select(
        F.xxhash64("file", "feature_index").alias("region_id"), "file", "feature_index",
        field_id.alias("field_id"),
        F.col("f.properties").alias("properties"),
        F.col("f.geometry.type").alias("geom_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def json_string(col) -> "F.Column":
    """A string column as a JSON string literal (quoted and escaped)."""
    return F.regexp_extract(F.to_json(F.array(col)), r"^\[(.*)\]$", 1)


def geometry_json(geom_type="geom_type", coordinates="coordinates"):
    """GeoJSON geometry text from a type and raw coordinates JSON."""
    t, c = F.col(geom_type), F.col(coordinates)
    return F.when(t.isNotNull(), F.concat(F.lit('{"type":'), json_string(t),
                                         F.lit(',"coordinates":'), c, F.lit("}")))


def polygons_table(features: DataFrame) -> DataFrame:
    """The polygon table as loaded: ``field_id`` and the geometry as GeoJSON
    text (``{"type": ..., "coordinates": ...}``)."""
    return features.select("field_id", geometry_json().alias("geometry"))


def features_json(df: DataFrame, properties: list[str], geom_type_col: str = "geom_type",
                  coords_col: str = "coordinates") -> DataFrame:
    """Feature rows to GeoJSON Feature text (``feature`` column). Property
    columns are written as JSON values; coordinates must already be JSON."""
    props = F.to_json(F.struct(*[F.col(p) for p in properties])) if properties else F.lit("{}")
    return df.select(
        "*",
        F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
                 F.coalesce(geometry_json(geom_type_col, coords_col), F.lit("null")), F.lit("}")).alias("feature"),
    )


def write_feature_collections(df: DataFrame, path: str, file_key: str, order_by: str,
                              feature_col: str = "feature", max_features_per_file: int = 100_000) -> None:
    """Write FeatureCollection files below a folder per ``file_key`` and chunk,
    the features ordered by ``order_by``.

    A FeatureCollection is one JSON document, so each file is written by one
    task, line by line: a head, the features in order, and an end. No task holds
    a collection in memory. A key with more than ``max_features_per_file``
    features is split into chunks by a hash of ``order_by`` (about that many
    each; deterministic, so a retried task writes the same file)."""
    counts = df.groupBy(file_key).agg(F.count(F.lit(1)).alias("_n"))
    n_files = F.ceil(F.col("_n") / F.lit(max_features_per_file)).cast("long")
    rows = df.join(counts, file_key).select(
        file_key, F.pmod(F.xxhash64(F.col(order_by)), n_files).alias("chunk"), F.lit(1).alias("_part"), F.col(order_by).alias("_order"),
        F.col(feature_col).alias("value"))
    chunks = rows.select(file_key, "chunk").distinct()
    frame = chunks.select(file_key, "chunk", F.explode(F.array(F.lit(0), F.lit(2))).alias("_part"), F.lit(None).cast(rows.schema["_order"].dataType).alias("_order"),
                          F.lit("").alias("value"))
    by_file = Window.partitionBy(file_key, "chunk").orderBy("_part", "_order")
    before = F.lag("_part").over(by_file)
    line = (F.when(F.col("_part") == 0, F.lit('{"type":"FeatureCollection","features":[')).when(F.col("_part") == 2, F.lit("]}"))
            .otherwise(F.concat(F.when(before == 1, F.lit(",")).otherwise(F.lit("")), F.col("value"))))
    lines = rows.unionByName(frame).withColumn("value", line)
    # the window has dealt and sorted the lines of a file into one task, in order
    lines.select(file_key, "chunk", "value").write.mode("overwrite").partitionBy(file_key, "chunk").text(path)
