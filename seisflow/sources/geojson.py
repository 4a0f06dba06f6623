"""GeoJSON feed documents → flat catalogue.

Two layouts are read:

* feed documents ``{"features": [...]}``, one JSON document per file
  (``multiLine``; each file is one task, many files scan in parallel);
* line-delimited features, one feature object per line, which Spark splits
  inside a file.  This is what :func:`write_feed` emits, because a single
  document holding every feature would have to pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seisflow.schema import CATALOGUE_FIELDS, FEED_FEATURE, FEED_SCHEMA


def _epoch_millis(c: Column) -> Column:
    # 0 and missing both mean "no time" in the feed.
    return F.timestamp_millis(F.nullif(c, F.lit(0).cast("long")))


def _int_field(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c.try_cast("int"))


def flatten_features(features: DataFrame, feature_col: str = "f") -> DataFrame:
    """One feature struct per row → the 24 catalogue columns.

    Absent properties are null; short or null coordinate arrays give null
    (``get`` is bounds-safe, unlike ``[]`` under ANSI mode).
    """
    p = lambda name: F.col(f"{feature_col}.properties.{name}")
    coords = F.col(f"{feature_col}.geometry.coordinates")
    time = _epoch_millis(p("time"))
    values = {
        "id": F.col(f"{feature_col}.id"),
        "magnitude": p("mag"),
        "place": p("place"),
        "time": time,
        "updated": _epoch_millis(p("updated")),
        "url": p("url"),
        "detail": p("detail"),
        "felt": _int_field(p("felt")),
        "cdi": p("cdi"),
        "mmi": p("mmi"),
        "alert": p("alert"),
        "status": p("status"),
        "tsunami": _int_field(p("tsunami")),
        "sig": _int_field(p("sig")),
        "net": p("net"),
        "code": p("code"),
        "ids": p("ids"),
        "sources": p("sources"),
        "types": p("types"),
        "longitude": F.get(coords, 0),
        "latitude": F.get(coords, 1),
        "depth": F.get(coords, 2),
        "date": F.date_format(time, "yyyy-MM-dd"),
        "hour": F.hour(time),
    }
    return features.select(*[values[n].cast(t).alias(n) for n, t in CATALOGUE_FIELDS])


def flatten_feed(documents: DataFrame) -> DataFrame:
    """A5: explode ``features`` of each document; a document without features yields no rows."""
    return flatten_features(documents.select(F.explode("features").alias("f")))


def read_feed(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """Scan landed feed files into the flat catalogue."""
    if line_delimited:
        feats = spark.read.schema(FEED_FEATURE).json(path)
        return flatten_features(feats.select(F.struct(*feats.columns).alias("f")))
    docs = spark.read.schema(FEED_SCHEMA).option("multiLine", True).json(path)
    return flatten_feed(docs)


def feed_from_catalogue(df: DataFrame) -> DataFrame:
    """Inverse projection: catalogue rows → feed feature structs (epoch-ms times)."""
    props = F.struct(
        F.col("magnitude").alias("mag"), F.col("place").alias("place"),
        F.unix_millis(F.col("time")).alias("time"), F.unix_millis(F.col("updated")).alias("updated"),
        "url", "detail", F.col("felt").cast("double").alias("felt"), "cdi", "mmi", "alert", "status",
        F.col("tsunami").cast("double").alias("tsunami"), F.col("sig").cast("double").alias("sig"),
        "net", "code", "ids", "sources", "types",
    )
    coords = F.when(F.col("longitude").isNull() & F.col("latitude").isNull() & F.col("depth").isNull(),
                    F.lit(None)).otherwise(F.array("longitude", "latitude", "depth"))
    return df.select(F.col("id"), props.alias("properties"), F.struct(coords.alias("coordinates")).alias("geometry"))


def write_feed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land catalogue rows as line-delimited feed features (one feature per line)."""
    feed_from_catalogue(df).write.mode(mode).json(path)


def write_feed_documents(df: DataFrame, path: str, features_per_document: int = 1000, mode: str = "overwrite") -> None:
    """Land catalogue rows as feed documents ``{"features": [...]}``, one per line of text.

    A document holds at most ``features_per_document`` features of one input
    partition (bucketed by the row's position inside its partition), so no
    group is larger than that bound whatever the input size.
    """
    feats = feed_from_catalogue(df).withColumn("__doc", F.floor(F.monotonically_increasing_id() / features_per_document))
    docs = feats.groupBy("__doc").agg(F.collect_list(F.struct("id", "properties", "geometry")).alias("features"))
    docs.select(F.to_json(F.struct("features")).alias("value")).write.mode(mode).text(path)


def read_feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Scan feed documents stored one per line (see :func:`write_feed_documents`)."""
    return flatten_feed(spark.read.schema(FEED_SCHEMA).json(path))
