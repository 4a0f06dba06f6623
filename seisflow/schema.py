"""Fixed schemas: the flat event catalogue and the raw GeoJSON feed document."""

from pyspark.sql import functions as F, types as T

# The 24 catalogue columns, in order, all nullable.
CATALOGUE_FIELDS = [
    ("id", T.StringType()),
    ("magnitude", T.DoubleType()),
    ("place", T.StringType()),
    ("time", T.TimestampType()),
    ("updated", T.TimestampType()),
    ("url", T.StringType()),
    ("detail", T.StringType()),
    ("felt", T.IntegerType()),
    ("cdi", T.DoubleType()),
    ("mmi", T.DoubleType()),
    ("alert", T.StringType()),
    ("status", T.StringType()),
    ("tsunami", T.IntegerType()),
    ("sig", T.IntegerType()),
    ("net", T.StringType()),
    ("code", T.StringType()),
    ("ids", T.StringType()),
    ("sources", T.StringType()),
    ("types", T.StringType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("depth", T.DoubleType()),
    ("date", T.StringType()),
    ("hour", T.IntegerType()),
]

CATALOGUE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in CATALOGUE_FIELDS])
CATALOGUE_COLUMNS = [n for n, _ in CATALOGUE_FIELDS]

# Integer columns are read as double from text and cast back: a writer that
# emits ``12.0`` for an integer column with gaps would otherwise read as null.

# Raw feed document: {"features": [{"id", "properties": {...}, "geometry": {"coordinates": [...]}}]}
FEED_PROPERTIES = T.StructType([
    T.StructField("mag", T.DoubleType()),
    T.StructField("place", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("updated", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("felt", T.DoubleType()),
    T.StructField("cdi", T.DoubleType()),
    T.StructField("mmi", T.DoubleType()),
    T.StructField("alert", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tsunami", T.DoubleType()),
    T.StructField("sig", T.DoubleType()),
    T.StructField("net", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("ids", T.StringType()),
    T.StructField("sources", T.StringType()),
    T.StructField("types", T.StringType()),
])

FEED_FEATURE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("properties", FEED_PROPERTIES),
    T.StructField("geometry", T.StructType([
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ])),
])

FEED_SCHEMA = T.StructType([T.StructField("features", T.ArrayType(FEED_FEATURE))])


def schema_report(df):
    """The schema as (position, name, type, nullable) rows with each column's number of values, in one pass."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    kinds = df.sparkSession.createDataFrame(rows, "position int, name string, data_type string, nullable boolean")
    filled = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).unpivot([], df.columns, "name", "non_null")
    return kinds.join(F.broadcast(filled), "name").select("position", "name", "data_type", "nullable", "non_null")
