"""Fixed schemas of the warehouse tables."""

from pyspark.sql import types as T

FACT = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("location", T.StringType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
])
FACT_COLS = [f.name for f in FACT.fields]

# One loaded time-series point; series key = (measurement, location, source, data_key).
POINT = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("measurement", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
])
SERIES_KEY = ["measurement", "location", "source", "data_key"]

PUBLIC_COLS = ["time", "location", "source", "measurement", "data_key", "data_value"]
PUBLIC = T.StructType([POINT[c] for c in PUBLIC_COLS])
PUBLIC_KEY = ["time", "measurement", "location", "data_key", "source"]
MEASUREMENTS = ["additive", "nonadditive"]

MERGED_INDOOR = T.StructType([
    T.StructField("Datetime", T.TimestampNTZType()),
    T.StructField("Temperature_Celsius", T.DoubleType()),
    T.StructField("Relative_Humidity(%)", T.DoubleType()),
    T.StructField("Location", T.StringType()),
])

SEEDS = {
    "mapping": T.StructType([
        T.StructField("data_key_original", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("data_key", T.StringType()),
    ]),
    "mapping_indoor": T.StructType([
        T.StructField("sensor", T.StringType()),
        T.StructField("location", T.StringType()),
    ]),
    "mapping_sources": T.StructType([
        T.StructField("file_nm", T.StringType()),
        T.StructField("source_nm", T.StringType()),
        T.StructField("history", T.IntegerType()),
    ]),
    "location_map": T.StructType([
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
    ]),
}

HIERARCHY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("level", T.IntegerType()),
])

WEATHER = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("temperature_kelvin", T.DoubleType()),
    T.StructField("humidity_pct", T.DoubleType()),
    T.StructField("pressure_hpa", T.DoubleType()),
])

REGISTRY = T.StructType([
    T.StructField("datasource_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("file_pattern", T.StringType()),
    T.StructField("required_columns", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("retention_months", T.IntegerType()),
    T.StructField("status", T.StringType()),
])
