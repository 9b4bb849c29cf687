"""Fixed table schemas and versions."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names, versions and identifiers of the data model ---
BRONZE_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
)
FLEET = "yellow"
ZONE_MIN, ZONE_MAX = 1, 265
CONTRACT_BY_POLICY = {"required": "1.0", "allow_unknown": "1.1"}
FEATURES_BY_CONTRACT = {"1.0": "gold-features-v1", "1.1": "gold-features-v2"}
SHORT_WINDOW_SECONDS = 900
LONG_WINDOW_SECONDS = 3600
STATIC_FEATURES = (
    "pickup_zone_id",
    "dropoff_zone_id",
    "pickup_hour_of_week",
    "trip_distance_miles",
    "passenger_count",
)
ROLLING_FEATURES = (
    "pu_zone_trips_15m",
    "pu_zone_mean_speed_15m",
    "pu_zone_mean_duration_60m",
    "do_zone_trips_60m",
)
TARGET = "actual_duration_seconds"
# --- end of fixed values ---

BRONZE = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("pickup_zone_id", T.ShortType()),
        T.StructField("dropoff_zone_id", T.ShortType()),
        T.StructField("trip_distance_miles", T.DoubleType()),
        T.StructField("passenger_count", T.ShortType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("actual_duration_seconds", T.IntegerType()),
        T.StructField("source_row_number", T.LongType()),
        T.StructField("contract_version", T.StringType()),
    ]
)
