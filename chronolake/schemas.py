"""Layer schemas, fixed settings and defaults.

Every layer has one declared ``StructType`` and one canonical column order, used for
populated and empty frames alike. Timestamps are ``timestamp_ntz`` holding UTC wall-clock
time: feed offsets are resolved to UTC at parse time, so the stored value never depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must match the behaviour being reproduced) ------------------------
# Station code -> display name lookup used when a feed row carries no station name.
STATION_OPTIONS: dict[str, str] = {
    "KJFK": "New York, Kennedy International Airport",
    "KSEA": "Seattle-Tacoma International Airport",
    "KSFO": "San Francisco International Airport",
    "KORD": "Chicago O'Hare International Airport",
    "KATL": "Atlanta Hartsfield-Jackson International Airport",
}
DEFAULT_SAMPLE_STATIONS: list[str] = ["KJFK", "KSEA", "KSFO"]
# Canned query names of the comparison panel.
QUERY_OPTIONS: list[str] = [
    "Show only new records",
    "Compare snapshot changes",
    "Aggregate by partition",
]
DEFAULT_LIVE_LIMIT = 72          # latest observations kept per station and pull
AUTO_REFRESH_MINUTES = 1440      # a refresh is due once the newest snapshot is this old
RESULT_LIMIT = 200               # row cap of the canned comparison queries
PREVIEW_ROWS = 25                # rows shown per side in the snapshot preview
DEFAULT_CUSTOM_SQL = "SELECT * FROM current_data LIMIT 100"
# Anomaly thresholds (strict comparisons) and the values nulls are read as.
GUST_LIMIT_KMH = 70.0
PRESSURE_FLOOR_PA = 98000.0
TEMP_HIGH_C = 38.0
TEMP_LOW_C = -25.0
NULL_GUST = 0.0
NULL_PRESSURE = 101325.0
NULL_TEMPERATURE = 0.0
# --------------------------------------------------------------------------------------

DEFAULT_SOURCE_NAME = "observation_feed"
LAYERS = ("bronze", "silver", "gold")

MEASURE_COLUMNS = [
    "temperature_c",
    "dewpoint_c",
    "wind_direction_deg",
    "wind_speed_kmh",
    "wind_gust_kmh",
    "pressure_pa",
    "visibility_m",
    "humidity_pct",
    "elevation_m",
]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("source_record_id", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("text_description", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in MEASURE_COLUMNS],
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("raw_message", T.StringType()),
        T.StructField("icon", T.StringType()),
        T.StructField("present_weather_count", T.IntegerType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("raw_payload_json", T.StringType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

BRONZE_EXTRA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("ingest_ts", T.StringType()),
        T.StructField("partition_date", T.StringType()),
        T.StructField("partition_station", T.StringType()),
    ]
)
BRONZE_SCHEMA = T.StructType(RAW_SCHEMA.fields + BRONZE_EXTRA.fields)
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()

SILVER_EXTRA = T.StructType(
    [
        T.StructField("observation_date", T.StringType()),
        T.StructField("observation_hour", T.TimestampNTZType()),
        T.StructField("quality_flag", T.StringType()),
        T.StructField("anomaly_flag", T.BooleanType()),
        T.StructField("incremental_partition", T.StringType()),
    ]
)
SILVER_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + SILVER_EXTRA.fields)
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()

GOLD_KEYS = ["partition_date", "station_id", "station_name"]
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("partition_date", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("new_records", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("avg_temperature_c", T.DoubleType()),
        T.StructField("avg_wind_speed_kmh", T.DoubleType()),
        T.StructField("max_wind_gust_kmh", T.DoubleType()),
        T.StructField("avg_pressure_pa", T.DoubleType()),
        T.StructField("first_seen", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
GOLD_COLUMNS = GOLD_SCHEMA.fieldNames()

# Additive per-group state kept next to gold so a refresh merges only the increment: exact sums of
# readings in fixed point, and apart from them (``far_``, null as a rule) those it cannot hold.
ADDED = ("sum_", "far_", "n_")
GOLD_STATE_SCHEMA = T.StructType(
    [
        T.StructField("partition_date", T.StringType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("sum_temperature_c", T.DecimalType(38, 12)),
        T.StructField("far_temperature_c", T.DoubleType()),
        T.StructField("n_temperature_c", T.LongType()),
        T.StructField("sum_wind_speed_kmh", T.DecimalType(38, 12)),
        T.StructField("far_wind_speed_kmh", T.DoubleType()),
        T.StructField("n_wind_speed_kmh", T.LongType()),
        T.StructField("max_wind_gust_kmh", T.DoubleType()),
        T.StructField("sum_pressure_pa", T.DecimalType(38, 12)),
        T.StructField("far_pressure_pa", T.DoubleType()),
        T.StructField("n_pressure_pa", T.LongType()),
        T.StructField("first_seen", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
    ]
)

# Bookkeeping columns of the append-only bronze log.
LOG_EXTRA = T.StructType(
    [
        T.StructField("is_first", T.BooleanType()),
        T.StructField("copies", T.LongType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("rows_processed", T.LongType()),
        T.StructField("partitions_scanned_incremental", T.LongType()),
        T.StructField("partitions_scanned_full", T.LongType()),
        T.StructField("full_scan_rows", T.LongType()),
        T.StructField("incremental_scan_rows", T.LongType()),
        T.StructField("processing_time_ms", T.DoubleType()),
        T.StructField("time_saved_pct", T.DoubleType()),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.IntegerType()),
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("station_ids", T.ArrayType(T.StringType())),
        T.StructField("raw_path", T.StringType()),
        T.StructField(
            "paths",
            T.StructType([T.StructField(layer, T.StringType()) for layer in LAYERS]),
        ),
        T.StructField(
            "row_counts",
            T.StructType([T.StructField(layer, T.LongType()) for layer in LAYERS]),
        ),
        T.StructField("metrics", METRICS_SCHEMA),
        T.StructField("batch_id", T.LongType()),
    ]
)


def layer_schema(layer: str) -> T.StructType:
    """Schema of a layer; any name other than silver/gold is bronze (as the panel does)."""
    if layer == "gold":
        return GOLD_SCHEMA
    if layer == "silver":
        return SILVER_SCHEMA
    return BRONZE_SCHEMA
