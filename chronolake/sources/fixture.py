"""Observation pulls derived from the ``events`` table (see FIXTURES.md).

One observation per event, then three overlapping pulls built from a single scan: each
event row is expanded (``explode`` of its pull codes) into the pulls it belongs to, so
``events`` is read once however many pulls there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators.layers import to_bronze

# --- fixed values of the fixture (FIXTURES.md) ---------------------------------------
STATION_CODES = ["KJFK", "KSEA", "KSFO", "KORD", "KATL"]  # index = user_id % 5
PULL_AS_OF = {
    1: "2024-01-11T00:00:00+00:00",
    2: "2024-01-21T00:00:00+00:00",
    3: "2024-01-31T00:00:00+00:00",
}
PULL1_END = "2024-01-11 00:00:00"
PULL2_START = "2024-01-08 00:00:00"
PULL2_END = "2024-01-21 00:00:00"
PULL3_START = "2024-01-18 00:00:00"
FIXTURE_SOURCE_NAME = "fixture_events"
FIXTURE_SOURCE_URL = "fixture://events"
# ---------------------------------------------------------------------------------------


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value).cast("double")


def observations(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw-schema observation per event (``fetched_at`` left null), plus ``event_id``.

    ``keep`` passes further ``events`` columns through.
    """
    eid, uid = F.col("event_id"), F.col("user_id")
    station = F.get(F.array(*[F.lit(c) for c in STATION_CODES]), (uid % 5).cast("int"))
    null_double = F.lit(None).cast("double")
    null_text = F.lit(None).cast("string")
    cols = {
        "source_record_id": F.concat(F.lit("obs-"), eid.cast("string")),
        "station_id": F.when(eid % 997 == 0, F.lit(None)).otherwise(station),
        "station_name": F.concat(
            F.when(eid % 53 == 0, F.lit("Renamed ")).otherwise(F.lit("Station ")),
            (uid % 5).cast("string"),
        ),
        "timestamp": F.col("ts").cast("timestamp_ntz"),
        "text_description": F.col("event_type"),
        "temperature_c": _null_if(eid % 11 == 0, (eid * 7) % 70 - 28),
        "dewpoint_c": null_double,
        "wind_direction_deg": null_double,
        "wind_speed_kmh": F.floor("value").cast("double"),
        "wind_gust_kmh": _null_if(eid % 3 == 0, F.floor(F.col("value") / 4) + 10),
        "pressure_pa": _null_if(eid % 17 == 0, 97900 + (eid * 13) % 4000),
        "visibility_m": null_double,
        "humidity_pct": _null_if(eid % 13 == 0, eid % 101),
        "elevation_m": null_double,
        "latitude": null_double,
        "longitude": null_double,
        "raw_message": null_text,
        "icon": null_text,
        "present_weather_count": F.lit(0),
        "fetched_at": null_text,
        "source_url": F.lit(FIXTURE_SOURCE_URL),
        "raw_payload_json": null_text,
    }
    return events.select(eid, *keep, *[cols[c].alias(c) for c in S.RAW_COLUMNS])


def _membership(ts: Column, eid: Column) -> Column:
    """Codes of the pulls an event belongs to: ``pull`` (+10 for the shifted copy)."""
    late = eid % 101 == 0
    in1 = (ts < _ntz(PULL1_END)) & ~late
    in2 = (ts >= _ntz(PULL2_START)) & (ts < _ntz(PULL2_END)) & ~late
    in3 = (ts >= _ntz(PULL3_START)) | late
    codes = [
        F.when(in1, F.lit(1)),
        F.when(in1 & (eid % 29 == 0), F.lit(11)),  # in-pull duplicate, one second later
        F.when(in2, F.lit(2)),
        F.when(in3, F.lit(3)),
    ]
    return F.array_compact(F.array(*codes))


def pulls(events: DataFrame) -> DataFrame:
    """All pulls as raw rows plus an int ``pull`` column (one scan of ``events``)."""
    obs = observations(events)
    expanded = obs.select("*", F.explode(_membership(F.col("timestamp"), F.col("event_id"))).alias("_code"))
    pull = F.col("_code") % 10
    as_of = F.get(F.array(*[F.lit(PULL_AS_OF[p]) for p in sorted(PULL_AS_OF)]), pull - 1)
    shifted_ts = F.when(
        F.col("_code") > 10, F.col("timestamp") + F.expr("INTERVAL 1 SECOND")
    ).otherwise(F.col("timestamp"))
    return expanded.withColumns({"timestamp": shifted_ts, "fetched_at": as_of}).select(
        pull.cast("int").alias("pull"), *S.RAW_COLUMNS
    )


def bronze_pulls(events: DataFrame) -> DataFrame:
    """Pulls enriched to bronze: ``ingest_ts`` is the as-of time of the pull."""
    return to_bronze(pulls(events), FIXTURE_SOURCE_NAME, F.col("fetched_at"), keep=("pull",))


def pull_frame(events: DataFrame, pull: int) -> DataFrame:
    """One pull as a raw frame, the input of one refresh."""
    return pulls(events).where(F.col("pull") == pull).drop("pull")


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
