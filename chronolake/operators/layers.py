"""Bronze / silver / gold transforms and the joins between them.

All functions are ``DataFrame -> DataFrame``; the clock (``as_of``) is always a parameter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.functions import columns as C

KEY = "source_record_id"
# Keep-first order inside one pull: earliest observation, then station (nulls last).
PULL_ORDER = ["timestamp", "station_id"]
PULL_NULLS_LAST = ("station_id",)


def normalize_raw(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to the raw schema, NaN -> null on every measure (one place, on entry)."""
    cols = [F.col(c) for c in keep]
    for field in S.RAW_SCHEMA.fields:
        c = F.col(field.name).cast(field.dataType)
        if field.dataType.typeName() == "double":
            c = C.nan_to_null(c)
        cols.append(c.alias(field.name))
    return raw.select(*cols)


def to_bronze(
    raw: DataFrame, source_name: str, as_of: str | Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """PRJ1-2: constant provenance columns and text partition keys."""
    ingest = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return normalize_raw(raw, keep).select(
        *keep,
        *S.RAW_COLUMNS,
        F.lit(source_name).alias("source_name"),
        ingest.alias("ingest_ts"),
        C.date_key("timestamp").alias("partition_date"),
        F.col("station_id").cast("string").alias("partition_station"),
    )


def to_silver(bronze: DataFrame, keep: tuple[str, ...] = (), **thresholds: float) -> DataFrame:
    """PRJ3-7: date/hour keys, quality and anomaly flags, ``date|station`` key.

    Expects rows already deduplicated (the keep-first rows of the log). ``keep`` passes
    further columns through.
    """
    date = C.date_key("timestamp")
    return bronze.select(
        *keep,
        *S.BRONZE_COLUMNS,
        date.alias("observation_date"),
        C.hour_floor("timestamp").alias("observation_hour"),
        C.quality_flag().alias("quality_flag"),
        C.anomaly_flag(**thresholds).alias("anomaly_flag"),
        C.incremental_partition(date, "station_id").alias("incremental_partition"),
    )


def gold_state(silver: DataFrame) -> DataFrame:
    """GRP1 as additive state: per (date, station, name) sums, counts, min and max.

    Null keys form their own groups. Partial aggregation runs map-side, so the shuffle
    carries at most one row per group and map task. Sums are exact (:func:`C.exact_part`),
    so neither the order of rows nor the refresh that brought them changes an average.
    """
    def measure(name: str) -> list:
        return [
            F.sum(C.exact_part(name)).alias(f"sum_{name}"),
            F.sum(C.far_part(name)).alias(f"far_{name}"),
            F.count(name).alias(f"n_{name}"),
        ]

    return (
        silver.groupBy(F.col("observation_date").alias("partition_date"), "station_id", "station_name")
        .agg(
            F.count(KEY).alias("rows_processed"),
            F.sum(F.col("anomaly_flag").cast("long")).alias("anomaly_count"),
            *measure("temperature_c"),
            *measure("wind_speed_kmh"),
            F.max("wind_gust_kmh").alias("max_wind_gust_kmh"),
            *measure("pressure_pa"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
        .select(*S.GOLD_STATE_SCHEMA.fieldNames())
    )


def merge_gold_state(previous: DataFrame, increment: DataFrame) -> DataFrame:
    """Combine two additive states (previous snapshot + new rows) group by group."""
    sums = [c for c in S.GOLD_STATE_SCHEMA.fieldNames() if c.startswith(S.ADDED)]
    return (
        previous.select(*S.GOLD_STATE_SCHEMA.fieldNames())
        .unionByName(increment.select(*S.GOLD_STATE_SCHEMA.fieldNames()))
        .groupBy(*S.GOLD_KEYS)
        .agg(
            F.sum("rows_processed").alias("rows_processed"),
            F.sum("anomaly_count").alias("anomaly_count"),
            *[F.sum(c).cast(S.GOLD_STATE_SCHEMA[c].dataType).alias(c) for c in sums],
            F.max("max_wind_gust_kmh").alias("max_wind_gust_kmh"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
        .select(*S.GOLD_STATE_SCHEMA.fieldNames())
    )


def gold_from_state(
    state: DataFrame, new_counts: DataFrame, updated_at: str, keep_state: bool = False
) -> DataFrame:
    """PRJ8-9 + JOIN1: finish the averages and attach per-partition new counts.

    The join is on two keys while gold's grain has three (station name too), so a renamed
    station repeats its count on each name row -- kept on purpose. Both sides are small
    (one row per day and station); AQE turns it into a broadcast join at runtime when the
    measured size allows. ``keep_state`` also returns the additive state columns.
    """
    joined = state.join(new_counts, ["partition_date", "station_id"], "left").withColumn(
        "new_records", F.coalesce(F.col("new_records"), F.lit(0).cast("long"))
    )
    return finish_gold(joined, updated_at, keep_state)


def finish_gold(
    state: DataFrame, updated_at: str | Column, keep_state: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Gold columns from additive state carrying ``new_records`` (averages, stamp).

    ``keep`` passes further columns through, in front.
    """
    def avg(name: str):
        near, far = F.col(f"sum_{name}").cast("double"), F.col(f"far_{name}")
        total = F.when(far.isNull(), near).otherwise(far + F.coalesce(near, F.lit(0.0)))
        return F.try_divide(total, F.col(f"n_{name}")).alias(f"avg_{name}")

    state_cols = [c for c in S.GOLD_STATE_SCHEMA.fieldNames() if c.startswith(S.ADDED)]
    return state.select(
        *keep,
        "partition_date",
        "station_id",
        "station_name",
        "rows_processed",
        "new_records",
        "anomaly_count",
        avg("temperature_c"),
        avg("wind_speed_kmh"),
        "max_wind_gust_kmh",
        avg("pressure_pa"),
        "first_seen",
        "last_seen",
        (updated_at if isinstance(updated_at, Column) else F.lit(updated_at)).alias("updated_at"),
        *(state_cols if keep_state else []),
    )


BROADCAST_ID_LIMIT = 2_000_000  # incoming ids broadcast only up to this many rows


def unseen(
    incoming: DataFrame,
    history: DataFrame | list[DataFrame],
    rows: int | None = None,
    broadcast_limit_rows: int = BROADCAST_ID_LIMIT,
) -> DataFrame:
    """JOIN3: incoming rows whose id is in none of the frames of ``history`` (or in that one frame).

    History is the big side and only its id column is read. ``rows`` bounds the incoming
    rows (the refresh knows it from landing them; else they are counted, an aggregate of
    every task). When that proves their ids small they are broadcast, so history is
    streamed once through a hash probe and never shuffled (``history SEMI incoming``), and
    the known ids -- at most as many -- are broadcast to the final anti-join. Otherwise it
    is an anti-join for each frame (a generation of the id index: bucketed, so only what is
    left of the increment is shuffled); callers pass one row for each id (keep-first runs
    before), so neither side has a hot key.
    """
    history = [history] if isinstance(history, DataFrame) else history
    incoming_ids = incoming.select(KEY)
    if (incoming_ids.count() if rows is None else rows) <= broadcast_limit_rows:
        every = reduce(DataFrame.union, [h.select(KEY) for h in history])
        known = every.join(F.broadcast(incoming_ids), KEY, "left_semi")
        return incoming.join(F.broadcast(known), KEY, "left_anti")
    for ids in history:
        incoming = incoming.join(ids.select(KEY), KEY, "left_anti")
    return incoming
