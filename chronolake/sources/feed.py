"""Observation feed documents -> raw rows (SRC1-12) and the landing folder (SNK1).

A landing folder holds one text document per station and pull under ``station=<id>/``,
each a GeoJSON-like ``{"features": [{"geometry": ..., "properties": ...}, ...]}``.
Documents are read whole (``wholetext``), split into feature strings with ``from_json``
(``array<string>`` keeps each feature's original text, unknown fields included), and each
feature is parsed again into a typed struct. Everything is built-in JSON / cast
expressions; no Python touches a row.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake import schemas as S
from chronolake.functions import columns as C
from chronolake.operators.topk import latest_per_station
from chronolake.sources.reading import or_empty

# Feed property name of each measure column (fixed values of the feed format).
MEASURE_PROPERTIES = {
    "temperature_c": "temperature",
    "dewpoint_c": "dewpoint",
    "wind_direction_deg": "windDirection",
    "wind_speed_kmh": "windSpeed",
    "wind_gust_kmh": "windGust",
    "pressure_pa": "barometricPressure",
    "visibility_m": "visibility",
    "humidity_pct": "relativeHumidity",
    "elevation_m": "elevation",
}

# Numbers are read as text and cast leniently, so "12.5", 12.5 and "n/a" all parse.
_MEASURES_DDL = ", ".join(f"{p}: struct<value: string>" for p in MEASURE_PROPERTIES.values())
FEATURE_DDL = (
    "struct<geometry: struct<coordinates: array<string>>, "
    "properties: struct<`@id`: string, stationId: string, stationName: string, "
    f"timestamp: string, textDescription: string, {_MEASURES_DDL}, "
    "rawMessage: string, icon: string, presentWeather: array<string>>>"
)
DOCUMENT_DDL = "struct<features: array<string>>"
STATION_PARTITION = "station"


def station_name_lookup(requested: Column) -> Column:
    """Display name of a station code from the fixed lookup (null when unknown)."""
    pairs = []
    for code, name in S.STATION_OPTIONS.items():
        pairs += [F.lit(code), F.lit(name)]
    return F.try_element_at(F.create_map(*pairs), requested)


def parse_features(
    features: DataFrame,
    feature_col: str = "feature",
    requested_col: str = STATION_PARTITION,
    fetched_at: str | Column | None = None,
    source_url: Column | None = None,
    stations: DataFrame | None = None,
    broadcast_limit_rows: int = 100_000,
) -> DataFrame:
    """SRC2-9, SRC11-12: one feature JSON string per row -> raw-schema rows.

    * measures: ``value`` text -> double via ``try_cast`` (bad / missing -> null)
    * coordinates: ``get`` (out of range -> null), lat = [1], lon = [0]
    * station id: feed value, else the requested station; name: feed value, else the
      lookup (``stations`` frame if given, else the fixed table), else the code
    * timestamp: any ISO offset -> UTC; rows without id or timestamp are dropped
    """
    f = F.from_json(F.col(feature_col), FEATURE_DDL)
    p = f["properties"]
    coords = f["geometry"]["coordinates"]
    requested = F.col(requested_col)
    fetched = fetched_at if isinstance(fetched_at, Column) else F.lit(fetched_at).cast("string")
    url = source_url if source_url is not None else F.lit(None).cast("string")
    parsed = features.select(
        p["@id"].alias("source_record_id"),
        F.coalesce(p["stationId"], requested).alias("station_id"),
        p["stationName"].alias("_feed_name"),
        requested.alias("_requested"),
        C.utc_wall_clock(p["timestamp"]).alias("timestamp"),
        p["textDescription"].alias("text_description"),
        *[C.lenient_double(p[prop]["value"]).alias(c) for c, prop in MEASURE_PROPERTIES.items()],
        C.lenient_double(F.get(coords, 1)).alias("latitude"),
        C.lenient_double(F.get(coords, 0)).alias("longitude"),
        p["rawMessage"].alias("raw_message"),
        p["icon"].alias("icon"),
        # explicit null test: size(null) is -1, not null, when ANSI mode is off
        F.when(p["presentWeather"].isNull(), F.lit(0))
        .otherwise(F.size(p["presentWeather"]))
        .cast("int")
        .alias("present_weather_count"),
        fetched.alias("fetched_at"),
        url.alias("source_url"),
        F.col(feature_col).alias("raw_payload_json"),
    ).dropna(subset=["source_record_id", "timestamp"])

    return resolve_station(parsed, stations, broadcast_limit_rows).select(*S.RAW_COLUMNS)


def resolve_station(
    rows: DataFrame, stations: DataFrame | None = None, broadcast_limit_rows: int = 100_000
) -> DataFrame:
    """SRC5 / JOIN5: ``station_name`` = feed name, else dimension name, else the code.

    ``rows`` carries ``_requested`` (station code asked for) and ``_feed_name``. Without a
    ``stations`` frame the fixed lookup is a map expression (no join at all); with one,
    the dimension is broadcast only after checking it is small, else joined normally.
    """
    if stations is None:
        fallback = station_name_lookup(F.col("_requested"))
    else:
        dim = stations.select(
            F.col("station_id").alias("_requested"), F.col("station_name").alias("_dim_name")
        )
        if dim.count() <= broadcast_limit_rows:
            dim = F.broadcast(dim)
        rows = rows.join(dim, "_requested", "left")
        fallback = F.col("_dim_name")
    name = F.coalesce(F.col("_feed_name"), fallback, F.col("_requested"))
    return rows.withColumn("station_name", name).drop("_requested", "_feed_name", "_dim_name")


def explode_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """SRC1: one row per feature; a document without ``features`` yields no rows."""
    features = F.from_json(F.col(text_col), DOCUMENT_DDL)["features"]
    return docs.select("*", F.explode(F.coalesce(features, F.array().cast("array<string>"))).alias("feature"))


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents under ``path``, by name only: their content is not read."""
    schema = T.StructType([T.StructField("file", T.StringType())])
    name = F.col("_metadata.file_path").alias("file")
    return or_empty(spark, schema, lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(name))


def station_of(file: str) -> str | None:
    """The station whose folder a landed document lies in."""
    found = re.search(rf"/{STATION_PARTITION}=([^/]+)/", file)
    return unquote(found[1]) if found else None


def read_landing(
    spark: SparkSession,
    path: str,
    fetched_at: str,
    limit: int | None = None,
    stations: DataFrame | None = None,
    station_ids: list[str] | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """SRC1 + SRC9 + SRC10: read every station document under ``path`` (files in parallel).

    ``files`` names the documents to read (one pull's) instead of all; ``station_ids`` prunes
    ``station=`` folders at planning time; ``limit`` keeps the newest observations per
    station, as the live service does. By default nothing that landed is left out.
    """
    reader = spark.read.option("wholetext", "true").option("basePath", path)
    docs = reader.text([unquote(f) for f in files] if files is not None else path)  # names are URIs
    if station_ids:
        docs = docs.where(F.col(STATION_PARTITION).isin(list(station_ids)))
    raw = observations_of(named(docs), fetched_at, stations)
    if limit is not None:
        raw = latest_per_station(raw, limit).drop("recency_rank")
    return raw


def named(docs: DataFrame) -> DataFrame:
    """Documents (batch or stream) with the station of their folder and the file they came from."""
    return docs.select("value", F.col(STATION_PARTITION).cast("string"), F.col("_metadata.file_path").alias("_file"))


def observations_of(docs: DataFrame, fetched_at: str, stations: DataFrame | None = None) -> DataFrame:
    """Raw rows of documents as :func:`named` gives them; the file is their ``source_url``."""
    return parse_features(explode_documents(docs), fetched_at=fetched_at, source_url=F.col("_file"), stations=stations)


def render_features(
    obs: DataFrame, requested_col: str = STATION_PARTITION, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Raw rows -> feature JSON text (the inverse of :func:`parse_features`)."""
    ts_text = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    geometry = F.when(
        F.col("latitude").isNotNull() | F.col("longitude").isNotNull(),
        F.struct(F.array(F.col("longitude"), F.col("latitude")).alias("coordinates")),
    )
    props = F.struct(
        F.col("source_record_id").alias("@id"),
        F.col("station_id").alias("stationId"),
        F.col("station_name").alias("stationName"),
        ts_text.alias("timestamp"),
        F.col("text_description").alias("textDescription"),
        *[F.struct(F.col(c).alias("value")).alias(prop) for c, prop in MEASURE_PROPERTIES.items()],
        F.col("raw_message").alias("rawMessage"),
        F.col("icon").alias("icon"),
    )
    feature = F.to_json(F.struct(geometry.alias("geometry"), props.alias("properties")))
    return obs.select(F.col(requested_col), *extra, feature.alias("feature"))


def render_documents(
    features: DataFrame,
    page_key: Column,
    requested_col: str = STATION_PARTITION,
) -> DataFrame:
    """Group feature strings into documents, one per (station, page).

    ``page_key`` must bound the number of features per document (e.g. a sequence number
    divided by a page size): a document is one row, so a group must never grow with the
    data.
    """
    return features.groupBy(F.col(requested_col), page_key.alias("_page")).agg(
        F.concat(
            F.lit('{"features":['), F.array_join(F.collect_list("feature"), ","), F.lit("]}")
        ).alias("value")
    ).select(requested_col, "value")


def write_landing(docs: DataFrame, path: str) -> str:
    """SNK1: land documents under ``station=<id>/``, one to a file (never merged or rewritten)."""
    out = docs.select("value", STATION_PARTITION).write.mode("append").option("maxRecordsPerFile", 1)
    out.partitionBy(STATION_PARTITION).text(path)
    return path
