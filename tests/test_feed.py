"""Feed documents -> raw rows (SRC1-12), landing folder (SNK1), refresh_if_due (SNP6-7)."""

import json

from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.plans.refresh import refresh_if_due
from chronolake.sources import feed as FD
from chronolake.sources import fixture as FX

SF = "/root/testdata/sf0.001"


def _docs(spark, docs):
    return spark.createDataFrame([(st, d) for st, d in docs], "station string, value string")


def _parse(spark, docs):
    return FD.parse_features(FD.explode_documents(_docs(spark, docs)), fetched_at="2024-01-02T00:00:00+00:00")


def test_hand_made_cases(spark):
    good = {
        "geometry": {"coordinates": [-73.78, 40.64]},
        "properties": {
            "@id": "a", "stationId": "KJFK", "stationName": "JFK", "timestamp": "2024-01-01T10:51:00+00:00",
            "textDescription": "Clear", "temperature": {"value": 12.5}, "windSpeed": {"value": "7"},
            "relativeHumidity": {"value": "n/a"}, "presentWeather": [{"w": 1}, {"w": 2}], "extra": 1,
        },
    }
    null_geometry = {"geometry": None, "properties": {"@id": "b", "timestamp": "2024-01-01T10:00:00Z",
                                                       "temperature": {"value": None}, "presentWeather": None}}
    missing_id = {"properties": {"timestamp": "2024-01-01T10:00:00+00:00"}}
    bad_ts = {"properties": {"@id": "d", "timestamp": "yesterday"}}
    offset_ts = {"properties": {"@id": "e", "timestamp": "2024-01-01T05:00:00-05:00"}}
    docs = [
        ("KSEA", json.dumps({"features": [good, null_geometry, missing_id, bad_ts, offset_ts]})),
        ("KSFO", json.dumps({"type": "FeatureCollection"})),  # no features -> no rows
        ("KORD", "not json at all"),
    ]
    rows = {r["source_record_id"]: r for r in _parse(spark, docs).collect()}
    assert set(rows) == {"a", "b", "e"}
    a, b, e = rows["a"], rows["b"], rows["e"]
    assert (a.latitude, a.longitude) == (40.64, -73.78)
    assert a.temperature_c == 12.5 and a.wind_speed_kmh == 7.0 and a.humidity_pct is None
    assert a.present_weather_count == 2 and a.station_id == "KJFK" and a.station_name == "JFK"
    assert json.loads(a.raw_payload_json)["properties"]["extra"] == 1  # unknown fields kept
    assert b.latitude is None and b.temperature_c is None and b.present_weather_count == 0
    # station defaults: requested id, then the fixed lookup
    assert b.station_id == "KSEA" and b.station_name == S.STATION_OPTIONS["KSEA"]
    assert str(e.timestamp) == "2024-01-01 10:00:00"  # offset resolved to UTC
    assert e.fetched_at == "2024-01-02T00:00:00+00:00"


def test_unknown_station_falls_back_to_code_and_dimension_frame(spark):
    docs = [("XXXX", json.dumps({"features": [{"properties": {"@id": "x", "timestamp": "2024-01-01T00:00:00Z"}}]}))]
    assert _parse(spark, docs).first().station_name == "XXXX"
    dim = spark.createDataFrame([("XXXX", "Somewhere")], "station_id string, station_name string")
    parsed = FD.parse_features(FD.explode_documents(_docs(spark, docs)), stations=dim)
    assert parsed.first().station_name == "Somewhere"


def test_landing_round_trip_and_latest_n(spark, workdir):
    obs = FX.observations(FX.read_events(spark, SF), keep=("user_id",)).withColumn(
        FD.STATION_PARTITION, F.coalesce("station_id", F.lit("KNUL"))
    )
    feats = FD.render_features(obs.withColumn("_page", F.floor(F.col("event_id") / 50)), extra=("_page",))
    docs = FD.render_documents(feats, F.col("_page"))
    path = FD.write_landing(docs, f"{workdir}/landing")
    back = FD.read_landing(spark, path, fetched_at="2024-02-01T00:00:00+00:00", limit=None)
    expected = obs.select(*[c for c in S.RAW_COLUMNS if c not in ("fetched_at", "source_url", "raw_payload_json")])
    got = back.select(*expected.columns)
    expected = expected.withColumn("station_id", F.coalesce("station_id", F.lit("KNUL")))
    assert got.count() == expected.count()
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert back.where(~F.col("source_url").contains("station=")).isEmpty()
    # SRC10 + station pruning
    top = FD.read_landing(spark, path, "2024-02-01T00:00:00+00:00", limit=5, station_ids=["KJFK", "KSEA"])
    counts = {r[0]: r[1] for r in top.groupBy("station_id").count().collect()}
    assert counts == {"KJFK": 5, "KSEA": 5}


def test_refresh_if_due_outcomes(spark, workdir):
    obs = FX.observations(FX.read_events(spark, SF)).where(F.col("station_id").isNotNull())
    obs = obs.withColumn(FD.STATION_PARTITION, F.col("station_id"))
    feats = FD.render_features(obs.withColumn("_page", F.floor(F.col("event_id") / 72)), extra=("_page",))
    landing = FD.write_landing(FD.render_documents(feats, F.col("_page")), f"{workdir}/landing")
    root = f"{workdir}/store"
    first = refresh_if_due(spark, root, landing, now="2024-02-01T00:00:00+00:00")
    assert first.status == "CREATED" and first.dropped == 0
    assert first.entry["row_counts"]["bronze"] == obs.count()  # all that landed
    not_due = refresh_if_due(spark, root, landing, now="2024-02-01T12:00:00+00:00")
    assert not_due.status == "SKIPPED_NOT_DUE"
    same = refresh_if_due(spark, root, landing, now="2024-02-01T12:00:00+00:00", force=True)
    assert same.status == "SKIPPED"  # no new document: nothing is read again
    # On request only the newest of some stations are published, and the rest is counted.
    other = f"{workdir}/other"
    few = refresh_if_due(spark, other, landing, "2024-02-02T00:00:00+00:00", ["KJFK", "KSEA"], limit=10)
    assert few.entry["metrics"]["rows_processed"] == 20 and few.unread > 0
    # What the limit left out of the documents read; those of other stations are not read, and stay open.
    assert few.dropped == obs.where(F.col("station").isin("KJFK", "KSEA")).count() - 20
    # A document that lands later is the next pull; known rows in it change nothing.
    FD.write_landing(FD.render_documents(feats.where("_page = 1"), F.col("_page")), landing)
    again = refresh_if_due(spark, root, landing, now="2024-02-03T00:00:00+00:00")
    assert again.status == "NO_CHANGE"


def test_refresh_cli(spark, workdir):
    from chronolake.plans.refresh import main

    obs = FX.observations(FX.read_events(spark, SF)).where(F.col("station_id").isNotNull())
    obs = obs.withColumn(FD.STATION_PARTITION, F.col("station_id"))
    feats = FD.render_features(obs.withColumn("_page", F.floor(F.col("event_id") / 72)), extra=("_page",))
    landing = FD.write_landing(FD.render_documents(feats, F.col("_page")), f"{workdir}/landing")
    args = [f"{workdir}/store", landing, "--at", "2024-02-01T00:00:00+00:00"]
    assert main(args).status == "CREATED"
    assert main(args).status == "SKIPPED_NOT_DUE"
    assert main(args + ["--older-than", "0"]).status == "SKIPPED"
