"""Feed parsing vs a brute-force Python parser on random feature documents."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronolake import schemas as S
from chronolake.sources import feed as FD

NUMBER = st.one_of(st.none(), st.integers(-50, 120), st.sampled_from(["7", "12.5", "n/a", ""]))
MEASURE = st.one_of(st.just("absent"), st.none(), st.fixed_dictionaries({"value": NUMBER}))
TS = st.one_of(
    st.none(),
    st.sampled_from(["garbage", "2024-01-05T10:00:00+00:00", "2024-01-05T05:00:00-05:00",
                     "2024-01-05T10:30:15.250000Z", "2024-02-29T23:59:59+01:00"]),
)
FEATURE = st.fixed_dictionaries(
    {
        "id": st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
        "station": st.one_of(st.none(), st.sampled_from(["KSEA", "XYZ"])),
        "name": st.one_of(st.none(), st.just("Feed Name")),
        "ts": TS,
        "temperature": MEASURE,
        "windGust": MEASURE,
        "coords": st.one_of(st.none(), st.just([]), st.just([-70.5, 40.25]), st.just(["x", 1])),
        "weather": st.one_of(st.just("absent"), st.none(), st.lists(st.just({"w": 1}), max_size=3)),
    }
)


def _feature(f):
    props = {"timestamp": f["ts"]}
    if f["id"] is not None:
        props["@id"] = f["id"]
    if f["station"] is not None:
        props["stationId"] = f["station"]
    if f["name"] is not None:
        props["stationName"] = f["name"]
    for key in ("temperature", "windGust"):
        if f[key] != "absent":
            props[key] = f[key]
    if f["weather"] != "absent":
        props["presentWeather"] = f["weather"]
    return {"geometry": None if f["coords"] is None else {"coordinates": f["coords"]}, "properties": props}


def _num(v):
    try:
        return float(v) if v is not None and v != "" else None
    except (TypeError, ValueError):
        return None


def _utc(text):
    if text is None:
        return None
    try:
        t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None)


def _brute(requested, feats):
    out = []
    for f in feats:
        ts = _utc(f["ts"])
        if f["id"] is None or ts is None:
            continue
        coords = f["coords"] or []
        measure = {k: (_num(f[k]["value"]) if isinstance(f[k], dict) else None) for k in ("temperature", "windGust")}
        out.append((
            f["id"], f["station"] or requested,
            f["name"] or S.STATION_OPTIONS.get(requested, requested), ts,
            measure["temperature"], measure["windGust"],
            _num(coords[1]) if len(coords) > 1 else None, _num(coords[0]) if coords else None,
            len(f["weather"]) if isinstance(f["weather"], list) else 0,
        ))
    return sorted(out, key=repr)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(["KSEA", "KJFK", "ZZZZ"]), st.lists(FEATURE, max_size=8))
def test_parse_matches_brute_force(spark, requested, feats):
    doc = json.dumps({"features": [_feature(f) for f in feats]})
    docs = spark.createDataFrame([(requested, doc)], "station string, value string")
    got = FD.parse_features(FD.explode_documents(docs)).collect()
    rows = sorted(
        ((r.source_record_id, r.station_id, r.station_name, r.timestamp, r.temperature_c, r.wind_gust_kmh,
          r.latitude, r.longitude, r.present_weather_count) for r in got),
        key=repr,
    )
    assert rows == _brute(requested, feats)
