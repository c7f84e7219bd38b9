"""Random overlapping pulls through the refresh job follow the rules, fractional measures included."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from chronolake import schemas as S
from chronolake.plans.explorer import Explorer
from chronolake.plans.refresh import refresh_snapshot
from chronolake.session import shared_dir
from chronolake.sources import fixture as FX

from . import rules

T0 = dt.datetime(2024, 1, 1)
ROW = st.tuples(
    st.integers(1, 3),                                   # pull
    st.sampled_from([f"r{i}" for i in range(6)]),        # id (shared across pulls)
    st.one_of(st.none(), st.sampled_from(["KJFK", "KSEA"])),
    st.sampled_from(["A", "B"]),                         # station name
    st.one_of(st.none(), st.integers(-30, 45)),          # temperature
    st.one_of(st.none(), st.integers(0, 90)),            # gust
)


def _pulls(rows):
    # a distinct minute per row: no ties in the keep-first order
    recs = []
    for i, (pull, rid, station, name, temp, gust) in enumerate(rows):
        rec = {c: None for c in S.RAW_COLUMNS}
        rec.update(
            pull=pull, source_record_id=rid, station_id=station, station_name=name,
            timestamp=T0 + dt.timedelta(hours=(i * 7) % 40, minutes=i),
            temperature_c=None if temp is None else temp + 0.1,
            wind_gust_kmh=None if gust is None else gust / 3 * 3.0,
            pressure_pa=99000.0, humidity_pct=50.0, wind_speed_kmh=5.0,
            present_weather_count=0, fetched_at=FX.PULL_AS_OF[pull], source_url="test",
        )
        recs.append(rec)
    return recs


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=3, max_size=25).filter(lambda r: {p for p, *_ in r} == {1, 2, 3}))
def test_refresh_job_follows_the_rules(spark, rows):
    recs = _pulls(rows)
    root = shared_dir(spark, "prop")
    schema = T.StructType(S.RAW_SCHEMA.fields + [T.StructField("pull", T.IntegerType())])
    raw_all = spark.createDataFrame(recs, schema)
    created = {}
    for pull in (1, 2, 3):
        done = refresh_snapshot(spark, root, raw_all.where(f"pull = {pull}").drop("pull"), FX.PULL_AS_OF[pull])
        if done.status == "CREATED":
            created[pull] = done.entry["snapshot_id"]
        else:
            assert done.status == "NO_CHANGE"
    want = rules.published({n: [r for r in recs if r["pull"] == n] for n in (1, 2, 3)})
    assert sorted(want) == sorted(created)
    ex = Explorer(spark, root)
    for pull, snapshot_id in created.items():
        rules.check(ex, snapshot_id, want[pull])
