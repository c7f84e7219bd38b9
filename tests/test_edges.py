"""Edge cases on small frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators import compare as CMP
from chronolake.operators import layers as L
from chronolake.operators.dedupe import flag_first_distinct, keep_first
from chronolake.plans import query_panel as QP
from chronolake.plans.timetravel import empty_layer

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def raw_rows(spark, rows):
    """rows: dicts with any raw columns; the rest are null."""
    full = [{c: r.get(c) for c in S.RAW_COLUMNS} for r in rows]
    return spark.createDataFrame(full, S.RAW_SCHEMA)


def obs(i, **kw):
    base = {"source_record_id": f"id{i}", "station_id": "KJFK", "station_name": "JFK",
            "timestamp": T0 + dt.timedelta(minutes=i), "temperature_c": 10.0, "pressure_pa": 100000.0,
            "humidity_pct": 50.0, "wind_speed_kmh": 5.0, "wind_gust_kmh": 10.0, "present_weather_count": 0}
    base.update(kw)
    return base


def silver_of(spark, rows):
    return L.to_silver(L.to_bronze(raw_rows(spark, rows), "src", "2024-01-02T00:00:00+00:00"))


def test_nan_is_null_on_entry(spark):
    s = silver_of(spark, [obs(1, wind_gust_kmh=math.nan, temperature_c=math.nan)]).first()
    assert s.wind_gust_kmh is None and s.temperature_c is None
    assert s.anomaly_flag is False and s.quality_flag == "REVIEW"


@pytest.mark.parametrize(
    "kw,flag",
    [
        ({"wind_gust_kmh": 70.0}, False), ({"wind_gust_kmh": 70.5}, True),
        ({"pressure_pa": 98000.0}, False), ({"pressure_pa": 97999.0}, True),
        ({"temperature_c": 38.0}, False), ({"temperature_c": 38.1}, True),
        ({"temperature_c": -25.0}, False), ({"temperature_c": -25.1}, True),
        ({"pressure_pa": None}, False), ({"wind_gust_kmh": None}, False),
    ],
)
def test_strict_thresholds(spark, kw, flag):
    assert silver_of(spark, [obs(1, **kw)]).first().anomaly_flag is flag


def test_quality_flag(spark):
    rows = [obs(1), obs(2, humidity_pct=None), obs(3, pressure_pa=None), obs(4, temperature_c=None)]
    flags = {r.source_record_id: r.quality_flag for r in silver_of(spark, rows).collect()}
    assert flags == {"id1": "PASS", "id2": "REVIEW", "id3": "REVIEW", "id4": "REVIEW"}


def gold_of(silver):
    """Gold of a first snapshot of these rows."""
    fresh = silver.where("station_id is not null").groupBy(F.col("observation_date").alias("partition_date"), "station_id")
    return L.gold_from_state(L.gold_state(silver), fresh.agg(F.count("*").alias("new_records")), "x")


def test_null_station_in_gold_new_counts_and_partition_key(spark):
    silver = silver_of(spark, [obs(1, station_id=None), obs(2, station_id=None), obs(3)])
    assert silver.where(F.col("station_id").isNull()).select("incremental_partition").first()[0] is None
    gold = {(r.station_id): r for r in gold_of(silver).collect()}
    assert gold[None].rows_processed == 2 and gold[None].new_records == 0  # GRP2 drops null stations
    assert gold["KJFK"].new_records == 1


def test_renamed_station_fans_out(spark):
    silver = silver_of(spark, [obs(1), obs(2, station_name="JFK renamed"), obs(3)])
    gold = gold_of(silver).collect()
    assert sorted((r.station_name, r.rows_processed, r.new_records) for r in gold) == [
        ("JFK", 2, 3), ("JFK renamed", 1, 3)
    ]


def test_first_pull_keeps_duplicates_later_reads_do_not(spark):
    rows = [obs(1), obs(1, timestamp=T0 + dt.timedelta(minutes=1, seconds=1)), obs(2), obs(2)]
    bronze = L.to_bronze(raw_rows(spark, rows), "src", "t")
    flagged = flag_first_distinct(bronze, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST).collect()
    assert sum(r.copies for r in flagged) == 4
    firsts = [r for r in flagged if r.is_first]
    assert sorted(r.source_record_id for r in firsts) == ["id1", "id2"]
    assert [r.timestamp for r in firsts if r.source_record_id == "id1"] == [T0 + dt.timedelta(minutes=1)]


def test_keep_first_order_and_nulls_last(spark):
    rows = [obs(1, station_id=None), obs(1, station_id="KSEA"), obs(1, timestamp=T0)]
    bronze = L.to_bronze(raw_rows(spark, rows), "src", "t")
    got = keep_first(bronze, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST).collect()
    assert len(got) == 1 and got[0].timestamp == T0
    got = keep_first(bronze.where(F.col("timestamp") != T0), L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST).first()
    assert got.station_id == "KSEA"


def test_keep_first_hot_key_is_partially_aggregated(spark):
    hot = spark.range(200_000).select(
        F.lit("hot").alias("k"), (F.col("id") % 1000).alias("t"), F.col("id").alias("v")
    ).union(spark.range(1000).select(F.concat(F.lit("k"), F.col("id").cast("string")), F.lit(5).cast("long"), F.col("id")))
    out = keep_first(hot.repartition(16), "k", ["t"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    row = out.where("k = 'hot'").first()
    assert (row.t, row.v) == (0, 0)
    assert out.count() == 1001


def test_unseen_broadcasts_only_a_counted_small_increment(spark):
    inc = L.to_bronze(raw_rows(spark, [obs(1), obs(2), obs(3)]), "s", "t")
    hist = spark.range(5000).selectExpr("concat('id', id) AS source_record_id")
    small = L.unseen(inc, hist)
    assert "GlobalLimit" not in small._jdf.queryExecution().executedPlan().toString()
    plan = small._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    assert small.count() == 0
    big = L.unseen(inc, hist, broadcast_limit_rows=1)  # "increment too large": no hints
    plan = big._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "BroadcastHashJoin" not in plan and "LeftAnti" in plan and "LeftSemi" not in plan
    assert big.count() == 0


def test_unseen(spark):
    inc = L.to_bronze(raw_rows(spark, [obs(1), obs(2), obs(3)]), "s", "t")
    hist = spark.createDataFrame([("id1",), ("id2",)], "source_record_id string")
    assert [r.source_record_id for r in L.unseen(inc, hist).collect()] == ["id3"]


def test_empty_gold_is_typed(spark):
    silver = silver_of(spark, [obs(1)]).where(F.lit(False))
    gold = gold_of(silver)
    assert [f.name for f in gold.schema.fields] == S.GOLD_COLUMNS
    assert gold.count() == 0
    assert empty_layer(spark, "gold").schema == S.GOLD_SCHEMA


def test_except_is_null_safe_and_distinct(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    b = spark.createDataFrame([(1, None)], "a int, b string")
    assert CMP.new_records(a, b).collect() == [(2, "x")]
    assert CMP.new_records(a, a).count() == 0  # p == c pair


def test_compare_gold_null_keys_never_match(spark):
    g = spark.createDataFrame([("2024-01-01", None, 3), ("2024-01-01", "K", 2)],
                              "partition_date string, station_id string, rows_processed long")
    out = CMP.compare_gold(g, g).collect()
    assert len(out) == 3  # null-station row once per side
    assert sorted(r.delta_rows for r in out) == [-3, 0, 3]


def test_custom_sql_blank_default_and_semicolon(spark):
    cur = spark.range(150).withColumnRenamed("id", "x")
    prev = spark.range(10).withColumnRenamed("id", "x")
    text, df = QP.run_snapshot_query(spark, "gold", prev, cur, "other", "   ")
    assert text == S.DEFAULT_CUSTOM_SQL and df.count() == 100
    _, df = QP.run_snapshot_query(spark, "gold", prev, cur,
                                  "other", "WITH q AS (SELECT x FROM current_data EXCEPT SELECT x FROM previous_data) SELECT count(*) AS n FROM q;")
    assert df.first().n == 140
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("current_data_", "previous_data_"))]


def test_canned_limit_is_deterministic(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("partition_key"), F.col("id").alias("row_count"))
    a = QP.CMP.top_rows(df, QP.CMP.full_order(df, ["partition_key desc"]), 200).collect()
    b = QP.CMP.top_rows(df.repartition(13), QP.CMP.full_order(df, ["partition_key desc"]), 200).collect()
    assert a == b and len(a) == 200


def test_expand_copies_spreads_a_huge_group(spark):
    from chronolake.plans.timetravel import expand_copies

    log = spark.createDataFrame(
        [("a", 1), ("b", 3), ("hot", 35)], "source_record_id string, copies long"
    )
    out = expand_copies(log, chunk=10)
    counts = {r[0]: r[1] for r in out.groupBy("source_record_id").count().collect()}
    assert counts == {"a": 1, "b": 3, "hot": 35}
    assert "Exchange hashpartitioning(source_record_id" in out._jdf.queryExecution().executedPlan().toString()


def test_due(spark):
    from chronolake.plans import catalog_views as CV
    from chronolake.plans.refresh import is_due

    newest = {"created_at": "2024-01-01T00:00:00+00:00"}
    assert is_due(None, "2024-01-02T00:00:00+00:00", 1440)
    assert not is_due(newest, "2024-01-01T23:59:00+00:00", 1440)
    assert is_due(newest, "2024-01-02T00:00:00+00:00", 1440) and is_due(newest, "2024-01-01T00:00:01+00:00", 0)
    assert is_due(newest, "2024-01-01T19:00:00-05:00", 1440)  # an offset clock is the same instant
    cat = spark.createDataFrame([{"seq": 1, "snapshot_id": "T1", **newest}], S.CATALOG_SCHEMA)
    pair = CV.default_pair(cat).first()
    assert (pair.previous_snapshot_id, pair.current_snapshot_id) == ("T1", "T1")


def test_pull_stamp_is_utc():
    from chronolake.sources.store import pull_stamp

    assert pull_stamp("2024-01-10T19:00:00-05:00") == pull_stamp("2024-01-11T00:00:00") == "20240111T000000Z"


def test_only_a_missing_path_reads_as_empty(spark, workdir):
    import pytest

    from chronolake.sources import catalog as CAT

    assert CAT.read_catalog(spark, workdir).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        CAT.read_catalog(spark, "nosuch://host/store").count()


def test_shared_folder_needs_a_checkpoint_dir_on_a_cluster():
    import pytest

    from chronolake.session import shared_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_snapshot_list_single_and_empty_catalog(spark):
    from chronolake.plans import catalog_views as CV

    one = spark.createDataFrame(
        [{"seq": 1, "snapshot_id": "T1", "created_at": "2024-01-11T00:00:00+00:00"}], S.CATALOG_SCHEMA
    )
    row = CV.snapshot_list(one).first()
    assert (row.label, row.is_latest, row.next_snapshot_id) == ("T1 (2024-01-11 00:00)", True, "T2")
    empty = spark.createDataFrame([], S.CATALOG_SCHEMA)
    assert CV.snapshot_list(empty).count() == 0
    assert CV.default_pair(empty).count() == 0
    assert CV.layer_counts(empty).count() == 0 and CV.scan_comparison(empty).count() == 0
