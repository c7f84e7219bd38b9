"""Row identity, the ledger of runs, exact averages, gold by changes, compaction, the stream of documents."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators import layers as L
from chronolake.operators.dedupe import flag_first_distinct
from chronolake.plans import rebuild as RB
from chronolake.plans.compact import compact
from chronolake.plans.explorer import Explorer
from chronolake.plans.refresh import refresh_if_due, refresh_snapshot
from chronolake.sources import catalog as CAT
from chronolake.sources import feed as FD
from chronolake.sources import store as ST
from chronolake.sources.store import LayerStore
from chronolake.streaming import ingest


def raw_rows(spark, rows):
    """(id, station, timestamp, temperature) -> a pull."""
    df = spark.createDataFrame(rows, "source_record_id string, station_id string, timestamp string, temperature_c double")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW_SCHEMA.fields if f.name not in df.columns]
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).select("*", *others).select(*S.RAW_COLUMNS)


def test_rows_of_a_first_pull_stay_apart(spark):
    """A microsecond, null against empty, the sign of a zero and the last digit of a double all tell rows apart."""
    schema = "k string, t timestamp_ntz, z timestamp, s string, x double, b binary, n int"
    base = ("a", "2024-01-01 00:00:00.123456", "2024-01-01 00:00:00.123456", None, 0.0, b"1:a", 1)
    changes = [(1, "2024-01-01 00:00:00.123457"), (2, "2024-01-01 00:00:00.123457"), (3, ""), (3, "-"), (4, -0.0), (4, 5e-324), (4, None), (5, None), (5, b""), (6, None), (0, None)]
    rows = [base, base] + [tuple(v if i == at else x for i, x in enumerate(base)) for at, v in changes]
    text = schema.replace("timestamp_ntz", "string").replace("timestamp", "string")
    df = spark.createDataFrame(rows, text).select("k", F.col("t").cast("timestamp_ntz"), F.col("z").cast("timestamp"), "s", "x", "b", "n")
    got = flag_first_distinct(df.repartition(4), "k", ["t"]).collect()
    assert sorted(r.copies for r in got) == [1] * len(changes) + [2]
    assert sorted(str(r.x) for r in got).count("-0.0") == 1
    assert sum(r.is_first for r in got) == 2  # ids a and null
    # neighbouring values cannot be read as each other
    twins = spark.createDataFrame([("1:a", "b"), ("1", "a1:b"), ("-", None), (None, "-")], "k string, s string")
    assert flag_first_distinct(twins, "k", ["s"]).count() == 4


def land(path, station, name, ids, hour=0):
    """One document with an observation for each id."""
    os.makedirs(f"{path}/station={station}", exist_ok=True)
    features = [
        {"properties": {"@id": i, "stationId": station, "timestamp": f"2024-01-{1 + n // 24:02d}T{n % 24:02d}:00:00+00:00", "temperature": {"value": n / 7}}}
        for n, i in enumerate(ids, start=hour)
    ]
    with open(f"{path}/station={station}/{name}", "w") as out:
        json.dump({"features": features}, out)


@pytest.fixture
def landing(tmp_path):
    path = f"{tmp_path}/landing zone"  # file names with spaces must match, too
    land(path, "KJFK", "a 1.json", [f"j{i}" for i in range(40)])
    land(path, "KSEA", "b.json", [f"s{i}" for i in range(30)])
    land(path, "KDEN", "c.json", [])
    return f"file://{path}", path


def at(day):
    return f"2024-03-{day:02d}T00:00:00+00:00"


def published(spark, root, n):
    return {r.source_record_id: r.ingest_ts for r in Explorer(spark, root).as_of("bronze", f"T{n}").collect()}


def test_a_run_for_one_station_leaves_the_others(spark, workdir, landing):
    url, _ = landing
    first = refresh_if_due(spark, workdir, url, at(1), station_ids=["KJFK"])
    assert (first.status, first.dropped, first.unread) == ("CREATED", 0, 2)
    assert set(published(spark, workdir, 1)) == {f"j{i}" for i in range(40)}
    second = refresh_if_due(spark, workdir, url, at(2), force=True)
    assert (second.status, second.unread) == ("CREATED", 0)
    rows = published(spark, workdir, 2)
    assert len(rows) == 70 and {t for i, t in rows.items() if i[0] == "j"} == {at(1)}
    assert refresh_if_due(spark, workdir, url, at(3), force=True).status == "SKIPPED"
    kept = {(r.station, r.rows, r.taken, r.outcome, r.seq) for r in CAT.ledger(spark, workdir).collect()}
    assert kept == {("KJFK", 40, 40, "CREATED", 1), ("KSEA", 30, 30, "CREATED", 2), ("KDEN", 0, 0, "CREATED", 2)}


def test_rows_that_a_limit_left_out_come_later(spark, workdir, landing):
    url, _ = landing
    first = refresh_if_due(spark, workdir, url, at(1), limit=25)
    assert (first.status, first.dropped) == ("CREATED", 20)
    assert refresh_if_due(spark, workdir, url, at(2), limit=25, force=True).status == "NO_CHANGE"
    assert refresh_if_due(spark, workdir, url, at(3), force=True).status == "CREATED"
    assert len(published(spark, workdir, 2)) == 70
    assert refresh_if_due(spark, workdir, url, at(4), force=True).status == "SKIPPED"


def test_what_came_of_a_document_is_kept_whatever_it_was(spark, workdir, landing, monkeypatch):
    """A landing of known rows, or of none, is parsed once."""
    url, path = landing
    refresh_if_due(spark, workdir, url, at(1))
    land(path, "KJFK", "again.json", [f"j{i}" for i in range(40)])
    land(path, "KDEN", "none.json", [])
    assert refresh_if_due(spark, workdir, url, at(2), force=True).status == "NO_CHANGE"
    land(path, "KDEN", "still none.json", [])
    assert refresh_if_due(spark, workdir, url, at(3), force=True).status == "SKIPPED"
    monkeypatch.setattr(FD, "read_landing", lambda *a, **k: pytest.fail("read again"))
    assert refresh_if_due(spark, workdir, url, at(4), force=True).status == "SKIPPED"
    assert {r.outcome for r in CAT.ledger(spark, workdir).collect()} == {"CREATED", "NO_CHANGE", "SKIPPED"}


def test_a_run_that_dies_settles_nothing(spark, workdir, landing, monkeypatch):
    url, _ = landing
    with monkeypatch.context() as m:
        m.setattr(CAT, "append_entry", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            refresh_if_due(spark, workdir, url, at(1))
    assert CAT.settled_files(spark, workdir).count() == 0
    assert refresh_if_due(spark, workdir, url, at(2)).status == "CREATED"
    assert len(published(spark, workdir, 1)) == 70


def test_documents_as_a_stream(spark, workdir, landing):
    """Each document is published once, also where the scheduled job took it or a batch comes again."""
    url, path = landing
    days = iter(range(1, 30))
    drain = lambda: ingest.stream_documents(spark, workdir, url, lambda: at(next(days)), max_files_per_trigger=1).awaitTermination()
    drain()
    assert len({r.source_record_id for r in Explorer(spark, workdir).as_of("bronze", "T2").collect()}) == 70
    land(path, "KJFK", "late.json", [f"j{i}" for i in range(30, 50)], hour=30)
    assert refresh_if_due(spark, workdir, url, at(29), force=True).status == "CREATED"
    drain()  # the job has it
    assert Explorer(spark, workdir).latest()["seq"] == 3
    docs = FD.named(spark.read.option("wholetext", "true").option("basePath", url).text(url))
    assert ingest.publish_documents(spark, workdir, S.DEFAULT_SOURCE_NAME, docs, 0, at(29)).status == "SKIPPED"


def test_averages_do_not_depend_on_order_or_refreshes(spark, workdir):
    """Fractional readings, one far outside any other: equal bit for bit, whatever came when."""
    rng = random.Random(4)
    rows = [(f"r{i}", "A", f"2024-01-0{1 + i % 3} 00:00:{i % 60:02d}", rng.uniform(-40, 40) / 3) for i in range(600)]
    rows += [("far", "A", "2024-01-01 01:00:00", 1e300), ("small", "A", "2024-01-02 01:00:00", 1e-9)]
    states = []
    for seed in range(2):
        rng = random.Random(seed)
        mixed = rng.sample(rows, len(rows))
        root = f"{workdir}/{seed}"
        cuts = [0, *sorted(rng.sample(range(1, len(rows)), seed + 1)), len(rows)]
        for day, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), start=1):
            refresh_snapshot(spark, root, raw_rows(spark, mixed[a:b]), at(day))
        gold = Explorer(spark, root).as_of("gold", f"T{len(cuts) - 1}")
        states.append(sorted((r.partition_date, r.rows_processed, r.avg_temperature_c.hex()) for r in gold.collect()))
    assert states[0] == states[1] and len(states[0]) == 3
    own = [x for _, _, t, x in rows if t.startswith("2024-01-03")]
    assert float.fromhex(states[0][2][2]) == pytest.approx(sum(own) / len(own), rel=1e-12)


def test_gold_grows_with_changes(spark, workdir, monkeypatch):
    """Each snapshot writes the groups it touches; all of them are as a recomputation has them."""
    monkeypatch.setattr(ST, "FULL_EVERY", 3)
    days = [f"2024-01-{d:02d}" for d in range(1, 21)]
    pulls = [[(f"{n}-{d}", "AB"[k % 2], f"{day} 0{n % 9}:00:00", float(n + k)) for k, (d, day) in enumerate(enumerate(days))] if n == 1 else
             [(f"{n}-x", None if n % 3 == 0 else "A", f"{days[n % 20]} 05:00:00", n / 3)] for n in range(1, 6)]
    for n, rows in enumerate(pulls, start=1):
        refresh_snapshot(spark, workdir, raw_rows(spark, rows), at(n))
    store = LayerStore(spark, workdir)
    sizes = {r.seq: r.n for r in store.gold_store().groupBy("seq").agg(F.count("*").alias("n")).collect()}
    assert sizes[1] == 20 and sizes[4] >= 20 and all(sizes[n] <= 2 for n in (2, 3, 5))
    whole = RB.gold_history(store.log(), len(pulls)).collect()
    for n in range(1, len(pulls) + 1):
        want = sorted((tuple(r[c] for c in S.GOLD_COLUMNS) for r in whole if r.seq == n), key=str)
        assert sorted(map(tuple, Explorer(spark, workdir).as_of("gold", f"T{n}").collect()), key=str) == want
    before = [sorted(map(str, Explorer(spark, workdir).as_of("gold", f"T{n}").collect())) for n in (1, 3, 5)]
    RB.rebuild(spark, workdir)
    again = LayerStore(spark, workdir)
    assert {r.seq: r.n for r in again.gold_store().groupBy("seq").agg(F.count("*").alias("n")).collect()} == sizes
    assert [sorted(map(str, Explorer(spark, workdir).as_of("gold", f"T{n}").collect())) for n in (1, 3, 5)] == before


def many(spark, n, days=3):
    day = F.date_format(F.expr(f"date_add(date'2024-01-01', cast(id % {days} as int))"), "yyyy-MM-dd")
    df = spark.range(n).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("i"), F.concat(day, F.lit(" 00:00:00")).alias("t"))
    df = df.select(F.col("i").alias("source_record_id"), F.lit("A").alias("station_id"), F.col("t").cast("timestamp_ntz").alias("timestamp"), F.lit(1.5).alias("temperature_c"))
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW_SCHEMA.fields if f.name not in df.columns]
    return df.select("*", *others).select(*S.RAW_COLUMNS)


def files_of(path):
    return [f"{d}/{f}" for d, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")]


def test_a_rebuilt_day_is_spread_by_its_size(spark, workdir):
    import pyarrow.parquet as pq

    refresh_snapshot(spark, workdir, many(spark, 30_000), at(1))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        RB.rebuild(spark, workdir)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files_of(f"{workdir}/silver_log_v1")]
    assert sum(sizes) == 30_000 and max(sizes) <= 6_000  # a day is a third of the rows
    assert Explorer(spark, workdir).as_of("silver", "T1").count() == 30_000


def test_compaction_changes_files_only(spark, workdir, monkeypatch):
    for n in range(1, 4):
        refresh_snapshot(spark, workdir, raw_rows(spark, [(f"{n}-{i}", "A", f"2024-01-0{n} 0{i}:00:00", i / 3) for i in range(5)]), at(n))

    def seen():
        ex = Explorer(spark, workdir)
        return [sorted(map(str, ex.as_of(x, f"T{n}").collect())) for x in S.LAYERS for n in range(1, 4)]

    before = seen()
    with monkeypatch.context() as m:  # dies after its files, before they count
        m.setattr(CAT, "publish_spans", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            compact(spark, workdir)
    assert seen() == before and LayerStore(spark, workdir).spans == []
    assert compact(spark, workdir) == {"bronze_log": 3, "silver_log": 3}
    assert seen() == before and compact(spark, workdir) == {}
    store = LayerStore(spark, workdir)
    opened = store.silver_log().inputFiles()
    assert len(store.silver_log().where("seq <= 3").inputFiles()) <= len(opened) and sum("_c" in f for f in opened) >= 1
    assert refresh_snapshot(spark, workdir, raw_rows(spark, [("3-1", "A", "2024-01-03 01:00:00", 1.0), ("new", "B", "2024-01-09 00:00:00", 2.0)]), at(5)).status == "CREATED"
    assert compact(spark, workdir) == {"bronze_log": 1, "silver_log": 1}
    assert seen() == before and Explorer(spark, workdir).as_of("bronze", "T4").count() == 16
    RB.rebuild(spark, workdir)  # other folders, which no span covers
    assert seen() == before and Explorer(spark, workdir).as_of("silver", "T4").count() == 16


def test_days_outside_a_range_are_not_read(spark, workdir):
    """SRT1: rows lie by day, so a day's predicate skips the row groups of other days."""
    refresh_snapshot(spark, workdir, many(spark, 30_000, days=10), at(1))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        compact(spark, workdir)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    span = LayerStore(spark, workdir).spans[0]["folder"]
    wanted = spark.read.schema(S.BRONZE_SCHEMA).parquet(f"{workdir}/{span}").where("partition_date between '2024-01-04' and '2024-01-05'").select("source_record_id")
    plan = wanted._jdf.queryExecution().executedPlan()
    assert "PushedFilters" in plan.toString() and len(wanted.collect()) == 6_000
    read = [n.metrics().apply("numOutputRows").value() for n in [wanted._jdf.queryExecution().executedPlan().collectLeaves().head()]]
    assert 6_000 <= read[0] <= 15_000


def test_null_stations_of_the_comparison_text(spark):
    gold = [("2024-01-01", None, 3), ("2024-01-01", "A", 5), ("2024-01-02", "A", 1)]
    cur = spark.createDataFrame(gold, "partition_date string, station_id string, rows_processed long")
    prev = spark.createDataFrame(gold[:2], cur.schema)
    from chronolake.operators import compare as CMP
    from chronolake.plans import query_panel as QP

    got = CMP.custom_sql(spark, cur, prev, QP.sql_text("gold", S.QUERY_OPTIONS[1]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("2024-01-01", None, 3, 0, 3), ("2024-01-01", None, 0, 3, -3), ("2024-01-01", "A", 5, 5, 0), ("2024-01-02", "A", 1, 0, 1)], key=str
    )


def test_layers_merge_is_typed(spark):
    state = L.gold_state(L.to_silver(L.to_bronze(raw_rows(spark, [("a", "A", "2024-01-01 00:00:00", 1.25)]), "s", "t")))
    assert L.merge_gold_state(state, state).schema["sum_temperature_c"].dataType == S.GOLD_STATE_SCHEMA["sum_temperature_c"].dataType
