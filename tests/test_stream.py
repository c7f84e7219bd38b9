"""STR1: the stream publishes the same snapshots as the batch job, whole pulls only, idempotently."""

import time

from chronolake import schemas as S
from chronolake.plans import registered as R
from chronolake.plans.explorer import Explorer
from chronolake.sources import fixture as FX
from chronolake.sources.store import LayerStore
from chronolake.streaming import ingest

SF = "/root/testdata/sf0.001"
SRC = FX.FIXTURE_SOURCE_NAME


def same(a, b):
    cols = sorted(set(a.columns) - {"ingest_ts"})
    a, b = a.select(*cols), b.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def land(spark, root, pull, files=3):
    raw = FX.pull_frame(FX.read_events(spark, SF), pull).repartition(files, "source_record_id")
    return ingest.land_pull(spark, root, raw, FX.PULL_AS_OF[pull], SRC, FX.STATION_CODES)


def test_stream_equals_batch_and_replay_is_idempotent(spark, workdir):
    for pull in (1, 2):
        land(spark, workdir, pull)  # several files, one announcement a trigger
    ingest.start_ingest(spark, workdir, SRC, max_pulls_per_trigger=1).awaitTermination(300)
    ex = Explorer(spark, workdir)
    assert ex.latest()["seq"] == 2 and ex.latest()["station_ids"] == FX.STATION_CODES
    land(spark, workdir, 2)  # landed again under the same time: nothing new
    land(spark, workdir, 3)
    ingest.start_ingest(spark, workdir, SRC).awaitTermination(300)
    cat = ex.catalog().orderBy("seq").collect()
    assert [c.snapshot_id for c in cat] == ["T1", "T2", "T3"]
    assert [c.created_at for c in cat] == [FX.PULL_AS_OF[n] for n in (1, 2, 3)]
    for n in (1, 3):
        for layer in S.LAYERS:
            same(ex.as_of(layer, f"T{n}"), R.published(spark, SF).as_of(layer, f"T{n}"))
    batch = spark.read.schema(ingest.LANDED_SCHEMA).json(ingest.landed_dir(workdir, SRC))
    assert ingest.publish_batch(spark, workdir, SRC, batch, batch_id=99) == []
    assert ex.latest()["seq"] == 3


def test_half_a_pull_is_never_published(spark, workdir):
    """Files that land while the stream runs count once the pull is announced, all together."""
    raw = FX.pull_frame(FX.read_events(spark, SF), 1)
    half, rest = raw.where("hash(source_record_id) % 2 = 0"), raw.where("hash(source_record_id) % 2 <> 0")
    land(spark, workdir, 3)  # something to stream
    q = ingest.start_ingest(spark, workdir, SRC, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        path, n = LayerStore(spark, workdir).write_raw(half, SRC, FX.PULL_AS_OF[1])
        q.processAllAvailable()
        assert Explorer(spark, workdir).latest()["seq"] == 1
        rest.select(*S.RAW_COLUMNS).write.mode("append").parquet(path)
        ingest.announce_pull(spark, workdir, path, FX.PULL_AS_OF[1], SRC)
        deadline = time.time() + 120
        while Explorer(spark, workdir).latest()["seq"] < 2 and time.time() < deadline:
            q.processAllAvailable()
            time.sleep(1)
    finally:
        q.stop()
    entry = Explorer(spark, workdir).latest()
    assert 0 < n < raw.count()
    assert entry["metrics"]["rows_processed"] == raw.join(FX.pull_frame(FX.read_events(spark, SF), 3), "source_record_id", "left_anti").select("source_record_id").distinct().count()


def test_ingest_cli_drains_landed_pulls(spark, workdir):
    ingest.land_pull(spark, workdir, FX.pull_frame(FX.read_events(spark, SF), 1), FX.PULL_AS_OF[1], "cli_source")
    ingest.main(["--root", workdir, "--source", "cli_source"])
    assert Explorer(spark, workdir).latest()["snapshot_id"] == "T1"
