"""STR1: repeated, idempotent ingestion of overlapping pulls with Structured Streaming.

Landing a pull writes its rows to a folder of its own and then, when they are complete, one
line to ``landed/source=<name>/``: the pull's folder, time and stations. That small folder is
the stream; so a pull is seen whole or not at all, however many files it has, however few
files a trigger takes, and whenever the trigger fires. Each announced pull is read by its
path, once, and published oldest first through the same merge as the batch job (keep-first,
anti-join to history, append to the log). A pull landed again is a folder and an
announcement of its own: its late or changed rows are the next increment.

Deduplication lives in the log, not in a state store: lateness is unbounded, so a watermark
would change results. Exactly-once: the catalog records each published pull (``raw_path``)
and micro-batch (``batch_id``); a replayed batch skips pulls already published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake import schemas as S
from chronolake.plans.refresh import Refresh, refresh_snapshot
from chronolake.plans.snapshot import build_snapshot
from chronolake.sources import catalog as CAT
from chronolake.sources import feed as FD
from chronolake.sources.store import LayerStore

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("raw_path", T.StringType()),
        T.StructField("as_of", T.StringType()),
        T.StructField("station_ids", T.ArrayType(T.StringType())),
    ]
)


def landed_dir(root: str, source_name: str) -> str:
    return f"{root.rstrip('/')}/landed/source={source_name}"


def announce_pull(
    spark: SparkSession, root: str, raw_path: str, as_of: str, source_name: str, station_ids: list[str] | None = None
) -> None:
    """Says that the pull under ``raw_path`` is complete. For landers that write the rows themselves."""
    row = spark.createDataFrame([(raw_path, as_of, list(station_ids or []))], LANDED_SCHEMA)
    row.coalesce(1).write.mode("append").json(landed_dir(root, source_name))


def land_pull(
    spark: SparkSession, root: str, raw: DataFrame, as_of: str, source_name: str, station_ids: list[str] | None = None
) -> str:
    """Upstream side: land one pull (SNK1) and announce it."""
    path, _ = LayerStore(spark, root).write_raw(raw, source_name, as_of)
    announce_pull(spark, root, path, as_of, source_name, station_ids)
    return path


def publish_batch(spark: SparkSession, root: str, source_name: str, batch: DataFrame, batch_id: int) -> list[dict]:
    """foreachBatch body: one snapshot per announced pull, oldest first."""
    pulls = sorted(batch.collect(), key=lambda r: (r.as_of, r.raw_path))  # announcements, not rows
    paths = [p.raw_path for p in pulls]
    known = CAT.read_catalog(spark, root).where(F.col("raw_path").isin(paths)).select("raw_path").collect()
    published = {r.raw_path for r in known}
    entries = []
    for pull in pulls:
        if pull.raw_path in published:
            continue  # a replayed batch: this pull is a snapshot already
        _, entry = build_snapshot(
            spark,
            spark.read.schema(S.RAW_SCHEMA).parquet(pull.raw_path),
            root,
            pull.as_of,
            source_name=source_name,
            station_ids=pull.station_ids,
            batch_id=batch_id,
            landed_path=pull.raw_path,
        )
        if entry is not None:
            entries.append(entry)
    return entries


def start_ingest(
    spark: SparkSession,
    root: str,
    source_name: str = S.DEFAULT_SOURCE_NAME,
    available_now: bool = True,
    processing_time: str | None = None,
    max_pulls_per_trigger: int | None = None,
):
    """Start the stream; ``available_now`` drains what has been announced and stops."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_pulls_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_pulls_per_trigger)
    stream = reader.json(landed_dir(root, source_name))
    writer = stream.writeStream.foreachBatch(
        lambda df, batch_id: publish_batch(spark, root, source_name, df, batch_id)
    ).option("checkpointLocation", f"{root.rstrip('/')}/_checkpoints/ingest-{source_name}")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def publish_documents(spark: SparkSession, root: str, source_name: str, batch: DataFrame, batch_id: int, now: str) -> Refresh:
    """foreachBatch body: the documents of one trigger become one snapshot.

    Documents that the ledger calls settled (a replayed batch, or one that the scheduled job took)
    are left out before anything is parsed.
    """
    settled = CAT.settled_files(spark, root).select(F.col("file").alias("_file"))
    fresh = batch.join(settled, "_file", "left_anti")
    files = fresh.select(F.col("_file").alias("file"), F.lit(None).cast("long").alias("rows"))
    raw = FD.observations_of(fresh, now)
    return refresh_snapshot(spark, root, raw, now, source_name, files=files, run=f"{source_name}-{batch_id}-{uuid.uuid4().hex[:8]}", batch_id=batch_id)


def stream_documents(
    spark: SparkSession,
    root: str,
    landing_path: str,
    now: Callable[[], str],
    source_name: str = S.DEFAULT_SOURCE_NAME,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """SRC1 as a stream: documents under ``station=<id>/`` are read as they land, whole, and parsed in tasks.

    Which files are new is the file source's own log, kept in the stream's checkpoint: no list of paths is made
    in the job, and a document is read once. A trigger takes all that has landed, or ``max_files_per_trigger``;
    ``now`` gives the time of a trigger's snapshot. Without ``processing_time`` the stream drains what has landed
    and stops. Documents must be moved into place whole, since a file is taken once.
    """
    schema = f"value string, {FD.STATION_PARTITION} string"
    reader = spark.readStream.schema(schema).option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = FD.named(reader.text(landing_path))
    writer = docs.writeStream.foreachBatch(
        lambda df, batch_id: publish_documents(spark, root, source_name, df, batch_id, now())
    ).option("checkpointLocation", f"{root.rstrip('/')}/_checkpoints/documents-{source_name}")
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def main(argv: list[str] | None = None) -> None:
    """``python -m chronolake.streaming.ingest --root <store> [--every '1 hour']``."""
    import argparse

    from chronolake.session import get_session

    parser = argparse.ArgumentParser(description="Publish landed pulls as snapshots, as a stream.")
    parser.add_argument("--root", required=True, help="store root (shared file system path)")
    parser.add_argument("--source", default=S.DEFAULT_SOURCE_NAME, help="source name of the landed pulls")
    parser.add_argument("--every", default=None, help="processing-time trigger; default: drain what has landed and stop")
    args = parser.parse_args(argv)
    spark = get_session("chronolake-ingest")
    query = start_ingest(spark, args.root, args.source, available_now=args.every is None, processing_time=args.every)
    query.awaitTermination()


if __name__ == "__main__":
    main()
