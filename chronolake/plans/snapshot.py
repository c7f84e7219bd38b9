"""Snapshot build (SNP1) and its metrics (SNP8).

A refresh costs O(increment + gold read) plus one id-only scan of history:

1. land the pull (SNK1) and read it back (lineage cut at a shared, durable table)
2. bronze-enrich; drop ids already in history (JOIN3); keep-first per id (DED1)
3. append ``bronze_log/seq=n`` (row counts observed on that write; nothing new ->
   NO_CHANGE, nothing committed), then ``silver_log/seq=n`` (flags of the new rows only)
4. gold state of the new silver rows merged with the previous snapshot's state (GRP1) of the
   days and stations it touches, new-record counts joined on (date, station) (GRP2 + JOIN1)
   -> ``gold/seq=n``: the changed groups, and all of them every FULL_EVERY snapshots
5. metrics from the increment and the small gold table, then the catalog row (commit)

The reference recomputes silver and gold over all history on every refresh; here only
the increment is touched, with identical results (silver rows never change once logged
and gold is additive).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.functions import columns as C
from chronolake.operators import layers as L
from chronolake.operators.dedupe import flag_first_distinct, keep_first
from chronolake.sources import catalog as CAT
from chronolake.sources.store import LayerStore, gold_base


def build_snapshot(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    as_of: str,
    source_name: str = S.DEFAULT_SOURCE_NAME,
    station_ids: list[str] | None = None,
    batch_id: int | None = None,
    landed_path: str | None = None,
    stable_dates: bool = False,
    previous: dict | None = None,
    previous_known: bool = False,
    id_buckets: int | None = None,
    files: DataFrame | None = None,
    run: str | None = None,
) -> tuple[str, dict | None]:
    """SNP1: publish the next snapshot from one pull; the outcome and its catalog entry.

    ``SKIPPED``: the pull has no rows, by the count of landing it. ``NO_CHANGE`` (JOIN4): a
    previous snapshot exists and the pull brings no new id; the anti-join to history runs
    once and its emptiness is read from the write's own metrics, so history is scanned once
    per refresh. Neither commits anything. ``CREATED`` otherwise.

    ``landed_path``: the pull is already in the raw landing folder (stream ingestion),
    so it is read from there instead of being landed again. ``stable_dates``: ids never
    change their observation time, so history before the pull's first day is skipped.
    ``previous`` / ``previous_known``: the caller already read the latest catalog entry.
    ``id_buckets``: buckets of the id index, which lets large increments anti-join history
    without shuffling it, from this snapshot on (default: by the number of ids). ``files``
    (file, rows): the landed documents of the pull and the rows that they hold (null: those
    of ``raw``); the ledger then says, whatever the outcome, what ``run`` took from each.
    """
    started = time.perf_counter()
    store = LayerStore(spark, root, id_buckets)
    if not previous_known:
        previous = CAT.latest_entry(CAT.read_catalog(spark, root))
    prev_seq = previous["seq"] if previous else 0
    seq = prev_seq + 1
    if prev_seq and previous["row_counts"]["bronze"] and store.log().where(F.col("seq") <= prev_seq).isEmpty():
        # Published snapshots exist but their log is gone: refuse to start history afresh.
        raise RuntimeError(f"bronze log of {previous['snapshot_id']} is missing under {root}")
    if landed_path:
        raw_path, landed = landed_path, raw
        rows = landed.count()  # from the file footers
    else:
        raw_path, rows = store.write_raw(raw, source_name, as_of)
        landed = spark.read.schema(S.RAW_SCHEMA).parquet(raw_path)

    def settle(outcome: str, at: int | None = None) -> None:
        if files is not None:
            taken = landed.groupBy(F.col("source_url").alias("file")).agg(F.count("*").alias("taken"))
            CAT.record_run(spark, root, run or uuid.uuid4().hex, files.join(taken, "file", "left"), outcome, at)

    if rows == 0:
        settle("SKIPPED")
        return "SKIPPED", None
    batch = L.to_bronze(landed, source_name, as_of)

    if prev_seq == 0:
        log_rows = flag_first_distinct(batch, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
    else:
        from_date = None
        if stable_dates:
            from_date = batch.agg(F.min("partition_date")).first()[0]  # one scalar
        # Both depend on the id alone, so their order is free: keep-first goes first, which
        # leaves one row for each id and hence no hot key in the anti-join.
        one_each = keep_first(batch, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
        log_rows = L.unseen(one_each, store.history_ids(prev_seq, from_date), rows).select(
            "*", F.lit(True).alias("is_first"), F.lit(1).cast("long").alias("copies")
        )
    # Row counts ride along with the write (one pass over the increment).
    written = Observation(f"increment-{seq}-{uuid.uuid4().hex[:8]}")  # unique per call
    log_rows = log_rows.observe(
        written,
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("rows"),
        F.count_if(F.col("is_first")).alias("kept"),
    )
    paths = {"bronze": store.write_log(seq, log_rows)}
    inc = written.get
    if prev_seq > 0 and inc["rows"] == 0:
        settle("NO_CHANGE")
        return "NO_CHANGE", None  # the seq folder stays uncatalogued (invisible)
    increment = store.log().where(F.col("seq") == seq)
    known = previous["row_counts"]["silver"] if previous else 0
    store.ids.write(seq, increment.where(F.col("is_first")), inc["kept"], known)

    paths["silver"] = store.write_silver(seq, L.to_silver(increment.where(F.col("is_first")), **store.thresholds))
    state = L.gold_state(store.silver_log().where(F.col("seq") == seq))
    # Per (day, station) counts of the increment, null stations included: small, and
    # it also gives the increment's distinct days without another pass.
    fresh = (
        increment.groupBy(C.date_key("timestamp").alias("partition_date"), "station_id")
        .agg(F.sum("copies").cast("long").alias("new_records"))
        .cache()
    )
    if prev_seq > 0:
        before = store.gold_state(prev_seq)
        if gold_base(seq) != seq:  # only the days and stations that the increment touches are written
            touched = fresh.select(F.col("partition_date").alias("_date"), F.col("station_id").alias("_station"))
            same = F.col("partition_date").eqNullSafe(F.col("_date")) & F.col("station_id").eqNullSafe(F.col("_station"))
            before = before.join(touched, same, "left_semi")
        state = L.merge_gold_state(before, state)
    new_counts = fresh.where(F.col("station_id").isNotNull())
    paths["gold"] = store.write_gold(seq, L.gold_from_state(state, new_counts, as_of, keep_state=True))
    inc_dates = fresh.select("partition_date").distinct().count()
    fresh.unpersist()
    gold_row = store.gold(seq, as_of).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("partition_date").alias("dates")
    ).first()

    if prev_seq == 0:
        full_rows, full_dates = inc["rows"], inc_dates
        silver_rows = inc["kept"]
        incremental_rows, incremental_dates = full_rows, full_dates
    else:
        silver_rows = previous["row_counts"]["silver"] + inc["kept"]
        full_rows, full_dates = silver_rows, gold_row["dates"]
        incremental_rows, incremental_dates = inc["rows"], inc_dates
    saved = max(0.0, (1 - incremental_rows / full_rows) * 100) if full_rows else 0.0

    entry = {
        "seq": seq,
        "snapshot_id": f"T{seq}",
        "created_at": as_of,
        "source_name": source_name,
        "station_ids": list(station_ids or []),
        "raw_path": raw_path,
        "paths": paths,
        "row_counts": {"bronze": full_rows, "silver": silver_rows, "gold": gold_row["rows"]},
        "metrics": {
            "rows_processed": incremental_rows,
            "partitions_scanned_incremental": incremental_dates,
            "partitions_scanned_full": full_dates,
            "full_scan_rows": full_rows,
            "incremental_scan_rows": incremental_rows,
            "processing_time_ms": round((time.perf_counter() - started) * 1000, 2),
            "time_saved_pct": round(saved, 2),
        },
        "batch_id": batch_id,
    }
    settle("CREATED", seq)
    CAT.append_entry(spark, root, entry)
    return "CREATED", entry
