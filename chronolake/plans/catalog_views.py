"""Catalog views: snapshot list, default pair, due test, metric tables (SNP2-3, SNP5-6, SNP9-10).

All are DataFrame -> DataFrame over the catalog (one row per snapshot, so windows without
a partition key here sort a handful of rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.functions import columns as C


def snapshot_list(catalog: DataFrame) -> DataFrame:
    """SNP2-3: snapshots in creation order with labels, latest flag and the next id."""
    latest = F.max("seq").over(Window.partitionBy())
    return catalog.select(
        "seq",
        "snapshot_id",
        "created_at",
        C.snapshot_label("snapshot_id", "created_at").alias("label"),
        (F.col("seq") == latest).alias("is_latest"),
        C.snapshot_id_of(latest + 1).alias("next_snapshot_id"),
    )


def default_pair(catalog: DataFrame) -> DataFrame:
    """SNP5: previous = second newest (itself if only one), current = latest."""
    ranked = catalog.select(
        "snapshot_id", F.row_number().over(Window.orderBy(F.col("seq").desc())).alias("r")
    ).where(F.col("r") <= 2)
    return ranked.agg(
        F.max_by("snapshot_id", -F.col("r")).alias("current_snapshot_id"),
        F.max_by("snapshot_id", F.col("r")).alias("previous_snapshot_id"),
    ).where(F.col("current_snapshot_id").isNotNull())


def due_after_each(catalog: DataFrame, max_age_minutes: int = S.AUTO_REFRESH_MINUTES) -> DataFrame:
    """SNP6 replayed: for each snapshot, is a refresh due when the next one was taken?"""
    nxt = F.lead("created_at").over(Window.orderBy("seq"))
    rows = catalog.select("seq", "snapshot_id", "created_at", nxt.alias("checked_at")).where(
        F.col("checked_at").isNotNull()
    )
    age = F.unix_timestamp(C.utc_wall_clock("checked_at")) - F.unix_timestamp(C.utc_wall_clock("created_at"))
    return rows.select(
        "snapshot_id",
        "checked_at",
        age.alias("age_seconds"),
        (age >= F.lit(max_age_minutes * 60)).alias("due"),
        (age >= F.lit(0)).alias("due_forced"),
    )


def scan_comparison(catalog: DataFrame) -> DataFrame:
    """SNP9: full vs incremental scan rows per snapshot, as (mode, rows) pairs."""
    return catalog.select(
        "snapshot_id",
        F.expr(
            "stack(2, 'Full scan', metrics.full_scan_rows, 'Incremental', metrics.incremental_scan_rows)"
        ).alias("mode", "rows"),
    )


def layer_counts(catalog: DataFrame) -> DataFrame:
    """SNP10: row count of every layer of every snapshot."""
    return catalog.select(
        "snapshot_id",
        F.expr(
            "stack(3, 'bronze', row_counts.bronze, 'silver', row_counts.silver, 'gold', row_counts.gold)"
        ).alias("layer", "row_count"),
    )


def metrics_table(catalog: DataFrame) -> DataFrame:
    """SNP8 as a table: the recorded refresh metrics of every snapshot."""
    return catalog.select("seq", "snapshot_id", "metrics.*")
