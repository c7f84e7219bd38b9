"""Snapshot comparison operators behind the canned queries (Q1-Q4) and custom SQL (SQL1)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S


def new_records(current: DataFrame, previous: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """SET1: ``current EXCEPT previous`` -- distinct, nulls compare equal, all columns.

    ``ignore`` drops columns before comparing (gold's ``updated_at`` is restamped on
    every refresh, so with it every gold row is "new").
    """
    cols = [c for c in current.columns if c not in ignore]
    return current.select(*cols).subtract(previous.select(*cols))


def compare_gold(current: DataFrame, previous: DataFrame) -> DataFrame:
    """JOIN2: full outer join of two gold snapshots on (date, station), zero-filled delta.

    ``=`` never matches null keys, so a null-station row shows once per side.
    """
    c = current.select("partition_date", "station_id", F.col("rows_processed").alias("c_rows"))
    p = previous.select(
        F.col("partition_date").alias("p_date"),
        F.col("station_id").alias("p_station"),
        F.col("rows_processed").alias("p_rows"),
    )
    cond = (c["partition_date"] == p["p_date"]) & (c["station_id"] == p["p_station"])
    cur = F.coalesce(F.col("c_rows"), F.lit(0).cast("long"))
    prev = F.coalesce(F.col("p_rows"), F.lit(0).cast("long"))
    return c.join(p, cond, "full").select(
        F.coalesce(F.col("partition_date"), F.col("p_date")).alias("partition_date"),
        F.coalesce(F.col("station_id"), F.col("p_station")).alias("station_id"),
        cur.alias("current_rows"),
        prev.alias("previous_rows"),
        (cur - prev).alias("delta_rows"),
    )


def partition_counts(current: DataFrame, date_column: str) -> DataFrame:
    """GRP3/GRP4: current rows per (station, date key)."""
    return current.groupBy("station_id", F.col(date_column).alias("partition_key")).agg(
        F.count(F.lit(1)).alias("current_rows")
    )


def aggregate_by_partition(current: DataFrame, layer: str) -> DataFrame:
    """GRP5-7: rows per date key (gold: sum of ``rows_processed``)."""
    if layer == "gold":
        return current.groupBy(F.col("partition_date").alias("partition_key")).agg(
            F.sum("rows_processed").alias("row_count")
        )
    date_column = "observation_date" if layer == "silver" else "partition_date"
    return current.groupBy(F.col(date_column).alias("partition_key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def counts_from_gold(gold: DataFrame, by_station: bool) -> DataFrame:
    """GRP3/GRP6 answered from gold: silver row counts are gold's ``rows_processed``.

    Gold rows are (day, station, name) groups of silver, so summing ``rows_processed``
    over names (Q3) or over stations too (Q4) gives the silver counts from a table of
    days x stations rows instead of a scan of every silver row. Also exact for bronze of
    snapshots after the first, whose rows are the silver rows.
    """
    keys = ["station_id"] if by_station else []
    name = "current_rows" if by_station else "row_count"
    return gold.groupBy(*keys, F.col("partition_date").alias("partition_key")).agg(
        F.sum("rows_processed").cast("long").alias(name)
    )


def top_rows(df: DataFrame, order: list, limit: int | None) -> DataFrame:
    """TOP1/TOP2: ordered limit (``TakeOrderedAndProject``: per-partition top-k, then merge).

    ``order`` should end with enough keys to make the cut deterministic. Without a
    ``limit`` the whole result is returned unsorted: a global sort of an unbounded
    result is left to whoever displays it.
    """
    return df.orderBy(*order).limit(limit) if limit is not None else df


def full_order(df: DataFrame, leading: list[str]) -> list:
    """``leading`` keys (``"col"`` or ``"col desc"``), then every other column ascending.

    Nulls sort last in both directions.
    """
    keys, used = [], set()
    for spec in leading:
        name, _, direction = spec.partition(" ")
        c = F.col(name)
        keys.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
        used.add(name)
    keys += [F.col(c).asc_nulls_last() for c in df.columns if c not in used]
    return keys


_TRAILING_SEMI = re.compile(r";\s*$")


def custom_sql(
    spark: SparkSession,
    current: DataFrame,
    previous: DataFrame,
    sql_text: str,
) -> DataFrame:
    """SQL1: user SQL over ``current_data`` / ``previous_data`` (trusted input only).

    Both frames are registered under per-call unique view names and bound through a
    ``WITH`` prefix, so concurrent calls never clash; analysis is eager, so the views are
    dropped before returning.
    """
    text = _TRAILING_SEMI.sub("", sql_text.strip()) or S.DEFAULT_CUSTOM_SQL
    tag = uuid.uuid4().hex[:12]
    cur_view, prev_view = f"current_data_{tag}", f"previous_data_{tag}"
    current.createOrReplaceTempView(cur_view)
    previous.createOrReplaceTempView(prev_view)
    try:
        wrapped = (
            f"WITH current_data AS (SELECT * FROM {cur_view}), "
            f"previous_data AS (SELECT * FROM {prev_view}) ({text})"
        )
        return spark.sql(wrapped)
    finally:
        spark.catalog.dropTempView(cur_view)
        spark.catalog.dropTempView(prev_view)
