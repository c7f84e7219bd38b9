"""Gold of every snapshot in one pass, and a rebuild of the derived layers.

Silver flags and gold are frozen when a refresh writes them. ``rebuild`` recomputes both
for every published snapshot from the bronze log (e.g. after changing an anomaly
threshold), one job per layer:

* silver: the flags of every kept log row, written partitioned by ``seq``
* gold: one aggregate of the log by (seq, day, station, name); running sums over ``seq``
  per gold group (a window whose partition is one gold group: at most one row per
  snapshot); each row then stands for every snapshot up to the group's next row
  (``explode(sequence(seq, next - 1))``); the two-key new-record count of each (seq, day,
  station) is a window sum over the names of that station and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.functions import columns as C
from chronolake.operators import layers as L
from chronolake.sources import catalog as CAT
from chronolake.sources import store as ST
from chronolake.sources.store import LayerStore

_ADDITIVE = ["rows_processed", "anomaly_count", *[c for c in S.GOLD_STATE_SCHEMA.fieldNames() if c.startswith(S.ADDED)]]
#: Snapshots up to which their times are broadcast.
BROADCAST_SNAPSHOTS = 100_000
_COUNTS = ("rows_processed", "anomaly_count", "n_temperature_c", "n_wind_speed_kmh", "n_pressure_pa")


def gold_history(
    log: DataFrame,
    last_seq: int,
    stamps: DataFrame | None = None,
    keep_state: bool = False,
    changes_only: bool = False,
    **thresholds: float,
) -> DataFrame:
    """Gold rows of every snapshot ``1..last_seq``, with a ``seq`` column.

    ``changes_only``: as a refresh writes them, the groups of the days and stations that a snapshot
    added to, and all groups of the snapshots that hold all (``store.gold_base``).

    ``stamps`` holds (seq, updated_at) per snapshot -- the catalog's creation times;
    without it, each snapshot's ingest time in the log is used.
    """
    kept = F.col("is_first")

    def when_kept(c):
        return F.when(kept, c)

    def measure(name: str) -> list:
        return [F.sum(when_kept(C.exact_part(name))).alias(f"sum_{name}"),
                F.sum(when_kept(C.far_part(name))).alias(f"far_{name}"),
                F.count(when_kept(F.col(name))).alias(f"n_{name}")]

    per_seq = log.where(F.col("seq") <= last_seq).groupBy(
        "seq", C.date_key("timestamp").alias("partition_date"), "station_id", "station_name"
    ).agg(
        F.count(when_kept(F.col(L.KEY))).alias("rows_processed"),
        F.sum(when_kept(C.anomaly_flag(**thresholds).cast("long"))).alias("anomaly_count"),
        *measure("temperature_c"),
        *measure("wind_speed_kmh"),
        F.max(when_kept(F.col("wind_gust_kmh"))).alias("max_wind_gust_kmh"),
        *measure("pressure_pa"),
        F.min(when_kept(F.col("timestamp"))).alias("first_seen"),
        F.max(when_kept(F.col("timestamp"))).alias("last_seen"),
        F.sum(F.col("copies")).alias("_fresh"),
        F.max("ingest_ts").alias("_stamp"),
    )
    group = S.GOLD_KEYS
    # Running state per gold group over its own snapshots, then each row stands for every
    # snapshot until the group's next row. What the group's row adds in its own snapshot
    # (``_fresh``) is 0 in the later ones it stands for.
    ordered = Window.partitionBy(*group).orderBy("seq")
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = per_seq.select(
        F.col("seq").alias("_own"),
        *group,
        *[(F.coalesce(F.sum(c).over(upto), F.lit(0)) if c in _COUNTS else F.sum(c).over(upto).cast(S.GOLD_STATE_SCHEMA[c].dataType)).alias(c)
          for c in _ADDITIVE],
        F.max("max_wind_gust_kmh").over(upto).alias("max_wind_gust_kmh"),
        F.min("first_seen").over(upto).alias("first_seen"),
        F.max("last_seen").over(upto).alias("last_seen"),
        "_fresh",
        F.max("_stamp").over(upto).alias("_stamp"),
        F.lead("seq").over(ordered).alias("_next"),
    )
    until = F.coalesce(F.col("_next") - 1, F.lit(last_seq))
    every = running.withColumn("seq", F.explode(F.sequence(F.col("_own"), until)))
    fresh = F.when((F.col("seq") == F.col("_own")) & F.col("station_id").isNotNull(), F.col("_fresh")).otherwise(0)
    of_day = Window.partitionBy("seq", "partition_date", "station_id")
    state = every.withColumn("new_records", F.sum(fresh).over(of_day).cast("long")).where(
        F.col("rows_processed") > 0  # before its first kept row a group is not in gold
    )
    if changes_only:
        touched = F.max((F.col("seq") == F.col("_own")).cast("int")).over(of_day) == 1
        state = state.withColumn("_touched", touched).where(F.col("_touched") | ((F.col("seq") - 1) % ST.FULL_EVERY == 0))
    if stamps is None:
        by_seq = per_seq.groupBy("seq").agg(F.max("_stamp").alias("updated_at"))
    else:
        by_seq = stamps.select("seq", "updated_at")
    # One row for each snapshot: broadcast up to a counted bound, shuffled beyond it.
    if by_seq.count() <= BROADCAST_SNAPSHOTS:
        by_seq = F.broadcast(by_seq)
    state = state.join(by_seq, "seq", "left")
    return L.finish_gold(state, F.col("updated_at"), keep_state, keep=("seq",))


def rebuild(spark: SparkSession, root: str, **thresholds: float) -> int:
    """Recompute silver and gold of every published snapshot from the bronze log.

    Returns the number of snapshots rebuilt. The new layers go to the folders of the next
    version; its row in ``_rules`` is written last and switches readers and later refreshes
    to them, thresholds included. A rebuild that dies before that changes nothing.
    """
    store = LayerStore(spark, root)
    catalog = CAT.read_catalog(spark, root)
    latest = CAT.latest_entry(catalog)
    if latest is None:
        return 0
    last = latest["seq"]
    log = store.log().where(F.col("seq") <= last)
    silver = L.to_silver(log.where(F.col("is_first")), keep=("seq",), **thresholds)
    stamps = catalog.select("seq", F.col("created_at").alias("updated_at"))
    gold = gold_history(log, last, stamps, keep_state=True, changes_only=True, **thresholds)
    store.version += 1
    for table, df in (("silver_log", silver), ("gold", gold)):
        # A snapshot's rows of one day meet, so files stay few and days clustered; what is more than
        # the advisory size is spread over tasks by its measured size once it is shuffled.
        spread = df.hint("rebalance", "seq", "partition_date")
        spread.sortWithinPartitions("seq", "partition_date").write.mode("overwrite").partitionBy("seq").parquet(store.path(table))
    CAT.publish_rules(spark, root, store.version, thresholds)
    return last
