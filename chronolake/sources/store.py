"""Append-only layer store on plain Parquet (SNK1, SNK2, SRC13).

Layout under ``root`` (any Hadoop file system path)::

    raw/source=<name>/pull_ts=<yyyyMMddTHHmmssZ>-<id>/   landed pull, never merged or replaced
    bronze_log/seq=<n>/                             rows first seen in snapshot n
    silver_log/seq=<n>/                             their silver flags
    gold/seq=<n>/                                   gold groups that snapshot n changed, with additive
                                                    state; every FULL_EVERY snapshots all groups
    _catalog/seq=<n>/                               catalog entry (written last = commit)
    _rules/version=<v>/                             thresholds; which silver_log / gold counts
    id_index/gen=<g>/seq=<n>/                       ids first published in snapshot n, bucketed
    <log>_c<k>/                                     a span of a log's snapshots in few files
    _layout/version=<v>/                            the spans in force (plans/compact.py)
    _ledger/run=<r>/                                what came of each landed document

Each writer overwrites only its own ``seq`` folder, so a retried refresh is idempotent;
readers only trust catalogued ``seq`` values, so a half-written snapshot is invisible.
Single writer assumed: plain Parquet has no compare-and-swap.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake import schemas as S
from chronolake.sources.catalog import current_rules, current_spans, find_seq, read_catalog
from chronolake.sources.id_index import IdIndex
from chronolake.sources.reading import or_empty

SEQ = T.StructField("seq", T.IntegerType())
LOG_SCHEMA = T.StructType(S.BRONZE_SCHEMA.fields + S.LOG_EXTRA.fields + [SEQ])
SILVER_LOG_SCHEMA = T.StructType(S.SILVER_SCHEMA.fields + [SEQ])
_STATE_ONLY = [f for f in S.GOLD_STATE_SCHEMA.fields if f.name not in S.GOLD_COLUMNS]
GOLD_STORE_SCHEMA = T.StructType(S.GOLD_SCHEMA.fields + _STATE_ONLY + [SEQ])

#: Fixed by the layout: snapshots 1, 1 + FULL_EVERY, ... hold all gold groups, the others those they changed.
FULL_EVERY = 16


def gold_base(seq: int) -> int:
    """The latest snapshot up to ``seq`` that holds all gold groups."""
    return seq - (seq - 1) % FULL_EVERY


def pull_stamp(as_of: str) -> str:
    """The instant in UTC, whatever the offset it is given in (none: UTC)."""
    at = datetime.fromisoformat(as_of)
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
    return at.strftime("%Y%m%dT%H%M%SZ")


class LayerStore:
    def __init__(self, spark: SparkSession, root: str, id_buckets: int | None = None):
        """``id_buckets``: buckets of the id index from the next snapshot on (default: by the number of ids)."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.version, self.thresholds = current_rules(spark, self.root)
        self.ids = IdIndex(spark, self.root, id_buckets)
        self.spans = current_spans(spark, self.root)

    # -- paths ---------------------------------------------------------------------
    def path(self, table: str, seq: int | None = None) -> str:
        suffix = f"_v{self.version}" if self.version and table in ("silver_log", "gold") else ""
        base = f"{self.root}/{table}{suffix}"
        return base if seq is None else f"{base}/seq={seq}"

    # -- writes --------------------------------------------------------------------
    def write_raw(self, raw: DataFrame, source_name: str, as_of: str) -> tuple[str, int]:
        """SNK1: land the pull as parsed (raw schema), never merged; its folder and row count.

        Every pull has a folder of its own, so pulls of one second never replace each other.
        """
        path = f"{self.root}/raw/source={source_name}/pull_ts={pull_stamp(as_of)}-{uuid.uuid4().hex[:8]}"
        seen = Observation(f"landed-{uuid.uuid4().hex[:8]}")
        raw.select(*S.RAW_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return path, seen.get["rows"]

    def _write_seq(self, table: str, seq: int, df: DataFrame, schema: T.StructType) -> str:
        cols = [f.name for f in schema.fields if f.name != "seq"]
        path = self.path(table, seq)
        # Rows of one snapshot clustered by day (then time, where there is one): row-group
        # min/max stats then skip whole groups for date / time predicates, without a
        # second partition level and without a global sort.
        order = [c for c in ("partition_date", "timestamp") if c in cols]
        df.select(*cols).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
        return path

    def write_log(self, seq: int, rows: DataFrame) -> str:
        return self._write_seq("bronze_log", seq, rows, LOG_SCHEMA)

    def write_silver(self, seq: int, rows: DataFrame) -> str:
        return self._write_seq("silver_log", seq, rows, SILVER_LOG_SCHEMA)

    def write_gold(self, seq: int, rows: DataFrame) -> str:
        return self._write_seq("gold", seq, rows, GOLD_STORE_SCHEMA)

    # -- reads ---------------------------------------------------------------------
    def table(self, table: str, schema: T.StructType) -> DataFrame:
        """The table's spans that compaction made, and the folders of the snapshots after them."""
        base = self.path(table)
        spans = [s for s in self.spans if s["name"] == base.rsplit("/", 1)[1]]
        own = or_empty(self.spark, schema, lambda: self.spark.read.schema(schema).parquet(base))
        for span in spans:
            own = own.where(F.col("seq") > span["last"])
        for span in spans:
            own = own.unionByName(self.spark.read.schema(schema).parquet(f"{self.root}/{span['folder']}"))
        return own

    def log(self) -> DataFrame:
        return self.table("bronze_log", LOG_SCHEMA)

    def silver_log(self) -> DataFrame:
        return self.table("silver_log", SILVER_LOG_SCHEMA)

    def gold_store(self) -> DataFrame:
        return self.table("gold", GOLD_STORE_SCHEMA)

    def history_ids(self, seq: int, from_date: str | None = None) -> list[DataFrame]:
        """Ids of ``bronze(T_seq)``, one column read: a frame for each generation of the id index, else the log's.

        ``from_date`` reads the log without the history days before it (row groups are clustered by
        ``partition_date``, so Parquet min/max statistics drop them unread). Only valid
        when an id always carries the same observation time.
        """
        indexed = self.ids.history(seq) if from_date is None else None
        if indexed:
            return indexed
        # Every id has exactly one ``is_first`` row, so this reads each id once (first-
        # snapshot copies of a hot id do not reach the join).
        log = self.log().where((F.col("seq") <= seq) & F.col("is_first"))
        if from_date is not None:
            log = log.where(F.col("partition_date") >= F.lit(from_date))
        return [log.select("source_record_id")]

    def bronze(self, seq: int) -> DataFrame:
        from chronolake.plans.timetravel import bronze_as_of

        return bronze_as_of(self.log().where(F.col("seq") <= seq), seq)

    def silver(self, seq: int) -> DataFrame:
        return self.silver_log().where(F.col("seq") <= seq).select(*S.SILVER_COLUMNS)

    def _latest_gold(self, seq: int) -> DataFrame:
        """Each group's row as snapshot ``seq`` has it: the latest since the last snapshot that holds all groups."""
        base = gold_base(seq)
        rows = self.gold_store().where(F.col("seq").between(base, seq))
        if base == seq:
            return rows
        others = [c for c in rows.columns if c not in S.GOLD_KEYS]
        latest = rows.groupBy(*S.GOLD_KEYS).agg(F.max_by(F.struct(*others), "seq").alias("g"))
        return latest.select(*S.GOLD_KEYS, "g.*").select(*rows.columns)

    def gold(self, seq: int, updated_at: str | None = None) -> DataFrame:
        """Gold of snapshot ``seq``; a group that it did not change has no new records in it.

        ``updated_at``: the snapshot's time (default: read from its catalog row).
        """
        rows = self._latest_gold(seq)
        if gold_base(seq) != seq:
            if updated_at is None:
                entry = find_seq(read_catalog(self.spark, self.root), seq)
                updated_at = entry["created_at"] if entry else None
            fresh = F.when(F.col("seq") == seq, F.col("new_records")).otherwise(0)
            rows = rows.withColumns({"new_records": fresh.cast("long"), "updated_at": F.lit(updated_at).cast("string")})
        return rows.select(*S.GOLD_COLUMNS)

    def gold_state(self, seq: int) -> DataFrame:
        return self._latest_gold(seq).select(*S.GOLD_STATE_SCHEMA.fieldNames())

    def layer(self, layer: str, seq: int) -> DataFrame:
        if layer == "gold":
            return self.gold(seq)
        if layer == "silver":
            return self.silver(seq)
        return self.bronze(seq)
