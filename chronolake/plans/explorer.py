"""Read-side API over a published store: time travel and comparison (SNP4, SNP5, Q1-Q4).

    ex = Explorer(spark, root)
    prev, cur = ex.default_pair()                  # ("T2", "T3")
    ex.as_of("gold", "T2")                         # layer as of a snapshot
    ex.query("silver", "Show only new records")    # canned query on the default pair

Snapshot ids resolve through the catalog, so only committed snapshots are visible; an
unknown id reads as a typed empty frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators import compare as CMP
from chronolake.plans import catalog_views as CV
from chronolake.plans import query_panel as QP
from chronolake.plans.timetravel import empty_layer, increment_of, new_rows_from_log
from chronolake.sources import catalog as CAT
from chronolake.sources.store import LayerStore


class Explorer:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.store = LayerStore(spark, root)

    def catalog(self) -> DataFrame:
        return CAT.read_catalog(self.spark, self.root)

    def latest(self) -> dict | None:
        return CAT.latest_entry(self.catalog())

    def seq_of(self, snapshot_id: str) -> int | None:
        entry = CAT.find_entry(self.catalog(), snapshot_id)
        return entry["seq"] if entry else None

    def snapshots(self) -> DataFrame:
        return CV.snapshot_list(self.catalog())

    def metrics(self) -> DataFrame:
        """SNP8: the recorded refresh metrics of every snapshot."""
        return CV.metrics_table(self.catalog())

    def scan_comparison(self) -> DataFrame:
        """SNP9: full vs incremental scan rows per snapshot."""
        return CV.scan_comparison(self.catalog())

    def layer_counts(self) -> DataFrame:
        """SNP10: rows per layer per snapshot."""
        return CV.layer_counts(self.catalog())

    def default_pair(self) -> tuple[str, str] | None:
        rows = CV.default_pair(self.catalog()).collect()  # one row
        return (rows[0]["previous_snapshot_id"], rows[0]["current_snapshot_id"]) if rows else None

    def as_of(self, layer: str, snapshot_id: str) -> DataFrame:
        """SNP4: the layer exactly as it was published in ``snapshot_id``."""
        seq = self.seq_of(snapshot_id)
        if seq is None:
            return empty_layer(self.spark, layer)
        return self.store.layer(layer, seq)

    def increment(self, snapshot_id: str) -> DataFrame:
        """Rows the refresh of ``snapshot_id`` added to bronze (its in-pull duplicates too,
        for the first snapshot) -- what the refresh metrics count."""
        seq = self.seq_of(snapshot_id)
        if seq is None:
            return empty_layer(self.spark, "bronze")
        return increment_of(self.store.log().where(F.col("seq") == seq), seq)

    def new_records(
        self, layer: str, previous_id: str, current_id: str, ignore: tuple[str, ...] = ()
    ) -> DataFrame:
        """Q1 without the cap. Bronze/silver: a log scan of the seqs in between."""
        p, c = self.seq_of(previous_id), self.seq_of(current_id)
        if layer in ("bronze", "silver") and p is not None and c is not None and not ignore:
            if layer == "bronze":
                log = self.store.log().where(F.col("seq") <= c)
                return new_rows_from_log(log, p, c, S.BRONZE_COLUMNS)
            if c <= 1 or p >= c:
                return empty_layer(self.spark, layer)
            rows = self.store.silver_log().where((F.col("seq") > p) & (F.col("seq") <= c))
            return rows.select(*S.SILVER_COLUMNS)
        return QP.show_new_records(
            self.as_of(layer, current_id), self.as_of(layer, previous_id), limit=None, ignore=ignore
        )

    def query(
        self,
        layer: str,
        chosen_query: str,
        previous_id: str | None = None,
        custom_sql: str = "",
        limit: int | None = None,
    ) -> tuple[str, DataFrame]:
        """The comparison panel: previous defaults to the second newest, current = latest."""
        pair = self.default_pair()
        if pair is None:
            empty = empty_layer(self.spark, layer)
            return QP.run_snapshot_query(self.spark, layer, empty, empty, chosen_query, custom_sql, limit)
        previous_id = previous_id or pair[0]
        current_id = pair[1]
        rewritten = self._counts_from_gold(layer, chosen_query, current_id, limit)
        if rewritten is not None:
            return QP.sql_text(layer, chosen_query, limit), rewritten
        if chosen_query == S.QUERY_OPTIONS[0] and layer in ("bronze", "silver"):
            rows = self.new_records(layer, previous_id, current_id)  # a log scan
            return QP.sql_text(layer, chosen_query, limit), CMP.top_rows(rows, CMP.full_order(rows, [rows.columns[0]]), limit)
        previous, current = self.as_of(layer, previous_id), self.as_of(layer, current_id)
        return QP.run_snapshot_query(self.spark, layer, previous, current, chosen_query, custom_sql, limit)

    def _counts_from_gold(self, layer: str, chosen_query: str, current_id: str, limit):
        """Q3/Q4 on silver (and bronze after T1) from the current gold: same rows, and a
        scan of days x stations instead of every observation."""
        if chosen_query not in S.QUERY_OPTIONS[1:] or layer == "gold":
            return None
        seq = self.seq_of(current_id)
        if seq is None or (layer != "silver" and seq < 2):
            return None  # bronze(T1) keeps in-pull duplicates: scan it
        gold = self.store.gold(seq)
        if chosen_query == S.QUERY_OPTIONS[1]:
            rows = CMP.counts_from_gold(gold, by_station=True)
            order = ["partition_key desc", "station_id"]
        else:
            rows = CMP.counts_from_gold(gold, by_station=False)
            order = ["partition_key desc"]
        return CMP.top_rows(rows, CMP.full_order(rows, order), limit)

    def preview(self, layer: str, previous_id: str, current_id: str, rows: int = S.PREVIEW_ROWS) -> DataFrame:
        order = S.GOLD_KEYS if layer == "gold" else ["timestamp", "station_id", "source_record_id"]
        return QP.preview(self.as_of(layer, previous_id), self.as_of(layer, current_id), order, rows)
