"""Compaction (SNK2): many small snapshot folders of a log become one span of few files.

Every refresh adds a folder to each log, so after a year of hourly refreshes a read opens tens of thousands of
small files. ``compact`` rewrites the folders that no span covers yet into a new one, whose rows carry their
snapshot as a column and lie in its order, so that row-group statistics still skip the snapshots that a read does
not want. The spans in force are named by the newest row set of ``_layout``, written last: a compaction that dies
before leaves everything as it was, and a reader that began before reads the folders, which stay. They may be
removed when no such reader is left.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from chronolake.sources import catalog as CAT
from chronolake.sources.store import LOG_SCHEMA, SILVER_LOG_SCHEMA, LayerStore

#: Spans of a log that are rewritten into one when another is added.
MOST_SPANS = 8


def compact(spark: SparkSession, root: str) -> dict[str, int]:
    """Rewrites both logs up to the latest snapshot; by folder, the number of snapshots in its new span."""
    store = LayerStore(spark, root)
    latest = CAT.latest_entry(CAT.read_catalog(spark, root))
    if latest is None:
        return {}
    spans, done = store.spans, {}
    for table, schema in (("bronze_log", LOG_SCHEMA), ("silver_log", SILVER_LOG_SCHEMA)):
        name = store.path(table).rsplit("/", 1)[1]
        own = [s for s in spans if s["name"] == name]
        first = own[-1]["last"] + 1 if own else 1
        if first > latest["seq"]:
            continue
        if len(own) >= MOST_SPANS:
            first, spans = 1, [s for s in spans if s["name"] != name]
        folder = f"{name}_c{uuid.uuid4().hex[:8]}"
        rows = store.table(table, schema).where(f"seq between {first} and {latest['seq']}")
        # Rows of a day meet, and a day that is larger than a file is spread by its measured size.
        spread = rows.hint("rebalance", "partition_date").sortWithinPartitions("seq", "partition_date", "timestamp")
        spread.write.parquet(f"{store.root}/{folder}")
        spans = [*spans, {"name": name, "folder": folder, "first": first, "last": latest["seq"]}]
        done[name] = latest["seq"] - first + 1
    if done:
        version = max((s.get("version", 0) for s in store.spans), default=0) + 1
        CAT.publish_spans(spark, root, version, spans)
    return done
