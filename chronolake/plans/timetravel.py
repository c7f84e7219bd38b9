"""Layers as of a snapshot, read from the append-only log (SNP4) and log rewrites.

The bronze log holds, per ``seq`` (snapshot number), the rows first seen in that
snapshot with ``is_first`` (keep-first survivor of its id) and ``copies`` (multiplicity
of identical rows; only the first snapshot keeps in-batch duplicates):

* ``bronze(T1)``  = all rows of ``seq = 1``, each repeated ``copies`` times
* ``bronze(Tn)``  = rows with ``seq <= n AND is_first``            (n >= 2)
* ``silver(Tn)``  = silver flags of rows with ``seq <= n AND is_first``, stored in ``silver_log``
* ``increment(Tn)`` = the rows of ``seq = n`` (with copies)

``seq`` is a partition column on disk, so each of these is a partition-pruned scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake import schemas as S


COPY_CHUNK = 100_000  # most copies one task expands for one log row


def expand_copies(log: DataFrame, chunk: int = COPY_CHUNK) -> DataFrame:
    """Repeat each log row ``copies`` times (identical rows of the first snapshot).

    Rows with up to ``chunk`` copies expand in place. A row with more (one record
    repeated a third of the data, say) is first cut into chunks of ``chunk`` copies, the
    chunk rows -- few -- are spread over tasks by a shuffle, and each task expands its
    chunks: no single task emits the whole group. ``copies`` is a data column, so the
    second branch's filter skips every row group without such rows unread.
    """
    cols = log.columns
    small = log.where(F.col("copies") <= chunk).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))
    )
    parts = log.where(F.col("copies") > chunk).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / chunk).cast("int")))
    )
    big = (
        parts.withColumn("_n", F.least(F.lit(chunk), F.col("copies") - F.col("_part") * chunk))
        .repartition("source_record_id", "_part")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    )
    return small.select(*cols).unionByName(big.select(*cols))


def bronze_as_of(log: DataFrame, n: int) -> DataFrame:
    if n <= 1:
        rows = expand_copies(log.where(F.col("seq") == 1))
    else:
        rows = log.where((F.col("seq") <= n) & F.col("is_first"))
    return rows.select(*S.BRONZE_COLUMNS)


def increment_of(log: DataFrame, n: int) -> DataFrame:
    return expand_copies(log.where(F.col("seq") == n)).select(*S.BRONZE_COLUMNS)


def new_rows_from_log(log: DataFrame, previous: int, current: int, columns: list[str]) -> DataFrame:
    """``layer(T_current) EXCEPT layer(T_previous)`` for bronze/silver, as a log scan.

    Rows never change once logged, so the difference of two snapshots is exactly the
    keep-first rows appended after ``previous`` -- no anti-join, no shuffle of either
    snapshot. (For ``current = 1`` nothing can be new relative to itself.)
    """
    if current <= 1 or previous >= current:
        return log.where(F.lit(False)).select(*columns)
    rows = log.where((F.col("seq") > previous) & (F.col("seq") <= current) & F.col("is_first"))
    return rows.select(*columns)


def empty_layer(spark, layer: str) -> DataFrame:
    """Typed empty frame of a layer (a missing snapshot reads as empty, never schemaless)."""
    return spark.createDataFrame([], S.layer_schema(layer))
