"""Deterministic keep-first deduplication, skew-safe.

A window ``row_number() OVER (PARTITION BY id ...)`` would put every copy of a hot id into
one task. Both operators here are aggregations instead, so Spark combines map-side
(partial ``min``) before the shuffle: a key that holds a third of all rows still leaves
each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.functions.columns import order_key, row_encoding


def keep_first(
    df: DataFrame,
    key: str,
    order: list[str],
    nulls_last: tuple[str, ...] = (),
) -> DataFrame:
    """One row per ``key``: the smallest by ``order``, remaining columns as tie-breakers.

    ``min`` over ``struct(order..., row...)`` is a total order on the whole row, so the
    survivor is the same on every run (unlike ``dropDuplicates``).
    """
    rest = [c for c in df.columns if c != key and c not in order]
    ranked = F.struct(order_key(order, nulls_last).alias("o"), F.struct(*order, *rest).alias("r"))
    return (
        df.groupBy(key)
        .agg(F.min(ranked).alias("_w"))
        .select(F.col(key), "_w.r.*")
        .select(*df.columns)
    )


def flag_first_distinct(
    df: DataFrame,
    key: str,
    order: list[str],
    nulls_last: tuple[str, ...] = (),
    flag: str = "is_first",
    copies: str = "copies",
) -> DataFrame:
    """Distinct rows with their multiplicity and a flag on the first row of each ``key``.

    Keeps every row (as ``copies``), for a layer that must still show duplicates while
    later reads take only the flagged row. Rows meet by the SHA-256 of their lossless
    encoding (:func:`row_encoding`), never by the key: rows apart by a microsecond, by null
    against empty or by the sign of a zero stay apart, the distinct rows of a hot key spread
    over all tasks, exact copies collapse map-side, and the full row is shuffled once. Rows
    that meet are held against each other by a second, typed hash of all columns: rows that
    differ under one digest are an error, never one row. The first row of a key is
    found over (order, digest) alone, one narrow row for each key and map task, and marked
    by an equi-join on the digest, by which the distinct rows are already partitioned.
    """
    rows = df.withColumn("_digest", F.unhex(F.sha2(row_encoding(df), 256)))
    seen = F.xxhash64(*df.columns)
    distinct_rows = rows.groupBy("_digest").agg(
        F.count(F.lit(1)).alias(copies), F.min(seen).alias("_low"), F.max(seen).alias("_high"), *[F.any_value(c).alias(c) for c in df.columns]
    )
    differ = F.raise_error(F.lit("rows that differ share a digest")).cast("long")
    distinct_rows = distinct_rows.withColumn(copies, F.when(F.col("_low") == F.col("_high"), F.col(copies)).otherwise(differ))
    ranked = F.struct(order_key(order, nulls_last).alias("o"), "_digest")
    winners = rows.groupBy(key).agg(F.min(ranked)["_digest"].alias("_digest")).select("_digest", F.lit(True).alias("_won"))
    return distinct_rows.join(winners, "_digest", "left").select(
        *df.columns, F.coalesce("_won", F.lit(False)).alias(flag), copies
    )
