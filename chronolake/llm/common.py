"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.session import shared_dir

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
#: Rows that one window or one group of a distributed ranking holds, about.
BUCKET_ROWS = 100_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; splitting leaves an empty string at either end at most."""
    return F.array_remove(F.split(text, GAP, -1), "")


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder that all executors share.

    Later steps read them from there, so a lost executor never reruns what made them. Spark
    removes the files when the frame is no longer referenced.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def buckets_for(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def before(df: DataFrame, group: list[str], bucket: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the rows of the group that come earlier.

    ``bucket`` never falls along ``order``, so the sum is that of the earlier buckets (one row per
    group and bucket) plus that of the earlier rows of the own bucket: no task sorts a whole
    group. ``df`` is read twice and should be cut; ``group`` and ``bucket`` hold no nulls.
    """
    keys = [*group, bucket]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        df.groupBy(*keys)
        .agg(F.sum(amount).alias("_all"))
        .select(*keys, F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(starts, keys)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside")
    )
