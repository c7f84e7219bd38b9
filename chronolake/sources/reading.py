"""Reads that treat a folder nobody has written yet as empty, and only that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chronolake.session import shared_dir


def or_empty(spark: SparkSession, schema: T.StructType, read: Callable[[], DataFrame]) -> DataFrame:
    """``read()``, or no rows of ``schema`` where its path does not exist; other failures are raised."""
    try:
        return read()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder that all executors share, and read from there afterwards."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
