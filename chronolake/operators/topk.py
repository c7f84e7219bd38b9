"""Per-group latest-N (SRC10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake import schemas as S


def latest_per_station(
    obs: DataFrame,
    limit: int = S.DEFAULT_LIVE_LIMIT,
    station: str = "station_id",
    rank_column: str = "recency_rank",
) -> DataFrame:
    """The ``limit`` newest observations of each station (ties: smaller id first).

    ``row_number() <= limit`` is planned with a partial ``WindowGroupLimit`` before the
    shuffle, so each map task ships at most ``limit`` rows per station even when one
    station holds most of the data.
    """
    w = Window.partitionBy(station).orderBy(F.col("timestamp").desc(), F.col("source_record_id"))
    return obs.withColumn(rank_column, F.row_number().over(w)).where(F.col(rank_column) <= limit)
