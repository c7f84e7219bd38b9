"""Comparison panel: canned queries (Q1-Q4), custom SQL (SQL1) and preview (TOP2).

``limit`` is the panel's result cap (``S.RESULT_LIMIT`` in its report); without one, the whole result is returned.
Every canned order ends with all remaining columns, so the rows kept at the cut are the
same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators import compare as CMP


def show_new_records(
    current: DataFrame, previous: DataFrame, limit: int | None = None, ignore: tuple[str, ...] = ()
) -> DataFrame:
    rows = CMP.new_records(current, previous, ignore)
    return CMP.top_rows(rows, CMP.full_order(rows, [rows.columns[0]]), limit)


def compare_changes(
    current: DataFrame, previous: DataFrame, layer: str, limit: int | None = None
) -> DataFrame:
    if layer == "gold":
        rows = CMP.compare_gold(current, previous)
        lead = ["partition_date desc", "station_id"]
    else:
        date_column = "observation_date" if layer == "silver" else "partition_date"
        rows = CMP.partition_counts(current, date_column)
        lead = ["partition_key desc", "station_id"]
    return CMP.top_rows(rows, CMP.full_order(rows, lead), limit)


def aggregate_by_partition(current: DataFrame, layer: str, limit: int | None = None) -> DataFrame:
    rows = CMP.aggregate_by_partition(current, layer)
    return CMP.top_rows(rows, CMP.full_order(rows, ["partition_key desc"]), limit)


def sql_text(layer: str, chosen_query: str, limit: int | None = None) -> str:
    """A canned query as SQL over ``current_data`` / ``previous_data``, as SQL1 would run it."""
    day = {"silver": "observation_date"}.get(layer, "partition_date")
    columns = S.layer_schema(layer).fieldNames()
    if chosen_query == S.QUERY_OPTIONS[0]:
        rows, lead = "SELECT * FROM current_data EXCEPT SELECT * FROM previous_data", [columns[0]]
    elif chosen_query == S.QUERY_OPTIONS[1] and layer == "gold":
        # USING is plain equality, key by key: a null station meets nothing and stays a row of its own side.
        def side(table: str, rows: str) -> str:
            return f"(SELECT partition_date, station_id, rows_processed AS {rows} FROM {table})"

        both = f"{side('current_data', 'now_rows')} FULL OUTER JOIN {side('previous_data', 'old_rows')} USING (partition_date, station_id)"
        counts = "partition_date, station_id, ifnull(now_rows, 0) AS current_rows, ifnull(old_rows, 0) AS previous_rows"
        rows = f"SELECT *, current_rows - previous_rows AS delta_rows FROM (SELECT {counts} FROM {both})"
        columns, lead = ["partition_date", "station_id", "current_rows", "previous_rows", "delta_rows"], ["partition_date desc", "station_id"]
    elif chosen_query == S.QUERY_OPTIONS[1]:
        rows = f"SELECT station_id, {day} AS partition_key, count(*) AS current_rows FROM current_data GROUP BY station_id, {day}"
        columns, lead = ["station_id", "partition_key", "current_rows"], ["partition_key desc", "station_id"]
    else:
        number = "sum(rows_processed)" if layer == "gold" else "count(*)"
        rows = f"SELECT {day} AS partition_key, {number} AS row_count FROM current_data GROUP BY {day}"
        columns, lead = ["partition_key", "row_count"], ["partition_key desc"]
    if limit is None:
        return rows
    order = lead + [c for c in columns if c not in {x.split()[0] for x in lead}]
    return f"SELECT * FROM ({rows}) ORDER BY {', '.join(f'{x} NULLS LAST' for x in order)} LIMIT {limit}"


def run_snapshot_query(
    spark: SparkSession,
    layer: str,
    previous: DataFrame,
    current: DataFrame,
    chosen_query: str,
    custom_sql: str = "",
    limit: int | None = None,
) -> tuple[str, DataFrame]:
    """The SQL and rows of a query by name; any other name runs ``custom_sql`` (blank -> default)."""
    if chosen_query == S.QUERY_OPTIONS[0]:
        return sql_text(layer, chosen_query, limit), show_new_records(current, previous, limit)
    if chosen_query == S.QUERY_OPTIONS[1]:
        return sql_text(layer, chosen_query, limit), compare_changes(current, previous, layer, limit)
    if chosen_query == S.QUERY_OPTIONS[2]:
        return sql_text(layer, chosen_query, limit), aggregate_by_partition(current, layer, limit)
    text = custom_sql.strip() or S.DEFAULT_CUSTOM_SQL
    return text, CMP.custom_sql(spark, current, previous, text)


def preview(
    previous: DataFrame, current: DataFrame, order: list[str], rows: int = S.PREVIEW_ROWS
) -> DataFrame:
    """TOP2: the first ``rows`` rows of each side (by ``order``), tagged with the side."""
    def side(df: DataFrame, name: str) -> DataFrame:
        top = CMP.top_rows(df, CMP.full_order(df, list(order)), rows)
        return top.select(F.lit(name).alias("side"), *df.columns)

    return side(previous, "previous").unionByName(side(current, "current"))
