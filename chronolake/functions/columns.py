"""Column expressions shared by the layers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: str | Column) -> Column:
    """Number from JSON text: numbers and numeric strings parse, anything else is null."""
    return col(c).cast("string").try_cast("double")


def nan_to_null(c: str | Column) -> Column:
    """NaN and null mean the same thing downstream (comparisons, avg, max)."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def utc_wall_clock(text: str | Column) -> Column:
    """ISO-8601 text (any offset) -> UTC wall-clock ``timestamp_ntz``; unparseable -> null."""
    instant = F.try_to_timestamp(col(text))
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def date_key(ts: str | Column) -> Column:
    """``YYYY-MM-DD`` text of a UTC wall-clock timestamp."""
    return F.to_date(col(ts)).cast("string")


def hour_floor(ts: str | Column) -> Column:
    """Timestamp floored to the hour, kept as ``timestamp_ntz`` (time-zone independent)."""
    ts = col(ts)
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def quality_flag(
    temperature: str | Column = "temperature_c",
    pressure: str | Column = "pressure_pa",
    humidity: str | Column = "humidity_pct",
) -> Column:
    """PASS iff temperature, pressure and humidity are all present."""
    ok = col(temperature).isNotNull() & col(pressure).isNotNull() & col(humidity).isNotNull()
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("REVIEW"))


def anomaly_flag(
    gust_limit: float = S.GUST_LIMIT_KMH,
    pressure_floor: float = S.PRESSURE_FLOOR_PA,
    temp_high: float = S.TEMP_HIGH_C,
    temp_low: float = S.TEMP_LOW_C,
) -> Column:
    """Strict threshold test; missing measures read as harmless defaults, so never null."""
    gust = F.coalesce(F.col("wind_gust_kmh"), F.lit(S.NULL_GUST))
    pressure = F.coalesce(F.col("pressure_pa"), F.lit(S.NULL_PRESSURE))
    temp = F.coalesce(F.col("temperature_c"), F.lit(S.NULL_TEMPERATURE))
    return (gust > gust_limit) | (pressure < pressure_floor) | (temp > temp_high) | (temp < temp_low)


def incremental_partition(date: str | Column, station: str | Column) -> Column:
    """``date|station``; null when the station is null (``concat`` propagates nulls)."""
    return F.concat(col(date), F.lit("|"), col(station))


def snapshot_label(snapshot_id: str | Column, created_at: str | Column) -> Column:
    """``T3 (2024-01-21 00:00)`` from an id and an ISO creation time."""
    when = utc_wall_clock(created_at)
    return F.concat(col(snapshot_id), F.lit(" ("), F.date_format(when, "yyyy-MM-dd HH:mm"), F.lit(")"))


def snapshot_id_of(seq: str | Column) -> Column:
    return F.concat(F.lit("T"), col(seq).cast("string"))


def order_key(order: list[str], nulls_last: tuple[str, ...] = ()) -> Column:
    """A struct whose natural (ascending) order is the given multi-column order.

    Columns listed in ``nulls_last`` get an ``isnull`` flag in front, so nulls sort after
    every value, as a pandas sort does.
    """
    fields: list[Column] = []
    for i, name in enumerate(order):
        if name in nulls_last:
            fields.append(F.col(name).isNull().alias(f"k{i}_null"))
        fields.append(F.col(name).alias(f"k{i}"))
    return F.struct(*fields)


def exact_part(c: str | Column) -> Column:
    """A reading as a fixed-point number of 12 decimals: sums of these do not depend on their order.

    Null where it has 17 digits or more before the point, or is infinite: see :func:`far_part`.
    """
    return col(c).try_cast("decimal(28, 12)")


def far_part(c: str | Column) -> Column:
    """What :func:`exact_part` cannot hold, null otherwise."""
    return F.when(exact_part(c).isNull(), col(c))


def row_encoding(df: DataFrame) -> Column:
    """The whole row as one string that no other row of these columns has.

    Every value is ``-`` if null, else the length of its text, ``:`` and the text; the text holds the value in
    full: microseconds of a timestamp, all digits and the sign of zero of a double, the bytes of a binary.
    """
    def text(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"column {field.name}: rows are encoded over plain columns only, not {kind.simpleString()}")
        if isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        value = value.cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.concat(*[text(f) for f in df.schema.fields])
