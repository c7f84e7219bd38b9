"""Every registered query equals its DuckDB oracle (small scale; the driver checks sf0.01)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from chronolake.plans import registered as R

SF = "/root/testdata/sf0.001"
NAMES = sorted(R.QUERIES)


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_canon(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def test_every_query_has_an_oracle():
    assert set(R.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["partition_date", "station_id", "current_rows", "previous_rows", "delta_rows"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "name", ["feed_parse", "obs_required_fields", "silver_t3", "gold_t1", "snapshot_list", "refresh_due"]
)
def test_session_settings_do_not_change_results(spark, duck, name, ansi):
    """The driver brings its own session: results must not depend on its zone or ANSI mode."""
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    other.conf.set("spark.sql.ansi.enabled", ansi)
    got = E.queries()[name](other, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert _rows(got) == _rows(want)
