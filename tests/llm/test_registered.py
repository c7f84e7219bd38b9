"""Registered queries: equal to their SQL where there is one; the pipeline held against its parts."""

import os
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
import corpus_pipeline
from chronolake.llm import near_dedup, registered

SF = "/root/testdata/sf0.001"


def canon(v):
    return None if v is None or v is pd.NA or v != v else round(v, 6) if isinstance(v, float) else v


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(canon(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    got, want = E.queries()[name](spark, SF).toPandas(), con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_operator_is_registered():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in registered.QUERIES} == set(range(1, 14))
    assert {"pipeline", *registered.QUERIES} <= set(E.queries())


def test_pipeline_stages(spark, workdir):
    """Each stage works on all that its predecessor kept; clean documents stay, copies go."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{workdir}/{i}")
        docs = spark.read.parquet(f"{workdir}/{i}")
        kept.append(docs.toPandas())
        if i < 4:
            assert docs.columns == columns
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    source = pd.read_parquet(f"{SF}/documents.parquet")
    good = set(labels[labels.quality == 1].doc_id) & set(source[source.text.str.split().str.len() >= 60].doc_id)
    assert len(good - set(kept[0].doc_id)) <= 0.05 * len(good)
    assert not kept[1].text.map(lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)).duplicated().any()
    assert set(kept[1].text.str.lower()) == set(kept[0].text.str.lower())
    classes = near_dedup.near_classes(spark.read.parquet(f"{workdir}/1")).toPandas()
    assert set(kept[2].doc_id) == set(classes.class_id)
    assert set(kept[3].doc_id) <= set(kept[2].doc_id) and Counter(kept[3].doc_id).most_common(1)[0][1] <= 3
    assert Counter(kept[4][kept[4].piece == 0].doc_id) == Counter(kept[3].doc_id)
