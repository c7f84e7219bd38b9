"""The expected values FIXTURES.md lists for sf0.01 and sf0.1."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from chronolake.plans import registered as R
from chronolake.sources import fixture as FX

FACTS = {
    "sf0.01": dict(pulls=[3387, 4291, 4407], seq=[3387, 3341, 3385], bronze=[3387, 6615, 10000],
                   gold=[94, 184, 280], null_station=11, fanout=88, compare=442, new=3385,
                   silver=[6891, 1005, 1949, 155]),
    "sf0.1": dict(pulls=[34233, 42939, 43860], seq=[34233, 32874, 34034], bronze=[34233, 65966, 100000],
                  gold=[126, 254, 382], null_station=82, fanout=108, compare=636, new=34034,
                  silver=[68961, 10018, 19363, 1658]),
}


@pytest.mark.parametrize("sf", sorted(FACTS))
def test_fixture_facts(spark, sf):
    want, sf_dir = FACTS[sf], f"/root/testdata/{sf}"
    events = FX.read_events(spark, sf_dir)
    assert [r[1] for r in FX.pulls(events).groupBy("pull").count().orderBy("pull").collect()] == want["pulls"]
    ex = R.published(spark, sf_dir)
    log = ex.store.log()
    assert [r[1] for r in log.groupBy("seq").agg(F.sum("copies")).orderBy("seq").collect()] == want["seq"]
    assert [ex.as_of("bronze", f"T{n}").count() for n in (1, 2, 3)] == want["bronze"]
    assert [ex.as_of("gold", f"T{n}").count() for n in (1, 2, 3)] == want["gold"]
    g3 = ex.as_of("gold", "T3")
    assert g3.where("station_id IS NULL").count() == want["null_station"]
    assert g3.where("new_records > rows_processed").count() == want["fanout"]
    s3 = ex.as_of("silver", "T3").groupBy("quality_flag", "anomaly_flag").count()
    assert [r[2] for r in s3.orderBy("quality_flag", "anomaly_flag").collect()] == want["silver"]
    assert E.queries()["compare_gold"](spark, sf_dir).count() == want["compare"]
    assert E.queries()["new_records_bronze_except"](spark, sf_dir).count() == want["new"]
