"""A third of all rows under one id: the refresh path stays correct (keep-first, counts)."""

from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.plans.explorer import Explorer
from chronolake.plans.refresh import refresh_snapshot
from chronolake.sources import fixture as FX

SF = "/root/testdata/sf0.01"


def _skewed_pull(spark, pull):
    """Fixture pull where every third event reports the same hot id."""
    raw = FX.pull_frame(FX.read_events(spark, SF), pull)
    n = F.substring_index(F.col("source_record_id"), "-", -1).cast("long")
    hot = F.when(n % 3 == 0, F.lit("obs-hot")).otherwise(F.col("source_record_id"))
    return raw.withColumn("source_record_id", hot)


def test_hot_id_through_refresh(spark, workdir):
    p1, p2 = _skewed_pull(spark, 1), _skewed_pull(spark, 2)
    hot_rows_p1 = p1.where("source_record_id = 'obs-hot'").count()
    assert hot_rows_p1 * 4 > p1.count()  # roughly a third of the pull
    assert refresh_snapshot(spark, workdir, p1, FX.PULL_AS_OF[1]).status == "CREATED"
    second = refresh_snapshot(spark, workdir, p2, FX.PULL_AS_OF[2])
    assert second.status == "CREATED"
    ex = Explorer(spark, workdir)
    b1, b2 = ex.as_of("bronze", "T1"), ex.as_of("bronze", "T2")
    # first snapshot keeps every copy; later snapshots one row per id
    assert b1.count() == p1.count()
    assert b2.groupBy("source_record_id").count().where("count > 1").isEmpty()
    # the survivor of the hot id is its earliest observation in the first pull
    earliest = p1.where("source_record_id = 'obs-hot'").agg(F.min("timestamp")).first()[0]
    kept = b2.where("source_record_id = 'obs-hot'").collect()
    assert len(kept) == 1 and kept[0].timestamp == earliest
    # the second pull's hot rows were all known -> not new
    expected_new = p2.where("source_record_id != 'obs-hot'").join(
        p1.select("source_record_id"), "source_record_id", "left_anti"
    ).select("source_record_id").distinct().count()
    assert second.entry["metrics"]["rows_processed"] == expected_new
    gold = ex.as_of("gold", "T2")
    assert gold.agg(F.sum("rows_processed")).first()[0] == b2.count()
    assert [f.name for f in gold.schema.fields] == S.GOLD_COLUMNS


def test_hot_id_is_spread_over_tasks(spark):
    """Distinct rows of one id meet by digest: no shuffle partition holds them together."""
    from chronolake.operators import layers as L
    from chronolake.operators.dedupe import flag_first_distinct

    rows = L.to_bronze(_skewed_pull(spark, 1).withColumn("source_record_id", F.lit("obs-hot")), "s", "t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flagged = flag_first_distinct(rows, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 1.5 * sum(sizes) / 8
    assert flagged.where("is_first").count() == 1


def test_increment_is_one_row_an_id_before_the_history_join(spark, workdir):
    from chronolake.operators import layers as L
    from chronolake.operators.dedupe import keep_first

    rows = L.to_bronze(_skewed_pull(spark, 1), "s", "t")
    one = keep_first(rows, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
    new = L.unseen(one, spark.range(10).selectExpr("concat('obs-', id) AS source_record_id"), rows=10**9)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("partial_min") and "SinglePartition" not in plan
