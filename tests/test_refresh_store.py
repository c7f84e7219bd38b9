"""Persistence: the refresh job run once per pull equals the closed-form log (SNP1, SNK*, SRC13-15)."""

from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.plans import registered as R
from chronolake.plans.explorer import Explorer
from chronolake.plans.refresh import refresh_snapshot
from chronolake.sources import catalog as CAT
from chronolake.sources import fixture as FX
from chronolake.sources.store import LayerStore

SF = "/root/testdata/sf0.001"


def layer(spark, name, n):
    return R.published(spark, SF).as_of(name, f"T{n}")


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _run_pulls(spark, root):
    events = FX.read_events(spark, SF)
    out = []
    for pull, as_of in FX.PULL_AS_OF.items():
        raw = FX.pull_frame(events, pull)
        out.append(refresh_snapshot(spark, root, raw, as_of, FX.FIXTURE_SOURCE_NAME, FX.STATION_CODES))
    return events, out


def test_rerun_is_no_change_and_empty_is_skipped(spark, workdir):
    events, _ = _run_pulls(spark, workdir)
    again = refresh_snapshot(spark, workdir, FX.pull_frame(events, 2), FX.PULL_AS_OF[3])
    assert again.status == "NO_CHANGE"
    empty = FX.pull_frame(events, 2).where(F.lit(False))
    assert refresh_snapshot(spark, workdir, empty, FX.PULL_AS_OF[3]).status == "SKIPPED"
    assert CAT.latest_entry(CAT.read_catalog(spark, workdir))["seq"] == 3


def test_uncommitted_snapshot_is_invisible(spark, workdir):
    events, _ = _run_pulls(spark, workdir)
    store = LayerStore(spark, workdir)
    # A crashed refresh wrote its log partition but no catalog row.
    junk = store.log().where(F.col("seq") == 3).drop("seq")
    store.write_log(4, junk)
    ex = Explorer(spark, workdir)
    assert ex.latest()["seq"] == 3
    _same(ex.as_of("bronze", "T3"), layer(spark, "bronze", 3))
    assert ex.as_of("bronze", "T4").count() == 0
    assert ex.as_of("gold", "T9").schema == S.GOLD_SCHEMA
    # The retry rewrites seq 4 from scratch; nothing new -> NO_CHANGE is decided first.
    res = refresh_snapshot(spark, workdir, FX.pull_frame(events, 3), "2024-02-10T00:00:00+00:00")
    assert res.status == "NO_CHANGE"


def test_explorer_queries_match_registered(spark, workdir):
    events, _ = _run_pulls(spark, workdir)
    ex = Explorer(spark, workdir)
    assert ex.default_pair() == ("T2", "T3")
    counts = {(r.snapshot_id, r.layer): r.row_count for r in ex.layer_counts().collect()}
    assert counts[("T3", "bronze")] == ex.as_of("bronze", "T3").count()
    assert counts[("T1", "gold")] == ex.as_of("gold", "T1").count()
    assert ex.scan_comparison().count() == 6 and ex.metrics().count() == 3
    metrics = {r.snapshot_id: r.rows_processed for r in ex.metrics().collect()}
    assert {s: ex.increment(s).count() for s in ("T1", "T2", "T3")} == metrics
    for layer in ("bronze", "silver"):
        _same(ex.new_records(layer, "T2", "T3"), R.QUERIES[f"new_records_{layer}"](spark, SF))
        # the generic EXCEPT path agrees with the log scan
        _same(
            ex.new_records(layer, "T2", "T3", ignore=("nothing",)),
            ex.new_records(layer, "T2", "T3"),
        )
    _, df = ex.query("gold", S.QUERY_OPTIONS[1], limit=None)
    _same(df, R.QUERIES["compare_gold"](spark, SF))
    for layer in ("bronze", "silver"):
        _, panel = ex.query(layer, S.QUERY_OPTIONS[0], limit=None)
        _same(panel, R.QUERIES[f"new_records_{layer}"](spark, SF))
        _, capped = ex.query(layer, S.QUERY_OPTIONS[0], limit=S.RESULT_LIMIT)
        assert capped.count() == S.RESULT_LIMIT
    assert ex.new_records("bronze", "T3", "T3").count() == 0
    assert ex.new_records("silver", "T1", "T1").count() == 0


def test_stable_dates_pruning_gives_same_log(spark, workdir):
    events = FX.read_events(spark, SF)
    for pull, as_of in FX.PULL_AS_OF.items():
        refresh_snapshot(spark, workdir, FX.pull_frame(events, pull), as_of, stable_dates=True)
    ex = Explorer(spark, workdir)
    for n in (2, 3):
        _same(ex.as_of("bronze", f"T{n}"), layer(spark, "bronze", n).drop("source_name"
              ).withColumn("source_name", F.lit(S.DEFAULT_SOURCE_NAME)))
    plan = LayerStore(spark, workdir).history_ids(3, "2024-01-18")[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seq" in plan and "partition_date" in plan


def test_counts_answered_from_gold_equal_the_scans(spark, workdir):
    _run_pulls(spark, workdir)
    ex = Explorer(spark, workdir)
    from chronolake.plans import query_panel as QP

    for layer in ("silver", "bronze"):
        for q in S.QUERY_OPTIONS[1:]:
            _, fast = ex.query(layer, q, limit=None)
            cur = ex.as_of(layer, "T3")
            slow = (QP.compare_changes(cur, cur, layer, limit=None) if q == S.QUERY_OPTIONS[1]
                    else QP.aggregate_by_partition(cur, layer, limit=None))
            _same(fast, slow)
            plan = fast._jdf.queryExecution().executedPlan().toString()
            assert "/gold" in plan and "silver_log" not in plan and "bronze_log" not in plan


def test_rebuild_switches_whole_and_its_thresholds_stay(spark, workdir, monkeypatch):
    from chronolake.plans import rebuild as RB
    from chronolake.sources.store import LayerStore as Store

    events = FX.read_events(spark, SF)
    for pull in (1, 2):
        refresh_snapshot(spark, workdir, FX.pull_frame(events, pull), FX.PULL_AS_OF[pull], FX.FIXTURE_SOURCE_NAME)

    def flagged(n):
        ex = Explorer(spark, workdir)
        silver = ex.as_of("silver", f"T{n}").where("anomaly_flag").count()
        assert ex.as_of("gold", f"T{n}").agg(F.sum("anomaly_count")).first()[0] == silver
        return silver

    before = [flagged(1), flagged(2)]
    assert RB.rebuild(spark, workdir) == 2 and [flagged(1), flagged(2)] == before
    for n in (1, 2):
        for name in ("silver", "gold"):
            _same(Explorer(spark, workdir).as_of(name, f"T{n}"), layer(spark, name, n))
    # A rebuild that dies before it is published leaves the layers as they were.
    monkeypatch.setattr(RB.CAT, "publish_rules", lambda *a: 1 / 0)
    try:
        RB.rebuild(spark, workdir, gust_limit=30.0)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert [flagged(1), flagged(2)] == before
    RB.rebuild(spark, workdir, gust_limit=30.0)
    assert flagged(2) > before[1]
    refresh_snapshot(spark, workdir, FX.pull_frame(events, 3), FX.PULL_AS_OF[3], FX.FIXTURE_SOURCE_NAME)
    bronze = Explorer(spark, workdir).as_of("bronze", "T3")
    odd = "coalesce(wind_gust_kmh, 0) > 30 OR pressure_pa < 98000 OR temperature_c > 38 OR temperature_c < -25"
    assert flagged(3) == bronze.where(odd).count()
    assert Store(spark, workdir).thresholds == {"gust_limit": 30.0}


def test_panel_sql_text_gives_the_same_rows(spark):
    ex = R.published(spark, SF)
    for name in S.LAYERS:
        for option in S.QUERY_OPTIONS:
            text, rows = ex.query(name, option, limit=50)
            _same(ex.query(name, "custom", custom_sql=text)[1], rows)


def test_pulls_of_one_second_do_not_replace_each_other(spark, workdir):
    events = FX.read_events(spark, SF)
    paths = {LayerStore(spark, workdir).write_raw(FX.pull_frame(events, n), "s", FX.PULL_AS_OF[1])[0] for n in (1, 2)}
    assert len(paths) == 2 and all(spark.read.parquet(p).count() for p in paths)


def test_lost_history_is_an_error(spark, workdir):
    import pytest

    events = FX.read_events(spark, SF)
    refresh_snapshot(spark, workdir, FX.pull_frame(events, 1), FX.PULL_AS_OF[1])
    # the catalog says T1 exists, but its log disappears (a different, empty store root
    # holding only the catalog)
    other = f"{workdir}-catalog-only"
    CAT.append_entry(spark, other, CAT.latest_entry(CAT.read_catalog(spark, workdir)))
    with pytest.raises(RuntimeError, match="missing"):
        refresh_snapshot(spark, other, FX.pull_frame(events, 2), FX.PULL_AS_OF[2])


def test_bucketed_id_index(spark, workdir):
    from chronolake.operators import layers as L

    events = FX.read_events(spark, SF)
    for pull, as_of in FX.PULL_AS_OF.items():
        refresh_snapshot(spark, workdir, FX.pull_frame(events, pull), as_of, FX.FIXTURE_SOURCE_NAME, id_buckets=8 if pull == 1 else None)
    ex = Explorer(spark, workdir)
    for n in (1, 2, 3):
        for name in S.LAYERS:
            _same(ex.as_of(name, f"T{n}"), layer(spark, name, n))
    store = LayerStore(spark, workdir)  # an existing index is picked up without asking
    assert [(g.buckets, g.from_seq) for g in store.ids.generations()] == [(8, 1)]
    [hist] = store.history_ids(3)
    assert "chronolake_ids_" in hist._jdf.queryExecution().executedPlan().toString()
    _same(hist, layer(spark, "silver", 3).select("source_record_id"))
    # an increment too large to broadcast: only the increment is shuffled
    inc = L.to_bronze(FX.pull_frame(events, 3), "x", "t")
    new = L.unseen(inc, store.history_ids(2), broadcast_limit_rows=0)
    plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    expected = inc.join(layer(spark, "bronze", 2).select("source_record_id"), "source_record_id", "left_anti")
    assert new.count() == expected.count()


def test_index_generations(spark, workdir):
    """A changed bucket count opens a generation: none is ever read with another's count."""
    from chronolake.operators import layers as L

    events = FX.read_events(spark, SF)
    for pull, buckets in ((1, 4), (2, 8)):
        refresh_snapshot(spark, workdir, FX.pull_frame(events, pull), FX.PULL_AS_OF[pull], FX.FIXTURE_SOURCE_NAME, id_buckets=buckets)
    store = LayerStore(spark, workdir, id_buckets=2)
    assert [(g.buckets, g.from_seq) for g in store.ids.generations()] == [(4, 1), (8, 2)]
    inc = L.to_bronze(FX.pull_frame(events, 3), "x", "t")
    expected = inc.join(layer(spark, "bronze", 2).select("source_record_id"), "source_record_id", "left_anti")
    for limit in (0, 10**9):
        _same(L.unseen(inc, store.history_ids(2), broadcast_limit_rows=limit), expected)
    # a retry finds the generation that the attempt before it opened
    store.ids.write(3, expected, 1, 1)
    store.ids.write(3, expected, 1, 1)
    assert [(g.buckets, g.from_seq) for g in store.ids.generations()] == [(4, 1), (8, 2), (2, 3)]
    assert sum(h.count() for h in store.history_ids(3)) == layer(spark, "silver", 2).count() + expected.count()


def test_index_grows_with_history(spark, workdir, monkeypatch):
    from chronolake.sources import id_index

    monkeypatch.setattr(id_index, "BUCKET_IDS", 150)
    _run_pulls(spark, workdir)
    counts = [g.buckets for g in LayerStore(spark, workdir).ids.generations()]
    assert len(counts) > 1 and counts == sorted(set(counts))
    ids = LayerStore(spark, workdir).history_ids(3)
    assert len(ids) == len(counts)
    assert sum(h.count() for h in ids) == layer(spark, "silver", 3).count()


def test_index_not_covering_history_falls_back_to_log(spark, workdir):
    events = FX.read_events(spark, SF)
    refresh_snapshot(spark, workdir, FX.pull_frame(events, 1), FX.PULL_AS_OF[1])
    store = LayerStore(spark, workdir)
    store.ids.root = f"{workdir}/elsewhere"  # an index that holds nothing
    [hist] = store.history_ids(1)
    assert "chronolake_ids_" not in hist._jdf.queryExecution().executedPlan().toString()
    assert hist.count() == LayerStore(spark, workdir).log().where("is_first").count()
