"""Registered queries: one per operator group of the inventory, each ``(spark, sf_dir)``.

Every query reads the whole ``events`` table of ``sf_dir`` or the store that the refresh job
publishes from it (FIXTURES.md: three overlapping pulls), so its work grows with the table.
The store is published once for each session and ``sf_dir``, by ``refresh_snapshot``, and read
through :class:`Explorer` as a user would; the default pair is previous = T2, current = T3.
Results are whole; the 200-row cap is registered once, as the top-k report it is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators import layers as L
from chronolake.operators.dedupe import flag_first_distinct, keep_first
from chronolake.operators.topk import latest_per_station
from chronolake.plans import catalog_views as CV
from chronolake.plans import query_panel as QP
from chronolake.plans.compact import compact
from chronolake.plans.explorer import Explorer
from chronolake.plans.rebuild import gold_history, rebuild
from chronolake.plans.refresh import refresh_if_due, refresh_snapshot
from chronolake.session import shared_dir
from chronolake.sources import feed as FD
from chronolake.sources import fixture as FX
from chronolake.streaming import ingest

PREVIOUS, CURRENT = 2, 3
PAGE_SIZE = 72  # event ids per rendered feed document (bounded group)
CUSTOM_SQL = """
SELECT c.station_id,
       CAST(SUM(c.rows_processed) AS BIGINT) AS current_rows,
       CAST(SUM(COALESCE(p.rows_processed, 0)) AS BIGINT) AS previous_rows,
       CAST(SUM(c.anomaly_count) AS BIGINT) AS current_anomalies
FROM current_data c
LEFT JOIN previous_data p
  ON c.partition_date = p.partition_date
 AND c.station_id = p.station_id
 AND c.station_name = p.station_name
GROUP BY c.station_id
"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.read_events(spark, sf_dir)


def publish(spark: SparkSession, sf_dir: str, root: str, pulls=tuple(FX.PULL_AS_OF), id_buckets: dict[int, int] | None = None) -> str:
    """Runs the refresh job once for each of ``pulls`` into ``root``."""
    events = _events(spark, sf_dir)
    for pull in pulls:
        refresh_snapshot(
            spark, root, FX.pull_frame(events, pull), FX.PULL_AS_OF[pull], FX.FIXTURE_SOURCE_NAME, FX.STATION_CODES,
            id_buckets=(id_buckets or {}).get(pull),
        )
    return root


_STORES: dict[tuple, str] = {}


def published(spark: SparkSession, sf_dir: str) -> Explorer:
    """The store of all three pulls, published at its first use in a session and shared by the queries."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        _STORES[key] = publish(spark, sf_dir, shared_dir(spark, "published"))
    return Explorer(spark, _STORES[key])


def _requested_station() -> Column:
    return F.get(F.array(*[F.lit(c) for c in FX.STATION_CODES]), (F.col("user_id") % 5).cast("int"))


def _iso_utc(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


# --- sources ------------------------------------------------------------------------------

def obs_required_fields(spark, sf_dir):
    """SRC11-12: mixed offsets, unparseable timestamps and missing ids -> parse, drop."""
    obs = FX.observations(_events(spark, sf_dir))
    eid = F.col("event_id")
    minus5 = F.concat(
        F.date_format(F.col("timestamp") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lit("-05:00"),
    )
    ts_text = (
        F.when(eid % 61 == 0, F.lit("not-a-time"))
        .when(eid % 7 == 0, minus5)
        .otherwise(_iso_utc(F.col("timestamp")))
    )
    props = F.struct(
        F.when(eid % 89 != 0, F.col("source_record_id")).alias("@id"), ts_text.alias("timestamp")
    )
    rows = obs.select(
        F.lit(FX.STATION_CODES[0]).alias(FD.STATION_PARTITION),
        F.to_json(F.struct(props.alias("properties"))).alias("feature"),
    )
    return FD.parse_features(rows).select("source_record_id", "timestamp")


def latest_n_per_station(spark, sf_dir):
    """SRC10: newest 72 observations per station."""
    top = latest_per_station(FX.observations(_events(spark, sf_dir)), S.DEFAULT_LIVE_LIMIT)
    return top.select("source_record_id", "station_id", "station_name", "timestamp", "recency_rank")


def station_dim(spark, sf_dir):
    """SRC5 / JOIN5: station id and name fallbacks (every 7th feed row lacks a name)."""
    obs = FX.observations(_events(spark, sf_dir), keep=("user_id",))
    rows = obs.select(
        "source_record_id",
        F.coalesce(F.col("station_id"), _requested_station()).alias("station_id"),
        _requested_station().alias("_requested"),
        F.when(F.col("event_id") % 7 != 0, F.col("station_name")).alias("_feed_name"),
    )
    return FD.resolve_station(rows)


def feed_parse(spark, sf_dir):
    """SRC1-9: observations rendered as feed documents (<= 72 ids each) and parsed back."""
    obs = FX.observations(_events(spark, sf_dir), keep=("user_id",)).withColumns(
        {
            "latitude": (40 + F.col("user_id") % 5).cast("double"),
            "longitude": (-70 - F.col("user_id") % 5).cast("double"),
            FD.STATION_PARTITION: _requested_station(),
            "_page": F.floor(F.col("event_id") / PAGE_SIZE),
        }
    )
    docs = FD.render_documents(FD.render_features(obs, extra=("_page",)), F.col("_page"))
    parsed = FD.parse_features(
        FD.explode_documents(docs),
        fetched_at=FX.PULL_AS_OF[3],
        source_url=F.concat(F.lit("landing://station="), F.col(FD.STATION_PARTITION)),
    )
    return parsed.drop("raw_payload_json")


def feed_lenient(spark, sf_dir):
    """SRC3-4, SRC6-7: bad numbers, short or missing coordinates, weather lists, kept payload."""
    eid = F.col("event_id").cast("string")
    n = F.col("event_id")
    value = F.when(n % 19 == 0, F.lit('"n/a"')).when(n % 23 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), eid, F.lit('.5"')))
    geometry = (
        F.when(n % 5 == 0, F.lit('{"coordinates":[-70]}')).when(n % 7 == 0, F.lit("null")).otherwise(F.lit('{"coordinates":[-70,40.25,3]}'))
    )
    weather = F.array_join(F.array_repeat(F.lit('"rain"'), (n % 4).cast("int")), ",")
    feature = F.concat(
        F.lit('{"geometry":'), geometry, F.lit(',"extra":'), eid, F.lit(',"properties":{"@id":"f-'), eid,
        F.lit('","timestamp":"2024-01-01T00:00:00Z","temperature":{"value":'), value,
        F.lit('},"presentWeather":['), weather, F.lit("]}}"),
    )
    rows = _events(spark, sf_dir).select(F.lit(FX.STATION_CODES[0]).alias(FD.STATION_PARTITION), feature.alias("feature"))
    return FD.parse_features(rows).select(
        "source_record_id", "temperature_c", "latitude", "longitude", "present_weather_count", "raw_payload_json"
    )


def station_dim_join(spark, sf_dir):
    """JOIN5: the station name from a dimension frame, joined; one code is missing from it."""
    events = _events(spark, sf_dir)
    stations = (
        FX.observations(events, keep=("user_id",))
        .select(_requested_station().alias("station_id"))
        .where(F.col("station_id") != FX.STATION_CODES[-1])
        .distinct()
        .withColumn("station_name", F.concat(F.lit("Dim "), F.col("station_id")))
    )
    rows = FX.observations(events, keep=("user_id",)).select(
        "source_record_id", _requested_station().alias("_requested"), F.when(F.col("event_id") % 7 != 0, F.col("station_name")).alias("_feed_name")
    )
    return FD.resolve_station(rows, stations)


# --- layers ------------------------------------------------------------------------------

def _layer_query(layer: str, n: int):
    def run(spark, sf_dir):
        return published(spark, sf_dir).as_of(layer, f"T{n}")

    run.__doc__ = f"SNP4: {layer} as of T{n}, from the published store"
    return run


def gold_all_snapshots(spark, sf_dir):
    """Gold of T1, T2 and T3 in one pass over the log (running sums per gold group over ``seq``)."""
    return gold_history(published(spark, sf_dir).store.log(), len(FX.PULL_AS_OF))


def _unseen(spark: SparkSession, sf_dir: str, store, pull: int, seq: int, rows: int | None = None) -> DataFrame:
    """DED1 + JOIN3 the way a refresh does it: a pull anti-joined to the ids published up to ``seq``."""
    bronze = FX.bronze_pulls(_events(spark, sf_dir)).where(F.col("pull") == pull).drop("pull")
    return L.unseen(keep_first(bronze, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST), store.history_ids(seq), rows)


def _incremental(rows: int | None = None):
    def run(spark, sf_dir):
        return _unseen(spark, sf_dir, published(spark, sf_dir).store, 3, 2, rows)

    run.__doc__ = "DED1, JOIN3: what pull 3 adds to T2, " + ("history shuffled" if rows else "ids broadcast")
    return run


def incremental_t3_id_index(spark, sf_dir):
    """JOIN3: what pull 3 adds to T2 whose ids lie in two generations, of 4 and of 8 buckets."""
    root = publish(spark, sf_dir, shared_dir(spark, "generations"), (1, 2), id_buckets={1: 4, 2: 8})
    return _unseen(spark, sf_dir, Explorer(spark, root).store, 3, 2, L.BROADCAST_ID_LIMIT + 1)


def no_change_check(spark, sf_dir):
    """JOIN4: each pull anti-joined to every published snapshot from the one before it, as a refresh would."""
    store, last, out = published(spark, sf_dir).store, len(FX.PULL_AS_OF), []
    for pull in FX.PULL_AS_OF:
        for seq in range(max(pull - 1, 1), last + 1):
            new = _unseen(spark, sf_dir, store, pull, seq).agg(F.count("*").alias("unknown_ids"))
            out.append(new.select(F.lit(pull).alias("pull"), F.lit(seq).alias("against_seq"), "unknown_ids"))
    counts = reduce(DataFrame.union, out)
    return counts.withColumn("status", F.when(F.col("unknown_ids") == 0, "NO_CHANGE").otherwise("CREATED"))


def first_snapshot_rows(spark, sf_dir):
    """DED1: the rows of a first pull that holds each observation twice, and once more each a microsecond later,
    with an empty text for a null one, and with the other zero; what the log then has of them."""
    obs = L.to_bronze(FX.observations(_events(spark, sf_dir)), "identity", FX.PULL_AS_OF[1])
    obs = obs.withColumns({"dewpoint_c": F.hour("timestamp") * F.lit(0.0), "icon": F.lit(None).cast("string")})
    zero = F.when(F.col("_n") == 4, -F.col("dewpoint_c")).otherwise(F.col("dewpoint_c"))
    later = F.when(F.col("_n") == 2, F.col("timestamp") + F.expr("INTERVAL 0.000001 SECOND")).otherwise(F.col("timestamp"))
    pull = obs.withColumn("_n", F.explode(F.array(*[F.lit(n) for n in range(5)]))).withColumns(
        {"dewpoint_c": zero, "timestamp": later, "icon": F.when(F.col("_n") == 3, F.lit("")).otherwise(F.col("icon"))}
    )
    log = flag_first_distinct(pull.drop("_n"), L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
    return log.select(
        "source_record_id", "timestamp", "icon", F.col("dewpoint_c").cast("string").alias("dewpoint"), "copies"
    )


def gold_exact_averages(spark, sf_dir):
    """GRP1: averages of fractional readings, merged over three refreshes."""
    root, events = shared_dir(spark, "fractions"), _events(spark, sf_dir)
    for pull, as_of in FX.PULL_AS_OF.items():
        raw = FX.pull_frame(events, pull)
        third = {c: F.col(c) / 3 for c in ("temperature_c", "wind_speed_kmh", "pressure_pa")}
        refresh_snapshot(spark, root, raw.withColumns(third), as_of, FX.FIXTURE_SOURCE_NAME, FX.STATION_CODES)
    gold = Explorer(spark, root).as_of("gold", f"T{CURRENT}")
    return gold.select(*S.GOLD_KEYS, *[c for c in gold.columns if c.startswith("avg_")])


# --- comparison panel ----------------------------------------------------------------------

def _pair(spark: SparkSession, sf_dir: str, layer: str, previous: int = PREVIOUS) -> tuple[DataFrame, DataFrame]:
    ex = published(spark, sf_dir)
    return ex.as_of(layer, f"T{CURRENT}"), ex.as_of(layer, f"T{previous}")


def _panel(layer: str, option: int, previous: int = PREVIOUS, limit: int | None = None):
    """A canned query (Q1, Q2/Q3, Q4) through ``Explorer.query``, with its rewrites."""
    def run(spark, sf_dir):
        return published(spark, sf_dir).query(layer, S.QUERY_OPTIONS[option], f"T{previous}", limit=limit)[1]

    return run


def _panel_sql(layer: str, option: int):
    """The same from the SQL text that the panel shows."""
    def run(spark, sf_dir):
        text = published(spark, sf_dir).query(layer, S.QUERY_OPTIONS[option])[0]
        return published(spark, sf_dir).query(layer, "custom", custom_sql=text)[1]

    return run


def _except(layer: str, ignore: tuple[str, ...] = (), previous: int = PREVIOUS):
    def run(spark, sf_dir):
        cur, prev = _pair(spark, sf_dir, layer, previous)
        return QP.show_new_records(cur, prev, ignore=ignore)

    return run


def _compare_scan(layer: str):
    def run(spark, sf_dir):
        return QP.compare_changes(*_pair(spark, sf_dir, layer), layer)

    return run


def _aggregate_scan(layer: str, n: int = CURRENT):
    def run(spark, sf_dir):
        return QP.aggregate_by_partition(published(spark, sf_dir).as_of(layer, f"T{n}"), layer)

    return run


def preview(spark, sf_dir):
    """TOP2: first 25 gold rows of each side."""
    return published(spark, sf_dir).preview("gold", f"T{PREVIOUS}", f"T{CURRENT}")


def custom_sql(spark, sf_dir):
    """SQL1: free SQL over ``current_data`` / ``previous_data`` (gold T3 vs T2)."""
    return published(spark, sf_dir).query("gold", "custom", custom_sql=CUSTOM_SQL)[1]


# --- catalog ---------------------------------------------------------------------------------

def snapshot_metrics(spark, sf_dir):
    """SNP8 as recorded by the refresh runs."""
    return published(spark, sf_dir).metrics().drop("processing_time_ms")


def scan_comparison(spark, sf_dir):
    return published(spark, sf_dir).scan_comparison()


def layer_counts(spark, sf_dir):
    return published(spark, sf_dir).layer_counts()


def snapshot_list(spark, sf_dir):
    return published(spark, sf_dir).snapshots()


def default_pair(spark, sf_dir):
    return CV.default_pair(published(spark, sf_dir).catalog())


def refresh_due(spark, sf_dir):
    return CV.due_after_each(published(spark, sf_dir).catalog())


# --- the refresh job and the stream --------------------------------------------------------

def _land(spark: SparkSession, sf_dir: str, path: str, where: Column) -> None:
    """Observations rendered as feed documents, landed as files under ``path``."""
    obs = FX.observations(_events(spark, sf_dir), keep=("user_id",)).where(where)
    obs = obs.withColumns({FD.STATION_PARTITION: _requested_station(), "_page": F.floor(F.col("event_id") / 2000)})
    FD.write_landing(FD.render_documents(FD.render_features(obs, extra=("_page",)), F.col("_page")), path)


def landing_refresh(spark, sf_dir):
    """SRC1, SRC9, SNP7: documents land twice; each scheduled run publishes all that is new, and no more."""
    root = shared_dir(spark, "landing-refresh")
    early = F.col("event_id") % 2 == 0
    for at, where in ((FX.PULL_AS_OF[1], early), (FX.PULL_AS_OF[2], ~early)):
        _land(spark, sf_dir, f"{root}/landing", where)
        refresh_if_due(spark, root, f"{root}/landing", at)
    rows = Explorer(spark, root).as_of("bronze", "T2")
    return rows.select("source_record_id", "station_id", "station_name", "timestamp", "temperature_c", "ingest_ts")


def landing_stream(spark, sf_dir):
    """SRC1, STR1: the same landings as a stream of documents, drained after each."""
    root = shared_dir(spark, "landing-stream")
    early = F.col("event_id") % 2 == 0
    for at, where in ((FX.PULL_AS_OF[1], early), (FX.PULL_AS_OF[2], ~early)):
        _land(spark, sf_dir, f"{root}/landing", where)
        ingest.stream_documents(spark, root, f"{root}/landing", lambda at=at: at).awaitTermination()
    rows = Explorer(spark, root).as_of("bronze", "T2")
    return rows.select("source_record_id", "station_id", "station_name", "timestamp", "temperature_c", "ingest_ts")


def partial_runs(spark, sf_dir):
    """SRC9, SRC10, SNP7: one landing, taken by a run for one station, one for the newest 72 of each other, one for
    all that is left, and one that finds nothing open; the rows by the run that published them, and their outcomes."""
    root = shared_dir(spark, "partial-runs")
    _land(spark, sf_dir, f"{root}/landing", F.lit(True))
    one = [FX.STATION_CODES[0]]
    runs = ((FX.PULL_AS_OF[1], one, None), (FX.PULL_AS_OF[2], None, S.DEFAULT_LIVE_LIMIT), (FX.PULL_AS_OF[3], None, None), ("2024-03-01T00:00:00+00:00", None, None))
    outcomes = [refresh_if_due(spark, root, f"{root}/landing", at, stations, limit, force=True) for at, stations, limit in runs]
    said = spark.createDataFrame(
        [(at, d.status, d.dropped, d.unread > 0) for (at, _, _), d in zip(runs, outcomes, strict=True)],
        "ingest_ts string, status string, left_out long, documents_left boolean",
    )
    rows = Explorer(spark, root).as_of("bronze", "T3").groupBy("ingest_ts").agg(F.count("*").alias("rows"), F.count_distinct(L.KEY).alias("ids"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "ids")]
    return said.join(rows, "ingest_ts", "left").select("ingest_ts", "status", "left_out", "documents_left", *counts)


def _replayed(read: Callable[[Explorer], DataFrame]):
    """All three refreshes run anew, into a store of their own."""
    def run(spark, sf_dir):
        return read(Explorer(spark, publish(spark, sf_dir, shared_dir(spark, "replay"))))

    run.__doc__ = "SNP1, SNP7: read after three refreshes that this query runs"
    return run


def refresh_outcomes(spark, sf_dir):
    """SNP6-7: every outcome of the job, and the rows published after each."""
    root, events = shared_dir(spark, "outcomes"), _events(spark, sf_dir)
    pull1, pull2 = (FX.pull_frame(events, n) for n in (1, 2))
    first, second = (FX.PULL_AS_OF[n] for n in (1, 2))
    steps = (
        ("empty", lambda: refresh_snapshot(spark, root, pull1.where(F.lit(False)), first)),
        ("first", lambda: refresh_snapshot(spark, root, pull1, first)),
        ("same again", lambda: refresh_snapshot(spark, root, pull1, second)),
        ("too early", lambda: refresh_if_due(spark, root, f"{root}/landing", first)),
        ("nothing landed", lambda: refresh_if_due(spark, root, f"{root}/landing", second)),
        ("second", lambda: refresh_snapshot(spark, root, pull2, second)),
    )
    out = []
    for name, run in steps:
        done = run()
        out.append((name, done.status, done.entry["row_counts"]["bronze"] if done.entry else 0))
    return spark.createDataFrame(out, "step string, status string, bronze_rows long")


def rebuild_then_refresh(spark, sf_dir):
    """PRJ6, SNP1: thresholds given to a rebuild hold for later refreshes too; gold of T3."""
    root = publish(spark, sf_dir, shared_dir(spark, "rebuilt"), (1, 2))
    rebuild(spark, root, gust_limit=30.0)
    publish(spark, sf_dir, root, (3,))
    return Explorer(spark, root).as_of("gold", "T3")


def compact_then_refresh(spark, sf_dir):
    """SNK2: two snapshots compacted into one span, a third published after it; silver as of T2 and new rows of T3."""
    root = publish(spark, sf_dir, shared_dir(spark, "compacted"), (1, 2))
    compact(spark, root)
    publish(spark, sf_dir, root, (3,))
    ex = Explorer(spark, root)
    return ex.as_of("silver", "T2").unionByName(ex.new_records("silver", "T2", "T3"))


def stream_replay_bronze_t3(spark, sf_dir):
    """STR1: pulls of several files, one announcement for each trigger, one pull landed twice; bronze as of T3."""
    root, events, source = shared_dir(spark, "stream-replay"), _events(spark, sf_dir), FX.FIXTURE_SOURCE_NAME
    for landed in ((1, 2), (2, 3)):
        for pull in landed:
            raw = FX.pull_frame(events, pull).repartition(3, "source_record_id")
            ingest.land_pull(spark, root, raw, FX.PULL_AS_OF[pull], source, FX.STATION_CODES)
        ingest.start_ingest(spark, root, source, max_pulls_per_trigger=1).awaitTermination()
    return Explorer(spark, root).as_of("bronze", "T3")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "obs_required_fields": obs_required_fields,
    "latest_n_per_station": latest_n_per_station,
    "station_dim": station_dim,
    "station_dim_join": station_dim_join,
    "feed_parse": feed_parse,
    "feed_lenient": feed_lenient,
    **{f"{layer}_t{n}": _layer_query(layer, n) for layer in S.LAYERS for n in (1, 2, 3)},
    "incremental_t3": _incremental(),
    "incremental_t3_shuffled": _incremental(rows=L.BROADCAST_ID_LIMIT + 1),
    "incremental_t3_id_index": incremental_t3_id_index,
    "first_snapshot_rows": first_snapshot_rows,
    "gold_exact_averages": gold_exact_averages,
    "no_change_check": no_change_check,
    "gold_all_snapshots": gold_all_snapshots,
    "new_records_bronze": _panel("bronze", 0),
    "new_records_bronze_except": _except("bronze"),
    "new_records_silver": _panel("silver", 0),
    "new_records_gold": _panel("gold", 0),
    "new_records_gold_ignore_updated_at": _except("gold", ignore=("updated_at",)),
    "new_records_bronze_t1_t3": _panel("bronze", 0, previous=1),
    "new_records_bronze_t1_t3_except": _except("bronze", previous=1),
    "new_records_silver_t1_t3": _panel("silver", 0, previous=1),
    "compare_gold": _panel("gold", 1),
    "compare_gold_sql_text": _panel_sql("gold", 1),
    "compare_gold_t1_t3": _panel("gold", 1, previous=1),
    "compare_silver": _compare_scan("silver"),
    "compare_silver_sql_text": _panel_sql("silver", 1),
    "compare_bronze": _compare_scan("bronze"),
    "compare_silver_via_gold": _panel("silver", 1),
    "compare_gold_top200": _panel("gold", 1, limit=S.RESULT_LIMIT),
    "aggregate_gold": _panel("gold", 2),
    "aggregate_silver": _aggregate_scan("silver"),
    "aggregate_bronze": _aggregate_scan("bronze"),
    "aggregate_bronze_t1": _aggregate_scan("bronze", 1),
    "aggregate_bronze_via_gold": _panel("bronze", 2),
    "aggregate_silver_sql_text": _panel_sql("silver", 2),
    "preview": preview,
    "custom_sql": custom_sql,
    "snapshot_metrics": snapshot_metrics,
    "scan_comparison": scan_comparison,
    "layer_counts": layer_counts,
    "snapshot_list": snapshot_list,
    "default_pair": default_pair,
    "refresh_due": refresh_due,
    "refresh_replay_gold_t3": _replayed(lambda ex: ex.as_of("gold", f"T{CURRENT}")),
    "refresh_replay_metrics": _replayed(lambda ex: ex.metrics().drop("processing_time_ms")),
    "refresh_outcomes": refresh_outcomes,
    "landing_refresh": landing_refresh,
    "landing_stream": landing_stream,
    "partial_runs": partial_runs,
    "rebuild_then_refresh": rebuild_then_refresh,
    "compact_then_refresh": compact_then_refresh,
    "stream_replay_bronze_t3": stream_replay_bronze_t3,
}
