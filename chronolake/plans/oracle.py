"""DuckDB SQL that states what each registered query must return (the correctness oracle).

The oracle follows FIXTURES.md literally -- window functions (``row_number``/``min`` over
the id), full recomputation of every snapshot -- while the Spark side uses the skew-safe
aggregate/join formulation and the log rewrites. Agreement of the two is the check.
"""

from __future__ import annotations

from chronolake import schemas as S
from chronolake.sources import fixture as FX

RAW = S.RAW_COLUMNS
BRONZE = S.BRONZE_COLUMNS


def q(name: str) -> str:
    return f'"{name}"'


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{q(n)}" for n in names)


_STATION_CASE = (
    "CASE user_id % 5 "
    + " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(FX.STATION_CODES[:-1]))
    + f" ELSE '{FX.STATION_CODES[-1]}' END"
)
_AS_OF_CASE = (
    "CASE pull " + " ".join(f"WHEN {p} THEN '{t}'" for p, t in FX.PULL_AS_OF.items()) + " END"
)

OBS = f"""obs AS (
  SELECT event_id, user_id,
    'obs-' || CAST(event_id AS VARCHAR) AS source_record_id,
    CASE WHEN event_id % 997 = 0 THEN NULL ELSE {_STATION_CASE} END AS station_id,
    CASE WHEN event_id % 53 = 0 THEN 'Renamed ' ELSE 'Station ' END || CAST(user_id % 5 AS VARCHAR) AS station_name,
    ts AS "timestamp",
    event_type AS text_description,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 7) % 70 - 28 AS DOUBLE) END AS temperature_c,
    CAST(NULL AS DOUBLE) AS dewpoint_c,
    CAST(NULL AS DOUBLE) AS wind_direction_deg,
    CAST(floor(value) AS DOUBLE) AS wind_speed_kmh,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value / 4) + 10 AS DOUBLE) END AS wind_gust_kmh,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(97900 + (event_id * 13) % 4000 AS DOUBLE) END AS pressure_pa,
    CAST(NULL AS DOUBLE) AS visibility_m,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 101 AS DOUBLE) END AS humidity_pct,
    CAST(NULL AS DOUBLE) AS elevation_m,
    CAST(NULL AS DOUBLE) AS latitude,
    CAST(NULL AS DOUBLE) AS longitude,
    CAST(NULL AS VARCHAR) AS raw_message,
    CAST(NULL AS VARCHAR) AS icon,
    CAST(0 AS INTEGER) AS present_weather_count,
    CAST(NULL AS VARCHAR) AS fetched_at,
    '{FX.FIXTURE_SOURCE_URL}' AS source_url,
    CAST(NULL AS VARCHAR) AS raw_payload_json
  FROM events)"""

_NO_TS = [c for c in RAW if c not in ("timestamp", "fetched_at")]
_SEL = f'{cols(_NO_TS)}, "timestamp"'
_SEL_SHIFT = f'{cols(_NO_TS)}, "timestamp" + INTERVAL 1 SECOND AS "timestamp"'
PULLS = f"""pull_rows AS (
  SELECT 1 AS pull, {_SEL} FROM obs
    WHERE "timestamp" < TIMESTAMP '{FX.PULL1_END}' AND event_id % 101 <> 0
  UNION ALL
  SELECT 1 AS pull, {_SEL_SHIFT} FROM obs
    WHERE "timestamp" < TIMESTAMP '{FX.PULL1_END}' AND event_id % 101 <> 0 AND event_id % 29 = 0
  UNION ALL
  SELECT 2 AS pull, {_SEL} FROM obs
    WHERE "timestamp" >= TIMESTAMP '{FX.PULL2_START}' AND "timestamp" < TIMESTAMP '{FX.PULL2_END}'
      AND event_id % 101 <> 0
  UNION ALL
  SELECT 3 AS pull, {_SEL} FROM obs
    WHERE "timestamp" >= TIMESTAMP '{FX.PULL3_START}' OR event_id % 101 = 0
),
bronze_rows AS (
  SELECT pull, {cols([c for c in RAW if c != "fetched_at"])}, {_AS_OF_CASE} AS fetched_at,
    '{FX.FIXTURE_SOURCE_NAME}' AS source_name,
    {_AS_OF_CASE} AS ingest_ts,
    strftime("timestamp", '%Y-%m-%d') AS partition_date,
    station_id AS partition_station
  FROM pull_rows
),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY source_record_id
                       ORDER BY pull, "timestamp", station_id NULLS LAST) AS keep_rank,
    min(pull) OVER (PARTITION BY source_record_id) AS first_pull
  FROM bronze_rows
),
bronze_log AS (
  SELECT {cols(BRONZE)}, first_pull AS seq, keep_rank
  FROM ranked WHERE pull = first_pull AND (pull = 1 OR keep_rank = 1)
)"""

BASE = f"WITH {OBS},\n{PULLS}"


def bronze(n: int) -> str:
    where = "seq = 1" if n == 1 else f"seq <= {n} AND keep_rank = 1"
    return f"SELECT {cols(BRONZE)} FROM bronze_log WHERE {where}"


def increment(n: int) -> str:
    return f"SELECT {cols(BRONZE)} FROM bronze_log WHERE seq = {n}"


def silver(n: int, gust: int = 70) -> str:
    return f"""SELECT {cols(BRONZE)},
    strftime("timestamp", '%Y-%m-%d') AS observation_date,
    date_trunc('hour', "timestamp") AS observation_hour,
    CASE WHEN temperature_c IS NOT NULL AND pressure_pa IS NOT NULL AND humidity_pct IS NOT NULL
         THEN 'PASS' ELSE 'REVIEW' END AS quality_flag,
    (coalesce(wind_gust_kmh, 0) > {gust} OR coalesce(pressure_pa, 101325) < 98000
     OR coalesce(temperature_c, 0) > 38 OR coalesce(temperature_c, 0) < -25) AS anomaly_flag,
    strftime("timestamp", '%Y-%m-%d') || '|' || station_id AS incremental_partition
  FROM bronze_log WHERE seq <= {n} AND keep_rank = 1"""


def gold(n: int, gust: int = 70) -> str:
    return f"""SELECT g.partition_date, g.station_id, g.station_name, g.rows_processed,
    coalesce(c.new_records, 0) AS new_records, g.anomaly_count, g.avg_temperature_c,
    g.avg_wind_speed_kmh, g.max_wind_gust_kmh, g.avg_pressure_pa, g.first_seen, g.last_seen,
    '{FX.PULL_AS_OF[n]}' AS updated_at
  FROM (
    SELECT observation_date AS partition_date, station_id, station_name,
      count(source_record_id) AS rows_processed,
      CAST(sum(CAST(anomaly_flag AS INTEGER)) AS BIGINT) AS anomaly_count,
      avg(temperature_c) AS avg_temperature_c,
      avg(wind_speed_kmh) AS avg_wind_speed_kmh,
      max(wind_gust_kmh) AS max_wind_gust_kmh,
      avg(pressure_pa) AS avg_pressure_pa,
      min("timestamp") AS first_seen,
      max("timestamp") AS last_seen
    FROM ({silver(n, gust)}) s
    GROUP BY observation_date, station_id, station_name
  ) g
  LEFT JOIN (
    SELECT strftime("timestamp", '%Y-%m-%d') AS partition_date, station_id,
      count(source_record_id) AS new_records
    FROM ({increment(n)}) i
    WHERE station_id IS NOT NULL
    GROUP BY 1, 2
  ) c ON g.partition_date = c.partition_date AND g.station_id = c.station_id"""


def layer(name: str, n: int) -> str:
    return {"bronze": bronze, "silver": silver, "gold": gold}[name](n)


def with_base(body: str, **ctes: str) -> str:
    extra = "".join(f",\n{k} AS ({v})" for k, v in ctes.items())
    return f"{BASE}{extra}\n{body}"


# --- per-query SQL ----------------------------------------------------------------------

def obs_required_fields() -> str:
    # The feed text carries no id on every 89th event and an unparseable time on every
    # 61st (other offsets parse back to the same instant); rows missing either required
    # field are dropped.
    return f"""WITH {OBS},
feed AS (
  SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE source_record_id END AS feed_id,
         CASE WHEN event_id % 61 = 0 THEN NULL ELSE "timestamp" END AS parsed_ts
  FROM obs
)
SELECT feed_id AS source_record_id, parsed_ts AS "timestamp"
FROM feed WHERE feed_id IS NOT NULL AND parsed_ts IS NOT NULL"""


def latest_n_per_station(limit: int = S.DEFAULT_LIVE_LIMIT) -> str:
    return f"""WITH {OBS}
SELECT * FROM (
  SELECT source_record_id, station_id, station_name, "timestamp",
    CAST(row_number() OVER (PARTITION BY station_id ORDER BY "timestamp" DESC, source_record_id)
         AS INTEGER) AS recency_rank
  FROM obs) r
WHERE recency_rank <= {limit}"""


def station_dim() -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in S.STATION_OPTIONS.items())
    return f"""WITH {OBS}
SELECT source_record_id,
  coalesce(station_id, {_STATION_CASE}) AS station_id,
  coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE station_name END,
           CASE {_STATION_CASE} {names} END) AS station_name
FROM obs"""


def feed_parse() -> str:
    keep = [c for c in RAW if c not in ("station_id", "latitude", "longitude", "fetched_at", "source_url", "raw_payload_json")]
    return f"""WITH {OBS}
SELECT {cols([c for c in keep if c != "source_record_id"])}, source_record_id,
  coalesce(station_id, {_STATION_CASE}) AS station_id,
  CAST(40 + user_id % 5 AS DOUBLE) AS latitude,
  CAST(-70 - user_id % 5 AS DOUBLE) AS longitude,
  '{FX.PULL_AS_OF[3]}' AS fetched_at,
  'landing://station=' || {_STATION_CASE} AS source_url
FROM obs"""


def feed_lenient() -> str:
    # Numbers that are no numbers and coordinates that are not there read as null; the
    # payload is kept as it came, unknown fields included.
    return """SELECT 'f-' || event_id AS source_record_id,
  CASE WHEN event_id % 19 = 0 OR event_id % 23 = 0 THEN NULL ELSE CAST(event_id || '.5' AS DOUBLE) END AS temperature_c,
  CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE 40.25::DOUBLE END AS latitude,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 = 0 THEN NULL ELSE -70::DOUBLE END AS longitude,
  CAST(event_id % 4 AS INTEGER) AS present_weather_count,
  '{"geometry":' || CASE WHEN event_id % 5 = 0 THEN '{"coordinates":[-70]}' WHEN event_id % 7 = 0 THEN 'null'
    ELSE '{"coordinates":[-70,40.25,3]}' END || ',"extra":' || event_id || ',"properties":{"@id":"f-' || event_id
    || '","timestamp":"2024-01-01T00:00:00Z","temperature":{"value":' || CASE WHEN event_id % 19 = 0 THEN '"n/a"'
    WHEN event_id % 23 = 0 THEN 'null' ELSE '"' || event_id || '.5"' END || '},"presentWeather":['
    || array_to_string(list_resize(CAST([] AS VARCHAR[]), event_id % 4, '"rain"'), ',') || ']}}' AS raw_payload_json
FROM events"""


def station_dim_join() -> str:
    return f"""WITH {OBS}
SELECT source_record_id, coalesce(CASE WHEN event_id % 7 = 0 THEN NULL ELSE station_name END,
  CASE WHEN {_STATION_CASE} = '{FX.STATION_CODES[-1]}' THEN '{FX.STATION_CODES[-1]}' ELSE 'Dim ' || {_STATION_CASE} END) AS station_name
FROM obs"""


def landing_refresh() -> str:
    return f"""WITH {OBS}
SELECT source_record_id, coalesce(station_id, {_STATION_CASE}) AS station_id, station_name, "timestamp", temperature_c,
  CASE WHEN event_id % 2 = 0 THEN '{FX.PULL_AS_OF[1]}' ELSE '{FX.PULL_AS_OF[2]}' END AS ingest_ts
FROM obs"""


def partial_runs() -> str:
    """Every observation is published once: its station's run, or the newest of its station, or the rest."""
    t = FX.PULL_AS_OF
    # The document's station, not the row's: a null station id is filled from the folder, so both agree.
    return f"""WITH {OBS}, d AS (
  SELECT source_record_id, user_id % 5 AS station, row_number() OVER (PARTITION BY user_id % 5 ORDER BY "timestamp" DESC, source_record_id) AS n FROM obs
), r AS (
  SELECT CASE WHEN station = 0 THEN '{t[1]}' WHEN n <= {S.DEFAULT_LIVE_LIMIT} THEN '{t[2]}' ELSE '{t[3]}' END AS ingest_ts, source_record_id FROM d
), c AS (
  SELECT ingest_ts, count(*) AS rows, count(DISTINCT source_record_id) AS ids FROM r GROUP BY ingest_ts
)
SELECT '{t[1]}' AS ingest_ts, 'CREATED' AS status, 0::BIGINT AS left_out, true AS documents_left, rows, ids FROM c WHERE ingest_ts = '{t[1]}'
UNION ALL SELECT '{t[2]}', 'CREATED', (SELECT rows FROM c WHERE ingest_ts = '{t[3]}'), false, rows, ids FROM c WHERE ingest_ts = '{t[2]}'
UNION ALL SELECT '{t[3]}', 'CREATED', 0, false, rows, ids FROM c WHERE ingest_ts = '{t[3]}'
UNION ALL SELECT '2024-03-01T00:00:00+00:00', 'SKIPPED', 0, false, 0, 0"""


def first_snapshot_rows() -> str:
    return f"""WITH {OBS}
SELECT source_record_id, "timestamp" + CASE WHEN n = 2 THEN INTERVAL 1 MICROSECOND ELSE INTERVAL 0 MICROSECOND END AS "timestamp",
  CASE WHEN n = 3 THEN '' END AS icon, CASE WHEN n = 4 THEN '-0.0' ELSE '0.0' END AS dewpoint,
  CAST(CASE WHEN n = 1 THEN 2 ELSE 1 END AS BIGINT) AS copies
FROM obs, (SELECT unnest([1, 2, 3, 4]) AS n)"""


def gold_exact_averages() -> str:
    def avg(name: str) -> str:
        return f"CAST(sum(CAST({name} / 3 AS DECIMAL(38, 12))) AS DOUBLE) / count({name}) AS avg_{name}"

    averages = ", ".join(avg(c) for c in ("temperature_c", "wind_speed_kmh", "pressure_pa"))
    return with_base(f"SELECT observation_date AS partition_date, station_id, station_name, {averages} FROM ({silver(3)}) s GROUP BY ALL")


def refresh_outcomes() -> str:
    one, two = (f"(SELECT count(*) FROM ({bronze(n)}) b)" for n in (1, 2))
    steps = (
        ("empty", "SKIPPED", "0"), ("first", "CREATED", one), ("same again", "NO_CHANGE", one),
        ("too early", "SKIPPED_NOT_DUE", one), ("nothing landed", "SKIPPED", one), ("second", "CREATED", two),
    )
    return with_base(" UNION ALL ".join(f"SELECT '{s}' AS step, '{st}' AS status, CAST({n} AS BIGINT) AS bronze_rows" for s, st, n in steps))


def no_change_check() -> str:
    return with_base("""SELECT p.pull, s.seq AS against_seq,
  CAST(count(DISTINCT CASE WHEN k.first_seq IS NULL OR k.first_seq > s.seq
                           THEN p.source_record_id END) AS BIGINT) AS unknown_ids,
  CASE WHEN count(DISTINCT CASE WHEN k.first_seq IS NULL OR k.first_seq > s.seq
                               THEN p.source_record_id END) = 0
       THEN 'NO_CHANGE' ELSE 'CREATED' END AS status
FROM bronze_rows p
JOIN (SELECT DISTINCT seq FROM bronze_log) s ON s.seq >= p.pull - 1 AND s.seq >= 1
LEFT JOIN (SELECT source_record_id, min(seq) AS first_seq FROM bronze_log GROUP BY 1) k
  ON p.source_record_id = k.source_record_id
GROUP BY p.pull, s.seq""")


def catalog_cte() -> str:
    """Per-snapshot facts computed the slow, obvious way (each snapshot in full)."""
    parts = []
    for n in sorted(FX.PULL_AS_OF):
        parts.append(f"""SELECT {n} AS seq, '{FX.PULL_AS_OF[n]}' AS created_at,
    (SELECT count(*) FROM ({bronze(n)}) b) AS full_rows,
    (SELECT count(DISTINCT partition_date) FROM ({bronze(n)}) b) AS full_dates,
    (SELECT count(*) FROM ({increment(n)}) i) AS inc_all,
    (SELECT count(DISTINCT strftime("timestamp", '%Y-%m-%d')) FROM ({increment(n)}) i) AS inc_dates_all,
    (SELECT count(*) FROM ({silver(n)}) s) AS silver_rows,
    (SELECT count(*) FROM ({gold(n)}) g) AS gold_rows""")
    facts = "\n  UNION ALL\n  ".join(parts)
    return f"""SELECT seq, created_at, full_rows, full_dates, silver_rows, gold_rows,
    CASE WHEN seq = 1 THEN full_rows ELSE inc_all END AS inc_rows,
    CASE WHEN seq = 1 OR inc_all = 0 THEN full_dates ELSE inc_dates_all END AS inc_dates
  FROM ({facts}) f"""


def snapshot_metrics() -> str:
    return with_base("""SELECT CAST(seq AS INTEGER) AS seq, 'T' || seq AS snapshot_id,
  CAST(inc_rows AS BIGINT) AS rows_processed,
  CAST(inc_dates AS BIGINT) AS partitions_scanned_incremental,
  CAST(full_dates AS BIGINT) AS partitions_scanned_full,
  CAST(full_rows AS BIGINT) AS full_scan_rows,
  CAST(inc_rows AS BIGINT) AS incremental_scan_rows,
  CASE WHEN full_rows > 0 THEN round(greatest(0.0, (1.0 - inc_rows / full_rows) * 100), 2)
       ELSE 0.0 END AS time_saved_pct
FROM cat""", cat=catalog_cte())


def scan_comparison() -> str:
    return with_base("""SELECT 'T' || seq AS snapshot_id, 'Full scan' AS mode, CAST(full_rows AS BIGINT) AS "rows" FROM cat
UNION ALL
SELECT 'T' || seq, 'Incremental', CAST(inc_rows AS BIGINT) FROM cat""", cat=catalog_cte())


def layer_counts() -> str:
    return with_base("""SELECT 'T' || seq AS snapshot_id, 'bronze' AS layer, CAST(full_rows AS BIGINT) AS row_count FROM cat
UNION ALL SELECT 'T' || seq, 'silver', CAST(silver_rows AS BIGINT) FROM cat
UNION ALL SELECT 'T' || seq, 'gold', CAST(gold_rows AS BIGINT) FROM cat""", cat=catalog_cte())


_SEQS = """cat AS (SELECT seq, max(ingest_ts) AS created_at FROM bronze_log GROUP BY seq)"""


def snapshot_list() -> str:
    return f"""{BASE},
{_SEQS}
SELECT CAST(seq AS INTEGER) AS seq, 'T' || seq AS snapshot_id, created_at,
  'T' || seq || ' (' || replace(substr(created_at, 1, 16), 'T', ' ') || ')' AS label,
  seq = max(seq) OVER () AS is_latest,
  'T' || (max(seq) OVER () + 1) AS next_snapshot_id
FROM cat"""


def default_pair() -> str:
    return f"""{BASE},
{_SEQS}
SELECT (SELECT 'T' || seq FROM cat ORDER BY seq DESC LIMIT 1) AS current_snapshot_id,
  coalesce((SELECT 'T' || seq FROM cat ORDER BY seq DESC LIMIT 1 OFFSET 1),
           (SELECT 'T' || seq FROM cat ORDER BY seq DESC LIMIT 1)) AS previous_snapshot_id"""


def refresh_due() -> str:
    return f"""{BASE},
{_SEQS},
pairs AS (
  SELECT seq, created_at, lead(created_at) OVER (ORDER BY seq) AS checked_at FROM cat
)
SELECT 'T' || seq AS snapshot_id, checked_at,
  date_diff('second', CAST(substr(created_at, 1, 19) AS TIMESTAMP),
                      CAST(substr(checked_at, 1, 19) AS TIMESTAMP)) AS age_seconds,
  date_diff('second', CAST(substr(created_at, 1, 19) AS TIMESTAMP),
                      CAST(substr(checked_at, 1, 19) AS TIMESTAMP)) >= {S.AUTO_REFRESH_MINUTES * 60} AS due,
  date_diff('second', CAST(substr(created_at, 1, 19) AS TIMESTAMP),
                      CAST(substr(checked_at, 1, 19) AS TIMESTAMP)) >= 0 AS due_forced
FROM pairs WHERE checked_at IS NOT NULL"""


def _except(a: str, b: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM ({a}) a EXCEPT SELECT {columns} FROM ({b}) b"


def _compare_gold_sql(previous: int = 2) -> str:
    """Matched pairs of gold rows, then the rows of either snapshot that nothing matches."""
    def unmatched(side: str, other: str, counts: str) -> str:
        return f"""SELECT {side}.partition_date, {side}.station_id, {counts}
  FROM {side} WHERE NOT EXISTS (SELECT 1 FROM {other} o WHERE o.partition_date = {side}.partition_date AND o.station_id = {side}.station_id)"""

    return f"""WITH later AS (SELECT partition_date, station_id, rows_processed AS n FROM ({gold(3)}) g3),
earlier AS (SELECT partition_date, station_id, rows_processed AS n FROM ({gold(previous)}) g2),
matched AS (
  SELECT later.partition_date, later.station_id, later.n AS current_rows, earlier.n AS previous_rows
  FROM later, earlier WHERE later.partition_date = earlier.partition_date AND later.station_id = earlier.station_id
),
appeared AS ({unmatched("later", "earlier", "later.n AS current_rows, 0 AS previous_rows")}),
vanished AS ({unmatched("earlier", "later", "0 AS current_rows, earlier.n AS previous_rows")}),
pairs AS (SELECT * FROM matched UNION ALL SELECT * FROM appeared UNION ALL SELECT * FROM vanished)
SELECT partition_date, station_id, CAST(current_rows AS BIGINT) AS current_rows,
  CAST(previous_rows AS BIGINT) AS previous_rows, CAST(current_rows - previous_rows AS BIGINT) AS delta_rows
FROM pairs"""


def _preview_side(name: str, n: int) -> str:
    rest = [c for c in S.GOLD_COLUMNS if c not in S.GOLD_KEYS]
    order = ", ".join(q(c) for c in S.GOLD_KEYS + rest)
    return f"(SELECT '{name}' AS side, * FROM ({gold(n)}) g ORDER BY {order} LIMIT {S.PREVIEW_ROWS})"


def all_sql(custom_sql_text: str) -> dict[str, str]:
    no_updated = cols([c for c in S.GOLD_COLUMNS if c != "updated_at"])
    new_bronze = with_base(_except(bronze(3), bronze(2)))
    out = {
        "obs_required_fields": obs_required_fields(),
        "latest_n_per_station": latest_n_per_station(),
        "station_dim": station_dim(),
        "feed_parse": feed_parse(),
        "bronze_t1": with_base(bronze(1)),
        "bronze_t2": with_base(bronze(2)),
        "bronze_t3": with_base(bronze(3)),
        "feed_lenient": feed_lenient(),
        "station_dim_join": station_dim_join(),
        "landing_refresh": landing_refresh(),
        "landing_stream": landing_refresh(),
        "compact_then_refresh": with_base(silver(3)),
        "partial_runs": partial_runs(),
        "first_snapshot_rows": first_snapshot_rows(),
        "gold_exact_averages": gold_exact_averages(),
        "refresh_outcomes": refresh_outcomes(),
        "rebuild_then_refresh": with_base(gold(3, 30)),
        "incremental_t3": with_base(increment(3)),
        "incremental_t3_shuffled": with_base(increment(3)),
        "incremental_t3_id_index": with_base(increment(3)),
        "no_change_check": no_change_check(),
        "silver_t1": with_base(silver(1)),
        "silver_t2": with_base(silver(2)),
        "silver_t3": with_base(silver(3)),
        "gold_t1": with_base(gold(1)),
        "gold_t2": with_base(gold(2)),
        "gold_t3": with_base(gold(3)),
        "new_records_bronze": new_bronze,
        "new_records_bronze_except": new_bronze,
        "new_records_silver": with_base(_except(silver(3), silver(2))),
        "new_records_gold": with_base(_except(gold(3), gold(2))),
        "new_records_gold_ignore_updated_at": with_base(_except(gold(3), gold(2), no_updated)),
        "new_records_bronze_t1_t3": with_base(_except(bronze(3), bronze(1))),
        "new_records_bronze_t1_t3_except": with_base(_except(bronze(3), bronze(1))),
        "new_records_silver_t1_t3": with_base(_except(silver(3), silver(1))),
        "compare_gold": with_base(f"SELECT * FROM ({_compare_gold_sql()}) x"),
        "compare_gold_t1_t3": with_base(f"SELECT * FROM ({_compare_gold_sql(1)}) x"),
        "compare_silver": with_base(
            f"SELECT station_id, observation_date AS partition_key, count(*) AS current_rows "
            f"FROM ({silver(3)}) s GROUP BY 1, 2"
        ),
        "compare_bronze": with_base(
            f"SELECT station_id, partition_date AS partition_key, count(*) AS current_rows "
            f"FROM ({bronze(3)}) b GROUP BY 1, 2"
        ),
        "compare_gold_top200": with_base(
            f"SELECT * FROM ({_compare_gold_sql()}) x ORDER BY partition_date DESC, station_id, "
            f"current_rows, previous_rows, delta_rows LIMIT {S.RESULT_LIMIT}"
        ),
        "aggregate_gold": with_base(
            f"SELECT partition_date AS partition_key, CAST(sum(rows_processed) AS BIGINT) AS row_count "
            f"FROM ({gold(3)}) g GROUP BY 1"
        ),
        "aggregate_silver": with_base(
            f"SELECT observation_date AS partition_key, count(*) AS row_count FROM ({silver(3)}) s GROUP BY 1"
        ),
        "aggregate_bronze_t1": with_base(
            f"SELECT partition_date AS partition_key, count(*) AS row_count FROM ({bronze(1)}) b GROUP BY 1"
        ),
        "aggregate_bronze": with_base(
            f"SELECT partition_date AS partition_key, count(*) AS row_count FROM ({bronze(3)}) b GROUP BY 1"
        ),
        "preview": with_base(f"{_preview_side('previous', 2)} UNION ALL {_preview_side('current', 3)}"),
        "custom_sql": with_base(custom_sql_text, current_data=gold(3), previous_data=gold(2)),
        "snapshot_metrics": snapshot_metrics(),
        "scan_comparison": scan_comparison(),
        "layer_counts": layer_counts(),
        "snapshot_list": snapshot_list(),
        "default_pair": default_pair(),
        "refresh_due": refresh_due(),
        "refresh_replay_gold_t3": with_base(gold(3)),
        "refresh_replay_metrics": snapshot_metrics(),
        "stream_replay_bronze_t3": with_base(bronze(3)),
    }
    out["gold_all_snapshots"] = with_base(
        " UNION ALL ".join(f"SELECT CAST({n} AS INTEGER) AS seq, * FROM ({gold(n)}) g{n}" for n in FX.PULL_AS_OF)
    )
    out["compare_gold_sql_text"] = out["compare_gold"]
    out["compare_silver_sql_text"] = out["compare_silver"]
    out["aggregate_silver_sql_text"] = out["aggregate_silver"]
    out["compare_silver_via_gold"] = out["compare_silver"]
    out["aggregate_bronze_via_gold"] = out["aggregate_bronze"]
    return out
