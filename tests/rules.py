"""What FIXTURES.md's rules say of some pulls, worked out id by id and group by group in plain Python."""

from collections import defaultdict


def published(pulls: dict[int, list[dict]]) -> dict[int, dict[str, list[dict]]]:
    """Per published pull: bronze rows, one row for each id (silver), and gold groups.

    An id belongs to the first pull that has it, and is stood for by its earliest row there
    (null stations last). Only the first pull's own view shows an id's other rows.
    """
    stands: dict[str, dict] = {}
    out = {}
    for n in sorted(pulls):
        arrived = [r for r in pulls[n] if r["source_record_id"] not in stands]
        for r in sorted(arrived, key=lambda r: (r["timestamp"], r["station_id"] is None, r["station_id"] or "")):
            stands.setdefault(r["source_record_id"], r | {"pull": n})
        if out and not arrived:
            continue  # nothing new: no snapshot
        first = not out
        fresh = arrived if first else [r for r in stands.values() if r["pull"] == n]
        out[n] = {
            "bronze": list(pulls[n]) if first else list(stands.values()),
            "silver": list(stands.values()),
            "gold": gold(list(stands.values()), fresh),
        }
    return out


def flags(r: dict) -> tuple[str, bool]:
    whole = None not in (r["temperature_c"], r["pressure_pa"], r["humidity_pct"])
    odd = (
        (r["wind_gust_kmh"] is not None and r["wind_gust_kmh"] > 70)
        or (r["pressure_pa"] is not None and r["pressure_pa"] < 98000)
        or (r["temperature_c"] is not None and not -25 <= r["temperature_c"] <= 38)
    )
    return ("PASS" if whole else "REVIEW"), odd


def gold(rows: list[dict], fresh: list[dict]) -> list[dict]:
    groups = defaultdict(list)
    for r in rows:
        groups[(f"{r['timestamp']:%Y-%m-%d}", r["station_id"], r["station_name"])].append(r)

    def mean(members, name):
        known = [r[name] for r in members if r[name] is not None]
        return sum(known) / len(known) if known else None

    out = []
    for (day, station, name), members in groups.items():
        gusts = [r["wind_gust_kmh"] for r in members if r["wind_gust_kmh"] is not None]
        new = [r for r in fresh if station is not None and r["station_id"] == station and f"{r['timestamp']:%Y-%m-%d}" == day]
        out.append(
            {
                "partition_date": day,
                "station_id": station,
                "station_name": name,
                "rows_processed": len(members),
                "new_records": len(new),
                "anomaly_count": sum(flags(r)[1] for r in members),
                "avg_temperature_c": mean(members, "temperature_c"),
                "avg_wind_speed_kmh": mean(members, "wind_speed_kmh"),
                "max_wind_gust_kmh": max(gusts) if gusts else None,
                "avg_pressure_pa": mean(members, "pressure_pa"),
                "first_seen": min(r["timestamp"] for r in members),
                "last_seen": max(r["timestamp"] for r in members),
            }
        )
    return out


def rounded(v):
    return round(v, 6) if isinstance(v, float) else v


def as_rows(dicts, columns):
    return sorted((tuple(rounded(d[c]) for c in columns) for d in dicts), key=str)


RAW_SHOWN = ["source_record_id", "station_id", "station_name", "timestamp", "temperature_c", "wind_gust_kmh"]
GOLD_SHOWN = [
    "partition_date", "station_id", "station_name", "rows_processed", "new_records", "anomaly_count", "avg_temperature_c",
    "avg_wind_speed_kmh", "max_wind_gust_kmh", "avg_pressure_pa", "first_seen", "last_seen",
]


def check(explorer, snapshot_id: str, want: dict[str, list[dict]]) -> None:
    """All three layers of a published snapshot against ``published``."""
    for layer in ("bronze", "silver"):
        got = [r.asDict() for r in explorer.as_of(layer, snapshot_id).collect()]
        assert as_rows(got, RAW_SHOWN) == as_rows(want[layer], RAW_SHOWN), layer
    got = {r.source_record_id: (r.quality_flag, r.anomaly_flag, r.incremental_partition) for r in explorer.as_of("silver", snapshot_id).collect()}
    for r in want["silver"]:
        key = None if r["station_id"] is None else f"{r['timestamp']:%Y-%m-%d}|{r['station_id']}"
        assert got[r["source_record_id"]] == (*flags(r), key)
    got = [r.asDict() for r in explorer.as_of("gold", snapshot_id).collect()]
    assert as_rows(got, GOLD_SHOWN) == as_rows(want["gold"], GOLD_SHOWN)
