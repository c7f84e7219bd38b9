"""The refresh job: is a snapshot due, and what came of taking one (SNP6, SNP7, JOIN4)."""

from __future__ import annotations

import argparse
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake import schemas as S
from chronolake.operators.topk import latest_per_station
from chronolake.plans.snapshot import build_snapshot
from chronolake.sources import catalog as CAT
from chronolake.sources import feed as FD
from chronolake.sources.reading import cut
from chronolake.sources.store import pull_stamp


@dataclass(frozen=True)
class Refresh:
    """``status``: SKIPPED_NOT_DUE, SKIPPED (empty pull), NO_CHANGE (all ids known) or CREATED.

    ``entry``: the newest catalog entry afterwards. ``dropped``: landed rows that a limit asked
    for by the caller kept out; ``unread``: documents of stations not asked for. Both stay
    open for a later run.
    """

    status: str
    entry: dict | None
    dropped: int = 0
    unread: int = 0

    def __str__(self) -> str:
        newest = f", newest {self.entry['snapshot_id']} of {self.entry['created_at']}" if self.entry else ""
        return f"{self.status}{newest}" + (f", {self.dropped} landed rows left out on request" if self.dropped else "") + (
            f", {self.unread} documents of other stations left for later" if self.unread else ""
        )


def is_due(latest: dict | None, now: str, max_age_minutes: int) -> bool:
    """SNP6: with no snapshot yet always, else from ``max_age_minutes`` after the newest on."""
    if latest is None:
        return True
    age = datetime.fromisoformat(now) - datetime.fromisoformat(latest["created_at"])
    return age >= timedelta(minutes=max_age_minutes)


def refresh_snapshot(spark: SparkSession, root: str, raw: DataFrame, as_of: str, source_name: str = S.DEFAULT_SOURCE_NAME, station_ids: list[str] | None = None, **how) -> Refresh:
    """SNP7: publish ``raw`` as the next snapshot unless it is empty or fully known.

    ``how`` goes to :func:`build_snapshot` (``batch_id``, ``stable_dates``, ``id_buckets``, ``files``, ``run``).
    """
    latest = CAT.latest_entry(CAT.read_catalog(spark, root))
    status, entry = build_snapshot(
        spark, raw, root, as_of, source_name, station_ids, previous=latest, previous_known=True, **how
    )
    return Refresh(status, entry or latest)


def refresh_if_due(
    spark: SparkSession,
    root: str,
    landing_path: str,
    now: str,
    station_ids: list[str] | None = None,
    limit: int | None = None,
    max_age_minutes: int = S.AUTO_REFRESH_MINUTES,
    force: bool = False,
    source_name: str = S.DEFAULT_SOURCE_NAME,
) -> Refresh:
    """One scheduled run: the landed documents that are not settled become the next snapshot.

    A document is settled once a run took all its rows, whatever came of them (the ledger,
    ``catalog.record_run``): it is not parsed again. Everything the others hold is published, unless the
    caller asks for some stations, whose documents alone are then read, or for the newest
    ``limit`` observations of each station. What that leaves out is counted, stays open and
    is published by the next run that does not leave it out.
    """
    latest = CAT.latest_entry(CAT.read_catalog(spark, root))
    if not is_due(latest, now, 0 if force else max_age_minutes):
        return Refresh("SKIPPED_NOT_DUE", latest)
    waiting = FD.landed_files(spark, landing_path).join(CAT.settled_files(spark, root), "file", "left_anti")
    open_ = [r.file for r in waiting.collect()]  # names of new documents; Spark's file index holds them all anyway
    paths = [p for p in open_ if not station_ids or FD.station_of(p) in station_ids]
    if not paths:
        return Refresh("SKIPPED", latest, 0, len(open_))
    raw = FD.read_landing(spark, landing_path, fetched_at=now, files=paths)
    files = spark.createDataFrame([(p, None) for p in paths], "file string, rows long")
    if limit is not None:
        raw = cut(raw)  # parsed once, for the counts and for the rows
        held = raw.groupBy(F.col("source_url").alias("file")).agg(F.count("*").alias("held"))
        files = files.join(held, "file", "left").select("file", F.coalesce("held", F.lit(0)).alias("rows"))
        raw = latest_per_station(raw, limit).drop("recency_rank")
    run = f"{pull_stamp(now)}-{uuid.uuid4().hex[:8]}"
    done = refresh_snapshot(spark, root, raw, now, source_name, station_ids, files=files, run=run)
    left = CAT.ledger(spark, root).where(F.col("run") == run).agg(F.sum(F.col("rows") - F.col("taken"))).first()[0]
    return Refresh(done.status, done.entry, left or 0, len(open_) - len(paths))


def main(argv: list[str] | None = None) -> Refresh:
    from chronolake.session import get_session

    cli = argparse.ArgumentParser(prog="chronolake-refresh", description="Publish what has landed as a snapshot.")
    cli.add_argument("root", help="store folder")
    cli.add_argument("landing", help="folder of landed station=<id>/ documents")
    cli.add_argument("--only-stations", metavar="ID", nargs="+", help="publish these stations only (default: all)")
    cli.add_argument("--newest", metavar="N", type=int, help="publish the newest N observations of each station only (default: all)")
    cli.add_argument("--older-than", metavar="MINUTES", type=int, default=S.AUTO_REFRESH_MINUTES, help="run if the newest snapshot is that old; 0: always")
    cli.add_argument("--at", metavar="ISO", help="time of this run (default: the clock)")
    given = cli.parse_args(argv)
    at = given.at or datetime.now(timezone.utc).isoformat(timespec="seconds")
    done = refresh_if_due(
        get_session("chronolake-refresh"), given.root, given.landing, at, given.only_stations, given.newest, given.older_than
    )
    print(done)
    return done


if __name__ == "__main__":
    main()
