"""chronolake: telemetry snapshot audit on Spark.

Main entry points::

    from chronolake import get_session, Explorer, refresh_if_due, refresh_snapshot
    from chronolake import read_landing, start_ingest, rebuild
"""

from chronolake.plans.explorer import Explorer
from chronolake.plans.rebuild import rebuild
from chronolake.plans.refresh import refresh_if_due, refresh_snapshot
from chronolake.session import get_session
from chronolake.sources.feed import read_landing
from chronolake.streaming.ingest import start_ingest

__all__ = [
    "Explorer",
    "get_session",
    "read_landing",
    "rebuild",
    "refresh_if_due",
    "refresh_snapshot",
    "start_ingest",
]
