"""Operator counts of every registered query's executed plan -> PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Broadcast joins are disabled for the report, so each plan shows the shape it takes when
no side is small (large data): every join a shuffle join, every exchange visible.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronolake.plans import registered as R  # noqa: E402
from chronolake.session import get_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin",
    "single-partition": r"Exchange SinglePartition",
    "reused": r"ReusedExchange",
    "SMJ": r"SortMergeJoin",
    "SHJ": r"ShuffledHashJoin",
    "BHJ": r"BroadcastHashJoin",
    "nested-loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "partial-agg": r"partial_",
    "window": r"\bWindow\b",
    "group-limit": r"WindowGroupLimit",
    "top-k": r"TakeOrderedAndProject",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "scans": r"FileScan",
}


NOTES = """Where the shuffles come from (queries on snapshots read a store that the refresh job
published, so they are scans of its tables plus what the query itself needs):

* **Layers** (`bronze_*`, `silver_*`, `gold_*`): partition-pruned scans, no shuffle.
* **Log rewrites** (`new_records_bronze`, `new_records_silver`): the log alone, no
  anti-join; compare with the `*_except` variants, which anti-join two snapshots.
* **Gold comparisons**: one shuffle for each of the two small gold tables.
* **`incremental_t3`**: keep-first (partial `min` before the exchange), then the anti-join to
  history by broadcast, by one shuffle, or against the bucketed id index.
* **`gold_all_snapshots`**: one aggregate of the log and two windows over its small result.
"""


def final_plan(df) -> str:
    # Execute the frame's own query execution (small SF: collecting is fine here) so the
    # adaptive plan is final -- stage reuse and runtime re-planning only show there.
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # the adaptive plan prints the final and the initial plan; keep the final one
    return text.split("== Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(
        "chronolake-plans", master="local[8]", shuffle_partitions=8,
        extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    cols = list(PATTERNS)
    print("# Plan report\n")
    print(f"Executed (AQE final) plans of every registered query of the reference's operators at `{sf_dir}` with broadcast")
    print("joins disabled, i.e. the shape each plan takes when no input is small. Counts are")
    print("operator occurrences. `partial-agg` counts map-side partial aggregate functions")
    print("(combine before the shuffle); `python` must stay 0 (no Python in any plan).")
    print("Generated by `tools/plan_report.py`.\n")
    print(NOTES)
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in R.QUERIES.items():
        df = fn(spark, sf_dir)
        plan = final_plan(df)
        counts = [str(len(re.findall(PATTERNS[c], plan))) for c in cols]
        print(f"| {name} | " + " | ".join(counts) + " |")
    refresh_section(spark, sf_dir, cols)
    spark.stop()


def refresh_section(spark, sf_dir: str, cols: list[str]) -> None:
    """The production refresh's own plans, on a store built from the first two pulls."""
    from chronolake.operators import layers as L
    from chronolake.operators.dedupe import keep_first
    from chronolake.plans.refresh import refresh_snapshot
    from chronolake.session import shared_dir
    from chronolake.sources import fixture as FX
    from chronolake.sources.store import LayerStore

    events = FX.read_events(spark, sf_dir)
    plain, indexed = shared_dir(spark, "plans-plain"), shared_dir(spark, "plans-indexed")
    for pull in (1, 2):
        refresh_snapshot(spark, plain, FX.pull_frame(events, pull), FX.PULL_AS_OF[pull])
        refresh_snapshot(spark, indexed, FX.pull_frame(events, pull), FX.PULL_AS_OF[pull], id_buckets=8)
    batch = L.to_bronze(FX.pull_frame(events, 3), "plans", FX.PULL_AS_OF[3])
    store, istore = LayerStore(spark, plain), LayerStore(spark, indexed)
    one_each = keep_first(batch, L.KEY, L.PULL_ORDER, L.PULL_NULLS_LAST)
    steps = {
        "refresh: new ids, increment counted small (broadcast)": L.unseen(one_each, store.history_ids(2)),
        "refresh: new ids, large increment": L.unseen(one_each, store.history_ids(2), broadcast_limit_rows=0),
        "refresh: new ids, large increment, id index": L.unseen(one_each, istore.history_ids(2), broadcast_limit_rows=0),
        "refresh: gold state merge": L.merge_gold_state(
            store.gold_state(2), L.gold_state(store.silver_log().where("seq = 2"))),
    }
    print("\n## Refresh job steps (on a store holding T1-T2, pull 3 incoming)\n")
    print("`bucketed` counts history scans read as Spark buckets (no exchange on that side).\n")
    print("| step | " + " | ".join(cols) + " | bucketed |")
    print("|---|" + "---|" * (len(cols) + 1))
    for name, df in steps.items():
        plan = final_plan(df)
        counts = [str(len(re.findall(PATTERNS[c], plan))) for c in cols]
        print(f"| {name} | " + " | ".join(counts) + f" | {plan.count('Bucketed: true')} |")


if __name__ == "__main__":
    main()
