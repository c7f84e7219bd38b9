"""Snapshot catalog: one row per snapshot, appended last (SRC14, SRC15, SNK3).

The catalog is tiny (one row per refresh); the few driver-side reads here are single
rows (the latest entry), never data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake import schemas as S
from chronolake.sources.reading import or_empty

_ENTRY_FIELDS = [f for f in S.CATALOG_SCHEMA.fields if f.name != "seq"]
_READ_SCHEMA = T.StructType(_ENTRY_FIELDS + [T.StructField("seq", T.IntegerType())])


def catalog_path(root: str) -> str:
    return f"{root.rstrip('/')}/_catalog"


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    """SRC14: all entries (empty, typed, when nothing is published yet)."""
    df = or_empty(spark, _READ_SCHEMA, lambda: spark.read.schema(_READ_SCHEMA).json(catalog_path(root)))
    return df.select(*S.CATALOG_SCHEMA.fieldNames())


def latest_entry(catalog: DataFrame) -> dict | None:
    """SRC15: the newest entry as a dict (one row to the driver), or None."""
    rows = catalog.orderBy(F.col("seq").desc()).limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else None


def find_entry(catalog: DataFrame, snapshot_id: str) -> dict | None:
    rows = catalog.where(F.col("snapshot_id") == snapshot_id).limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else None


def find_seq(catalog: DataFrame, seq: int) -> dict | None:
    rows = catalog.where(F.col("seq") == seq).limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else None


def append_entry(spark: SparkSession, root: str, entry: dict) -> None:
    """SNK3: publish one entry. Written after every layer, so it is the commit marker.

    Refuses to overwrite a published ``seq`` (a second writer got there first). The check
    narrows, but cannot close, the race window: plain Parquet has no compare-and-swap, so
    one writer per store is still assumed.
    """
    if not read_catalog(spark, root).where(F.col("seq") == entry["seq"]).isEmpty():
        raise RuntimeError(f"snapshot seq {entry['seq']} is already published under {root}")
    row = {f.name: entry.get(f.name) for f in S.CATALOG_SCHEMA.fields}
    df = spark.createDataFrame([row], S.CATALOG_SCHEMA).coalesce(1)
    df.drop("seq").write.mode("overwrite").json(f"{catalog_path(root)}/seq={entry['seq']}")


# Which set of derived layers counts, and the thresholds they were made with: version v has
# the folders silver_log_v<v> and gold_v<v> (version 0: without suffix). The row of a version
# is written after its folders, so a rebuild that dies leaves the version before it in force.
_RULES_SCHEMA = T.StructType(
    [T.StructField("thresholds", T.MapType(T.StringType(), T.DoubleType())), T.StructField("version", T.IntegerType())]
)


def current_rules(spark: SparkSession, root: str) -> tuple[int, dict[str, float]]:
    """The version of the derived layers in force and its thresholds (none: the defaults)."""
    path = f"{root.rstrip('/')}/_rules"
    rules = or_empty(spark, _RULES_SCHEMA, lambda: spark.read.schema(_RULES_SCHEMA).json(path))
    rows = rules.orderBy(F.col("version").desc()).limit(1).collect()
    return (rows[0]["version"], dict(rows[0]["thresholds"] or {})) if rows else (0, {})


def publish_rules(spark: SparkSession, root: str, version: int, thresholds: dict[str, float]) -> None:
    row = spark.createDataFrame([({k: float(v) for k, v in thresholds.items()}, version)], _RULES_SCHEMA)
    row.coalesce(1).drop("version").write.mode("overwrite").json(f"{root.rstrip('/')}/_rules/version={version}")


# Which spans of a log compaction has rewritten: the newest version names all of them, and is written after them.
_LAYOUT_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("first", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("version", T.IntegerType()),
    ]
)


def current_spans(spark: SparkSession, root: str) -> list[dict]:
    """name of the log's folder, folder, first and last snapshot of every span in force: a few rows."""
    path = f"{root.rstrip('/')}/_layout"
    rows = or_empty(spark, _LAYOUT_SCHEMA, lambda: spark.read.schema(_LAYOUT_SCHEMA).json(path))
    found = [r.asDict() for r in rows.collect()]
    newest = max((r["version"] for r in found), default=0)
    return sorted((r for r in found if r["version"] == newest), key=lambda r: (r["name"], r["first"]))


def publish_spans(spark: SparkSession, root: str, version: int, spans: list[dict]) -> None:
    rows = [(s["name"], s["folder"], s["first"], s["last"], version) for s in spans]
    made = spark.createDataFrame(rows, _LAYOUT_SCHEMA).coalesce(1).drop("version")
    made.write.mode("overwrite").json(f"{root.rstrip('/')}/_layout/version={version}")


# What came of the documents of each run: rows that a document holds, how many of them the run took, and the
# snapshot, if there is one. A row about a snapshot counts once that is in the catalog.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("station", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("taken", T.LongType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("run", T.StringType()),
    ]
)


def record_run(spark: SparkSession, root: str, run: str, files: DataFrame, outcome: str, seq: int | None) -> None:
    """``files``: file, rows (null: as many as taken) and taken (null: none) of every document of the run."""
    taken = F.coalesce(F.col("taken"), F.lit(0)).cast("long")
    rows = files.select(
        "file",
        F.regexp_extract("file", r"/station=([^/]+)/", 1).alias("station"),
        F.coalesce(F.col("rows"), taken).alias("rows"),
        taken.alias("taken"),
        F.lit(outcome).alias("outcome"),
        F.lit(seq).cast("int").alias("seq"),
    )
    rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/_ledger/run={run}")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/_ledger"
    rows = or_empty(spark, LEDGER_SCHEMA, lambda: spark.read.schema(LEDGER_SCHEMA).parquet(path))
    published = read_catalog(spark, root).select("seq")
    return rows.where("seq is null").unionByName(rows.where("seq is not null").join(published, "seq", "left_semi").select(*rows.columns))


def settled_files(spark: SparkSession, root: str) -> DataFrame:
    """The documents (file) of which some run took all rows: they need not be read again."""
    return ledger(spark, root).where("taken >= rows").select("file").distinct()
