"""Published ids bucketed by id, in generations (JOIN3 for increments too large to broadcast).

``id_index/gen=<g>/seq=<n>`` holds the ids first published in snapshot n, bucketed by id with Spark's own
bucketing (declared through a session catalog table over the folder), so that a join of history with an increment
shuffles the increment only. A generation has a bucket count of its own, written next to it before its first ids,
and never read with another: ``id_index/_generations/gen=<g>`` holds the count and the first snapshot. When the
ids of the newest generation outgrow its buckets, or another count is asked for, the next snapshot opens a new one;
the ids before stay where they are. History is then one frame for each generation, and there are few: each has at
least twice the buckets of the last, unless the caller changed the count.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake.sources.reading import or_empty

#: Ids of a bucket; a generation that holds more for each of its buckets is closed.
BUCKET_IDS = 4_000_000
_SCHEMA = T.StructType([T.StructField(n, T.IntegerType()) for n in ("buckets", "from_seq", "gen")])


@dataclass(frozen=True)
class Generation:
    gen: int
    buckets: int
    from_seq: int


def buckets_for(ids: int) -> int:
    """The least power of two that gives no bucket more than BUCKET_IDS."""
    buckets = 1
    while buckets * BUCKET_IDS < ids:
        buckets *= 2
    return buckets


class IdIndex:
    """``buckets``: the count that new generations are to have; by default it follows the number of ids."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root, self.buckets = spark, f"{root.rstrip('/')}/id_index", buckets

    def generations(self) -> list[Generation]:
        """Those that have been opened, oldest first: a few rows."""
        path = f"{self.root}/_generations"
        rows = or_empty(self.spark, _SCHEMA, lambda: self.spark.read.schema(_SCHEMA).json(path))
        return [Generation(r.gen, r.buckets, r.from_seq) for r in rows.orderBy("gen").collect()]

    def _table(self, gen: Generation) -> str:
        """The session's table over a generation's folder, its partitions listed afresh."""
        name = f"chronolake_ids_{hashlib.sha1(self.root.encode()).hexdigest()[:16]}_g{gen.gen}_b{gen.buckets}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (source_record_id STRING, seq INT) USING parquet PARTITIONED BY (seq) "
            f"CLUSTERED BY (source_record_id) INTO {gen.buckets} BUCKETS LOCATION '{self.root}/gen={gen.gen}'"
        )
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _for_write(self, seq: int, new_ids: int, known_ids: int) -> Generation:
        """The generation that snapshot ``seq`` goes to, opened if need be; a retry finds the one it opened."""
        found = [g for g in self.generations() if g.from_seq <= seq]
        last = found[-1] if found else None
        wanted = self.buckets or buckets_for(known_ids + new_ids)
        if last and (last.from_seq == seq or (last.buckets == wanted if self.buckets else last.buckets >= wanted)):
            return last
        made = Generation(last.gen + 1 if last else 1, wanted, seq)
        row = self.spark.createDataFrame([(made.buckets, made.from_seq)], "buckets int, from_seq int")
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/_generations/gen={made.gen}")
        # The folder is there before its table is made.
        empty = self.spark.createDataFrame([], "source_record_id string")
        empty.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/gen={made.gen}/_made")
        return made

    def write(self, seq: int, ids: DataFrame, new_ids: int, known_ids: int) -> None:
        """Replace snapshot ``seq``'s ids (idempotent on retry), a file to a bucket."""
        gen = self._for_write(seq, new_ids, known_ids)
        view = f"chronolake_ids_in_{uuid.uuid4().hex[:12]}"
        ids.select("source_record_id").repartition(gen.buckets, "source_record_id").createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self._table(gen)} PARTITION (seq={int(seq)}) SELECT source_record_id FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def history(self, seq: int) -> list[DataFrame] | None:
        """The ids of snapshots 1 to ``seq``, a frame for each generation; None unless all of them are indexed."""
        generations = [g for g in self.generations() if g.from_seq <= seq]
        if not generations:
            return None
        frames, listed = [], 0
        for gen, after in zip(generations, [*generations[1:], None], strict=True):
            last = min(seq, after.from_seq - 1) if after else seq
            table = self._table(gen)
            own = F.regexp_extract("partition", r"seq=(\d+)", 1).cast("int").between(gen.from_seq, last)
            listed += self.spark.sql(f"SHOW PARTITIONS {table}").where(own).count()
            frames.append(self.spark.table(table).where(F.col("seq").between(gen.from_seq, last)).select("source_record_id"))
        return frames if frames and listed == seq else None
