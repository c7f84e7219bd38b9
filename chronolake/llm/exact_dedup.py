"""Exact deduplication through a cuckoo-filter index of live digests.

A document's digest is the SHA-256 of its text with A-Z lowered. The index is split into buckets by
digest; each bucket holds a cuckoo filter over its live digests beside the stored keys themselves
(digest, document that stays, count). A digest that the filter has not seen is new and needs no look
at the stored keys; a hit is verified against them, so false positives cost a look and never a row.
Digests can be deleted when their documents go, and a filter that overflows is rebuilt at twice the
size from the stored keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, cut, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fingerprints to a slot of the filter, moves before it counts as full, digests one map task
#: combines before it sends them on.
SLOT, KICKS, COMBINE = 4, 200, 50_000
INDEX = "bucket int, digest binary, keep_id long, copies long"
FILTER = "bucket int, slots int, fingerprints binary"


class CuckooFilter:
    """Partial-key cuckoo hashing with 16-bit fingerprints; copies of a digest are stored once."""

    def __init__(self, keys: int = 0):
        self.slots = 1
        while self.slots * SLOT * 0.9 < max(keys, 4):
            self.slots *= 2
        self.cells: list[list[int]] = [[] for _ in range(self.slots)]

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & (self.slots - 1)
        return mark, first, self._other(first, mark)

    def _other(self, slot: int, mark: int) -> int:
        return (slot ^ (mark * 0x5BD1E995)) & (self.slots - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._place(digest)
        return mark in self.cells[a] or mark in self.cells[b]

    def insert(self, digest: bytes) -> bool:
        """False when no cell was found: the filter must then be rebuilt from the stored keys."""
        mark, a, b = self._place(digest)
        for slot in (a, b):
            if len(self.cells[slot]) < SLOT:
                self.cells[slot].append(mark)
                return True
        slot = b
        for turn in range(KICKS):
            cell = self.cells[slot]
            cell[turn % SLOT], mark = mark, cell[turn % SLOT]
            slot = self._other(slot, mark)
            if len(self.cells[slot]) < SLOT:
                self.cells[slot].append(mark)
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, a, b = self._place(digest)
        for slot in (a, b):
            if mark in self.cells[slot]:
                self.cells[slot].remove(mark)
                return True
        return False

    @classmethod
    def of(cls, keys, size: int = 0) -> CuckooFilter:
        """A filter over all keys, larger each time that one overflows."""
        keys = list(keys)
        size = max(size, len(keys))
        while True:
            made = cls(size)
            if all(made.insert(k) for k in keys):
                return made
            size = made.slots * SLOT

    def pack(self) -> bytes:
        cells = np.zeros((self.slots, SLOT), dtype="<u2")
        for i, cell in enumerate(self.cells):
            cells[i, : len(cell)] = cell
        return cells.tobytes()

    @classmethod
    def unpack(cls, slots: int, data: bytes) -> CuckooFilter:
        made = cls()
        made.slots = slots
        made.cells = [[x for x in row if x] for row in np.frombuffer(data, "<u2").reshape(slots, SLOT).tolist()]
        return made


class Bucket:
    """The live digests of one bucket: the filter, and the stored keys that its hits are held against."""

    def __init__(self, stored: dict[bytes, tuple[int | None, int]] | None = None, made: CuckooFilter | None = None):
        self.stored = dict(stored or {})
        self.filter = made or CuckooFilter.of(self.stored)

    def add(self, digest: bytes, doc_id: int | None, copies: int = 1) -> None:
        if digest in self.filter and (old := self.stored.get(digest)):
            ids = [x for x in (old[0], doc_id) if x is not None]
            self.stored[digest] = (max(ids) if ids else None, old[1] + copies)
            return
        self.stored[digest] = (doc_id, copies)
        if not self.filter.insert(digest):
            self.filter = CuckooFilter.of(self.stored, 2 * self.filter.slots * SLOT)

    def remove(self, digest: bytes) -> bool:
        """Forgets a digest whose documents are gone; False if it was not live."""
        if digest not in self.filter or digest not in self.stored:
            return False
        del self.stored[digest]
        return self.filter.delete(digest)

    def rows(self, bucket: int) -> pd.DataFrame:
        keys = list(self.stored)
        return pd.DataFrame(
            {
                "bucket": np.full(len(keys), bucket, dtype="int32"),
                "digest": keys,
                "keep_id": pd.array([self.stored[k][0] for k in keys], dtype="Int64"),
                "copies": np.array([self.stored[k][1] for k in keys], dtype="int64"),
            }
        )


def digest_of() -> Column:
    return F.unhex(F.sha2(F.translate(text_of(), UPPER, LOWER), 256))


def digests(docs: DataFrame, n_buckets: int) -> DataFrame:
    """doc_id, digest (32 bytes) and bucket of every row; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest_of().alias("digest"),
    ).withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int"))


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each digest of a map task, so a digest that a third of all rows share is sent once by each."""
    held: dict[bytes, list] = {}

    def out() -> pd.DataFrame:
        return pd.DataFrame(
            {
                "bucket": np.array([v[0] for v in held.values()], dtype="int32"),
                "digest": list(held),
                "keep_id": pd.array([v[1] for v in held.values()], dtype="Int64"),
                "copies": np.array([v[2] for v in held.values()], dtype="int64"),
            }
        )

    for batch in batches:
        ids = batch["doc_id"].astype("Int64")
        for bucket, digest, doc_id, known in zip(batch["bucket"], batch["digest"], ids.fillna(0), ids.notna(), strict=True):
            doc_id = int(doc_id) if known else None
            if (v := held.get(digest)) is None:
                held[bytes(digest)] = [bucket, doc_id, 1]
            else:
                v[1] = doc_id if v[1] is None else v[1] if doc_id is None else max(v[1], doc_id)
                v[2] += 1
        if len(held) >= COMBINE:
            yield out()
            held.clear()
    if held:
        yield out()


def _fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    bucket = Bucket()
    ids = rows["keep_id"].astype("Int64")
    for digest, doc_id, known, copies in zip(rows["digest"], ids.fillna(0), ids.notna(), rows["copies"], strict=True):
        bucket.add(bytes(digest), int(doc_id) if known else None, int(copies))
    return bucket.rows(int(key[0]))


def build_index(docs: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """The stored keys (bucket, digest, keep_id, copies) of all documents, one row for each live digest.

    Buckets hold about 100,000 digests each: their number follows the row count.
    """
    n_buckets = n_buckets or buckets_for(docs.count())
    sent = digests(docs, n_buckets).mapInPandas(_combine, INDEX)
    return cut(sent.groupBy("bucket").applyInPandas(_fill, INDEX))


def filters(index: DataFrame) -> DataFrame:
    """The packed cuckoo filter of every bucket, to be kept beside the index."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(bytes(d) for d in rows["digest"])
        return pd.DataFrame({"bucket": [int(key[0])], "slots": [made.slots], "fingerprints": [made.pack()]})

    return index.groupBy("bucket").applyInPandas(pack, FILTER)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame, n_buckets: int) -> DataFrame:
    """The index after the digests of ``removed`` (digest) went and the documents of ``added`` came."""
    change = "bucket int, digest binary, keep_id long, copies long, kind int"
    gone = removed.select(
        F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int").alias("bucket"),
        "digest",
        F.lit(None).cast("long").alias("keep_id"),
        F.lit(0).cast("long").alias("copies"),
    ).distinct()
    came = digests(added, n_buckets).mapInPandas(_combine, INDEX)
    parts = [f.select("*", F.lit(kind).alias("kind")) for kind, f in enumerate((index, gone, came))]

    def apply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ids = rows["keep_id"].astype("Int64")
        rows = list(zip(rows["kind"], rows["digest"], ids.fillna(0), ids.notna(), rows["copies"], strict=True))
        rows = [(k, bytes(d), int(i) if known else None, int(n)) for k, d, i, known, n in rows]
        bucket = Bucket({d: (i, n) for k, d, i, n in rows if k == 0})
        for k, d, _, _ in rows:
            if k == 1:
                bucket.remove(d)
        for k, d, i, n in rows:
            if k == 2:
                bucket.add(d, i, n)
        return bucket.rows(int(key[0]))

    merged = parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*[x.split()[0] for x in change.split(", ")])
    return cut(merged.groupBy("bucket").applyInPandas(apply, INDEX))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs`` (doc_id, text, any others).

    Of equal texts (A-Z lowered, null as empty) the largest doc_id stays. Rows that repeat a doc_id with an
    equal text are one document: they count in group_size and share its fate. A null doc_id loses against
    any other; if a group has no other, its rows stay. An empty table gives no rows.
    """
    n_buckets = buckets_for(docs.count())
    index = build_index(docs, n_buckets).select("digest", "keep_id", "copies")
    return (
        digests(docs, n_buckets)
        .select("doc_id", "digest")
        .join(index, "digest")
        .select(
            "doc_id",
            "keep_id",
            F.col("copies").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns."""
    gone = exact_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.unhex("text_sha256").alias("_digest")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col("_gone")) & (digest_of() == F.col("_digest")), "left_anti")
