"""Vectors in blocks, and queries streamed past them: what both vector operators stand on.

Equal vectors are one class, which keeps its least ids: no more of them can be among the first k of any answer,
since ties go to the smaller id. So a vector that holds a third of all rows is one stored row. Classes lie in
blocks of bounded size; a block is loaded by one task, and the queries that must see it stream past it batch by
batch, so that memory is bounded by a block whatever the number of queries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A block holds so many classes at most; below PARALLEL times that, blocks are smaller, but of LEAST_ROWS.
MOST_ROWS, LEAST_ROWS, PARALLEL = 50_000, 1_000, 24
#: Partitions that blocks are dealt to at most.
MOST_PARTITIONS = 10_000
STORED = "block int, part int, key binary, vec binary, more array<double>, ids array<long>, label long"


def block_rows(classes: int) -> int:
    return int(min(MOST_ROWS, max(LEAST_ROWS, classes // PARALLEL)))


def is_usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def as_bytes(row: np.ndarray) -> bytes:
    """Little-endian doubles without trailing zeros: a shorter vector is as one padded with zeros."""
    end = len(row)
    while end and row[end - 1] == 0:
        end -= 1
    return (row[:end] + 0.0).astype("<f8").tobytes()


def encoded(rows: DataFrame, change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """id, label, vec (``change`` of the vector's doubles, as bytes) and key (128-bit digest of vec and label)
    of ``rows`` (id long, label long, v array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = change(batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(float))
            ends = batch.column(2).offsets.to_numpy() - (batch.column(2).offsets[0].as_py() if batch.num_rows else 0)
            vecs = [as_bytes(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            labels = batch.column(1).to_pylist()
            keys = [hashlib.blake2b(v + str(n).encode(), digest_size=16).digest() for v, n in zip(vecs, labels, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(vecs, pa.binary()), pa.array(keys, pa.binary())], ["id", "label", "vec", "key"]
            )

    return rows.select("id", "label", "v").mapInArrow(run, "id long, label long, vec binary, key binary")


def classes(rows: DataFrame, keep: int, asks: Column) -> DataFrame:
    """key, label, vec, ids (the ``keep`` least, ascending) and asked (whether any of its rows is a query).

    ``rows`` as :func:`encoded` gives them, cut. Ids meet as narrow rows, the least of each key chosen in every
    map task before they are shuffled; of the vectors one for each key and map task is.
    """
    least = Window.partitionBy("key").orderBy("id")
    narrow = rows.select("key", "id").distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= keep)
    ids = narrow.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    one = rows.groupBy("key").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.max(asks).alias("asked"))
    return one.join(ids, "key")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors stored as bytes, padded with zeros to ``width``."""
    out = np.zeros((len(column), width))
    for i, data in enumerate(column.to_pylist()):
        row = np.frombuffer(data, "<f8")
        out[i, : len(row)] = row
    return out


def lists(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def inner(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Inner products of rows, in double precision, components added left to right: the same wherever a pair is met."""
    out = np.zeros(len(one))
    for a in range(0, len(one), 4096):
        if one.shape[1]:
            out[a : a + 4096] = np.cumsum(one[a : a + 4096] * many[a : a + 4096], axis=1)[:, -1]
    return out


class Ids:
    """The ids of a block's classes, side by side."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, order: np.ndarray):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = column.take(pa.array(order))
        self.flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        self.starts, self.counts = ends[:-1] - ends[0], np.diff(ends)

    def first(self, asker: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k first of each asker among the ids of ``rows``: larger scores, then smaller ids. Asker, id, score."""
        n = self.counts[rows]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids = self.flat[np.repeat(self.starts[rows], n) + at]
        asker, scores = np.repeat(asker, n), np.repeat(scores, n)
        order = np.lexsort((ids, -scores, asker))
        asker, ids, scores = asker[order], ids[order], scores[order]
        began = np.flatnonzero(np.concatenate([[True], asker[1:] != asker[:-1]])) if len(asker) else np.empty(0, dtype=int)
        place = np.arange(len(asker)) - np.repeat(began, np.diff([*began, len(asker)]))
        return asker[place < k], ids[place < k], scores[place < k]


def visit(stored: DataFrame, asking: DataFrame, blocks: int, load: Callable, schema: str) -> DataFrame:
    """The answers of ``asking`` rows from the blocks they name; both have the columns of STORED but for ``part``.

    ``load`` gets the rows of a block as an Arrow table and returns a function from a batch of queries to batches
    of answers. A block's rows come before its queries in its task.
    """
    columns = [c.split()[0] for c in STORED.split(", ") if not c.startswith("part ")]
    both = stored.select(*columns, F.lit(0).alias("part")).union(asking.select(*columns, F.lit(1).alias("part")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, answer = None, [], None
        for batch in batches:
            block, part = (batch.column(c).to_numpy() for c in ("block", "part"))
            starts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (part[1:] != part[:-1])])) if batch.num_rows else []
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if block[a] != at:
                    at, rows, answer = block[a], [], None
                piece = batch.slice(a, b - a)
                if part[a] == 0:
                    rows.append(piece)
                elif rows or answer:
                    if answer is None:
                        answer, rows = load(pa.Table.from_batches(rows)), []
                    yield from answer(piece)

    dealt = both.repartition(max(1, min(blocks, MOST_PARTITIONS)), "block").sortWithinPartitions("block", "part")
    return dealt.mapInArrow(run, schema)


def first_of(found: DataFrame, group: list[str], k: int) -> DataFrame:
    """The ``k`` rows of each group with the largest score, ties by the smaller id, numbered ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def spread_cells(counts: list[tuple[int, int]], most: int) -> dict[int, tuple[int, int]]:
    """For cells and their counts, in order: the first block of each and over how many blocks it is spread.

    Small cells share a block while they fit; a cell of more than ``most`` rows has blocks of its own.
    """
    out, block, room = {}, -1, 0
    for cell, n in counts:
        if n > most:
            parts = -(-n // most)
            out[cell] = (block + 1, parts)
            block, room = block + parts, 0
            continue
        if n > room:
            block, room = block + 1, most
        out[cell] = (block, 1)
        room -= n
    return out


def sample(rows: DataFrame, count: int, most: int) -> DataFrame:
    """About ``most`` rows chosen by their key (all, if fewer): the same rows on every run."""
    share = min(1.0, most / max(1, count))
    return rows.where(F.pmod(F.xxhash64("key", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else rows
