"""Approximate nearest neighbours by low-dimensional stable projections, a kd-tree and a chi-square stop.

Largest inner products become least distances: vectors are scaled by the largest norm and get one more component
that brings them to length 1, queries are scaled to length 1. A projection on DIMENSIONS Gaussian directions then
turns a distance d into a projected one whose square is d**2 times a chi-square variable. Projected vectors lie in
a kd-tree: its upper part deals them to blocks, and each block has cells of its own. A query takes projected
neighbours in order of their projected distance and verifies each by its inner product, until the chi-square test
holds: a vector nearer than the k-th found would have been met with a chance of CONFIDENCE.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut

#: Projected dimensions (even), the chance that the stopping test asks for, seed of the directions.
DIMENSIONS, CONFIDENCE, SEED = 12, 0.98, 23
#: Classes that the upper tree is fitted on, its leaves at most, vectors of a cell of a block's tree.
SAMPLE, LEAVES, CELL = 50_000, 4_096, 32
#: Numbers of a matrix of queries and a block's vectors that is worked on at once.
TOGETHER = 2_000_000
#: Projections and scores are taken as equal within this, in units of the largest product.
SLACK = 1e-9


def chi_square(x: float, degrees: int) -> float:
    """Chance that a chi-square variable of an even number of degrees is at most x."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def quantile(chance: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < chance:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < chance else (low, middle)
    return high


def box_distances(places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared projected distance from every place to each box."""
    out = np.zeros((len(places), len(low)))
    for j in range(places.shape[1]):
        at = places[:, j, None]
        off = np.maximum(np.maximum(low[:, j] - at, at - high[:, j]), 0.0)
        out += off * off
    return out


class Space:
    """The projection: width and largest norm of the vectors, and the directions."""

    def __init__(self, width: int, largest: float):
        self.width, self.largest = width, largest
        self.directions = np.random.default_rng(SEED).normal(size=(width + 1, DIMENSIONS))

    def of_stored(self, x: np.ndarray) -> np.ndarray:
        x = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]]) @ self.directions

    def of_query(self, x: np.ndarray) -> np.ndarray:
        return (x / norms(x)[:, None]) @ self.directions[:-1]


def norms(x: np.ndarray) -> np.ndarray:
    most = np.maximum(np.abs(x).max(axis=1, initial=0.0), np.finfo(float).tiny)
    x = x / most[:, None]
    with np.errstate(over="ignore"):
        return np.minimum(np.sqrt(np.einsum("ij,ij->i", x, x)) * most, np.finfo(float).max)


class UpperTree:
    """Splits places at quantiles of the widest side of a sample, down to a number of leaves."""

    def __init__(self, places: np.ndarray, leaves: int):
        self.side, self.at, self.left, self.right = [], [], [], []
        self.leaf: list[int] = []
        self._n = 0
        self._split(places, leaves)

    def _split(self, places: np.ndarray, leaves: int) -> int:
        node = len(self.side)
        for part in (self.side, self.at, self.left, self.right, self.leaf):
            part.append(-1)
        if leaves <= 1 or len(places) < 2:
            self.leaf[node], self._n = self._n, self._n + 1
            return node
        side = int(np.argmax(places.max(axis=0) - places.min(axis=0)))
        at = float(np.quantile(places[:, side], (leaves // 2) / leaves))
        under = places[:, side] <= at
        self.side[node], self.at[node] = side, at
        self.left[node] = self._split(places[under], leaves // 2)
        self.right[node] = self._split(places[~under], leaves - leaves // 2)
        return node

    def leaf_of(self, places: np.ndarray) -> np.ndarray:
        side, at, left, right, leaf = (np.array(x) for x in (self.side, self.at, self.left, self.right, self.leaf))
        node = np.zeros(len(places), dtype=int)
        while (inner := leaf[node] < 0).any():
            under = places[np.arange(len(places)), side[node]] <= at[node]
            node = np.where(inner, np.where(under, left[node], right[node]), node)
        return leaf[node]


def _cells(places: np.ndarray) -> list[np.ndarray]:
    """Rows of the cells of a kd-tree over ``places``, halved along the widest side."""
    done, todo = [], [np.arange(len(places))]
    while todo:
        rows = todo.pop()
        own = places[rows]
        spread = own.max(axis=0) - own.min(axis=0)
        if len(rows) <= CELL or spread.max() == 0:
            done.append(rows)
            continue
        order = rows[np.argpartition(own[:, int(np.argmax(spread))], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return done


class Block:
    """A block's vectors in the cells of a kd-tree over their places.

    Queries go through it together: in each step every query opens its next cells by projected distance, the
    places inside are put in order by their own, and those that no closed cell can come before are verified.
    """

    def __init__(self, rows: pa.Table, space: Space, k: int):
        places = B.lists(rows["more"], DIMENSIONS)
        cells = _cells(places)
        order = np.concatenate(cells)
        self.places, self.x = places[order], B.matrix(rows["vec"], space.width)[order]
        self.lengths = np.einsum("ij,ij->i", self.places, self.places)
        self.ids = B.Ids(rows["ids"], order)
        ends = np.cumsum([len(c) for c in cells])
        self.spans = list(zip((ends - [len(c) for c in cells]).tolist(), ends.tolist(), strict=True))
        self.low = np.array([self.places[a:b].min(axis=0) for a, b in self.spans])
        self.high = np.array([self.places[a:b].max(axis=0) for a, b in self.spans])
        self.starts = np.array([a for a, _ in self.spans])
        self.space, self.k, self.factor = space, k, quantile(CONFIDENCE, DIMENSIONS)

    def kth(self, scores: np.ndarray) -> np.ndarray:
        """Each query's k-th best score (a matrix, -inf where not verified), copies counted; -inf where there are fewer."""
        k = min(self.k, scores.shape[1])
        if self.ids.counts.max() == 1:
            return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k] if k == self.k else np.full(len(scores), -math.inf)
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(scores, best, axis=1), axis=1), axis=1)
        ranked = np.take_along_axis(scores, best, axis=1)
        enough = np.cumsum(self.ids.counts[best], axis=1) >= self.k
        at = np.argmax(enough, axis=1)
        return np.where(enough.any(axis=1), ranked[np.arange(len(at)), at], -math.inf)

    def search(self, q: np.ndarray, places: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query (its row), id and score of the k best of each query, of those no worse than its ``bound``."""
        unit = norms(q) * self.space.largest
        away = box_distances(places, self.low, self.high)
        rank = np.argsort(np.argsort(away, axis=1, kind="stable"), axis=1)
        nearest = np.hstack([np.sort(away, axis=1), np.full((len(q), 1), math.inf)])
        own, cells = np.einsum("ij,ij->i", places, places), len(self.spans)
        limit, opened, step = reach(bound, unit, self.factor), np.zeros(len(q), dtype=int), 4
        apart, scores = np.full((len(q), len(self.x)), math.inf), np.full((len(q), len(self.x)), -math.inf)
        going = np.ones(len(q), dtype=bool)
        while going.any():
            within = (away <= limit[:, None]).sum(axis=1)
            to = np.where(going, np.maximum(opened, np.minimum(opened + step, within)), opened)
            fresh = (rank >= opened[:, None]) & (rank < to[:, None])
            for c in np.flatnonzero(fresh.any(axis=0)):
                (a, b), who = self.spans[c], np.flatnonzero(fresh[:, c])
                apart[who, a:b] = np.maximum(0.0, self.lengths[a:b] + own[who, None] - 2 * places[who] @ self.places[a:b].T)
            opened, step = to, 2 * step
            # No cell that is still closed holds a place nearer than this: what is open within it comes next in order.
            closed = nearest[np.arange(len(q)), to]
            due = apart <= np.minimum(closed, limit)[:, None]
            for c in np.flatnonzero(np.logical_or.reduceat(due, self.starts, axis=1).any(axis=0)):
                (a, b) = self.spans[c]
                who = np.flatnonzero(due[:, a:b].any(axis=1))
                scores[who, a:b] = np.where(due[who, a:b], q[who] @ self.x[a:b].T, scores[who, a:b])
            apart[due] = math.inf  # verified
            bound = np.maximum(bound, self.kth(scores))
            limit = np.minimum(limit, reach(bound, unit, self.factor))
            going &= (closed <= limit) & (to < cells)
        asker, rows = np.nonzero(scores >= (bound - SLACK * unit)[:, None])
        rows, asker = rows[scores[asker, rows] > -math.inf], asker[scores[asker, rows] > -math.inf]
        return self.ids.first(asker, rows, B.inner(q[asker], self.x[rows]), self.k)

    def __call__(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        many = max(8, TOGETHER // len(self.x))
        for a in range(0, asked.num_rows, many):
            part = asked.slice(a, many)
            q, more = B.matrix(part["vec"], self.space.width), B.lists(part["more"], DIMENSIONS + 1)
            asker, ids, scores = self.search(q, more[:, :-1], more[:, -1])
            keys = part["key"].take(pa.array(asker, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["key", "id", "score"])


def reach(score: np.ndarray, unit: np.ndarray, factor: float) -> np.ndarray:
    """Squared projected distance at which the test holds once the k-th score is ``score``."""
    return np.where(score == -math.inf, math.inf, factor * np.maximum(0.0, 2 - 2 * np.where(score == -math.inf, 0.0, score) / unit) + SLACK)


def _space(groups: DataFrame) -> Space | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                width = max(len(v) for v in batch.column(0).to_pylist()) // 8
                yield pa.RecordBatch.from_arrays([pa.array([width]), pa.array([norms(B.matrix(batch.column(0), width)).max()])], ["width", "norm"])

    got = groups.select("vec").mapInArrow(run, "width long, norm double").agg(F.max("width").alias("width"), F.max("norm").alias("norm")).first()
    return Space(got.width, got.norm) if got.width else None


class Index:
    """The classes of ``groups`` (see :func:`blocks.classes`), projected and dealt to blocks by the upper tree."""

    def __init__(self, groups: DataFrame, space: Space, k: int):
        self.space, self.k = space, k
        count = groups.count()
        some = B.sample(groups, count, SAMPLE).select("vec").toArrow()["vec"]
        most = B.block_rows(count)
        tree = UpperTree(space.of_stored(B.matrix(some, space.width)), min(LEAVES, -(-count // most)))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = space.of_stored(B.matrix(batch.column(1), space.width))
                ends = np.arange(0, DIMENSIONS * len(at) + 1, DIMENSIONS, dtype=np.int32)
                more = pa.ListArray.from_arrays(ends, pa.array(at.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(tree.leaf_of(at), pa.int32()), more], ["key", "vec", "ids", "label", "leaf", "more"]
                )

        placed = cut(groups.select("key", "vec", "ids", "label").mapInArrow(place, "key binary, vec binary, ids array<long>, label long, leaf int, more array<double>"))
        sides = [f(F.col("more")[i]) for f in (F.min, F.max) for i in range(DIMENSIONS)]
        leaves = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.array(*sides).alias("box")).orderBy("leaf").collect()  # LEAVES at most
        spread = B.spread_cells([(r.leaf, r.n) for r in leaves], most)
        box = np.array([r.box for r in leaves])
        self.low, self.high = box[:, :DIMENSIONS], box[:, DIMENSIONS:]
        self.first, self.parts = (np.array([spread[r.leaf][i] for r in leaves]) for i in (0, 1))
        self.blocks = int((self.first + self.parts).max())
        places = groups.sparkSession.createDataFrame([(r.leaf, *spread[r.leaf]) for r in leaves], "leaf int, first int, parts int")
        block = F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts").cast("long")).cast("int")
        self.stored = placed.join(F.broadcast(places), "leaf").withColumn("block", block)

    def _plan(self, queries: DataFrame, home: bool) -> DataFrame:
        """``queries`` (key, vec, label, bound) once for each block to ask: the nearest one, or all others in reach."""
        space, low, high, first, parts = self.space, self.low, self.high, self.first, self.parts
        factor = quantile(CONFIDENCE, DIMENSIONS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                q, bounds = B.matrix(batch.column(1), space.width), np.array(batch.column(3).to_pylist(), dtype=float)
                at, limit = space.of_query(q), reach(bounds, norms(q) * space.largest, factor)
                keys, blocks, rows = batch.column(0).to_pylist(), [], []
                many = max(8, TOGETHER // len(low))
                for n, away in ((n, row) for a in range(0, len(q), many) for n, row in enumerate(box_distances(at[a : a + many], low, high), a)):
                    near = int(np.argmin(away))
                    own = int(first[near] + int.from_bytes(keys[n][:4], "little") % parts[near])
                    asked = {own: None}
                    if not home:
                        within = np.flatnonzero(away <= limit[n])
                        asked = dict.fromkeys(b for i in within for b in range(first[i], first[i] + parts[i]))  # leaves share blocks
                        asked.pop(own, None)
                    blocks += asked
                    rows += [n] * len(asked)
                more = np.hstack([at, bounds[:, None]])[rows]
                ends = np.arange(0, (DIMENSIONS + 1) * len(rows) + 1, DIMENSIONS + 1, dtype=np.int32)
                sent = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks, pa.int32()), *sent.columns, pa.ListArray.from_arrays(ends, pa.array(more.ravel(), pa.float64()))],
                    ["block", "key", "vec", "label", "more"],
                )

        asked = queries.select("key", "vec", "label", "bound").mapInArrow(run, "block int, key binary, vec binary, label long, more array<double>")
        return asked.withColumn("ids", F.lit(None).cast("array<long>"))

    def _ask(self, planned: DataFrame) -> DataFrame:
        space, k = self.space, self.k
        return B.visit(self.stored, planned, self.blocks, lambda rows: Block(rows, space, k), "key binary, id long, score double")

    def nearest(self, queries: DataFrame) -> DataFrame:
        """key, rank, id, score of the k best of every query (key, vec, label).

        A query asks the nearest block first; its k-th score there then bounds the search in all the others.
        """
        least = F.lit(-math.inf)
        near = cut(self._ask(self._plan(queries.withColumn("bound", least), True)))
        bounds = B.first_of(near, ["key"], self.k).where(F.col("rank") == self.k).select("key", F.col("score").alias("bound"))
        bounded = cut(queries.join(bounds, "key", "left").withColumn("bound", F.coalesce("bound", least)))
        return B.first_of(near.union(self._ask(self._plan(bounded, False))), ["key"], self.k)


def search(rows: DataFrame, k: int = 20, asks: Column | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows of largest inner product of every query.

    ``rows``: vec_id, embedding, any others; queries are the rows where ``asks`` holds (default: 20 divides
    vec_id). A query's own vec_id is no candidate. Rows without a vec_id take no part, nor do vectors that are
    null, all zero (or empty), or hold null or non-finite components; a shorter vector is as one padded with
    zeros. Equal rows count once; rows that share a vec_id with different vectors are each a candidate, and each
    a query. Ties go to the smaller vec_id. An empty table, or a lone vector, gives no rows.
    """
    asks = F.col("id") % 20 == 0 if asks is None else asks
    v = F.col("embedding").cast("array<double>")
    read = rows.select(F.col("vec_id").cast("long").alias("id"), F.lit(None).cast("long").alias("label"), v.alias("v"))
    used = read.where(F.col("id").isNotNull() & B.is_usable(F.col("v")))
    base = cut(B.encoded(used.where(F.exists("v", lambda x: x != 0)), lambda x: x))
    groups = cut(B.classes(base, k + 1, asks))
    space = _space(groups)
    if space is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = Index(groups, space, k + 1).nearest(groups.where("asked").select("key", "vec", "label"))
    best = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    queries = base.where(asks).select("key", F.col("id").alias("query_id")).distinct()
    others = F.filter("best", lambda x: x["id"] != F.col("query_id"))
    one = queries.join(best, "key").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x"))
    return one.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))
