"""Hard negatives through an inverted multi-index with certified stops.

Vectors are cut in two halves and each half has a codebook of its own, so a pair of codes names a cell. With an
anchor, the score of a cell's vectors is at most the sum of two half-score bounds: the anchor's half by the
code's centre, plus its length by the code's radius. A multi-sequence heap takes cells in falling order of that
sum. It stops once what it looks for is certified: no cell still closed can hold a row that would change the
anchor's positives, or any of the score windows that its positives open for negatives.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import cut

#: Positives of an anchor and negatives of a positive; a negative's score is from LOW to HIGH hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Classes that the codebooks are fitted on, rounds of the fit, codes of a half at most, vectors of a cell aimed at, seed.
SAMPLE, ROUNDS, CODES, CELL, SEED = 20_000, 10, 256, 200, 29
#: Bounds are raised by this part of the largest product, for what rounding takes.
SLACK = 1e-9


def quantised(x: np.ndarray) -> np.ndarray:
    return np.floor(256 * x)


def window(score: int) -> tuple[int, int]:
    """Least and largest score of a negative under a positive's score; empty (least over largest) for a negative one."""
    return -(-LOW * score // 100), HIGH * score // 100


def codebook(x: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by k-means from ``codes`` of the rows."""
    centres = x[rng.permutation(len(x))[:codes]].copy()
    for _ in range(ROUNDS):
        near = nearest_code(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest_code(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * x @ centres.T, axis=1)


def in_order(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of two lists of half-scores by falling sum: (sum, place in one, place in two)."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    heap, rows = [(-(one[a[0]] + two[b[0]]), 0, 0)], len(a)
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(one[a[i]] + two[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < rows:
            heapq.heappush(heap, (-(one[a[i + 1]] + two[b[0]]), i + 1, 0))


class Codes:
    """The two codebooks, the radius of every code, and the cells in use with their blocks."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.width, self.half = sample.shape[1], sample.shape[1] // 2
        rng = np.random.default_rng(SEED)
        self.centres = [codebook(part, codes, rng) for part in self.halves(sample)]
        self.sizes = [len(c) for c in self.centres]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every row, and how far its halves are from their codes."""
        codes, far = [], []
        for part, centres in zip(self.halves(x), self.centres, strict=True):
            near = nearest_code(part, centres)
            codes.append(near)
            far.append(np.sqrt(((part - centres[near]) ** 2).sum(axis=1)))
        return codes[0] * self.sizes[1] + codes[1], np.stack(far, axis=1)

    def use(self, cells: list, most: int) -> None:
        """``cells``: cell, rows, largest distance of a first and of a second half, in order of the cell."""
        self.radius = [np.zeros(n) for n in self.sizes]
        for c in cells:
            for side, code in enumerate(divmod(c.cell, self.sizes[1])):
                self.radius[side][code] = max(self.radius[side][code], (c.far0, c.far1)[side])
        self.where = B.spread_cells([(c.cell, c.n) for c in cells], most)
        self.blocks = max(first + parts for first, parts in self.where.values())

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each code of a half, the most that a vector's half can score with the anchor's."""
        out = []
        for part, centres, radius in zip(self.halves(q[None, :]), self.centres, self.radius, strict=True):
            length = math.sqrt(float((part * part).sum()))
            score = centres @ part[0] + length * radius
            out.append(score + SLACK * (1 + length * (radius + np.sqrt((centres * centres).sum(axis=1)))))
        return out[0], out[1]

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """The cells in use by falling bound, with it."""
        for bound, i, j in in_order(*self.bounds(q)):
            if (cell := i * self.sizes[1] + j) in self.where:
                yield bound, cell


class Block:
    """The vectors of some cells, those of a cell side by side; scores are whole numbers, exact in doubles up to 2**53."""

    def __init__(self, rows: pa.Table, codes: Codes):
        cell = B.lists(rows["more"], 1)[:, 0].astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell, self.codes = cell[order], codes
        self.x = B.matrix(rows["vec"], codes.width)[order]
        self.label = rows["label"].to_numpy()[order]
        ids = rows["ids"].to_pylist()
        self.ids = [ids[i] for i in order]
        names, starts = np.unique(cell, return_index=True)
        self.spans = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cell)], strict=True), strict=True))
        self.first, self.second = (np.unique(c) for c in np.divmod(names, codes.sizes[1]))

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """The block's cells by falling bound: bound, and the span of their rows."""
        one, two = self.codes.bounds(q)
        for bound, i, j in in_order(one[self.first], two[self.second]):
            span = self.spans.get(int(self.first[i] * self.codes.sizes[1] + self.second[j]))
            if span:
                yield bound, *span

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (self.x[rows] @ q).astype(np.int64)

    def best(self, found: list[tuple[int, int]], scores: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k first of ``found`` and the ids of ``rows``, as (minus score, id) in order."""
        if len(rows) > k:
            cut_off = np.partition(scores, len(rows) - k)[len(rows) - k]
            rows, scores = rows[scores >= cut_off], scores[scores >= cut_off]
        new = [(-int(s), i) for s, row in zip(scores.tolist(), rows.tolist(), strict=True) for i in self.ids[row][:k]]
        return sorted(found + new)[:k]


def runs_of(cells: Iterator[tuple[float, int, int]]) -> Iterator[tuple[float, np.ndarray]]:
    """Rows of the next cells, twice as many cells each time, with the bound of what comes after them."""
    waiting, step = [], 1
    for bound, a, b in cells:
        if len(waiting) == step:
            yield bound, np.concatenate(waiting)
            waiting, step = [], 2 * step
        waiting.append(np.arange(a, b))
    if waiting:
        yield -math.inf, np.concatenate(waiting)


class PositivesOf(Block):
    """Answers the best rows of the anchor's own label; ``more``: a score that k rows are known to reach."""

    def __call__(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, known, label = B.matrix(asked["vec"], self.codes.width), B.lists(asked["more"], 1)[:, 0], asked["label"].to_numpy()
        keys, ids, scores = [], [], []
        k = POSITIVES + 1
        for n, key in enumerate(asked["key"].to_pylist()):
            found: list[tuple[int, int]] = []
            for rest, rows in runs_of(self.cells(q[n])):
                rows = rows[self.label[rows] == label[n]]
                got = self.scores(q[n], rows)
                found = self.best(found, got[got >= known[n]], rows[got >= known[n]], k)
                if rest < max(known[n], -found[-1][0] if len(found) == k else -math.inf):
                    break  # certified: what is closed scores less than k rows
            keys += [key] * len(found)
            ids += [i for _, i in found]
            scores += [-s for s, _ in found]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], ["key", "id", "score"])


class NegativesOf(Block):
    """Answers the first rows of other labels in every window; ``more``: positive's score and least score to look for, for each."""

    def __call__(self, asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, label, more = B.matrix(asked["vec"], self.codes.width), asked["label"].to_numpy(), asked["more"].to_pylist()
        keys, positives, ids, scores = [], [], [], []
        for n, key in enumerate(asked["key"].to_pylist()):
            wanted = [(int(p), int(least), window(int(p))[1]) for p, least in zip(more[n][::2], more[n][1::2], strict=True)]
            found: list[list[tuple[int, int]]] = [[] for _ in wanted]
            for rest, rows in runs_of(self.cells(q[n])):
                rows = rows[self.label[rows] != label[n]]
                got = self.scores(q[n], rows)
                open_ = False
                for w, (_, least, most) in enumerate(wanted):
                    inside = (got >= least) & (got <= most)
                    if inside.any():
                        found[w] = self.best(found[w], got[inside], rows[inside], NEGATIVES)
                    open_ |= rest >= (max(least, -found[w][-1][0]) if len(found[w]) == NEGATIVES else least)
                if not open_:
                    break  # certified: what is closed scores less than each window still takes
            for (positive, _, _), own in zip(wanted, found, strict=True):
                keys += [key] * len(own)
                positives += [positive] * len(own)
                ids += [i for _, i in own]
                scores += [-s for s, _ in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(positives, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
            ["key", "positive_score", "id", "score"],
        )


class MultiIndex:
    """The classes of ``groups`` (see :func:`blocks.classes`) in the cells of two codebooks, dealt to blocks."""

    def __init__(self, groups: DataFrame, width: int):
        count = groups.count()
        some = B.matrix(B.sample(groups, count, SAMPLE).select("vec").toArrow()["vec"], width)
        codes = Codes(some, int(min(CODES, max(1, round(math.sqrt(count / CELL))))))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, far = codes.of(B.matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32()), pa.array(far[:, 0]), pa.array(far[:, 1])], ["key", "vec", "ids", "label", "cell", "far0", "far1"]
                )

        placed = cut(
            groups.select("key", "vec", "ids", "label").mapInArrow(
                assign, "key binary, vec binary, ids array<long>, label long, cell int, far0 double, far1 double"
            )
        )
        per = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far0").alias("far0"), F.max("far1").alias("far1"))
        codes.use(per.orderBy("cell").collect(), B.block_rows(count))  # CODES**2 rows at most
        places = groups.sparkSession.createDataFrame([(c, *at) for c, at in codes.where.items()], "cell int, first int, parts int")
        block = F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts").cast("long")).cast("int")
        self.codes = codes
        self.stored = placed.join(F.broadcast(places), "cell").withColumn("block", block).withColumn("more", F.array(F.col("cell").cast("double")))

    def _plan(self, queries: DataFrame, home: bool) -> DataFrame:
        """``queries`` (key, vec, label, more, least) once for each block to ask: that of the first cell, or those of
        all further cells whose bound is not under ``least``."""
        codes = self.codes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, blocks, rows = B.matrix(batch.column(1), codes.width), [], []
                for n, (key, least) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                    own, asked = None, {}
                    for bound, cell in codes.cells(q[n]):
                        first, parts = codes.where[cell]
                        if own is None:
                            own = first + int.from_bytes(key[:4], "little") % parts
                            if home:
                                asked[own] = None
                                break
                        if bound < least:
                            break
                        asked.update(dict.fromkeys(range(first, first + parts)))
                    if not home:
                        asked.pop(own, None)
                    blocks += asked
                    rows += [n] * len(asked)
                sent = batch.select([0, 1, 2, 3]).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), *sent.columns], ["block", "key", "vec", "label", "more"])

        asked = queries.select("key", "vec", "label", "more", "least").mapInArrow(run, "block int, key binary, vec binary, label long, more array<double>")
        return asked.withColumn("ids", F.lit(None).cast("array<long>"))

    def _ask(self, queries: DataFrame, home: bool, kind: type, schema: str) -> DataFrame:
        codes = self.codes
        return B.visit(self.stored, self._plan(queries, home), codes.blocks, lambda rows: kind(rows, codes), schema)

    def positives(self, anchors: DataFrame) -> DataFrame:
        """key, rank, id and score of the first POSITIVES + 1 rows of the label of every anchor (key, vec, label)."""
        k, least = POSITIVES + 1, F.lit(-math.inf)
        schema = "key binary, id long, score long"
        near = cut(self._ask(anchors.withColumn("least", least).withColumn("more", F.array("least")), True, PositivesOf, schema))
        known = B.first_of(near, ["key"], k).where(F.col("rank") == k).select("key", F.col("score").cast("double").alias("least"))
        rest = cut(anchors.join(known, "key", "left").withColumn("least", F.coalesce("least", least)).withColumn("more", F.array("least")))
        return B.first_of(near.union(self._ask(rest, False, PositivesOf, schema)), ["key"], k)

    def negatives(self, anchors: DataFrame, windows: DataFrame) -> DataFrame:
        """key, positive_score, rank, id and score of the first NEGATIVES rows in every window.

        ``windows``: key, positive_score and least, the smallest score that a negative may have.
        """
        group, schema = ["key", "positive_score"], "key binary, positive_score long, id long, score long"

        def asking(open_: DataFrame) -> DataFrame:
            pair = F.sort_array(F.collect_list(F.struct(F.col("positive_score").cast("double").alias("p"), F.col("least").cast("double").alias("l"))))
            one = open_.groupBy("key").agg(F.flatten(F.transform(pair, lambda x: F.array(x["p"], x["l"]))).alias("more"), F.min("least").cast("double").alias("least"))
            return anchors.join(one, "key")

        near = cut(self._ask(asking(windows), True, NegativesOf, schema))
        known = B.first_of(near, group, NEGATIVES).where(F.col("rank") == NEGATIVES).select(*group, F.col("score").alias("known"))
        rest = cut(asking(windows.join(known, group, "left").withColumn("least", F.greatest("least", F.coalesce("known", "least")))))
        return B.first_of(near.union(self._ask(rest, False, NegativesOf, schema)), group, NEGATIVES)


def relabelled(vec_id: Column, label: Column) -> Column:
    """The label that a row counts under: every seventh one has the next of ten."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def mine(rows: DataFrame, label: Column | None = None, anchors: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the hard negatives.

    ``rows``: vec_id, embedding, label, any others; ``label`` is what a row counts under (default:
    :func:`relabelled`), ``anchors`` where a row is an anchor (default: 50 divides vec_id). A component x counts as
    floor(256 * x). Rows with a null vec_id, label, vector or component, or a non-finite one, take no part; a
    shorter vector is as one padded with zeros. Equal rows count once; a row with the anchor's own vec_id is no
    positive. Higher scores come first, ties by smaller vec_id. A positive without a row in its window, and one
    whose score is negative, gives none. Scores are exact up to 2**53. An empty table gives no rows.
    """
    n = F.col("label").cast("long")
    label = relabelled(F.col("vec_id").cast("long"), n) if label is None else label
    anchors = F.col("id") % 50 == 0 if anchors is None else anchors
    read = rows.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    base = cut(B.encoded(read.where("id is not null and label is not null").where(B.is_usable(F.col("v"))), quantised))
    groups = cut(B.classes(base, POSITIVES + 1, anchors))
    width = groups.agg(F.max(F.octet_length("vec"))).first()[0]
    if width is None:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return rows.sparkSession.createDataFrame([], schema)
    index = MultiIndex(groups, max(2, width // 8))
    asking = groups.where("asked").select("key", "vec", "label")
    best = cut(index.positives(asking))
    scores = best.select("key", F.col("score").alias("positive_score")).distinct()
    low = F.expr(f"({LOW} * cast(positive_score as decimal(20, 0)) + 99) div 100")
    negatives = index.negatives(asking, scores.withColumn("least", low).where(F.col("positive_score") >= 0))
    listed = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    own = base.where(anchors).select("key", F.col("id").alias("anchor_id")).distinct().join(listed, "key")
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("anchor_id")), 1, POSITIVES)
    pairs = own.select("key", "anchor_id", F.explode(others).alias("p")).select(
        "key", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")
    )
    lists = negatives.groupBy("key", "positive_score").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    return pairs.join(lists, ["key", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.explode("found").alias("x")).select(
        "anchor_id", "positive_id", F.col("x.rank").cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        "positive_score", F.col("x.score").alias("negative_score"),
    )
