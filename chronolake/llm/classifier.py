"""Quality classifier: ridge scores over random Fourier features of document statistics, calibrated.

A document becomes a short vector of statistics of its whole text. Cosines of random projections approximate a
Gaussian kernel over the standardised vectors; every partition sums its part of the normal equations, the
sums are added up, and the driver solves one system of FEATURES + 1 unknowns. Isotonic regression on rows
that the fit has not seen turns ridge scores into chances.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of
from .quality_rules import with_counts

FEATURES, RIDGE, SEED = 256, 1e-4, 11
#: Statistics of a document.
STATISTICS = 15
#: Labelled rows that are learned from, at most (chosen by hash); the fit is no better with more.
TRAIN_ROWS = 400_000
#: Partitions that the training rows are spread over, and bins of the ridge score that isotonic regression sees.
PARTS, BINS = 16, 2_000
LIMIT = 0.3
NOT_ASCII = re.compile(r"[^\x00-\x7f]")


class Characters:
    """Counts over a text in one pass of its bytes: digits, sentence marks, commas, bars, vowels, letters, distinct words."""

    def __init__(self):
        groups = ["0123456789", ".?", ",;:", "|", "aeiouAEIOU"]
        self.groups = [np.frombuffer(g.encode(), np.uint8) for g in groups]
        self.letters = np.array([i for i in range(128) if chr(i).isalpha()])

    def count(self, text: str) -> list[int]:
        data = text.encode()
        seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, dtype=int)
        letters = int(seen[self.letters].sum())
        if seen[128:].any():
            letters += sum(map(str.isalpha, NOT_ASCII.findall(text)))
        return [*(int(seen[g].sum()) for g in self.groups), letters, len(set(data.split()))]


def statistics(docs: DataFrame, name: str = "x") -> DataFrame:
    """doc_id and the array ``name``: statistics of the whole text; all 0 for an empty or null one.

    Neither language nor source nor doc_id goes in.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters = Characters()
        for batch in batches:
            n = {c: batch.column(i + 2).to_numpy().astype(float) for i, c in enumerate(counts)}
            own = np.array([characters.count(t) for t in batch.column(1).to_pylist()], dtype=float).reshape(-1, 7)
            digits, marks, commas, bars, vowels, letters, distinct = own.T

            def share(part: np.ndarray, whole: np.ndarray, most: float = 1.0) -> np.ndarray:
                return np.minimum(np.divide(part, whole, out=np.zeros_like(part), where=whole > 0), most)

            columns = [
                np.log1p(n["n_words"]) / 10,
                share(n["word_chars"], 10 * n["n_words"], 5.0),
                share(n["n_symbols"], n["word_chars"]),
                share(n["n_dup_lines"], n["n_lines"]),
                share(n["n_repeat_words"], n["n_words"]),
                share(n["n_capitals"], n["word_chars"]),
                share(n["n_shouts"], n["n_words"], 3.0),
                share(bars, n["n_words"], 3.0),
                share(digits, n["word_chars"]),
                share(marks, n["n_words"], 3.0),
                share(commas, n["n_words"], 3.0),
                share(distinct, n["n_words"]),
                share(letters, n["word_chars"]),
                share(vowels, n["word_chars"]),
                np.log1p(share(n["n_words"], n["n_lines"], 1e9)) / 10,
            ]
            x = np.stack(columns, axis=1)
            ends = np.arange(0, STATISTICS * len(x) + 1, STATISTICS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["doc_id", name])

    counted = with_counts(docs.select("doc_id", "text"))
    read = counted.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("t"), *[F.col("_q")[c].alias(c) for c in counts])
    return read.mapInArrow(run, f"doc_id long, {name} array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 5; a null doc_id is as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


class Model:
    """Standardisation, projections, ridge weights and the calibration curve."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        d = len(mean)
        self.projection = rng.normal(scale=1 / np.sqrt(d / 2), size=(d, FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps, self.chances = np.array([0.0]), np.array([0.5])

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -4, 4)
        waves = np.sqrt(2 / FEATURES) * np.cos(z @ self.projection + self.phase)
        return np.hstack([waves, np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; a hundredth of it follows the ridge score, so that equal chances keep their order."""
        r = self.ridge(x)
        return 0.99 * np.interp(r, self.steps, self.chances) + 0.01 / (1 + np.exp(-np.clip(4 * (r - 0.5), -30, 30)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _normal_sums(model: Model, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of Z'Z and Z'y over ``rows`` (x, y): one pair for each partition, then added in tasks."""
    size = FEATURES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                z = model.expand(_matrix(batch.column(0)))
                a += z.T @ z
                b += z.T @ batch.column(1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([np.vstack([a, b]).tobytes()])], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data).reshape(size + 1, size)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    sums = rows.select("x", "y").mapInArrow(partial, "sums binary")
    for tasks in (PARTS // 4, 1):  # a tree: no task adds up all partitions' sums
        sums = sums.repartition(tasks).mapInArrow(add, "sums binary")
    sums = sums.first()
    total = np.frombuffer(sums.sums).reshape(size + 1, size)
    return total[:-1], total[-1]


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending x with means y and weights n: block centres and their values."""
    blocks: list[list[float]] = []
    for xi, yi, ni in zip(x, y, n, strict=True):
        blocks.append([xi * ni, yi * ni, ni])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """The model of ``described`` (doc_id, x) and ``labels`` (doc_id, quality).

    Only rows whose fold is not 0 are learned from: folds 2 to 4 fit the weights, fold 1 calibrates them. Of
    several labels of a document the largest counts. With no labels, or labels of one kind, every score is
    the share of good ones (0.5 without any).
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("q"))
    marks = marks.where(fold(F.col("_id")) != 0)
    part = min(1.0, TRAIN_ROWS / max(1, marks.count()))
    chosen = marks.where(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1_000_000)) < int(part * 1_000_000))
    held = described.join(chosen, F.col("doc_id") == F.col("_id")).select(
        "doc_id", "x", (F.col("q") == 1).cast("double").alias("y"), fold(F.col("doc_id")).alias("fold")
    )
    held = cut(held.repartition(PARTS, "doc_id"))
    stats = held.agg(
        F.count("*").alias("n"),
        F.avg("y").alias("y"),
    ).first()
    d = STATISTICS
    per = held.agg(*[f(F.col("x")[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first() if stats.n else None
    model = Model(
        np.array([per[f"m{i}"] for i in range(d)]) if per else np.zeros(d), np.array([per[f"s{i}"] for i in range(d)]) if per else np.ones(d)
    )
    model.chances = np.array([stats.y if stats.n else 0.5])
    if not stats.n or stats.y in (0.0, 1.0):
        return model
    z, y = _normal_sums(model, held.where("fold <> 1"))
    model.weights = np.linalg.solve(z + RIDGE * max(1.0, z[-1, -1]) * np.eye(len(y)), y)

    def ridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                r = model.ridge(_matrix(batch.column(0)))
                yield pa.RecordBatch.from_arrays([pa.array(r), batch.column(1)], ["r", "y"])

    low, high = -0.5, 1.5
    scored = held.where("fold = 1").select("x", "y").mapInArrow(ridge, "r double, y double")
    where = F.floor((F.least(F.greatest("r", F.lit(low)), F.lit(high)) - low) / (high - low) * (BINS - 1))
    bins = scored.groupBy(where.alias("bin")).agg(F.avg("r").alias("r"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()
    if bins:
        model.steps, model.chances = isotonic(*(np.array([float(b[k]) for b in bins]) for k in ("r", "y", "n")))
    return model


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text, any others).

    Empty and null texts are scored by their statistics like any other; repeated rows get equal scores; a
    null doc_id is held out. An empty table gives no rows.
    """
    described = cut(statistics(docs))
    model = fit(described, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], ["doc_id", "score"])

    return described.mapInArrow(score, "doc_id long, score double").select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )
