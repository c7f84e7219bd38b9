"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every rule rejects a document whose level (a share in whole percents) is over a cutoff. On the labelled
documents of each stratum (language), the exact binomial test says for every cutoff whether the share of
good documents that the rule rejects is proven to be at most ``ALPHA`` by rule, at a confidence divided by the
number of strata and rules (Bonferroni). Cutoffs of one rule are nested, so testing them from the laxest on
until one fails needs no further correction. Among the proven cutoffs the one that gains most is taken; where
labels are too few to prove any, the rule rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Rule: the count that is held against another count.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
}
#: All rules together may falsely reject so large a share of the good documents of a stratum, but for so
#: small a chance that any of the bounds is wrong.
ALPHA, DELTA = 0.05, 0.05
#: A cutoff must catch that many shares of the bad documents for each share of good ones it costs.
GOOD_COST = 20
#: Strata up to which their cutoffs are broadcast; beyond, they are joined by a shuffle.
BROADCAST_STRATA = 10_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts"]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def with_counts(docs: DataFrame, name: str = "_q") -> DataFrame:
    """Adds the struct ``name`` of COUNTS over the whole text, all computed in place, without a shuffle.

    Three-word windows are compared by 64-bit hashes. A null or empty text has all counts 0.
    """
    w, h, s, p = (f"{name}_{x}" for x in "whsp")
    size = F.size(F.col(w))
    text = text_of()
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window = F.transform(
        F.slice(F.col(w), F.lit(1), F.greatest(size - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)),
    )
    repeated = F.size(F.array_distinct(F.col(h))) < F.size(F.col(h))
    placed = F.sort_array(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    twice = F.filter(
        F.col(s),
        lambda x, j: (F.get(F.col(s), j - 1)["h"] == x["h"]) | (F.get(F.col(s), j + 1)["h"] == x["h"]),
    )
    return (
        docs.withColumns({w: words(text), f"{name}_l": lines})
        .withColumn(h, window)
        .withColumn(s, F.when(repeated, placed))
        .withColumn(p, F.sort_array(F.transform(twice, lambda x: x["i"])))
        .withColumn(
            name,
            F.struct(
                size.cast("long").alias("n_words"),
                F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
                (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                F.size(f"{name}_l").cast("long").alias("n_lines"),
                (F.size(f"{name}_l") - F.size(F.array_distinct(f"{name}_l"))).cast("long").alias("n_dup_lines"),
                F.coalesce(
                    _sum(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(F.col(p), j + 1) - x, F.lit(3))).cast("long"))),
                    F.lit(0),
                ).cast("long").alias("n_repeat_words"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
                (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_shouts"),
            ),
        )
        .drop(w, f"{name}_l", h, s, p)
    )


def settled(counted: DataFrame, name: str = "_q") -> DataFrame:
    """The same rows, with counts that filters may use: filters are not moved below an explode.

    Below the projections of with_counts they would repeat each expression for each use of it.
    """
    others = [F.col(f"`{c}`") for c in counted.columns if c != name]
    return counted.select(*others, F.explode(F.array(name)).alias(name))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def level(q: Column, rule: str) -> Column:
    """A rule's share in whole percents, rounded down, 100 at most; 0 where there is nothing to share."""
    part, whole = (q[x] for x in RULES[rule])
    return F.when(whole > 0, F.least(F.floor(100 * part / whole), F.lit(100))).otherwise(0).cast("int")


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 10, to about 1e-13."""
    y = x + 10
    shift = sum((F.log(x + i) for i in range(10)), F.lit(0.0))
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(n: Column, k: Column, p: float, terms: int = 20_000) -> Column:
    """P(X <= k) for X of n trials with chance p; 1 where k is not under n * p.

    Terms are summed from k down, each from the last one; beyond ``terms`` of them a geometric series
    bounds the rest from above, so the sum never comes out too small.
    """
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(
        _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    )

    def ratio(i: Column) -> Column:
        return i * (1 - p) / ((n - i + 1) * p)

    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("all"))
    steps = F.when(k >= 1, F.sequence(F.lit(0), F.least(k - 1, F.lit(terms)).cast("int"))).otherwise(F.array().cast("array<int>"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] * ratio(k - i)
        return F.struct(term.alias("term"), (a["all"] + term).alias("all"))

    summed = F.aggregate(steps, zero, step)
    last = F.greatest(k - terms - 1, F.lit(0.0))
    rest = F.when(last > 0, summed["term"] * ratio(last) / (1 - ratio(last))).otherwise(0.0)
    return F.when(k >= n * p, 1.0).otherwise(top * (summed["all"] + rest))


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """lang and, for each rule, the cutoff over which a level is rejected (100: nothing is).

    ``measured`` has doc_id, lang and the counts ``_q``; every labelled document that passes the base rules
    is in the holdout. Of several labels of a document the largest counts.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("_good"))
    held = measured.where(~base_failed(F.col("_q"))).join(marks.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), level(F.col("_q"), r).alias("level")) for r in RULES])
    levels = (
        held.select("lang", "_good", F.explode(rules).alias("r"))
        .groupBy("lang", "r.rule", "r.level")
        .agg(F.sum(F.when(F.col("_good") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("_good") == 1, 0).otherwise(1)).alias("bad"))
    )
    counted = cut(
        levels.groupBy("lang", "rule").agg(
            F.collect_list(F.struct("level", "good", "bad")).alias("h"), F.sum("good").alias("n"), F.sum("bad").alias("n_bad")
        )
    )
    tests = counted.count()

    def over(c: Column, what: str) -> Column:
        return _sum(F.transform(F.filter(F.col("h"), lambda x: x["level"] > c), lambda x: x[what]))

    tried = (
        counted.select("*", F.explode(F.sequence(F.lit(0), F.lit(100))).alias("c"))
        .select("lang", "rule", "n", "n_bad", "c", over(F.col("c"), "good").alias("k"), over(F.col("c"), "bad").alias("b"))
        .where(F.col("n") > 0)
        .where(binomial_tail(F.col("n"), F.col("k"), alpha / len(RULES)) <= delta / max(tests, 1))
    )
    gain = F.col("b") * F.col("n") - GOOD_COST * F.col("k") * F.col("n_bad")
    chosen = tried.groupBy("lang", "rule").agg(F.max_by("c", F.struct(gain, "c")).alias("c"))
    return cut(
        chosen.groupBy("lang").agg(*[F.max(F.when(F.col("rule") == r, F.col("c"))).alias(f"_cut_{r}") for r in RULES])
    )


def judged(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds _base_failed and _kept to rows with lang and counts ``_q``."""
    cuts = cuts.withColumnRenamed("lang", "_lang")
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_STRATA else cuts
    passed = F.lit(True)
    for r in RULES:
        passed &= level(F.col("_q"), r) <= F.coalesce(F.col(f"_cut_{r}"), F.lit(100))
    failed = base_failed(F.col("_q"))
    return (
        measured.join(cuts, measured["lang"].eqNullSafe(F.col("_lang")), "left")
        .withColumns({"_base_failed": failed, "_kept": ~failed & passed})
        .drop("_lang", *[f"_cut_{r}" for r in RULES])
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs`` (doc_id, text, lang, any others).

    A null language is a stratum of its own. A null or empty text fails the base rules. Repeated rows are
    judged alike. Without labels only the base rules reject; an empty table gives no rows.
    """
    measured = cut(with_counts(docs.select("doc_id", "text", "lang")).select("doc_id", "lang", "_q"))
    rows = judged(measured, cutoffs(measured, labels))
    return rows.select("doc_id", "lang", "_q.*", F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; counts are made anew rather than joined to texts."""
    measured = settled(with_counts(docs.select("doc_id", "text", "lang")).select("doc_id", "lang", "_q"))
    cuts = cutoffs(measured, labels)
    return judged(settled(with_counts(docs)), cuts).where("_kept").select(*docs.columns)
