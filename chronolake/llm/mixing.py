"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a word target: its share of all words by weight, at most three times what it has. Its
documents are taken in complete epochs first; what is left of the target is filled in the order of
exponential keys, ``-ln(u) / w`` with w the document's quality weight, so heavier documents come earlier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import before, buckets_for, cut, text_of, words

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"


def quality_weight(text: Column, n_words: Column) -> Column:
    """0.1 to 1: the share of letters, digits and white space among the characters of the text.

    Symbols, bars and shouting marks lower it; an empty text weighs 0.1.
    """
    plain = F.length(F.regexp_replace(text, r"[!#*$%&|<>=_~^]", ""))
    return F.when(n_words == 0, F.lit(0.1)).otherwise(0.1 + 0.9 * plain / F.length(text))


def unit_hash(*parts: Column) -> Column:
    """A number over 0 and under 1 from 13 hex digits of the MD5 of the parts."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(SEED), *parts)), 1, 13), 16, 10).cast("long")
    return (digits + F.lit(0.5)) / F.lit(float(2**52))


def measured(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source_key, size, key and ``extra`` columns: the text is read here once and not carried on.

    source_key is the source behind a letter (``a``), or ``b`` for null, so that nulls come last.
    """
    text = text_of()
    size = F.size(words(text)).cast("long")
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("b")).alias("source_key"),
        size.alias("size"),
        quality_weight(text, size).alias("weight"),
        *extra,
    )
    u = unit_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return sized.withColumn("key", -F.log(u) / F.col("weight")).drop("weight")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source_key, source_size and target of every source (one row each).

    Sources in the order of their code points, null last, weigh 5, 2, 1 and so on. In the order of size
    by weight, a source is cut to three times its size while its share of what the earlier ones left is
    more than that; the rest share by weight.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy("source_key")
    by_room = every.orderBy(F.col("source_size") / F.col("weight"), "source_key")
    later = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    room = MOST_EPOCHS * F.col("source_size")
    return (
        sized.groupBy("source_key")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("rank", F.lit(len(weights))) + 1))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum(room).over(earlier), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(later))
        .withColumn("full", F.col("weight") * F.col("left") >= room * F.col("sharing"))
        .withColumn("share", F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), "source_key", "left", "sharing"))).over(every))
        .select(
            "source_key",
            "source_size",
            F.when(F.col("full"), room.cast("double"))
            .otherwise(F.col("weight") * F.col("share.left") / F.col("share.sharing"))
            .alias("target"),
        )
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs and taken (words) of every row of ``docs``.

    ``extra`` names columns to carry through, which also break ties of the key, the doc_id and the size.

    Documents are taken whole. After the complete epochs, documents are taken once more in key order; the
    one at which the target is crossed is taken if that leaves the source nearer to its target. Ties of
    the key go by doc_id and size; repeated rows are documents of their own. A null text has no words, a
    null source is a source of its own, and an empty table gives no rows.
    """
    sized = cut(measured(docs, extra))
    n_buckets = buckets_for(sized.count())
    goals = cut(targets(sized, weights))
    # Falls with no key: 1 - exp(-key) grows with it, and is spread evenly where the weights are 1.
    sized = sized.withColumn("bucket", F.floor(n_buckets * (1 - F.exp(-F.col("key")))).cast("int"))
    order = [F.col("key"), F.col("doc_id"), F.col("size"), *[F.col(c) for c in extra]]
    epochs = F.least(F.lit(MOST_EPOCHS), F.floor(F.col("target") / F.col("source_size")))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    return (
        before(sized, ["source_key"], "bucket", order, F.col("size"), "earlier")
        .join(goals, "source_key")
        .withColumn("epochs", F.when(F.col("source_size") > 0, epochs).otherwise(0).cast("long"))
        .withColumn("more", (F.col("size") > 0) & (2 * (rest - F.col("earlier")) >= F.col("size")))
        .select(
            "doc_id",
            F.when(F.col("source_key").startswith("a"), F.expr("substring(source_key, 2)")).alias("source"),
            "size",
            "source_size",
            "target",
            (F.col("epochs") + F.col("more").cast("long")).alias("epochs"),
            ((F.col("epochs") + F.col("more").cast("long")) * F.col("size")).alias("taken"),
            *extra,
        )
    )


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows are known by doc_id, source and text. Of rows that share all three the mix may take some once more than
    the others; so many of them, by their place in ``docs``, are. Nulls are values like any other, rows without
    words are not taken, and an empty table gives no rows.
    """
    known = docs.withColumn("_digest", F.md5(text_of()))
    own = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "source")], F.col("source").isNull().cast("string"), F.col("doc_id").isNull().cast("string"), F.col("_digest")))
    known = known.withColumn("_own", own)
    mixed = mix(known, weights, ("_own",)).groupBy("_own").agg(F.min("epochs").alias("_epochs"), (F.sum("epochs") - F.count("*") * F.min("epochs")).alias("_more"))
    taken = known.join(mixed.where("_epochs > 0 or _more > 0"), "_own")
    # At most the one group of a source at which its target is crossed is taken in part.
    parted = cut(taken.where("_more > 0").withColumn("_at", F.monotonically_increasing_id()).withColumn("_bucket", F.shiftright("_at", 33)))
    parted = before(parted, ["_own"], "_bucket", [F.col("_at")], F.lit(1), "_place")
    parted = parted.withColumn("_epochs", F.col("_epochs") + (F.col("_place") < F.col("_more")).cast("long"))
    every = taken.where("_more = 0").select(*docs.columns, "_epochs").union(parted.select(*docs.columns, "_epochs"))
    copies = F.when(F.col("_epochs") > 0, F.sequence(F.lit(1), F.col("_epochs").cast("int"))).otherwise(F.array().cast("array<int>"))
    return every.withColumn("_copy", F.explode(copies)).select(*docs.columns)
