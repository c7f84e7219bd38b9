"""Merkle manifest of a dataset: a persistent tree whose versions copy paths only.

A row's leaf is the hash of its fields. The rows of a source, in order of doc_id, are the leaves of a tree with
16 children to a node; the roots of the sources, in order, are the leaves of the dataset's tree. Trees are built
by aligned blocks of 16**3 nodes (three levels), a task each; the roots of the blocks are the nodes of the next
round, until a tree has one. A changed leaf makes a version of the dataset: it copies its ancestors, in its block
first and then through the upper levels, whose siblings reach the block as one short path, and shares every other
node with the tree it was made from.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Children of a node, and levels that one block rises: it has WIDTH**RISE leaves.
WIDTH, RISE = 16, 3
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The dataset's tree; a source's tree is ``n`` (null) or ``s`` and the source.
TOP = ""
#: Rows of starts that are broadcast at most (counted first).
SMALL = 50_000
NODES = "tree string, level int, idx long, digest string, size long, top boolean"
PATHS = "tree string, idx long, root string, before array<string>, after array<string>"
ROWS = "tree string, idx long, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, copies array<string>"


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree of so many."""
    levels = 0
    while size > 1:
        size, levels = -(-size // WIDTH), levels + 1
    return levels


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(**fields: Column) -> Column:
    """The hash of a row's fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    return F.sha2(F.concat(*[_field(fields[c]) for c in FIELDS]), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a row is changed: 5 divides the crc32 of its doc_id in decimal; a null doc_id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf and changed (the leaf after the row's A-Z were lower-cased; null if the row stays)."""
    fields = {c: F.col(c) for c in FIELDS}
    lowered = fields | {"text": F.translate("text", UPPER, LOWER)}
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(**fields).alias("leaf"),
        F.when(tampered(F.col("doc_id")), leaf(**lowered)).alias("changed"),
    )


def positioned(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds idx (place among the rows of its tree, from 0) and size (rows of the tree) to ``rows``, which are cut.

    Rows are dealt by ranges of (tree, order, row), so that a large tree, or many equal rows, take many tasks;
    what lies before each range is one row for each tree and task.
    """
    keys = ["tree", *order, "_row"]
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = cut(ranged.drop("_row").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(
        numbered.groupBy("tree", "_part")
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .select("tree", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"), F.sum("_n").over(Window.partitionBy("tree")).alias("size"))
    )
    starts = F.broadcast(starts) if starts.count() <= SMALL else starts
    return numbered.join(starts, ["tree", "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_start")).drop("_at", "_part", "_first", "_start")


def _levels(digests: list[str], size: int, rise: int) -> list[list[str]]:
    """The block's nodes, level by level, in a tree of ``size`` nodes."""
    levels = [digests]
    for _ in range(min(rise, height(size))):
        low = levels[-1]
        levels.append([digest_of("".join(low[i : i + WIDTH])) for i in range(0, len(low), WIDTH)])
    return levels


def _siblings(levels: list[list[str]]) -> list[tuple[list[str], list[str]]]:
    """For every node of the block: its siblings before and after it, level by level up to the block's root."""
    runs = [[(low[i : i + WIDTH]) for i in range(0, len(low), WIDTH)] for low in levels[:-1]]
    out = []
    for i in range(len(levels[0])):
        before, after = [], []
        for own in runs:
            run = own[i // WIDTH]
            before.append("".join(run[: i % WIDTH]))
            after.append("".join(run[i % WIDTH + 1 :]))
            i //= WIDTH
        out.append((before, after))
    return out


def fold(start: str, before: list[str], after: list[str]) -> list[str]:
    """The ancestors of a node, from its parent to the root, recomputed from it and its siblings."""
    copies = []
    for left, right in zip(before, after, strict=True):
        start = digest_of(left + start + right)
        copies.append(start)
    return copies


def _blocks(nodes: DataFrame, rise: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"idx div {WIDTH**rise}"))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    """Rows under the Arrow form of a DDL schema of strings, numbers and lists of strings."""
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    fields = [(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _rise(rise: int, group: pa.Table) -> pa.Table:
    """The nodes above those of a block (tree, idx, digest, size, level, block); ``top``: those it ends with."""
    own = group.sort_by("idx").to_pydict()
    tree, size, block, level = (own[c][0] for c in ("tree", "size", "block", "level"))
    levels, rows = _levels(own["digest"], size, rise), []
    for up, digests in enumerate(levels[1:], start=1):
        first = block * WIDTH ** (rise - up)
        rows += [(tree, level + up, first + i, d, -(-size // WIDTH**up), up == len(levels) - 1) for i, d in enumerate(digests)]
    return _table(rows, NODES)


def upper_nodes(bottom: DataFrame, rise: int) -> tuple[DataFrame, list[DataFrame]]:
    """All nodes above ``bottom`` (tree, level, idx, digest, size), and the nodes that each round began with.

    A round lifts every block by ``rise`` levels, so there is one for each factor of 16**rise in the largest
    tree. Trees that have come down to one node take no further part.
    """
    rounds, above = [bottom], []
    while not rounds[-1].where("size > 1").isEmpty():
        made = cut(_blocks(rounds[-1].where("size > 1"), rise).groupBy("tree", "block").applyInArrow(lambda group: _rise(rise, group), NODES))
        above.append(made)
        rounds.append(made.where("top").select("tree", "level", "idx", "digest", "size"))
    nodes = bottom.where("level > 0")
    for made in above:
        nodes = nodes.union(made.select(*nodes.columns))
    return nodes, rounds


def _paths_of_block(rise: int, group: pa.Table, upper: pa.Table) -> pa.Table:
    """The paths of the nodes of a block, which go on with the one of the block's root."""
    own, rows = group.sort_by("idx").to_pydict(), []
    if own["idx"]:
        levels = _levels(own["digest"], own["size"][0], rise)
        above = upper.to_pylist()[0]
        for tree, idx, (before, after) in zip(own["tree"], own["idx"], _siblings(levels), strict=True):
            rows.append((tree, idx, above["root"], before + above["before"], after + above["after"]))
    return _table(rows, PATHS)


def _with_upper(nodes: DataFrame, upper: DataFrame, rise: int, work, schema: str) -> DataFrame:
    """``work`` on every block of ``nodes`` and the path of its root (``upper``, by tree and idx of the block)."""
    own = upper.withColumnRenamed("idx", "block")
    return _blocks(nodes, rise).groupBy("tree", "block").cogroup(own.groupBy("tree", "block")).applyInArrow(lambda group, upper: work(rise, group, upper), schema)


def paths(rounds: list[DataFrame], rise: int) -> DataFrame:
    """The path of every node of the first round: root of its tree, and siblings up to it, level by level."""
    last = rounds[-1].where("size = 1")
    none = F.array().cast("array<string>")
    found = cut(last.select("tree", "idx", F.col("digest").alias("root"), none.alias("before"), none.alias("after")))
    for nodes in reversed(rounds[:-1]):
        single = nodes.where("size = 1").select("tree", "idx", F.col("digest").alias("root"), none.alias("before"), none.alias("after"))
        found = cut(_with_upper(nodes.where("size > 1"), found, rise, _paths_of_block, PATHS).union(single))
    return found


def _proofs_of_block(rise: int, group: pa.Table, upper: pa.Table) -> pa.Table:
    """Proof, fold and version of the leaves of a block, all the way to the dataset's root."""
    own, rows = group.sort_by("idx").to_pydict(), []
    if own["idx"]:
        siblings = _siblings(_levels(own["digest"], own["size"][0], rise))
        above = upper.to_pylist()[0]
        rest = "".join(b + a for b, a in zip(above["before"], above["after"], strict=True))
        for tree, idx, doc_id, digest, changed, (before, after) in zip(*(own[c] for c in ("tree", "idx", "doc_id", "digest", "changed")), siblings, strict=True):
            proof = digest_of("".join(b + a for b, a in zip(before, after, strict=True)) + rest)
            start = digest if changed is None else changed
            copies = [start, *fold(start, before + above["before"], after + above["after"])]
            rows.append((tree, idx, doc_id, digest, above["subroot"], above["root"], proof, copies[-1], None if changed is None else copies))
    return _table(rows, ROWS)


class Manifest:
    """The tree of a table (doc_id, source, lang, n_chars, text, any others) and the versions of its changed rows.

    ``rows``: tree, idx, doc_id, leaf, subroot, root, proof_sha256, folded_root, copies (the changed leaf and the
    ancestors that the row's version copies, bottom up; null where the row is unchanged). ``nodes``: tree, level,
    idx, digest of the base version; level 0 are the leaves, and in the dataset's tree the subroots.

    Rows without a doc_id come first in their source; rows that share one go by leaf. A null source is a source of
    its own, before all others. Texts are hashed whole, however long. Repeated rows are leaves each. An empty table
    has no rows and no nodes.
    """

    def __init__(self, docs: DataFrame, rise: int = RISE):
        self.bottom = cut(positioned(cut(leaves(docs)), ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest").withColumn("level", F.lit(0)))
        upper, rounds = upper_nodes(self.bottom.select("tree", "level", "idx", "digest", "size"), rise)
        # From here on all is by block of leaves: one row for 16**rise of them.
        blocks = rounds[1] if len(rounds) > 1 else rounds[0].limit(0)
        single = rounds[0].where("size = 1").select("tree", "level", "idx", "digest", "size")
        own = paths([blocks.union(single), *rounds[2:]], rise)
        subroots = own.groupBy("tree").agg(F.first("root").alias("digest"))
        ordered = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("source_tree"), "digest")
        top = cut(positioned(cut(ordered), ["source_tree"]).withColumn("level", F.lit(0)))
        top_upper, top_rounds = upper_nodes(top.select("tree", "level", "idx", "digest", "size"), rise)
        of_source = top.select("idx", "source_tree").join(paths(top_rounds, rise).withColumnsRenamed({"before": "b", "after": "a", "root": "top"}), "idx")
        of_source = of_source.select(F.col("source_tree").alias("tree"), "idx", "b", "a", "top")
        self.upper = cut(
            own.join(of_source.drop("idx"), "tree").select(
                "tree", "idx", F.col("root").alias("subroot"), F.col("top").alias("root"),
                F.concat("before", "b").alias("before"), F.concat("after", "a").alias("after"),
            )
        )
        base = self.bottom.select("tree", "level", "idx", "digest", "size").union(upper.select("tree", "level", "idx", "digest", "size"))
        tops = top.select("tree", "level", "idx", "digest", "size").union(top_upper.select("tree", "level", "idx", "digest", "size"))
        self.nodes = base.union(tops).select("tree", "level", "idx", "digest")
        self.sources = of_source.select("tree", F.col("idx").alias("place"))
        self.rows = _with_upper(self.bottom, self.upper, rise, _proofs_of_block, ROWS)

    def versions(self) -> DataFrame:
        """The nodes that versions hold of their own: version (doc_id), tree, level, idx, digest.

        A version's node at (tree, level, idx) is the one listed here, or else the base version's.
        """
        sizes = self.bottom.groupBy("tree").agg(F.max("size").alias("size"))
        levels = F.aggregate(
            F.sequence(F.lit(1), F.lit(16)),
            F.struct(F.col("size").alias("n"), F.lit(0).alias("h")),
            lambda s, _: F.struct(F.ceil(s["n"] / WIDTH).cast("long").alias("n"), (s["h"] + F.when(s["n"] > 1, 1).otherwise(0)).alias("h")),
        )["h"]
        made = self.rows.where("copies is not null").join(sizes, "tree").join(self.sources, "tree").withColumn("h", levels)
        one = made.select("doc_id", "tree", "idx", "place", "h", F.posexplode("copies").alias("at", "digest"))
        above = F.greatest(F.col("at") - F.col("h"), F.lit(0))
        inside = one.where("at <= h").select("doc_id", "tree", F.col("at").alias("level"), _raised(F.col("idx"), F.col("at")).alias("idx"), "digest")
        outside = one.where("at >= h").select("doc_id", F.lit(TOP).alias("tree"), above.alias("level"), _raised(F.col("place"), above).alias("idx"), "digest")
        return inside.union(outside).withColumnRenamed("doc_id", "version")


def _raised(idx: Column, levels: Column) -> Column:
    return F.floor(idx / F.pow(F.lit(float(WIDTH)), levels)).cast("long")


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row (see :class:`Manifest`)."""
    rows = Manifest(docs).rows
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
