"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A text's k-mers are its five-word shingles, each labelled with its occurrence number, so that repeats count. For
every band the few labelled k-mers of least hash are taken and kept in the order of the text: two texts meet in a
band when they share these k-mers in the same order, which follows their edit similarity rather than their set
overlap. Texts that meet are compared with the leader of their bucket first, the text that meets most others: their
labelled k-mers are aligned within a band around the diagonal, and a link needs aligned k-mers of at least 0.8 of
all. An odd sketch of each text, the parity of its k-mers in each of 2,048 cells, rules pairs out before: two
sketches never differ in more cells than the texts differ in k-mers, so no link is lost by it. Connected texts form
a class. What then still shares a bucket but no
class is compared pair by pair where few texts are outside the bucket's largest class; the texts of other buckets
are sampled anew, with more k-mers to a band and more bands, so that unlike texts part and like ones meet again,
round by round, until every bucket has few such texts or is one class. The work grows with the number of texts in
such buckets, not with its square.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

WORDS, SIMILARITY = 5, 0.8
#: Bands, and k-mers sampled for each. At similarity 0.8 two texts meet in a band with a chance of about 0.8**3:
#: they share fewer than SHARED of the 16 once in about 5,000 pairs, and fewer than SHARED_LATER once in 160. Only
#: pairs of more than BLUNT k-mers in all need them (SHARED_LATER without the leader of their bucket): for them the
#: odd sketch rules out less and less.
BANDS, SAMPLED, SHARED, SHARED_LATER = 16, 3, 2, 4
#: A bucket with so many texts outside its largest class is compared class by class. Each later round samples DEEPER
#: k-mers more for a band, and takes so many bands that texts of similarity 0.8 miss each other in all of them with
#: a chance of exp(-MEET).
SMALL, DEEPER, MEET = 48, 8, 4.0
#: Cells of an odd sketch; k-mers of a pair beyond which it no longer tells a similarity of 0.7 from one of 0.8.
CELLS, BLUNT = 2048, 3072
#: Texts that one chunk holds against a leader; words that a task keeps the hash of.
CHUNK, CACHE = 64, 1_000_000
#: Wanted rows whose digests are broadcast at most (counted first); beyond, the texts are shuffled to them.
BROADCAST_ROWS = 500_000
#: Rows of links, roots and buckets that a task reads, about.
TASK_ROWS = 100_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_WORD = re.compile(r"[^\W_]+")
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def seeds(bands: int, turn: int = 0) -> np.ndarray:
    return np.random.default_rng([5, turn]).integers(1, 2**63, size=(bands, 1), dtype=np.uint64)


class Words(dict):
    """64-bit hashes of the words of texts: runs of letters and digits in lower case, or where a text has none, what
    white space separates."""

    def __missing__(self, word: bytes) -> int | tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        parts = [word] if word.isascii() else [w.encode() for w in _WORD.findall(word.decode())]
        found = tuple(xxhash.xxh64_intdigest(w) for w in parts)
        self[word] = found[0] if len(found) == 1 else found
        return self[word]

    def of(self, text: str | None) -> np.ndarray:
        low = (text or "").lower()
        found = list(map(self.__getitem__, low.encode().translate(_SPACED).split()))
        try:
            hashes = np.array(found, dtype=np.uint64)
        except (TypeError, ValueError):  # parts of some word: flat, in order
            hashes = np.array([h for x in found for h in (x if isinstance(x, tuple) else (x,))], dtype=np.uint64)
        if not len(hashes):
            hashes = np.array([xxhash.xxh64_intdigest(b"\0" + w.encode()) for w in low.split()], dtype=np.uint64)
        return hashes


def node_of(words: np.ndarray) -> bytes:
    """Texts of the same words are one node."""
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def labelled_kmers(words: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers in text order, each mixed with how often it came before; a shorter text is one k-mer."""
    words = words.view(np.uint64)
    if len(words) < WORDS:
        words = np.concatenate([words, np.full(WORDS - len(words), len(words), dtype=np.uint64)])
    n = len(words) - WORDS + 1
    kmers = words[:n].copy()
    for j in range(1, WORDS):
        kmers = _mixed(kmers) + words[j : j + n]
    kmers = _mixed(kmers)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    same = ranked[1:] == ranked[:-1]
    if same.any():
        run = np.arange(n)
        starts = np.where(np.concatenate([[True], ~same]), run, 0)
        seen = np.empty(n, dtype=np.uint64)
        seen[order] = run - np.maximum.accumulate(starts)
        kmers = np.where(seen > 0, _mixed(kmers + seen * _MIX2), kmers)
    return kmers


def samples(kmers: np.ndarray, bands: np.ndarray, sampled: int) -> np.ndarray:
    """One hash for each band (a seed): its ``sampled`` least labelled k-mers, in text order."""
    take = min(sampled, len(kmers))
    out = np.empty(len(bands), dtype=np.uint64)
    step = max(1, 320_000 // len(kmers))
    for at in range(0, len(bands), step):
        ranks = _mixed(kmers[None, :] ^ bands[at : at + step])
        least = np.argpartition(ranks, take - 1, axis=1)[:, :take] if take < len(kmers) else np.tile(np.arange(take), (len(ranks), 1))
        least.sort(axis=1)
        mixed = np.arange(at, at + len(least), dtype=np.uint64) * _MIX2
        for j in range(take):
            mixed = _mixed(mixed + kmers[least[:, j]])
        out[at : at + step] = mixed
    return out.view(np.int64)


def odd_sketch(kmers: np.ndarray) -> np.ndarray:
    """The parity of the labelled k-mers in each of CELLS cells, 64 to a number."""
    cells = _mixed(kmers ^ _MIX2) % np.uint64(CELLS)
    odd = np.bincount(cells.astype(np.int64), minlength=CELLS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


class Leader:
    """A text's labelled k-mers, ready to be aligned with others."""

    def __init__(self, kmers: np.ndarray):
        self.order = np.argsort(kmers)
        self.ranked = kmers[self.order]

    def similarity(self, other: np.ndarray) -> float:
        """Aligned k-mers by all k-mers of both texts; 0 where it must be under SIMILARITY.

        Labelled k-mers are distinct, so the longest common subsequence is the longest rising run of their
        matched positions. An aligned pair cannot be further off the diagonal than the k-mers that stay
        unmatched, a ninth of both texts at similarity 0.8: what is outside that band is left out.
        """
        n, m = len(self.ranked), len(other)
        if min(n, m) < SIMILARITY * max(n, m):
            return 0.0
        found = np.minimum(np.searchsorted(self.ranked, other), n - 1)
        theirs = np.flatnonzero(self.ranked[found] == other)
        if len(theirs) < SIMILARITY * (n + m - len(theirs)):
            return 0.0
        own = self.order[found[theirs]]
        own = own[np.abs(own - theirs) <= (n + m) * (1 - SIMILARITY) / (1 + SIMILARITY)]
        matched = len(own)
        if matched > 1 and not (np.diff(own) > 0).all():
            tails: list[int] = []
            for x in own.tolist():
                i = bisect.bisect_left(tails, x)
                tails[i : i + 1] = [x]
            matched = len(tails)
        return matched / (n + m - matched)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The same for two texts given by the hashes of their words."""
    return Leader(labelled_kmers(a)).similarity(labelled_kmers(b))


def _int_lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(r) for r in rows]]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)))


def row_key(docs: DataFrame) -> Column:
    """Digest of doc_id and text: what tells rows apart."""
    return F.unhex(F.md5(F.concat(F.coalesce(docs["doc_id"].cast("string"), F.lit("-")), F.lit(":"), F.coalesce(docs["text"].cast("string"), F.lit("")))))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, own (digest of the row), node (digest of the words), bands, odd sketch and size (k-mers) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bands = Words(), seeds(BANDS)
        for batch in batches:
            nodes, found, odd, sizes = [], [], [], []
            for text in batch.column(2).to_pylist():
                hashes = words.of(text)
                kmers = labelled_kmers(hashes)
                nodes.append(node_of(hashes))
                found.append(samples(kmers, bands, SAMPLED))
                odd.append(odd_sketch(kmers))
                sizes.append(len(kmers))
            made = [pa.array(nodes, pa.binary()), _int_lists(found), _int_lists(odd), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "own", "node", "bands", "odd", "size"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("own"), text_of().alias("t"))
    return read.mapInArrow(run, "doc_id long, own binary, node binary, bands array<long>, odd array<long>, size int")


def kmers_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and kmers (labelled k-mers in text order, as bytes) of the rows named by ``wanted`` (own, node; cut)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in (batch.slice(a, 500) for a in range(0, batch.num_rows, 500)):
                made = [labelled_kmers(words.of(t)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.large_binary()).cast(pa.binary())], ["node", "kmers"])

    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.select(row_key(docs).alias("own"), text_of().alias("t")).join(wanted, "own").groupBy("node").agg(F.any_value("t").alias("t"))
    return texts.mapInArrow(run, "node binary, kmers binary")


def verified(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar.

    The pairs of a are dealt to chunks; a's k-mers come first in each and are sent once for all its pairs there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, leader = None, None
        for batch in batches:
            a, b = [], []
            for node, other, data in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "kmers")), strict=True):
                kmers = np.frombuffer(data, dtype=np.uint64)
                if other is None:
                    if node != at:
                        at, leader = node, Leader(kmers)
                elif leader.similarity(kmers) >= SIMILARITY:
                    a.append(node)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = cut(pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk")))
    heads = dealt.select("a", "chunk").distinct().join(grams.withColumnRenamed("node", "a"), "a").select("a", "chunk", F.lit(None).cast("binary").alias("b"), "kmers")
    tails = dealt.join(grams.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "kmers")
    both = heads.union(tails).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return both.mapInArrow(run, "a binary, b binary")


def _shared_bands(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)


def _odd_cells(a: Column, b: Column) -> Column:
    """Cells in which two odd sketches differ: at most the k-mers that only one of the texts has."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _may_link(shared: int) -> Column:
    """Whether the texts of size na and nb, bands ba and bb, odd sketches oa and ob can be similar.

    At similarity 0.8 a ninth of the k-mers of both is in one text only, at most. Those of more than BLUNT k-mers
    must share so many bands too.
    """
    na, nb = F.col("na"), F.col("nb")
    sizes = F.least(na, nb) >= SIMILARITY * F.greatest(na, nb)
    cells = _odd_cells(F.col("oa"), F.col("ob")) <= (na + nb) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6
    return sizes & cells & ((na + nb <= BLUNT) | (_shared_bands(F.col("ba"), F.col("bb")) >= shared))


def _side(nodes: DataFrame, name: str) -> DataFrame:
    """The nodes as one side of pairs: their name, size, bands and odd sketch."""
    named = {"node": name, "size": f"n{name}", "bands": f"b{name}", "odd": f"o{name}"}
    return nodes.select(*[F.col(c).alias(named.get(c, c)) for c in nodes.columns])


def near_pairs(pairs: DataFrame, nodes: DataFrame, shared: int = SHARED) -> DataFrame:
    """The pairs (a, b) that can be similar, and the bands they share: no text is read for the others."""
    nodes = nodes.select("node", "size", "bands", "odd")
    both = pairs.join(_side(nodes, "a"), "a").join(_side(nodes, "b"), "b").where(_may_link(shared))
    return both.select("a", "b", _shared_bands(F.col("ba"), F.col("bb")).alias("n"))


def _fresh(df: DataFrame) -> DataFrame:
    """The rows cut, without the size that Spark estimates: joins multiply it, and over many rounds of joins of
    cut frames, which hand it on, the number itself outgrows the driver. Few rows are read by few tasks, however
    many partitions shuffles have: the rounds end on small frames, and each task of a shuffle leaves files."""
    held, session = cut(df), df.sparkSession
    tasks = 1 + held.count() // TASK_ROWS
    made = DataFrame(session._jsparkSession.createDataFrame(held._jdf.toJavaRDD(), held._jdf.schema()), session)
    return made.coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """node, root: a node that stands for all that a chain of links (a, b) connects, for every linked node.

    Each round sends every node to its least neighbour and on to that one's, then joins the links'
    ends into their roots and drops links whose ends have become one: what is left shrinks each time.
    """
    edges = _fresh(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    roots = None
    while roots is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        near = _fresh(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select("node", F.least("node", "n").alias("up")))
        step = near.join(near.select(F.col("node").alias("up"), F.col("up").alias("over")), "up")
        step = _fresh(step.select("node", F.least("up", "over").alias("root")))
        if roots is None:
            roots = step
        else:
            onwards = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = _fresh(roots.join(onwards, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        ends = ends.join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b").where("ra <> rb")
        edges = _fresh(ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return roots


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots after more links: only the classes that these connect are looked at again."""
    across = _fresh(_apart(links, roots).select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
    onwards = components(across).select(F.col("node").alias("root"), F.col("root").alias("next"))
    alone = onwards.join(roots.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("next").alias("root"))
    moved = roots.join(onwards, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return _fresh(moved.union(alone))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes are not yet in one class."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    tied = pairs.join(a, "a", "left").join(b, "b", "left")
    return tied.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))


def _shared(keys: DataFrame) -> DataFrame:
    """key, node and score of the nodes of every key that has others.

    The score is the size of all buckets of a node: a text that many others are copies of meets more of
    them than they meet of each other.
    """
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = cut(keys.join(sizes, "key"))
    return cut(sized.join(sized.groupBy("node").agg(F.sum("n").alias("score")), "node").select("key", "node", "score"))


def _finer(grams: DataFrame, nodes: DataFrame, turn: int) -> DataFrame:
    """key, node and score in the buckets of a later round."""
    sampled = SAMPLED + DEEPER * turn
    bands = seeds(math.ceil(MEET / SIMILARITY**sampled), turn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(a, 500) for a in range(0, batch.num_rows, 500)):
                made = [samples(np.frombuffer(k, dtype=np.uint64), bands, sampled) for k in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _int_lists(made)], ["node", "bands"])

    found = grams.join(nodes, "node").select("node", "kmers").mapInArrow(run, "node binary, bands array<long>")
    return _shared(found.select(F.posexplode("bands").alias("band", "v"), "node").select(F.xxhash64("band", "v").alias("key"), "node"))


def _named(nodes: DataFrame, some: DataFrame) -> DataFrame:
    """own and node of the nodes in ``some``."""
    return cut(nodes.select("own", "node").join(some.select("node").distinct(), "node"))


def _later_rounds(roots: DataFrame, members: DataFrame, met: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The roots after the buckets of several classes were looked at again.

    ``members`` (key, node, score) are the nodes of all buckets, ``met`` the pairs (a, b) that were compared. Where
    up to SMALL nodes of a bucket are outside its largest class, they are held against all nodes of other classes
    there, so the work is at most SMALL times the bucket, however large that class is. Any other bucket is held
    against its leader, and its nodes go on to the buckets of the next round.
    """
    grams, tried, turn = None, [met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))], 0
    while True:
        rooted = _fresh(members.join(roots, "node", "left").select("key", "node", "score", F.coalesce("root", "node").alias("root")))
        sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key")
        several = sizes.agg(F.sum("c").alias("n"), F.max("c").alias("most"), F.max_by("root", F.struct("c", "root")).alias("main")).where("n > most")
        members = _fresh(rooted.join(several.select("key", "main", (F.col("n") - F.col("most")).alias("minor")), "key"))
        if members.isEmpty():
            return roots
        small, large = members.where(F.col("minor") <= SMALL), members.where(F.col("minor") > SMALL)
        # What rules a pair out without its texts is part of the join, so that only the rest leaves it.
        small = small.select("key", "node", "root", "main").join(nodes.select("node", "size", "bands", "odd"), "node")
        minor = _side(small.where("root <> main"), "a")
        others = _side(small.select(F.col("key").alias("kb"), F.col("root").alias("rb"), "node", "size", "bands", "odd"), "b")
        once = (F.col("rb") == F.col("main")) | (F.col("a") < F.col("b"))
        alike = (F.col("key") == F.col("kb")) & (F.col("root") != F.col("rb")) & once & _may_link(SHARED_LATER)
        pairs = minor.join(others, alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        led = large.groupBy("key").agg(F.max_by(F.struct("node", "root"), F.struct("score", "node")).alias("a"))
        led = large.join(led, "key").where(F.col("a.root") != F.col("root"))
        led = led.select(F.least(F.col("a.node"), F.col("node")).alias("a"), F.greatest(F.col("a.node"), F.col("node")).alias("b"))
        pairs = pairs.union(near_pairs(led.distinct(), nodes, SHARED_LATER).select("a", "b")).distinct()
        for earlier in tried:
            pairs = pairs.join(earlier, ["a", "b"], "left_anti")
        pairs = _fresh(pairs)
        if grams is None:  # of all texts that this round and the later ones look at
            grams = cut(kmers_of(docs, _named(nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(large.select("node")))))
        if not pairs.isEmpty():
            roots = _merged(roots, _fresh(verified(pairs, grams)))
            tried.append(pairs)
        if large.isEmpty():
            return roots
        turn += 1
        members = _finer(grams, large.select("node").distinct(), turn)


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size and kept of every row of ``docs`` (doc_id, text, any others).

    Texts that differ in case, punctuation and white space only are copies and stand for one node. In each
    bucket every node is held against the leader; first against the leader that it shares most bands with, then
    against the others that are still in another class, and at last in the later rounds. class_id is the
    least doc_id of the class, which stays; null where all are null. Repeated rows share their fate. Null,
    empty and blank texts are copies of each other; texts under five words are one k-mer; texts are read whole,
    however long. Other columns do not matter, whatever their names. An empty table gives no rows.
    """
    return _classed(docs).drop("own")


def _classed(docs: DataFrame) -> DataFrame:
    """The rows of near_classes with the digest of the row."""
    rows = cut(sketched(docs))
    nodes = rows.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("own").alias("own"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd"), F.any_value("size").alias("size"), F.count("*").alias("n")
    )
    nodes = cut(nodes)
    keys = nodes.select("node", F.posexplode("bands").alias("band", "v")).select(F.xxhash64("band", "v").alias("key"), "node")
    shared = _shared(keys)
    leaders = shared.groupBy("key").agg(F.max_by("node", F.struct("score", "node")).alias("a"))
    met = shared.join(leaders, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    close = cut(near_pairs(met, nodes))
    grams = cut(kmers_of(docs, _named(nodes, close.select(F.col("a").alias("node")).union(close.select("b")))))
    first = close.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")
    roots = components(verified(first, grams))
    apart = cut(_apart(close.select("a", "b").join(first, ["a", "b"], "left_anti"), roots))
    if not apart.isEmpty():
        roots = _merged(roots, cut(verified(apart.select("a", "b"), grams)))
    roots = _later_rounds(roots, shared, close, nodes, docs)
    class_of = cut(nodes.join(roots, "node", "left").select("node", "rep", "n", F.coalesce("root", "node").alias("root")))
    classes = cut(class_of.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size")))
    by_node = cut(class_of.join(classes, "root").select("node", "class_id", "class_size"))
    return (
        rows.select("doc_id", "own", "node")
        .join(by_node, "node")
        .select("doc_id", "own", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that near_classes keeps, with all their columns; nulls, ties and repeats as there."""
    gone = _classed(docs).where(~F.col("kept")).select(F.col("own").alias("_own")).distinct()
    return docs.join(gone, row_key(docs) == F.col("_own"), "left_anti")
