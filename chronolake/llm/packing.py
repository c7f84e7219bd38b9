"""Packing documents into token sequences: best fit, then a swap-based local search.

Documents become token ids and are cut only where longer than a sequence. Pieces that fill a sequence are
done. The others are dealt into groups of bounded size; in each group the pieces go best fit, longest first,
and a local search then moves a document, or exchanges one for one or two for one, between underfull
sequences wherever that increases the sum of squared fills, until sequences run empty. Sequences that stay
underfull are pooled over the groups and packed again, until one group holds them all.
"""

from __future__ import annotations

import array
import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of

LENGTH = 2048
END = b"\0\0\0\0"
#: Pieces to a group.
GROUP_ROWS = 20_000
#: Sequences filled less than this are pooled for another round.
FULL = 0.99
#: Words (and parts of words) whose ids a Python worker remembers: about 250 MB at the most.
REMEMBERED = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Token ids of texts, by the words between ASCII white space: no token spans it.

    Words repeat, so their ids are remembered. A new word of plain Latin characters is cut into the
    tokenizer's parts, and the new parts of a batch are encoded in one call; any other word is encoded by
    itself. The ids are those of the tokenizer over the whole text.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.plain = regex.compile("[!-~¡-¬®-įı-ɏ]*").fullmatch
        self.parts_of = regex.compile(_PARTS).findall
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn_parts(self, new: list[str]) -> None:
        ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(new):
            self.parts.update((p, self._ids(p)) for p in new)
            return
        data, start = ids.tobytes(), 0
        for part, stop in zip(new, (stops * 4).tolist(), strict=True):
            self.parts[part] = data[start:stop]
            start = stop

    def _parts(self, text: str) -> list[str] | None:
        """The tokenizer's parts of a word, or None if it isn't plain."""
        if text.isascii():
            if text.isalpha():
                return [text.lower()]
            if not text.isprintable() or "<|" in text or "</w>" in text:
                return None
        elif not self.plain(text):
            return None
        return self.parts_of(text.lower())

    def _learn(self, new: list[bytes]) -> None:
        if len(self.parts) > REMEMBERED:
            self.parts = {}
        held, words, fresh, cut_up = self.parts, self.words, {}, []
        for word in new:
            text = word.decode()
            parts = self._parts(text)
            if parts is None:
                words[word] = self._ids(text)
            else:
                cut_up.append((word, parts))
                for p in parts:
                    if p not in held:
                        fresh[p] = None
        if fresh:
            self._learn_parts(list(fresh))
        for word, parts in cut_up:
            words[word] = held[parts[0]] if len(parts) == 1 else b"".join([held[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [t.encode().split() for t in texts]
        held = self.words
        new = list({w for s in split for w in s if w not in held})
        if len(held) + len(new) > REMEMBERED:
            self.words = held = {}
            new = list({w for s in split for w in s})
        if new:
            self._learn(new)
        return [b"".join([held[w] for w in s]) for s in split]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_of(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every document, its closing id 0 included."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or default_tokenizer()).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                out: list[tuple] = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += END
                    for piece, start in enumerate(range(0, len(ids), 4 * length)):
                        own = ids[start : start + 4 * length]
                        out.append((doc_id, piece, start // 4, len(own) // 4, zlib.crc32(own)))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(make, PIECES)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of positions in ``lengths``: longest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    some = 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        fits = some >> lengths[i]
        if fits:
            free = (fits & -fits).bit_length() - 1 + lengths[i]
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
        else:
            free, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        free -= lengths[i]
        by_free[free].append(b)
        some |= 1 << free
    return bins


def least_bins(lengths: list[int], size: int) -> int:
    """A number of bins that no packing goes below.

    For every limit up to half a bin: pieces over half a bin need one each, and of the pieces from the limit to half a
    bin, what the rest of those bins cannot hold needs more; a bin whose large piece leaves less than the limit holds none.
    """
    number = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=size + 1)
    tokens = number * np.arange(size + 1)
    half = size // 2
    most = -(-int(tokens.sum()) // size)
    large = int(number[half + 1 :].sum())
    for limit in range(half + 1):
        beside = slice(half + 1, size - limit + 1)
        rest = int(number[beside].sum()) * size - int(tokens[beside].sum())
        most = max(most, large + max(0, -(-(int(tokens[limit : half + 1].sum()) - rest) // size)))
    return most


def _most(outs: int, backs: int, room: int, gain: int) -> int:
    """The largest n - m over ``gain`` and up to ``room``, n of ``outs``, m of ``backs`` (sets as bits), or ``gain``."""
    if not outs or not backs:
        return gain
    if room - gain <= 2 * outs.bit_count():
        for d in range(room, gain, -1):
            if (outs >> d) & backs:
                return d
        return gain
    while outs:
        n = outs.bit_length() - 1
        outs ^= 1 << n
        if n <= gain:
            break
        least = max(0, n - room)
        fits = backs >> least
        if fits:
            gain = max(gain, n - least - (fits & -fits).bit_length() + 1)
    return gain


class SwapSearch:
    """Local search between underfull bins: every step moves length into a bin as full or fuller, so squared fills grow.

    A document moves whole, or goes for a shorter one, or for two that are shorter together, or two go for a
    shorter one. The least filled bin that may have a step comes first: it gives by the step that fills another
    bin most, or else takes so. Steps are kept. A bin without a step is looked at again only once it has
    changed itself: a changed bin is held against all others, both ways. The search ends when no step is
    left between any two bins, or when there are no more bins than ``least_bins``.

    The bins of one room are looked at together: the lengths they hold and the sums of two of them are sets, kept
    as the bits of a number, so whether any of them has a step is a few shifts, however many they are.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], size: int):
        self.lengths, self.size = lengths, size
        self.bins = [list(b) for b in bins]
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        self.steps = 0
        self.sets: dict[int, tuple[int, int]] = {}
        self.rooms: dict[int, dict[int, None]] = {}
        self.held: dict[int, tuple[int, int]] = {}
        for b in range(len(bins)):
            self._open(b)

    def _open(self, b: int) -> None:
        room = self.size - self.fill[b]
        if not room or not self.bins[b]:
            return
        ones = twos = 0
        for i in self.bins[b]:
            twos |= ones << self.lengths[i]
            ones |= 1 << self.lengths[i]
        self.sets[b] = ones, twos
        self.rooms.setdefault(room, {})[b] = None
        if room in self.held:
            self.held[room] = self.held[room][0] | ones, self.held[room][1] | twos

    def _shut(self, b: int) -> None:
        del self.sets[b]
        room = self.size - self.fill[b]
        del self.rooms[room][b]
        self.held.pop(room, None)
        if not self.rooms[room]:
            del self.rooms[room]

    def _of_room(self, room: int, without: int) -> tuple[int, int]:
        """Lengths and sums of two in the bins of a room."""
        if room in self.held and without not in self.rooms[room]:
            return self.held[room]
        ones = twos = 0
        for b in self.rooms[room]:
            if b != without:
                ones |= self.sets[b][0]
                twos |= self.sets[b][1]
        if without not in self.rooms[room]:
            self.held[room] = ones, twos
        return ones, twos

    @staticmethod
    def _gain(giver: tuple[int, int], taker: tuple[int, int], room: int, gain: int) -> int:
        gain = _most(giver[0], 1 | taker[0] | taker[1], room, gain)
        return _most(giver[1], taker[0], room, gain)

    def _step(self, b: int) -> tuple[int, int, int] | None:
        """giver, taker and the length that goes over: the best step that ``b`` gives, or else takes."""
        own, room = self.sets[b], self.size - self.fill[b]
        best, at = 0, None
        rooms = sorted(r for r in self.rooms if r != room or len(self.rooms[r]) > 1)
        for r in reversed(rooms):
            if r <= best:
                break
            if r <= room and (gain := self._gain(own, self._of_room(r, b), r, best)) > best:
                best, at = gain, r
        if at is not None:
            taker = next(t for t in self.rooms[at] if t != b and self._gain(own, self.sets[t], at, best - 1) == best)
            return b, taker, best
        for r in rooms:
            if best == room:
                break
            if r >= room and (gain := self._gain(self._of_room(r, b), own, room, best)) > best:
                best, at = gain, r
        if at is None:
            return None
        giver = next(g for g in self.rooms[at] if g != b and self._gain(self.sets[g], own, room, best - 1) == best)
        return giver, b, best

    def _members(self, b: int, n: int, two: bool) -> list[int]:
        """One document of the bin, or two, of this length together."""
        if not n:
            return []
        if not two:
            return [next(i for i in self.bins[b] if self.lengths[i] == n)]
        seen: dict[int, int] = {}
        for i in self.bins[b]:
            if n - self.lengths[i] in seen:
                return [seen[n - self.lengths[i]], i]
            seen[self.lengths[i]] = i
        raise AssertionError("no two documents of this length")

    def _go(self, giver: int, taker: int, moved: int) -> None:
        (ones, twos), (their_ones, their_twos) = self.sets[giver], self.sets[taker]
        backs = (ones >> moved) & (1 | their_ones | their_twos)
        two = not backs
        backs = backs or (twos >> moved) & their_ones
        m = (backs & -backs).bit_length() - 1
        out = self._members(giver, m + moved, two)
        back = self._members(taker, m, not two and not their_ones >> m & 1)
        self._shut(giver)
        self._shut(taker)
        self.bins[giver] = [i for i in self.bins[giver] if i not in out] + back
        self.bins[taker] = [i for i in self.bins[taker] if i not in back] + out
        self.fill[giver] -= moved
        self.fill[taker] += moved
        self._open(giver)
        self._open(taker)
        self.steps += 1

    def run(self) -> list[list[int]]:
        least, used = least_bins(self.lengths, self.size), sum(map(bool, self.bins))
        waiting = dict.fromkeys(self.sets)
        queue = [(self.fill[b], b) for b in waiting]
        heapq.heapify(queue)
        while queue and used > least:
            fill, b = heapq.heappop(queue)
            if b not in waiting or b not in self.sets or fill != self.fill[b]:
                continue
            step = self._step(b)
            if step is None:
                del waiting[b]
                continue
            self._go(*step)
            used -= not self.bins[step[0]]
            for changed in step[:2]:
                waiting[changed] = None
                heapq.heappush(queue, (self.fill[changed], changed))
        return [b for b in self.bins if b]


def swap_search(lengths: list[int], bins: list[list[int]], size: int) -> list[list[int]]:
    """The bins after the search."""
    return SwapSearch(lengths, bins, size).run()


def pack_group(rows: pd.DataFrame, size: int) -> pd.DataFrame:
    """Adds bin, offset and fill to the pieces of one group, and of the group the bins after best fit, the least number
    of bins there can be and the steps of the search."""
    rows = rows.sort_values(["length", "doc_id", "piece"], ascending=False, kind="stable", ignore_index=True)
    lengths = rows["length"].tolist()
    fitted = best_fit(lengths, size)
    search = SwapSearch(lengths, fitted, size)
    bins = search.run()
    bin_of, offset, fill = (np.zeros(len(lengths), dtype="int64") for _ in range(3))
    for b, members in enumerate(bins):
        at = 0
        for i in members:
            bin_of[i], offset[i] = b, at
            at += lengths[i]
        fill[members] = at
    return rows.assign(bin=bin_of, offset=offset, fill=fill, fitted=len(fitted), least=least_bins(lengths, size), steps=search.steps)


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row of ``docs``.

    A null or empty text is the closing id alone. Repeated rows and doc_ids are packed each for itself; a
    null doc_id is carried. A very long text is cut into as many pieces as it fills. Other columns do not
    matter, whatever their names. An empty table gives no rows.
    """
    return _packed(docs, tokenizer, length, group_rows)[0]


def search_report(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """For every round and group of ``pack``: pieces, sequences after best fit (fitted) and after the search
    (searched), the least number there can be and the steps of the search."""
    return _packed(docs, tokenizer, length, group_rows)[1]


def _packed(docs: DataFrame, tokenizer: str | None, length: int, group_rows: int) -> tuple[DataFrame, DataFrame]:
    pieces = cut(pieces_of(docs, tokenizer, length).withColumn("row", F.monotonically_increasing_id()))
    whole = pieces.where(F.col("length") == length).select(
        *[c.split()[0] for c in PIECES.split(", ")],
        (-1 - F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    done, left = [whole], pieces.where(F.col("length") < length)
    rows, schema = left.count(), f"{PIECES}, row long, grp long, bin long, offset long, fill long, fitted long, least long, steps long"
    opened, level, reports = None, -1, []
    while True:  # ends: every further round leaves fewer underfull sequences than the one before
        level += 1
        groups = max(1, -(-rows // group_rows))

        def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            return pack_group(part, length)[[c.split()[0] for c in schema.split(", ")]]

        dealt = left.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)))
        packed = cut(dealt.groupBy("grp").applyInPandas(fit, schema))
        reports.append(
            packed.groupBy(F.lit(level).alias("round"), "grp").agg(
                F.count("*").alias("pieces"), F.any_value("fitted").alias("fitted"), F.count_distinct("bin").alias("searched"),
                F.any_value("least").alias("least"), F.any_value("steps").alias("steps"),
            )
        )
        number = F.lit(level) * F.lit(2**48) + F.col("grp") * F.lit(2**24) + F.col("bin")
        placed = packed.select(*whole.columns[:5], number.cast("long").alias("sequence_id"), "offset")
        under = F.col("fill") < FULL * length
        found = packed.where(under).agg(F.count("*").alias("rows"), F.count_distinct("grp", "bin").alias("bins")).first()
        # Another round helps as long as it leaves fewer underfull sequences than the one before.
        if groups == 1 or not found.rows or (opened is not None and found.bins >= opened):
            done.append(placed)
            break
        shut = packed.where(~under)
        done.append(shut.select(*whole.columns[:5], number.cast("long").alias("sequence_id"), "offset"))
        left, rows, opened = packed.where(under).select(*pieces.columns), found.rows, found.bins
    return functools.reduce(DataFrame.unionByName, done), functools.reduce(DataFrame.unionByName, reports)


def fill_report(packed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Sequences, tokens and mean fill of a packing."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    return per.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), (F.avg("n") / length).alias("fill"))
