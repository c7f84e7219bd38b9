"""WARC archives of pages, with a two-level capture index.

Pages are written as gzip members of WARC files, equal payloads as revisits of the first. Captures are
sorted by their URL with the host reversed and packed into compressed blocks; a sparse directory at the end of
each index file keeps the first and last capture of its blocks. A lookup finds the file among at most MAX_FILES
bounds, the block by binary search in that file's directory, and reads that byte range and then the record's.

Files go through pyarrow's file systems, under the shared folder. A task that is run again writes a file of a
new name; only names that a finished task has reported are ever read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

DATE = "2024-01-01T00:00:00Z"
#: Payloads under so many bytes are never stored as revisits.
LEAST_BYTES = 100
#: Captures to a block, captures to an index file (about), index files at most.
BLOCK, FILE_ROWS, MAX_FILES = 512, 50_000, 10_000
CAPTURES = "surt string, page_id long, file string, start long, length long"
BOUNDS = "idx string, first string, first_id long, last string, last_id long"
RECORDS = "page_id long, record_type string, refers_to long, payload_digest string, stated_digest string, payload_bytes long"
_NONE = -(2**63)  # stands for a null page_id in sorted keys


def _open(base: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(base)


def surt(url: Column) -> Column:
    """``com,example,www)/path?query``: the host reversed and lowered, without scheme, user, port and fragment."""
    url = F.coalesce(url, F.lit(""))
    head = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?"
    host = F.lower(F.regexp_extract(url, head + r"([^/?#:]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(url, head + r"[^/?#]*", ""), "#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def with_first(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and ``first``: the smallest page_id of the same payload, where it has others."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha2(html, 256).alias("digest"),
    )
    firsts = cut(
        read.where(F.octet_length("html") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return read.join(firsts, "digest", "left")


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """One record as a gzip member. Characters that a header line cannot hold are percent-encoded in the URL."""
    revisit = first is not None and page_id != first
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{first}>")
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    data = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes) -> tuple[int | None, str, int | None, str, bytes]:
    """page_id, type, refers_to, stated digest and payload of one gzip member."""
    text = zlib.decompress(data, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    ids = [fields[k][10:-1] if k in fields else "" for k in ("WARC-Record-ID", "WARC-Refers-To")]
    page_id, refers_to = (int(x) if x else None for x in ids)
    return page_id, fields["WARC-Type"], refers_to, fields["WARC-Payload-Digest"][7:], block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, base: str) -> DataFrame:
    """Writes one WARC file for each task under ``base``; the captures (surt, page_id, file, start, length)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(base)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            found: dict[str, list] = {k: [] for k in ("surt", "page_id", "file", "start", "length")}
            for row in range(batch.num_rows):
                page_id, url, html, digest, first, key = (batch.column(i)[row].as_py() for i in range(6))
                data = _record(page_id, url, html.encode(), digest, first)
                out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                out.write(data)
                for k, v in zip(found, (key, page_id, name, at, len(data)), strict=True):
                    found[k].append(v)
                at += len(data)
            types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found.values(), types, strict=True)], list(found))
        if out:
            out.close()

    rows = with_first(pages).select("page_id", "url", "html", "digest", "first", surt(F.col("url")).alias("surt"))
    return cut(rows.mapInArrow(write, CAPTURES))


def _line(surt: str, page_id: int, file: str, start: int, length: int) -> bytes:
    return f"{page_id}\t{file}\t{start}\t{length}\t".encode() + surt.replace("\\", "\\\\").replace("\n", "\\n").encode()


def _read_line(line: bytes) -> tuple[str, int, str, int, int]:
    page_id, file, start, length, key = line.split(b"\t", 4)
    parts = key.decode().split("\\\\")
    return "\\".join(p.replace("\\n", "\n") for p in parts), int(page_id), file.decode(), int(start), int(length)


def write_index(captures: DataFrame, base: str) -> DataFrame:
    """Writes the sorted captures as index files under ``base``; the first and last capture of every file.

    A file is its compressed blocks, then their directory, then 8 bytes that say where that begins.
    """
    files = max(1, min(MAX_FILES, -(-captures.count() // FILE_ROWS)))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(base)
        fs.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.idx"
        out, at, held, blocks = None, 0, [], []

        def flush() -> None:
            nonlocal out, at
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress(b"\n".join(_line(*x) for x in held), 6)
            out.write(data)
            blocks.append((held[0][:2], held[-1][:2], at, len(data)))
            at += len(data)
            held.clear()

        for batch in batches:
            for x in batch.itertuples(index=False, name=None):
                held.append(x)
                if len(held) == BLOCK:
                    flush()
        if held:
            flush()
        if out:
            out.write(zlib.compress(json.dumps(blocks).encode(), 6) + at.to_bytes(8, "little"))
            out.close()
            row = (name, *blocks[0][0], *blocks[-1][1])
            yield pd.DataFrame([row], columns=["idx", "first", "first_id", "last", "last_id"])

    keyed = captures.withColumn("page_id", F.coalesce("page_id", F.lit(_NONE)))
    ordered = keyed.repartitionByRange(files, "surt", "page_id", "start").sortWithinPartitions("surt", "page_id", "start")
    return cut(ordered.mapInPandas(write, BOUNDS))


class IndexFile:
    """An index file under lookups in ascending order: the directory, and the one block read last."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        file.seek(size - 8)
        at = int.from_bytes(file.read(8), "little")
        file.seek(at)
        found = json.loads(zlib.decompress(file.read(size - 8 - at)))
        self.blocks = [(tuple(first), start, length) for first, _, start, length in found]
        self.lasts = [tuple(last) for _, last, _, _ in found]
        self.loaded, self.lines = None, {}

    def find(self, key: tuple[str, int]) -> list[tuple]:
        """The captures of (surt, page_id): binary search in the directory, then the blocks that may hold it."""
        out = []
        i = bisect.bisect_left(self.lasts, key)
        while i < len(self.blocks) and self.blocks[i][0] <= key:
            if self.loaded != i:
                self.file.seek(self.blocks[i][1])
                self.lines, self.loaded = {}, i
                for line in zlib.decompress(self.file.read(self.blocks[i][2])).split(b"\n"):
                    x = _read_line(line)
                    self.lines.setdefault(x[:2], []).append(x)
            out += self.lines.get(key, [])
            i += 1
        return out


def lookup(index: DataFrame, base: str, wanted: DataFrame) -> DataFrame:
    """The captures (as CAPTURES) whose (surt, page_id) is in ``wanted``.

    Only the bounds of the index files (MAX_FILES rows at most) go to the driver and every task. Wanted
    keys are sent to the file that holds them and sorted, so a task opens each file once, reads each block
    at most once, and holds one block at a time.
    """
    bounds = sorted(((r.first, r.first_id), (r.last, r.last_id), r.idx) for r in index.collect())
    keyed = wanted.select("surt", F.coalesce(F.col("page_id"), F.lit(_NONE)).alias("page_id")).distinct()

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lasts = [b[1] for b in bounds]
        for batch in batches:
            out = []
            for key in zip(batch["surt"], batch["page_id"].tolist(), strict=True):
                i = bisect.bisect_left(lasts, key)
                while i < len(bounds) and bounds[i][0] <= key:  # equal keys may run over several files
                    out.append((*key, bounds[i][2]))
                    i += 1
            yield pd.DataFrame(out, columns=["surt", "page_id", "idx"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(base)
        name, file = None, None
        for batch in batches:
            out = []
            for surt, page_id, idx in zip(batch["surt"], batch["page_id"].tolist(), batch["idx"], strict=True):
                if idx != name:
                    name, file = idx, IndexFile(fs.open_input_file(f"{root}/{idx}"))
                out += file.find((surt, page_id))
            made = pd.DataFrame(out, columns=[c.split()[0] for c in CAPTURES.split(", ")])
            ids = made["page_id"].astype("Int64")
            yield made.assign(page_id=ids.where(ids != _NONE))

    routed = keyed.mapInPandas(route, "surt string, page_id long, idx string")
    return routed.repartition("idx").sortWithinPartitions("idx", "surt", "page_id").mapInPandas(read, CAPTURES)


def read_archives(captures: DataFrame, base: str) -> DataFrame:
    """The records of captures, read by byte range in the order of the files; payloads are hashed as read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(base)
        name, file = None, None
        for batch in batches:
            out = []
            for other, start, length in zip(batch["file"], batch["start"].tolist(), batch["length"].tolist(), strict=True):
                if other != name:
                    if file:
                        file.close()
                    name, file = other, fs.open_input_file(f"{root}/{other}")
                file.seek(start)
                page_id, kind, refers_to, stated, payload = parse_record(file.read(length))
                out.append((page_id, kind, refers_to, hashlib.sha256(payload).hexdigest(), stated, len(payload)))
            made = pd.DataFrame(out, columns=[c.split()[0] for c in RECORDS.split(", ")])
            yield made.astype({"page_id": "Int64", "refers_to": "Int64"})
        if file:
            file.close()

    return captures.repartition("file").sortWithinPartitions("file", "start").mapInPandas(read, RECORDS)


def archive_round_trip(pages: DataFrame, base: str) -> DataFrame:
    """Writes all ``pages`` (page_id, url, html, any others) and their index, looks every page up and reads it back.

    page_id, payload_bytes, payload_digest, record_type and refers_to; for a revisit, bytes and digest are
    those of the response it refers to, as read. Null html is an empty payload, a null url has the key
    ``)``; a null page_id loses against any other, and records without one are all responses where no other
    has their payload. Rows that repeat a page_id are records of their own; those of a payload's smallest
    page_id are all responses. An empty table gives no rows.
    """
    captures = write_archives(pages, f"{base}/warc")
    index = write_index(captures, f"{base}/index")
    found = lookup(index, f"{base}/index", captures)
    records = cut(read_archives(found, f"{base}/warc"))
    responses = cut(
        records.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    told = (F.col("refers_to") == F.col("_id")) & (F.col("stated_digest") == F.col("_digest"))
    own = records.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    again = records.where("record_type = 'revisit'").join(responses, told, "left").select(
        "page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return own.unionByName(again)
