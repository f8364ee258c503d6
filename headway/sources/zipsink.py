"""Text members of a ZIP, or plain files, written by executors.

Tasks deflate their own lines into blocks that end at a byte, which may be put one
behind the other.  The driver sees each task's length and checksum; one task writes the
file, block by block, under another name and then renames it, so that it may be lost and
run again.  Paths may have any scheme that pyarrow's file systems open.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from . import feedsource
from .feedsource import joined_crc

#: Bytes of a block, about.
BLOCK = 4 << 20
#: An empty last block, behind which a deflated stream ends.
END = b"\x03\x00"
#: What stands for a number that needs 64 bits, and from where numbers do.
LONG = LIMIT = 0xFFFFFFFF


def deflated(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    return deflate.compress(data) + deflate.flush(zlib.Z_FULL_FLUSH)


def blocks(lines: DataFrame, pack: bool) -> DataFrame:
    """part, block, data, and of each part's blocks the length and checksum of what they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            data = b"".join(held)
            out = deflated(data) if pack else data
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "data": out, "size": len(data), "crc": zlib.crc32(data)}], schema=schema)

        for batch in batches:
            some, at = batch.column("value"), 0
            ends = np.cumsum(pc.binary_length(some).to_numpy().astype("int64") + 1)
            while at < len(some):
                before = ends[at - 1] if at else 0
                # up to the line that fills the block
                stop = min(int(np.searchsorted(ends, before + BLOCK - size)) + 1, len(some))
                held.append(pc.binary_join(pa.ListArray.from_arrays([0, stop - at], some[at:stop]), "\n")[0].as_buffer().to_pybytes() + b"\n")
                size, at = size + int(ends[stop - 1] - before), stop
                if size >= BLOCK:
                    yield row()
                    held, size, block = [], 0, block + 1
        if held:
            yield row()

    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("data", pa.binary()), ("size", pa.int64()), ("crc", pa.int64())])
    return lines.select("value").mapInArrow(run, "part long, block long, data binary, size long, crc long")


def _short(x: int) -> int:
    return x if x < LIMIT else LONG


def local_header(name: bytes, crc: int, size: int, packed: int) -> bytes:
    # a local header has both lengths in its extra field or none
    wide = struct.pack("<HHQQ", 1, 16, size, packed) if max(size, packed) >= LIMIT else b""
    lengths = (LONG, LONG) if wide else (packed, size)
    return struct.pack("<4s5H3I2H", b"PK\x03\x04", 45 if wide else 20, 0x800, 8, 0, 33, crc, *lengths, len(name), len(wide)) + name + wide


def directory(entries: list[tuple[bytes, int, int, int, int]], indexes: list[bytes], start: int) -> bytes:
    """Indexes of blocks, which begin at ``start``, the central directory of (name, crc, size, packed, offset), which tells where they are, and its end."""
    out, at = b"", start
    start += sum(map(len, indexes))
    for (name, crc, *numbers), own in zip(entries, indexes, strict=True):
        size, packed, offset = numbers
        long = [x for x in numbers if x >= LIMIT]
        wide = struct.pack(f"<HH{len(long)}Q", 1, 8 * len(long), *long) if long else b""
        version = 45 if wide else 20
        wide += struct.pack("<HHQQ", feedsource.INDEX_FIELD, 16, at, len(own))
        at += len(own)
        out += struct.pack("<4s6H3I5H2I", b"PK\x01\x02", version, version, 0x800, 8, 0, 33, crc, _short(packed), _short(size), len(name), len(wide), 0, 0, 0, 0, _short(offset)) + name + wide
    n, size = len(entries), len(out)
    if start >= LIMIT:
        out += struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, start) + struct.pack("<4sIQI", b"PK\x06\x07", 0, start + size, 1)
    return b"".join(indexes) + out + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, n, n, size, _short(start), 0)


def _write(path: str, heads: dict[int, bytes], rows: DataFrame, tail: bytes) -> None:
    """One task writes heads, each before its member's blocks, and the tail."""
    draft = f"{path}._draft"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = feedsource.opened(draft)
        left = sorted(heads)
        with system.open_output_stream(place) as f:
            for batch in batches:
                for member, data in zip(batch.column("member").to_pylist(), batch.column("data").to_pylist(), strict=True):
                    while left and left[0] <= member:
                        f.write(heads[left.pop(0)])
                    f.write(data)
            for member in left:
                f.write(heads[member])
            f.write(tail)
        yield pa.RecordBatch.from_pydict({"done": [True]})

    rows.repartition(1).sortWithinPartitions("member", "part", "block").select("member", "data").mapInArrow(run, "done boolean").collect()
    system, place = feedsource.opened(path)
    system.move(feedsource.opened(draft)[1], place)


def write(path: str, members: dict[str, tuple[str, DataFrame]]) -> None:
    """A ZIP of members: their first line and the lines behind it (value), in order of partitions.

    An index of each member's blocks stands before the directory, where other programs
    see nothing; by it ``feedsource`` reads a member in many tasks.
    """
    if not members:
        raise ValueError("a ZIP has a member")
    rows = None
    for k, (_, lines) in enumerate(members.values()):
        own = blocks(lines, True).withColumn("member", F.lit(k).cast("long"))
        rows = own if rows is None else rows.union(own)
    # written once, as a block deflated anew might differ
    rows = graph.written(rows)
    facts: dict[int, list] = {k: [] for k in range(len(members))}
    for r in rows.select("member", "part", "block", "size", "crc", F.octet_length("data").alias("packed")).orderBy("member", "part", "block").toLocalIterator():
        facts[r["member"]].append((r["size"], r["packed"], r["crc"]))
    heads, entries, indexes, offset, before = {}, [], [], 0, b""
    for k, (name, (first, _)) in enumerate(members.items()):
        data = first.encode()
        packed_first = deflated(data)
        size, packed, crc = len(data), len(packed_first), zlib.crc32(data)
        indexes.append(feedsource.index([(size, packed, crc), *facts[k]]))
        for more, packed_more, crc_more in facts[k]:
            size, packed, crc = size + more, packed + packed_more, joined_crc(crc, crc_more, more)
        packed += len(END)
        head = local_header(name.encode(), crc, size, packed)
        heads[k] = before + head + packed_first
        entries.append((name.encode(), crc, size, packed, offset))
        offset += len(head) + packed
        before = END
    _write(path, heads, rows, END + directory(entries, indexes, offset))


def write_plain(path: str, first: str, lines: DataFrame) -> None:
    """A file of the first line and the lines behind it, in order of partitions."""
    rows = graph.written(blocks(lines, False).withColumn("member", F.lit(0).cast("long")))
    _write(path, {0: first.encode()}, rows, b"")
