"""A data source of a feed's lines, read by executors straight from a ZIP or a folder.

The driver looks at the archive's directory only.  A deflated member is one stream and
one task, unless the archive has an index of its blocks, as those of ``zipsink`` do: then
it is cut between blocks.  Stored members and plain files are cut into byte ranges, which
begin behind the first line end inside them and run to the first behind their end.  Lines
carry their place: the range's number and the line's in it, so that order is the file's.  Paths may
have any scheme that pyarrow's file systems open.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of a read, and about of a batch of lines.
RANGE, CHUNK = 16 << 20, 1 << 20
BOM = "\ufeff"
LOCAL_HEADER = 30
#: An index of a member's blocks: the extra field that tells where it is and how long, what it begins with, and a block in it (its length, deflated and not, and its checksum).
INDEX_FIELD, INDEX_MARK, INDEX_BLOCK = 0x6862, b"headway blocks 1", struct.Struct("<QQI")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def member_name(name: str) -> str | None:
    """A member's lower-case base name without ``.txt``; None for other files."""
    base = name.replace("\\", "/").rsplit("/", 1)[-1].lower()
    return base[:-4] if base.endswith(".txt") else None


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo that of the checksum, the highest bit the constant."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        bit, b = bit >> 1, b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(a: int, b: int, n: int) -> int:
    """The checksum of two pieces behind each other, the second of ``n`` bytes: the first's moved by as many zeros, in as many steps as the number has bits."""
    step = 1 << 23
    while n > 0:
        a, step, n = _times(a, step) if n & 1 else a, _times(step, step), n >> 1
    return a ^ b


@dataclass
class Member(InputPartition):
    """Bytes ``start`` to ``stop`` of a file that hold a member, or range ``part`` of one from ``first``; ``crc`` of what it inflates to for a deflated one, and the blocks of one with an index."""

    path: str
    start: int
    stop: int
    first: int = 0
    part: int = 0
    crc: int | None = None
    blocks: tuple[tuple[int, int, int], ...] = ()


def index(blocks: list[tuple[int, int, int]]) -> bytes:
    """The index of a member's blocks (size, packed, crc), with its own checksum at the end."""
    data = INDEX_MARK + b"".join(INDEX_BLOCK.pack(packed, size, crc) for size, packed, crc in blocks)
    return data + struct.pack("<I", zlib.crc32(data))


def indexed(f, info: zipfile.ZipInfo) -> tuple[tuple[int, int, int], ...]:
    """The blocks (size, packed, crc) that a member's index names; none if it has no index, or one that isn't of this very member."""
    extra = info.extra
    while len(extra) >= 4:
        field, length = struct.unpack_from("<HH", extra)
        if field == INDEX_FIELD and length == 16 and len(extra) >= 20:
            at, size = struct.unpack_from("<QQ", extra, 4)
            break
        extra = extra[4 + length :]
    else:
        return ()
    end = f.seek(0, 2)
    if at + size > end or size < len(INDEX_MARK) + 4:
        return ()
    f.seek(at)
    data = f.read(size)
    body = data[len(INDEX_MARK) : -4]
    if not data.startswith(INDEX_MARK) or zlib.crc32(data[:-4]) != int.from_bytes(data[-4:], "little") or len(body) % INDEX_BLOCK.size:
        return ()
    found = tuple((size, packed, crc) for packed, size, crc in INDEX_BLOCK.iter_unpack(body))
    whole = 0
    for size, _, crc in found:
        whole = joined_crc(whole, crc, size)
    told = sum(b[0] for b in found), sum(b[1] for b in found), whole
    return found if told[0] == info.file_size and told[1] <= info.compress_size and told[2] == info.CRC else ()


def members(path: str) -> dict[str, Member]:
    """Members by name of a ZIP, a folder or a single ``.txt`` file; of equal names the last counts (in a folder, the last in order)."""
    system, place = opened(path)
    out = {}
    own = system.get_file_info(place)
    if own.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if own.type == fs.FileType.File and member_name(path) is not None:
        return {member_name(path): Member(path, 0, own.size)}
    if own.type == fs.FileType.Directory:
        for info in sorted(system.get_file_info(fs.FileSelector(place)), key=lambda i: i.path):
            name = member_name(info.path)
            if name is not None and info.type == fs.FileType.File:
                head, _, _ = path.partition("://")
                out[name] = Member(f"{head}://{info.path}" if "://" in path else info.path, 0, info.size)
        return out
    with system.open_input_file(place) as f, zipfile.ZipFile(f) as z:
        for info in z.infolist():
            name = member_name(info.filename)
            if name is None:
                continue
            if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or info.flag_bits & 1:
                raise ValueError(f"{path}: {info.filename} is neither stored nor deflated")
            # names and extra fields of the local header may differ from the directory's
            f.seek(info.header_offset)
            local = f.read(LOCAL_HEADER)
            start = info.header_offset + LOCAL_HEADER + int.from_bytes(local[26:28], "little") + int.from_bytes(local[28:30], "little")
            out[name] = Member(path, start, start + info.compress_size, start, 0, info.CRC if info.compress_type else None, indexed(f, info) if info.compress_type else ())
    return out


def ranges(member: Member, size: int = RANGE) -> list[Member]:
    """A member in parts of about ``size`` bytes of text."""
    if member.blocks:
        out, at, begin, crc, held = [], member.start, member.start, 0, 0
        for k, (more, packed, of_more) in enumerate(member.blocks):
            at, crc, held = at + packed, joined_crc(crc, of_more, more), held + more
            if held >= size or k == len(member.blocks) - 1:
                out.append(Member(member.path, begin, at, member.start, len(out), crc))
                begin, crc, held = at, 0, 0
        return out
    if member.crc is not None or member.stop - member.start <= size:
        return [Member(member.path, member.start, member.stop, member.start, 0, member.crc)]
    starts = range(member.start, member.stop, size)
    return [Member(member.path, at, member.stop, member.start, part) for part, at in enumerate(starts)]


def chunks(member: Member, size: int = RANGE) -> Iterator[bytes]:
    """The bytes of a range's lines."""
    system, place = opened(member.path)
    with system.open_input_file(place) as f:
        if member.crc is not None:
            f.seek(member.start)
            left, inflate, crc = member.stop - member.start, zlib.decompressobj(-15), 0
            while left > 0:
                data = f.read(min(CHUNK, left))
                if not data:
                    raise EOFError(f"{member.path}: a member ends early")
                left -= len(data)
                while data:
                    out = inflate.decompress(data, 4 * CHUNK)
                    crc = zlib.crc32(out, crc)
                    yield out
                    data = inflate.unconsumed_tail
            out = inflate.flush()
            if zlib.crc32(out, crc) != member.crc:
                raise ValueError(f"{member.path}: a member's checksum is wrong")
            yield out
            return
        at, end = member.start, min(member.start + size, member.stop)
        if at > member.first:
            # the line that is open here, or begins here, belongs to the range before
            at -= 1
            f.seek(at)
            while at < end:
                data = f.read(min(CHUNK, end - at))
                cut = data.find(b"\n")
                if cut >= 0:
                    at += cut + 1
                    break
                at += len(data)
            if at >= end:
                return
        f.seek(at)
        while at < end:
            data = f.read(min(CHUNK, end - at))
            at += len(data)
            yield data
        while at < member.stop and not data.endswith(b"\n"):
            data = f.read(min(CHUNK, member.stop - at))
            at += len(data)
            cut = data.find(b"\n")
            data = data if cut < 0 else data[: cut + 1]
            yield data


def lines(pieces: Iterator[bytes]) -> Iterator[list[str]]:
    """Lists of lines of about CHUNK bytes; a line ends with LF, CR or both."""

    def split(data: bytes) -> list[str]:
        return data.replace(b"\r\n", b"\n").replace(b"\r", b"\n").removesuffix(b"\n").decode(errors="replace").split("\n")

    held = bytearray()
    for data in pieces:
        held += data
        cut = held.rfind(b"\n") + 1 if len(held) >= CHUNK else 0
        if cut:
            yield split(bytes(held[:cut]))
            del held[:cut]
    if held:
        yield split(bytes(held))


class FeedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.member, self.size = options["path"], options["member"], int(options.get("range", RANGE))

    def partitions(self) -> list[Member]:
        found = members(self.path).get(self.member)
        if found is None:
            raise FileNotFoundError(f"{self.path}: no {self.member}.txt")
        return ranges(found, self.size)

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        row = partition.part << 33
        for some in lines(chunks(partition, self.size)):
            if row == 0:
                some[0] = some[0].removeprefix(BOM)
            yield pa.RecordBatch.from_arrays([pa.array(range(row, row + len(some)), pa.int64()), pa.array(some, pa.string())], ["_row", "value"])
            row += len(some)


class FeedLines(DataSource):
    """``spark.read.format("feed_lines")`` with options path, member and range: _row (grows in file order, 0 for the header) and value."""

    @classmethod
    def name(cls) -> str:
        return "feed_lines"

    def schema(self) -> str:
        return "_row long, value string"

    def reader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))


def feed_lines(spark: SparkSession, path: str, member: str, size: int = RANGE) -> DataFrame:
    spark.dataSource.register(FeedLines)
    return spark.read.format("feed_lines").options(path=path, member=member, range=str(size)).load()


def first_line(member: Member) -> str:
    return next((some[0].removeprefix(BOM) for some in lines(chunks(member))), "")
