"""Exact dedup with Patricia tries that own texts.

Each task puts the whole texts of its rows into compressed radix tries, keyed by
bytes: equal texts end in one terminal node, which counts them and holds the row
that stays.  A terminal becomes one row (its text, count, best row and number); rows
only remember the number.  The terminals meet in partitions by length and content
hash, where tries insert the full texts again, and the owner's numbers lead the rows
back to it.  Hashes only choose partitions; equality is that of the tries.

A text that one task holds often, or a long one, is likely to be in many tasks: its
terminals first meet by groups of tasks, so that no task gets one copy from each.

A trie beyond its room spills by subtree: the heaviest subtree's terminals are
emitted and leave memory.  In the first step they simply count as further terminals.
Later, where each text must meet all its copies, texts that lead into a spilled
subtree follow it, and the spilled rows meet again in another round of partitions.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, save

#: Bytes that a trie holds at most: its texts, and for each terminal and each of its numbers about what they take besides.
ROOM, NODE, NUMBER = 96 << 20, 400, 40
#: Bytes of texts of a partition, about, and the most partitions; beyond those tries spill.
PART, PARTS = 48 << 20, 32768
#: Groups of tasks in which texts meet first that a task has twice or more, or that have LONG bytes.
GROUPS, LONG = 64, 32 << 10
#: The smallest long, the place of a missing id in the order of ids.
NO_ID = -(2**63)
#: A node whose subtree left memory.
SPILLED = object()
TERMINAL = "n_bytes long, hash long, text string, top long, row long, n long, numbers array<long>"
COLUMNS = [c.split()[0] for c in TERMINAL.split(", ")]


class Terminal:
    """Copies of one text: their best row as (doc_id, row), how many, and the numbers that rows remember."""

    __slots__ = ("best", "n", "numbers")

    def __init__(self):
        self.best, self.n, self.numbers = (NO_ID, NO_ID), 0, []


class Node:
    """``label``: the bytes on the edge to this node; ``kids`` by their first byte; ``end``: the terminal of a text that ends here."""

    __slots__ = ("label", "kids", "end")

    def __init__(self, label: bytes, end=None):
        self.label, self.kids, self.end = label, {}, end


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """A compressed radix trie of byte strings with a bound on what it holds."""

    def __init__(self, room: int = ROOM):
        self.root, self.room, self.held, self.ends = Node(b""), room, 0, 0

    def full(self) -> bool:
        """Whether a subtree should leave; one text alone always stays."""
        return self.held > self.room and self.ends > 1

    def find(self, key: bytes) -> Terminal | None:
        """The terminal of ``key``, made where there is none; None where its subtree left memory."""
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = Node(key[at:])
                at = len(key)
            elif key.startswith(kid.label, at):
                at += len(kid.label)
            else:
                # the edge parts where the key leaves it
                m = shared_length(kid.label, key[at : at + len(kid.label)])
                fork = Node(kid.label[:m])
                kid.label = kid.label[m:]
                fork.kids[kid.label[0]] = kid
                node.kids[key[at]] = kid = fork
                at += m
            node = kid
            if node.end is SPILLED:
                return None
        if node.end is None:
            node.end = Terminal()
            self.held += len(key) + NODE
            self.ends += 1
        return node.end

    def add(self, key: bytes, best: tuple[int, int], n: int, numbers: list[int]) -> bool:
        """Count ``n`` copies of ``key``; False where its subtree left memory."""
        end = self.find(key)
        if end is None:
            return False
        end.best = max(end.best, best)
        end.n += n
        end.numbers += numbers
        self.held += NUMBER * len(numbers)
        return True

    def below(self, node: Node, prefix: bytes):
        """(text, terminal) of each terminal of a subtree, whose node's text is ``prefix``."""
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.end is not None and node.end is not SPILLED:
                yield prefix, node.end
            stack += [(kid, prefix + kid.label) for kid in node.kids.values()]

    def weight(self, node: Node, length: int) -> int:
        """What a subtree holds, whose node's text has ``length`` bytes."""
        out, stack = 0, [(node, length)]
        while stack:
            node, length = stack.pop()
            if node.end is not None and node.end is not SPILLED:
                out += length + NODE + NUMBER * len(node.end.numbers)
            stack += [(kid, length + len(kid.label)) for kid in node.kids.values()]
        return out

    def spill(self, forget: bool) -> list[tuple[bytes, Terminal]]:
        """Take out the heaviest subtree with at most half of what is held, or one text: its (text, terminal).

        ``forget``: texts that come later start it anew; otherwise they find it spilled.
        """
        up, node, prefix = None, self.root, b""
        while node.kids:
            most, first = max((self.weight(kid, len(prefix) + len(kid.label)), first) for first, kid in node.kids.items())
            if not most:
                break
            up, node = node, node.kids[first]
            prefix += node.label
            if 2 * most <= self.held:
                break
        out = list(self.below(node, prefix))
        self.held -= sum(len(text) + NODE + NUMBER * len(end.numbers) for text, end in out)
        self.ends -= len(out)
        if forget:
            del up.kids[node.label[0]]
        else:
            node.kids, node.end = {}, SPILLED
        return out

    def all(self):
        return self.below(self.root, b"")


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def local_terminals(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """Of doc_id and text, one row a document (row: its number, number: its terminal's) and one a terminal of its task (number, top, best row, n, text).

    The rows of a task are numbered from its partition's number; the table is saved, so
    that both kinds keep their numbers.
    """

    def run(batches):
        base = TaskContext.get().partitionId() << 36
        rows = ends = 0
        trie = Trie(room)

        def terminals(found):
            texts, some = zip(*found, strict=True)
            columns = [pa.array(c, pa.int64()) for c in ([None] * len(some), [e.numbers[0] for e in some], [e.best[1] for e in some], [e.best[0] for e in some], [e.n for e in some])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()).cast(pa.string())], names)

        names = ["doc_id", "number", "row", "top", "n", "text"]
        for b in pieces(batches, "text"):
            ids, numbers = b.column("doc_id").to_pylist(), []
            for id_, text in zip(ids, _texts(b), strict=True):
                end = trie.find(text)
                if not end.n:
                    end.numbers.append(base + ends)
                    trie.held += NUMBER
                    ends += 1
                end.best = max(end.best, (NO_ID if id_ is None else id_, base + rows))
                end.n += 1
                rows += 1
                numbers.append(end.numbers[0])
            own = pa.array(range(base + rows - len(ids), base + rows), pa.int64())
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(numbers, pa.int64()), own, none, none, pa.nulls(len(ids), pa.string())], names)
            while trie.full():
                yield from _cut(trie.spill(forget=True), terminals)
        yield from _cut(trie.all(), terminals)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, number long, row long, top long, n long, text string")


def _cut(found, batch, size: int = 4 << 20):
    """Batches of (text, terminal) of about ``size`` bytes."""
    some, held = [], 0
    for text, end in found:
        some.append((text, end))
        held += len(text) + NODE
        if held > size:
            yield from batch(some)
            some, held = [], 0
    if some:
        yield from batch(some)


def merge(terminals: DataFrame, room: int = ROOM, last: bool = True) -> DataFrame:
    """Terminals (columns TERMINAL) of each partition merged by tries.

    TERMINAL and text_sha256, which only texts have whose subtree stayed in memory:
    these have all their copies in one row.  ``last``: they leave their text behind.
    """

    def batch(stayed: bool):
        def make(found):
            texts, some = zip(*found, strict=True)
            hashes = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in texts]
            columns = [pa.array(c, pa.int64()) for c in ([len(t) for t in texts], hashes, [e.best[0] for e in some], [e.best[1] for e in some], [e.n for e in some])]
            own = pa.nulls(len(some), pa.string()) if stayed and last else pa.array(texts, pa.binary()).cast(pa.string())
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in texts] if stayed else [None] * len(some), pa.string())
            yield pa.RecordBatch.from_arrays([*columns[:2], own, *columns[2:], pa.array([e.numbers for e in some], pa.list_(pa.int64())), digests], [*COLUMNS, "text_sha256"])

        return make

    def run(batches):
        trie = Trie(room)
        for b in pieces(batches, "text"):
            late = []
            columns = [b.column(c).to_pylist() for c in ("top", "row", "n", "numbers")]
            for text, top, row, n, numbers in zip(_texts(b), *columns, strict=True):
                if not trie.add(text, (top, row), n, numbers):
                    end = Terminal()
                    end.best, end.n, end.numbers = (top, row), n, numbers
                    late.append((text, end))
            while trie.full():
                late += trie.spill(forget=False)
            yield from _cut(late, batch(False))
        yield from _cut(trie.all(), batch(True))

    return terminals.mapInArrow(run, f"{TERMINAL}, text_sha256 string")


def owners(terminals: DataFrame, n_bytes: int, room: int = ROOM) -> DataFrame:
    """Per terminal of a task (number) the best row of all its text's copies: keep_id, keep_row, group_size and the text's SHA-256.

    ``n_bytes``: bytes of the terminals' texts, which give the number of partitions.
    """
    spark = terminals.sparkSession
    parts = min(PARTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PART)))
    often = (F.col("n") > 1) | (F.col("n_bytes") >= LONG)
    first = terminals.filter(often).repartition(parts, "n_bytes", "hash", F.pmod(F.shiftright("row", 36), F.lit(GROUPS)))
    # what a group spills goes on as it is, only with more copies to meet
    grouped = merge(first, room, last=False).select(*COLUMNS).withColumn("hash", F.xxhash64("text"))
    rest, out = terminals.filter(~often).unionByName(grouped), None
    while True:
        merged = save(merge(rest.repartition(parts, "n_bytes", "hash"), room), "owners")
        whole = merged.filter("text_sha256 IS NOT NULL").select(F.explode("numbers").alias("number"), F.when(F.col("top") != NO_ID, F.col("top")).alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"), "text_sha256")
        out = whole if out is None else out.unionByName(whole)
        rest = merged.filter("text_sha256 IS NULL").select(*COLUMNS)
        if rest.isEmpty():
            return out


def exact_duplicates(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are ignored): doc_id, keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the largest doc_id stays, and one of the rows that
    repeat it.  Rows without doc_id come last; where all copies lack it, one of them
    stays and keep_id is null.  A null text equals an empty one.  An empty table gives
    no rows.
    """
    local = save(local_terminals(docs, room), "terminals")
    ends = local.filter("n IS NOT NULL").select(F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("hash"), "text", "top", "row", "n", F.array("number").alias("numbers"))
    n_bytes = ends.agg(F.sum("n_bytes")).first()[0] or 0
    rows = local.filter("n IS NULL").select("doc_id", "number", "row")
    return rows.join(owners(ends, n_bytes, room), "number").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
