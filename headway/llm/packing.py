"""Best-fit packing by a configuration linear program over the length histogram.

Only the histogram (at most ``capacity`` numbers) comes to the driver.  There the
configuration program  min sum x_p  with  sum a_pl x_p >= n_l  is solved by
multiplicative weights: prices start from a solution of its dual, a length's price
falls with its coverage, a knapsack dynamic program over the capacity finds, for each
badly covered length, the most valuable pattern that holds it, and the pattern's
amount grows.  The amounts are rounded down, patterns with a fraction left give one
copy, and what remains is priced again by the same weights in whole copies, at every
size.  A pattern counts if its dual value is near the largest one, whatever it wastes.
What no such pattern holds is packed best-fit decreasing as counts of lengths; the
program goes as far as that total doesn't rise, so no more sequences than best-fit
alone.  Spark then ranks the pieces of each length and gives each its place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import pieces, save

CAPACITY, END = 4096, 1
ROUNDS, COLUMNS, ETA, STEP = 24, 160, 4.0, 0.34
#: Passes over what remains, rounds of whole copies in each; the share of the largest dual value that a pattern may lack: none first, SLACK then, twice as much and SLACK more in each further pass.
PASSES, WHOLE, SLACK = 6, 12, 0.0005
#: Part of a length in its first price, so that pieces that the dual gives nothing still fill up patterns.
TRACE = 1e-4
#: Pieces of one length that are ranked together, about.
RANK_ROWS = 5_000


class Knapsack:
    """Unbounded knapsack over a capacity for given prices of lengths; of equal choices the longest."""

    def __init__(self, lengths: np.ndarray, price: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths.tolist(), capacity
        value, pick = np.zeros(capacity + 1), [-1] * (capacity + 1)
        # prices by length from the capacity down, so that each step adds two slices
        index, down = np.full(capacity + 1, -1), np.full(capacity, -np.inf)
        index[lengths], down[capacity - lengths] = np.arange(len(lengths)), price
        place = index.tolist()
        for c in range(1, capacity + 1):
            gain = value[:c] + down[capacity - c :]
            r = int(gain.argmax())
            value[c] = value[c - 1]
            if gain[r] > value[c]:
                value[c], pick[c] = gain[r], place[c - r]
        self.best, self.pick = float(value[capacity]), pick

    def with_length(self, i: int, most: list[int]) -> dict[int, int]:
        """The most valuable pattern that holds length i; where a choice is used up, the longest that is left."""
        lengths, pick = self.lengths, self.pick
        out, room = {i: 1}, self.capacity - lengths[i]
        while room > 0:
            j = pick[room]
            if j < 0 or not most[j] or out.get(j, 0) >= most[j]:
                j = bisect_right(lengths, room) - 1
                while j >= 0 and (not most[j] or out.get(j, 0) >= most[j]):
                    j -= 1
                if j < 0:
                    break
            out[j] = out.get(j, 0) + 1
            room -= lengths[j]
        return out


def first_prices(lengths: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """A dual solution and its bound: for the best t, lengths over capacity - t count whole, those under t nothing, others by length."""
    ts = np.append(0, lengths[2 * lengths <= capacity])
    upto, total = np.append(0, np.cumsum(need)), np.append(0, np.cumsum(need * lengths))
    low, high = np.searchsorted(lengths, ts), np.searchsorted(lengths, capacity - ts, side="right")
    # t may be half of the capacity, where nothing lies between
    bounds = (upto[-1] - upto[high]) + -(-(total[high] - total[np.minimum(low, high)]) // capacity)
    half = np.searchsorted(lengths, capacity // 2, side="right")
    if upto[-1] - upto[half] > bounds.max():
        return np.where(lengths > capacity // 2, capacity, 0) + TRACE * lengths, int(upto[-1] - upto[half])
    t = int(ts[bounds.argmax()])
    return np.where(lengths > capacity - t, capacity, np.where(lengths >= t, lengths, 0)) + TRACE * lengths, int(bounds.max())


def _weighed(base: np.ndarray, cover: np.ndarray) -> np.ndarray:
    return base * np.exp(-ETA * (cover - cover.mean()).clip(-1, 1))


def multiplicative_weights(lengths: np.ndarray, need: np.ndarray, base: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Amounts of patterns that together use no more of any length than is needed, and nearly as much of most."""
    amount: dict[tuple, float] = {}
    cover, most = np.zeros(len(lengths)), need.tolist()
    for _ in range(ROUNDS):
        if cover.min() >= 1:
            break
        sack = Knapsack(lengths, _weighed(base, cover), capacity)
        for i in np.argsort(cover, kind="stable")[:COLUMNS].tolist():
            pattern = sack.with_length(i, most)
            own, at = np.array(list(pattern.values())), np.array(list(pattern))
            step = STEP * float((need[at] / own).min())
            cover[at] += own * step / need[at]
            key = tuple(sorted(pattern.items()))
            amount[key] = amount.get(key, 0.0) + step
    return {p: x / max(1.0, *(cover[i] for i, _ in p)) for p, x in amount.items()}


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over (length: count), as patterns and copies; a bit of ``free`` says that bins with so much room are open.

    Equal bins are one entry, so work and memory grow with the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    free = 0
    for x in sorted(histogram, reverse=True):
        n = histogram[x]
        while n:
            fits = free >> x
            if fits:
                r = (fits & -fits).bit_length() - 1 + x
                held, bins = room[r].pop()
            else:
                r, held, bins = capacity, {}, 0
            # best-fit fills a bin with pieces of one length before it goes to the next
            k = min(r // x, n)
            taken = min(bins, n // k) if fits else n // k
            if bins > taken:
                room[r].append((held, bins - taken))
            elif fits and not room[r]:
                free &= ~(1 << r)
            room.setdefault(r - k * x, []).append((held | {x: k}, taken))
            free |= 1 << (r - k * x)
            n -= k * taken
    return [entry for entries in room.values() for entry in entries]


def whole_copies(lengths: np.ndarray, need: np.ndarray, base: np.ndarray, least: float, capacity: int, fractional: bool) -> tuple[list[tuple[tuple, int]], list[int], bool]:
    """Patterns worth ``least`` and their copies, what is left of each length, and whether rounding down gave any."""
    stock, worth, out = need.tolist(), base.tolist(), []

    def take(pattern, most: int) -> int:
        copies = min(most, *(stock[i] // k for i, k in pattern))
        if copies > 0:
            for i, k in pattern:
                stock[i] -= copies * k
            out.append((tuple(pattern), copies))
        return max(copies, 0)

    value = lambda pattern: sum(worth[i] * k for i, k in pattern)
    floors = 0
    if fractional:
        amounts = sorted(((p, x) for p, x in multiplicative_weights(lengths, need, base, capacity).items() if value(p) >= least), key=lambda item: (-item[1], item[0]))
        for p, x in amounts:
            floors += take(p, int(x))
        for p, x in sorted(amounts, key=lambda item: (item[1] // 1 - item[1], item[0])):
            if x % 1:
                take(p, 1)
    for _ in range(WHOLE):
        before, held = len(out), np.array(stock)
        if not held.any():
            break
        cover = 1 - held / need
        sack = Knapsack(lengths, _weighed(base, cover) * (held > 0), capacity)
        for i in np.lexsort((-lengths, cover)).tolist():
            if stock[i]:
                pattern = sorted(sack.with_length(i, stock).items())
                if value(pattern) >= least:
                    take(pattern, max(1, int(STEP * min(stock[j] // k for j, k in pattern))))
        if len(out) == before:
            break
    return out, stock, floors > 0


def plan_parts(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[dict[int, int], int]], list[tuple[dict[int, int], int]]]:
    """Patterns (length: count) and copies, first those of the program, then best-fit's of what it left."""
    lengths = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    placed: list[tuple[dict[int, int], int]] = []
    best = (placed, best_fit(histogram, capacity))
    used, fractional = sum(c for _, c in best[1]), True
    for k in range(PASSES):
        some = np.flatnonzero(left)
        if not len(some):
            break
        own = lengths[some]
        base, _ = first_prices(own, left[some], capacity)
        least = (1 - SLACK * (2**k - 1) - 1e-9) * Knapsack(own, base, capacity).best
        found, stock, fractional = whole_copies(own, left[some], base, least, capacity, fractional)
        if not found:
            continue
        left[some] = stock
        placed = placed + [({int(own[i]): n for i, n in p}, c) for p, c in found]
        rest = best_fit({int(x): int(n) for x, n in zip(lengths, left, strict=True) if n}, capacity)
        total = sum(c for _, c in placed) + sum(c for _, c in rest)
        # of equal totals the program's larger part
        if total <= used:
            best, used = (placed, rest), total
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length: count) and copies that hold exactly the pieces of the histogram."""
    placed, rest = plan_parts(histogram, capacity)
    return placed + rest


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces per sequence, first sequence, first offset) in the order of ranks."""
    out: dict[int, list] = {}
    next_rank: Counter = Counter()
    sequence = 0
    for pattern, copies in patterns:
        offset = 0
        for x, k in sorted(pattern.items(), reverse=True):
            out.setdefault(x, []).append((next_rank[x], k, sequence, offset))
            next_rank[x] += k * copies
            offset += k * x
        sequence += copies
    return {x: np.array(rows, np.int64) for x, rows in out.items()}


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document, whose ids end with END: doc_id, piece, start, length, ids_crc32."""

    def run(batches):
        own, end = codec(vocabulary), np.array([END], "<u4").tobytes()
        for b in pieces(batches, "text"):
            rows: list[tuple] = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), own.encode(b.column("text").to_pylist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence_id and offset.

    A null or empty text is one piece, the end id alone.  Repeated rows, and rows
    without doc_id, are packed each for itself.  An empty table gives no rows.
    """
    rows = save(token_pieces(docs, vocabulary, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = rows.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    key = ["length", "share"]
    # as many shares of each length as its pieces need; the list has one row a length, ``capacity`` at most
    shares = F.broadcast(rows.sparkSession.createDataFrame([(x, -(-n // RANK_ROWS)) for x, n in histogram.items()], "length long, shares long"))
    dealt = rows.join(shares, "length").withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "shares")).drop("shares")
    before = dealt.groupBy(*key).agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")).drop("n")
    inner = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("inner", inner).join(before, key).withColumn("rank", F.col("inner") + F.col("before"))

    def run(batches):
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(part):
                    x = int(length[part[0]])
                    table = places.value[x]
                    row = table[np.searchsorted(table[:, 0], rank[part], side="right") - 1]
                    inside = rank[part] - row[:, 0]
                    sequence[part] = row[:, 2] + inside // row[:, 1]
                    offset[part] = row[:, 3] + inside % row[:, 1] * x
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    wanted = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank"))
    return wanted.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
