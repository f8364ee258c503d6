"""Source divergence audit: every pair of a language's sources meets in a tournament of blocks.

A group is a (lang, source).  Terms are counted in one pass over the texts; those in
enough documents of the language are dealt to slices of numbered terms.  In each slice
the language's groups form blocks of count vectors.  A block stays in its partition,
while compressed copies of the others visit it in the rounds of a round-robin
tournament (circle method): of two blocks that meet one is at home and one travels,
and the meeting gives the values of both directions.  A partition's rows come in the
order of the rounds, so a task holds one block at home and one visitor.

Shares and values are integers.  A group's vector has only the terms that it uses; a
term that neither of two groups uses adds the same value each time, so a meeting adds
up the differences from it over the terms used, and the first slice adds the rest.
"""

from __future__ import annotations

import heapq
import io
import json
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt_join, pieces, save

#: Documents of its language that a term must be in, and terms listed a group.
MIN_DOCUMENTS, TOP = 10, 10
#: Terms of a slice and groups of a block, about.
SLICE, BLOCK = 8192, 32
#: Terms that a task counts before it hands them on.
HELD = 200_000
#: 1,000,000,000 parts of a whole, as two factors: products with counts of up to 2^48 stay in 64 bits.
WHOLE = (31_250, 32_000)
_SEPARATORS = bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Maps A-Z to a-z and all that no term has to spaces; bytes of other characters stay.
_FOLD = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case."""
    return text.translate(_FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and df (documents), and one row without term for each group."""

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows():
            for (lang, source), (n, df) in held.items():
                terms = pa.array([None, *n], pa.binary()).cast(pa.string())
                both = pa.array([0, *n.values()], pa.int64()), pa.array([0, *(df[t] for t in n)], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array([source] * len(terms)), terms, *both], ["lang", "source", "term", "n", "df"])
            held.clear()

        for b in pieces(batches, "text"):
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                terms = terms_of(text)
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                df.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from rows()
        yield from rows()

    own = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = own.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: np.ndarray, whole: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 (n + 2) / (whole + 2 terms)), exactly; 1 where there are no terms."""
    least = whole + 2 * terms if terms else np.full_like(whole, 2**48)
    head, rest = np.divmod((n + 2) * WHOLE[0], least)
    return 1 + head * WHOLE[1] + rest * WHOLE[1] // least


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Block:
    """Vectors of shares: ``members``, their share of a term that they don't use (``none``), and numbers and shares of the terms used, cut at ``ends``."""

    def __init__(self, packed: bytes):
        with np.load(io.BytesIO(packed)) as z:
            self.members = json.loads(z["members"].tobytes())
            whole, self.terms, self.ends, n, gaps = z["whole"], int(z["terms"]), z["ends"], z["n"], z["gaps"]
        size = np.diff(self.ends)
        self.index = np.cumsum(gaps.astype(np.int64))
        self.none = share(np.zeros_like(whole), whole, self.terms)
        self.p = share(n, np.repeat(whole, size), self.terms)
        self.row = np.repeat(np.arange(len(whole)), size)
        self.dense = np.zeros((len(whole), 0), np.int64)

    @staticmethod
    def pack(members: list[str], whole: np.ndarray, terms: int, row: np.ndarray, index: np.ndarray, n: np.ndarray) -> bytes:
        """Compressed: numbers as differences, in the order of members."""
        order = np.lexsort((index, row))
        out = io.BytesIO()
        gaps = np.diff(index[order], prepend=0).astype(np.int32)
        ends = np.searchsorted(row[order], np.arange(len(members) + 1))
        np.savez_compressed(out, members=np.frombuffer(json.dumps(members).encode(), np.uint8), whole=whole, terms=terms, ends=ends, n=n[order], gaps=gaps)
        return out.getvalue()

    def at(self, width: int) -> np.ndarray:
        """The shares of the first ``width`` terms at least, 0 for those not used."""
        if self.dense.shape[1] < width:
            self.dense = np.zeros((len(self.members), max(width, int(self.index.max(initial=-1)) + 1)), np.int64)
            self.dense[self.row, self.index] = self.p
        return self.dense


def meeting(home: Block, visitor: Block, first: bool) -> np.ndarray:
    """Values of each group at home with each visitor, over the terms of one slice; ``first`` adds the terms that neither uses."""
    out = np.zeros((len(home.members), len(visitor.members)), np.int64)
    dense = home.at(int(visitor.index.max(initial=-1)) + 1)
    used = np.diff(home.ends)
    for w in range(len(visitor.members)):
        at, p = (x[visitor.ends[w] : visitor.ends[w + 1]] for x in (visitor.index, visitor.p))
        none = visitor.none[w]
        base = gap(home.none, none)
        # what groups at home use, as if the visitor used nothing
        alone = np.concatenate([[0], np.cumsum(gap(home.p, none))])
        total = alone[home.ends[1:]] - alone[home.ends[:-1]] - used * base
        # what the visitor uses, in place of what was counted there
        theirs = dense[:, at]
        both = theirs > 0
        total += gap(np.where(both, theirs, home.none[:, None]), p).sum(1) - len(at) * base
        total -= np.where(both, gap(theirs, none) - base[:, None], 0).sum(1)
        out[:, w] = total + (home.terms * base if first else 0)
    return out


def cells(entries: DataFrame) -> DataFrame:
    """Blocks packed, and each group's TOP terms of a slice: lang, slice, block, blocks, packed / source, index, value.

    ``entries``: lang, slice, block, blocks, terms, source, index, n, lang_n; a row with
    index -1 has the group's and the language's whole count.  A cell has about BLOCK
    groups with about SLICE terms each.
    """
    fields = {"lang": pa.string(), "slice": pa.int64(), "block": pa.int64(), "blocks": pa.int64(), "source": pa.string(), "index": pa.int64(), "value": pa.int64(), "packed": pa.binary()}
    schema = pa.schema(list(fields.items()))

    def run(t: pa.Table) -> pa.Table:
        source, index, n, lang_n = (t.column(c).to_numpy() for c in ("source", "index", "n", "lang_n"))
        terms, head = t.column("terms")[0].as_py(), index < 0
        members = sorted(source[head].tolist())
        number = {s: i for i, s in enumerate(members)}
        row = np.array([number[s] for s in source.tolist()], np.int64)
        whole = np.zeros(len(members), np.int64)
        whole[row[head]] = n[head]
        all_ = lang_n[head][0]
        row, index, n, lang_n = row[~head], index[~head], n[~head], lang_n[~head]
        p, q = share(n, whole[row], terms), share(lang_n, np.full_like(lang_n, all_), terms)
        value = gap(p, q)
        found = [(None, None, None, Block.pack(members, whole, terms, row, index, n))]
        for i, name in enumerate(members):
            over = np.flatnonzero((row == i) & (p > q))
            best = heapq.nsmallest(TOP, zip((-value[over]).tolist(), index[over].tolist(), strict=True))
            found += [(name, k, -v, None) for v, k in best]
        same = {c: [t.column(c)[0].as_py()] * len(found) for c in ("lang", "slice", "block", "blocks")}
        new = dict(zip(("source", "index", "value", "packed"), map(list, zip(*found, strict=True)), strict=True))
        return pa.table(same | new, schema=schema)

    return entries.groupBy("lang", "slice", "block").applyInArrow(run, "lang string, slice long, block long, blocks long, source string, index long, value long, packed binary")


def tournament(blocks: DataFrame) -> DataFrame:
    """Rows (lang, slice, home, round, packed): each block at home (round -1), and as visitor in the rounds in which it travels.

    With m players, blocks and if they are odd a bye, i and j below m - 1 meet in round
    (i + j) mod (m - 1), and who would meet himself meets m - 1.  The larger number
    travels if the sum is even, else the smaller.
    """
    i, r, m = F.col("block"), F.col("round"), F.expr("(blocks + blocks % 2)")
    other = F.pmod(r - i, m - 1)
    other = F.when(i == m - 1, F.pmod(r * F.expr("((blocks + blocks % 2) div 2)"), m - 1)).when(other == i, m - 1).otherwise(other)
    met = blocks.withColumn("round", F.explode(F.expr("sequence(0L, blocks + blocks % 2 - 2)"))).withColumn("home", other)
    travels = F.when((i + F.col("home")) % 2 == 0, i > F.col("home")).otherwise(i < F.col("home"))
    away = met.filter((F.col("home") < F.col("blocks")) & travels)
    columns = ["lang", "slice", "home", "round", "packed"]
    return blocks.select("lang", "slice", i.alias("home"), F.lit(-1).cast("long").alias("round"), "packed").unionByName(away.select(*columns))


def meet(rows: DataFrame) -> DataFrame:
    """lang, source, item and value of each pair of groups and slice, both ways, of the rows of ``tournament``."""

    def run(batches):
        key = home = None
        for b in pieces(batches, "packed"):
            for lang, slice_, at, turn, packed in zip(*(b.column(c).to_pylist() for c in ("lang", "slice", "home", "round", "packed")), strict=True):
                if turn < 0:
                    key, home = (lang, slice_, at), Block(packed)
                elif (lang, slice_, at) != key:
                    # a block without groups has no one at home
                    continue
                block = home if turn < 0 else Block(packed)
                values = meeting(home, block, slice_ == 0)
                i, j = np.triu_indices(len(home.members), 1) if turn < 0 else np.indices(values.shape).reshape(2, -1)
                one, two = [home.members[k] for k in i.tolist()], [block.members[k] for k in j.tolist()]
                value = pa.array(values[i, j], pa.int64())
                for source, item in ((one, two), (two, one)):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(source), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), value], ["lang", "source", "item", "value"])

    dealt = rows.repartition("lang", "slice", "home").sortWithinPartitions("lang", "slice", "home", "round")
    return dealt.mapInArrow(run, "lang string, source string, item string, value long")


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, slice_: int = SLICE, block: int = BLOCK) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank of ``docs`` (text, lang, source; others are ignored).

    A null text, lang or source is empty.  Repeated rows count each.  A language of one
    source has no pairs; without kept terms all pairs are 0 and there are no terms.  An
    empty table gives no rows.  Counts may go up to 2^48.
    """
    counts = save(term_counts(docs), "terms")
    kept = save(counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).filter(F.col("df") >= min_documents).drop("df"), "kept")
    groups = counts.filter("term IS NULL").select("lang", "source")
    some = lambda n, size: F.greatest(F.ceil(F.coalesce(n, F.lit(0)) / size), F.lit(1)).cast("long")
    langs = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("sum")), "lang", "left")
    langs = save(langs.select("lang", some(F.col("n_groups"), block).alias("blocks"), some(F.col("n_terms"), slice_).alias("slices"), F.coalesce("n_terms", F.lit(0)).alias("terms"), F.coalesce("sum", F.lit(0)).alias("whole")), "languages")

    sliced = dealt_join(kept, langs, "lang").withColumn("slice", F.pmod(F.xxhash64("term"), "slices"))
    number = (F.row_number().over(Window.partitionBy("lang", "slice").orderBy("term")) - 1).cast("long")
    vocabulary = save(sliced.select("lang", "term", "lang_n", "slice", "blocks", "terms", number.alias("index")), "vocabulary")
    columns = ["lang", "slice", F.pmod(F.xxhash64("source"), "blocks").alias("block"), "blocks", "terms", "source", "index", "n", "lang_n"]
    used = counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]).select(*columns)
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    heads = dealt_join(groups.join(sums, ["lang", "source"], "left"), langs, "lang").withColumn("slice", F.explode(F.expr("sequence(0L, slices - 1)")))
    heads = heads.withColumns({"n": F.coalesce("n", F.lit(0)), "index": F.lit(-1).cast("long"), "lang_n": F.col("whole")}).select(*columns)
    found = save(cells(used.unionByName(heads)), "cells")

    blocks = found.filter("packed IS NOT NULL").select("lang", "slice", "block", "blocks", "packed")
    pairs = meet(tournament(blocks)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    best = found.filter("packed IS NULL").join(vocabulary.select("lang", "slice", "index", "term"), ["lang", "slice", "index"]).select("lang", "source", F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank.alias("rank")) for part, df in (("pair", pairs), ("term", best))]
    return out[0].unionByName(out[1].filter(F.col("rank") <= TOP))
