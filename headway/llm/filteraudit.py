"""Filter interaction audit: what each order of filters removes, from lattice-edge counts.

Filters applied in any order walk up the lattice of subsets.  A step is an edge
(subset already applied, next filter); five filters have 80 edges, which the 600
steps of their 120 orders share.  What happens on an edge depends on a document's
set of failed filters alone, so documents are first counted by that set and
contribute to the edges as counts; the steps are then joined to the edges.

A text is looked at once, in Arrow batches; the rest are joins and counts.  Shuffled
are one short row a document, to meet its labels and the copies of its text, and counts.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces

FILTERS = "ABCDE"
#: A fails texts of fewer words; B fails if under this percentage of the words are distinct, C if over this one of the code points is in A-Z, D on any of these characters.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, MARKS = 200, 50, 3, b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: The bytes that begin a code point.
_FIRST_BYTES = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)
#: Parts that rows without doc_id are dealt to.
DEALT = 256
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: bytes) -> int:
    """The bits of A to D that a text in UTF-8 fails; split() without an argument divides at just the white space that words have none of."""
    words = text.split()
    few, alike = len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT * len(words)
    loud = 100 * (len(text) - len(text.translate(None, _CAPITALS))) > MAX_CAPITALS * (len(text) - len(text.translate(None, _FIRST_BYTES)))
    return few | alike << 1 | loud << 2 | (len(text.translate(None, MARKS)) < len(text)) << 3


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (SHA-256 of the text) and failed (bits of A to D) of each row of doc_id, text, lang."""

    def run(batches):
        for b in pieces(batches, "text"):
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            digests, failed = [hashlib.sha256(t).digest() for t in texts], [text_failures(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(digests, pa.binary()), pa.array(failed, pa.int32())], ["doc_id", "part", "digest", "failed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text").mapInArrow(run, "doc_id long, part string, digest binary, failed int")


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of documents by part, failed (bits of FILTERS), good and toxic.

    A text's copies are found by its SHA-256.  E fails every row whose text a smaller
    doc_id holds; rows without doc_id neither fail it nor make others fail.  Of several
    labels of a document, each mark counts if one of them has it.
    """
    own = facts(docs).withColumn("deal", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(DEALT))).otherwise(0))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("deal", F.lit(0).cast("long"))
    known = own.join(marks, ["doc_id", "deal"], "left").fillna(False, ["good", "toxic"])
    kinds = ["digest", "part", "failed", "good", "toxic"]
    rows = known.groupBy("doc_id", "deal", *kinds).agg(F.count("*").alias("n"))
    # copies of a text shrink to one row a kind before they meet: how many, the smallest doc_id, and the rows that have it
    copies = rows.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("without") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.array(F.struct(F.col("failed"), passing.alias("n")), F.struct((F.col("failed") + F.lit(16)).alias("failed"), (F.col("n") - passing).alias("n")))
    both = copies.withColumn("least", least).select("part", "good", "toxic", F.inline(split))
    return both.filter("n > 0").groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def edges(sets: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """Per part and lattice edge (applied: bits of the subset, filter: number of the next one) the COUNTS of documents.

    ``sets`` has part, failed, good, toxic and n; every part has every edge.
    """
    lattice = [(s, f) for f in range(n_filters) for s in range(1 << n_filters) if not s >> f & 1]
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("applied"), F.lit(f).alias("filter")) for s, f in lattice]))
    on = sets.select("*", each.alias("edge")).select("part", "failed", "good", "toxic", "n", "edge.applied", "edge.filter")
    before, fails = F.col("failed").bitwiseAND(F.col("applied")) != 0, F.getbit("failed", F.col("filter")) == 1
    removed = ~before & fails
    cases = [~before & ~fails, removed, before & fails, F.col("failed") == F.expr("shiftleft(1, filter)"), removed & F.col("good"), removed & F.col("toxic")]
    return on.groupBy("part", "applied", "filter").agg(*[F.sum(F.when(case, F.col("n")).otherwise(0)).alias(c) for case, c in zip(cases, COUNTS, strict=True)])


def steps(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """filter_order, step, applied and filter of each step of every order of ``filters``."""
    rows = [("".join(filters[f] for f in order), k + 1, sum(1 << f for f in order[:k]), f) for order in permutations(range(len(filters))) for k, f in enumerate(order)]
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, filter int")


def paths(edge_counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part and step of every order the COUNTS of its edge, and shapley: what its filter removes, summed over all orders."""
    # one row a step: 600 for five filters
    out = edge_counts.join(F.broadcast(steps(edge_counts.sparkSession, filters)), ["applied", "filter"])
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).select("part", "filter_order", "step", *COUNTS, "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, COUNTS and shapley of the five filters on ``docs`` (doc_id, text, lang).

    A null text is empty and fails A alone, or E too where it is a copy; a null lang is
    the empty part.  Repeated rows count each, and fail E only beside a smaller doc_id.
    Other columns are ignored.  A table without rows has no parts and gives no rows; an
    empty table of labels gives zeros for what is lost.
    """
    return paths(edges(failed_sets(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"))))
