"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches of ascending ids.  A batch's line keys are merge-anti-
joined with all runs; the keys that no run has form the batch's own sorted run,
each with the smallest document of the batch that holds it.  When a level has
FANOUT runs, they are merged into one run of the next level.  As batches ascend,
a key's owner is the smallest document of all that hold it, and a line is
dropped exactly where the runs don't have its key with its own document.

Only DataFrame functions.  Runs are Parquet tables in the shared folder; texts are
shuffled once, to meet their dropped line numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, save
from .quality import let, strip

BATCHES, FANOUT, MIN_KEY = 4, 2, 10
KEY = ["h1", "h2"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; lower() does that unless other capitals occur."""
    others = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(others, F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


class Runs:
    """The store of line keys: levels of sorted runs with disjoint keys."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout, self.levels = fanout, [[]]

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        out = None
        for r in runs:
            out = r if out is None else out.union(r)
        return out

    def add(self, lines: DataFrame) -> None:
        """Add a batch of lines (h1, h2, doc_id), whose documents come after those added before."""
        keys = lines.groupBy(*KEY).agg(F.min("doc_id").alias("doc_id"))
        known = self.all()
        fresh = keys if known is None else keys.hint("merge").join(known.select(*KEY), KEY, "left_anti")
        self.levels[0].append(save(fresh.sortWithinPartitions(*KEY), "run-0"))

    def compact(self) -> None:
        """Merge the runs of each full level into one of the next."""
        k = 0
        while k < len(self.levels):
            if len(self.levels[k]) >= self.fanout:
                merged = self.levels[k][0]
                for r in self.levels[k][1:]:
                    merged = merged.union(r)
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(save(merged.repartition(*KEY).sortWithinPartitions(*KEY), f"run-{k + 1}"))
                self.levels[k] = []
            k += 1


def line_keys(docs: DataFrame) -> DataFrame:
    """doc_id, row hash, line number and 128-bit key hash of each line with a key of MIN_KEY code points or more."""
    lines = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = ascii_lower(strip(F.col("line")))
    return lines.filter(F.length(strip(F.col("line"))) >= MIN_KEY).select("doc_id", "row", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with n_lines, n_dropped (long) and kept_text (string).

    A line whose key (stripped, A-Z in lower case, MIN_KEY code points or more) occurs
    in two documents or more stays only in the document with the smallest doc_id.
    A null or empty text is one empty line.  Rows without doc_id keep all lines and
    own none; rows with the same doc_id are one document.  Columns of ``docs`` that
    have the names of the new ones are replaced.  An empty table stays empty.
    """
    new = ("n_lines", "n_dropped", "kept_text")
    docs = docs.select(*[c for c in docs.columns if c not in new])
    cuts = [c for c in docs.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000).alias("c")).first()["c"] or []]
    batch = sum(((F.col("doc_id") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    lines = save(line_keys(docs.select("doc_id", "text")).withColumn("batch", batch), "lines")
    runs = Runs(fanout)
    for b in range(len(cuts) + 1):
        runs.compact()
        runs.add(lines.filter(F.col("batch") == b))
    dropped = lines.hint("merge").join(runs.all(), [*KEY, "doc_id"], "left_anti")
    row, gone = free_names([*docs.columns, *new], "_row", "_dropped")
    dropped = dropped.groupBy("doc_id", "row").agg(F.collect_set("pos").alias(gone)).withColumnRenamed("row", row)
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.withColumn(row, F.xxhash64("text"))
    left = lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(gone)), lambda i: F.get(ls, i)), "\n")
    return own.join(dropped.hint("shuffle_hash"), ["doc_id", row], "left").select(
        *[own[c] for c in docs.columns],
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias("n_dropped"),
        F.when(F.col(gone).isNull(), text).otherwise(let(F.split(text, "\n"), left)).alias("kept_text"),
    )
