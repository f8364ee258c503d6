"""Token counts of documents in flat token files, found by scanning for separators.

A flat file is a stream of fixed-width ids in which an end-of-document id follows
each document; nothing says where documents begin.  It is held as a table of
blocks (file_id, block, data) that cut the stream without regard to documents.
Each block is searched at once with numpy; a prefix scan over blocks (within groups
of SPAN blocks, then over groups) carries ordinals and the last separator across
block boundaries, so no task sees more than SPAN block summaries of a file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import pieces, save

BLOCK, SPAN, END_OF_DOCUMENT = 1 << 17, 1024, 49407


def write_flat(docs: DataFrame, vocabulary: str, end: int = END_OF_DOCUMENT, block: int = BLOCK, width: str = "<u2") -> DataFrame:
    """One flat file per partition: file_id, block, data (ids of ``width``), first (ordinal) and doc_ids of the documents ending in the block.

    The last two columns are the list of what went into a file in its order; the scan doesn't read them.
    Strings of special tokens in a text are ordinary text, so that only ends of documents are ends.
    A vocabulary with ids that ``width`` has no room for is an error.
    """

    def run(batches):
        own, mark = codec(vocabulary), np.array([end], width)
        file_id = TaskContext.get().partitionId()
        held, n, number, first, ended = [], 0, 0, 0, []

        def row(data: np.ndarray, ids: list) -> pa.RecordBatch:
            columns = [pa.array([file_id], pa.int64()), pa.array([number], pa.int64()), pa.array([data.tobytes()], pa.binary()), pa.array([first], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["file_id", "block", "data", "first", "doc_ids"])

        for b in pieces(batches, "text"):
            for doc, ids in zip(b.column("doc_id").to_pylist(), own.encode(b.column("text").to_pylist(), special=False), strict=True):
                ids = np.frombuffer(ids, "<u4")
                if len(ids) and int(ids.max()) > np.iinfo(width).max:
                    raise ValueError(f"an id needs more than {width}")
                stream = np.concatenate([ids.astype(width), mark])
                while n + len(stream) > block:
                    cut = block - n
                    yield row(np.concatenate([*held, stream[:cut]]), ended)
                    stream, held, n, number, first, ended = stream[cut:], [], 0, number + 1, first + len(ended), []
                held.append(stream)
                n += len(stream)
                ended.append(doc)
        if n:
            yield row(np.concatenate(held), ended)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "file_id long, block long, data binary, first long, doc_ids array<long>")


def separators(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: str = "<u2") -> DataFrame:
    """Ids in each block and the places of separators in it: file_id, block, n, ends."""

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                ids = np.frombuffer(b.column("data")[k].as_buffer(), width)
                at = pa.array([np.flatnonzero(ids == end).astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("file_id")[k : k + 1], b.column("block")[k : k + 1], pa.array([len(ids)], pa.int64()), at], ["file_id", "block", "n", "ends"])

    return blocks.select("file_id", "block", "data").mapInArrow(run, "file_id long, block long, n long, ends array<int>")


def prefix_scan(df: DataFrame, **columns: Column) -> DataFrame:
    """Each column aggregated over the earlier blocks of the file, by groups of SPAN blocks; null before the first."""
    spans = df.withColumn("_span", F.floor(F.col("block") / SPAN)).withColumns({f"_v_{k}": v for k, (_, v) in columns.items()})
    earlier = Window.partitionBy("file_id").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    totals = spans.groupBy("file_id", "_span").agg(*[f(f"_v_{k}").alias(f"_t_{k}") for k, (f, _) in columns.items()])
    totals = totals.select("file_id", "_span", *[f(f"_t_{k}").over(earlier).alias(f"_p_{k}") for k, (f, _) in columns.items()])
    inner = Window.partitionBy("file_id", "_span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out = spans.join(totals, ["file_id", "_span"]).withColumns({f"_i_{k}": f(f"_v_{k}").over(inner) for k, (f, _) in columns.items()})
    both = lambda k, f: F.greatest(f"_p_{k}", f"_i_{k}") if f is F.max else F.when(F.col(f"_p_{k}").isNull(), F.col(f"_i_{k}")).otherwise(F.col(f"_p_{k}") + F.coalesce(f"_i_{k}", F.lit(0)))
    return out.select(*df.columns, *[both(k, f).alias(k) for k, (f, _) in columns.items()])


def document_lengths(blocks: DataFrame, end: int = END_OF_DOCUMENT, width: str = "<u2") -> DataFrame:
    """file_id, ordinal, start and n_tokens of each document of flat files (without its separator), and ``complete``.

    Ids behind a file's last separator are a document that is not complete.  An
    empty document has 0 tokens.  A file without ids, or an empty table, gives no rows.
    """
    # places of separators are few; all that follows reads them, not the ids
    found = save(separators(blocks, end, width), "separators")
    sums = prefix_scan(found, start=(F.sum, F.col("n")), ordinal=(F.sum, F.size("ends").cast("long"))).fillna(0, ["start", "ordinal"])
    # a file's last block also ends a document if ids remain; behind it stands a separator that isn't there
    total = found.groupBy("file_id").agg(F.sum("n").alias("total"), F.max("block").alias("last"))
    last_end = F.when(F.size("ends") > 0, F.col("start") + F.element_at("ends", -1))
    carried = prefix_scan(sums, carry=(F.max, last_end)).join(total, "file_id")
    open_end = (F.col("block") == F.col("last")) & (F.coalesce(last_end, F.col("carry"), F.lit(-1)) < F.col("total") - 1)
    ends = F.concat(F.transform("ends", lambda x: F.col("start") + x), F.when(open_end, F.array("total")).otherwise(F.array().cast("array<bigint>")))
    rows = carried.withColumn("all", ends).select("file_id", "ordinal", "carry", "total", "all", F.posexplode("all").alias("k", "stop"))
    begin = F.when(F.col("k") > 0, F.get("all", F.col("k") - 1)).otherwise(F.coalesce("carry", F.lit(-1))) + 1
    return rows.select("file_id", (F.col("ordinal") + F.col("k")).alias("ordinal"), begin.alias("start"), (F.col("stop") - begin).alias("n_tokens"), (F.col("stop") < F.col("total")).alias("complete"))


def count_documents(flat: DataFrame) -> DataFrame:
    """doc_id with what ``document_lengths`` finds in files of ``write_flat``; rows without doc_id and repeated ones count like others."""
    order = flat.select("file_id", F.posexplode("doc_ids").alias("k", "doc_id"), "first").select("file_id", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return document_lengths(flat).join(order, ["file_id", "ordinal"], "left")
