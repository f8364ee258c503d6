"""Helpers shared by the training-text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a piece that a Python function holds at once, and its text bytes.
PIECE_ROWS, PIECE_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a local
    session gets a temporary folder of this machine; any other is an error, as its
    executors wouldn't see such a folder.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.headway.scratch", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-headway-")
        spark.conf.set("spark.headway.scratch", folder)
    return folder.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    The files are in the shared folder, so a lost executor costs no recomputation.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names`` with underscores put before them until none is a name of ``columns``."""
    used, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


#: A key is hot if over this share of all rows hold it, so that fewer than 1 / HOT keys are hot and their list may be broadcast; tables of fewer rows have no hot keys.
HOT, HOT_ROWS = 1 / 4096, 256


def hot_keys(df: DataFrame, *key: str) -> DataFrame:
    """``key`` and ``_shares``, the number of parts to deal its rows to, of the keys that over HOT of all rows hold."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_n"))
    least = F.greatest(F.sum("_n") * F.lit(HOT), F.lit(HOT_ROWS))
    return counts.filter(F.col("_n") > HOT_ROWS).crossJoin(F.broadcast(counts.agg(least.alias("_least")))).filter(F.col("_n") > F.col("_least")).select(*key, F.ceil(F.col("_n") / F.col("_least")).cast("int").alias("_shares"))


def dealt_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, whose rows differ in ``key``; a hot key's rows of ``left`` are dealt to parts, each with its copy of the row of ``right``.

    Without hot keys it is a plain join; their list, which HOT bounds, is looked at first.
    """
    found = hot_keys(left, key).collect()
    if not found:
        return left.join(right, key, how)
    hot = F.broadcast(left.sparkSession.createDataFrame(found, left.select(key, F.lit(1).alias("_shares")).schema))
    shares = F.coalesce("_shares", F.lit(1))
    others = [c for c in left.columns if c != key]
    dealt = left.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*(others or [key])), shares).cast("int")).drop("_shares")
    copies = right.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def pieces(batches: Iterator[pa.RecordBatch], text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no piece has over PIECE_ROWS rows or, unless one row has more, PIECE_BYTES of text."""
    for batch in batches:
        start = 0
        sizes = None
        if text is not None:
            import pyarrow.compute as pc

            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        while start < batch.num_rows:
            stop, held = start, 0
            while stop < batch.num_rows and stop - start < PIECE_ROWS:
                held += sizes[stop] if sizes else 0
                if stop > start and held > PIECE_BYTES:
                    break
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop
