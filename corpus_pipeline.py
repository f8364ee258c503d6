"""The corpus pipeline: quality rules, line dedup, near duplicates, pseudonyms, packing.

Counted as part of headway.llm.  Each stage takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of ``documents``: a stage that changes texts
sets n_chars anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import save, table
from headway.llm.jaccard import representatives
from headway.llm.linededup import dedup_lines
from headway.llm.packing import pack
from headway.llm.pii import pseudonymise
from headway.llm.quality import clean_lines
from headway.llm.queries import pseudonym_key, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(df: DataFrame, text: str) -> DataFrame:
    new = F.col(text)
    return df.select("doc_id", new.alias("text"), "lang", "source", F.length(new).cast("long").alias("n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without their failing lines."""
    return _with_text(clean_lines(docs.select(*COLUMNS)).filter("kept"), "cleaned")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a smaller doc_id holds; a document that loses every line goes."""
    out = dedup_lines(docs.select(*COLUMNS))
    return _with_text(out.filter((F.col("n_dropped") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")), "kept_text")


def near_duplicate_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, that with the smallest doc_id; rows without shingles stay.

    Rows are judged each for itself: another text with the same doc_id stays if nothing
    resembles it, and of equal rows one stays.  Rows without doc_id stay if all of their
    component lack it, one of them.
    """
    return representatives(docs.select(*COLUMNS))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal data and secrets."""
    return _with_text(pseudonymise(docs.select(*COLUMNS), pseudonym_key(spark)), "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_join),
    ("PII", pseudonyms),
    ("best-fit packing", packing),
]

#: Set similarity of components, keyed pseudonyms and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
