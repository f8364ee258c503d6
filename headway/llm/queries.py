"""The registered queries of the training-text operators: each applies its operator to a whole table."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pseudonym_key(spark: SparkSession) -> bytes:
    """The secret key of pseudonyms, from the session's ``spark.headway.pseudonymKey``.

    Where it is unset a fresh random key is drawn, whose pseudonyms link values within one run only.
    """
    set_ = spark.conf.get("spark.headway.pseudonymKey", None)
    return set_.encode() if set_ else secrets.token_bytes(32)


def op1_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .htmltext import extract

    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests

    return digests(table(spark, sf_dir, "documents"), vocabulary())


def op3_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mtree import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import with_held_out

    return with_held_out(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import clean_lines

    out = clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines_failed")


def op9_line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import dedup_lines

    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise

    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark))
    return out.select("doc_id", "text", F.size("spans").cast("long").alias("n_found"), F.array_join(F.array_sort(F.array_distinct("spans.kind")), ",").alias("kinds"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import save
    from .tokenscan import count_documents, write_flat

    flat = save(write_flat(table(spark, sf_dir, "documents"), vocabulary()), "flat")
    return count_documents(flat).select("doc_id", "file_id", "ordinal", "start", "n_tokens", "complete")


def op10_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary())


def op11_filter_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filteraudit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_source_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


def op12_source_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


def op13_patricia_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exactdedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_site_templates, op2_bpe_codec, op3_mtree_top_k, op4_crf_language, op5_line_first_quality, op6_feistel_pseudonyms, op7_jaccard_join, op8_separator_scan, op9_line_dedup_runs, op10_configuration_packing, op11_filter_lattice, op12_source_tournament, op13_patricia_dedup)}


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return {"op3_mtree_top_k": oracles.TOP_K, "op5_line_first_quality": oracles.QUALITY, "op7_jaccard_join": oracles.NEAR, "op9_line_dedup_runs": oracles.LINES, "op11_filter_lattice": oracles.FILTER_ORDERS, "op12_source_tournament": oracles.DIVERGENCE, "op12_source_tournament": oracles.DIVERGENCE, "op13_patricia_dedup": oracles.COPIES}
