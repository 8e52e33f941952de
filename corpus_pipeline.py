"""A training corpus from documents: language, near-duplicates, repeated passages, mixture, tokens.

Each stage takes what the one before it kept, written as Parquet and read again, so that a lost executor or a failed stage
repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tejido.llm import bpe, langid, mixing, simhash, substring_dedup
from tejido.llm._shared import cut, drop_cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language stays in doubt, go (operator 4). So do null and empty texts; null languages and sources, null and repeated
    doc_ids are no matter: each row is judged by its text alone, texts of any length whole. No rows give no rows."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays (operator 3). Rows without a doc_id stay; rows that share one are one
    document, which stays if any of them leads its group, with each of its texts once. Null and empty texts are copies of each other."""
    return simhash.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document holds are cut out; documents that are left empty go (operator 5). Rows with a null doc_id or text
    stay as they are. Earlier is by doc_id; of rows that share one, the least text stands for all as a holder."""
    return substring_dedup.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are interleaved at their weights; those that are through before the last one begin anew (operator 6). Null sources are one source; null
    texts and doc_ids count like others; rows that share doc_id and source stand in one place. Ties of the order within a source are broken by doc_id."""
    return mixing.mixed(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and their way back (operator 9). A null text has no tokens; repeated rows and null doc_ids have a row each."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode_documents),
]

#: SQL can't express the stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            drop_cut(before)
        before = docs
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
