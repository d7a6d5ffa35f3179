"""A corpus from raw documents to token ids: STAGES in order, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm import bpe, decontaminate, langid, linededup, simhash
from chronoload.llm.common import table
from chronoload.session import prepare, stage

#: Rows that a Python worker holds at once. Stages of the pipeline share their workers, so each must leave room for the next.
BATCH_ROWS = 2_000


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter, or unlike every learned language, go; all stay if no language can be learned."""
    _bounded(spark)
    return langid.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more hold stay in the last of them only."""
    _bounded(spark)
    return linededup.drop_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, the one with the least id stays."""
    _bounded(spark)
    return simhash.drop_near_duplicates(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or a whole shorter item, go."""
    _bounded(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left: ``doc_id, source, lang, n_tokens, ids`` and whether they decode to the text."""
    import public_tokenizers

    _bounded(spark)
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    whole = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "lang", "n_tokens", "ids", whole.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("byte_bpe", encode),
]

#: No SQL has the fingerprints, the random field or the merges; the tests run each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
