"""From raw documents to training sequences: every stage is one operator, written and read again before the next.

NULLs, empty texts, repeated rows, empty tables and extra columns are
handled by the operators; every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import materialize, table
from tidewell.llm.decontaminate import clean_documents
from tidewell.llm.jaccard_join import keep_one
from tidewell.llm.language_id import held_out, keep_identified
from tidewell.llm.mixing import mix_sources
from tidewell.llm.token_output import written_order


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give documents without a language the one found; drop those to which none can be given: without text or without a letter."""
    return keep_identified(docs, docs.where(~held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal or similar texts (five-word shingles, similarity 0.8)."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is covered by benchmark windows."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin the documents of each source to its target."""
    return mix_sources(docs)


def order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, written to shards; one fixed-stride record per row, read back from them."""
    return written_order(docs)


STAGES = [("language_id", identify), ("jaccard_join", near_duplicates), ("decontamination", decontaminate), ("mix_sources", mix), ("training_order", order)]

#: Automata and tokenizers cannot be written in SQL; tests compare every stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
