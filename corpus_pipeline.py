"""A text corpus made ready for training, in five stages over the documents table.

Each stage takes (spark, docs, folder) and returns a frame; its result is
written as Parquet and read again as the next stage's documents. Any columns
beside those of documents go through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtside.llm import decontamination, mixing, quality, simhash, token_files
from courtside.llm.common import read, stored_copy, stored_place
from courtside.llm.registry import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the quality rules; all columns stay.

    Rows with a NULL or empty text have too few words and go. Each row is judged
    by its own text and language, so repeated rows, and rows that share a doc_id
    or have none, stay or go each by itself. An empty table stays empty.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; all columns stay.

    Different rows that share a doc_id, or have none, are documents of their
    own; of equal rows one stays. Rows with neither doc_id nor words stay. An
    empty table stays empty.
    """
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a notable share of benchmark text; all columns stay.

    Each row is judged by its own text, whatever its doc_id; rows with a NULL or
    empty text stay. An empty table, or an empty benchmark, changes nothing.
    """
    return decontamination.drop_contaminated(docs, read(spark, folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, in order of training position; columns as they were.

    Rows with a NULL or blank text have no words and are not taken; rows
    without source are one source; repeated rows, and rows that share a doc_id or
    have none, are rows of their own. An empty table stays empty.
    """
    return mixing.curriculum(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token shards of all documents in the order they are stored in, which is that of their training positions; told per document.

    A row per row: NULL and empty texts are the end id alone, repeated rows are
    written as often, doc_id may lack. An empty table gives no rows. Documents
    that do not come from files have no stored order and are written by doc_id.
    """
    from_files = bool(docs.inputFiles())
    return token_files.token_output(docs, TOKENIZER, order=stored_place() if from_files else None)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]

# The fingerprints and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents table; each stage's result is stored before the next."""
    docs = read(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_copy(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
