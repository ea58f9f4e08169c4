"""A pipeline for training data: five stages, each on what the one before kept.

Language identification drops documents without a letter or without a clear
language; line dedup removes lines that repeat earlier ones and documents that
lose all of theirs; SimHash keeps the first document of each group of near
copies; decontamination drops documents that hold a benchmark window; packing
cuts what is left into sequences of 2048 tokens.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm import decontamination, language, lines, packing, simhash
from strandlake.llm.common import kept, table
from strandlake.llm.queries import tokenizer_path

#: Posterior under which no language is clear.
CLEAR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a clear language.

    Null, empty and letterless texts have none and go; rows that repeat go or
    stay together; with no language to learn from all go; an empty table stays
    empty; all columns stay as they are, whatever their names.
    """
    found, (lang, score) = language.judged(docs, language.learn(docs)), language.judged_names(docs)
    return found.filter((F.col(lang) != language.UNKNOWN) & (F.col(score) >= CLEAR)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that had words and lost all of them goes.

    Null and empty texts lose nothing and stay; documents that share an id, or
    have none, are told apart by their texts; rows that repeat both keep the
    same lines each; an empty table stays empty; other columns stay as they are.
    """
    left, (_, removed) = lines.dedup_lines(docs), lines.count_names(docs)
    return left.filter((F.col(removed) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies.

    Texts without a word (null, empty, blank) are one group; a null id comes
    last; documents that share an id are told apart by their texts; of rows that
    repeat one stays; an empty table stays empty; other columns stay as they are.
    """
    return simhash.first_of_groups(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window.

    Null and empty texts hold none and stay; rows that repeat go or stay
    together; an empty benchmark takes nothing; columns stay as they are.
    """
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, sequence and offset.

    A null text is empty, its document one token long; rows that repeat are
    documents of their own; an empty table gives no piece; columns other than
    doc_id and text are left out.
    """
    return packing.pack_documents(docs, tokenizer_path(), end_id=1)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
#: Language models and tokenizers have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
