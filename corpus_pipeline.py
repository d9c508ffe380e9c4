"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import langid
from rollcall.llm.chosen_path import keep_one
from rollcall.llm.common import DOCUMENT_COLUMNS, is_held_out, table
from rollcall.llm.decontaminate import mark_leaks
from rollcall.llm.line_dedup import dedup_lines
from rollcall.llm.packing import added_tokens, pack_documents
from rollcall.session import passing, prepare, remove, staged

# Of held-out documents whose language was found, so many scored lower than the bound's base.
LOWEST_SHARE = 0.001
SLACK = 0.9
# A text that is half in one language and half in another is no stranger.
MIXED = 0.45


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without a letter or of no clear language go.

    What is clear is told by documents that the model has not learned from: the
    bound lies below nearly all scores of those whose language it found, and no
    higher than that of a text in two languages.
    """
    named = staged(langid.predict(docs.select(*DOCUMENT_COLUMNS), langid.fit(docs)), "named")
    found = named.where(is_held_out(F.col("doc_id")) & (F.col("lang") == F.col("lang_pred")))
    base = found.agg(F.percentile_approx("score", F.lit(LOWEST_SHARE), F.lit(10000))).first()[0] or 0.0
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= min(SLACK * base, MIXED))
    return named.where(known).select(*DOCUMENT_COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; a document that loses all its lines goes."""
    own = dedup_lines(docs.select(*DOCUMENT_COLUMNS))
    left = (F.size("removed") == 0) | F.col("text").rlike(r"\S")
    return own.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    return keep_one(docs.select(*DOCUMENT_COLUMNS))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    marked = mark_leaks(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))
    return marked.where(F.size("leaks") == 0).select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


STAGES = [
    ("language identification", languages),
    ("line dedup", lines),
    ("n-gram Jaccard join", similar),
    ("benchmark decontamination", leaks),
    ("best-fit packing", packed),
]

# Models, MinHash and tokenisation are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    What a stage stored on its way is removed once its own rows are written.
    """
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for _, stage in first:
        with passing() as kept:
            rows = kept(staged(stage(spark, docs, sf_dir), "stage"))
        if hasattr(docs, "staged_path"):
            remove(docs)
        docs = rows
    return last(spark, docs, sf_dir)
