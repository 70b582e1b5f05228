"""Corpus pipeline: language identification, exact copies, near copies, personal
data, packing. Every stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import langid, pii
from strata.llm.common import Scratch, quoted, read_table
from strata.llm.exactdedup import dedup_rows
from strata.llm.packing import pack, token_pieces
from strata.llm.simhash import simhash_components

# The models and the tokenizer leave no SQL form; tests hold the stages against
# brute force.
ORACLE_SQL = None

# A text whose most likely language has less than this probability has none.
MIN_LANGUAGE_SCORE = 0.5


def _back(rows: DataFrame, docs: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``docs`` out of ``row``, some of them replaced."""
    changed = changed or {}
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no recognised language go: null and empty texts, texts
    without letters, and those whose best language is unlikely."""
    found = langid.predict(docs, langid.fit(docs))
    return _back(found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)), docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: that with the largest id."""
    return _back(dedup_rows(docs, Scratch(spark, "pipeline-exact")).where("kept"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays (all rows
    that carry this id). Documents without an id belong to no component and stay."""
    components = simhash_components(docs, Scratch(spark, "pipeline-near"))
    gone = components.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    kept = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"))
    return _back(kept.join(gone, F.col("row.doc_id") == F.col("gone_id"), "left_anti"), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced by its kind in angle brackets;
    n_chars, where there is such a column, follows."""
    found = pii.find(docs, pii.fit(docs, Scratch(spark, "pipeline-pii")))
    changed = {"text": F.col("redacted")}
    if "n_chars" in docs.columns:
        length = F.char_length("redacted").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("spans") > 0, length).otherwise(F.col("row.n_chars"))
    return _back(found, docs, changed)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in the sequences."""
    return pack(token_pieces(docs), Scratch(spark, "pipeline-packing"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pii", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each returns is written to the
    shared folder and reread for the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
