"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor wrote and works on all of it. Null texts count as empty: the first stage drops them.
Null ids, languages and sources are values like others. Rows that repeat a document are copies: line dedup leaves one.
Columns besides doc_id, text, lang, source and n_chars pass through, whatever their names. Empty tables give empty
results. Ties are settled by doc_id, then by hashes of the texts, as each operator's docstring says.

Quality rules drop documents; line dedup drops lines, and documents that have none left; the n-gram join keeps one
document of each near-duplicate class; mixing repeats documents of under-represented sources (no source loses one);
packing returns token pieces in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import line_dedup, ngram_join, packing, quality_rules, source_mix
from foliant.llm.common import release, scratch, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has, or one within an edit of them."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their sources' weights ask for, in the order of the mix."""
    return source_mix.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("source mixing", mixing), ("packing", packed)]

#: SQL has neither the tokenizer of the last stage nor the hashes that order the mix; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents. What a stage stores for itself, and what its predecessor wrote, goes when it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            out = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), stays=True)
        release(docs)
        docs = out
    return STAGES[-1][1](spark, docs, sf_dir)
