"""The corpus pipeline: language ID, near copies, decontamination, mixing, shards; a stage per function of STAGES.

Every stage takes a table with ``doc_id``, ``text``, ``lang`` and ``source``; all other columns, whatever their names and
types, stay as they are, but for ``n_chars`` of a text that ``mix`` cuts. Each stage states what becomes of nulls, empty
and very long texts, ties and repeated rows; an empty table gives an empty table in all of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import decontamination, languages, mixing, sharding, similarity
from earshot.llm.text import apart
from earshot.session import shared_dir
from earshot.sources.store import delete, materialize, scratch


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language. What goes: texts without a letter, and those for which no language gets half of
    the likelihood, so that a short text between two languages stays.

    Null, empty and blank texts have no letter and go. Texts of any length are judged whole. Rows alike in text, repeated
    rows among them, share their fate; languages that are equally likely come in the order of their names. Where no row
    has a language to learn from, no document has one.
    """
    inside, back = apart(docs, "doc_id", "text", "lang")
    judged = languages.identify(inside, languages.learn(inside), ambiguous=0.5)
    return back(judged.filter((F.col("lang_pred") != languages.UNKNOWN) & ~F.col("ambiguous")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8; the one with the smallest id, of
    equal ids that with the smallest hash of its text.

    Copies without an id and repeated rows are copies like others: of rows alike in id and text the one with the smallest
    hash of its columns stays. Null, empty and blank texts have no words, are near to nothing and all stay. Texts of any
    length are compared whole.
    """
    inside, back = apart(docs, "doc_id", "text")
    return back(similarity.drop_near_copies(inside, alike=False))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no item of the table ``benchmark``.

    Null and empty texts overlap nothing and stay. Texts and items of any length are searched whole. Rows alike in id and
    text share their fate. An empty benchmark, and items without tokens, take nothing away.
    """
    inside, back = apart(docs, "doc_id", "text")
    return back(decontamination.decontaminate(inside, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, one per source cut where the target is reached; a cut text
    has its own ``n_chars``, where there is such a column.

    Null, empty and blank texts have no words to take and go. A null source is a source, the last one. A very long text
    is cut like others. Which documents come first is decided by a hash of the row; rows alike in all of it share the cut.
    """
    inside, back = apart(docs, "doc_id", "text", "source")
    mixed = back(mixing.mixed_rows(mixing.mix(inside)))
    own = next((c for c in docs.columns if c.lower() == "n_chars"), None)
    if own is None:
        return mixed
    length = F.when(F.col("text").isNull(), F.col(f"`{own}`")).otherwise(F.length("text"))
    return mixed.withColumn(own, length.cast(docs.schema[own].dataType))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shards (``sharding.MADE``); columns of these names are replaced.

    Null and empty texts have 0 bytes. Rows without id are placed by their text; rows that share an id, repeated rows among
    them, are in one shard while it fits its limit, and split beyond. A single text above the limit is a shard alone.
    """
    return sharding.shard(docs)


STAGES = [
    ("language", identify),
    ("near_copies", one_of_each),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# SQL cannot state a fitted classifier; tests compare the stages with plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each over all that the one before kept. What a stage wrote on its way is deleted with it, and
    its input once the output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, path=path)
        if before is not None:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
