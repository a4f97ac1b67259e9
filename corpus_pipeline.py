"""Corpus pipeline: toxicity, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on every row it is given and returns a DataFrame; all
but the last return the columns of documents. run() writes each stage's result to the shared folder
and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import langid, toxicity
from lotline.llm.common import staged, table
from lotline.llm.near_dedup import near_duplicates
from lotline.llm.packing import pack_apart
from lotline.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Null and empty texts are scored like any other."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, model, carry=tuple(COLUMNS[1:])).where("predicted = 0").select(COLUMNS)


def drop_unreadable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told (null text, or no letter) go.

    A corpus without a labelled document to learn from leaves every language 'und'; its readable
    documents stay.
    """
    return langid.identify(docs, langid.fit(docs), carry=tuple(COLUMNS[1:])).where("readable").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the least doc_id stays; of repeated rows, one.

    A document is a doc_id with a text: different texts under one doc_id are judged one by one, and if
    they are near copies of each other, all of them stay. A null doc_id counts as larger than any other;
    of a class of null doc_ids alone one text stays. Of rows equal in doc_id and text the one with the
    least lang, source and n_chars stays.
    """
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    classes = near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "class_id").distinct()
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("key")).alias("tie"))
    ranked = staged(keyed.select("key", rank.alias("rank")).distinct().join(classes, "key"), "ranked")
    least = ranked.groupBy("class_id").agg(F.min("rank").alias("least"))
    gone = ranked.join(least, "class_id").where("rank > least").select("key").distinct()
    kept = keyed.join(gone, "key", "left_anti").groupBy("key", "doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("rest"))
    return kept.select("doc_id", "text", "rest.*").select(COLUMNS)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document too are cut out; documents left without words go.

    What stands around a passage stays as it is, blanks and line breaks included; a document without a
    passage to cut keeps its text unchanged.
    """
    out = substring_dedup(docs, carry=("lang", "source"), rest=True).where("n_words > n_removed")
    text = F.col("rest")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in a training sequence; near copies, which cutting passages can leave, never share a bin."""
    return pack_apart(docs)


STAGES = [("toxicity", drop_toxic), ("language", drop_unreadable), ("near_dedup", drop_near_copies), ("substring_dedup", drop_passages), ("packing", pack)]
#: Learnt models and signatures have no SQL twin. Tests hold near copies, passages and packing against brute force, the
#: language network against a scalar forward pass and toxicity against held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
