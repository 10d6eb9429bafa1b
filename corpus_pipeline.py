"""The corpus pipeline: from documents to packed training sequences.

Each stage takes the documents that the one before kept, written as Parquet and read again. All
but the last return the columns of documents, extra ones included. Each row's own text decides, with
or without a doc_id and whatever shares it: rows go in the pass that reads their text, or by doc_id
and text together. All stages run on the same executors, so each bounds the batches of rows that
their Python workers take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import contamination, language, near_duplicates, packing, toxicity
from wayfare.llm.tables import maybe_among, text_keys
from wayfare.session import bound_batches, cut_lineage, scratch_path

#: Probability of a toxic label from which a document is rejected.
TOXIC = 0.3
SEQUENCE = 1024


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text are in ``dropped`` (doc_id, key, key2)."""
    found = cut_lineage(dropped.select(F.col("doc_id").cast("long").alias("__id"), F.col("key").alias("__key"), F.col("key2").alias("__key2")).distinct())
    key, key2 = text_keys("text")
    known = docs.select("*", F.col("doc_id").cast("long").alias("__own"), key.alias("__one"), key2.alias("__two"))
    # Most rows are told to stay by a filter of fixed size and are not shuffled.
    marked = maybe_among(known, F.xxhash64("__own", "__one", "__two"), found.select(F.xxhash64("__id", "__key", "__key2").alias("hashed")), "__maybe")
    met = marked.where("__maybe")
    same = met["__own"].eqNullSafe(found["__id"]) & (met["__one"] == found["__key"]) & (met["__two"] == found["__key2"])
    left = met.join(found, same, "left_anti")
    return marked.where("NOT __maybe").unionByName(left).select(*(F.col(f"`{name}`") for name in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language compression cannot tell: no letters, or hardly a margin.

    Dictionaries come from the labelled languages of ``docs`` itself.
    """
    bound_batches(spark)
    return language.drop(docs, language.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents at or above ``TOXIC``; learns from the labelled ones among ``docs``."""
    bound_batches(spark)
    return toxicity.drop(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group: five-word shingles, 0.8 or more.

    Rows without doc_id stay. Different texts under one doc_id are documents of their own; of those in
    one group, the one with the smallest set keys stays. Of rows equal in doc_id and text one stays.
    """
    bound_batches(spark)
    found = cut_lineage(near_duplicates.cluster(docs.where("doc_id IS NOT NULL"), keyed=True))
    keys = [F.col("text_key").alias("key"), F.col("text_key2").alias("key2")]
    single = _without(docs, found.where("NOT leads").select("doc_id", *keys))
    again = found.where("leads").groupBy("doc_id", *keys).count().where("count > 1").select("doc_id", "key", "key2")
    again = cut_lineage(again)
    if again.isEmpty():
        return single
    key, key2 = text_keys(docs["text"])
    named = single.where("doc_id IS NOT NULL").withColumn("__key", key).withColumn("__key2", key2).withColumn("__doc", F.col("doc_id").cast("long"))
    same = (named["__doc"] == again["doc_id"]) & (named["__key"] == again["key"]) & (named["__key2"] == again["key2"])
    repeated = named.join(again, same, "left_semi").dropDuplicates(["__doc", "__key", "__key2"])
    return _without(single, again).unionByName(repeated.select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, verbatim or with other numbers and names."""
    bound_batches(spark)
    return _without(docs, contamination.find_in_texts(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset) of the pieces of all documents."""
    bound_batches(spark)
    return packing.pack(docs, *packing.vocabulary(), most=SEQUENCE)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Compression, fitted scores and sketches have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if at + 1 == len(STAGES):
            return result
        path = scratch_path(spark, name)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
