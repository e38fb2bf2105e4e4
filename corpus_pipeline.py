"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

    toxicity        documents with a toxicity score of a half or more go
    near_duplicates of each group of documents linked by shingle similarity, the one with the smallest id stays
    benchmark       documents that hold a test item within its edits go
    mix             sources are mixed to their target weights; a document's words come as often as the mix takes them
    tokens          what is left is written as token records, and their read-back index is the result

All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chronogrid.llm import decontaminate, queries, token_records, toxicity
from chronogrid.llm.common import saved
from chronogrid.llm.jaccard_join import jaccard_groups
from chronogrid.llm.mixing import mix


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5. The model is trained on labelled documents of the stage's input.

    Each row is decided by its text alone, whatever else repeats it. Null and empty texts
    have a score as well; without labels of both classes all rows have one score. An
    empty table stays empty.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id.

    Documents without words, or without an id, all stay. Rows that share an id are one
    document: of a kept id every differing text stays, and of rows that repeat id and text
    the one whose row has the smallest hash, so that reruns agree. An empty table stays
    empty.
    """
    groups = jaccard_groups(docs).where("doc_id <> component_id").select("doc_id").distinct()
    first = docs.join(saved(groups, "near-copies"), "doc_id", "left_anti")
    # Whole texts are dealt out and sorted of repeated ids alone; the other rows, and those without an id, stay where they are.
    repeated = saved(first.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return first.select(*docs.columns)
    same = Window.partitionBy("doc_id", F.sha2(F.col("text").cast("string"), 256)).orderBy(F.xxhash64(*docs.columns))
    nth = "__nth_of_id_and_text"
    told = first.join(repeated, "doc_id", "left_semi").withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1)
    return told.select(*docs.columns).unionByName(first.join(repeated, "doc_id", "left_anti").select(*docs.columns))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item within its edits. Each row is decided by its text; null and empty texts stay, an empty table on either side drops nothing."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each document and pass that takes words of it, text and n_chars to match.

    A null source is one of its own; texts without words are in no mix. Rows that repeat
    an id are documents of their own. An empty table gives an empty mix.
    """
    return mix(docs).texts(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of all documents in order of doc_id; doc_id, start, n_tokens and ids_crc32 as read back from the files.

    Null ids come first, rows of one id by a hash of their texts; a null or empty text is
    the end id alone. An empty table gives no rows.
    """
    return token_records.round_trip(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("benchmark", benchmark_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

#: SQL can express neither the classifier nor the edit matching, the draws and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
