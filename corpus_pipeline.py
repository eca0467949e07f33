"""A corpus pipeline over `documents`: quality classifier, exact dedup, n-gram Jaccard join, substring dedup, best-fit
packing. Each stage's result is written as Parquet in the shared folder and read again as the next one's docs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillstream.llm import exact_dedup, jaccard_join, packing, quality, stage, substring_dedup


@stage.pipeline_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above; it is fitted on the labels of sf_dir.

    Null and empty texts are scored like others (as one passage without words), very long ones whole, repeated rows each;
    a score equal to the threshold stays. Without labels the model is as it was before training. An empty table gives
    none; all columns of docs are kept, whatever their names."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@stage.pipeline_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id.

    Null and empty texts are equal. Rows that repeat doc_id and text are one document: of them the smallest by all columns
    stays. A row without a doc_id stays only where none of its copies has one. An empty table gives none; all columns of
    docs are kept."""
    return exact_dedup.keep_first_copies(docs)


@stage.pipeline_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.75, the one with the smallest doc_id.

    Null, empty and blank texts are linked with nothing and stay; texts of fewer than five words are one shingle; very
    long ones are read whole. Of equal doc_ids the smallest digest decides; a row without a doc_id stays only where none
    of its group has one. An empty table gives none; all columns of docs are kept."""
    return jaccard_join.keep_one_of_each(docs)


@stage.pipeline_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that occur elsewhere.

    Texts that lose nothing stay as they are, null ones null; one that loses all its words stays as an empty text. Rows
    that share a doc_id, or have none, are told apart by their texts. n_chars, where there is such a column, follows the
    text. An empty table gives none; all other columns of docs are kept."""
    return substring_dedup.without_repeats(docs)


@stage.pipeline_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences of 1024.

    Null and empty texts are one piece that holds the end id; very long ones are cut into full pieces; repeated rows and
    rows without a doc_id are packed each. An empty table gives none; no column but doc_id and text is read."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("best-fit packing", pack),
]

#: The classifier and the packing have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{stage.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, function) in enumerate(STAGES):
        out = function(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
