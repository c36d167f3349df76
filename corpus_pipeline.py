"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept.  All but the last return the columns of documents.  Rows with a null
doc_id pass the stages that address documents by it unchanged.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm import jaccard, line_dedup, quality, tiling
from hindcast.llm.common import durable
from hindcast.llm.packing import pack_documents

#: Ids of documents to leave out that may be broadcast (8 bytes each); more of them are shuffled, with the texts.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but those whose doc_id is in gone."""
    gone = durable(gone.select("doc_id").distinct())
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity or repeats exceed their language's limit go."""
    found = quality.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, found.groupBy("doc_id").agg(F.bool_or("keep").alias("keep")).where("not keep"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines with 50 words or more go; so do documents that lose all they have."""
    out = line_dedup.line_dedup(docs)
    out = out.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"\S"))
    return out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles the one with the smallest id stays."""
    found = jaccard.jaccard_components(docs, n=5, percent=80)
    return without(docs, found.where("component_id <> doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    return without(docs, tiling.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences of 2048 tokens that all kept documents are packed into."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The first, third and last stages have no SQL: they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each returns is written to the shared folder, read again, and deleted when the next is written."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-pipeline-")
    folder = f"{base}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
                done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
    return docs
