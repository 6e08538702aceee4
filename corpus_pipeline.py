"""From raw documents to token ids: quality, exact copies, near copies, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
documents, extra ones too. `run` writes each stage as Parquet beside the checkpoints, reads it again
and removes the folder of the stage before; the last stage's folder holds the result and is the caller's to remove.

Cases. Null texts count as empty, of any length in all stages; documents of null id pass near_dedup as they are. Rows
that are equal in id and text are one text for exact_dedup, which keeps one row, with the values of
one of them. Rows that repeat an id with different texts are judged one by one. Ties go to the id that
a stage names, then to the text. Column names of documents never clash with those of the stages. Empty
tables pass all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernlight.llm import exact_dedup, mixing, pieces, quality, simhash_dedup
from fernlight.llm.common import checkpointed, drop_folder, ensure_checkpoint_dir, ship


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(F.col("text"), model) >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id. Fingerprints within four bits link, all of them.

    So do texts whose five-word shingles are 0.8 similar and that share a band of least hashes: every such
    pair does with a probability of 0.99997 or more.
    """
    ship(spark)
    near = simhash_dedup.near_copies(docs, similarity=0.8, shingle=5).where("not kept")
    gone = checkpointed(near.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")))
    text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(simhash_dedup.few(gone), (docs["doc_id"] == F.col("__gone")) & F.coalesce(F.col("__hash") == text, F.lit(True)), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by probabilities raked to source, language and topic targets."""
    return mixing.sample_mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of each document."""
    ship(spark)
    return pieces.encode(docs)


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixture", mix), ("encode", encode)]

#: The classifier and the near copies are not SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        here = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if before:
            drop_folder(spark, before)
        before = here
    return docs
