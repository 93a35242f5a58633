"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, one document of each group of near copies stays, repeated passages are cut from the others, documents
that hold benchmark items go, and what is left is encoded and decoded.

Odd rows: a null or empty text is scored as a text without any feature, has no copies, repeats or items, and encodes to the
begin and end ids; a row without doc_id stays in every stage; rows that repeat doc_id and text are copies of each other;
of equal texts the smallest doc_id stays; extra columns, of any name, reach the last stage; empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.llm import decontaminate, metric_join, piece_codec, toxicity, unit_dedup
from wattledger.llm.common import keep


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below one half; learned from the labelled rows that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return model.score(docs).where("score < 0.5").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return metric_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return unit_dedup.remove_repeats(docs, PASSAGE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"), ("lang", "source"))


PASSAGE_WORDS = 20  # repeats of fewer words in a row, such as stock phrases, stay


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

# learned scores and a tokenizer can't be put in SQL; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
