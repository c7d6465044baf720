"""A corpus pipeline of five stages: language ID, exact dedup, SimHash near-dedup,
mixing sources to target weights, SentencePiece encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from farelens.llm import exact, langid, mixing, pieces, simhash
from farelens.llm.common import documents, shared_folder
from farelens.llm.queries import piece_model

#: Texts that agree with no language profile better than this are rejected.
MIN_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = langid.fit(docs, usable=~langid.held_out())
    return langid.drop_undetermined(docs, profiles, MIN_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_spans(docs, piece_model(), end=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece_encoding", encoding),
]
#: Fingerprints, language profiles and BPE have no SQL form; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet in the shared folder and reread.
    Returned are the ids; the last stage's table also holds pieces and byte ranges."""
    docs = documents(spark, sf_dir)
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs.select("doc_id", "ids")
