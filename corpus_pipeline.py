"""A training corpus from raw documents: filter, deduplicate, mix and encode, each stage on what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.llm import block_names, covering_simhash, mixing, toxic_passages, word_automaton
from proclivity.llm.shared import Workspace

#: A document with at least this probability of being toxic is rejected.
TOXIC = 0.3
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic passages. Scores are joined by doc_id; a null doc_id is judged by its own text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_passages.drop_toxic(docs, labels, TOXIC).select(COLUMNS)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return block_names.drop_copies(docs).select(COLUMNS)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id."""
    return covering_simhash.drop_near_copies(docs).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources share the mixture by the square root of their size, in shuffled order."""
    return mixing.mix(docs, power=0.5, seed=1).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and what they decode to."""
    ws = Workspace(spark, "encode")
    encoded = word_automaton.encode(ws, docs.select(COLUMNS), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_copies),
    ("SimHash near-dedup", remove_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL cannot express the learned filter, the fingerprints and the encoding; tests use plain re-computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
