"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept. All stages but the last return the columns of ``documents``;
the last returns the pieces of the packed documents. :func:`run` writes every
stage's result as Parquet in the shared folder and rereads it, so a stage's
lineage ends with it and a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.llm import exact_dedup, language_id, mixing, packing, simhash_dedup
from ferryline.llm.common import free_name, quoted
from ferryline.workspace import fresh_dir

#: A document with fewer of its letters explained by the languages is rejected,
MIN_FIT = 0.5
#: unless its language is known by less than this (estimated) share of its text.
MIN_COVERED = 0.95
#: Seed of the mixture.
MIX_SEED = 20
#: Tokens in a training sequence.
SEQUENCE_TOKENS = 2048


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: NULL text or no letter, or letters
    that the languages learned from ``docs`` don't explain. Where too little
    was learned to tell (few labels or none), a document with letters stays."""
    out = free_name(docs, "language")
    found = language_id.with_language(docs, language_id.learn(docs), out=out)
    told = quoted(out)
    thin = told["covered"] < MIN_COVERED
    has_letters = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    return found.where(has_letters & (thin | (told["fit"] >= MIN_FIT))).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest identifier stays."""
    out = free_name(docs, "dedup")
    found = exact_dedup.exact_dedup(docs, keep="largest", out=out)
    return found.where(quoted(out)["kept"]).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash_dedup.one_of_each(docs, shingle=3, radius=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source weighs the same in a mixture of as many documents."""
    return mixing.mix_sources(docs, seed=MIX_SEED).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a document that was repeated is packed as often."""
    return packing.pack_documents(docs, capacity=SEQUENCE_TOKENS)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: Hashes, trained models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = fresh_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
