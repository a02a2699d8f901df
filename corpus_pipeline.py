"""From raw documents to packed training sequences, stage by stage.

Each stage takes all that its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.llm import cotraining, decontaminate, packing, similar_texts, suffix_dedup
from keepsake.llm.catalog import word_tokenizer
from keepsake.llm.common import read
from keepsake.sources.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = cotraining.train(docs, read(spark, sf_dir, "labels"))
    scored = cotraining.score(docs, model, score_as="__score", keep_as="__kept")
    return scored.where(F.col("__kept")).select([F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: five-word shingles alike to 0.8."""
    return similar_texts.deduplicated(docs, size=5, similarity=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 that occur again anywhere are cut from the texts."""
    return suffix_dedup.deduplicated(docs, length=200)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten benchmark words go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"), window=10)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences of at most 2048."""
    return packing.pack(docs, word_tokenizer(), max_len=2048, end_id=0)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("best-fit packing", packed),
]

# Training, fingerprints and tokens are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for n, (_, apply) in enumerate(STAGES):
        docs = apply(spark, docs if n == 0 else stage(docs, "kept"), sf_dir)
    return docs
