"""The corpus pipeline: each stage takes the documents that the one before kept, written and reread.

STAGES lists (name, function); a function takes (spark, docs, sf_dir). All but the last return the
columns of `documents`; the last returns each document's tokens. Null ids and texts are rows like any
others: a null text is empty, a row with a null id is its own document. Repeated rows are each judged,
and near-duplicate removal keeps or drops rows of one id together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import byte_bpe, decontamination, line_dedup, near_dedup, toxicity
from shelfline.llm.common import documents
from shelfline.session import freeze


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model learns from the labelled ones among those given."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model, keep=docs.columns).where("predicted = 0").select(docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; n_chars follows the text."""
    kept = line_dedup.line_dedup(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group with similarity 0.8 or more, in sets of five words, the document of least id stays."""
    gone = near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover one word in twenty or more go."""
    judged = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where("not contaminated").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids as little-endian unsigned 32-bit integers, and whether they decode to its text."""
    coded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                            keep=["doc_id", "text", "lang", "source"])
    whole = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        whole.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]
ORACLE_SQL = None   # the toxicity score and the merges of the vocabulary are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
