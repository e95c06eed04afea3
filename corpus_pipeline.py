"""Documents to training tokens: toxic ones out, near copies out, repeated passages cut, sources mixed, encoded.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that the one before kept, written as
Parquet and read again.  All but the last return the columns of ``documents``.  Nulls, empty and long texts,
repeated rows, empty tables and further columns are handled as the operators' modules state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.llm import bpe, minhash, mixing, repeats, toxicity
from paylode.llm.common import ready, table
from paylode.session import settled, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "byte_bpe_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents predicted toxic go; learnt from the documents of the stage that have a usable label."""
    ready(spark)
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near copies (similarity 0.8 and more) the smallest id stays."""
    ready(spark)
    return minhash.keep_one(docs, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: runs of over 50 words that start elsewhere too are cut out of the texts; all documents stay."""
    ready(spark)
    return repeats.without_passages(docs, words=51)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the mix takes it."""
    ready(spark)
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: ``doc_id, source, n_tokens, ids`` and whether the ids decode to the text."""
    ready(spark)
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("source", "text")), path)
    return coded.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("byte_level_bpe", tokenize),
]

#: Learnt scores and drawn copies are not SQL; tests hold run() against a version by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mixed() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir), name)
        return docs

    return STAGES[-1][1](spark, settled(spark, "mixed-documents", mixed), sf_dir)
