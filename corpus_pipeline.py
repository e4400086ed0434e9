"""From raw documents to token ids: toxicity, exact copies, near copies, source mix, byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as
Parquet below ``spark.checkpoint.dir`` and reads it again as the next stage's ``docs``.  All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import byte_bpe, exact_dedup, jaccard_join, mixing, toxicity
from strata.llm.common import staged
from strata.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_levels

#: nine tenths of the tokens that are left, no document more than once
MIX_FRACTION, MIX_EPOCHS = (9, 10), 1

#: the encoder's tables in a worker (its whole memory is about 220 MB): here it shares an executor with
#: what earlier stages left
WORKER_STEPS, WORKER_PIECES = 100_000, 40_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more, the one with the least id."""
    return jaccard_join.drop_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token budget dealt out over domains, languages and sources."""
    return mixing.mixed(docs, mix_levels(), MIX_WEIGHTS, fraction=MIX_FRACTION, max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digests of the ids and of the text decoded from them."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                               with_ids=True, max_steps=WORKER_STEPS, max_pieces=WORKER_PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_similar),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode),
]

#: learnt scores, shingle links and merges are beyond SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
