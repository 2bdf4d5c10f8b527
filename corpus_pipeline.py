"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. toxicity: documents that score THRESHOLD or more go;
2. exact dedup: of equal texts the one with the largest id stays;
3. n-gram Jaccard join: of each group of near copies (five words, 0.8) one
   with the smallest id stays;
4. mixing: sources are brought to their target weights, a document is
   repeated for each pass that takes words of it, in the order of training;
   one without words (null, empty or blank text) stays once;
5. byte-level BPE: encode, decode, and return counts and digests per document.

No stage can be given as SQL as a whole (a trained score decides the first),
so ORACLE_SQL is None and the tests compare with a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import bpe, dedup, jaccard, mixing, toxicity
from salesmart.llm.common import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_passes(mixing.mix(docs, mixing.word_count(docs["text"])), docs.columns,
                                wordless=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = bpe.encode(docs.select("doc_id", "text"), path, pattern).select("doc_id", "ids")
    return bpe.digests(bpe.decode(coded, path, pattern))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("byte_bpe", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
