"""From raw documents to token ids: language, quality, near copies, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its decisions take effect. All but the
last return the columns of ``documents``.

* language: learns from all texts with a language; a text goes if it has no letters, or if less than a quarter of its
  letters stand in spans of learned languages, whichever, that use the word's script. So it rejects letterless texts and
  texts mostly in scripts that no learned language uses, but no text in a learned script, whatever it says;
* quality: learns from ``labels`` of the documents that are left; a text below the score of 0.3 goes;
* near copies: five-word shingles, similarity 0.8 or more; of each group of texts the row of the smallest id stays, and
  one of its rows without id; an id with different texts is as many documents;
* mixing: sources weigh 1, 2, 3, repeating; rows are repeated where their source needs further epochs;
* encoding: byte-level BPE ids of every text, decoded again for their digest.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.llm import byte_pairs, language, mixing, near_documents, quality
from courtside.llm.sending import small_batches
from courtside.session import fresh_path, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_LANGUAGE = 0.25


def _stage(work: Stage) -> Stage:
    """A stage whose texts reach Python in batches of bounded size."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return work(spark, docs, sf_dir)

    return run


def _others(docs: DataFrame) -> DataFrame:
    """Id, text, and all other columns as one, so that none can clash with a stage's results."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("rest") if rest else F.lit(True).alias("rest"))


def _as_before(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


@_stage
def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs)
    rows = language.label(_others(docs), model, language.PENALTY, "text", "rest", shares=True)
    return _as_before(rows.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("learned") >= LEAST_LANGUAGE)), docs)


@_stage
def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(settle(quality.measured(docs), "stats"), labels)
    rows = quality.scored(quality.measured(_others(docs), "text", "rest"), model)
    return _as_before(rows.where(F.col("score") >= quality.LEAST), docs)


@_stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_documents.one_of_each(docs, k=5, percent=80)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokens = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_pairs.coded(docs, tokens, public_tokenizers.PATTERN)


STAGES = [
    ("language", by_language),
    ("quality", by_quality),
    ("near-copies", without_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]

# languages, quality, copies and token ids cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
