"""From raw documents to token ids in five stages; each is written as Parquet and read again as the next one's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farebox.llm import bpe, decontaminate, secrets, simhash, toxicity
from farebox.llm.tasks import stored
from farebox.session import pin_settings


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of this input, doesn't reject; same columns.

    NULL and empty texts are scored like texts without words, repeated rows stay or go together, long texts are read whole.
    Without a labelled row nothing is rejected; an empty input stays empty. Other columns may have any name and type.
    """
    return toxicity.drop_toxic(docs, pin_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by SimHash (three-word shingles, at most three differing bits), that of
    the smallest id; same columns.

    NULL and empty texts are one group. Of rows that repeat the chosen id and text one stays; an id of NULL is chosen only
    where a group has no other. An empty input stays empty. Other columns may have any name and type.
    """
    pin_settings(spark)
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten benchmark words occurs; same columns.

    NULL and empty texts stay, repeated rows stay or go together, rows of one id are judged each by its own text, however
    long. An empty input or benchmark is no special case. Other columns may have any name and type.
    """
    return decontaminate.remove_contaminated(docs, pin_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and ``n_chars`` of changed texts counted anew; same columns.

    NULL stays NULL, texts without secrets stay as they are, repeated rows change alike, long texts are searched whole. An
    empty input stays empty. Other columns may have any name and type.
    """
    pin_settings(spark)
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``token_ids`` and the digests of ids and decoded bytes, a row per row.

    NULL and empty texts have no tokens; repeated rows give repeated rows, an empty input none; long texts are encoded
    whole. Other columns are not looked at.
    """
    pin_settings(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_texts(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", blank_secrets),
    ("encoding", encode),
]

# Fingerprints, classifier and tokens have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = pin_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
