"""Corpus pipeline over ``documents``: every stage reads what the one before kept.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

1. quality: documents that the ranking classifier predicts as bad go; where the labels teach no
   model (none, of one class, or other values than 0 and 1) all documents stay.
2. near_duplicates: of each group of linked documents the one with the smallest doc_id stays
   (of repeated rows one); documents without words link with nothing and stay.
3. repeats: every character covered by a passage of more than 50 words, or by a 400-byte string,
   that occurs elsewhere goes; the document stays, with its new n_chars.
4. decontamination: documents that contain a benchmark item go.
5. packing: sequences of at most 4096 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm import decontaminate, ngram_join, packing, quality_rank, suffix_dedup
from veritab.llm.shared import Scratch, fresh, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rank.train(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    score = fresh("quality_score", docs.columns)
    scored = quality_rank.score_quality(docs, model, docs.columns, score)
    return scored.where(F.col(score) >= quality_rank.THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, passages=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("decontamination", decontamination), ("packing", pack)]

#: The classifier, the tokenizer and the packing rule have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
