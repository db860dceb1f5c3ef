"""Columns that stages use themselves, and labels that are neither 0 nor 1."""
from pyspark.sql import functions as F

from veritab.llm import ngram_join, quality_rank, suffix_dedup
from veritab.llm.shared import fresh

NAMES = ["quality_score", "quality_text", "suffix_key", "suffix_kept", "near_join_id", "near_join_text", "Key", "pieces", "salt", "gram"]


def clashing(df):
    for i, n in enumerate(NAMES):
        df = df.withColumn(n, F.concat(F.lit(f"{i}-"), F.col("doc_id").cast("string")))
    return df


def same(before, after, *changed):
    keep = [c for c in before.columns if c not in changed]
    assert after.columns == before.columns
    want = {tuple(r) for r in before.select(*keep).collect()}
    got = [tuple(r) for r in after.select(*keep).collect()]
    assert got and set(got) <= want
    return got


def test_fresh_names():
    assert fresh("a", ["b"]) == "a" and fresh("a", ["A", "a_"]) == "a__"


def test_stages_keep_clashing_columns(spark, sf):
    docs = clashing(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_rank.train(docs, labels)
    name = fresh("quality_score", docs.columns)
    scored = quality_rank.score_quality(docs, model, docs.columns, name)
    assert len(same(docs, scored.drop(name))) == docs.count()
    same(docs, ngram_join.keep_one(docs))
    assert len(same(docs, suffix_dedup.without_repeats(docs, passages=True), "text", "n_chars")) == docs.count()


def test_other_labels_teach_nothing(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = docs.select("doc_id").subtract(labels.select("doc_id")).limit(3).withColumn("quality", F.lit(2))
    a = quality_rank.train(docs, labels.select("doc_id", F.col("quality").cast("int")))
    b = quality_rank.train(docs, labels.select("doc_id", F.col("quality").cast("int")).union(odd))
    assert (a.weights == b.weights).all() and a.cut == b.cut
