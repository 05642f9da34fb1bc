"""The corpus pipeline: language, repeated lines, near duplicates, mixing of sources, token ids.

Each stage takes the documents that its predecessor kept and returns documents with the same columns; the last
one returns token ids. ``run`` writes every stage to the shared folder before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.llm.bpe import token_digests
from bandstand.llm.language import UNKNOWN, predict_languages, train_language_model
from bandstand.llm.line_dedup import drop_frequent_lines
from bandstand.llm.mixing import mixed
from bandstand.llm.near_text import near_text_components
from bandstand.runtime import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without letters go, also where no row names a language."""
    model = train_language_model(docs, "doc_id", "text", "lang")
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict_languages(docs, "doc_id", "text", model, with_row=True)
    return found.where(F.col("lang_pred") != UNKNOWN).select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more share; a document that had no others is empty."""
    cleaned = drop_frequent_lines(docs, "doc_id", "text")
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cleaned.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id; one row of an id that repeats."""
    scratch = Scratch(spark, "near-duplicates")
    found = scratch.write(near_text_components(docs, "doc_id", "text").select("doc_id", "kept"))
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    return left.where("doc_id is not null").dropDuplicates(["doc_id"]).union(left.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixed(docs, "doc_id", "text", "source")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(docs, "doc_id", "text", ranks)


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]
# Fitted classifiers, hashed draws and token ids cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
