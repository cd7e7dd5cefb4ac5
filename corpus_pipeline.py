"""The corpus pipeline: documents through language ID, near and exact deduplication, decontamination and tokenisation.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; all but the last return the
columns of docs, whatever other columns there are and however they are named. An empty table gives an empty one. ``run`` writes each stage's result as Parquet into the shared folder and reads it again. It belongs to
``tokenmix.llm`` and imports it plainly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmix.llm import bpe, decontaminate, langid, pieces, repeats, simhash
from tokenmix.llm.common import rested, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of undeterminable language (null, empty or without a letter); lang becomes the predicted one.

    Ties of languages go to the first in code-point order; repeated rows stay; very long texts are scored word by word, whole; where no document has
    a language to learn from, lang is left as it is and only the letterless go.
    """
    rested(spark)
    model = langid.train(docs)
    if not model.langs:  # nothing to learn from: only what has no letter at all goes
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    aside = {c: f"_kept_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = langid.identify(docs.withColumnsRenamed(aside), model).where(F.col("lang_pred") != pieces.UND).withColumn("lang", F.col("lang_pred"))
    return found.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates (five-word shingles, Jaccard similarity of 0.8 or more) the document with the smallest id stays.

    A null id comes after all others; of equal ids (and repeated rows) one row stays, that of the smallest text digest, and rows of one id with texts of different
    classes stay each for its own. Null, empty and wordless texts are one class; fewer than five words are one shingle; very long texts are compared as whole sets.
    """
    rested(spark)
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated passages of 100 bytes or more (whole characters of them), and documents of which nothing is left.

    The first place in the order of doc_id keeps its passage; a null id comes first; equal ids by the XXH64 of their texts, repeated rows whichever comes first. n_chars follows
    a text that changes. Null and empty texts stay; very long texts are cut like others.
    """
    rested(spark)
    return repeats.cut_texts(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with an occurrence of a benchmark window (ten words, or all of a shorter item), wherever it is in a text of any length.

    Null, empty and wordless texts stay; rows with one id are judged each by its own text; repeated rows go or stay together; an empty benchmark drops nothing.
    """
    rested(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, a row for every row; null texts are empty ones, a text of any length is encoded whole."""
    rested(spark)
    return bpe.encode_decode(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe_encode_decode", bpe_encode_decode),
]

#: Language identification and tokenisation have no SQL form; tests compare the stages with brute force and the library, and run() with the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
