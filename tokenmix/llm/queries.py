"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from . import bpe, decontaminate, langid, licences, media, quality, repeats, simhash, tokenfile, warc
from .common import held_out, table


def op1_warc(spark, sf_dir):
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op2_webp(spark, sf_dir):
    return media.roundtrip(table(spark, sf_dir, "documents"))


def op3_simhash(spark, sf_dir):
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op4_decontaminate(spark, sf_dir):
    return decontaminate.measures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op5_token_files(spark, sf_dir):
    return tokenfile.roundtrip(table(spark, sf_dir, "documents"))


def op6_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op7_repeats(spark, sf_dir):
    return repeats.measures(table(spark, sf_dir, "documents"))


def op8_bpe_encode_decode(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def queries():
    return {"op1_warc": op1_warc, "op2_webp": op2_webp, "op3_simhash": op3_simhash, "op4_decontaminate": op4_decontaminate, "op5_token_files": op5_token_files, "op6_licences": op6_licences, "op7_repeats": op7_repeats, "op8_bpe_encode_decode": op8_bpe_encode_decode, "op9_quality": op9_quality, "op10_language_id": op10_language_id, "pipeline": corpus_pipeline.run}


def oracle_sql():
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return sql | {"op1_warc": warc.ORACLE, "op4_decontaminate": decontaminate.ORACLE, "op6_licences": licences.ORACLE}
