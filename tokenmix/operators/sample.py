"""Deterministic audit samples: k records per file by hash, checked in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .validate import validated

SEED = "tokenmix-audit-v1"


def by_hash(rows: DataFrame, group: str, key: str, k: int, seed: str = SEED) -> DataFrame:
    """The k rows of each group with the smallest SHA-256 of seed and key, with their rank.

    Spark cuts each task's rows to k per group before the shuffle (window group limit), so a hot group moves k rows a task.
    """
    order = F.sha2(F.concat_ws(":", F.lit(seed), F.col(group), F.col(key).cast("string")), 256)
    hashed = rows.withColumn("_h", order)
    ranked = hashed.withColumn("sample_rank", F.row_number().over(Window.partitionBy(group).orderBy("_h", key)))
    return ranked.where(F.col("sample_rank") <= k).drop("_h")


def audit(records: DataFrame, k: int = 10, seed: str = SEED) -> DataFrame:
    """file, record_start, valid and rejection_reason of the sampled records of each file."""
    some = by_hash(records.select("file", "record_start", "value"), "file", "record_start", k, seed)
    v = some.withColumn("v", validated(F.col("value")))
    return v.select("file", "record_start", "sample_rank", "v.valid", "v.cluster_id", "v.rejection_reason")
