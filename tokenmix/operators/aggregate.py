"""Cluster totals and what is derived from them. Inputs have cluster_id and token_count; ``totals`` frames have
cluster_id, tokens and docs.

All sums are partial before the shuffle, so what moves is at most a row per cluster (and region) from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import settings


def _sums() -> list[Column]:
    return [F.sum("token_count").alias("tokens"), F.count("*").alias("docs")]


def region_partials(records: DataFrame, region: str = "work_index") -> DataFrame:
    return records.groupBy(region, "cluster_id").agg(*_sums())


def merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("cluster_id").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))


def totals(records: DataFrame) -> DataFrame:
    return records.groupBy("cluster_id").agg(*_sums())


def dense(found: DataFrame) -> DataFrame:
    """A row for every cluster, zeros where nothing was found."""
    spark: SparkSession = found.sparkSession
    every = spark.range(min(settings.ALL_CLUSTERS), max(settings.ALL_CLUSTERS) + 1).select(F.col("id").cast("int").alias("cluster_id"))
    zero = F.lit(0).cast("long")
    return every.join(found, "cluster_id", "left").select("cluster_id", F.coalesce("tokens", zero).alias("tokens"), F.coalesce("docs", zero).alias("docs"))


def is_accepted() -> Column:
    return F.col("cluster_id").isin(*settings.ACCEPTED_CLUSTERS)


def in_domain() -> Column:
    return F.col("cluster_id").between(min(settings.ALL_CLUSTERS), max(settings.ALL_CLUSTERS))


def grand(found: DataFrame) -> DataFrame:
    """all_tokens, accepted_tokens, excluded_tokens and records."""
    zero = F.lit(0).cast("long")
    return found.agg(
        F.coalesce(F.sum("tokens"), zero).alias("all_tokens"), F.coalesce(F.sum(F.when(is_accepted(), F.col("tokens"))), zero).alias("accepted_tokens"),
        F.coalesce(F.sum(F.when(~is_accepted(), F.col("tokens"))), zero).alias("excluded_tokens"), F.coalesce(F.sum("docs"), zero).alias("records"),
    )


def missing(found: DataFrame) -> DataFrame:
    """Clusters without tokens."""
    return dense(found).where("tokens <= 0").select("cluster_id")


def positivity(found: DataFrame) -> DataFrame:
    return dense(found).agg(F.min("tokens").alias("least_tokens"), F.min("docs").alias("least_docs"), (F.min(F.least("tokens", "docs")) > 0).alias("all_positive"))


def weights(found: DataFrame) -> DataFrame:
    """cluster (as string) and weight of the accepted clusters."""
    return dense(found).where(is_accepted()).select(F.col("cluster_id").cast("string").alias("cluster"), F.col("tokens").alias("weight"))


def weights_json(found: DataFrame) -> DataFrame:
    """One row: the weights as JSON, keys in string order."""
    pairs = F.array_sort(F.collect_list(F.struct("cluster", "weight")))  # at most a row per cluster
    return weights(found).agg(F.to_json(F.map_from_entries(pairs)).alias("weights"))


def weights_verdicts(found: DataFrame, published: DataFrame) -> DataFrame:
    """cluster, expected, published and matches of both sides."""
    e = weights(found).withColumnRenamed("weight", "expected")
    p = published.select("cluster", F.col("weight").alias("published"))
    return e.join(p, "cluster", "full_outer").withColumn("matches", F.col("expected").eqNullSafe(F.col("published")))


def token_shares(found: DataFrame) -> DataFrame:
    """Percent of all tokens, and of the accepted ones (null for excluded clusters), to six places."""
    every = Window.partitionBy()  # over at most a row per cluster
    d = dense(found)
    all_share = F.round(100.0 * F.col("tokens") / F.sum("tokens").over(every), 6)
    own = F.round(100.0 * F.col("tokens") / F.sum(F.when(is_accepted(), F.col("tokens"))).over(every), 6)
    return d.select("cluster_id", "tokens", all_share.alias("percent_all"), F.when(is_accepted(), own).alias("percent_accepted"))


def document_shares(found: DataFrame) -> DataFrame:
    return dense(found).select("cluster_id", "docs", F.round(100.0 * F.col("docs") / F.sum("docs").over(Window.partitionBy()), 6).alias("percent_docs"))


def crosscheck(found: DataFrame, external: DataFrame) -> DataFrame:
    """docs of both sides per cluster and whether they agree; external: cluster_id, docs."""
    e = external.select("cluster_id", F.col("docs").alias("external_docs"))
    return dense(found).select("cluster_id", "docs").join(e, "cluster_id", "full_outer").withColumn("agrees", F.col("docs").eqNullSafe(F.col("external_docs")))


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """cluster_ids that only one side has."""
    a, b = left.select("cluster_id").distinct(), right.select("cluster_id").distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def first_fault(extracted: DataFrame) -> DataFrame:
    """The rejected record of the lowest plan index, then offset: work_index, file, record_start, reason."""
    bad = extracted.where(F.col("reason").isNotNull())
    return bad.agg(F.min_by(F.struct("work_index", "file", "record_start", "reason"), F.struct("work_index", "record_start")).alias("f")).where("f is not null").select("f.*")
