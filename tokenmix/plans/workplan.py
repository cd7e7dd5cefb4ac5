"""The deterministic scan plan: byte regions of the source files in an order given by hashes.

Plans exist as DataFrames (``regions``, ``plan_items``, and one frame of verdicts per check) and as a small JSON
document at the driver (``make``, ``save``, ``load``), which holds one row per region and file.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import settings
from ..functions import canonical, columns

FILES = "path string, size long"
ITEMS = "index int, filename string, range_start long, range_end long, work_item_id string"


def regions(files: DataFrame, region_bytes: int) -> DataFrame:
    """filename, range_start, range_end: half-open regions that cover every file; empty files have none."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(region_bytes).cast("long")))
    cut = files.where("size > 0").select(F.col("path").alias("filename"), "size", starts.alias("range_start"))
    return cut.select("filename", "range_start", F.least(F.col("range_start") + region_bytes, F.col("size")).alias("range_end"))


def plan_items(files: DataFrame, revision: str, seed: str, region_bytes: int) -> DataFrame:
    """``ITEMS`` in hash order: index counts from 0 (the window is over one row per region, not over records)."""
    each = regions(files, region_bytes)
    named = each.withColumn("work_item_id", columns.identity(revision, F.col("filename"), F.col("range_start"), F.col("range_end")))
    order = Window.orderBy(columns.order_hash(seed, F.col("work_item_id")), "work_item_id")
    return named.withColumn("index", F.row_number().over(order) - 1).select("index", "filename", "range_start", "range_end", "work_item_id")


# --- checks: a verdict for every row ---


def range_verdicts(items: DataFrame, files: DataFrame) -> DataFrame:
    """in_range: 0 <= start < end <= file size."""
    joined = items.join(files, items.filename == files.path, "left")
    return joined.withColumn("in_range", F.coalesce((F.col("range_start") >= 0) & (F.col("range_start") < F.col("range_end")) & (F.col("range_end") <= F.col("size")), F.lit(False))).drop("path", "size")


def identity_verdicts(items: DataFrame, revision: str) -> DataFrame:
    return items.withColumn("identity_ok", F.col("work_item_id") == columns.identity(revision, F.col("filename"), F.col("range_start"), F.col("range_end")))


def index_verdicts(items: DataFrame) -> DataFrame:
    """index_ok: indices are 0, 1, ... without gap or repeat."""
    return items.withColumn("index_ok", F.row_number().over(Window.orderBy("index", "work_item_id")) - 1 == F.col("index"))


def coverage_verdicts(items: DataFrame, files: DataFrame) -> DataFrame:
    """Per file: items, first_start, last_end and covered (no gap or overlap, from 0 to the size)."""
    w = Window.partitionBy("filename").orderBy("range_start", "range_end")
    steps = items.select("filename", "range_start", "range_end", (F.col("range_start") == F.coalesce(F.lag("range_end").over(w), F.lit(0))).alias("joined"))
    per = steps.groupBy("filename").agg(F.count("*").alias("items"), F.min("range_start").alias("first_start"), F.max("range_end").alias("last_end"), F.min("joined").alias("joined"))
    both = files.join(per, files.path == per.filename, "left")
    ok = F.coalesce(F.col("joined") & (F.col("first_start") == 0) & (F.col("last_end") == F.col("size")), F.lit(False))
    return both.select("path", F.coalesce("items", F.lit(0)).alias("items"), "first_start", "last_end", ok.alias("covered"))


def with_source(items: DataFrame, files: DataFrame) -> DataFrame:
    """Each item with its file's size."""
    return items.join(files, items.filename == files.path).drop("path")


def unknown_files(items: DataFrame, files: DataFrame) -> DataFrame:
    """Items whose file isn't in the list."""
    return items.join(files, items.filename == files.path, "left_anti")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def size_drift(planned: DataFrame, actual: DataFrame) -> DataFrame:
    """path, planned_size, actual_size and drifted of all files of either side."""
    p, a = planned.select("path", F.col("size").alias("planned_size")), actual.select("path", F.col("size").alias("actual_size"))
    return p.join(a, "path", "full_outer").withColumn("drifted", ~F.col("planned_size").eqNullSafe(F.col("actual_size")))


def list_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with position) that only one of two ordered file lists has; side is left or right."""
    w = Window.orderBy("path", "size")
    a, b = (x.select("path", "size", F.row_number().over(w).alias("position")) for x in (left, right))
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def remaining(items: DataFrame, done: Column | int) -> DataFrame:
    """Items from the next index on, in order."""
    return items.where(F.col("index") >= done)


def prefix_bytes(items: DataFrame) -> DataFrame:
    """covered_bytes: bytes of all items up to each one."""
    w = Window.orderBy("index").rowsBetween(Window.unboundedPreceding, 0)
    return items.withColumn("covered_bytes", F.sum(F.col("range_end") - F.col("range_start")).over(w))


# --- the JSON document ---


def make(spark: SparkSession, files: list[tuple[str, int]], corpus: settings.Corpus) -> dict:
    """The plan document of files (path, size)."""
    if corpus.region_bytes <= 0:
        raise ValueError("region_bytes must be positive")
    if not files:
        raise ValueError("a plan needs source files")
    if any(isinstance(n, bool) or not isinstance(n, int) or n <= 0 for _, n in files):
        raise ValueError("source sizes must be positive integers")
    if len({p for p, _ in files}) != len(files):
        raise ValueError("duplicate source paths")
    files = sorted(files)
    frame = spark.createDataFrame(files, FILES)
    rows = plan_items(frame, corpus.revision, corpus.seed, corpus.region_bytes).orderBy("index").collect()
    plan = {
        "schema_version": settings.PLAN_VERSION, "dataset": corpus.dataset, "revision": corpus.revision, "source_glob": corpus.glob, "selection_seed": corpus.seed,
        "region_bytes": corpus.region_bytes, "source_files": [{"path": p, "size": n} for p, n in files], "work_items": [r.asDict() for r in rows],
    }
    return plan | {"hash": canonical.self_hash(plan, "hash")}


def save(path: str, plan: dict) -> None:
    canonical.write_json(path, plan)


def items_frame(spark: SparkSession, plan: dict) -> DataFrame:
    names = [f.split()[0] for f in ITEMS.split(", ")]
    return spark.createDataFrame([tuple(i[n] for n in names) for i in plan["work_items"]], ITEMS)


def files_frame(spark: SparkSession, plan: dict) -> DataFrame:
    return spark.createDataFrame([(f["path"], f["size"]) for f in plan["source_files"]], FILES)


def load(spark: SparkSession, path: str) -> dict:
    """The saved plan; ValueError unless its version, hash and contents hold."""
    return checked(spark, canonical.read_json(path))


def checked(spark: SparkSession, plan) -> dict:
    if not isinstance(plan, dict) or plan.get("schema_version") != settings.PLAN_VERSION:
        raise ValueError("unsupported work plan version")
    if plan.get("hash") != canonical.self_hash(plan, "hash"):
        raise ValueError("work plan hash mismatch")
    check(spark, plan)
    return plan


def check(spark: SparkSession, plan: dict) -> None:
    if not plan["source_files"] or not plan["work_items"]:
        raise ValueError("the work plan is empty")
    files, items = files_frame(spark, plan), items_frame(spark, plan)
    faults = (
        ("duplicate source paths", duplicates(files, "path")),
        ("work item indices are not dense", index_verdicts(items).where("not index_ok")),
        ("work items name unknown files", unknown_files(items, files)),
        ("work item identity mismatch", identity_verdicts(items, plan["revision"]).where("not identity_ok")),
        ("duplicate work items", duplicates(items, "work_item_id")),
        ("work item range outside its file", range_verdicts(items, files).where("not in_range")),
        ("work items leave gaps or overlap", coverage_verdicts(items, files).where("not covered")),
    )
    if [i["index"] for i in plan["work_items"]] != list(range(len(plan["work_items"]))):
        raise ValueError("work item indices are not dense")
    for what, found in faults:
        if some := found.limit(3).collect():
            raise ValueError(f"{what}: {[r.asDict() for r in some]}")


def plan_hash(plan: dict) -> str:
    return hashlib.sha256(canonical.canonical(plan, ("hash",))).hexdigest()
