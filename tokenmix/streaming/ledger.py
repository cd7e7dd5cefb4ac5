"""Resumable scans: a Parquet ledger of finished plan regions.

A run works through the plan in order, a batch of regions at a time. Each batch is one Spark job (regions are its
partitions, at most ``in_flight`` of them at work at once) and one append to the ledger: rows
(work_index, source_bytes, cluster_id, tokens, docs), at most 20 a region and one with null cluster for its bytes. The append
is Spark's own commit; the progress document, to which the batch's sums are added, follows it. What counts after a crash is the dense prefix
of the ledger that progress names: batches beyond it are taken again, so each region counts once, and a ledger that does not add up to
its progress is refused. Ledger and documents lie in one folder on any file system (``functions.store``).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import report, settings
from ..functions.store import Store
from ..operators import aggregate
from ..operators.extract import extract
from ..plans import workplan
from ..sources import jsonl

LOG = logging.getLogger(__name__)
LEDGER = "work_index int, source_bytes long, cluster_id int, tokens long, docs long"
SUMS = {"cluster_source_tokens": "tokens", "cluster_document_counts": "docs"}


class BadRecord(ValueError):
    pass


class Interrupted(RuntimeError):
    pass


def empty_map() -> dict[str, int]:
    return {str(c): 0 for c in settings.ALL_CLUSTERS}


def advanced(plan: dict, progress: dict, done: int, totals: list[dict]) -> dict:
    """Progress after the items below done, of which the new ones have these totals per cluster."""
    sums = {k: dict(progress[k]) for k in SUMS}
    for row in totals:
        for k, column in SUMS.items():
            sums[k][str(row["cluster_id"])] += row[column]
    prefix = {"next_work_item_index": done, "completed_work_items": done, "source_bytes_covered": report.item_bytes(plan["work_items"][:done])}
    return progress | sums | prefix | {"record_count": sum(sums["cluster_document_counts"].values())}


def initial(plan: dict) -> dict:
    return advanced(plan, report.header(plan) | {k: empty_map() for k in SUMS} | {"complete": False}, 0, [])


def check_state(state, plan: dict) -> dict:
    """The state, or ValueError where it doesn't belong to the plan or contradicts itself."""
    report.demand(report.progress_claims(plan, state))
    return state


def append(store: Store, name: str, plan: dict, items: list[dict], in_flight: int | None = None, **source) -> list[dict]:
    """Scans items and appends their rows; their totals per cluster. BadRecord (and no append) if a record is rejected."""
    spark = store.spark
    scanned = jsonl.ranges(spark, plan, items, **source)
    records = extract(scanned.coalesce(in_flight) if in_flight else scanned)
    counted = records.groupBy("work_index", "cluster_id", F.col("reason").isNotNull().alias("bad")).agg(F.sum("token_count").alias("tokens"), F.count("*").alias("docs"))
    rows = counted.collect()  # at most 21 rows a region of the batch
    if any(r["bad"] for r in rows):
        # only now are rejected records looked for one by one: the first in plan order is the one reported
        f = aggregate.first_fault(records).collect()[0]
        raise BadRecord(f"invalid record at {f['file']}:{f['record_start']}: {f['reason']}")
    out = [(r["work_index"], None, r["cluster_id"], r["tokens"], r["docs"]) for r in rows]
    out += [(i["index"], i["range_end"] - i["range_start"], None, 0, 0) for i in items]
    spark.createDataFrame(out, LEDGER).coalesce(1).write.mode("overwrite").parquet(store.url(f"{name}/batch-{items[0]['index']:08d}"))
    return [r.asDict() for r in rows]


def read(store: Store, name: str, before: int) -> DataFrame:
    """The ledger rows of items below an index."""
    found = [store.url(f"{name}/{n}") for n in store.children(name) if n.startswith("batch-")]
    if not found:
        return store.spark.createDataFrame([], LEDGER)
    return store.spark.read.schema(LEDGER).parquet(*found).where(F.col("work_index") < before)


def fold(rows: DataFrame) -> DataFrame:
    """Dense totals of ledger rows."""
    return aggregate.dense(aggregate.merged(rows.where("cluster_id is not null")))


def progress_by_item(rows: DataFrame) -> DataFrame:
    """Running tokens, docs and bytes in plan order (one row per region)."""
    per = rows.groupBy("work_index").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"), F.sum("source_bytes").alias("bytes"))
    w = Window.orderBy("work_index").rowsBetween(Window.unboundedPreceding, 0)
    return per.select("work_index", *(F.sum(c).over(w).alias(f"running_{c}") for c in ("tokens", "docs", "bytes")))


def _begun(store: Store, plan: dict, names: settings.Names) -> dict:
    """Progress of a run that starts in a folder without one."""
    if found := [n for n in (names.progress, names.report, names.weights) if store.exists(n)]:
        raise FileExistsError(f"{store.url(found[0])} exists; resume or take another")
    store.drop(names.ledger)
    progress = initial(plan)
    store.put(names.progress, progress)
    return progress


def _resumed(store: Store, plan: dict, names: settings.Names) -> dict:
    """Progress of a run that goes on: the ledger's prefix adds up to it, and what lies beyond is dropped."""
    progress = check_state(store.json(names.progress), plan)
    if progress["complete"] is not True:
        done = progress["next_work_item_index"]
        for n in store.children(names.ledger):
            if n.startswith("batch-") and int(n.rpartition("-")[2]) >= done:
                store.drop(f"{names.ledger}/{n}")
        rows = read(store, names.ledger, done)
        covered = rows.agg(F.countDistinct("work_index").alias("n")).collect()[0]["n"]
        totals = [r.asDict() for r in fold(rows).collect()]
        if covered != done or any(progress[k] != {str(r["cluster_id"]): r[c] for r in totals} for k, c in SUMS.items()):
            raise ValueError("the ledger does not add up to the progress")
    return progress


def scan(spark: SparkSession, run_dir: str, plan: dict, *, resume: bool = False, batch_items: int = 1024, in_flight: int | None = None, stop_after: int | None = None, names: settings.Names = settings.Names(), **source) -> dict:
    """Runs (or goes on with) a scan in run_dir and returns its report. source: folder=, url= or reader= of the files (``jsonl.ranges``).

    in_flight bounds the regions that are read at once. stop_after interrupts the run when so many items are done (a test of
    resuming). A finished run returns its verified report and writes nothing.
    """
    if min(x for x in (batch_items, in_flight, stop_after, 1) if x is not None) <= 0:
        raise ValueError("batch_items, in_flight and stop_after must be positive")
    store = Store(spark, run_dir)
    progress = (_resumed if resume else _begun)(store, plan, names)
    if progress["complete"] is True:
        report.demand(report.run_claims(store, plan, names))
        return store.json(names.report)
    edges = {*range(progress["next_work_item_index"], len(plan["work_items"]), batch_items), len(plan["work_items"]), *([stop_after] if stop_after else [])}
    steps = sorted(e for e in edges if progress["next_work_item_index"] <= e <= len(plan["work_items"]))
    for begin, end in zip(steps, steps[1:]):
        progress = advanced(plan, progress, end, append(store, names.ledger, plan, plan["work_items"][begin:end], in_flight, **source))
        store.put(names.progress, progress)
        LOG.info("%d of %d regions, %d records, %d bytes", end, len(plan["work_items"]), progress["record_count"], progress["source_bytes_covered"])
        if end == stop_after:
            raise Interrupted(f"stopped after {end} items as asked")
    return report.finish(store, plan, progress, names)


def stream(spark: SparkSession, batches: str, run_dir: str, checkpoint: str, plan: dict, files_per_trigger: int = 1, **source):
    """The same loop as a streaming query: files of plan items that arrive in batches are scanned and appended (available now, then it ends).

    A repeated micro-batch overwrites its own append, so each region counts once.
    """
    arriving = spark.readStream.schema(workplan.ITEMS).option("maxFilesPerTrigger", files_per_trigger).parquet(batches)

    def take(frame: DataFrame, _: int) -> None:
        items = sorted((r.asDict() for r in frame.collect()), key=lambda i: i["index"])  # plan rows, not records
        if items:
            append(Store(frame.sparkSession, run_dir), settings.Names.ledger, plan, items, **source)

    return arriving.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
