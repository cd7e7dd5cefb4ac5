"""JSONL sources: Spark's text scan (splits without loss, offsets by window) and a byte-range data source.

``scan`` is the fast path for totals: Spark splits the files, every line belongs to one split. ``jsonl_ranges``
(a Python data source) reads exactly the regions of a plan, with the absolute offset of each record, from a folder or over HTTP ranges,
and keeps every byte (a byte-order mark, invalid UTF-8).
"""

from __future__ import annotations

import base64
import json
import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import columns
from ..shipping import ship
from .ranges import FsRange, HttpRange, LocalRange, RangeReader, owned_records

SCHEMA = "work_index int, file string, record_start long, value binary"


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, size of the folder's own files that match, from metadata only."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.col("length").alias("size"))


def scan(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """file, value: every line without its newline and one carriage return."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
    return lines.select(F.col("_metadata.file_name").alias("file"), columns.without_cr(F.col("value")).alias("value"))


def with_offsets(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """file, record_start, value. For audits and fault reports: totals need no offsets."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
    placed = lines.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    return offsets(placed, "file", "block", "n").select("file", "record_start", columns.without_cr(F.col("value")).alias("value"))


def offsets(lines: DataFrame, file: str, block: str, order: str, size: Column | None = None) -> DataFrame:
    """lines with record_start: bytes (with newlines) of the file's lines before each.

    A file's blocks follow each other, and order counts within a block. Only a block's lines are ever in one task; blocks are
    placed by the sums of those before them, one row per block. size: bytes of a line without its newline (else of ``value``).
    """
    n = (F.octet_length("value") if size is None else size).cast("long") + 1
    zero = F.lit(0).cast("long")
    sums = lines.groupBy(file, block).agg(F.sum(n).alias("_bytes"))
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    based = sums.select(file, block, F.coalesce(F.sum("_bytes").over(before), zero).alias("_base"))
    inside = Window.partitionBy(file, block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("_inside", F.coalesce(F.sum(n).over(inside), zero)).join(based, [file, block]).withColumn("record_start", F.col("_base") + F.col("_inside")).drop("_base", "_inside")


class Region(InputPartition):
    def __init__(self, item: dict, size: int):
        self.item, self.size = item, size


class RangeSource(DataSource):
    """format("jsonl_ranges") with options plan (JSON of source_files and work_items) and folder (path or URL), url (HTTP, with {path}) or
    reader (base64 of a pickled function of path and size that gives a ``RangeReader``)."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return RangeScan(self.options)


class RangeScan(DataSourceReader):
    def __init__(self, options):
        plan = json.loads(options["plan"])
        self.sizes = {f["path"]: f["size"] for f in plan["source_files"]}
        self.items, self.folder, self.url, self.made = plan["work_items"], options.get("folder"), options.get("url"), options.get("reader")
        for i in self.items:
            if i["filename"] not in self.sizes:
                raise ValueError(f"work item {i['index']} names the unknown file {i['filename']}")

    def partitions(self):
        return [Region(i, self.sizes[i["filename"]]) for i in self.items]

    def reader(self, path: str, size: int) -> RangeReader:
        if self.made:
            return pickle.loads(base64.b64decode(self.made))(path, size)
        if self.folder:
            return FsRange(f"{self.folder}/{path}") if "://" in self.folder else LocalRange(f"{self.folder}/{path}")
        return HttpRange(self.url.format(path=path), size)

    def read(self, partition: Region):
        i = partition.item
        reader = self.reader(i["filename"], partition.size)
        if reader.file_size() != partition.size:
            raise RuntimeError(f"source size of {i['filename']} changed: planned {partition.size}, found {reader.file_size()}")
        for start, raw in owned_records(reader, i["range_start"], i["range_end"]):
            yield i["index"], i["filename"], start, raw


def ranges(spark: SparkSession, plan: dict, items: list[dict] | None = None, folder: str | None = None, url: str | None = None, reader: Callable[[str, int], RangeReader] | None = None) -> DataFrame:
    """``SCHEMA`` of the plan's items (or of some of them), from a folder, over HTTP, or by a reader of one's own."""
    ship(spark)
    spark.dataSource.register(RangeSource)
    payload = json.dumps({"source_files": plan["source_files"], "work_items": plan["work_items"] if items is None else items})
    chosen = {"folder": folder, "url": url, "reader": reader and base64.b64encode(cloudpickle.dumps(reader)).decode()}
    if sum(v is not None for v in chosen.values()) != 1:
        raise ValueError("one of folder, url and reader is needed")
    return spark.read.format("jsonl_ranges").option("plan", payload).options(**{k: v for k, v in chosen.items() if v is not None}).load()
