"""Shared scratch folders: below spark.checkpoint.dir, which the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship


def folder(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="tokenmix-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_files(rows: DataFrame, url: str) -> list[tuple[str, int]]:
    """Writes text files into a folder (a URL) and returns (path, size) of each. rows: path, at and value; a file's lines are its
    values by at, each with a newline. A task holds one batch; a repeated task writes the same files again."""
    ship(rows.sparkSession)

    def work(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(url)
        store.create_dir(base, recursive=True)
        sink, name, size, done = None, None, 0, []
        for b in batches:
            for path, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if path != name:
                    if sink:
                        sink.close()
                        done.append((name, size))
                    sink, name, size = store.open_output_stream(f"{base}/{path}"), path, 0
                line = value.encode() + b"\n"
                sink.write(line)
                size += len(line)
        if sink:
            sink.close()
            done.append((name, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done]), pa.array([s for _, s in done], pa.int64())], ["path", "size"])

    dealt = rows.select("path", "at", "value").repartition("path").sortWithinPartitions("path", "at").select("path", "value")
    return sorted(tuple(r) for r in dealt.mapInArrow(work, "path string, size long").collect())  # one row per file
