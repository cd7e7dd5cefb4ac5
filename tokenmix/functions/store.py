"""The small documents of a run, by name, in a folder on any file system: a plain path (synced, replaced as a whole) or a URL that Hadoop knows."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid

from pyspark.sql import SparkSession

from . import canonical


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.remote = spark, folder.rstrip("/"), "://" in folder

    def url(self, name: str) -> str:
        """As Spark's readers and writers want it; a plain path is the driver's own disk, whatever the default file system is."""
        return f"{self.folder}/{name}" if self.remote else f"file://{os.path.abspath(self.folder)}/{name}"

    def _hadoop(self, name: str):
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.url(name))
        return path, path.getFileSystem(sc._jsc.hadoopConfiguration())

    def read(self, name: str) -> bytes:
        if not self.remote:
            with open(f"{self.folder}/{name}", "rb") as f:
                return f.read()
        path, fs = self._hadoop(name)
        if not fs.exists(path):
            raise FileNotFoundError(self.url(name))
        source = fs.open(path)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
        finally:
            source.close()

    def json(self, name: str):
        return json.loads(self.read(name).decode())

    def sha256(self, name: str) -> str:
        return hashlib.sha256(self.read(name)).hexdigest()

    def put(self, name: str, payload) -> None:
        """Readers see the old document or the new one."""
        if not self.remote:
            canonical.write_json(f"{self.folder}/{name}", payload)
            return
        path, fs = self._hadoop(name)
        new, _ = self._hadoop(f".{name}.{uuid.uuid4().hex}")
        sink = fs.create(new, True)
        try:
            sink.write(bytearray(canonical.canonical(payload)))
        finally:
            sink.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = gateway.new_array(rename, 1)
        how[0] = rename.valueOf("OVERWRITE")
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(new, path, how)

    def exists(self, name: str) -> bool:
        if not self.remote:
            return os.path.exists(f"{self.folder}/{name}")
        path, fs = self._hadoop(name)
        return fs.exists(path)

    def children(self, name: str) -> list[str]:
        """Names below the folder called name; none if there is no such folder."""
        if not self.exists(name):
            return []
        if not self.remote:
            return sorted(os.listdir(f"{self.folder}/{name}"))
        path, fs = self._hadoop(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def drop(self, name: str) -> None:
        if not self.remote:
            shutil.rmtree(f"{self.folder}/{name}", ignore_errors=True)
            return
        path, fs = self._hadoop(name)
        fs.delete(path, True)
