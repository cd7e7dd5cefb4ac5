"""What the operators of this subpackage share: table access, shared storage and code shipping."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Rows and bytes of one Arrow batch handed to Python; whole texts may be long, so both are low.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches of this session and makes the package importable on executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # an execution's shuffle files go when it ends, not when the driver happens to collect its garbage
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    ship(spark)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder URL below spark.checkpoint.dir, which driver and executors share.

    Where the setting is absent a local folder is set for the session, if it is a local one (tests); elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="tokenmix-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and base.startswith("/"):
        fs = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        base = ("file://" + base) if fs.startswith("file:") else fs.rstrip("/") + base
    return f"{base.rstrip('/')}/tokenmix/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Cuts lineage: writes df as Parquet into the shared folder and reads it again.

    Without a _SUCCESS file, which nobody asks for: on a local file system the driver would fork for its ``chmod``, and the JVM is counted twice meanwhile.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", codec).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame) -> DataFrame:
    """For frames that are small beside the corpus (links, edges): no more tasks and files than the cluster works on at a time, thrice."""
    return df.coalesce(3 * df.sparkSession.sparkContext.defaultParallelism)


#: A key is hot if it has over 1/SHARE of the rows, and over HOT_ROWS of them (fewer are no burden for a task).
SHARE, HOT_ROWS = 1000, 100_000


def hot_keys(counts: DataFrame, key: str, total: int) -> list:
    """Keys of counts (key, n: one row per key) with so many of the total rows: fewer than SHARE, and none if there are few rows."""
    if total <= HOT_ROWS:
        return []
    return [r[0] for r in counts.where(F.col("n") > max(total // SHARE, HOT_ROWS)).select(key).collect()]


def joined(rows: DataFrame, names: DataFrame, key: str, hot: list) -> DataFrame:
    """rows with what names (one row per key) has for their key; names of hot keys are broadcast, so that no task gets all the rows of one."""
    if not hot:
        return rows.join(names, key)
    is_hot = F.col(key).isin(hot)
    return rows.where(~is_hot).join(names.where(~is_hot), key).unionByName(rows.where(is_hot).join(F.broadcast(names.where(is_hot)), key))


def rested(spark: SparkSession) -> None:
    """Gives back what the driver no longer needs: between steps of many plans, whose remains would let it grow to all it may have.

    Its garbage is collected, so that the heap shrinks to what lives, and then the memory that the JVM's compilers and buffers and Python have freed, which the C library would keep, goes back to the system.
    """
    jvm = spark.sparkContext._jvm
    gc.collect()  # first, as it lets go of the JVM's objects too
    jvm.System.gc()
    _trim_jvm(spark)
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def _trim_jvm(spark: SparkSession) -> bool:
    """The JVM's own command for that; false where it has none (before 17.0.9, or not on Linux)."""
    jvm, new = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    server, name = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), "systemTrimNativeHeap"
    commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")

    def asked(method, kinds, *values):  # the server's class is not open to py4j, its interface is
        types, given = new(jvm.Class, len(kinds)), new(jvm.Object, len(kinds))
        for k, (kind, value) in enumerate(zip(kinds, values)):
            types[k], given[k] = jvm.Class.forName(kind), value
        return jvm.Class.forName("javax.management.MBeanServer").getMethod(method, types).invoke(server, given)

    if name not in [x.getName() for x in asked("getMBeanInfo", ["javax.management.ObjectName"], commands).getOperations()]:
        return False
    asked("invoke", ["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"], commands, name, None, None)
    return True


#: What a Python worker keeps between the batches and tasks of one operator.
_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The store of an operator in this worker; those of other operators are given up, as a worker serves one after another."""
    if any(k != operator for k in _kept):
        import pyarrow as pa

        for k in [k for k in _kept if k != operator]:
            del _kept[k]
        gc.collect()
        pa.default_memory_pool().release_unused()
    return _kept.setdefault(operator, {})


def dropped(df: DataFrame) -> None:
    """Deletes the shared files behind a frame made by ``written``."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/tokenmix/" in folder:
            deleted(df.sparkSession, folder)


def deleted(spark: SparkSession, url: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(url)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(columns: list[str], base: str) -> str:
    """A column name that none of the columns has (Spark's names don't tell cases apart)."""
    name, taken = f"_tokenmix_{base}", {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that nothing is learned from (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def open_fs(url: str):
    """(pyarrow filesystem, path) of a URL in the shared folder, as executors see it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url if "://" in url else url.replace("file:", "file://", 1))
