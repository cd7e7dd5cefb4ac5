"""WARC archives: a writer, and a sequential reader.

Reader: one gzip member per record; each member is inflated incrementally (``BLOCK`` compressed bytes at a
time), its header is framed by the blank line, its block by Content-Length, and payload digests are verified while the bytes
pass. Only one record's payload is held at a time.

Writer: payloads are the UTF-8 of html. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the
one with the smallest page_id is a response and the others are revisits that refer to it; smaller ones are all responses. Archives are written
by tasks into the shared folder under names of the attempt; the manifest that Spark commits says which of them count,
so repeated and lost tasks leave no wrong records.

Defined cases: null html -> empty payload; null url -> no target header; rows that repeat a page_id and payload are all
responses if that page_id is the smallest, else all revisits; a null page_id never is the smallest unless no other has the payload
(then a response); a very long html is one record, held once by the writer and once by the reader; an empty table gives no archive and no rows; other
columns are not read. A damaged archive raises ``WarcError``.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_fs, ready, shared_dir

REVISIT_BYTES, BLOCK, LEVEL = 100, 64 << 10, 6
#: Partitions that one payload is dealt to; archive bytes that one task reads.
SALTS, READ_BYTES = 64, 64 << 20
VERSION = b"WARC/1.1"
DATE = "2000-01-01T00:00:00Z"  # fixed, so equal pages give equal archives


class WarcError(ValueError):
    pass


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers.get("warc-type", "")

    def number(self, name: str) -> int | None:
        """The id within a <urn:page:id> header."""
        v = self.headers.get(name)
        return None if v is None or v == "<urn:page:null>" else int(v.removeprefix("<urn:page:").removesuffix(">"))


def _clean(value: str) -> str:
    """Header values keep to one line (control characters are percent-escaped)."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def member(headers: list[tuple[str, str]], block: bytes, level: int = LEVEL) -> bytes:
    """One record as one gzip member."""
    head = VERSION + b"\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in headers).encode("utf-8", "surrogatepass") + b"\r\n"
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _inflated(source, size: int) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(offset of a gzip member, its inflated pieces), member after member."""
    data, at, ended = source.read(size), 0, False

    def pieces():
        nonlocal data, at, ended
        z = zlib.decompressobj(31)
        try:
            while True:
                out = z.decompress(data, size)
                at_in = len(data) - len(z.unconsumed_tail) - len(z.unused_data)
                at += at_in
                data = z.unused_data if z.eof else z.unconsumed_tail
                if out:
                    yield out
                if z.eof:
                    return
                if not data:
                    data = source.read(size)
                    if not data:
                        raise WarcError(f"the archive ends within a record at {at}")
        except zlib.error as e:
            raise WarcError(f"bad gzip data at {at}: {e}") from None

    while True:
        if not data:
            data = source.read(size)
            if not data:
                return
        yield at, pieces()


def records(source, size: int = BLOCK) -> Iterator[Record]:
    """The records of an archive (any object with read), in order."""
    for offset, pieces in _inflated(source, size):
        got = bytearray()
        for p in pieces:
            got += p
            if (end := got.find(b"\r\n\r\n")) >= 0:
                break
        else:
            raise WarcError(f"no end of the header of the record at {offset}")
        lines = bytes(got[:end]).decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError(f"no WARC record at {offset}")
        headers: dict[str, str] = {}
        for line in lines[1:]:
            k, colon, v = line.partition(":")
            if not colon:
                raise WarcError(f"bad header line of the record at {offset}")
            headers[k.strip().lower()] = v.strip()
        if not (length := headers.get("content-length", "")).isdigit():
            raise WarcError(f"no Content-Length of the record at {offset}")
        want, digest = int(length), hashlib.sha256()
        block = got[end + 4 :]
        digest.update(block[:want])
        for p in pieces:
            digest.update(p[: max(0, want - len(block))])
            block += p
        if len(block) != want + 4 or block[want:] != b"\r\n\r\n":
            raise WarcError(f"the record at {offset} has not the length that its header says")
        said = headers.get("warc-payload-digest" if headers.get("warc-type") != "revisit" else "warc-block-digest")
        if said is not None and said != f"sha256:{digest.hexdigest()}":
            raise WarcError(f"the record at {offset} has another digest than its header says")
        yield Record(offset, headers, bytes(block[:want]))


def with_types(pages: DataFrame, least: int = REVISIT_BYTES, salts: int = SALTS) -> DataFrame:
    """page_id, url, html (empty for revisits), payload_bytes, payload_digest, record_type, refers_to.

    Payloads that occur again are found from (digest, salt) groups, at most ``salts`` of a payload, and joined on both, so
    a payload that fills a third of all rows is in so many partitions.
    """
    html = F.coalesce("html", F.lit(""))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"), salt.alias("salt"))
    parts = (
        pages.select("page_id", F.octet_length(html).alias("n"), F.sha2(html, 256).alias("first_digest"), salt.alias("first_salt"))
        .where(F.col("n") >= least)
        .groupBy("first_digest", "first_salt")
        .agg(F.min("page_id").alias("least_id"), F.count("*").alias("copies"))
    )
    first = (
        parts.groupBy("first_digest")
        .agg(F.min("least_id").alias("first_id"), F.sum("copies").alias("copies"), F.collect_list("first_salt").alias("salts"))  # no longer than that
        .where(F.col("copies") > 1)
        .select("first_digest", "first_id", F.explode("salts").alias("first_salt"))
    )
    # small payloads get keys of their own, so that they don't meet in one task
    key = F.when(F.col("payload_bytes") >= least, F.col("payload_digest")).otherwise(F.concat(F.lit("small "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    joined = rows.withColumn("key", key).join(first, (F.col("key") == F.col("first_digest")) & (F.col("salt") == F.col("first_salt")), "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(again, F.lit("")).otherwise(F.col("html")).alias("html"), "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"),
    )


def _rows(batch: pa.RecordBatch, some: int = 64):
    """The batch's rows; not all of its texts are Python objects at once."""
    for x in range(0, batch.num_rows, some):
        yield from zip(*(c.to_pylist() for c in batch.slice(x, some).columns))


def write(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Writes archives into folder; returns their committed manifest (file string, n_records long, n_bytes long)."""
    spark = ready(pages.sparkSession)
    urn = lambda i: f"<urn:page:{'null' if i is None else i}>"

    def work(batches):
        from pyspark import TaskContext

        url, sink, n, size = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for b in batches:
            for page, target, html, length, digest, kind, refers in _rows(b):
                payload = html.encode("utf-8", "surrogatepass")
                headers = [("WARC-Type", kind), ("WARC-Record-ID", urn(page)), ("WARC-Date", DATE)]
                if target is not None:
                    headers.append(("WARC-Target-URI", target))
                headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(length))]
                if kind == "revisit":
                    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", urn(refers))]
                    payload = b""
                    headers.append(("WARC-Block-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"))
                headers += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
                if sink is None:
                    fs, path = open_fs(url)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = fs.open_output_stream(path)
                one = member(headers, payload, level)
                sink.write(one)
                n, size = n + 1, size + len(one)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [url], "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

    manifest = folder + "/manifest"
    # a row per archive; few files of them
    listed = with_types(pages).mapInArrow(work, "file string, n_records long, n_bytes long").repartition(spark.sparkContext.defaultParallelism)
    listed.write.parquet(manifest)
    return spark.read.schema("file string, n_records long, n_bytes long").parquet(manifest)


def read(manifest: DataFrame, with_block: bool = False) -> DataFrame:
    """A row per record of the listed archives; a task reads whole archives of about ``READ_BYTES``."""
    spark = ready(manifest.sparkSession)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string, record_offset long" + ", block binary" * with_block
    types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("record_offset", pa.int64())] + [("block", pa.binary())] * with_block)

    def work(batches):
        for b in batches:
            for url, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, path = open_fs(url)
                rows, seen = [], 0
                with fs.open_input_stream(path) as source:
                    for r in records(source):
                        length = int(r.headers["x-payload-length"])
                        if r.kind == "response" and length != len(r.block):
                            raise WarcError(f"{url} at {r.offset}: the payload has {len(r.block)} bytes, its header says {length}")
                        row = (r.number("warc-record-id"), r.headers.get("warc-target-uri"), length, r.headers["warc-payload-digest"].removeprefix("sha256:"), r.kind, r.number("warc-refers-to"), url, r.offset)
                        rows.append(row + ((r.block,) if with_block else ()))
                        seen += 1
                        if len(rows) == (100 if with_block else 5000):
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)
                if seen != n:
                    raise WarcError(f"{url} has {seen} records, not {n}")

    files = manifest.select("file", "n_records")
    size = manifest.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes")).collect()[0]
    tasks = max(3 * spark.sparkContext.defaultParallelism, (size["bytes"] or 0) // READ_BYTES)
    return files.repartition(max(1, min(size["n"], tasks))).mapInArrow(work, schema)


def roundtrip(pages: DataFrame) -> DataFrame:
    return read(write(pages, shared_dir(pages.sparkSession, "warc"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
