"""Whole texts as lossless media: the bytes of a text as grey samples of WebP images, and features of what is read back.

The payload is the UTF-8 of the text, filled with bytes 255 to a positive multiple of ``UNIT`` (24 x 24 samples). It is
stored as one WebP file per ``STRIP`` units, one file after another, so that no image grows with the text. Files are written and read
``BULK`` payload bytes at a time, of a very long text too.

Defined cases: a null text is an empty one (one unit of 255); equal texts give equal values; an empty table
gives an empty result; repeated rows each get a result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import webp
from .common import ready

UNIT, STRIP = 576, 8
#: Payload bytes that are decoded in step.
BULK = 4 << 20


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT), len(raw)


def _in_bulk(items: list, size, work) -> list:
    """work(items), so many at a time that their sizes are about BULK."""
    out, held, total = [], [], 0
    for x in items:
        held.append(x)
        total += size(x)
        if total >= BULK:
            out += work(held)
            held, total = [], 0
    return out + (work(held) if held else [])


def to_media(payloads: list[bytes]) -> list[bytes]:
    """The stored form of each payload."""
    strips = [[np.frombuffer(p, np.uint8)[i : i + UNIT * STRIP] for i in range(0, len(p), UNIT * STRIP)] for p in payloads]
    files = iter(_in_bulk([s for some in strips for s in some], len, webp.store_many))
    return [b"".join(next(files) for _ in some) for some in strips]


def split_media(media: bytes) -> list[bytes]:
    files, at = [], 0
    while at < len(media):
        n = webp.file_size(media, at)
        files.append(media[at : at + n])
        at += n
    return files


def from_media(many: list[bytes]) -> list[np.ndarray]:
    """The samples of each stored form."""
    files = [split_media(m) for m in many]
    got = iter(_in_bulk([f for some in files for f in some], lambda f: 2 * len(f), webp.load_many))
    return [np.concatenate([next(got) for _ in some]) for some in files]


def feature(samples: np.ndarray) -> str:
    """Mean and variance in thousandths, and the share of each of 16 sample ranges in thousandths, all in whole numbers."""
    n = np.bincount(samples, minlength=256)
    total, values = len(samples), np.arange(256)
    one, two = int(n @ values), int(n @ (values * values))
    shares = n.reshape(16, 16).sum(1) * 1000 // total
    return f"{one * 1000 // total}:{(two * total - one * one) * 1000 // (total * total)}:" + ",".join(map(str, shares.tolist()))


COLUMNS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def measures(texts: list[str | None]):
    """Columns of ``COLUMNS`` and the stored forms of the texts."""
    columns: list[list] = [[] for _ in range(7)]
    media: list[bytes] = []
    bulk, size = [], 0

    def flush():
        stored = to_media([p for p, _ in bulk])
        media.extend(stored)
        for (_, n), m, samples in zip(bulk, stored, from_media(stored)):
            raw = samples.tobytes()
            row = (n, len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature(samples))
            for c, v in zip(columns, row):
                c.append(v)
        bulk.clear()

    for t in texts:
        bulk.append(payload_of(t))
        size += len(bulk[-1][0])
        if size >= BULK:
            flush()
            size = 0
    if bulk:
        flush()
    return columns, media


def roundtrip(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """doc_id and ``COLUMNS``, with keep_media also media binary."""
    ready(docs.sparkSession)
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))] + ["media"] * keep_media

    def work(batches):
        for b in batches:
            columns, media = measures(b.column(1).to_pylist())
            arrays = [b.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(media, pa.binary())] if keep_media else []), names)

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id long, {COLUMNS}" + ", media binary" * keep_media)
