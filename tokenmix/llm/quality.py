"""Quality by compression: two zstandard dictionaries, one from good and one from bad labelled text.

A text's feature is the compressed-size difference normalised by length, (bad - good) / bytes, where
``good`` is the size of the text compressed with the dictionary of good text. The whole text is compressed, in chunks
of ``CHUNK`` bytes whose sizes are added up: each chunk meets a fresh dictionary, so long texts are judged by the
dictionaries and not by what they taught the compressor themselves, and memory is bounded. A logistic
fit of the feature on labelled rows that no dictionary saw turns it into a score.

Learned from labelled rows that are not held out, at most ``TRAIN_ROWS`` of each label (those with the
smallest hash of doc_id) of at most ``TRAIN_BYTES`` each. Labels, lang, source and doc_id are no inputs of a score.

Defined cases: a null text is an empty text and gets the score of feature 0; without labels of both kinds
every score is the share of label 1 (0.5 without labels); repeated rows each get a score, equal texts (ties) the same; a null label
is no label; of an id with several texts the smallest is learned from; very long texts are scored chunk by chunk; an empty table gives
an empty result; other columns are kept (``score`` and ``predicted`` are replaced).
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, kept, ready

TRAIN_ROWS, TRAIN_BYTES = 1500, 16 << 10
DICTIONARY_BYTES, CHUNK, LEVEL = 32 << 10, 512, 3
THRESHOLD = 0.7


@dataclass
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def compressors(self):
        import zstandard

        return [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_checksum=False, write_dict_id=False) for d in (self.good, self.bad)]

    def features(self, texts: list[str | None], tools=None) -> np.ndarray:
        good, bad = tools or self.compressors()
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            raw = (t or "").encode("utf-8", "surrogatepass")
            if raw:
                g = b = 0
                for k in range(0, len(raw), CHUNK):
                    part = raw[k : k + CHUNK]
                    g, b = g + len(good.compress(part)), b + len(bad.compress(part))
                out[i] = (b - g) / len(raw)
        return out

    def scores(self, texts: list[str | None], tools=None) -> np.ndarray:
        z = np.clip(self.slope * self.features(texts, tools) + self.offset, -30, 30)
        return 1 / (1 + np.exp(-z))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Newton's method; the targets are pulled in a little (Platt), so that separable rows end too."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = x.std() or 1.0
    a = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(h, a.T @ (t - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of about size bytes; few or short texts make a plain one of their bytes."""
    import zstandard

    chunks = [t[i : i + CHUNK] for t in texts for i in range(0, len(t), CHUNK)]
    if sum(map(len, chunks)) >= 16 * 1024 and len(chunks) >= 16:
        try:
            return zstandard.train_dictionary(min(size, sum(map(len, chunks)) // 8), chunks, level=LEVEL).as_bytes()
        except zstandard.ZstdError:  # too uniform to train on
            pass
    return b"".join(chunks)[-size:]


def fit(rows: list[tuple[int, str, int]], size: int = DICTIONARY_BYTES) -> Model:
    """rows: (doc_id, text, label). Half of them make the dictionaries, the other half the score."""
    half = lambda r: zlib.crc32(f"half {r[0]}".encode()) % 2
    texts = {label: [r[1].encode() for r in rows if r[2] == label and not half(r)] for label in (0, 1)}
    y = np.array([r[2] for r in rows if half(r)], float)
    n1 = sum(r[2] for r in rows)
    prior = Model(b"", b"", 0.0, float(np.log((n1 + 0.5) / (len(rows) - n1 + 0.5))))
    if not texts[0] or not texts[1] or len(set(y.tolist())) < 2:
        return prior
    model = Model(_dictionary(texts[1], size), _dictionary(texts[0], size), 1.0, 0.0)
    model.slope, model.offset = _logistic(model.features([r[1] for r in rows if half(r)]), y)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    sample = None
    for label in (0, 1):  # a bounded sample of ids of each label
        some = usable.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        sample = some if sample is None else sample.unionByName(some)
    texts = docs.where(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES)).select("doc_id", "text")
    # one text of an id, however often the id occurs: at most 2 * rows texts of TRAIN_BYTES
    got = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect()
    return fit(sorted((r["doc_id"], r["text"], r["quality"]) for r in got))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs, then score double and predicted int (replacing such columns)."""
    spark = ready(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    schema = T.StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")
    shared, key, at = spark.sparkContext.broadcast(model), uuid.uuid4().hex, docs.columns.index("text")

    def work(batches):
        model = shared.value
        store = kept("quality")
        if key not in store:
            store.clear()
            store[key] = model.compressors()
        for b in batches:
            s = model.scores(b.column(at).to_pylist(), store[key])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], [*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(work, schema)
