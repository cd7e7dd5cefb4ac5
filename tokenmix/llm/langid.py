"""Spark side of language identification (method and defined cases: ``pieces``)."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pieces
from .common import held_out, ready

#: At most about so many documents are learned from, whatever the corpus holds (expected size of a hash sample).
TRAIN_DOCS = 3000
#: Documents over this many bytes are not learned from.
TRAIN_BYTES = 32 << 10


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def train(docs: DataFrame, vocabulary: str | None = None, limit: int = TRAIN_DOCS) -> pieces.Model:
    """Learns from text and non-null lang of documents that are not held out; a bounded hash sample per language."""
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).alias("at")
    )
    n = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = max(1, limit // max(1, len(n)))
    share = F.lit(0)
    for lang, k in n.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, each / k) * (1 << 20))).otherwise(share)
    sample = usable.where((F.col("at") < share) & (F.octet_length("text") <= TRAIN_BYTES)).select("lang", "text")
    counts: dict[str, dict[str, float]] = {lang: {} for lang in n}
    for r in sample.toLocalIterator():
        c = counts[r["lang"]]
        for w in pieces.blocks_of(r["text"]):
            c[w] = c.get(w, 0) + 1
    counts = {k: v for k, v in counts.items() if v}
    return pieces.fit(pieces.vocabulary(vocabulary or vocabulary_path()), counts)


def identify(docs: DataFrame, model: pieces.Model) -> DataFrame:
    """All columns of docs, with lang_pred string and score double after them (replacing such columns)."""
    spark = ready(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    # only text goes through Python; the rest of the row rides along in the Arrow batch
    schema = T.StructType(list(docs.schema.fields)).add("lang_pred", "string").add("score", "double")
    shared, key, at = spark.sparkContext.broadcast(model), uuid.uuid4().hex, docs.columns.index("text")

    def score(batches):
        scorer = pieces.Scorer.of(shared.value, key)
        for b in batches:
            pred, value = scorer.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(value, pa.float64())], [*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)
