"""Token ids in Arrow stream files of equal-length sequences.

A file holds one run of ids, cut into sequences of ``length``: record batches of the columns ``ids``
(fixed-size list of uint16, or uint32 for a vocabulary that needs it) and ``mask`` (fixed-size list of bool,
bits in Arrow: true for an id, false for the filling behind the last one). Every batch but the last
has the same number of sequences, so sequence k is in batch k // rows at row k % rows, and a reader takes
it from the mapped or fetched buffer without copying. Beside it lies an index file (Arrow stream) with each document's
doc_id, start in the file and number of ids.

Documents are written in ascending doc_id order (null first; equal ids by the XXH64 of their texts, then by text): the corpus is range
partitioned, each partition writes files of about ``FILE_IDS`` ids, and the files' totals (one row per file) give every file's
place in the whole run. A file is written under a name of the task attempt and becomes part of the result only
through the manifest that Spark commits, so repeated and lost tasks leave no wrong rows.

Defined cases: null text -> like empty text (only the end id); the added tokens' strings in a text are the
added tokens, as in the library; repeated rows are separate documents; very long texts are encoded span by span and lie in one file; an empty
table gives no file and no rows; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import kept, open_fs, ready, shared_dir

S, L, O, A, W = spans.SPACE, spans.LETTER, spans.OTHER, spans.APOSTROPHE, spans.WIDE
#: Places where the vocabulary's pattern always ends a match (white space is dropped, so spaces are spans of their own).
CUTS = spans.pair_table([(L, S), (O, S), (A, S), (S, L), (S, O), (S, A), (L, O), (L, A), (O, L)])
LENGTH, ROWS, END = 1024, 256, 2
#: ids after which a task opens its next file (at the end of a document).
FILE_IDS = 1 << 27
END_OF_STREAM = b"\xff\xff\xff\xff\0\0\0\0"


class LibraryEncoder:
    """The tokenizers library's ids of whole texts, asked for once per distinct span."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached = spans.Cached(CUTS, self._make, fold=self._fold, limit=1_000_000, most=32 << 20, bits=21)

    @staticmethod
    def _fold(buf: np.ndarray) -> np.ndarray:
        """A-Z to lower case where no byte outside ASCII is near (the library lower-cases after composing characters)."""
        wide = buf >= 128
        if not wide.any():
            return spans.LOWER[buf]
        near = wide.copy()
        near[:-1] |= wide[1:]
        return np.where(near, buf, spans.LOWER[buf])

    def _make(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in new], add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for x in got for i in x), np.int32, int(n.sum())), n

    def encode(self, texts: list[bytes]):
        """For slices of the texts in order: (slice, ids one text after another, offsets of the texts)."""
        odd = [k for k, t in enumerate(texts) if any(a in t for a in self.added)]
        if not odd:
            yield from self.cached.lists(texts)
            return
        whole = {k: np.array(self.tokenizer.encode(texts[k].decode("utf-8", "surrogatepass"), add_special_tokens=False).ids, np.int32) for k in odd}
        rest = [b"" if k in whole else t for k, t in enumerate(texts)]
        for part, ids, ends in self.cached.lists(rest):
            here = [k for k in odd if part.start <= k < part.stop]
            if here:
                lists = [whole.get(k, ids[ends[i] : ends[i + 1]]) for i, k in enumerate(range(part.start, part.stop))]
                ids = np.concatenate(lists)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            yield part, ids, ends


def encoder(path: str) -> LibraryEncoder:
    store = kept("tokenfile")
    if path not in store:
        store[path] = LibraryEncoder(path)
    return store[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def sequence_schema(length: int, vocabulary: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint16() if vocabulary <= 1 << 16 else pa.uint32(), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class Writer:
    """Appends ids to a sequence file and documents to its index."""

    def __init__(self, url: str, vocabulary: int, length: int = LENGTH, rows: int = ROWS):
        fs, path = open_fs(url)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.length, self.rows, self.total, self.held, self.waiting = length, rows, 0, [], 0
        self.sink, self.index_sink = fs.open_output_stream(path), fs.open_output_stream(path + ".index")
        self.schema = sequence_schema(length, vocabulary)
        self.type = np.uint16 if vocabulary <= 1 << 16 else np.uint32
        self.stream = pa.ipc.new_stream(self.sink, self.schema)
        self.index = pa.ipc.new_stream(self.index_sink, INDEX)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        n = np.diff(ends)
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(self.total + ends[:-1]), pa.array(n)], schema=INDEX))
        self.held.append(ids.astype(self.type))
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= self.length * self.rows:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate([*self.held, np.zeros(0, self.type)])
        step = self.length * self.rows
        whole = len(flat) if last else len(flat) // step * step
        for i in range(0, whole, step):
            some = flat[i : i + step]
            fill = -len(some) % self.length
            mask = np.arange(len(some) + fill) < len(some)
            some = np.concatenate([some, np.zeros(fill, self.type)]) if fill else some
            self.stream.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (some, mask)], schema=self.schema))
        self.held, self.waiting = [flat[whole:]], len(flat) - whole

    def close(self) -> int:
        self._flush(True)
        for x in (self.stream, self.index, self.sink, self.index_sink):
            x.close()
        return self.total


class Reader:
    """Random access to the sequences of a file. All batches but the last have the same size in bytes, so batch k is found by its offset:
    on local storage it is a view of the mapped file, elsewhere it alone is fetched."""

    def __init__(self, url: str):
        fs, path = open_fs(url)
        self.source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        self.length, self.begin = self.schema.field("ids").type.list_size, self.source.tell()
        body = self.source.size() - self.begin - len(END_OF_STREAM)
        self.rows, self.step, self.count = 0, max(body, 1), 0
        self.held: tuple[int, pa.RecordBatch | None] = (-1, None)
        if body > 0:
            self.rows = self.batch(0).num_rows
            self.step = self.source.tell() - self.begin
            self.count = -(-body // self.step)
        self.index = pa.ipc.open_stream(fs.open_input_stream(path + ".index"))

    def batch(self, k: int) -> pa.RecordBatch:
        if self.held[0] != k:
            self.source.seek(self.begin + k * self.step)
            self.held = k, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
        return self.held[1]

    def flat(self, k: int) -> np.ndarray:
        return self.batch(k).column(0).flatten().to_numpy()

    def __len__(self) -> int:
        return (self.count - 1) * self.rows + self.batch(self.count - 1).num_rows if self.count else 0

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """ids and mask of sequence k, as views of the file's buffers."""
        at = k % self.rows * self.length
        return self.flat(k // self.rows)[at : at + self.length], self.batch(k // self.rows).column(1).flatten().slice(at, self.length)

    def ids(self, start: int, n: int) -> np.ndarray:
        """ids start .. start+n of the file's run; a copy only where they lie in two batches."""
        step, parts = self.rows * self.length, []
        while n > 0:
            k, at = divmod(start, step)
            parts.append(self.flat(k)[at : at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


MANIFEST = "file string, place long, part long, n_tokens long"


def write(docs: DataFrame, folder: str, path: str | None = None, length: int = LENGTH, rows: int = ROWS, most: int = FILE_IDS) -> DataFrame:
    """Writes the files; returns their manifest (``MANIFEST``; place and part give the order), already committed."""
    spark = ready(docs.sparkSession)
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def work(batches):
        from pyspark import TaskContext

        place, part, writer, url = TaskContext.get().partitionId(), 0, None, ""
        enc = encoder(path or vocabulary_path())

        def ended():
            return pa.RecordBatch.from_pydict({"file": [url], "place": pa.array([place], pa.int64()), "part": pa.array([part], pa.int64()), "n_tokens": pa.array([writer.close()], pa.int64())})

        for b in spans.grouped(batches, 1, 16 << 20):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            for some, ids, ends in enc.encode(texts):
                ids, ends = np.insert(ids, ends[1:], END), ends + np.arange(len(ends))
                x = 0
                while x + 1 < len(ends):
                    if writer is not None and writer.total >= most:
                        yield ended()
                        writer, part = None, part + 1
                    if writer is None:
                        url = f"{folder}/ids-{place:06d}-{part:04d}-{uuid.uuid4().hex}.arrows"
                        writer = Writer(url, enc.tokenizer.get_vocab_size() + 1, length, rows)
                    y = min(len(ends) - 1, int(np.searchsorted(ends, ends[x] + most - writer.total)))  # the document with which the file is full
                    writer.add(b.column(0).slice(some.start + x, y - x).cast(pa.int64()), ids[ends[x] : ends[y]], ends[x : y + 1] - ends[x])
                    x = y
        if writer is not None:
            yield ended()

    manifest = folder + "/manifest"
    ordered.mapInArrow(work, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    spark = ready(manifest.sparkSession)
    files = sorted(manifest.collect(), key=lambda r: (r["place"], r["part"]))  # one row per file
    before = np.concatenate([[0], np.cumsum([r["n_tokens"] for r in files])]).astype(int).tolist()
    listed = spark.createDataFrame([(r["file"], b) for r, b in zip(files, before)], "file string, before long")

    def work(batches):
        for b in batches:
            for url, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                r = Reader(url)
                for docs in r.index:
                    start, n = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                    crc = [zlib.crc32(r.ids(x, y).astype("<u4")) for x, y in zip(start.tolist(), n.tolist())]
                    yield pa.RecordBatch.from_pydict({"doc_id": docs.column(0), "start": pa.array(start + base), "n_tokens": docs.column(2), "ids_crc32": pa.array(crc, pa.int64())})

    return listed.repartition(max(1, len(files)), "file").mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def roundtrip(docs: DataFrame, path: str | None = None) -> DataFrame:
    return read(write(docs, shared_dir(docs.sparkSession, "tokens"), path))
