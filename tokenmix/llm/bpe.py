"""Byte-level BPE encoding and decoding with a pair occurrence index.

``PairIndex`` maps every mergeable pair to all its positions in the symbols of a partition's distinct
words; the active ranks are applied in ascending order, each at all its positions at once, and the lists
of the pairs that a merge makes are extended. (A pair that contains a merge's product always has a higher
rank, so ascending order over the partition is the order within each word.)

Defined cases: null text -> like empty text (no tokens); a very long text is one buffer, its distinct spans are merged ``bulk`` at a time; the special token's string in a text is the
special token, as in the library; repeated rows each get a result; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import spans
from .common import kept, ready

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
S, L, O, A, W = spans.SPACE, spans.LETTER, spans.OTHER, spans.APOSTROPHE, spans.WIDE
#: Places where the pattern always ends a match: word|space, letters|signs and signs|letters (not after an apostrophe).
CUTS = spans.pair_table([(L, S), (O, S), (A, S), (L, O), (L, A), (O, L)])


def byte_characters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: visible Latin-1 bytes are themselves, the others follow from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        ids, to_char = data["model"]["vocab"], byte_characters()
        to_byte = {c: b for b, c in to_char.items()}
        self.base = np.array([ids[to_char[b]] for b in range(256)], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        left = np.array([ids[a] for a, _ in merges], np.int64)
        right = np.array([ids[b] for _, b in merges], np.int64)
        #: (left, right, product) by rank
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        key = left << 20 | right
        self.rank_of = np.argsort(key, kind="stable").astype(np.int32)
        self.keys = key[self.rank_of]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        text = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.bytes = spans.Lists(np.uint8)
        parts = [text.get(i, b"") for i in range(max(text) + 1)]
        self.bytes.append(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1 where the pair doesn't merge."""
        key = a.astype(np.int64) << 20 | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.rank_of[i], np.int32(-1))


class PairIndex:
    def __init__(self, vocabulary: Vocabulary, symbols: np.ndarray, starts: np.ndarray):
        """symbols of words one after another; starts of the words."""
        self.v, self.symbol, n = vocabulary, symbols.copy(), len(symbols)
        self.next, self.prev = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        if n:
            self.next[-1] = -1
            self.next[starts[1:] - 1] = -1
            self.prev[starts] = -1
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._note(np.nonzero(self.next >= 0)[0].astype(np.int32))

    def _note(self, at: np.ndarray) -> None:
        """Adds positions to the lists of the pairs that begin there; a pair new to the index becomes active."""
        r = self.v.rank(self.symbol[at], self.symbol[self.next[at]])
        at, r = at[r >= 0], r[r >= 0]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = [*(np.nonzero(np.diff(r, prepend=-1))[0]).tolist(), len(r)]
        places, active = self.places, self.active
        for x, y in zip(cuts, cuts[1:]):
            rank = int(r[x])
            if rank in places:
                places[rank].append(at[x:y])
            else:
                places[rank] = [at[x:y]]
                heapq.heappush(active, rank)

    def run(self) -> np.ndarray:
        """The symbols after all merges, -1 where a symbol was merged into the one before."""
        symbol, nxt, prv, merges = self.symbol, self.next, self.prev, self.v.merges
        while self.active:
            rank = heapq.heappop(self.active)
            lists = self.places.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b, made = merges[rank]
            right = nxt[at]
            at = at[(symbol[at] == a) & (right >= 0) & (symbol[right] == b)]
            if not len(at):
                continue
            at = np.unique(at)  # a position may have been noted twice
            if a == b and len(at) > 1:  # in a row of equal symbols every second place, from the left
                head = np.ones(len(at), bool)
                head[1:] = nxt[at[:-1]] != at[1:]
                k = np.arange(len(at))
                at = at[(k - np.maximum.accumulate(np.where(head, k, 0))) % 2 == 0]
            right = nxt[at]
            after = nxt[right]
            symbol[at], symbol[right], nxt[at] = made, -1, after
            inner = after >= 0
            prv[after[inner]] = at[inner]
            before = prv[at]
            self._note(np.concatenate([at[inner], before[before >= 0]]))
        return symbol


class Encoder:
    """Encodes whole texts; distinct spans are merged once and kept for later texts."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.cached = spans.Cached(CUTS, self._merge)
        self.special = {s.encode(): i for s, i in self.v.special.items()}
        self.split = regex.compile(b"(" + b"|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + b")")

    def _merge(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = [], []
        for w in new:
            parts = PATTERN.findall(w.decode("utf-8", "surrogatepass"))
            words.extend(parts)
            counts.append(len(parts))
        buf, offsets = spans.join([w.encode("utf-8", "surrogatepass") for w in words])
        out = PairIndex(self.v, self.v.base[buf], offsets[:-1]).run()
        left = out >= 0
        total = np.concatenate([[0], np.cumsum(left)])[offsets]  # tokens before each word
        ends = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])
        return out[left], np.diff(total[ends])

    def encode(self, texts: list[bytes]):
        """For slices of the texts in order: (slice, ids one text after another, offsets of the texts)."""
        if not any(s in t for s in self.special for t in texts):
            yield from self.cached.lists(texts)
            return
        pieces, owner, then = [], [], []  # a special token's string splits its text
        for k, t in enumerate(texts):
            parts = self.split.split(t)
            for i in range(0, len(parts), 2):
                pieces.append(parts[i])
                owner.append(k)
                then.append(self.special[parts[i + 1]] if i + 1 < len(parts) else -1)
        found = list(self.cached.lists(pieces))
        ids = np.concatenate([f for _, f, _ in found])
        n = np.concatenate([np.diff(e) for _, _, e in found])
        then = np.array(then)
        ids = np.insert(ids, np.cumsum(n)[then >= 0], then[then >= 0])
        per = np.bincount(np.array(owner), n + (then >= 0), len(texts)).astype(np.int64)
        yield slice(0, len(texts)), ids, np.concatenate([[0], np.cumsum(per)])

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The decoded texts in UTF-8."""
        flat, at = self.v.bytes.take(ids)
        raw, at = flat.tobytes(), at[ends].tolist()
        return [raw[x:y].decode("utf-8", "replace").encode() for x, y in zip(at, at[1:])]


def encoder(path: str) -> Encoder:
    store = kept("bpe")
    if path not in store:
        store[path] = Encoder(path)
    return store[path]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_decode(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each whole text; with keep_ids also ids array<int> and decoded string."""
    ready(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids

    def work(batches):
        enc = encoder(path or vocabulary_path())
        for b in spans.grouped(batches, 1):
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            n, hashes, plain, kept, text = [], [], [], [], []
            for _, ids, ends in enc.encode(texts):
                raw, at = ids.astype("<u4").tobytes(), ends.tolist()
                decoded = enc.decode(ids, ends)
                n.extend(np.diff(ends).tolist())
                hashes.extend(hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in zip(at, at[1:]))
                plain.extend(hashlib.sha256(t).hexdigest() for t in decoded)
                if keep_ids:
                    kept.extend(ids[x:y].tolist() for x, y in zip(at, at[1:]))
                    text.extend(t.decode() for t in decoded)
            columns = {"doc_id": b.column(0).cast(pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(hashes, pa.string()), "decoded_sha256": pa.array(plain, pa.string())}
            if keep_ids:
                columns |= {"ids": pa.array(kept, pa.list_(pa.int32())), "decoded": pa.array(text, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(work, schema)
