"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary of pieces is given (a sentencepiece model file). For each language a
probability of every piece is learned by expectation maximisation; the score of a word is the sum over
*all* its segmentations into pieces of the product of piece probabilities (forward algorithm), the score
of a text the sum of the logarithms over its words.

A word is a maximal run without white space, lower-cased, after a word-start mark. Words of up to ``SHORT`` characters are scored
many at a time and kept; of longer ones (whole texts, in scripts without spaces) the same sum is carried along ``STEPS`` characters at a time,
scaled on the way, so memory does not depend on the length. (Learning, which is from a bounded sample, cuts such runs into blocks of SHORT.)

Defined cases: null or letterless text -> ``und`` with score 0; no learnable language at all -> ``und``;
ties go to the first language in code-point order; repeated rows each get a result; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import regex

from .common import kept

MARK = "▁"
SHORT = 32
#: Characters of long words that are taken at a time, and after how many of them the sums are scaled.
STEPS, SCALE = 512, 8
UND = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_LETTER = regex.compile(r"\p{L}")


def vocabulary(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model (no control, unknown or byte pieces), lower-cased, distinct."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = (sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
    return sorted({p for p in kept if p})


class Lookup:
    """Piece id of a substring hash: two direct-address tables, the second for what collides in the first."""

    BITS = 19

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)
        h = np.array([self._hash_one(p) for p in pieces], np.uint64)
        assert len(set(h.tolist())) == len(pieces)
        self.hash = np.concatenate([h, np.zeros(1, np.uint64)])
        shift = np.uint64(64 - self.BITS)
        self.first = np.full(1 << self.BITS, self.size, np.int32)
        slot = (h >> shift).astype(np.int64)
        self.first[slot] = np.arange(self.size)
        rest = np.nonzero(self.first[slot] != np.arange(self.size))[0]
        self.second = {int(h[i]): int(i) for i in rest}
        self.rest_h = np.array(sorted(self.second), np.uint64)
        self.rest_i = np.array([self.second[int(x)] for x in self.rest_h], np.int32)

    @staticmethod
    def _hash_one(piece: str) -> int:
        x = 0
        for c in piece:
            x = (x * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return Lookup._finish(np.array([x], np.uint64), len(piece))[0]

    @staticmethod
    def _finish(h: np.ndarray, length: int) -> np.ndarray:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(length)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)

    def ids(self, h: np.ndarray, length: int) -> np.ndarray:
        """size where the substring is no piece."""
        h = self._finish(h, length)
        i = self.first[(h >> np.uint64(64 - self.BITS)).astype(np.int64)]
        miss = self.hash[i] != h
        if miss.any():
            i = np.where(miss, self.size, i)
            if len(self.rest_h):
                w = np.nonzero(miss)
                k = np.minimum(np.searchsorted(self.rest_h, h[w]), len(self.rest_h) - 1)
                i[w] = np.where(self.rest_h[k] == h[w], self.rest_i[k], self.size)
        return i


def words_of(text: str) -> list[str]:
    return text.lower().split()


def blocks_of(text: str) -> list[str]:
    """The words, longer ones in blocks of SHORT characters."""
    return [w[i : i + SHORT] for w in words_of(text) for i in range(0, len(w), SHORT)]


def _codes(words: list[str], n: int) -> np.ndarray:
    """Code points of the strings, with zeros after a shorter one's end."""
    return np.frombuffer("".join(w.ljust(n, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.uint64)


def _hashed(codes: np.ndarray, lookup: Lookup):
    """Gives ids(end, length): piece ids of the substrings of all rows that end there."""
    n = codes.shape[1]
    prefix = np.zeros((n + 1, len(codes)), np.uint64)
    power = [np.uint64(1)]
    with np.errstate(over="ignore"):
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + codes[:, i] + np.uint64(1)
            power.append(power[-1] * _BASE)
    return lambda end, k: lookup.ids(prefix[end] - prefix[end - k] * power[k], k)


def _edges(words: list[str], lookup: Lookup):
    """For words of one length n (without the mark): (n+1, {(end, length): piece ids})."""
    n = len(words[0]) + 1
    ids = _hashed(_codes([MARK + w for w in words], n), lookup)
    return n, {(end, k): ids(end, k) for end in range(1, n + 1) for k in range(1, min(end, lookup.longest) + 1)}


def by_length(words: list[str]):
    """Indices of the words by their number of characters."""
    n = np.array([len(w) for w in words], np.int64)
    order = np.argsort(n, kind="stable")
    cuts = np.nonzero(np.diff(n[order]))[0] + 1
    return [x for x in np.split(order, cuts) if len(x)]


class Model:
    """langs, and prob[piece, lang] with two more rows: unknown single character, and zero (no edge)."""

    UNKNOWN = 1e-7

    def __init__(self, pieces: list[str], langs: list[str], prob: np.ndarray):
        self.pieces, self.langs = pieces, langs
        unknown = np.full((1, len(langs)), self.UNKNOWN)
        self.prob = np.concatenate([prob, np.zeros((1, len(langs))), unknown])

    def log_words(self, words: list[str], lookup: Lookup) -> np.ndarray:
        """ln of the sum over all segmentations, for each word and language."""
        out = np.empty((len(words), len(self.langs)))
        for some in by_length(words):
            if len(words[some[0]]) > SHORT:
                continue
            for i in range(0, len(some), 4096):
                at = some[i : i + 4096]
                n, edges = _edges([words[k] for k in at], lookup)
                alpha = [np.ones((len(at), len(self.langs)))]
                for end in range(1, n + 1):
                    total = np.zeros_like(alpha[0])
                    for k in range(1, min(end, lookup.longest) + 1):
                        ids = edges[end, k]
                        if k == 1:  # a character outside the vocabulary is a piece of its own
                            ids = np.where(ids == lookup.size, lookup.size + 1, ids)
                            total += alpha[end - 1] * self.prob[ids]
                        else:
                            rows = np.nonzero(ids != lookup.size)[0]
                            if len(rows):
                                total[rows] += alpha[end - k][rows] * self.prob[ids[rows]]
                    alpha.append(total)
                out[at] = np.log(np.maximum(alpha[n], 1e-300))
        long = sorted((k for k, w in enumerate(words) if len(w) > SHORT), key=lambda k: -len(words[k]))
        for i in range(0, len(long), 256):
            out[long[i : i + 256]] = self._log_long([words[k] for k in long[i : i + 256]], lookup)
        return out

    def _log_long(self, words: list[str], lookup: Lookup) -> np.ndarray:
        """The same for words by falling length."""
        width, langs = lookup.longest, len(self.langs)
        lens = np.array([len(w) + 1 for w in words])
        out, logs = np.empty((len(words), langs)), np.zeros((len(words), langs))
        last = np.zeros((width, len(words), langs))  # the sums up to the places before, the latest at the end; scaled by exp(logs)
        last[-1] = 1
        lengths = np.arange(width, 0, -1)
        for x in range(0, int(lens[0]), STEPS):
            live = int(np.count_nonzero(lens > x))
            last, logs = last[:, :live], logs[:live]
            begin, n = max(0, x - width), min(STEPS, int(lens[0]) - x)
            ids = _hashed(_codes([(MARK + w)[begin : x + n] for w in words[:live]], x + n - begin), lookup)
            sums = np.concatenate([last, np.empty((n, live, langs))])
            for i in range(n):
                end = x - begin + i + 1  # within the part
                known = np.stack([ids(end, k) if k <= end else np.full(live, lookup.size) for k in lengths])
                known[-1] = np.where(known[-1] == lookup.size, lookup.size + 1, known[-1])
                sums[width + i] = np.einsum("krl,krl->rl", sums[i : i + width], self.prob[known])
                done = np.nonzero(lens[:live] == x + i + 1)[0]
                out[done] = np.log(np.maximum(sums[width + i, done], 1e-300)) + logs[done]
                if i % SCALE == SCALE - 1 or i == n - 1:
                    top = np.maximum(sums[width + i], 1e-300)
                    sums[i + 1 : width + i + 1] /= top
                    logs = logs + np.log(top)
            last = sums[n:]
        return out


def fit(pieces: list[str], counts: dict[str, dict[str, float]], rounds: int = 3, smooth: float = 0.05) -> Model:
    """EM over weighted words per language. counts: lang -> word -> weight."""
    lookup = Lookup(pieces)
    longest, langs = lookup.longest, sorted(counts)
    prob = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    prepared = []
    for j, lang in enumerate(langs):
        words = sorted(counts[lang])
        for some in by_length(words):
            for i in range(0, len(some), 4096):
                at = some[i : i + 4096]
                weight = np.array([counts[lang][words[k]] for k in at], float)
                prepared.append((j, weight, *_edges([words[k] for k in at], lookup)))
    for _ in range(rounds):
        model = Model(pieces, langs, prob)
        expect = np.full((len(pieces) + 2, len(langs)), 0.0)
        for j, weight, n, edges in prepared:
            p = model.prob[:, j]
            real = {e: np.where((ids == lookup.size) & (e[1] == 1), lookup.size + 1, ids) for e, ids in edges.items()}
            alpha, beta = [np.ones(len(weight))], {n: np.ones(len(weight))}
            for end in range(1, n + 1):
                alpha.append(sum(alpha[end - k] * p[real[end, k]] for k in range(1, min(end, longest) + 1)))
            for start in range(n - 1, -1, -1):
                beta[start] = sum(beta[end] * p[real[end, end - start]] for end in range(start + 1, min(n, start + longest) + 1))
            scale = weight / np.maximum(alpha[n], 1e-300)
            for (end, k), ids in real.items():
                expect[:, j] += np.bincount(ids, alpha[end - k] * p[ids] * beta[end] * scale, len(expect))
        seen = expect[: len(pieces)] + smooth
        prob = seen / seen.sum(0)
    return Model(pieces, langs, prob)


CACHE_WORDS = 300_000


class Scorer:
    """Scores whole texts; the words' scores are kept for later texts, up to CACHE_WORDS of them."""

    def __init__(self, model: Model, key: str):
        self.model, self.key = model, key
        self.lookup = Lookup(model.pieces)
        self._reset()

    def _reset(self):
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)))

    @classmethod
    def of(cls, model: Model, key: str) -> "Scorer":
        store = kept("langid")
        if key not in store:
            store.clear()
            store[key] = cls(model, key)
        return store[key]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs = self.model.langs
        if not langs:
            return [UND] * len(texts), [0.0] * len(texts)
        if len(self.index) > CACHE_WORDS:
            self._reset()
        index, fresh, rows, long = self.index, [], [], {}
        for t in texts:
            words, more = words_of(t) if t else [], []
            for w in set(words):
                if len(w) > SHORT:  # not kept
                    long.setdefault(w, len(long))
                    more.append(w)
                elif w not in index:
                    index[w] = len(index)
                    fresh.append(w)
            if more:
                more = [long[w] for w in words if len(w) > SHORT]
                words = [w for w in words if len(w) <= SHORT]
            rows.append((np.fromiter(map(index.__getitem__, words), np.int64, len(words)), more))
        if fresh:
            self.scores = np.concatenate([self.scores, self.model.log_words(fresh, self.lookup)])
        long_scores = self.model.log_words(list(long), self.lookup)
        pred, score = [], []
        for t, (r, more) in zip(texts, rows):
            if not t or not _LETTER.search(t):
                pred.append(UND)
                score.append(0.0)
                continue
            total = self.scores[r].sum(0) + long_scores[more].sum(0)
            total = total - total.max()
            e = np.exp(total)
            k = int(np.argmax(total))
            pred.append(langs[k])
            score.append(float(e[k] / e.sum()))
        return pred, score
