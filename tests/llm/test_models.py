"""Language ID, quality, BPE and licences."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmix.llm import bpe, langid, licences, pieces, quality
from tokenmix.llm.common import held_out, table

from .conftest import ODD


def test_forward_algorithm_sums_all_segmentations():
    rng = np.random.default_rng(1)
    some = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb", "bb"]
    prob = rng.random((len(some), 2))
    model = pieces.Model(some, ["x", "y"], prob)

    def total(text, lang):
        if not text:
            return 1.0
        return sum((prob[some.index(text[:k]), lang] if text[:k] in some else pieces.Model.UNKNOWN if k == 1 else 0.0) * total(text[k:], lang) for k in range(1, len(text) + 1))

    words = ["a", "ab", "abba", "c", "acb", "bbbb", "", "a" * 32]
    got = model.log_words(words, pieces.Lookup(some))
    for w, row in zip(words[:-1], got):
        assert np.allclose(np.exp(row), [total("▁" + w, k) for k in (0, 1)])
    assert np.isfinite(got).all()


def test_scores_of_whole_texts():
    """Texts with words of any length against sums over all segmentations in exact arithmetic."""
    from fractions import Fraction

    rnd = random.Random(5)
    some = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb", "bb", "ababababababababababab"]
    prob = np.array([[rnd.randint(1, 99) / 128 for _ in range(3)] for _ in some])
    model = pieces.Model(some, ["x", "y", "z"], prob)
    exact = [[Fraction(float(p)) for p in row] for row in prob]

    def total(word, lang):
        sums = [Fraction(1)]
        for end in range(1, len(word) + 1):
            here = Fraction(0)
            for start in range(end):
                s = word[start:end]
                here += sums[start] * (exact[some.index(s)][lang] if s in some else Fraction(model.UNKNOWN) if len(s) == 1 else 0)
            sums.append(here)
        return sums[-1]

    def ln(f):
        return np.log(float(f.numerator >> max(0, f.numerator.bit_length() - 900))) + max(0, f.numerator.bit_length() - 900) * np.log(2) - np.log(float(f.denominator >> max(0, f.denominator.bit_length() - 900))) - max(0, f.denominator.bit_length() - 900) * np.log(2)

    words = ["".join(rnd.choice("abc") for _ in range(n)) for n in (1, 5, 31, 32, 33, 34, 60, 130)] + ["ab" * 40, "c" * 200]
    got = model.log_words(words, pieces.Lookup(some))
    want = [[ln(total("▁" + w, k)) for k in range(3)] for w in words]
    assert np.allclose(got, want, rtol=1e-9)
    old = pieces.STEPS
    try:
        pieces.STEPS = 7  # parts shorter than the longest piece
        assert np.allclose(model.log_words(words, pieces.Lookup(some)), want, rtol=1e-9)
    finally:
        pieces.STEPS = old
    texts = ["ab abb " + words[7], "A\tB " + words[8] + " ab", "abba", None, "12 .", "a a a a"]
    pred, score = pieces.Scorer(model, "t").predict(texts)
    for t, p, s in zip(texts, pred, score):
        if t in (None, "12 ."):
            assert (p, s) == ("und", 0.0)
            continue
        logs = [sum(ln(total("▁" + w, k)) for w in t.lower().split()) for k in range(3)]
        shares = np.exp(np.array(logs) - max(logs))
        assert p == "xyz"[int(np.argmax(logs))] and abs(s - shares.max() / shares.sum()) < 1e-9
    same = pieces.Model(some, ["x", "y"], prob[:, :1].repeat(2, 1))
    assert pieces.Scorer(same, "u").predict(["ab " + "ab" * 30]) == (["x"], [0.5])  # a tie


def test_expectation_maximisation_prefers_what_is_seen():
    model = pieces.fit(["▁", "▁th", "e", "t", "h", "▁de", "r", "d", "▁"][:8], {"de": {"der": 10.0}, "en": {"the": 10.0}})
    s = pieces.Scorer(model, "k")
    assert s.predict(["the the", "der", "", None, "12 !", "The"])[0] == ["en", "de", "und", "und", "und", "en"]
    assert np.allclose(model.prob[:8].sum(0), 1)
    assert pieces.words_of("A" * 70) == ["a" * 70] and [len(b) for b in pieces.blocks_of("A" * 70)] == [32, 32, 6]


def test_language_of_held_out_documents(spark, sf):
    docs = table(spark, sf, "documents")
    out = langid.identify(docs, langid.train(docs)).where(held_out(F.col("doc_id")))
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert right >= 0.95 * n


def test_language_of_odd_rows(spark, odd, nothing):
    model = langid.train(odd)
    out = langid.identify(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    got = {(r["doc_id"], r["lang_pred"] == "und", 0 <= r["score"] <= 1) for r in out.collect()}
    assert {i for i, und, _ in got if und} == {1, 2, 3, 12} and all(ok for _, _, ok in got) and out.count() == len(ODD)
    assert langid.identify(nothing, model).count() == 0
    none = langid.train(nothing)
    assert none.langs == [] and {r["lang_pred"] for r in langid.identify(odd, none).collect()} == {"und"}


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    rows = [(r["score"], r["quality"]) for r in out.select("score", "quality").collect()]
    good, bad = [s for s, q in rows if q], [s for s, q in rows if not q]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(7, 1, 0), (8, 1, 0), (4, 0, 0), (12, 0, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.where("quality = 1"), labels.limit(0)):
        out = quality.score(odd, quality.train(odd, lab)).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
        empty = {r["score"] for r in out if not r["text"]}
        assert len(empty) == 1
    assert quality.score(nothing, quality.train(odd, labels)).count() == 0


def test_quality_scores_equal_brute_force(spark):
    """Compressed sizes chunk by chunk, a calibration that solves its equations, and scores from both."""
    import zstandard

    rnd = random.Random(21)
    good, bad = ["careful", "sentence", "argument", "evidence", "result"], ["click", "now", "free", "win", "$$$"]
    rows = [(i, " ".join(rnd.choice((good if rnd.random() < 0.8 else bad) if i % 2 else (bad if rnd.random() < 0.8 else good)) for _ in range(rnd.randint(5, 300))), i % 2) for i in range(600)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    model = quality.train(docs.unionByName(docs), labels)

    def feature(text):
        size = {}
        for name, d in (("good", model.good), ("bad", model.bad)):
            size[name] = 0
            for k in range(0, len(text), 512):
                c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
                size[name] += len(c.compress(text[k : k + 512]))
        return (size["bad"] - size["good"]) / len(text) if text else 0.0

    seen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    fitted = [(feature(t.encode()), q) for i, t, q in seen if zlib.crc32(f"half {i}".encode()) % 2]
    x, y = np.array([f for f, _ in fitted]), np.array([q for _, q in fitted], float)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    p = 1 / (1 + np.exp(-(model.slope * x + model.offset)))
    assert abs(((target - p) * x / x.std()).sum() - 1e-3 * model.slope * x.std()) < 1e-5 and abs((target - p).sum() - 1e-3 * model.offset) < 1e-5
    for r in quality.score(docs, model).collect():
        want = 1 / (1 + np.exp(-np.clip(model.slope * feature(r["text"].encode()) + model.offset, -30, 30)))
        assert abs(r["score"] - want) < 1e-12 and r["predicted"] == (want >= 0.7)


def test_quality_learns_from_no_held_out_label(spark):
    rows = [(i, ("good words here " if zlib.crc32(str(i).encode()) % 4 != 2 else "HELD OUT ") * 20, i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    m = quality.train(docs, labels)
    assert b"HELD" not in m.good + m.bad


def test_bpe_equals_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.vocabulary_path()
    tok, enc, rnd = tokenizers.Tokenizer.from_file(path), bpe.Encoder(path), random.Random(8)
    parts = ["a", "the", "'s", "'LL", " ", "  ", "\n", "\t", " ", " ", "é", "́", "1", "٣", "!", "...", "日本", "😀", "<|endoftext|>", "<|", "\x1c", "\x85", "_", "A", "aaaaaaa", "\x00", "abab"]
    texts = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|>b"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    got, back = [], []
    for _, ids, ends in enc.encode(raw):
        got += [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
        back += enc.decode(ids, ends)
    want = tok.encode_batch(texts, add_special_tokens=False)
    assert got == [e.ids for e in want]
    assert back == [tok.decode(e.ids, skip_special_tokens=False).encode() for e in want] == raw


def test_bpe_of_odd_rows(spark, odd, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    import hashlib

    tok = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    rows = bpe.encode_decode(odd, keep_ids=True).collect()
    assert len(rows) == len(ODD) and bpe.encode_decode(nothing).count() == 0
    for r in rows:
        text = next(t for i, t, _ in ODD if i == r["doc_id"]) or ""
        ids = tok.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def plain_licences(text):
    """Dice of every unit and template, without pruning."""
    import re

    text = text or ""
    blocks = [*text.split("\n"), *(p for p in re.split(r"\n[ \t\r]*\n", text) if "\n" in p)]
    units = {*blocks, *(s for b in blocks for s in re.split(r"[.!?][ \t\r\n]+", b)), text}
    out = []
    for a in {frozenset(licences.bigrams_of(u)) for u in units}:
        for name, body in licences.TEMPLATES:
            b = set(licences.bigrams_of(body))
            if a and 2 * len(a & b) / (len(a) + len(b)) >= licences.LEAST:
                out.append((round(2 * len(a & b) / (len(a) + len(b)), 6), name))
    return out


def test_licences(spark, odd, nothing):
    rnd = random.Random(9)
    texts = [t for _, t, _ in ODD]
    for _, body in licences.TEMPLATES:
        w = body.split()
        for k in range(4):
            v = [x for x in w if rnd.random() > 0.04 * k]
            texts += [" ".join(v).upper(), "intro\n\n" + "\n".join(" ".join(v[i : i + 9]) for i in range(0, len(v), 9)) + "\n\nmore"]
    texts += ["Copyright 2020 Foo. Licensed under the MIT License.", "x = 1\nReleased under the MIT License. See LICENSE for details.\ny = 2", "Redistributions of source code must retain the above copyright notice,\nthis list of conditions and the following disclaimer. And so on\ncode()"]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits = 0
    for r in got:
        want = plain_licences(r["text"])
        hits += bool(want)
        best = min(((-d, n) for d, n in want), default=(0.0, None))
        assert (r["n_matches"], r["licences"], r["best_licence"], r["best_dice"]) == (len(want), ",".join(sorted({n for _, n in want})), best[1], -best[0]), r["text"]
        assert r["best_licence"] or r["text"] not in texts[-3:]
    assert hits > 100
    assert licences.scan(nothing).count() == 0 and licences.scan(odd).count() == len(ODD)
