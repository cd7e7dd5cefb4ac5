"""WARC, media columns and token files."""

import hashlib
import io
import zlib

import numpy as np
import pytest

from tokenmix.llm import media, tokenfile, warc, webp
from tokenmix.llm.common import shared_dir

from .conftest import ODD

PAGES = [(5, "u5", "x" * 200), (3, None, "x" * 200), (3, "u3", "x" * 200), (9, "u9", "short"), (10, "u\r\n10", "short"), (None, "n", "x" * 200), (11, "u", None), (12, "u", ""), (13, "é", "ü" * 60), (14, "é", "ü" * 60), (None, "m", "y" * 100), (15, "u", "z" * 300_000)]


def test_warc_roundtrip(spark):
    got = {}
    out = warc.read(warc.write(spark.createDataFrame(PAGES, "page_id long, url string, html string"), shared_dir(spark, "warc")), with_block=True).collect()
    for r in out:
        got.setdefault(r["page_id"], []).append(r)
    assert len(out) == len(PAGES)
    for i, _, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        first = min(ids) if ids and len(raw) >= 100 else None
        again = first is not None and i != first
        for r in got[i]:
            if r["payload_digest"] == hashlib.sha256(raw).hexdigest():
                assert (r["payload_bytes"], r["record_type"], r["refers_to"]) == (len(raw), "revisit" if again else "response", first if again else None)
                assert bytes(r["block"]) == (b"" if again else raw)
    assert warc.roundtrip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_reader_is_incremental_and_strict():
    one = lambda b, **more: warc.member([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(b).hexdigest()), ("Content-Length", str(len(b)))], b)
    blocks = [b"a" * 5000, b"", b"\r\n\r\n", bytes(range(256)) * 40]
    data = b"".join(map(one, blocks))
    for size in (1, 7, 1 << 16):
        found = list(warc.records(io.BytesIO(data), size))
        assert [r.block for r in found] == blocks and found[1].offset == len(one(blocks[0]))
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(data[:-9])))
    for head, body in ((("Content-Length", "4"), b"12345"), (("Content-Length", "x"), b""), (("X", "1"), b"")):
        with pytest.raises(warc.WarcError):
            list(warc.records(io.BytesIO(warc.member([head], body))))
    with pytest.raises(warc.WarcError, match="digest"):
        list(warc.records(io.BytesIO(warc.member([("WARC-Payload-Digest", "sha256:0"), ("Content-Length", "1")], b"1"))))
    with pytest.raises(warc.WarcError):
        list(warc.records(io.BytesIO(b"no gzip at all")))


@pytest.mark.parametrize("seed", range(6))
def test_webp_all_features(seed):
    rng = np.random.default_rng(seed)
    for _ in range(6):
        h, w = rng.integers(1, 23, 2)
        colours = int(rng.choice([1, 2, 3, 4, 9, 16, 40, 1000]))
        image = rng.integers(0, 256, (colours, 4))[rng.integers(0, colours, (h, w))].astype(np.uint8)
        options = [dict(), dict(predictor=-1), dict(predictor=int(rng.integers(0, 14)), green=True), dict(cross=(int(rng.integers(0, 256)), 77, 5)), dict(cache=int(rng.integers(1, 12)), references=False), dict(cache=5), dict(block=2), dict(block=2, cache=3, predictor=-1, cross=(200, 100, 50), green=True)]
        for o in options + ([dict(palette=True), dict(palette=True, predictor=-1, cache=2)] if colours <= 256 else []):
            assert (webp.decode(webp.encode(image, **o)) == image).all(), o


def test_webp_of_others():
    """The widely published lossless probe image (one transparent pixel), which this code did not write."""
    import base64

    assert webp.decode(base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA==")).tolist() == [[[0, 0, 0, 0]]]


def test_webp_many_at_once():
    """Images with all kinds of features decoded in step, whatever their sizes."""
    rng = np.random.default_rng(9)
    images, files = [], []
    for k, o in enumerate([dict(), dict(palette=True), dict(predictor=-1, green=True), dict(cross=(3, 250, 9)), dict(cache=4), dict(block=2, cache=2), dict(palette=True, cache=3, references=False)]):
        image = rng.integers(0, 256, (5, 4))[rng.integers(0, 5, (3 + 2 * k, 29 - 3 * k))].astype(np.uint8)
        images.append(image)
        files.append(webp.encode(image, **o))
    assert all((a == b).all() for a, b in zip(webp.decode_many(files), images))


def test_webp_bulk_and_damage():
    rng = np.random.default_rng(1)
    many = [rng.integers(0, int(rng.integers(1, 256)) + 1, 24 * int(rng.integers(1, 60))).astype(np.uint8) for _ in range(40)] + [np.full(576, 255, np.uint8)]
    many.append(np.repeat(np.arange(20), [2**k for k in range(14)] + [1] * 6)[: 24 * 600].astype(np.uint8))  # a deep code
    words = [bytes(rng.integers(97, 123, int(rng.integers(2, 9))).astype(np.uint8)) + b" " for _ in range(80)]
    many += [np.frombuffer(b"".join(words[int(k)] for k in rng.integers(0, 80, 3000))[: 24 * 384], np.uint8) for _ in range(5)]  # like text
    many += [np.tile(np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8), 24 * 384 // 36), np.cumsum(rng.integers(0, 6, 24 * 60)).astype(np.uint8), np.frombuffer((b"0123456789ABCDEF" * 576)[: 24 * 384], np.uint8)]
    files = webp.store_many(many)
    assert all((a == b).all() for a, b in zip(webp.load_many(files), many))
    assert all((webp.decode(f)[..., 2].ravel() == m).all() for f, m in zip(files[:5], many))
    assert all((webp.decode(f)[..., [0, 1, 3]] == [255, 0, 0]).all() for f in files[-9:])
    assert len(files[-4]) < 0.7 * len(many[-4]) and len(files[-3]) < 300 and len(files[-1]) < 300
    # what the production files use
    first_kind = lambda f: (b := webp.Bits(webp._payload(f), 40)).read(1) and b.read(2) + 1
    used = [first_kind(f) for f in files]
    assert used[-1] == webp.PALETTE + 1 and used[-2] == webp.PREDICTOR + 1 and used[-4] == 0 and {0, webp.PALETTE + 1, webp.PREDICTOR + 1} <= set(used)
    for damaged in (webp.wrap(files[0][20:60]), webp.wrap(files[-4][20:200])):
        with pytest.raises(webp.WebpError):
            webp.load_many([files[1], damaged])
    with pytest.raises(webp.WebpError):
        webp.decode(b"RIFF0000WEBPVP8 " + b"\0" * 20)


def test_media_of_odd_rows(spark, odd, nothing):
    out = media.roundtrip(odd, keep_media=True).collect()
    assert len(out) == len(ODD) and media.roundtrip(nothing).count() == 0
    by = {}
    for r in out:
        text = next(t for i, t, _ in ODD if i == r["doc_id"])
        raw = (text or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-32:])
        stored = bytes(r["media"])
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert b"".join(webp.decode(f)[..., 2].tobytes() for f in media.split_media(stored)) == payload
        assert by.setdefault(raw, tuple(r)[1:]) == tuple(r)[1:]


def library(path):
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(path)


def test_token_files(spark, odd, nothing, tmp_path):
    rows = tokenfile.roundtrip(odd).collect()
    tok, start = library(tokenfile.vocabulary_path()), 0
    order = sorted(((i is not None, i or 0), t or "") for i, t, _ in ODD)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows))
    assert len(got) == len(ODD)
    for ((known, i), t), g in zip(order, got):
        ids = np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert g == (start, i if known else None, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert tokenfile.roundtrip(nothing).count() == 0


def test_token_files_roll_over(spark, tmp_path):
    """Small files in the same order: starts run on from file to file."""
    docs = spark.createDataFrame([(k, f"word {k} and some more " * (k % 9 * 300)) for k in range(60)], "doc_id long, text string").coalesce(1)
    manifest = tokenfile.write(docs, f"file://{tmp_path}/small", length=16, rows=4, most=500)
    assert manifest.count() > 3
    rows = sorted(map(tuple, tokenfile.read(manifest).collect()))
    assert rows == sorted(map(tuple, tokenfile.roundtrip(docs).collect())) and len(rows) == 60


def test_sequence_file_random_access(tmp_path):
    import pyarrow as pa

    url = f"file://{tmp_path}/x/ids.arrows"
    w, ids = tokenfile.Writer(url, 50_000, length=8, rows=3), np.arange(100)
    for a in range(0, 100, 10):
        w.add(pa.array([a]), ids[a : a + 10], np.array([0, 10]))
    assert w.close() == 100
    r = tokenfile.Reader(url)
    assert len(r) == 13 and r.flat(0).dtype == np.uint16 and r.count == 5
    for k in (12, 0, 5):
        some, mask = r.sequence(k)
        assert some.base is not None and len(some) == len(mask) == 8
        n = min(8, 100 - 8 * k)
        assert some[:n].tolist() == ids[8 * k : 8 * k + n].tolist() and mask.to_pylist() == [True] * n + [False] * (8 - n)
    assert r.ids(20, 30).tolist() == list(range(20, 50)) and r.ids(5, 0).tolist() == []
    big = tokenfile.Writer(f"file://{tmp_path}/big.arrows", 70_000)
    assert big.type == np.uint32


def test_library_encoder_equals_library():
    import random

    tok, enc, rnd = library(tokenfile.vocabulary_path()), tokenfile.LibraryEncoder(tokenfile.vocabulary_path()), random.Random(5)
    parts = ["a", "the", "'s", "'LL", " ", "  ", "\n", " ", "é", "́", "1", "٣", "!", "日本", "😀", "<|endoftext|>", "<|", "\x1c", "\x85", "J", "̌", "Σ", "İ", "ǅ", "K", "\x00"]
    texts = ["", "<|ENDOFTEXT|>"] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    got = [ids[a:b].tolist() for _, ids, ends in enc.encode([t.encode() for t in texts]) for a, b in zip(ends, ends[1:])]
    assert got == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
