"""SimHash classes, repeated passages, components and decontamination against brute force."""

import functools
import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tokenmix.llm import common, components, decontaminate, repeats, simhash, windows
from tokenmix.llm.bcr import Collection

from .conftest import ODD


def roots(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    rnd = random.Random(3)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(200, k) for k in range(201, 400)]
    edges = chain + star + [(rnd.randrange(400, 600), rnd.randrange(400, 600)) for _ in range(120)] + [(7, 7)]
    want = roots(600, edges)
    got = {r["u"]: r["v"] for r in components.stars(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == want[x] for x in range(600))
    assert components.stars(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hot_keys_change_nothing(spark, monkeypatch):
    """The same components and classes where hubs, fingerprints and roots are joined apart."""
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    monkeypatch.setattr(common, "SHARE", 20)
    rnd = random.Random(3)
    edges = [(200, k) for k in range(201, 400)] + [(k, 900 - k) for k in range(250, 300)] + [(rnd.randrange(400, 600), rnd.randrange(400, 600)) for _ in range(120)]
    want = roots(1000, edges)
    frame = spark.createDataFrame(edges, "u long, v long")
    assert common.hot_keys(frame.groupBy("u").count().withColumnRenamed("count", "n"), "u", len(edges)) == [200]
    got = {r["u"]: r["v"] for r in components.stars(frame).collect()}
    assert all(got.get(x, x) == want[x] for x in range(1000))
    rows = [(k, "the very same text of a third of all rows") for k in range(60)] + [(100 + k, f"other {k} words {k * 7} in {k * 13} here") for k in range(100)]
    out = simhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", simhash.hexadecimal("fp"), "component_id").collect()
    check_simhash(rows, [tuple(r) for r in out])


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())) if w]
    if not words:
        return 0
    h = [xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))


def check_simhash(rows, got):
    prints = [plain_fingerprint(t or "") for _, t in rows]
    root = roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2])
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i is not None, i or 0), f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root))
    assert sorted(((i is not None, i or 0), f, c) for i, f, c in got) == want


@pytest.mark.parametrize("crowd", [simhash.CROWD, 1])
def test_simhash(spark, crowd):
    rnd = random.Random(1)
    base = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(300)) for _ in range(6)]
    rows = [(i, t) for i, t, _ in ODD if i not in (7, 8, 9)]
    for k in range(120):
        w = rnd.choice(base).split()
        w[rnd.randrange(300)] = "Changed"
        rows.append((100 + k, " ".join(w) if k % 3 else rnd.choice(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.classes(df, crowd).select("doc_id", simhash.hexadecimal("fp"), "component_id").collect()
    check_simhash(rows, [tuple(r) for r in out])


def test_links_of_crowded_fingerprints(spark):
    rnd = random.Random(2)
    prints = {rnd.getrandbits(63)}
    while len(prints) < 300:  # chains of near fingerprints around few centres
        prints.add((rnd.choice(sorted(prints)[:40]) ^ (1 << rnd.randrange(64)) ^ (rnd.random() < 0.5) << rnd.randrange(63)) & (1 << 63) - 1)
    some = sorted(prints)
    want = roots(300, [(a, b) for a in range(300) for b in range(a) if (some[a] ^ some[b]).bit_count() <= 2])
    nodes = spark.createDataFrame([(x,) for x in some], "fp long")
    for crowd in (1, 3, 10_000):
        star = {r["u"]: r["v"] for r in components.stars(simhash.links(nodes, crowd)).collect()}
        assert [some.index(star.get(x, x)) for x in some] == want


def test_simhash_of_nothing_and_keep_one(spark, odd, nothing):
    assert simhash.classes(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.select("doc_id").collect())
    assert (True, 8) not in ids and len(ids) == len(set(ids)) and {(True, 1), (True, 4), (True, 5), (True, 7)} <= set(ids)


def test_keep_one_decides_by_row(spark):
    """Equal ids with other texts, null ids and repeated rows: one row per class of texts stays."""
    a, b, c = ("first text of seven words in here", "quite another one that shares no words", "and yet a third of them for null")
    keep = lambda rows: sorted((r[0] is not None, r[0] or 0, r[1]) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert keep([(5, a), (5, b)]) == [(True, 5, a), (True, 5, b)]
    assert keep([(3, b), (5, a), (5, b)]) == [(True, 3, b), (True, 5, a)]
    assert keep([(None, a), (None, b), (None, c), (None, c)]) == sorted([(False, 0, a), (False, 0, b), (False, 0, c)])
    assert keep([(9, a), (None, a), (9, a)]) == [(True, 9, a)]


def test_finer_masks_hold_every_close_pair():
    rnd = random.Random(12)
    for agreed in (0, 0xFFFF0000FFFF, *simhash._finer(0x00000000FFFFFFFF)[:2]):
        left = [k for k in range(64) if not agreed >> k & 1]
        for _ in range(300):
            flipped = sum(1 << k for k in rnd.sample(left, rnd.randint(1, 2)))
            assert any(not flipped & m for m in simhash._finer(agreed))


# --- repeated passages ---


def plain_repeats(rows, width=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            if raw[s : s + width] in seen:
                gone[s : s + width] = b"\1" * width
            seen.add(raw[s : s + width])
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def made_documents():
    rnd = random.Random(4)
    text = lambda n: "".join(rnd.choice("ab cdé") for _ in range(n))
    line, passage = text(60), text(330)
    rows = []
    for k in range(60):
        parts = [text(rnd.randint(0, 200)), line, text(rnd.randint(0, 150))]
        if k % 3 == 0:
            parts.append(passage[rnd.randint(0, 50) : rnd.randint(200, 330)])
        if k % 7 == 0:
            parts += [text(130)] * 2
        rows.append((k, "".join(parts)))
    return rows + [(200 + k, rows[6][1]) for k in range(5)] + [(300, "ab" * 300)]


@pytest.mark.parametrize("options", [{}, dict(block=3000, crowd=3), dict(block=700, sizes=(32, 100), crowd=10), dict(block=700, crowd=2, fan=3)])
def test_repeats(spark, options):
    rows = made_documents() + [(i, t) for i, t, _ in ODD if i not in (7, 8, 9)]
    got = repeats.measures(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(plain_repeats(rows), key=key)


def judged_by_hand(rows, folder, crowd=3, buckets=2):
    """n_removed of each of the rows, a block each, by the steps of ``repeats.run`` in this process."""
    sizes = repeats.SIZES
    blocks = [repeats.Block(pa.table({"doc_id": [i], "text": [t]})) for i, t in rows]
    waiting = {k: b.segments(sizes[0]) for k, b in enumerate(blocks)}
    entries = [repeats.mail(repeats._asked(s, k, 0, buckets, crowd)) for k, s in waiting.items()]
    boxes = []
    of = lambda t, **kv: t.filter(functools.reduce(pc.and_, [pc.equal(t.column(c), v) for c, v in kv.items()]))
    for level in range(len(sizes)):
        every = pa.concat_tables([repeats.mail([]), *entries])
        answers = pa.concat_tables([repeats._answers(x, level + 1 < len(sizes), crowd) for b in range(buckets) if (x := of(every, bucket=b)).num_rows] or [repeats.mail([])])
        sent = [repeats.mail(repeats._sent(s, k, level, of(answers, blk=k), buckets, sizes, crowd)) for k, s in waiting.items()]
        boxes += sent
        entries = [of(x, kind=repeats.ENTRY) for x in sent]
        waiting = {k: repeats._waiting(x, repeats.WIDTH) for k, s in zip(waiting, sent) if (x := of(s, kind=repeats.KEPT)).num_rows}
    box = pa.concat_tables(boxes)
    asked = of(box, kind=repeats.BYTES)
    gone = [of(box, kind=repeats.GONE)] + [repeats._judged(x, repeats.WIDTH, folder) for lv in range(len(sizes)) for b in range(buckets) if (x := of(asked, level=lv, bucket=b)).num_rows]
    gone = pa.concat_tables(gone)
    return [next(repeats._cut(b, of(gone, blk=k)))[0] for k, b in enumerate(blocks)]


def test_nothing_goes_by_hash_alone(monkeypatch, tmp_path):
    """All hashes folded to two bits: texts that differ stay whole, and what repeats still goes."""
    real, segments = windows.grams, windows.segments

    def folded(*args):
        s = segments(*args)
        s.same = s.same & np.uint64(1 << 63)
        return s

    monkeypatch.setattr(windows, "grams", lambda buf, k: real(buf, k) & np.uint64(3 << 62))
    monkeypatch.setattr(windows, "segments", folded)
    rnd = random.Random(14)
    text = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    line = text(70)
    unlike = [(k, text(100) + line + text(100)) for k in range(12)]
    assert judged_by_hand(unlike, f"file://{tmp_path}") == [0] * 12
    passage = text(140)
    rows = unlike + [(20, text(50) + passage + text(60)), (21, passage), (22, unlike[3][1]), (23, text(90) + passage * 2)]
    assert judged_by_hand(rows, f"file://{tmp_path}") == [r[2] for r in plain_repeats(rows)]


def test_repeats_in_long_texts(spark, odd, nothing):
    got = {r["doc_id"]: r for r in repeats.measures(odd).collect()}
    n = len(ODD[7][1])
    assert (got[8]["n_bytes"], got[8]["n_removed"], got[8]["n_spans"]) == (n, n, 1)
    assert got[9]["n_bytes"] - got[9]["n_removed"] == len(" changed ") and repeats.measures(nothing).count() == 0


def test_cut_texts_keeps_columns_and_characters(spark, odd, nothing):
    out = repeats.cut_texts(odd)
    assert out.columns == odd.columns and repeats.cut_texts(nothing).count() == 0
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    assert 8 not in ids and {1, 2, 3, 4, 7, 9} <= set(ids)
    assert next(r for r in rows if r["doc_id"] == 9)["text"] == " changed " and next(r for r in rows if r["doc_id"] == 9)["n_chars"] == 9
    assert repeats._whole("aéb".encode(), [(2, 4)]) == "aé".encode() and repeats._whole("aéb".encode(), [(1, 3)]) == b"ab"


def test_column_wise_construction(tmp_path):
    rng = np.random.default_rng(1)
    for _ in range(80):
        strings = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(0, 15))).astype(np.uint8)) for _ in range(int(rng.integers(1, 12)))]
        c = Collection(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), f"file://{tmp_path}", int(rng.integers(1, 60)))
        suffixes = sorted((s[j:], i, j) for i, s in enumerate(strings) for j in range(len(s) + 1))

        def common(a, b):
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            return k

        string, start, symbol, prefix = (np.concatenate(x).tolist() for x in zip(*c.entries()))
        assert prefix == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]
        assert [strings[s][j:] for s, j in zip(string, start)] == [x for x, _, _ in suffixes]
        assert [(s, j) for s, j, x in zip(string, start, symbol) if x == 0] == [(s, j) for s, j in zip(string, start) if j == 0]
        string, start, kind = c.classes(3)
        by = {}
        for s, j, k in zip(string.tolist(), start.tolist(), kind.tolist()):
            by.setdefault(strings[s][j : j + 3], set()).add(k)
        assert all(len(v) == 1 for v in by.values()) and len(set.union(set(), *by.values())) == len(by)
        c.close()
    assert not os.listdir(tmp_path)


def test_construction_over_all_bytes(tmp_path):
    strings = [bytes(range(256)), bytes(range(100, 200)) * 2]
    c = Collection(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), f"file://{tmp_path}", 50)
    string, start, kind = c.classes(100)
    pairs = {}
    for s, j, k in zip(string.tolist(), start.tolist(), kind.tolist()):
        pairs.setdefault(k, []).append((s, j))
    assert sorted(sorted(v) for v in pairs.values() if len(v) > 1) == [[(0, 100), (1, 0), (1, 100)]]


@pytest.mark.parametrize("k", [32, 64, 100])
def test_segments_cover_every_window_once(k):
    rnd = random.Random(k)
    texts = [bytes(rnd.choice(b"abc") for _ in range(rnd.choice([0, 50, 99, 100, 101, 700]))) for _ in range(30)] + [b"a" * 400]
    s = windows.segments(texts, 100, k)
    got = sorted((r, x) for r, a, n in zip(s.row.tolist(), s.start.tolist(), s.n.tolist()) for x in range(a, a + n))
    assert got == [(i, x) for i, t in enumerate(texts) for x in range(len(t) - 99)]
    where = {}
    for r, a, n, anchor in zip(s.row.tolist(), s.start.tolist(), s.n.tolist(), s.anchor.tolist()):
        for x in range(a, a + n):
            assert where.setdefault(texts[r][x : x + 100], anchor) == anchor


# --- decontamination ---


def plain_hits(text, items):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if w]
    w, hit, found = split(text), set(), set()
    for i, t in items:
        v = split(t)
        for s in range(max(1, len(v) - 9) if v else 0):
            win = v[s : s + 10]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(i)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination(spark, odd, nothing, most):
    rnd = random.Random(6)
    vocabulary = ["the", "of", "a", "x1", "é", "Zed", "rare"] + [f"w{k}" for k in range(15)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(1, text(14)), (2, text(10)), (30, text(3)), (4, None), (5, "!!"), (6, text(12)), (6, text(11)), (None, text(12))]
    items.append((7, items[0][1]))
    some = [(i, t) for i, t, _ in ODD if i not in (7, 8, 9)]
    for k in range(60):
        src = (rnd.choice(items)[1] or "").split()
        some.append((100 + k, ", ".join([text(rnd.randint(0, 9)), " ".join(src[: rnd.randint(8, 14)]).upper(), text(5), " ".join(src[2:])])))
    docs, bench = spark.createDataFrame(some, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.measures(docs, bench, most=most).collect()
    want = []
    for i, t in some:
        n, hit, found = plain_hits(t, items)
        want.append((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key) and any(w[2] for w in want)
    clean = decontaminate.keep_clean(odd, bench)
    assert clean.columns == odd.columns and clean.count() == sum(not plain_hits(t, items)[1] for _, t, _ in ODD)
    assert decontaminate.measures(nothing, bench).count() == 0
    empty = decontaminate.measures(docs, bench.limit(0)).collect()
    assert len(empty) == len(some) and not any(r["contaminated"] for r in empty)
