"""Near duplicates of the pipeline against brute force."""

import random

import pytest

from tokenmix.llm import near, simhash

from .test_dedup import roots


def plain_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_classes(texts):
    sets = [plain_set(t) for t in texts]
    alike = lambda a, b: a == b or 10 * len(a & b) >= 8 * len(a | b)
    return roots(len(sets), [(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j])])


def made_texts():
    rnd = random.Random(11)
    words = lambda n: [f"w{rnd.randrange(500)}" for _ in range(n)]
    texts, bases = ["", None, " \t", "One two", "one TWO", "three"], [words(n) for n in (5, 9, 30, 80, 200, 400)]
    for k in range(300):
        w = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, 1 + len(w) // 30)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(40)}"
        texts.append(" ".join(w + (words(rnd.randint(0, len(w) // 5)) if k % 4 == 0 else [])))
    return texts


@pytest.mark.parametrize("crowd", [1, near.CROWD, 10_000])
def test_near_classes_equal_brute_force(spark, crowd):
    texts = made_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["root"] for r in near.classes(df, crowd).collect()}
    least = {}
    for i in sorted(got):
        least.setdefault(got[i], i)
    assert [least[got[i]] for i in range(len(texts))] == plain_classes(texts)


def test_near_copies_go(spark):
    """4 of 330 words changed (306 of 346 shingles) make over 2 bits of a fingerprint, and still a near copy; 25 changed (201 of 451) make none."""
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(3000)}" for _ in range(330)]
    changed = lambda n: " ".join(f"new{k}" if k % (330 // n) == 7 else w for k, w in enumerate(base))
    texts = [" ".join(base), changed(4), changed(25)]
    bits = [int(x) for x in simhash.fingerprint_many([t.encode() for t in texts])]
    assert (bits[0] ^ bits[1]).bit_count() > simhash.DISTANCE
    kept = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_near_duplicates_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = [rows[k][0] for k in sorted(set(plain_classes([t for _, t in rows])))]
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == want


def test_one_row_of_each_class(spark):
    """Null ids and ids that occur with different texts: a class is a class of texts, whatever the ids."""
    rnd = random.Random(13)
    text = lambda: " ".join(f"w{rnd.randrange(3000)}" for _ in range(40))
    alone, twice, shared, other = [text() for _ in range(50)], text(), text(), text()
    rows = [(None, t) for t in alone] + [(None, twice)] * 2 + [(1, shared), (1, other), (1, other), (2, other + " more"), (3, twice), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k long")
    kept = simhash.keep_one(docs)
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = [(None, t) for t in alone] + [(1, shared), (1, other), (3, twice)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted((r for r in got if r[0] != 4), key=key) == sorted(want, key=key) and sum(i == 4 for i, _ in got) == 1
    assert kept.columns == docs.columns


def test_the_stage_finds_near_copies_by_fingerprints(spark, monkeypatch):
    """Without the prefixes, fingerprints alone hold near copies that are 6 or fewer bits apart, and what is close but not similar stays apart."""
    rnd = random.Random(14)
    words = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    texts = []
    for _ in range(40):
        base = words(400)
        texts += [" ".join(base), " ".join([*base[:200], "changed", *base[201:]]), " ".join(words(400))]
    prints = [int(x) for x in near.fingerprints([near.shingle_set(t) for t in texts])]
    bits = lambda i, j: (prints[i] ^ prints[j]).bit_count()
    close = [k for k in range(0, 120, 3) if bits(k, k + 1) <= simhash.WIDE_DISTANCE]
    assert len(close) > 30
    monkeypatch.setattr(near, "prefix", lambda shingles, counts: shingles[:0])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["root"] for r in near.classes(df).collect()}
    assert all(got[k] == got[k + 1] for k in close)
    assert len(set(got.values())) == 120 - sum(got[k] == got[k + 1] for k in range(0, 120, 3))


@pytest.mark.parametrize("bucket", [1, simhash.BUCKET])
def test_nearest_fingerprints(spark, bucket):
    """All that have one of 6 or fewer bits below them have their closest one; in crowded blocks only what is close is found."""
    rnd = random.Random(15)
    prints = {rnd.getrandbits(64) for _ in range(40)}
    for x in sorted(prints):
        for n in (1, 3, 6, 9, 14):
            prints.add(x ^ sum(1 << k for k in rnd.sample(range(64), n)))
    some = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    distance = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    got = {r["u"]: r["v"] for r in simhash.nearest(spark.createDataFrame([(x,) for x in some], "fp long"), bucket).collect()}
    assert got and all(v < u and distance(u, v) <= simhash.WIDE_MOST for u, v in got.items())
    if bucket > 1:
        for k, u in enumerate(some):
            least = min((distance(u, v) for v in some[:k]), default=64)
            assert least > simhash.WIDE_DISTANCE or distance(u, got[u]) == least


def rows_of_joins(spark, done):
    """How many rows the joins of the executions after those of done have made."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    runs = store.executionsList()
    for run in (i for i in (runs.apply(k).executionId() for k in range(runs.size())) if i not in done):
        done.add(run)
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (x for x in (nodes.apply(k) for k in range(nodes.size())) if "Join" in x.name()):
            for m in (node.metrics().apply(k) for k in range(node.metrics().size())):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return total


@pytest.mark.parametrize("crowd", [1, simhash.CROWD])
def test_a_group_of_close_fingerprints_makes_few_pairs(spark, crowd):
    """400 fingerprints of 10 or fewer bits from each other (79,800 pairs): each has its closest one, and joins give far less than all pairs."""
    rnd = random.Random(17)
    base, free = rnd.getrandbits(64), rnd.sample(range(48), 24)  # two blocks of eight bits are those of all
    prints = {base}
    while len(prints) < 400:
        prints.add(base ^ sum(1 << k for k in rnd.sample(free, rnd.randint(1, 5))))
    prints |= {rnd.getrandbits(64) for _ in range(40)}
    some = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    distance = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    rows_of_joins(spark, done := set())
    got = {r["u"]: r["v"] for r in simhash.nearest(spark.createDataFrame([(x,) for x in some], "fp long"), crowd=crowd).collect()}
    made = rows_of_joins(spark, done)
    for k, u in enumerate(some):
        least = min((distance(u, v) for v in some[:k]), default=64)
        assert least > simhash.WIDE_DISTANCE or distance(u, got[u]) == least
    assert len(got) >= 390 and all(v < u and distance(u, v) <= simhash.WIDE_MOST for u, v in got.items())
    assert 0 < made < 90 * len(some), made  # placing them by blocks and joining the sizes makes up to 28 + 6 + 15 rows of each


def test_close_fingerprints_in_the_largest_crowds(spark):
    """Where more agree than are joined, the closest one of four or fewer bits is still found."""
    rnd = random.Random(18)
    base, free = rnd.getrandbits(64), rnd.sample(range(48), 12)
    some = sorted(x - (1 << 64) if x >> 63 else x for x in {base ^ sum(1 << k for k in rnd.sample(free, rnd.randint(0, 5))) for _ in range(200)})
    distance = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    got = {r["u"]: r["v"] for r in simhash.nearest(spark.createDataFrame([(x,) for x in some], "fp long"), 10).collect()}
    for k, u in enumerate(some):
        least = min((distance(u, v) for v in some[:k]), default=64)
        assert least > 4 or distance(u, got[u]) == least


def test_fingerprints_that_agree_by_chance_are_no_rows(spark):
    """8,000 fingerprints of which 125 agree in any two blocks (a table of 1/500 of what would give as many by chance): joins have at most a row for each of seven blocks, not for pairs of blocks, and each has its closest one."""
    rnd = random.Random(19)
    some = near.np.array(sorted({sum(rnd.randrange(8) << 8 * k + k for k in range(7)) + (rnd.randrange(8) << 56) for _ in range(8000)}), near.np.int64)
    rows_of_joins(spark, done := set())
    got = {r["u"]: r["v"] for r in simhash.nearest(spark.createDataFrame([(int(x),) for x in some], "fp long")).collect()}
    assert 0 < rows_of_joins(spark, done) <= 7 * len(some)
    for k, u in enumerate(some[1:], 1):
        bits = near.np.bitwise_count(some[:k] ^ u)
        assert bits.min() > simhash.WIDE_DISTANCE or got[int(u)] == some[bits.argmin()]


@pytest.mark.parametrize("crowd", [1, 5, 1000])
@pytest.mark.parametrize("counted", [1, 64, 1 << 18])
def test_closest_of_runs(monkeypatch, crowd, counted):
    rnd = random.Random(20)
    sizes = [1, 7, 2, 40, 1, 5, 6, 19, 20, 21]
    runs = [sorted(x - (1 << 64) if x >> 63 else x for x in {rnd.getrandbits(2) << 62 | rnd.getrandbits(12) << k for k in range(n)}) for n in sizes]
    sizes = near.np.array([len(r) for r in runs])
    monkeypatch.setattr(simhash, "COUNTED", counted)
    bits, least = simhash._below(near.np.array(sum(runs, []), near.np.int64), sizes, 20, crowd)
    distance = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    want = [min(((distance(u, v), v) for v in (r[:k] if len(r) <= 20 else r[:1])), default=(65, 0)) if k else (65, 0) for r in runs for k, u in enumerate(r)]
    assert [(int(b), int(v) if b < 65 else 0) for b, v in zip(bits, least)] == want


def test_crowds_are_joined_across_roots(spark):
    """All pairs of different roots, each once, whichever root most nodes of a shingle have."""
    rnd = random.Random(21)
    rows = [(s, s * 1000 + k, 100, 0, rnd.choice([0, 0, 0, 0, 5, 6 + k])) for s in range(3) for k in range(40)]
    placed = spark.createDataFrame(rows, "shingle long, node long, n int, at int, root long")
    sketches = spark.createDataFrame([(r[1], *[0] * len(near.SKETCH)) for r in rows], "node long, " + ", ".join(f"{c} long" for c in near.SKETCH))
    got = sorted((r["u"], r["v"]) for r in near._crowds_joined(placed, sketches).collect())
    assert got == sorted((a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] > b[1] and a[4] != b[4])


def test_fingerprints_of_sets():
    rnd = random.Random(16)
    sets = [near.np.array(sorted(rnd.getrandbits(64) for _ in range(n)), near.np.uint64) for n in (0, 1, 2, 5, 70_000, 0, 300)]
    plain = lambda s: sum((2 * sum(int(h) >> k & 1 for h in s) > len(s)) << k for k in range(64))
    got = near.fingerprints(sets).view("u8").tolist()
    assert got[:4] + got[5:] == [plain(s) for k, s in enumerate(sets) if k != 4]
    ones = near.np.unpackbits(sets[4].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int)
    assert got[4] == sum(1 << k for k in range(64) if 2 * ones[k] > 70_000)


def test_the_driver_gives_its_garbage_back(spark):
    """What the driver's JVM no longer needs goes between steps, and does not wait until the heap is full."""
    from tokenmix.llm.common import rested

    used = lambda: (lambda r: r.totalMemory() - r.freeMemory())(spark._jvm.java.lang.Runtime.getRuntime())
    rested(spark)
    for _ in range(5):
        spark._jvm.java.lang.String("x" * 4_000_000)
    before = used()
    rested(spark)
    assert used() < before - 10_000_000


def test_the_driver_gives_freed_native_memory_back(spark):
    """What the JVM and Python have freed, and the C library keeps, goes back to the system between steps."""
    import ctypes
    import os
    import re
    from pathlib import Path

    from tokenmix.llm.common import rested

    held = lambda pid: int(re.search(r"\nRss:\s+(\d+)", "\n" + Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024
    jvm, size, n, every = spark._jvm, 64 << 10, 1000, 100
    field = jvm.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    unsafe, libc = field.get(None), ctypes.CDLL(None)
    libc.malloc.restype, libc.free.argtypes = ctypes.c_void_p, [ctypes.c_void_p]

    rested(spark)
    for pid, take, fill, free in (
        (jvm.java.lang.ProcessHandle.current().pid(), unsafe.allocateMemory, lambda at: unsafe.setMemory(at, size, 1), unsafe.freeMemory),
        (os.getpid(), libc.malloc, lambda at: ctypes.memset(at, 1, size), libc.free),
    ):
        blocks = [take(size) for _ in range(n)]
        for at in blocks:
            fill(at)
        for k, at in enumerate(blocks):  # a few stay between, so that what is freed is not at the end
            if k % every != every - 1:
                free(at)
        before = held(pid)
        rested(spark)
        assert held(pid) < before - 40, (pid, before, held(pid))
        for at in blocks[every - 1 :: every]:
            free(at)


def test_written_frames_have_no_marker(spark):
    import os
    from urllib.parse import urlparse

    from tokenmix.llm.common import written

    df = written(spark.range(10).toDF("x"), "marker")
    folder = os.path.dirname(urlparse(df.inputFiles()[0]).path)
    assert df.count() == 10 and not [f for f in os.listdir(folder) if "SUCCESS" in f]
    assert written(spark.range(0).toDF("x"), "marker").count() == 0
