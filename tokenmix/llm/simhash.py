"""SimHash near-duplicate classes.

Fingerprints: A-Z lower-cased, words are runs of bytes other than space and \\x09-\\x0D, shingles of ``SHINGLE`` words with
repeats (fewer words: the whole sequence as one shingle; none: fingerprint zero), each shingle's XXH64 with seed 42; a bit is 1 if it is set in
over half of the hashes.

Links: two fingerprints are linked at ``DISTANCE`` = 2 or fewer differing bits. The 64 bits are split into ``BLOCKS`` = 4 blocks; by the pigeonhole
principle a close pair agrees in at least two of them, so fingerprints are joined on each of the six pairs of blocks
and the Hamming distance of the joined ones is verified. Only distinct fingerprints take part. Where over ``CROWD`` fingerprints agree in a pair of
blocks, the same is done once more with the bits that are left: these are split into four blocks, of which a close pair again agrees in two; and so on
until eight bits are left, in which at most 256 fingerprints can differ. So no join is larger than a constant, and no pair is lost.

Fingerprints and classes that many rows have are joined by ``common.joined``.

Defined cases: null text -> no words (fingerprint zero, linked like any other); repeated rows each get a result; a null
doc_id is never a component's id unless it has no other (then null); very long texts are hashed whole, a shingle at a time; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import components
from .common import dropped, few_files, hot_keys, joined, kept, ready, rested, written

SHINGLE, SEED, DISTANCE, BLOCKS, CROWD = 3, 42, 2, 4, 24
#: Of ``nearest``.
WIDE_BLOCKS, WIDE_DISTANCE, WIDE_MOST, BUCKET = 8, 6, 10, 512
#: Differing bits up to which the closest ones are looked for, one step after the other, where over a bucket agree.
WIDE_STEPS = (2, 4)
#: Pairs of fingerprints whose differing bits are counted at once.
COUNTED = 1 << 18
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    from xxhash import xxh64_intdigest

    words = text.translate(_LOWER).split()  # bytes.split: exactly space and \x09-\x0D
    if not words:
        return []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    if len(words) <= size:
        return [xxh64_intdigest(joined, SEED)]
    starts = [0, *(e + 1 for e in ends[:-size])]
    return [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


def fingerprint_many(texts: list[bytes]) -> np.ndarray:
    """int64 fingerprints (the unsigned value's bits)."""
    out, held, sizes, where = np.zeros(len(texts), np.uint64), [], [], []

    def flush():
        if held:
            bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            n = np.array(sizes)
            counts = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int32)
            out[where] = np.packbits(counts * 2 > n[:, None], axis=1, bitorder="little").view("<u8").ravel()
            held.clear(), sizes.clear(), where.clear()

    for i, t in enumerate(texts):
        h = shingle_hashes(t)
        if h:
            held.extend(h)
            sizes.append(len(h))
            where.append(i)
        if len(held) > 1 << 16:
            flush()
    flush()
    return out.view(np.int64)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id long, fp long."""
    ready(docs.sparkSession)

    def work(batches):
        kept("simhash")
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fingerprint_many(texts))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _finer(agreed: int) -> list[int]:
    """The masks in one of which two close values that agree in the bits ``agreed`` agree: these bits and two of four blocks of the others."""
    left = [k for k in range(64) if not agreed >> k & 1]
    size = len(left) // BLOCKS
    parts = [sum(1 << k for k in left[i * size : (i + 1) * size]) for i in range(BLOCKS)]
    return [agreed | sum(some) for some in combinations(parts, BLOCKS - DISTANCE)]


def _placed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """fp, mask and value (the fingerprint's bits in the mask) by each of the masks that are finer than the row's own."""
    finer = F.create_map(*(x for m in masks for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(f)) for f in _finer(m))))))
    return rows.select("fp", F.explode(finer[F.col("mask")]).alias("mask")).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def links(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (u, v) with the components of the link graph over the distinct fingerprints fp of nodes."""
    masks, rows, found = [0], nodes.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        placed = _placed(rows, masks)
        sizes = placed.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        sized = written(placed.join(sizes, ["mask", "value"]), "blocks")
        masks = sorted({f for m in masks for f in _finer(m)})
        last = bin(masks[0]).count("1") >= 56
        few = sized if last else sized.where(F.col("n") <= crowd)
        a, b = few.select("mask", "value", F.col("fp").alias("u")), few.select("mask", "value", F.col("fp").alias("v"))
        near = a.join(b, ["mask", "value"]).where((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= DISTANCE)).select("u", "v").distinct()
        found = near if found is None else found.unionByName(near)
        rows = sized.where(F.col("n") > crowd).select("fp", "mask").distinct()
        if last or rows.isEmpty():
            return found
        found, rows = written(few_files(found), "links"), written(few_files(rows), "crowds")


def _masks(blocks: int) -> list[tuple[int, int]]:
    """Of 64 bits in so many blocks, each pair of blocks: its number in bits, and its mask."""
    size = 64 // blocks
    return [(1 << i | 1 << j, (1 << size) - 1 << size * i | (1 << size) - 1 << size * j) for i, j in combinations(range(blocks), 2)]


def _agreed(x, blocks: int) -> Column:
    """Of a difference of fingerprints, the two first of so many blocks without a differing bit, as bits."""
    size = 64 // blocks
    equal = sum((F.when(x.bitwiseAND(F.lit(_signed((1 << size) - 1 << size * k))) == 0, 1 << k).otherwise(0) for k in range(blocks)), F.lit(0))
    later = equal.bitwiseAND(equal - 1)
    return equal.bitwiseAND(-equal) + later.bitwiseAND(-later)


def _by_blocks(nodes: DataFrame, blocks: int) -> DataFrame:
    """fp, code and value (the fingerprint's bits) of each pair of blocks."""
    at = F.array(*(F.struct(F.lit(code).alias("code"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value")) for code, mask in _masks(blocks)))
    return nodes.select("fp", F.explode(at).alias("at")).select("fp", "at.code", "at.value")


def _met(some: DataFrame, others: DataFrame, blocks: int, most: int) -> DataFrame:
    """Pairs (u, v) of at most so many differing bits, u of some and a smaller v of others, each where it first agrees in two blocks."""
    a, b = some.select("code", "value", F.col("fp").alias("u")), others.select("code", "value", F.col("fp").alias("v"))
    x = F.col("u").bitwiseXOR(F.col("v"))
    return a.join(b, ["code", "value"]).where((F.col("u") > F.col("v")) & (F.bit_count(x) <= most) & (_agreed(x, blocks) == F.col("code"))).select("u", "v")


def _closest(pairs: DataFrame) -> DataFrame:
    """u, bits and v of the closest v of each u."""
    bits = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    found = pairs.groupBy("u").agg(F.min(F.struct(bits.alias("bits"), F.col("v"))).alias("least")).select("u", "least.bits", "least.v")
    return written(few_files(found), "nearest")


def _below(f: np.ndarray, sizes: np.ndarray, bucket: int, crowd: int) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of so many fingerprints, each in ascending order: the bits between each one and the closest (of several the smallest) before it in its run, and this one.

    All of the runs of at most ``crowd`` are compared with the one before, then with the one before that, and so on; in longer ones a run's pairs are counted together. Of over
    ``bucket`` each is compared with the first only.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    bits, least, nth = np.full(len(f), 65, np.uint8), np.zeros(len(f), np.int64), np.arange(len(f)) - np.repeat(starts, sizes)
    left, back = np.flatnonzero((nth > 0) & np.repeat(sizes <= min(crowd, bucket), sizes)), 1
    while len(left):
        v = f[left - back]
        n = np.bitwise_count((f[left] ^ v).view(np.uint64))
        closer = n <= bits[left]  # of as many bits the later one is the smaller
        bits[left[closer]], least[left[closer]] = n[closer], v[closer]
        back += 1
        left = left[nth[left] >= back]
    for run in np.flatnonzero((sizes > crowd) & (sizes > 1) & (sizes <= bucket)):
        start, end = starts[run], ends[run]
        step = max(1, COUNTED // (end - start))
        for low in range(start, end, step):
            high = min(low + step, end)
            n = np.bitwise_count((f[low:high, None] ^ f[None, start:high]).view(np.uint64))
            n[np.arange(start, high)[None, :] >= np.arange(low, high)[:, None]] = 65
            at = n.argmin(axis=1)
            bits[low:high], least[low:high] = n[np.arange(high - low), at], f[start + at]
    headed = np.flatnonzero((nth > 0) & np.repeat(sizes > bucket, sizes))
    least[headed] = f[headed - nth[headed]]
    bits[headed] = np.bitwise_count((f[headed] ^ least[headed]).view(np.uint64))
    return bits, least


def _nearest_of_block(t: pa.Table, bucket: int, crowd: int) -> pa.Table:
    """Of distinct fingerprints that agree in a block: by each later block (u, v), v the closest one below u of those that agree in it too; and v null for a u with which over ``bucket`` agree."""
    kept("near")
    f, block, size = np.sort(t.column("fp").to_numpy()), t.column("block")[0].as_py(), 64 // WIDE_BLOCKS
    bits, least, crowded = np.full(len(f), 65, np.uint8), np.zeros(len(f), np.int64), np.zeros(len(f), bool)
    for other in range(block + 1, WIDE_BLOCKS):
        value = (f.view(np.uint64) >> np.uint64(size * other) & np.uint64((1 << size) - 1)).astype(np.uint16)
        order = np.argsort(value, kind="stable")
        sizes = np.bincount(value)
        sizes = sizes[sizes > 0]
        n, v = _below(f[order], sizes, bucket, crowd)
        crowded[order] |= np.repeat(sizes > bucket, sizes)
        closer = (n < bits[order]) | (n == bits[order]) & (v < least[order])
        bits[order[closer]], least[order[closer]] = n[closer], v[closer]
    near, none = bits <= WIDE_MOST, pa.nulls(int(crowded.sum()), pa.int64())
    return pa.table({"u": np.concatenate([f[near], f[crowded]]), "v": pa.chunked_array([pa.array(least[near]), none], pa.int64())})


def nearest(nodes: DataFrame, bucket: int = BUCKET, crowd: int = CROWD) -> DataFrame:
    """(u, v): for the distinct fingerprints fp of nodes the closest one below it, where one is close.

    ``WIDE_BLOCKS`` = 8 blocks of 8 bits: fingerprints of ``WIDE_DISTANCE`` = 6 or fewer differing bits agree in two of them, and all that agree in two are compared; what
    is compared counts up to ``WIDE_MOST`` = 10 differing bits. So that of the 28 pairs of blocks no pair is a row, fingerprints are grouped by their value of one block (seven
    rows each, 1,792 groups), and in a group those that agree in a later block too are compared by arrays, a nanosecond or so a pair: as many agree by chance in two blocks as the
    corpus is large (1/65536 of it), so all pairs of a join would be as many as its square. Only close ones come out, one of each fingerprint at most.

    Of over ``bucket`` fingerprints that agree, each is compared with one of them only, and all of these with each other within ``WIDE_STEPS``: steps of r bits have
    blocks of their own, r + 2 (of which two agree), so they find all of that distance in any crowd, and who has found one within a step looks no further. Who uses this
    looks for the others in another way (``near``).
    """
    ready(nodes.sparkSession)
    size = 64 // WIDE_BLOCKS
    blocks = F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", size * k).bitwiseAND(F.lit((1 << size) - 1)).alias("value")) for k in range(WIDE_BLOCKS - 1)))
    placed = nodes.select("fp", F.explode(blocks).alias("at")).select("fp", "at.block", "at.value")
    several = placed.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1").select("block", "value")  # at most a row for each group; small tables have many groups of one
    met = written(placed.join(F.broadcast(several), ["block", "value"]).select("fp", "block", "value").groupBy("block", "value").applyInArrow(lambda t: _nearest_of_block(t, bucket, crowd), "u long, v long"), "met")
    found, crowds = _closest(met.where("v is not null")), met.where("v is null").select(F.col("u").alias("fp"))
    if not crowds.isEmpty():
        crowded = written(few_files(crowds.distinct()), "crowded")
        for last, most in zip((0, *WIDE_STEPS), WIDE_STEPS):
            rested(nodes.sparkSession)
            others = _by_blocks(crowded, most + 2)
            some = others.join(found.where(F.col("bits") <= last).select(F.col("u").alias("fp")), "fp", "left_anti")
            before, found = found, _closest(_met(some, others, most + 2, most).unionByName(found.select("u", "v")))
            dropped(before)
        dropped(crowded)
    dropped(met)
    return found.select("u", "v")


def classes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    prints = written(fingerprints(docs), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "nodes")
    star = components.stars(links(nodes, crowd))
    rooted = written(nodes.join(star.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "rooted")
    total = prints.count()
    roots = hot_keys(rooted.groupBy("root").agg(F.count("*").alias("n")), "root", total)
    named = joined(rooted, rooted.groupBy("root").agg(F.min("first").alias("component_id")), "root", roots).select("fp", "component_id")
    return joined(prints, named, "fp", hot_keys(rooted, "fp", total)).select("doc_id", "fp", "component_id")


def hexadecimal(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs but for near duplicates (``near.classes``): of each class one row stays, of the smallest id (a null
    id comes last), then of the smallest text digest. Equal ids with texts of different classes, and null ids, each have their class's row."""
    from . import near

    id_first = F.struct(F.col("doc_id").isNull(), "doc_id", "key")  # a null id comes last
    found = written(near.classes(docs), "classes")
    rested(docs.sparkSession)
    one = found.groupBy("root").agg(F.min(id_first).alias("one")).select("one.doc_id", "one.key")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    chosen = one.select(F.col("key").alias("k"), name.alias("i"))  # rows of one id and text are in one class, so these are different
    rows = docs.select(F.struct(*docs.columns).alias("row"), near.text_key().alias("k"), name.alias("i")).join(chosen, ["k", "i"], "left_semi")
    # of repeated rows one stays
    first = F.row_number().over(Window.partitionBy("k", "i").orderBy("k"))
    return rows.withColumn("nth", first).where("nth = 1").select("row.*")
