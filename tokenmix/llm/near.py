"""Near duplicates: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words and shingle hashes are those of ``simhash``, with ``SHINGLE`` = 5 words (fewer words: the whole sequence as one shingle). First comes SimHash:
each set of shingles has a fingerprint (``simhash``'s rule, without repeats), ``simhash.nearest`` finds close fingerprints by
blocks and Hamming distance, their sets are compared exactly, and the components of what is similar are the first classes.

No radius of fingerprints holds every pair of similarity 0.8 (the distance is about 10 +- 3 of 64 bits, without a bound), so what this leaves
is looked for between different classes of SimHash, by
prefix filtering, which loses none: shingles have one order for all documents, and two sets of similarity 0.8 share one of
the first n - ceil(0.8 n) + 1 shingles of each. The order is rarest first by counters of hashed shingles (a fixed ``COUNTERS`` of
them, summed over the corpus), then by hash; it decides what is compared, never what is found. Sizes and places bound the
overlap that is possible, and what passes is compared exactly, as whole sets.

Equal sets are one node. Shingles in the prefixes of over ``CROWD`` nodes are not joined within themselves at first: in ``ROUNDS`` rounds
all nodes of such a crowd are compared with one of them, and crowds that are of one class by then are done. In the others, nodes of different classes are joined
where bitmaps of their sets allow the similarity (the join gives no other pairs).

Nodes are 64-bit hashes of the sets. Defined cases: null text -> no words; all documents without words are one class; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import components
from .common import dropped, few_files, hot_keys, joined, kept, ready, rested, written
from .simhash import BUCKET, nearest, shingle_hashes

SHINGLE, CROWD, ROUNDS = 5, 24, 3
#: Counters of hashed shingles, and how many of them are in a row.
COUNTERS, PART = 1 << 20, 1 << 12
#: A set's bitmap of 1,024 bits, as columns.
SKETCH = tuple(f"b{k}" for k in range(16))
#: Nodes that a task knows to have sent.
SENT = 200_000
#: Hashes whose bits are unpacked at once.
UNPACKED = 1 << 16


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(np.array(shingle_hashes((text or "").encode("utf-8", "surrogatepass"), SHINGLE), np.uint64))


def node_of(shingles: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(shingles.tobytes(), 5)).astype(np.int64))


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """int64 SimHash fingerprints of sets of shingles: a bit is 1 if it is set in over half of the hashes (no shingles: zero)."""
    n = np.array([len(s) for s in sets], np.int64)
    ones, flat, owner = np.zeros((len(sets), 64), np.int64), np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), n)
    for at in range(0, len(flat), UNPACKED):
        whose = owner[at : at + UNPACKED]
        first = np.flatnonzero(np.diff(whose, prepend=-1))
        bits = np.unpackbits(flat[at : at + UNPACKED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[whose[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > n[:, None], axis=1, bitorder="little").view("<u8").ravel().view(np.int64)


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of which a set of similarity 0.8 has one in its own prefix, in order."""
    n = len(shingles)
    order = np.lexsort((shingles, counts[(shingles % np.uint64(COUNTERS)).astype(np.int64)]))
    return shingles[order[: n - -(-4 * n // 5) + 1]] if n else shingles


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of 0.8 or more, in integers: the overlap is at least 4/9 of both sizes."""
    return 9 * len(np.intersect1d(a, b, assume_unique=True)) >= 4 * (len(a) + len(b))


def text_key():
    """Stands for the text of a row beside its doc_id; null is not the empty text."""
    return F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null"))


def _marked(batches):
    """Rows of documents, and at last rows of counters (part is not null)."""
    kept("near")
    counts, names = np.zeros(COUNTERS, np.int64), ["doc_id", "key", "node", "print", "part", "counts"]
    for b in batches:
        sets = [shingle_set(t) for t in b.column(2).to_pylist()]
        nodes = [node_of(s) for s in sets]
        once = list({k: s for k, s in zip(nodes, sets)}.values())
        if once:
            counts += np.bincount((np.concatenate(once) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        none = pa.nulls(len(nodes), pa.int32()), pa.nulls(len(nodes), pa.binary())
        prints = pa.array(fingerprints(sets), pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(1).cast(pa.string()), pa.array(nodes, pa.int64()), prints, *none], names)
    for k in np.unique(np.nonzero(counts)[0] // PART).tolist():
        part = pa.array([k], pa.int32()), pa.array([counts[k * PART : (k + 1) * PART].tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), *[pa.nulls(1, pa.int64())] * 2, *part], names)


def _summed(t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in t.column("counts"))
    return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _prefixes(shared):
    def work(batches):
        kept("near")
        sent = set()
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                s = shingle_set(t)
                node = node_of(s)
                if node in sent or not len(s):
                    continue
                if len(sent) < SENT:
                    sent.add(node)
                p = prefix(s, shared.value)
                out.append((p.view(np.int64), np.full(len(p), node, np.int64), np.full(len(p), len(s), np.int32), np.arange(len(p), dtype=np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["shingle", "node", "n", "at"])

    return work


def _sets(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["node", "shingles"])


def _compared(batches):
    for b in batches:
        a, c = ([np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(k)] for k in (2, 3))
        yield pa.RecordBatch.from_arrays(b.columns[:2], ["u", "v"]).filter(pa.array([similar(x, y) for x, y in zip(a, c)], pa.bool_()))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of the pairs (u, v) those that are similar."""
    a, b = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return written(few_files(pairs.distinct().join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_compared, "u long, v long")), "links")


def _possible(n, at, m, to):
    """Whether sets of n and m shingles that share the ones at these places (and none before) can be similar."""
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * F.least(n - at, m - to) >= 4 * (n + m))


def _wanted_sets(docs: DataFrame, marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and shingles of the nodes (u), each from one row of docs."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    one = marked.groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("one")).join(nodes, F.col("node") == F.col("u"))
    one = one.select("node", F.col("one.key").alias("k"), F.coalesce(F.col("one.doc_id").cast("string"), F.lit("null")).alias("i"))
    rows = docs.select(text_key().alias("k"), name.alias("i"), "text").join(one, ["k", "i"])
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("k", "i").orderBy("k"))).where("nth = 1")
    return written(rows.select("node", "text").mapInArrow(_sets, "node long, shingles binary"), "sets")


def _sketched(batches):
    for b in batches:
        bits = np.zeros((b.num_rows, 64 * len(SKETCH)), bool)
        for k, x in enumerate(b.column(1)):
            bits[k, (np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(20)).astype(np.int64) % bits.shape[1]] = True
        words = np.packbits(bits, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(w)) for w in words.T)], ["node", *SKETCH])


def _sketch_allows() -> Column:
    """Bits that only one of two sketches has are at most the shingles that only one of two sets has; similar sets differ in a ninth of both sizes at most."""
    differing = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in SKETCH), F.lit(0))
    return 9 * differing <= F.col("a.n") + F.col("b.n")


def _joined(placed: DataFrame) -> DataFrame:
    """Pairs of placed (shingle, node, n, at, root) of different roots that may be similar."""
    a, b = placed.alias("a"), placed.alias("b")
    apart = (F.col("a.node") > F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    return a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & apart & _possible(F.col("a.n"), F.col("a.at"), F.col("b.n"), F.col("b.at"))).select(F.col("a.node").alias("u"), F.col("b.node").alias("v"))


def _crowds_joined(placed: DataFrame, sketches: DataFrame) -> DataFrame:
    """As ``_joined``, where the sketches (of nodes) allow it. Of a pair of different roots at most one node is of the root that most nodes of the
    shingle have; so all are joined with the others only, and a crowd that is nearly of one class makes few pairs."""
    most = placed.groupBy("shingle", "root").agg(F.count("*").alias("k")).groupBy("shingle").agg(F.max(F.struct("k", "root")).alias("most")).select("shingle", F.col("most.root").alias("most"))
    sketched = placed.join(sketches, "node").join(most, "shingle").withColumn("main", F.col("root") == F.col("most"))
    a, b = sketched.where("not main").alias("a"), sketched.alias("b")
    apart = (F.col("a.root") != F.col("b.root")) & (F.col("b.main") | (F.col("a.node") > F.col("b.node"))) & _sketch_allows()
    pairs = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & apart & _possible(F.col("a.n"), F.col("a.at"), F.col("b.n"), F.col("b.at")))
    return pairs.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v"))


def _rooted(placed: DataFrame, star: DataFrame) -> DataFrame:
    return placed.drop("root").join(star.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _grown(star: DataFrame, links: DataFrame) -> DataFrame:
    """The stars of a graph with these links added, made from the stars that were, and not from all links again."""
    if links.isEmpty():
        return star
    rested(links.sparkSession)
    return components.stars(star.unionByName(links))


def simhash_pairs(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (u, v) of the nodes of prints (node, print) that SimHash finds: each node with the first of its fingerprint, and the first of each
    fingerprint with that of the closest one. So there are no more pairs than nodes, however many are close to each other."""
    first = written(prints.groupBy("print").agg(F.min("node").alias("first")), "prints")
    a, b = first.select(F.col("print").alias("u"), F.col("first").alias("a")), first.select(F.col("print").alias("v"), F.col("first").alias("b"))
    close = nearest(first.select(F.col("print").alias("fp")), bucket).join(a, "u").join(b, "v").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    same = prints.join(first, "print").where("node != first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    return written(few_files(close.unionByName(same)), "close")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("u").unionByName(pairs.select(F.col("v").alias("u")))


def _crowds(placed: DataFrame) -> DataFrame:
    """Without crowds of one class."""
    several = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("shingle")
    return written(few_files(placed.join(several, "shingle")), "crowds")


def classes(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, key (``text_key``) and root of each row; rows of one class have one root."""
    spark = ready(docs.sparkSession)
    marked = written(docs.select("doc_id", text_key().alias("key"), "text").mapInArrow(_marked, "doc_id long, key string, node long, print long, part int, counts binary"), "marked")
    counts = np.zeros(COUNTERS, np.int64)
    for r in marked.where("part is not null").select("part", "counts").groupBy("part").applyInArrow(_summed, "part int, counts binary").collect():
        counts[r["part"] * PART : (r["part"] + 1) * PART] = np.frombuffer(r["counts"], np.int64)
    shared = spark.sparkContext.broadcast(np.minimum(counts, (1 << 31) - 1).astype(np.int32))
    marked = marked.where("part is null").select("doc_id", "key", "node", "print")

    rested(spark)
    # (the set without shingles is similar to no other)
    pairs = simhash_pairs(marked.where(F.col("node") != node_of(shingle_set(None))).groupBy("node").agg(F.first("print").alias("print")))
    sets = _wanted_sets(docs, marked, _ends(pairs).distinct())
    found = _links(pairs, sets)
    rested(spark)
    star = components.stars(found)
    dropped(sets)
    rested(spark)

    every = docs.select("text").mapInArrow(_prefixes(shared), "shingle long, node long, n int, at int")
    # counted by partial sums and joined back (not by a window), so that a shingle of very many nodes is never in one task
    once = every.groupBy("shingle", "node").agg(F.first("n").alias("n"), F.first("at").alias("at"))
    # (n and at are looked at on both sides, so that both read one shuffle)
    often = once.groupBy("shingle").agg(F.count("*").alias("nodes"), F.max("n").alias("most"), F.max("at").alias("last")).where("nodes > 1 and most > last").select("shingle", "nodes")
    placed = written(once.join(often, "shingle"), "prefixes")
    shared.destroy()
    pairs = written(few_files(_joined(_rooted(placed.where(F.col("nodes") <= crowd), star)).distinct()), "pairs")
    crowds = _crowds(_rooted(placed.where(F.col("nodes") > crowd), star))
    dropped(placed)
    rested(spark)
    sets = _wanted_sets(docs, marked, _ends(pairs).unionByName(crowds.select(F.col("node").alias("u"))).distinct())

    star = _grown(star, _links(pairs, sets))
    for k in range(ROUNDS):
        if crowds.isEmpty():
            break
        crowds = _crowds(_rooted(crowds, star))
        heads = crowds.groupBy("shingle").agg(F.min(F.struct(F.xxhash64("node", F.lit(k)), F.col("node"), F.col("n"), F.col("root"))).alias("h"))
        pairs = crowds.join(heads, "shingle").where((F.col("root") != F.col("h.root")) & (5 * F.least("n", "h.n") >= 4 * F.greatest("n", "h.n")))
        star = _grown(star, _links(pairs.select(F.greatest("node", "h.node").alias("u"), F.least("node", "h.node").alias("v")), sets))
    if not crowds.isEmpty():
        rest = _crowds(_rooted(crowds, star))
        sketches = sets.join(rest.select("node").distinct(), "node", "left_semi").mapInArrow(_sketched, "node long, " + ", ".join(f"{c} long" for c in SKETCH))
        star = _grown(star, _links(_crowds_joined(rest, sketches), sets))
    dropped(sets)
    rested(spark)
    counts = marked.groupBy("node").agg(F.count("*").alias("n"))
    names = counts.join(star.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    return joined(marked, names, "node", hot_keys(counts, "node", marked.count())).select("doc_id", "key", "root")
