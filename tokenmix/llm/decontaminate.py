"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer, but not none, is one window). A window occurs in a document
where all its words stand in a row. The join: the words of a window are ordered by rarity over all documents; as containment must be
whole, the necessary prefix is the rarest word alone. Documents' words are joined with the windows' prefix words; the place
of the prefix word in the window and the window's length bound where the occurrence would have to begin and end; the words from there on are compared
exactly. A word inside any occurrence is hit.

The windows are broadcast if they, with their items, take at most ``BROADCAST_BYTES`` (measured first) and documents' words are then never shuffled; beyond
that only (document, place, hash of the word) is shuffled to the windows and the candidates go back to their documents for the exact comparison.

Defined cases: null text or a text without words -> no words, no window, not contaminated; repeated rows each get a result; documents with one doc_id
and different texts are kept apart; a null doc_id is an id like others; null item_ids count as no item, but their windows hit; an empty benchmark hits
nothing; very long texts are one array of words, taken apart in place; an empty table gives an empty result; other columns are not read
(``keep_clean`` keeps them).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_files, written

WINDOW = 10
BROADCAST_BYTES = 64 << 20
#: ASCII characters that separate words.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words(text: Column) -> Column:
    """Words after A-Z are lower-cased: one character map, then a split at single spaces, neither of them by a regular expression."""
    spaced = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + SEPARATORS, string.ascii_lowercase + " " * len(SEPARATORS))
    return F.array_remove(F.split(spaced, " "), "")


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """window array<string> and items array<string> (ids of the items with it), each different window once."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    each = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, size))).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def key_of(docs: DataFrame) -> list[Column]:
    """What tells documents apart besides doc_id, if ids repeat."""
    return [F.xxhash64("text").alias("text_hash"), F.octet_length("text").alias("text_bytes")]


def prefixed(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """windows with h (hash of their rarest word), place (where it is in the window) and length."""
    placed = windows.withColumn("wid", F.xxhash64("window")).select("wid", "window", "items", F.posexplode("window").alias("place", "word")).withColumn("h", F.xxhash64("word"))
    known = placed.select("h").distinct()
    seen = docs.select(F.explode(words(F.col("text"))).alias("word")).select(F.xxhash64("word").alias("h"))
    counts = seen.join(_maybe_broadcast(known, 16), "h").groupBy("h").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "place"))
    first = placed.join(counts, "h", "left").groupBy("window").agg(rarest.alias("r"), F.first("items").alias("items"))
    return first.select("window", "items", F.col("r.h").alias("h"), F.col("r.place").alias("place"), F.size("window").alias("length"))


def _bytes(df: DataFrame, columns: list[str], row: int) -> int:
    """Bytes of the rows: so many each, and the strings and entries of array columns."""
    size = F.lit(row).cast("long")
    for c in columns:
        size = size + F.octet_length(F.concat_ws(" ", c)) + 16 * F.size(c)
    return df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).collect()[0]["b"]


def _maybe_broadcast(df: DataFrame, row: int) -> DataFrame:
    return F.broadcast(df) if _bytes(df, [], row) <= BROADCAST_BYTES else df


class Windows:
    """The windows with their prefixes, written once, and whether they may be broadcast."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, size: int, most: int):
        self.rows = written(few_files(prefixed(item_windows(benchmark, size), docs)), "windows")
        self.small = _bytes(self.rows, ["window", "items"], 200) <= most


def _exact(found: DataFrame) -> DataFrame:
    """Of places where a window's prefix stands those where all of it does."""
    start = F.col("start")
    bounded = found.where((start >= 0) & (start + F.col("length") <= F.size("w")))
    return bounded.where(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("window"))


KEY = ("doc_id", "text_hash", "text_bytes")


def _placed(docs: DataFrame, win: Windows, with_end: bool = False) -> DataFrame:
    """Words of documents (and with with_end an empty one behind them) met with the broadcast windows: ``KEY``, w, start, length, items, window."""
    d = docs.select("doc_id", *key_of(docs), words(F.col("text")).alias("w"))
    rows, each = win.rows, F.col("w")
    if with_end:
        end = win.rows.sparkSession.range(1).select(F.lit(None).cast("array<string>").alias("window"), F.lit(None).cast("array<string>").alias("items"), F.xxhash64(F.lit("")).alias("h"), F.lit(0).alias("place"), F.lit(0).alias("length"))
        rows, each = rows.unionByName(end), F.concat("w", F.array(F.lit("")))
    at = d.select(*KEY, "w", F.posexplode(each).alias("p", "word")).withColumn("h", F.xxhash64("word"))
    return at.join(F.broadcast(rows), "h").withColumn("start", F.col("p") - F.col("place"))


def occurrences(docs: DataFrame, benchmark: DataFrame | Windows, size: int = WINDOW, most: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, text_hash, text_bytes, start (0-based word), length and items of every occurrence of a window."""
    win = benchmark if isinstance(benchmark, Windows) else Windows(docs, benchmark, size, most)
    if win.small:
        return _exact(_placed(docs, win)).select(*KEY, "start", "length", "items")
    d = docs.select("doc_id", *key_of(docs), words(F.col("text")).alias("w"))
    at = d.select(*KEY, F.size("w").alias("n"), F.posexplode("w").alias("p", "word")).select(*KEY, "n", "p", F.xxhash64("word").alias("h"))
    near = at.join(win.rows, "h").withColumn("start", F.col("p") - F.col("place")).where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n"))).drop("n", "p", "h")
    e = near.alias("e")
    same = F.col("e.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("e.text_hash") == F.col("d.text_hash")) & F.col("e.text_bytes").eqNullSafe(F.col("d.text_bytes"))
    return _exact(d.dropDuplicates(list(KEY)).alias("d").join(e, same).select("e.*", "d.w")).select(*KEY, "start", "length", "items")


def _covered(spans: Column) -> Column:
    """Words in the union of (start, length) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))

    def step(acc, x):
        end = (x["start"] + x["length"]).cast("long")
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["hit"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["start"].cast("long")))).alias("hit"))

    return F.aggregate(spans, zero, step)["hit"]


def _gathered(rows: DataFrame, *more: Column) -> DataFrame:
    """Per document: spans (start, length), sorted, and the sorted items; both are collected without nulls."""
    spans = F.array_sort(F.collect_set(F.when(F.col("length") > 0, F.struct("start", "length"))))
    return rows.groupBy(*KEY).agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), *more)


def measures(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items of every document."""
    win = Windows(docs, benchmark, size, most)
    if win.small:
        # one pass over the texts: the empty word behind each meets a row of its own, which brings every row of docs and its number of words
        met = _placed(docs, win, with_end=True)
        is_end = F.col("window").isNull()
        inside = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.size("w")) & (F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, F.greatest("length", F.lit(1))) == F.col("window"))
        kept = met.where(is_end | inside).select(*KEY, "start", "length", "items", F.when(is_end, F.size("w").cast("long")).alias("n_words"))
        per = _gathered(kept, F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"))
        per = per.select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    else:
        d = docs.select("doc_id", *key_of(docs), F.size(words(F.col("text"))).cast("long").alias("n_words")).alias("d")
        p = _gathered(occurrences(docs, win)).alias("p")
        same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_hash") == F.col("p.text_hash")) & F.col("d.text_bytes").eqNullSafe(F.col("p.text_bytes"))
        per = d.join(p, same, "left").select("d.doc_id", "n_words", "spans", "items")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    return per.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), items.alias("items"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, with their columns."""
    bad = occurrences(docs, benchmark, size).select("doc_id", "text_hash", "text_bytes").distinct().alias("b")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *key_of(docs)).alias("d")
    same = F.col("d.row.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.text_hash") == F.col("b.text_hash")) & F.col("d.text_bytes").eqNullSafe(F.col("b.text_bytes"))
    return keyed.join(bad, same, "left_anti").select("row.*")


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), bw AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), bs AS (
  SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM bw WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS t FROM bs
), ms AS (
  SELECT DISTINCT m FROM win
), dp AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM dw, ms WHERE len(w) >= m
), occ AS (
  SELECT DISTINCT dp.doc_id, dp.s, dp.m, win.item_id FROM dp JOIN win ON win.m = dp.m AND array_to_string(dp.w[dp.s:dp.s + dp.m - 1], ' ') = win.t
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM occ) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
