"""Benchmark decontamination by winnowing.

A window is ``SPAN`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window. Words are those of ``byte_terms``. For windows of s
words k-grams with k = (s + 1) // 2 are hashed and of each s - k + 1 neighbouring
k-grams the smallest hash is the fingerprint. A window that a document shares with an
item has the same k-grams, so the same fingerprint: no shared window is missed.

A document's run of equal fingerprints is looked up once in a bitmap of the items'
fingerprints (2 MB whatever the benchmark); where it may occur there, the hit is
extended to the whole windows around it. Fingerprint and window together are
the key that meets the items' windows, so a common fingerprint with other words
around it makes no pairs, and the join is many to one: windows that the same items
hold are one class. Documents carry classes, and the items of a set of classes are
listed once per distinct set, not once per document.

Windows are compared by 64-bit hashes of their words together with the fingerprint's.

Defined cases: a null or wordless text has no words and no hits; a null or wordless
item has no window; items of the same id count once, a null id as ''; repeated
document rows each give a row; empty tables give an empty result, or no hits; other
columns are ignored. Ids may be of any type.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.byte_terms import bitmap_of, marked, terms
from paneltide.llm.common import materialise, mix64, ready, slices

SPAN = 10
STEP = np.uint64(0x9FB21C651E98DF25)


def _grams(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each n neighbouring words; the end is short of n - 1."""
    m = max(0, len(words) - n + 1)
    out = np.full(m, np.uint64(seed))
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix64(out * STEP ^ words[i:i + m])
    return out


def windows(counts: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, fingerprint, place among all words) of every window
    of ``size`` words."""
    if len(words) < size:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    k = (size + 1) // 2
    grams = _grams(words, k, size)
    least = grams[:len(words) - size + 1].copy()
    for i in range(1, size - k + 1):
        np.minimum(least, grams[i:i + len(least)], out=least)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(least))
    inside = ends[owner[:len(least)]] - place >= size
    place = place[inside]
    text = owner[place]
    return text, place - (ends - counts)[text], least[place], place


def window_hash(words: np.ndarray, place: np.ndarray, fingerprint: np.ndarray, size: int) -> np.ndarray:
    """Hash of the windows' words, of their order and of their fingerprint."""
    out = fingerprint + np.uint64(size)
    with np.errstate(over="ignore"):
        for i in range(size):
            out = mix64(out * STEP ^ words[place + i])
    return out


def _item_windows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            counts, words = terms(batch.column("text"))
            for size in range(1, span + 1):
                fits = counts == size if size < span else counts >= size
                text, _, mark, place = windows(counts, words, size)
                take = fits[text]
                text, mark, place = text[take], mark[take], place[take]
                yield pa.record_batch([
                    batch.column("item").take(pa.array(text)), pa.array(np.full(len(text), size, np.int32)),
                    pa.array(mark.view(np.int64)), pa.array(window_hash(words, place, mark, size).view(np.int64))],
                    names=["item", "size", "mark", "win"])
    return run


def _candidates(sizes: list[int], bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for batch in slices(batches, limit=1 << 20):
            counts, words = terms(batch.column("text"))
            found = []
            for size in sizes:
                text, first, mark, place = windows(counts, words, size)
                # neighbouring windows mostly share their fingerprint: one look-up for each run of them
                new = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]]) if len(mark) else np.zeros(0, np.int64)
                hit = np.repeat(marked(known, mark[new]), np.diff(np.r_[new, len(mark)]))
                text, first, mark, place = text[hit], first[hit], mark[hit], place[hit]
                found.append((text, first, np.full(len(text), size), window_hash(words, place, mark, size).view(np.int64)))
            text, first, size, win = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
            order = np.argsort(text, kind="stable")
            at = pa.array(np.r_[0, np.cumsum(np.bincount(text, minlength=len(counts)))].astype(np.int32))
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(counts.astype(np.int64)),
                *(pa.ListArray.from_arrays(at, pa.array(x[order].astype(t)))
                  for x, t in ((first, np.int32), (size, np.int32), (win, np.int64)))],
                names=["doc_id", "n_words", "start", "size", "win"])
    return run


def item_classes(items: DataFrame, span: int = SPAN, id_col: str = "item_id", text_col: str = "text"):
    """(windows, members): (size, mark, win, class) of every distinct window of the items
    and (class, item) of the items that hold the windows of a class. Windows with the
    same items are one class, known by the count and two order-free digests of them."""
    held = materialise(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                                    F.col(text_col).alias("text"))
                       .mapInArrow(_item_windows(span), "item string, size int, mark long, win long").distinct(), "windows")
    kind = held.groupBy("size", "mark", "win").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "item")).alias("y"))
    kind = materialise(kind, "kinds")
    name = kind.groupBy("n", "x", "y").agg(F.min(F.struct("win", "size")).alias("class"))
    known = kind.join(name, ["n", "x", "y"]).select("size", "mark", "win", F.col("class.win").alias("class"))
    members = held.join(name.select(F.col("class.win").alias("win"), F.col("class.size").alias("size")), ["win", "size"],
                        "left_semi").select(F.col("win").alias("class"), "item").distinct()
    return known, members


def find(docs: DataFrame, items: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, sets). ``documents`` has one row per document: doc_id, n_words, spans
    (array of (start, stop) in words, what windows of items cover, in order) and
    ``set``, the classes of those windows. ``sets`` lists (set, items): the ids of the
    items that a set of classes stands for, as strings in order."""
    spark = ready(docs.sparkSession)
    known, members = item_classes(items, span, item_id, item_text)
    known = materialise(known, "known")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())      # span numbers at most
    bitmap = spark.sparkContext.broadcast(bitmap_of(known.select("mark")))             # 2 MB
    kind = docs.schema[id_col].dataType.simpleString()
    scan = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _candidates(sizes, bitmap), f"doc_id {kind}, n_words long, start array<int>, size array<int>, win array<long>")
    # row numbers are given once, in the stored copy that all readers below share
    scan = materialise(scan.withColumn("row", F.monotonically_increasing_id()), "scan")
    near = scan.filter(F.size("win") > 0).select("row", F.explode(F.arrays_zip("start", "size", "win")).alias("w")) \
        .select("row", "w.start", (F.col("w.start") + F.col("w.size")).alias("stop"), "w.size", "w.win")
    hits = near.join(known.select("size", "win", "class"), ["win", "size"])
    # windows that overlap or touch become one span
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    island = hits.withColumn("new", F.when(F.col("start") <= F.max("stop").over(before), 0).otherwise(1)) \
        .withColumn("island", F.sum("new").over(upto))
    spans = island.groupBy("row", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                                                F.collect_set("class").alias("classes"))
    spans = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("set"))
    spans = materialise(spans, "spans")
    sets = spans.select("set").distinct().select("set", F.explode("set").alias("class")).join(members, "class") \
        .groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = scan.select("row", "doc_id", "n_words").join(spans, "row", "left").drop("row")
    return found, sets


def report(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside windows of items),
    n_items, the SHA-256 of the items' ids joined by commas, whether any word was hit."""
    found, sets = find(docs, items, **names)
    listed = sets.select("set", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    clean = found.filter("set is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
        F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256"), F.lit(False).alias("contaminated"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    dirty = found.filter("set is not null").join(listed, "set").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), "n_items", "items_sha256", F.lit(True).alias("contaminated"))
    return clean.unionByName(dirty)
