"""Ranked lexical search with bag deduplication.

Every row of ``items`` is a query against all documents. Documents are restricted to
the vocabulary of the items: what is left of a document is its bag, the frequencies of
the vocabulary's terms, and a length term m. Documents of an equal bag and m score
alike for every item, so they are one class: grouped by a digest, verified by bag and m
themselves, scored once. The best classes of an item by (score, smallest doc_id) hold
its best documents; only these are expanded, by ascending doc_id.

Score, in whole numbers: the sum over the item's terms, repeats included, of
w * ((10^9 tf) div (1000 tf + 12 m)), w = floor(1000 ln((2N + 2) / (2 df + 1))) and
m = 75 + (25 n N) div L, with n the document's terms, N the documents with a term, L
all terms and df the documents with the term.

Scale: texts are read once for a block of items and leave a bag each. Blocks hold
``ENTRIES`` distinct (item, term) pairs, a broadcast of a few MB; more items are more
blocks. Of a class ``TOP`` members at most travel, cut before the shuffle, so a class
of a third of all documents is no hot key; tasks pass ``TOP`` classes per item on.
Terms are held as 64-bit hashes of their lower-case bytes (``byte_terms``).

Defined cases: null, empty and wordless texts are no documents of any result; an item
without words, or of words that no document has, gives no rows; repeated items each
give their rows, repeated document rows are documents of their own; a null doc_id ranks
last; empty tables give an empty result; other columns are ignored. ``doc_id`` must be
a whole number, ``item_id`` may be of any type.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.byte_terms import bitmap_of, marked, terms
from paneltide.llm.common import materialise, ready, slices

TOP = 20
ENTRIES = 1 << 19              # distinct (item, term) pairs of a block
PAIRS = 1 << 21                # (class, item) scores, or (class, term, item) addends, held at once
LAST_ID = (1 << 63) - 1


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, term, times) of each item row."""
    for batch in slices(batches, limit=1 << 20):
        counts, words = terms(batch.column("text"))
        owner = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((words, owner))
        o, w = owner[order], words[order]
        first = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (w[1:] != w[:-1])]) if len(o) else np.zeros(0, np.int64)
        yield pa.record_batch([batch.column("item").take(pa.array(o[first])), pa.array(w[first].view(np.int64)),
                               pa.array(np.diff(np.r_[first, len(o)]).astype(np.int64))], names=["item", "term", "times"])


def _bags(vocabulary, bitmap):
    """doc_id, number of terms, and the bag: (place in the vocabulary, frequency) as pairs
    of 32-bit numbers in order (null: no term of the vocabulary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = vocabulary.value, bitmap.value
        for batch in slices(batches, limit=1 << 20):
            counts, words = terms(batch.column("text"))
            owner = np.repeat(np.arange(len(counts)), counts)
            maybe = np.flatnonzero(marked(bits, words))
            words, owner = words[maybe], owner[maybe]
            place = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
            real = known[place] == words if len(known) else np.zeros(len(words), bool)
            key, tf = np.unique(owner[real] * len(known) + place[real], return_counts=True)
            owner = key // max(len(known), 1)
            flat = np.empty((len(key), 2), "<u4")
            flat[:, 0], flat[:, 1] = key - owner * len(known), tf
            at = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(counts)))].astype(np.int32) * 8
            none = np.packbits(np.diff(at) > 0, bitorder="little")
            bag = pa.Array.from_buffers(pa.binary(), len(counts), [pa.py_buffer(none), pa.py_buffer(at), pa.py_buffer(flat)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts.astype(np.int64)), bag],
                                  names=["doc_id", "n", "bag"])
    return run


def _decoded(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bag, place, frequency) of all pairs of an array of bags without nulls."""
    _, offsets, data = bags.buffers()
    at = np.frombuffer(offsets, np.int32)[bags.offset:bags.offset + len(bags) + 1].astype(np.int64)
    flat = np.frombuffer(data, "<u4")[at[0] // 4:at[-1] // 4].reshape(-1, 2) if data is not None else np.zeros((0, 2), "<u4")
    return np.repeat(np.arange(len(bags)), np.diff(at) // 8), flat[:, 0].astype(np.int64), flat[:, 1].astype(np.int64)


def _frequencies(size: int):
    """(place, documents) of the vocabulary's terms, added up within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_decoded(batch.column("bag"))[1], minlength=size)
        place = np.flatnonzero(total)
        yield pa.record_batch([pa.array(place), pa.array(total[place])], names=["place", "df"])
    return run


class Index:
    """The items of a block: for each place of the vocabulary the items that have the term
    and what one unit of impact adds to their score."""

    def __init__(self, items: np.ndarray, place: np.ndarray, adds: np.ndarray, size: int):
        self.ids, item = np.unique(items, return_inverse=True)
        order = np.argsort(place, kind="stable")
        self.item, self.adds = item[order].astype(np.int64), adds[order]
        self.first = np.searchsorted(place[order], np.arange(size + 1))
        # sums of whole numbers are exact in doubles below 2^53
        self.exact = float(np.bincount(item, weights=adds).max(initial=0)) * 1e6 < 2.0 ** 53

    def scores(self, owner: np.ndarray, place: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
        """Scores of ``rows`` classes (their terms in order of class) with every item."""
        wide = len(self.ids)
        out = np.zeros(rows * wide, np.int64)
        each = self.first[place + 1] - self.first[place]
        ends = np.cumsum(each)
        a = 0
        while a < len(place):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS, side="right")))
            n = each[a:b]
            at = np.arange(n.sum()) + np.repeat(self.first[place[a:b]] - (np.cumsum(n) - n), n)
            key = np.repeat(owner[a:b] * wide, n) + self.item[at]
            value = np.repeat(impact[a:b], n) * self.adds[at]
            if self.exact:
                low = int(owner[a]) * wide
                part = np.bincount(key - low, weights=value).astype(np.int64)
                out[low:low + len(part)] += part
            else:
                np.add.at(out, key, value)
            a = b
        return out.reshape(rows, wide)


def _best(index, top: int):
    """The ``top`` classes of each item in a task by (score, smallest doc_id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        held = [np.zeros(0, np.int64) for _ in range(4)]               # item, score, first id, class
        least = np.ones(len(ix.ids), np.int64)
        for batch in batches:
            step = max(1, PAIRS // max(len(ix.ids), 1))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                owner, place, tf = _decoded(part.column("bag"))
                m = part.column("m").to_numpy()
                impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[owner])
                s = ix.scores(owner, place, impact, part.num_rows)
                row, item = np.nonzero(s >= least)
                if not len(row):
                    continue
                new = [item, s[row, item], part.column("first_id").to_numpy()[row], part.column("class").to_numpy()[row]]
                item, score, first, group = (np.concatenate(x) for x in zip(held, new))
                order = np.lexsort((group, first, -score, item))
                item, score, first, group = item[order], score[order], first[order], group[order]
                start = np.searchsorted(item, np.arange(len(ix.ids)))
                nth = np.arange(len(item)) - start[item]
                # from now on a class must reach the last one that an item still holds
                full = nth == top - 1
                least[item[full]] = score[full]
                held = [x[nth < top] for x in (item, score, first, group)]
        yield pa.record_batch([pa.array(ix.ids[held[0]]), *(pa.array(x) for x in held[1:])],
                              names=["item", "score", "first_id", "class"])
    return run


def _classes(bags: DataFrame, top: int) -> DataFrame:
    """(class, nth, doc_id, id, bag, m): at most ``top`` members of each class by ascending
    id; the class is known by the row of its first member."""
    total = bags.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    docs, all_terms = int(total["docs"]), int(total["terms"] or 0)
    m = F.expr(f"75 + ((cast(25 * n as decimal(20, 0)) * cast({docs} as decimal(18, 0))) div cast({max(all_terms, 1)} as decimal(38, 0)))")
    own = bags.filter("bag is not null").withColumn("m", m.cast("long")).withColumn("digest", F.xxhash64("bag", "m"))
    w = Window.partitionBy("digest", "m", "bag").orderBy("id", "row")
    first = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return own.select("digest", "m", "bag", "id", "row", "doc_id", F.row_number().over(w).alias("nth"),
                      F.first("row").over(first).alias("class")).filter(F.col("nth") <= top)


def _search_block(docs: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of one block."""
    spark = docs.sparkSession
    held = entries.select("item", "term", "times").toArrow()             # bounded by the block
    item, term, times = (held.column(c).to_numpy() for c in ("item", "term", "times"))
    vocabulary, place = np.unique(term.view(np.uint64), return_inverse=True)
    words, bitmap = (spark.sparkContext.broadcast(x) for x in (vocabulary, bitmap_of(entries.select("term"))))
    bags = docs.mapInArrow(_bags(words, bitmap), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, bag binary")
    bags = bags.withColumn("row", F.monotonically_increasing_id()).withColumn(
        "id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)))
    bags = materialise(bags, "bags")
    df = np.zeros(len(vocabulary), np.int64)
    found = bags.filter("bag is not null").select("bag").mapInArrow(_frequencies(len(vocabulary)), "place long, df long") \
        .groupBy("place").agg(F.sum("df").alias("df")).toArrow()
    df[found.column("place").to_numpy()] = found.column("df").to_numpy()
    n_docs = bags.filter("n > 0").count()
    weight = np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)
    index = spark.sparkContext.broadcast(Index(item, place, weight[place] * times, len(vocabulary)))
    members = materialise(_classes(bags, top), "members")
    best = members.filter("nth = 1").select("bag", "m", F.col("id").alias("first_id"), "class") \
        .mapInArrow(_best(index, top), "item long, score long, first_id long, class long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first_id", "class")
    best = best.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top).select("item", "score", "class")
    rank = Window.partitionBy("item").orderBy(F.desc("score"), "id", "row")
    return members.select("class", "id", "row", "doc_id").join(best, "class") \
        .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top) \
        .select("item", "rank", "doc_id", "score")


def _blocks(entries: DataFrame, total: int, size: int) -> list[tuple[int, int]]:
    """Ranges of buckets of items with about ``size`` entries each."""
    buckets = max(1, 16 * -(-total // size)) if total > size else 1
    if buckets == 1:
        return [(0, 1, 1)] if total else []
    counts = dict(entries.groupBy(F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("b")).count().collect())
    out, start, held = [], 0, 0
    for b in range(buckets):
        n = counts.get(b, 0)
        if held and held + n > size:
            out.append((start, b, buckets))
            start, held = b, 0
        held += n
    return [*out, (start, buckets, buckets)]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", entries: int = ENTRIES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``top`` documents of every item
    with a score above 0; equal scores by ascending doc_id."""
    ready(docs.sparkSession)
    queries = materialise(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
                          .withColumn("item", F.monotonically_increasing_id()), "items")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = materialise(queries.select("item", "text").mapInArrow(_item_terms, "item long, term long, times long"), "entries")
    out = None
    for low, high, of in _blocks(held, held.count(), entries):
        bucket = F.pmod(F.xxhash64("item"), F.lit(of))
        part = _search_block(own, held.filter((bucket >= low) & (bucket < high)), top)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = own.filter(F.lit(False)).select(F.lit(0).cast("long").alias("item"), F.lit(0).alias("rank"), "doc_id",
                                              F.lit(0).cast("long").alias("score"))
    return out.join(queries.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
