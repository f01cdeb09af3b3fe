"""Near-duplicates by ProbMinHash.

A document is the weighted set of its 5-word shingles (weight: occurrences).
Each shingle is a Poisson process of rate equal to its weight: arrivals at
exponential distances, each for a random one of ``REGISTERS`` registers, which
keep the earliest arrival. A document's processes stop as soon as they pass its
latest register, so a long text costs little more than its length. Equal
registers estimate the probability Jaccard similarity. ``BANDS`` bands of
``ROWS`` registers give candidates (a pair at 0.8 meets in one with probability
0.99993). A candidate goes on if ``PLANES`` bits of each register agree often enough:
``AGREE`` of 512 registers is 4.2 standard deviations below a pair at 0.8. The rest
are verified by the exact probability Jaccard of their shingles, ``THRESHOLD``
or more, and linked pairs make up classes.

Texts with equal words are one candidate. Inside a band's bucket not all pairs
are formed: first every member meets the bucket's hub, the one with most bucket
mates, and verified links merge classes; then only members outside the hub's
class meet the members of other classes. After that every pair of a bucket is
in one class or has been compared, so no link between classes is lost.

Defined cases: a text of fewer than five words is one shingle of them all; null
and wordless texts are classes of their own; repeated rows fall into one class;
a null ``doc_id`` ranks last; an empty table gives an empty result; other
columns are ignored (``classes``) or passed through (``representatives``). Rows
are numbered once, in a stored copy that all steps read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import fresh, materialise, mix64, numbered, ready, slices, word_hashes

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
REGISTERS = 512
LANES = REGISTERS // 64        # longs that hold one bit of each register
PLANES = 4                     # bits kept of each register: unequal ones agree by chance in one of 16
AGREE = 379
MARKS = 1 << 18                # longs of the bitmap that thins texts before their join
ARRIVAL = np.uint64(0x8CB92BA72F3D8DD7)


def _shingles(counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each shingle, hash): runs of WORDS words; all words of a shorter text."""
    ends = np.cumsum(counts)
    width = np.minimum(counts, WORDS)
    n = np.where(counts > 0, counts - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n)
    first = np.repeat(ends - counts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out = np.full(len(owner), 7, np.uint64)
    padded = np.append(words, np.uint64(0))
    with np.errstate(over="ignore"):
        for i in range(WORDS):
            have = i < width[owner]
            out = mix64(out * np.uint64(0x9FB21C651E98DF25) ^ np.where(have, padded[np.where(have, first + i, 0)], np.uint64(i)))
    return owner, out


def _weighted(owner: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with the number of occurrences, ordered by both."""
    order = np.argsort(shingles, kind="stable")
    narrow = owner[order].astype(np.uint16 if len(owner) and owner[-1] < 1 << 16 else np.int64)
    order = order[np.argsort(narrow, kind="stable")]
    o, s = owner[order], shingles[order]
    first = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (s[1:] != s[:-1])]) if len(o) else np.zeros(0, np.int64)
    return o[first], s[first], np.diff(np.r_[first, len(o)]).astype(np.float64)


def signatures(texts: int, owner: np.ndarray, shingles: np.ndarray, weight: np.ndarray,
               registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signature of each text: per register the shingle that arrives first."""
    earliest = np.full(texts * registers, np.inf)
    who = np.zeros(texts * registers, np.uint64)
    time = np.zeros(len(owner))
    live, step = np.arange(len(owner)), 0
    while len(live):
        with np.errstate(over="ignore"):
            draw = mix64(shingles[live] + np.uint64(step) * ARRIVAL)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53) / weight[live]
        register = ((mix64(draw) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        slot = owner[live] * registers + register
        np.minimum.at(earliest, slot, time)
        won = time == earliest[slot]
        who[slot[won]] = shingles[live[won]]
        # stop the processes that are past the latest register of their text
        inside = np.unique(owner[live])
        latest = np.zeros(texts)
        latest[inside] = earliest.reshape(texts, registers)[inside].max(1)
        on = time < latest[owner[live]]
        live, time, step = live[on], time[on], step + 1
    return who.reshape(texts, registers)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    out = np.tile(mix64(np.arange(BANDS, dtype=np.uint64)), (len(signature), 1))
    with np.errstate(over="ignore"):
        for i in range(ROWS):
            out = mix64(out * np.uint64(0x9FB21C651E98DF25) ^ signature[:, i:BANDS * ROWS:ROWS])
    return out


def register_bits(signature: np.ndarray) -> np.ndarray:
    """PLANES bits of each register: LANES numbers of first bits, then of second bits and so on."""
    mixed = mix64(signature)
    return np.concatenate([np.packbits((mixed >> np.uint64(k) & np.uint64(1)).astype(np.uint8), axis=1,
                                       bitorder="little").view(np.int64) for k in range(PLANES)], axis=1)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=4 << 20):
        counts, words = word_hashes(batch.column("text"), lower=True)
        signature = signatures(len(counts), *_weighted(*_shingles(counts, words)))
        keys, bits = band_keys(signature).view(np.int64), register_bits(signature)
        ends = np.cumsum(counts)
        digest = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None
                  for a, b in zip(ends - counts, ends)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("row"), pa.array(digest, pa.binary()),
                               pa.array(list(keys), pa.list_(pa.int64())), pa.array(list(bits), pa.list_(pa.int64()))],
                              names=["doc_id", "row", "digest", "bands", "bits"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets (sorted shingles, weights):
    the sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i), by ordering the
    elements by y / x."""
    keys, inverse = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[inverse[:len(a[0])]], y[inverse[len(a[0]):]] = a[1], b[1]
    ratio = np.divide(y, x, out=np.full(len(x), np.inf), where=x > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    upto = np.searchsorted(ratio, ratio, side="right")      # elements of the same or a smaller ratio
    sum_x, sum_y = np.r_[0.0, np.cumsum(x)], np.r_[0.0, np.cumsum(y)]
    both = (x > 0) & (y > 0)
    u = upto[both]
    return float((1.0 / (sum_x[u] / x[both] + (sum_y[-1] - sum_y[u]) / y[both])).sum())


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text_a", 2 << 20):
                sides = []
                for side in ("text_a", "text_b"):
                    owner, keys, weight = _weighted(*_shingles(*word_hashes(part.column(side), lower=True)))
                    cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
                    sides.append([(keys[p:q], weight[p:q]) for p, q in zip(cut, cut[1:])])
                near = np.array([similarity(x, y) >= threshold for x, y in zip(*sides)], bool)
                yield pa.record_batch([part.column(c).filter(pa.array(near)) for c in ("a", "b")], names=["a", "b"])
    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b): large-star and small-star steps until
    nothing changes; each step is an aggregate joined back, never a neighbour list."""
    stars = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b") \
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        stars = materialise(small, "stars")
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a > b) of one bucket that are in different classes and whose register
    bits agree as those of a pair at the threshold do. A pair that shares several
    buckets comes from the first of its common bands only."""
    other = right.select("bucket", F.col("row").alias("row2"), F.col("class").alias("class2"),
                         F.col("bands").alias("bands2"), F.col("bits").alias("bits2"))
    def differ(i):
        planes = [F.col("bits")[k].bitwiseXOR(F.col("bits2")[k]) for k in range(i, PLANES * LANES, LANES)]
        return F.bit_count(reduce(lambda x, y: x.bitwiseOR(y), planes))
    unlike = sum((differ(i) for i in range(LANES)), F.lit(0))
    common = F.filter(F.zip_with("bands", "bands2", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())
    return left.join(other, "bucket").filter(
        (F.col("class") != F.col("class2")) & (unlike <= REGISTERS - AGREE) & (F.get(common, F.lit(0)) == F.col("bucket"))) \
        .select(F.greatest("row", "row2").alias("a"), F.least("row", "row2").alias("b")).distinct()


def _texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, text) of the rows of ``docs`` that are in ``rows``. A bitmap of MARKS longs
    is broadcast to drop most others before the join moves any text."""
    spot = F.xxhash64("row")
    word, bit = F.shiftright(spot, 6).bitwiseAND(F.lit(MARKS - 1)), spot.bitwiseAND(F.lit(63)).cast("int")
    marks = rows.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("marks"))
    thin = docs.select("row", "text").withColumn("word", word).join(F.broadcast(marks), "word").filter(
        F.call_function("shiftright", F.col("marks"), bit).bitwiseAND(F.lit(1)) == 1).select("row", "text")
    return thin.join(rows, "row", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    side = lambda x: texts.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b") \
        .mapInArrow(_verify(threshold), "a long, b long")


def _linked(docs: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of all members (bucket, row, degree, bits) that are in one class
    with a smaller row."""
    texts = materialise(_texts_of(docs, members.select("row").distinct()), "texts")
    hub = members.groupBy("bucket").agg(F.max(F.struct("degree", "row")).alias("h")) \
        .select("bucket", F.col("h.row").alias("hub"))
    own = members.withColumn("class", F.col("row"))
    hubs = own.join(hub.select("bucket", F.col("hub").alias("row")), ["bucket", "row"], "left_semi")
    near = materialise(_verified(_candidates(own, hubs), texts, threshold), "links")
    labels = connected(near)
    # rows outside the class of their bucket's hub meet the other classes of the bucket
    label = labels.select(F.col("node").alias("row"), "root")
    now = materialise(members.join(label, "row", "left").withColumn("class", F.coalesce("root", "row")).drop("root"),
                      "classed")
    main = now.join(hub.withColumnRenamed("hub", "row"), ["bucket", "row"], "left_semi") \
        .select("bucket", F.col("class").alias("main"))
    rest = now.join(main, "bucket").filter("class <> main").drop("main")
    more = materialise(_verified(_candidates(rest, now), texts, threshold), "links")
    return connected(near.unionByName(more))


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, row, class_id, class_row) of every row of ``docs``, a stored table with
    ``doc_id``, ``row`` and ``text``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketch = materialise(docs.select("doc_id", "row", "text").mapInArrow(
        _sketch, f"doc_id {kind}, row long, digest binary, bands array<long>, bits array<long>"), "sketch")
    # texts with equal words: the smallest row stands for them
    stands = sketch.filter("digest is not null").groupBy("digest").agg(F.min("row").alias("stand"))
    single = sketch.join(stands.select(F.col("stand").alias("row")), "row", "left_semi")
    bands = single.select("row", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialise(bands.join(shared, "bucket"), "members")
    degree = members.groupBy("row").agg(F.sum("n").alias("degree"))
    more = degree.join(sketch.select("row", "bands", "bits"), "row")
    members = materialise(members.drop("n").join(more, "row"), "degrees")
    roots = _linked(docs, members, threshold)
    rows = sketch.select("doc_id", "row", "digest").join(stands, "digest", "left")
    rows = rows.select("doc_id", "row", F.coalesce("stand", "row").alias("node")).join(roots, "node", "left") \
        .select("doc_id", "row", F.coalesce("root", "node").alias("root"))
    rows = materialise(rows, "classes")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("f"),
                                     F.count(F.lit(1)).alias("class_size"))
    return rows.join(first, "root").select("doc_id", "row", F.col("f.doc_id").alias("class_id"),
                                           F.col("f.row").alias("class_row"), "class_size")


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class),
    the class's size and whether this row is the one that stands for it."""
    ready(docs.sparkSession)
    own = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "row", "numbered")
    return _classes(own, threshold).select(
        "doc_id", "class_id", "class_size", (F.col("row") == F.col("class_row")).alias("is_representative"))


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one of the smallest doc_id; all columns."""
    ready(docs.sparkSession)
    name = fresh(docs, "row_")
    own = numbered(docs, name, "numbered")
    keep = _classes(own.select("doc_id", F.col(name).alias("row"), "text"), threshold) \
        .filter("row = class_row").select(F.col("row").alias(name))
    return own.join(keep, name, "left_semi").select(*docs.columns)
