"""Substring dedup by paragraph hashing: passages are normalised, their digests
grouped over the whole corpus, the earliest ranked occurrence stays and the others
are cut out of their documents, with the original offsets of what was cut.

Units are the pieces of a line that end at . ! ? , ; : or the line's end, or after a word
of ``LONG`` bytes or more, so that equal text divides alike wherever it stands. A
passage is the consecutive units from one unit on that reach ``MIN_WORDS`` words; there
is one for every unit, so a repeated stretch of 50 words holds a whole passage whether or
not it starts and ends with sentences. Compared are the lower-case words of
``byte_terms``. A word of more than 15 bytes counts once more for each 16, so text
without spaces between its words makes passages too.

A unit is cut if it lies in a passage that stood before: in an earlier document
(ascending ``doc_id``, null last, then place in the input) or earlier in the same
one. It goes with all that follows it up to the next unit. By induction over
the rank every cut unit still stands, within the same words, where it stood first.

Only digests (96 bits) move through the shuffles, twice at most: counts and first
places come from an aggregate, digests that surely occur once are left out of
the join by a bitmap of 2 MB, and the join with the first places is many to one, so the
engine may split where a passage is hot. Texts without a cut do not move at all, again by
a bitmap; the others move once, to meet their cuts.

Defined cases: a null text stays null with no cut; empty texts and texts of fewer words
stay as they are; repeated rows lose what the first of them keeps; an empty table gives
an empty result; other columns pass through. Ids must be whole numbers or null. The input
is read once, into a copy with row numbers.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.byte_terms import Spans, bitmap_of, hashes, marked, powers, spans
from paneltide.llm.common import fresh, materialise, mix64, numbered, ready, slices

MIN_WORDS = 30
LONG = 10                      # bytes of a word that ends its unit
WIDE = 16                      # bytes that make one more word
ENDS = "\n.!?,;:"
LAST_ID = (1 << 63) - 1

_ENDS = np.zeros(256, bool)
_ENDS[np.frombuffer(ENDS.encode(), np.uint8)] = True


def units(found: Spans) -> tuple[np.ndarray, np.ndarray]:
    """(text of each unit, its first term); the end of the last one closes the second."""
    n = len(found.start)
    ends = np.zeros(n, bool)
    if n:
        # punctuation between a term and the next one of the batch; a text's last term ends a unit
        seen = np.flatnonzero(_ENDS[found.raw])
        after = np.r_[found.start[1:], len(found.raw)]
        ends = np.searchsorted(seen, after) > np.searchsorted(seen, found.stop)
        ends |= found.stop - found.start >= LONG
        ends[np.cumsum(found.counts)[found.counts > 0] - 1] = True
    first = np.r_[0, np.flatnonzero(ends) + 1]
    owner = np.repeat(np.arange(len(found.counts)), found.counts)
    return owner[first[:-1]], first


def passages(found: Spans, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, unit in the text, number of units, digest) of every passage, the digest as
    two columns of 64 bits of which 32 of the second are used."""
    text, first = units(found)
    weight = np.r_[0, np.cumsum(1 + (found.stop - found.start) // WIDE)]
    low, high = first[:-1], first[1:]
    # the first unit by whose end the weight is reached
    last = np.searchsorted(weight[high], weight[low] + min_words)
    have = last < len(low)
    have[have] &= text[last[have]] == text[have]
    at, last = np.flatnonzero(have), last[have]
    s, e = low[at], high[last]
    up, down = powers(len(found.start) + 1)
    word, out = hashes(found), []
    with np.errstate(over="ignore"):
        for seed in (np.uint64(1), np.uint64(0xD6E8FEB86659FD93)):
            total = np.r_[np.uint64(0), np.cumsum(mix64(word ^ seed) * up[:len(word)], dtype=np.uint64)]
            out.append(mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
    begin = np.searchsorted(text, np.arange(len(found.counts)))
    return text[at], at - begin[text[at]], last - at + 1, np.stack([out[0], out[1] >> np.uint64(32)])


def _digests(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 1 << 20):
            text, unit, n, digest = passages(spans(batch.column("_text")), min_words)
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(text, minlength=batch.num_rows))].astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (
                unit.astype(np.int32), n.astype(np.int32), digest[0].view(np.int64), digest[1].astype(np.uint32).view(np.int32))]
            yield pa.record_batch([batch.column("_row"), batch.column("_id"), *lists],
                                  names=["_row", "_id", "unit", "n", "h", "g"])
    return run


def _maybe_again(bitmap):
    """The passages whose digest may occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for batch in batches:
            owner = np.repeat(np.arange(batch.num_rows), batch.column("h").value_lengths().to_numpy(zero_copy_only=False))
            flat = {c: batch.column(c).flatten() for c in ("unit", "n", "h", "g")}
            take = pa.array(np.flatnonzero(marked(known, flat["h"].to_numpy().view(np.uint64))))
            yield pa.record_batch([batch.column("_row").take(pa.array(owner).take(take)), *(x.take(take) for x in flat.values())],
                                  names=["_row", *flat])
    return run


def cuts(docs: DataFrame, row: str, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, cut): of each row that loses any, the units to cut as (first, last) ranges
    in order; ranges may overlap."""
    spark = docs.sparkSession
    own = docs.select(F.col(row).alias("_row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("_id"),
                      F.col(text_col).alias("_text")).filter("_text is not null")
    held = own.mapInArrow(_digests(min_words), "_row long, _id long, unit array<int>, n array<int>, h array<long>, g array<int>")
    held = materialise(held.filter(F.size("h") > 0), "passages")
    every = held.select("_row", "_id", F.explode(F.arrays_zip("unit", "h", "g")).alias("p")) \
        .select("_row", "_id", "p.unit", "p.h", "p.g")
    first = every.groupBy("h", "g").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("_id", "_row", "unit")).alias("f"))
    first = materialise(first.filter("times > 1").select(
        "h", "g", F.col("f._row").alias("keep_row"), F.col("f.unit").alias("keep_unit")), "firsts")
    bitmap = spark.sparkContext.broadcast(bitmap_of(first.select("h")))
    again = held.select("_row", "unit", "n", "h", "g").mapInArrow(
        _maybe_again(bitmap), "_row long, unit int, n int, h long, g int")
    again = again.join(first, ["h", "g"]).filter((F.col("_row") != F.col("keep_row")) | (F.col("unit") != F.col("keep_unit")))
    return again.groupBy("_row").agg(F.array_sort(F.collect_list(
        F.struct("unit", (F.col("unit") + F.col("n") - 1).alias("last")))).alias("cut"))


REBUILT = "row long, text string, n_chars long, starts array<long>, lengths array<long>"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its cut units, and where those stood in code points."""
    for batch in slices(batches, limit=1 << 20):
        found = spans(batch.column("text"))
        text, first = units(found)
        begin = np.searchsorted(text, np.arange(batch.num_rows + 1))
        char = np.r_[0, np.cumsum((found.raw & 0xC0) != 0x80)]
        rows = []
        for i, ranges in enumerate(batch.column("cut").to_pylist()):
            low, high = int(found.at[i]), int(found.at[i + 1])
            # first byte of each unit of the text and its end
            edge = np.r_[found.start[first[begin[i]:begin[i + 1]]], high]
            kept, gone, at = [], [], low
            for r in ranges:
                a, b = int(edge[r["unit"]]), int(edge[r["last"] + 1])
                if a > at or not gone:
                    kept.append((at, a))
                    gone.append([a, b])
                else:
                    gone[-1][1] = max(gone[-1][1], b)
                at = max(at, b)
            kept.append((at, high))
            new = b"".join(found.raw[a:b].tobytes() for a, b in kept)
            rows.append((new.decode(), sum(int(char[b] - char[a]) for a, b in kept),
                         [int(char[a] - char[low]) for a, _ in gone], [int(char[b] - char[a]) for a, b in gone]))
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.record_batch([batch.column("row"), *(pa.array(c, t) for c, t in zip(columns, types))],
                              names=["row", "text", "n_chars", "starts", "lengths"])


def _may_be_in(row: str, bitmap: DataFrame):
    """(column, condition): the join key of a row number in ``bitmap`` and whether its bit is set."""
    spot = F.xxhash64(row)
    return F.shiftrightunsigned(spot, 46), F.call_function(
        "shiftright", F.col(bitmap.columns[1]), spot.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def dedupe(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (``n_chars``, where present, counted
    anew if something was cut) and one more column ``cut``: array of (start, length) of
    what was removed, in code points of the original text and in order. If ``docs`` has a
    column ``cut``, the new one is ``cut_``."""
    ready(docs.sparkSession)
    row, new, place, bits = (fresh(docs, c) for c in ("row_", "new_", "place_", "bits_"))
    stored = numbered(docs, row, "numbered")
    found = materialise(cuts(stored, row, min_words), "cuts")
    # a bitmap of the rows with cuts, 2 MB at most: all others need not move
    spot = F.xxhash64("_row")
    marks = found.groupBy(F.shiftrightunsigned(spot, 46).alias(place)).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), spot.bitwiseAND(F.lit(63)).cast("int"))).alias(bits))
    key, is_set = _may_be_in(row, marks)
    seen = stored.withColumn(place, key).join(F.broadcast(marks), place, "left").withColumn(
        place, F.coalesce(is_set, F.lit(False)))
    moved = seen.filter(place)
    rebuilt = moved.select(F.col(row).alias("row"), "text").join(found.withColumnRenamed("_row", "row"), "row") \
        .select("row", "text", "cut").mapInArrow(_without, REBUILT)
    rebuilt = rebuilt.select(F.col("row").alias(row), F.struct("text", "n_chars", F.arrays_zip(
        F.col("starts").alias("start"), F.col("lengths").alias("length")).alias("cut")).alias(new))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    name = fresh(docs, "cut")
    cut = F.col(new)
    changed = {"text": cut["text"], "n_chars": cut["n_chars"]}
    after = moved.join(rebuilt, row, "left").select(
        *(F.when(cut.isNotNull(), changed[c]).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c in changed
          else F.col(c) for c in docs.columns), F.coalesce(cut["cut"], none).alias(name))
    return seen.filter(~F.col(place)).select(*docs.columns, none.alias(name)).unionByName(after)
