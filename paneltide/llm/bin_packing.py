"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``CAPACITY`` tokens; only longer documents are
cut. The plan is made on the histogram of piece lengths, at most ``CAPACITY``
numbers whatever the corpus: the largest length left opens a bin, and a bitset
subset-sum over the lengths still available finds the fullest feasible
combination for the rest of it. That combination is removed as often as the
histogram allows, so one search serves many bins.

Pieces get a rank among those of their length from per-task counters (counts
per task and length are added up, never the pieces themselves), and the plan
maps ranges of ranks to sequences and offsets.

Defined cases: a null text is empty and is one piece of its end id alone; a
document of exactly ``CAPACITY`` tokens is one full piece; repeated rows are
packed each on its own; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.byte_terms import hashes, spans
from paneltide.llm.common import materialise, mix64, ready, slices

CAPACITY = 2048
END_ID = 0
CACHE = 500_000                # distinct pieces of a generation kept per worker, some 20 MB
BLOCK = 2000                   # pieces joined into one call of the tokenizer

_TOKENIZERS: dict[str, tuple] = {}

_CODE = np.arange(256)
_SOLID = (_CODE != 32) & ((_CODE < 9) | (_CODE > 13))                  # no white space
_LETTER = ((_CODE | 32) >= 97) & ((_CODE | 32) <= 122) & (_CODE < 128)
_ALNUM = _LETTER | (_CODE >= 48) & (_CODE <= 57)
_STOP = np.zeros(256, bool)
_STOP[np.frombuffer(b".,;:!?", np.uint8)] = True
_FOLDED = mix64(np.where(_LETTER, _CODE | 32, _CODE).astype(np.uint64) + np.uint64(1))
_PLAIN = mix64(_CODE.astype(np.uint64) + np.uint64(1))
_AGAIN = mix64(_FOLDED)
OPENING = ord("<")             # special tokens begin with it; they are not case-folded


def _apart(before: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Between a letter and a stop, or a stop and a letter or digit, the tokenizer always
    parts the text, so both sides can be encoded on their own."""
    return _LETTER[before] & _STOP[byte] | _STOP[before] & _ALNUM[byte]


class Pieces:
    """Ids of pieces of text, in arrays ordered by a hash of the piece: ``keys``, a second
    hash, first place and number of ids in ``ids``."""

    def __init__(self, keys, checks, lengths, ids):
        order = np.argsort(keys, kind="stable")
        self.keys, self.checks = keys[order], checks[order]
        self.first, self.lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
        self.ids = ids

    @classmethod
    def none(cls):
        return cls(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def find(self, keys, checks):
        """(place of each key, whether it is there)."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, (self.keys[at] == keys) & (self.checks[at] == checks)

    def taken(self, at):
        """(number of ids of the places, their ids in a row)."""
        n = self.lengths[at]
        return n, self.ids[np.arange(n.sum()) + np.repeat(self.first[at] - (np.cumsum(n) - n), n)]

    def plus(self, keys, checks, lengths, ids):
        own = np.argsort(self.first, kind="stable")
        return Pieces(np.r_[self.keys[own], keys], np.r_[self.checks[own], checks], np.r_[self.lengths[own], lengths],
                      np.r_[self.ids, ids])


class Encoder:
    """The tokenizer of a file with a cache of two generations: when the young one is
    full it becomes the old one, and what is still in use moves back up."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [(i, a.content) for i, a in sorted(self.tokenizer.get_added_tokens_decoder().items()) if a.special]
        self.mark = special[0] if special else None
        self.young, self.old = Pieces.none(), Pieces.none()

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids). Pieces are joined with a special token
        between them, which cuts them apart again."""
        t, mark = self.tokenizer, self.mark
        counts, ids = np.zeros(len(pieces), np.int64), []
        for a in range(0, len(pieces), BLOCK):
            block = pieces[a:a + BLOCK]
            if mark is None or any(mark[1] in x for x in block):
                for i, e in enumerate(t.encode_batch_fast(block, add_special_tokens=False), a):
                    counts[i] = len(e.ids)
                    ids.append(np.array(e.ids, "<u4"))
                continue
            out = np.array(t.encode_batch_fast([mark[1].join(block)], add_special_tokens=False)[0].ids, "<u4")
            cut = out == mark[0]
            counts[a:a + len(block)] = np.diff(np.r_[-1, np.flatnonzero(cut), len(out)]) - 1
            ids.append(out[~cut])
        return counts, np.concatenate([np.zeros(0, "<u4"), *ids])

    def known(self, raw: np.ndarray, keys, checks, start, stop) -> tuple[Pieces, np.ndarray]:
        """(pieces, place of each of the distinct ``keys`` in them), encoding what is new."""
        if len(self.young.keys) >= CACHE:
            self.old, self.young = self.young, Pieces.none()
        there = self.young.find(keys, checks)[1]
        up, back = self.old.find(keys, checks)
        back &= ~there
        new = np.flatnonzero(~there & ~back)
        counts, ids = self.encode([raw[a:b].tobytes().decode() for a, b in zip(start[new].tolist(), stop[new].tolist())])
        moved, old_ids = self.old.taken(up[back])
        self.young = self.young.plus(np.r_[keys[back], keys[new]], np.r_[checks[back], checks[new]],
                                     np.r_[moved, counts], np.r_[old_ids, ids])
        at, found = self.young.find(keys, checks)
        if not found.all():             # two pieces of one key: none of this slice is taken from the cache
            counts, ids = self.encode([raw[a:b].tobytes().decode() for a, b in zip(start.tolist(), stop.tolist())])
            apart = Pieces(np.arange(len(keys), dtype=np.uint64), checks, counts, ids)
            self.young = self.old = Pieces.none()
            return apart, np.arange(len(keys))
        return self.young, at


def _encoder(path: str) -> Encoder:
    """The encoder of the file, once a process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path)
    return _TOKENIZERS[path]


def _token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(first position of each text and the end, ids with END_ID after each text).
    The tokenizer drops white space and never joins across it, so each distinct
    piece between white space or stops is encoded once."""
    found = spans(texts, _SOLID, _apart)
    first = hashes(found, _FOLDED)
    # pieces that may hold a special token are told apart by case, the others are not
    seen = np.flatnonzero(found.raw == OPENING)
    odd = np.searchsorted(seen, found.stop) > np.searchsorted(seen, found.start)
    if odd.any():
        first[odd] = mix64(hashes(found, _PLAIN)[odd])
    _, some, index = np.unique(first, return_index=True, return_inverse=True)
    check = mix64((found.stop - found.start)[some].astype(np.uint64) ^ hashes(found, _AGAIN)[some])
    pieces, at = _encoder(path).known(found.raw, first[some], check, found.start[some], found.stop[some])
    length, start, flat = pieces.lengths[at], pieces.first[at], pieces.ids
    # an extra piece of one id at the end of each text
    owner_end = np.cumsum(found.counts + 1) - 1
    inner = np.ones(len(index) + len(found.counts), bool)
    inner[owner_end] = False
    n, at = np.ones(len(inner), np.int64), np.full(len(inner), len(flat), np.int64)
    n[inner], at[inner] = length[index], start[index]
    ends = np.cumsum(n)
    ids = np.append(flat, np.uint32(END_ID))[np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    return np.r_[0, ends[owner_end]] if len(found.counts) else np.zeros(1, np.int64), ids


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, limit=4 << 20):
            bounds, ids = _token_ids(batch.column("text"), path)
            rows = [(d, p, a - s, min(capacity, e - a), zlib.crc32(ids[a:min(e, a + capacity)]), a)
                    for d, (s, e) in enumerate(zip(bounds.tolist(), bounds[1:].tolist()))
                    for p, a in enumerate(range(s, e, capacity))]
            doc, piece, start, length, crc, at = (np.array(x, np.int64) for x in zip(*rows))
            # rank of each piece among this task's pieces of its length
            order = np.argsort(length, kind="stable")
            first = np.flatnonzero(np.r_[True, length[order][1:] != length[order][:-1]])
            step = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
            nr = np.empty(len(order), np.int64)
            nr[order] = step + seen[length[order]]
            seen += np.bincount(length, minlength=capacity + 1)
            out = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                   pa.array(length), pa.array(crc), pa.array(np.full(len(doc), task, np.int64)), pa.array(nr)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nr"]
            if with_ids:
                out.append(pa.array([ids[a:a + n].astype(np.int32) for a, n in zip(at, length)], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(out, names=names)
    return run


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination of available lengths within ``room``: a bitset of
    reachable sums grows length by length (copies by doubling), largest first,
    and is walked back from its highest bit."""
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if counts[n] and n <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            k *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Minimum bin slack on the histogram. Returns rows (length, first rank, pieces
    per bin, first bin, offset in the bin) and the number of bins."""
    counts = {n: c for n, c in histogram.items() if c}
    rank = dict.fromkeys(counts, 0)
    rows, bins = [], 0
    while counts:
        largest = max(counts)
        counts[largest] -= 1
        combo = fill(counts, capacity - largest)
        counts[largest] += 1
        combo[largest] = combo.get(largest, 0) + 1
        times = min(counts[n] // k for n, k in combo.items())
        offset = 0
        for n in sorted(combo, reverse=True):
            rows.append((n, rank[n], combo[n], bins, offset))
            offset += n * combo[n]
            rank[n] += combo[n] * times
            counts[n] -= combo[n] * times
            if not counts[n]:
                del counts[n]
        bins += times
    return rows, bins


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        key = rows[:, 0] << 44 | rows[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            r = rows[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            nth = rank - r[:, 1]
            rest = [c for c in batch.schema.names if c not in ("rank",)]
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(r[:, 3] + nth // r[:, 2]),
                                   pa.array(r[:, 4] + nth % r[:, 2] * length)],
                                  names=[*rest, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and
    offset (and ``ids`` if ``with_ids``)."""
    spark = ready(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    columns = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    ids = ", ids array<int>" if with_ids else ""
    pieces = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(path, capacity, with_ids), f"{columns}, task long, nr long{ids}"), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows, _ = plan(histogram, capacity)
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    held = spark.sparkContext.broadcast(table)       # a few rows per length
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).select(
        *columns.replace(",", "").split()[0::2], *(["ids"] if with_ids else []),
        (F.col("base") + F.col("nr")).alias("rank"))
    return ranked.mapInArrow(_place(held), f"{columns}{ids}, sequence_id long, offset long")
