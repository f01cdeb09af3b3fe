"""LM scoring with a log-frequency Bloom filter.

Training: unigram (with one end token a text) and bigram counts of all training
texts are gathered by hash in segments of the key space. Each segment becomes
one Bloom filter sized by its own n-grams; the filter holds, for an n-gram of
count c, the events (n-gram, 1) .. (n-gram, q) with q = 1 + floor(log2 c). A
second set of segments holds, for every context h, the sum S(h) of the quantised
counts of its own bigrams: the events of 1 + floor(log2 S) and those of
``STEP_BITS`` bits below the first one, rounded up. The segments are broadcast in
shards of ``SHARD_BYTES`` at most, one shard after the other when there are
more, so a worker never holds a larger filter.

Scoring: the quantised count of an n-gram is the number of probes j = 1, 2, ..
that hit before the first miss; c is the mean count of that quantum. Bigrams are
smoothed by their unigrams:
P(w|h) = (c(hw) + MU * P(w)) / (S(h) + MU), P(w) = (c(w) + 0.1) / (U + 0.1 (V + 1)),
U the sum of c over all V training tokens. P(w) adds up to 1 over the V tokens and
one unknown token, P(w|h) to 1 for S as it is and to more than 0.94 for S as it is
held. A filter can only overstate: a miss proves an n-gram absent. c(hw) is cut
to c(w) and S(h), which a true count never exceeds. The false bigrams that are left
add 0.004 V / (S(h) + MU) on average to the mass of a context summed over all V tokens;
fewer of them take a larger filter (a rate of 1 / 4V: 36 bits an event for V of 3 million).

The exact base score does not use the filter: counts of the ``FREQUENT`` most
frequent tokens are broadcast (a fixed number of 16 bytes), all other tokens of
a text are joined to the count table.

Tokens are known by 64-bit hashes of their bytes; a bigram's key is a bijective mix of
32 bits of its context and 32 of its token, so the context of a counted bigram is read
from its key and need not be shuffled beside it (contexts that share their 32 bits
have one sum, which is then too high). Defined cases: a null text is
empty and has the end token only; repeated rows are scored alike; a null
doc_id counts as '' for the fold; with no training rows N and V are 0 and all
tokens unknown; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import held_out, materialise, mix64, ready, slices, unmix64, word_hashes

FOLDS = 10
ALPHA = 0.1
MU = 8.0
BITS_PER_EVENT, PROBES = 12, 6      # 0.4 % false positives
SHARD_BYTES = 256 << 20
FREQUENT = 1 << 17
BLOCK = 1 << 15                 # n-grams probed at once
STEP_BITS = 4                   # of a context's sum, below its first bit
FLUSH = 2_000_000               # n-grams gathered in a task before they are passed on
END = np.uint64(0x9D5C1C0B5E8E2A31)
START = np.uint64(0x3C79AC492BA7B653)
CONTEXT = np.uint64(0xFFFFFFFF00000000)         # a context's bits in the key of a bigram
EVENT = np.uint64(0xA0761D6478BD642F)

PARTS = pa.schema([("seg", pa.int32()), ("uni", pa.binary()), ("uni_n", pa.binary()),
                   ("bi", pa.binary()), ("bi_n", pa.binary())])
SUMS = pa.schema([("seg", pa.int32()), ("h", pa.binary()), ("h_sum", pa.binary())])


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first position of each text, token hashes with an end token per text)."""
    counts, words = word_hashes(texts, lower=True)
    ends = np.cumsum(counts + 1) - 1
    out = np.empty(len(words) + len(counts), np.uint64)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = words, END
    return ends - counts, out


def _bigrams(starts: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context, bigram) key of every token; a text's first context is START."""
    context = np.empty_like(tokens)
    context[1:] = context_keys(tokens[:-1])
    context[starts] = context_keys(START)
    return context, mix64(context | tokens & ~CONTEXT)


def context_keys(tokens: np.ndarray) -> np.ndarray:
    return mix64(tokens) & CONTEXT


def _count(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    keys_ = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    if counts is None:
        return np.unique(keys_, return_counts=True)
    order = np.argsort(keys_)
    keys_, n = keys_[order], np.concatenate(counts)[order] if counts else np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys_[1:] != keys_[:-1]]) if len(keys_) else np.zeros(0, np.int64)
    return keys_[first], np.add.reduceat(n, first) if len(first) else n


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _by_segment(keys: np.ndarray, columns: list[np.ndarray], segments: int, seg: list[int] | None = None):
    """The segments that ``keys`` (ascending) meet, and each column's bytes per segment."""
    cuts = np.searchsorted(_segment(keys, segments), np.arange(segments + 1))
    if seg is None:
        seg = np.flatnonzero(np.diff(cuts)).tolist()
    return seg, [pa.array([x[cuts[i]:cuts[i + 1]].tobytes() for i in seg], pa.binary()) for x in columns]


def _gather(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            u, un = _count([h[0] for h in held])
            b, bn = _count([h[1] for h in held])
            held.clear()
            seg = np.unique(np.r_[_segment(u, segments), _segment(b, segments)]).tolist()
            uni = _by_segment(u, [u, un.astype(np.uint32)], segments, seg)[1]
            bi = _by_segment(b, [b, bn.astype(np.uint32)], segments, seg)[1]
            return pa.record_batch([pa.array(seg, pa.int32()), *uni, *bi], schema=PARTS)
        size = 0
        for batch in slices(batches):
            starts, tokens = _tokens(batch.column("text"))
            held.append((tokens, _bigrams(starts, tokens)[1]))
            size += len(tokens)
            if size >= FLUSH:
                yield flush()
                size = 0
        if held:
            yield flush()
    return run


def _build(table: pa.Table) -> pa.Table:
    """Merge one segment's counts; its filter, its exact unigram counts and its share of
    the contexts' sums (in halves, as mean counts are)."""
    def side(k: str, kind=np.uint64):
        return [np.frombuffer(x, kind) for x in table.column(k).to_pylist()]
    uni, uni_n = _count(side("uni"), [x.astype(np.int64) for x in side("uni_n", np.uint32)])
    bi, bi_n = _count(side("bi"), [x.astype(np.int64) for x in side("bi_n", np.uint32)])
    quanta = np.frexp(np.concatenate([uni_n, bi_n]).astype(np.float64))[1]      # 1 + floor(log2 n)
    halves = (2 * _mean_counts()[quanta]).astype(np.int64)
    h, h_sum = _count([unmix64(bi) & CONTEXT], [halves[len(uni):]])
    keys = np.concatenate([uni, bi])
    levels = [(keys[quanta >= j], j) for j in range(1, int(quanta.max(initial=0)) + 1)]
    events, packed = _filter(levels)
    return pa.table({"seg": pa.array([table.column("seg")[0].as_py()], pa.int32()),
                     "tokens": pa.array([int(uni_n.sum())], pa.int64()),
                     "types": pa.array([len(uni)], pa.int64()),
                     "halves": pa.array([int(halves[:len(uni)].sum())], pa.int64()),
                     "events": pa.array([events], pa.int64()),
                     "uni": pa.array([uni.tobytes()], pa.binary()),
                     "uni_n": pa.array([uni_n.astype(np.int64).tobytes()], pa.binary()),
                     "filter": pa.array([packed], pa.binary()),
                     "h": pa.array([h.tobytes()], pa.binary()),
                     "h_sum": pa.array([h_sum.tobytes()], pa.binary())})


def _filter(levels: list[tuple[np.ndarray, int]]) -> tuple[int, bytes]:
    """(events, packed bits) of a filter that holds all (keys, event) of ``levels``."""
    events = sum(len(keys) for keys, _ in levels)
    bits = max(64, -(-events * BITS_PER_EVENT // 64) * 64)
    flags = np.zeros(bits, bool)
    for keys, j in levels:
        for at in _positions(keys, j, np.uint64(bits)):
            flags[at] = True
    return events, np.packbits(flags, bitorder="little").tobytes()


def _sums(segments: int):
    """Deal the contexts' sums out by the contexts' own segments, added up per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, size = [], [], 0

        def flush():
            h, n = _count(keys, sums)
            keys.clear()
            sums.clear()
            seg, columns = _by_segment(h, [h, n], segments)
            return pa.record_batch([pa.array(seg, pa.int32()), *columns], schema=SUMS)
        for batch in batches:
            for h, n in zip(batch.column("h"), batch.column("h_sum")):
                keys.append(np.frombuffer(h.as_py(), np.uint64))
                sums.append(np.frombuffer(n.as_py(), np.int64))
                size += len(keys[-1])
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()
    return run


def _rounded(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponent, ``STEP_BITS`` bits below the first) of each number, rounded up."""
    exponent = np.frexp(halves.astype(np.float64))[1] - 1
    steps = np.ceil((halves / 2.0 ** exponent - 1) * (1 << STEP_BITS)).astype(np.int64)
    over = steps >> STEP_BITS
    return exponent + over, np.where(over > 0, 0, steps)


def _build_contexts(table: pa.Table) -> pa.Table:
    """The filter of one segment of contexts. A sum is 2 halves or more, so the exponent
    is the number of its events; then one event per bit that is set."""
    h, n = _count([np.frombuffer(x, np.uint64) for x in table.column("h").to_pylist()],
                  [np.frombuffer(x, np.int64) for x in table.column("h_sum").to_pylist()])
    exponent, steps = _rounded(n)
    levels = [(h[exponent >= j], j) for j in range(1, int(exponent.max(initial=0)) + 1)]
    levels += [(h[(steps >> k) & 1 == 1], 64 + k) for k in range(STEP_BITS)]
    events, packed = _filter(levels)
    return pa.table({"seg": pa.array([table.column("seg")[0].as_py()], pa.int32()),
                     "events": pa.array([events], pa.int64()), "filter": pa.array([packed], pa.binary())})


def _positions(keys: np.ndarray, j: int, bits: np.ndarray):
    """The PROBES bit positions of event (n-gram, j), one array each."""
    with np.errstate(over="ignore"):
        a = mix64(keys + np.uint64(j) * EVENT)
        b = mix64(a) | np.uint64(1)
        for _ in range(PROBES):
            yield (a >> np.uint64(32)) * bits >> np.uint64(32)      # a segment has fewer than 2^32 bits
            a = a + b


def train(docs: DataFrame, segments: int | None = None) -> DataFrame:
    """One row per segment: token and type counts, exact unigram counts and the
    Bloom filter; the segments of the contexts follow, from number ``segments`` on.
    ``docs`` are the training rows."""
    ready(docs.sparkSession)
    texts = docs.select("text")
    segments = segments or max(256, 8 * texts.rdd.getNumPartitions())
    parts = texts.mapInArrow(_gather(segments), "seg int, uni binary, uni_n binary, bi binary, bi_n binary")
    grams = materialise(parts.groupBy("seg").applyInArrow(
        _build, "seg int, tokens long, types long, halves long, events long, uni binary, uni_n binary, filter binary, "
        "h binary, h_sum binary"), "lm")
    sums = grams.select("h", "h_sum").mapInArrow(_sums(segments), "seg int, h binary, h_sum binary")
    contexts = materialise(sums.groupBy("seg").applyInArrow(
        _build_contexts, "seg int, events long, filter binary"), "lm-contexts")
    return grams.drop("h", "h_sum").unionByName(
        contexts.withColumn("seg", F.col("seg") + segments), allowMissingColumns=True) \
        .withColumn("segments", F.lit(segments))


def token_counts(model: DataFrame) -> DataFrame:
    """Exact (token hash, count) of the training rows."""
    def run(batches):
        for batch in batches:
            for k, n in zip(batch.column("uni"), batch.column("uni_n")):
                yield pa.record_batch([pa.array(np.frombuffer(k.as_py(), np.int64)),
                                       pa.array(np.frombuffer(n.as_py(), np.int64))], names=["key", "n"])
    return model.filter("uni IS NOT NULL").select("uni", "uni_n").mapInArrow(run, "key long, n long")


class Filter:
    """A run of segments ready for probing."""

    def __init__(self, data: bytes | bytearray, held: list[tuple[int, int]], segments: int):
        """``held``: (segment, bytes) in the order of ``data``."""
        self.segments = segments
        self.bits = np.zeros(2 * segments, np.uint64)
        self.start = np.zeros(2 * segments, np.uint64)
        at = 0
        for seg, size in held:
            self.bits[seg], self.start[seg] = size * 8, at * 8
            at += size
        self.data = np.frombuffer(data, np.uint8)

    def quanta(self, keys: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Quantised count of each n-gram, not probed beyond ``most``; 0: absent (or in
        another shard)."""
        return self._levels(keys, _segment(keys, self.segments), most)

    def sums(self, contexts: np.ndarray) -> np.ndarray:
        """The sum of each context in halves, as one number: exponent and bits below the
        first; 0: no such context (or in another shard)."""
        seg = _segment(contexts, self.segments) + self.segments
        exponent = self._levels(contexts, seg).astype(np.uint16)
        live = np.flatnonzero(exponent)
        steps = np.zeros(len(contexts), np.uint16)
        for k in reversed(range(STEP_BITS)):
            live = live[exponent[live] >= STEP_BITS - k]        # a small sum has no lower bits
            steps[live[self._hits(contexts, seg, live, 64 + k)]] |= np.uint16(1 << k)
        return exponent << np.uint16(STEP_BITS) | steps

    def _levels(self, keys: np.ndarray, seg: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros(len(keys), np.uint8)
        live = np.flatnonzero(self.bits[seg])
        j = 1
        while len(live):
            live = live[self._hits(keys, seg, live, j)]
            out[live] = j
            if most is not None:
                live = live[most[live] > j]
            j += 1
        return out

    def _hits(self, keys: np.ndarray, seg: np.ndarray, live: np.ndarray, j: int) -> np.ndarray:
        """Which of ``live`` have event j, in blocks whose arrays stay in the cache."""
        found = [a + self._probe(keys[live[a:a + BLOCK]], seg[live[a:a + BLOCK]], j)
                 for a in range(0, len(live), BLOCK)]
        return np.concatenate(found) if found else live

    def _probe(self, keys: np.ndarray, seg: np.ndarray, j: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            at = mix64(keys + np.uint64(j) * EVENT)
        step = mix64(at) | np.uint64(1)
        bits, start = self.bits[seg], self.start[seg]
        hit = np.arange(len(keys))

        def held(i: int) -> np.ndarray:
            bit = ((at + np.uint64(i) * step >> np.uint64(32)) * bits >> np.uint64(32)) + start
            return self.data[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)
        # the first two probes turn most absent events away, the others are read together
        for probes in ((0,), (1,), range(2, PROBES)):
            ok = np.flatnonzero(np.bitwise_and.reduce([held(i) for i in probes]))
            if len(ok) < len(hit):
                at, step, bits, start, hit = at[ok], step[ok], bits[ok], start[ok], hit[ok]
        return hit


def _mean_counts() -> np.ndarray:
    """Mean count of each quantum: 0, 1, 2.5, 5.5, .."""
    q = np.arange(64, dtype=np.float64)
    return np.where(q == 0, 0, (2.0 ** (q - 1) + 2.0 ** q - 1) / 2)


def _held_sums() -> np.ndarray:
    """The sum behind each number of ``Filter.sums``."""
    x = np.arange(64 << STEP_BITS)
    return np.where(x == 0, 0, 2.0 ** ((x >> STEP_BITS) - 1) * (1 + (x % (1 << STEP_BITS)) / (1 << STEP_BITS)))


def bigram_log10(uni: np.ndarray, bi: np.ndarray, context: np.ndarray, halves: int, n_types: int) -> np.ndarray:
    """log10 P(w|h) from the quanta of w and hw and the held sum of h."""
    mean, s = _mean_counts(), _held_sums()[context]
    c_w = mean[uni]
    p_w = (c_w + ALPHA) / (halves / 2 + ALPHA * (n_types + 1))
    return np.log10((np.minimum(mean[np.minimum(bi, uni)], s) + MU * p_w) / (s + MU))


def _score_texts(shard, frequent, totals, last: bool, first: bool):
    """Fill in this shard's quanta; the last shard also yields the scores."""
    halves, n_types = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = Filter(*shard.value)
        keys, counts = frequent.value
        for batch in slices(batches, limit=2 << 20):
            starts, tokens = _tokens(batch.column("text"))
            ends = np.r_[starts[1:], len(tokens)] if len(starts) else starts
            bigrams = _bigrams(starts, tokens)[1]
            inverse, types = pd.factorize(tokens)
            uni = filt.quanta(types)[inverse]
            place, bigrams = pd.factorize(bigrams)
            most = None
            if first and last:          # a bigram is counted no more often than its token; one shard does not tell
                most = np.empty(len(bigrams), np.uint8)
                most[place] = uni
            bi = filt.quanta(bigrams, most)[place]
            sums = np.empty(len(tokens), np.uint16)
            sums[1:] = filt.sums(context_keys(types))[inverse][:-1]
            sums[starts] = filt.sums(context_keys(np.array([START])))
            if not first:
                before = np.frombuffer(b"".join(batch.column("quanta").to_pylist()), np.uint16).reshape(-1, 3).T
                uni, bi, sums = np.maximum(uni, before[0]), np.maximum(bi, before[1]), np.maximum(sums, before[2])
            if not last:
                rows = np.stack([uni.astype(np.uint16), bi.astype(np.uint16), sums], 1)
                packed = [rows[a:b].tobytes() for a, b in zip(starts, ends)]
                yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "row", "held_out", "text")),
                                       pa.array(packed, pa.binary())],
                                      names=["doc_id", "row", "held_out", "text", "quanta"])
                continue
            logs = bigram_log10(uni, bi, sums, halves, n_types)
            at = np.searchsorted(keys, tokens)
            at[at == len(keys)] = 0
            known = keys[at] == tokens if len(keys) else np.zeros(len(tokens), bool)
            base = np.where(known, np.log10((counts[at] if len(keys) else 0) + ALPHA), 0.0)
            rest = ~known
            owner = np.repeat(np.arange(len(starts)), ends - starts)
            rare_n = np.bincount(owner[rest], minlength=len(starts))
            rare = np.split(tokens[rest].view(np.int64), np.cumsum(rare_n)[:-1]) if len(starts) else []
            yield pa.record_batch([
                batch.column("doc_id"), batch.column("row"), batch.column("held_out"),
                pa.array(ends - starts, pa.int64()),
                pa.array(np.bincount(owner, known, len(starts)).astype(np.int64)),
                pa.array(np.bincount(owner, base, len(starts))),
                pa.array(np.bincount(owner, logs, len(starts))),
                pa.array(rare, pa.list_(pa.int64()))],
                names=["doc_id", "row", "held_out", "n_tokens", "known", "base", "score", "rare"])
    return run


def score(docs: DataFrame, model: DataFrame, folds: int = FOLDS, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Score every row of ``docs`` with a model of ``train``."""
    spark = ready(docs.sparkSession)
    sc = spark.sparkContext
    total = model.agg(F.sum("tokens").alias("n"), F.sum("types").alias("v"), F.sum("halves").alias("u"),
                      F.max("segments").alias("s")).first()
    n_all, n_types, halves, segments = total["n"] or 0, total["v"] or 0, total["u"] or 0, total["s"] or 1
    counts = token_counts(model)
    top = counts.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()     # FREQUENT pairs of numbers at most
    keys = top.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    frequent = sc.broadcast((keys[order], top.column("n").to_numpy().astype(np.float64)[order]))
    del top
    # shards: runs of segments of SHARD_BYTES at most
    sizes = [(r["seg"], r["b"]) for r in model.select("seg", F.octet_length("filter").alias("b")).orderBy("seg").collect()]
    shards, room = [[]], SHARD_BYTES
    for seg, b in sizes:
        if b > room and shards[-1]:
            shards.append([])
            room = SHARD_BYTES
        shards[-1].append(seg)
        room -= b
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       held_out(id_col, folds).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for i, segs in enumerate(shards):
        low, high = (segs[0], segs[-1]) if segs else (0, -1)
        part = model.filter(F.col("seg").between(low, high)).select("seg", "filter")
        data, held = bytearray(), []
        for r in part.toLocalIterator():
            held.append((r["seg"], len(r["filter"])))
            data += r["filter"]
        shard = sc.broadcast((data, held, segments))
        del data
        last = i == len(shards) - 1
        types = ("n_tokens long, known long, base double, score double, rare array<long>" if last
                 else "text string, quanta binary")
        rows = materialise(rows.mapInArrow(
            _score_texts(shard, frequent, (halves, n_types), last, i == 0),
            f"doc_id {docs.schema[id_col].dataType.simpleString()}, row long, held_out boolean, {types}"), "lm-rows")
        shard.unpersist()
    # the tokens beyond the broadcast table meet the exact counts
    rare = rows.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("k"))
    found = rare.join(counts, "key", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("k"),
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ALPHA))).alias("b"))
    scale = F.log10(F.lit(n_all + ALPHA * (n_types + 1)))
    return rows.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"), "score")


def fit_and_score(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Learn from the rows that are not held out, score all rows."""
    return score(docs, train(docs.filter(~held_out("doc_id", folds))), folds)
