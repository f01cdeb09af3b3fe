"""Language identification: interpolated Kneser-Ney character language models,
one per language, in sorted hash arrays; the language of the lowest
length-normalised cross-entropy wins, with calibrated rejection.

Texts are reduced to lower-case letters with single spaces between words. The
models are fitted on a bounded sample, ``SAMPLE`` documents a language (those with
the smallest hash of their id), counted as a Spark aggregate. n-grams up to
``ORDER`` characters live in one sorted array of 64-bit hashes a level, with
a row of log probabilities, one per language, beside each; contexts likewise
with back-off weights. An n-gram that no language has seen backs off:
log P(c|h) = log gamma(h) + log P(c|h').

Rejection: on a calibration fold of the sample each language's cross-entropies
give a mean and a spread that shrinks with length; a text whose best
cross-entropy lies over ``REJECT`` spreads above the mean of its language belongs
to none of them. ``score`` is the softmax over languages of -beta * sqrt(length) *
cross-entropy with beta fitted on that fold.

Defined cases: null text or text without a letter: ``und``, score 0, rejected;
null ``lang`` rows are never learned from; ties of the cross-entropy go to the
language first in order; repeated rows are treated alike; without any labelled
row all texts are ``und``; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.common import fresh, held_out, ready, slices

FOLDS = 5
ORDER = 5
SAMPLE = 1000                  # documents a language
DISCOUNT = 0.75
REJECT = 8.0
CHUNK = 1 << 19                # characters handled at once
UNDETERMINED = "und"
SALT = np.uint64(0x9E6C63D0676A9A99)


def letters_only(text):
    """Lower-case letters; runs of anything else become one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+", " "))


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first position of each text, code points); a text is framed by spaces."""
    words = [" " * (ORDER - 1) + t + " " if t else "" for t in texts.to_pylist()]
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return np.cumsum([0, *(len(w) for w in words)]), flat


def _hash_at(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that end at each position."""
    out = np.full(len(at), np.uint64(n), np.uint64) * SALT
    first = at - n + 1
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ codes[first + i]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(29)
    return out


def _positions(starts: np.ndarray) -> np.ndarray:
    """Positions of the characters that are predicted: all but the leading spaces."""
    return np.concatenate([np.arange(a + ORDER - 1, b) for a, b in zip(starts, starts[1:]) if b > a]
                          or [np.zeros(0, np.int64)]).astype(np.int64)


def _ngram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, level, n-gram, context, suffix, count) of each slice of the sample.
    ``suffix`` is the n-gram without its first character."""
    for batch in slices(batches, "letters"):
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            starts, codes = _codes(batch.column("letters").filter(pa.array(langs == lang)))
            at = _positions(starts)
            for n in range(1, ORDER + 1):
                if not len(at):
                    continue
                grams = _hash_at(codes, at, n)
                keys, first, counts = np.unique(grams, return_index=True, return_counts=True)
                where = at[first]
                context = _hash_at(codes, where - 1, n - 1) if n > 1 else np.zeros(len(keys), np.uint64)
                suffix = _hash_at(codes, where, n - 1) if n > 1 else np.zeros(len(keys), np.uint64)
                yield pa.record_batch(
                    [pa.array([lang] * len(keys)), pa.array([n] * len(keys), pa.int32()),
                     *(pa.array(x.view(np.int64)) for x in (keys, context, suffix)),
                     pa.array(counts.astype(np.int64))],
                    names=["lang", "n", "gram", "context", "suffix", "count"])


@dataclass
class Models:
    """Per level: sorted n-gram hashes with log P per language, and sorted
    context hashes with log gamma per language."""
    langs: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    gamma: list[np.ndarray]
    unseen: np.ndarray
    limits: np.ndarray | None = None       # mean, floor and length part of the spread, per language
    beta: float = 1.0

    def log_probs(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log2 P of the character at each position, per language."""
        out = np.zeros((len(at), len(self.langs)), np.float32)
        rest = np.arange(len(at))
        for n in range(ORDER, 0, -1):
            i, seen = _find(self.grams[n - 1], _hash_at(codes, at[rest], n))
            out[rest[seen]] += self.logp[n - 1][i[seen]]
            rest = rest[~seen]
            if not len(rest):
                return out
            if n > 1:
                i, seen = _find(self.contexts[n - 1], _hash_at(codes, at[rest] - 1, n - 1))
                out[rest[seen]] += self.gamma[n - 1][i[seen]]
        out[rest] += self.unseen
        return out

    def cross_entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(characters, bits per character by language) of each text."""
        starts, codes = _codes(texts)
        n = np.maximum(np.diff(starts) - (ORDER - 1), 0)
        bits = np.zeros((len(n), len(self.langs)))
        at = _positions(starts)
        if len(at):
            owner = np.repeat(np.arange(len(n)), n)
            for a in range(0, len(at), CHUNK):
                own = owner[a:a + CHUNK]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                bits[own[first]] -= np.add.reduceat(
                    self.log_probs(codes, at[a:a + CHUNK]).astype(np.float64), first, axis=0)
        return n, bits / np.maximum(n, 1)[:, None]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    i = np.searchsorted(table, keys)
    i[i == len(table)] = 0
    return i, table[i] == keys


def _fit(counts, langs: list[str]) -> Models:
    """Interpolated Kneser-Ney per language from (lang, n, gram, context, suffix,
    count): raw counts at the top level, numbers of distinct left neighbours
    (distinct longer n-grams with this suffix) below."""
    size = len(langs)
    counts["l"] = counts["lang"].map({x: i for i, x in enumerate(langs)})
    levels = {n: g for n, g in counts.groupby("n")}
    value: dict[int, dict[int, np.ndarray]] = {}
    grams, contexts = [], []
    union = {}
    for n in range(1, ORDER + 1):
        g = levels[n]
        names, first = np.unique(g["gram"].to_numpy().view(np.uint64), return_index=True)
        union[n] = (names, g["context"].to_numpy().view(np.uint64)[first], g["suffix"].to_numpy().view(np.uint64)[first])
        grams.append(names)
        contexts.append(np.unique(union[n][1]))
    for n in range(1, ORDER + 1):
        value[n] = np.zeros((len(grams[n - 1]), size))
        if n == ORDER:
            g = levels[n]
            value[n][np.searchsorted(grams[n - 1], g["gram"].to_numpy().view(np.uint64)), g["l"].to_numpy()] = g["count"]
        else:                       # continuation counts
            g = levels[n + 1]
            i, ok = _find(grams[n - 1], g["suffix"].to_numpy().view(np.uint64))
            np.add.at(value[n], (i[ok], g["l"].to_numpy()[ok]), 1.0)
    logp, gamma = [], []
    lower = None
    vocabulary = len(grams[0]) + 1
    for n in range(1, ORDER + 1):
        names, context, suffix = union[n]
        c = value[n]
        at = np.searchsorted(contexts[n - 1], context)
        total = np.zeros((len(contexts[n - 1]), size))
        kinds = np.zeros_like(total)
        np.add.at(total, at, c)
        np.add.at(kinds, at, (c > 0).astype(float))
        back = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
        below = np.full((len(names), size), 1.0 / vocabulary) if n == 1 else \
            lower[np.searchsorted(grams[n - 2], suffix) % max(1, len(lower))]
        p = np.maximum(c - DISCOUNT, 0) / np.maximum(total[at], 1) + back[at] * below
        lower = p
        logp.append(np.log2(p).astype(np.float32))
        gamma.append(np.log2(back).astype(np.float32))
    unseen = (gamma[0][0] if len(gamma[0]) else np.zeros(size)) - np.log2(vocabulary)
    return Models(langs, grams, logp, contexts, gamma, unseen.astype(np.float32))


def _calibrate(models: Models, table) -> None:
    """Spread of the right language's cross-entropy and sharpness of the score,
    from (lang, n, bits) of the calibration fold."""
    size = len(models.langs)
    limits = np.tile([6.0, 0.2, 2.0], (size, 1))
    for i, lang in enumerate(models.langs):
        own = table[table["lang"] == lang]
        if not len(own):
            continue
        x, n = np.array([b[i] for b in own["bits"]]), own["n"].to_numpy()
        weight = n / n.sum()
        mean = float((weight * x).sum())
        # variance = floor^2 + part^2 / n; the part from short texts, the floor from long ones
        part = float(np.sqrt(np.median(n * (x - mean) ** 2) / 0.455)) + 0.5
        long = np.abs(x - mean)[n >= np.median(n)]
        limits[i] = mean, float(np.median(long) / 0.6745) + 0.02, part
    models.limits = limits
    if len(table) and size > 1:
        right = table["lang"].map({x: i for i, x in enumerate(models.langs)}).to_numpy()
        bits, n = np.stack(table["bits"].to_list()), table["n"].to_numpy()
        losses = []
        grid = [0.5, 1.0, 2.0, 4.0, 8.0]
        for beta in grid:
            z = -beta * np.sqrt(n)[:, None] * bits
            z -= z.max(1, keepdims=True)
            losses.append(-(z[np.arange(len(z)), right] - np.log(np.exp(z).sum(1))).mean())
        models.beta = grid[int(np.argmin(losses))]


def train(docs: DataFrame, folds: int = FOLDS, sample: int = SAMPLE) -> Models | None:
    """Fit on ``sample`` documents a language of those outside fold 0; fold 1 of
    the sample calibrates. ``lang`` null: not learned from."""
    spark = ready(docs.sparkSession)
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "lang", "text", key.alias("key")) \
        .filter((F.col("key") % folds != 0) & F.col("lang").isNotNull())
    # only ids take part in the choice; at most sample ids a language are broadcast
    w = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "doc_id")
    chosen = rows.select("doc_id", "lang", "key").withColumn("k", F.row_number().over(w)) \
        .filter(F.col("k") <= sample).select(F.col("doc_id").alias("id"), F.col("lang").alias("l"))
    picked = rows.join(F.broadcast(chosen.distinct()), F.col("doc_id").eqNullSafe(F.col("id"))
                       & (F.col("lang") == F.col("l")), "left_semi") \
        .select("lang", (F.col("key") % folds == 1).alias("check"), letters_only(F.col("text")).alias("letters")) \
        .filter(F.length("letters") > 0)
    grams = picked.filter(~F.col("check")).select("lang", "letters").mapInArrow(
        _ngram_counts, "lang string, n int, gram long, context long, suffix long, count long") \
        .groupBy("lang", "n", "gram").agg(F.first("context").alias("context"), F.first("suffix").alias("suffix"),
                                          F.sum("count").alias("count"))
    counts = grams.toArrow().to_pandas()   # bounded by the sample
    if not len(counts):
        return None
    langs = sorted(counts["lang"].unique())
    models = _fit(counts, langs)
    held = spark.sparkContext.broadcast(models)

    def measure(batches):
        for batch in slices(batches, "letters"):
            n, bits = held.value.cross_entropies(batch.column("letters"))
            yield pa.record_batch([batch.column("lang"), pa.array(n), pa.array(list(bits), pa.list_(pa.float64()))],
                                  names=["lang", "n", "bits"])
    table = picked.filter("check").select("lang", "letters").mapInArrow(
        measure, "lang string, n long, bits array<double>").toArrow().to_pandas()
    _calibrate(models, table[table["lang"].isin(langs)])
    return models


def _predict(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = models.value
        for batch in slices(batches, "letters"):
            rest = [batch.column(c) for c in batch.schema.names if c != "letters"]
            names = [c for c in batch.schema.names if c != "letters"]
            if m is None:
                pred, score = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
                bits, ok = np.full(batch.num_rows, np.nan), np.zeros(batch.num_rows, bool)
            else:
                n, all_bits = m.cross_entropies(batch.column("letters"))
                best = all_bits.argmin(1)
                bits = all_bits[np.arange(len(n)), best]
                z = m.beta * np.sqrt(n)[:, None] * (bits[:, None] - all_bits)
                score = np.where(n > 0, 1 / np.exp(np.maximum(z, -700)).sum(1), 0.0)
                mean, floor, part = m.limits[best].T
                ok = (n > 0) & (bits <= mean + REJECT * np.sqrt(floor ** 2 + part ** 2 / np.maximum(n, 1)))
                pred = [m.langs[i] if k else UNDETERMINED for i, k in zip(best, n)]
                bits = np.where(n > 0, bits, np.nan)
            yield pa.record_batch([*rest, pa.array(pred, pa.string()), pa.array(score), pa.array(bits),
                                   pa.array(ok)], names=[*names, "lang_pred", "score", "bits_per_char", "accepted"])
    return run


def predict(docs: DataFrame, models: Models | None, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_char and accepted of each row."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(models)
    rows = docs.select("doc_id", held_out("doc_id", folds).alias("held_out"),
                       letters_only(F.col("text")).alias("letters"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_predict(held), f"doc_id {kind}, held_out boolean, lang_pred string, score double, "
                           "bits_per_char double, accepted boolean")


def fit_and_predict(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is accepted as one of the learned languages,
    all columns as they were."""
    spark = ready(docs.sparkSession)
    held = spark.sparkContext.broadcast(train(docs))

    @F.pandas_udf("boolean")
    def passes(letters):
        m = held.value
        out = np.zeros(len(letters), bool)
        if m is not None:
            done = 0
            for batch in slices(iter([pa.record_batch([pa.array(letters, pa.string())], names=["letters"])]), "letters"):
                n, bits = m.cross_entropies(batch.column("letters"))
                best = bits.argmin(1)
                mean, floor, part = m.limits[best].T
                limit = mean + REJECT * np.sqrt(floor ** 2 + part ** 2 / np.maximum(n, 1))
                out[done:done + len(n)] = (n > 0) & (bits.min(1) <= limit)
                done += len(n)
        return pd.Series(out)
    name = fresh(docs, "ok_")
    return docs.withColumn(name, passes(letters_only(F.col("text")))).filter(F.col(name)).drop(name)
