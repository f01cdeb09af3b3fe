"""LM scoring and language identification against brute force."""
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from paneltide.llm import language_id, lm_scoring
from paneltide.llm.queries import QUERIES
from tests.llm.helpers import docs_of, prose, stored

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def test_base_scores_are_exact_and_model_beats_them(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    train = [r["text"] for r in docs if zlib.crc32(str(r["doc_id"]).encode()) % 10]
    c = Counter(t for x in train for t in tokens(x))
    bi = Counter(p for x in train for p in zip([b""] + tokens(x), tokens(x)))
    n, v = sum(c.values()), len(c)
    quantum = lambda k: (2 ** (k.bit_length() - 1) + 2 ** k.bit_length() - 1) / 2 if k else 0
    got = {r["doc_id"]: r for r in QUERIES["op1_bloom_lm"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    means = quantum
    sums = Counter()
    for (h, _), k in bi.items():
        sums[h] += means(k)
    total = sum(means(k) for k in c.values())

    def held_sum(s):                                     # in halves, rounded up to 4 bits below the first
        unit = 2.0 ** (math.floor(math.log2(2 * s)) - lm_scoring.STEP_BITS) if s else 1
        return math.ceil(2 * s / unit) * unit / 2
    p = lambda w: (means(c[w]) + .1) / (total + .1 * (v + 1))
    assert math.isclose(sum(map(p, c)) + p(b" "), 1)
    off, gaps = 0, []
    for r in docs:
        t, g = tokens(r["text"]), got[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"]) == (len(t), sum(x in c for x in t), n)
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert math.isclose(g["base_score"], sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in t), rel_tol=1e-9)
        score = 0.0
        for h, w in zip([b""] + t, t):
            s = held_sum(sums[h])
            score += math.log10((means(bi[h, w]) + lm_scoring.MU * p(w)) / (s + lm_scoring.MU))
        gaps.append(abs(score - g["score"]) / len(t))
        off += gaps[-1] > 1e-9
    assert off < len(docs) and sorted(gaps)[len(gaps) // 2] < 0.01 and max(gaps) < 0.2      # the filter's false positives
    held = [g for g in got.values() if g["held_out"]]
    assert sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    counts = rng.integers(1, 50, len(keys)).astype(np.uint32)
    import pyarrow as pa
    part = pa.table({"seg": pa.array([0], pa.int32()), "uni": pa.array([keys.tobytes()]), "uni_n": pa.array([counts.tobytes()]),
                     "bi": pa.array([b""]), "bi_n": pa.array([b""])})
    built = lm_scoring._build(part).to_pylist()[0]
    assert built["tokens"] == counts.sum() and built["types"] == len(keys)
    f = lm_scoring.Filter(built["filter"], [(0, len(built["filter"]))], 1)
    true = np.frexp(counts.astype(float))[1]
    got = f.quanta(keys)
    assert (got >= true).all() and (got > true).mean() < 0.03
    assert (f.quanta(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.03


def test_probabilities_of_a_context_add_up(spark, tmp_path):
    """Over all tokens and an unknown one, read from the filter with its errors."""
    texts = [prose(i, 40 + i % 90, 30 + 20 * (i % 15)) for i in range(400)]
    docs = stored(spark, tmp_path, docs_of(spark, texts))
    model = lm_scoring.train(docs)
    rows = sorted(model.collect(), key=lambda r: r["seg"])
    f = lm_scoring.Filter(b"".join(r["filter"] for r in rows), [(r["seg"], len(r["filter"])) for r in rows], rows[0]["segments"])
    import pyarrow as pa
    starts, hashed = lm_scoring._tokens(pa.array(texts))
    context, bigrams = lm_scoring._bigrams(starts, hashed)
    vocabulary, true = np.unique(hashed), np.unique(bigrams)
    uni = f.quanta(np.r_[vocabulary, np.uint64(12345)])
    halves, types = sum(r["halves"] or 0 for r in rows), sum(r["types"] or 0 for r in rows)
    assert types == len(vocabulary)
    exact, over = [], []
    for h in np.unique(context):
        keys = lm_scoring.mix64(h | vocabulary & ~lm_scoring.CONTEXT)
        q = np.r_[f.quanta(keys), np.uint8(0)]
        real = np.where(np.r_[np.isin(keys, true), False], q, 0).astype(np.uint8)
        s = np.repeat(f.sums(np.array([h])), len(q))
        exact.append((10 ** lm_scoring.bigram_log10(uni, real, s, halves, types)).sum())
        over.append((10 ** lm_scoring.bigram_log10(uni, q, s, halves, types)).sum() - exact[-1])
    exact = np.array(exact)
    # false levels of true counts; false bigrams add their rate over the vocabulary
    assert np.mean((exact > 0.94) & (exact < 1.05)) > 0.97 and 0.95 < exact.mean() <= 1
    assert np.mean(over) < 2 * 0.004 * len(vocabulary) / lm_scoring.MU


def test_sums_of_contexts_are_rounded_up_by_a_sixteenth_at_most():
    n = np.r_[np.arange(2, 3000), np.array([1 << 40, (1 << 40) + 1, (1 << 41) - 1])]
    exponent, steps = lm_scoring._rounded(n)
    held = lm_scoring._held_sums()[exponent << lm_scoring.STEP_BITS | steps] * 2
    assert (held >= n).all() and (held <= n * (1 + 1 / 16)).all() and (held[n < 32] == n[n < 32]).all()


def test_several_shards_score_alike(spark, monkeypatch, tmp_path):
    docs = stored(spark, tmp_path, docs_of(spark, [prose(i, 60) for i in range(60)] + [None, ""]))
    one = {r["doc_id"]: r for r in lm_scoring.fit_and_score(docs).collect()}
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 1500)
    monkeypatch.setattr(lm_scoring, "FREQUENT", 3)
    many = {r["doc_id"]: r for r in lm_scoring.fit_and_score(docs).collect()}
    for k, r in one.items():
        assert math.isclose(r["score"], many[k]["score"], rel_tol=1e-9)
        assert math.isclose(r["base_score"], many[k]["base_score"], rel_tol=1e-9) and r["n_known"] == many[k]["n_known"]


def test_kneser_ney_equals_the_recursion(spark, tmp_path):
    texts = ["abra cadabra abra", "banana bandana", "abba baba", "un deux trois", "deux ou trois"] * 4
    langs = (["x"] * 3 + ["y"] * 2) * 4
    docs = stored(spark, tmp_path, docs_of(spark, texts, langs))
    models = language_id.train(docs)
    used = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 not in (0, 1)]
    assert models.langs == ["x", "y"]
    n_max, d = language_id.ORDER, language_id.DISCOUNT
    for li, lang in enumerate(models.langs):
        padded = [" " * (n_max - 1) + texts[i] + " " for i in used if langs[i] == lang]
        grams = {n: Counter(p[e - n + 1:e + 1] for p in padded for e in range(n_max - 1, len(p))) for n in range(1, n_max + 1)}
        value = {n_max: grams[n_max]} | {n: Counter(g[1:] for g in grams[n + 1]) for n in range(1, n_max)}
        both = {c for i in used for c in texts[i] + " "}
        total, kinds = defaultdict(float), defaultdict(int)
        for n in value:
            for g, k in value[n].items():
                total[n, g[:-1]] += k
                kinds[n, g[:-1]] += 1

        def p(g):
            n = len(g)
            if n == 0:
                return 1 / (len(both) + 1)
            h = (n, g[:-1])
            if not total[h]:
                return p(g[1:])
            return max(value[n][g] - d, 0) / total[h] + d * kinds[h] / total[h] * p(g[1:])
        for text in ("abra banana", "trois bandana", "zzz"):
            codes = " " * (n_max - 1) + text + " "
            want = [math.log2(p(codes[e - n_max + 1:e + 1])) for e in range(n_max - 1, len(codes))]
            arr = np.frombuffer(codes.encode("utf-32-le"), np.uint32).astype(np.uint64)
            got = models.log_probs(arr, np.arange(n_max - 1, len(codes)))[:, li]
            assert np.allclose(got, want, atol=1e-4)


def test_held_out_accuracy_and_rejection(spark):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    got = QUERIES["op2_kneser_ney_lid"](spark, MIDDLE).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(truth) and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]][0] for r in held]) >= 0.98
    assert np.mean([r["accepted"] for r in got if len(truth[r["doc_id"]][1]) > 50]) > 0.99


@pytest.mark.parametrize("text", ["xqzj kvwp qqxz zzkj vvwx " * 8, "привет как дела сегодня хорошо " * 8])
def test_foreign_text_is_rejected(spark, text, tmp_path):
    base = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text", "lang")
    models = language_id.train(base)
    out = language_id.predict(docs_of(spark, [text]), models).collect()[0]
    assert not out["accepted"] and out["lang_pred"] in models.langs
