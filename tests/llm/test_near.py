"""SimHash and ProbMinHash against brute force."""
import hashlib
import random

import numpy as np
import xxhash

from paneltide.llm import prob_minhash, simhash
from tests.llm.helpers import ODD, docs_of, prose, stored

M = (1 << 64) - 1


def spark_hash(*words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed


def brute_print(text):
    import re
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    terms = [spark_hash(*p) for p in zip(words, words[1:])] or [spark_hash(w) for w in words]
    if not terms:
        return 0
    return sum(1 << b for b in range(64) if 2 * sum(t >> b & 1 for t in terms) > len(terms))


def test_fingerprints_and_edits(spark, tmp_path):
    texts = [t for t in ODD if t is None or len(t) < 5000] + [prose(i, 80) for i in range(30)] + [prose(3, 80)]
    rows = {r["doc_id"]: r for r in simhash.report(stored(spark, tmp_path, docs_of(spark, texts)), 1).collect()}
    prints = [brute_print(t) for t in texts]
    n = len(texts)
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % n] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + following[:q]
        r, like = rows[i], lambda a, b: 1 - bin(a ^ b).count("1") / 64
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert int(r["fingerprint"], 16) == prints[i] and int(r["edited_fingerprint"], 16) == brute_print(edited)
        assert r["near_edited"] == like(prints[i], brute_print(edited)) and r["near_next"] == like(prints[i], prints[(i + 1) % n])
        assert r["n_near"] == sum(bin(prints[i] ^ p).count("1") <= simhash.RADIUS for p in prints)


def test_block_tables_find_all_within_the_radius(spark):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(60)]
    prints = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base for _ in range(4)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {x["fp"] & M: x["n_near"] for x in simhash.search(df, df).collect()}
    assert got == {p: sum(bin(p ^ q).count("1") <= 3 for q in prints) for p in prints}


def test_order_with_ties_gaps_and_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "QUANTILES", 8)
    ids = [5, 5, 1, 900000, 17, -3, 900001, 44, 45, 46, 1 << 40, None]
    df = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = sorted((r for r in simhash.with_next(stored(spark, tmp_path, df)).collect()), key=lambda r: (
        r["doc_id"] is not None, r["doc_id"], r["text"]))
    for a, b in zip(got, got[1:] + got[:1]):
        assert a["next_text"] == b["text"] and (a["next_range"], a["next_nr"]) == (b["range"], b["nr"])


def jaccard(x, y):
    """Probability Jaccard by its definition."""
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)


def bag(text):
    w = text.lower().split()
    k = min(5, len(w))
    out = {}
    for i in range(len(w) - k + 1):
        out[tuple(w[i:i + k])] = out.get(tuple(w[i:i + k]), 0) + 1
    return out


def test_similarity_is_the_probability_jaccard():
    r = random.Random(5)
    for _ in range(40):
        x = {k: r.randrange(1, 6) for k in r.sample(range(30), r.randrange(1, 20))}
        y = {k: r.randrange(1, 6) for k in r.sample(range(30), r.randrange(1, 20))}
        side = lambda s: (np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)], float))
        assert abs(prob_minhash.similarity(side(x), side(y)) - jaccard(x, y)) < 1e-12


def test_signatures_estimate_it():
    r = random.Random(6)
    x = {k: r.randrange(1, 4) for k in range(300)}
    y = {k: (v if k % 5 else v + 2) for k, v in x.items() if k % 7}
    owner = np.array([0] * len(x) + [1] * len(y))
    keys = np.array([*x, *y], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weight = np.array([*x.values(), *y.values()], float)
    sig = prob_minhash.signatures(2, owner, keys, weight, 4000)
    assert abs((sig[0] == sig[1]).mean() - jaccard(x, y)) < 0.03


def test_register_bits_agree_for_pairs_at_the_threshold():
    r = random.Random(9)
    worst = 512
    for k in range(30):
        keys = np.array([r.getrandbits(63) for _ in range(400)], np.uint64)
        own = np.r_[np.zeros(360, int), np.ones(360, int)]                    # 320 of 400 shared: 0.8
        both = np.r_[keys[:360], keys[40:]]
        sig = prob_minhash.signatures(2, own, both, np.ones(len(own)))
        x, y = (list(map(int, v)) for v in prob_minhash.register_bits(sig).view(np.uint64))
        unlike = [0] * 8
        for i, (p, q) in enumerate(zip(x, y)):
            unlike[i % 8] |= p ^ q
        worst = min(worst, 512 - sum(bin(u).count("1") for u in unlike))
    assert worst >= prob_minhash.AGREE


def changed(text, seed, n):
    r, w = random.Random(seed), text.split()
    for i in r.sample(range(len(w)), n):
        w[i] = f"changed{seed}"
    return " ".join(w)


def test_classes_equal_brute_force(spark, tmp_path):
    texts = [prose(i, 150) for i in range(25)]
    texts += [changed(texts[i % 5], 100 + i, 1 + i % 6) for i in range(60)]     # near groups round a base
    texts += [texts[3], texts[3] + " ", texts[7], "one two", "one  two", "three", None, "", " "]
    step = texts[10]
    for i in range(8):                                                          # a chain of small steps
        step = changed(step, 500 + i, 2)
        texts.append(step)
    bags = [bag(t) if t else {} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    docs = stored(spark, tmp_path, docs_of(spark, texts))
    got = prob_minhash.classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in range(len(texts))}
    assert sum(r["is_representative"] for r in got) == len({find(i) for i in range(len(texts))})
    kept = prob_minhash.representatives(docs).collect()
    assert {r["doc_id"] for r in kept} == {find(i) for i in range(len(texts))}


def test_other_splits_between_the_jobs_change_nothing(spark, tmp_path, monkeypatch):
    texts = [prose(i % 12, 90) for i in range(40)] + [changed(prose(i, 90), i, 1) for i in range(12)]
    path = str(tmp_path / "many")
    docs_of(spark, texts).repartition(6, "doc_id").write.parquet(path)
    store, key = prob_minhash.materialise, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)

    def then_other_splits(df, label):
        out = store(df, label)
        spark.conf.set(key, "256" if label == "sketch" else before)
        return out
    monkeypatch.setattr(prob_minhash, "materialise", then_other_splits)
    try:
        kept = prob_minhash.representatives(spark.read.parquet(path))
        spark.conf.set(key, "256")
        assert {r["doc_id"] for r in kept.collect()} == set(range(12))
    finally:
        spark.conf.set(key, before)


def test_connected_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + r.randrange(60), 100 + r.randrange(60)) for _ in range(40)] + [(900, k) for k in range(901, 960)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in prob_minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
