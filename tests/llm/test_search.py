"""Decontamination and ranked search against plain Python."""
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from paneltide.llm import bag_search, byte_terms, decontaminate
from tests.llm.helpers import ODD, edge_docs, prose


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(byte_terms.PATTERN_LOWER, lower(text))


def docs_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row long, class string")


def items_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, item string")


def test_terms_equal_the_pattern():
    texts = [*ODD, "ab" * 70_000 + " c", "x " * 40_000, None, "end", "A", "\u0080z", "a\x00b"]
    got = byte_terms.terms(pa.array(texts))
    want = [words(t) for t in texts]
    assert got.counts.tolist() == [len(w) for w in want]
    table = {}
    for w, h in zip((w for ws in want for w in ws), got.hashes.tolist()):
        assert table.setdefault(w, h) == h
    assert len(set(table.values())) == len(table)
    assert byte_terms.terms(pa.array(texts).slice(3, 5)).counts.tolist() == [len(w) for w in want[3:8]]
    assert len(byte_terms.terms(pa.array([], pa.string())).counts) == 0


def test_shared_windows_share_a_fingerprint():
    rng = random.Random(1)
    for size in range(1, 11):
        body = [rng.randrange(9) for _ in range(size)]
        left, right = ([rng.randrange(9) for _ in range(20)] for _ in range(2))
        one = byte_terms.mix64(np.array(body, np.uint64))
        two = byte_terms.mix64(np.array(left + body + right, np.uint64))
        a = decontaminate.windows(np.array([size]), one, size)
        b = decontaminate.windows(np.array([len(two)]), two, size)
        hashes = decontaminate.window_hash(two, b[3], b[2], size)
        assert b[2][20] == a[2][0] and hashes[20] == decontaminate.window_hash(one, a[3], a[2], size)[0]


def brute_hits(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                got = wins.get(tuple(w[i:i + size]))
                if got:
                    found |= got
                    hit |= set(range(i, i + size))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    items = [(i, prose(i, rng.randrange(1, 40))) for i in range(30)]
    items += [(30, items[29][1]), (30, "two words"), (None, "w1 w2 w3"), (31, None), (32, "... !"), (33, "One"), (34, "漢字 é ½")]
    docs = [(i, prose(100 + i, rng.randrange(0, 300))) for i in range(60)]
    for i in range(60, 120):
        a, b = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        cut = b.split()[rng.randrange(3):][:rng.randrange(8, 14)]
        docs.append((i, f"{prose(i, 20)} {a.upper()}. {prose(i + 1, 5)}, {' '.join(cut)}-{prose(i, 9)}"))
    return docs + [(5, docs[70][1]), (5, docs[70][1]), (None, items[3][1]), (200, None), (201, ""), (202, "one"), (203, " 漢字, É é ½!")], items


def test_hits_equal_brute_force(spark, corpus):
    docs, items = corpus
    got = decontaminate.report(docs_frame(spark, docs), items_frame(spark, items)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_hits(docs, items)
    assert sum(r["contaminated"] for r in got) > 50


def test_spans_cover_the_hits(spark, corpus):
    docs, items = corpus
    found, sets = decontaminate.find(docs_frame(spark, docs), items_frame(spark, items))
    want = {(d, n): h for d, n, h, *_ in brute_hits(docs, items)}
    for r in found.filter("spans is not null").collect():
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == want[r["doc_id"], r["n_words"]]
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert {i for r in sets.collect() for i in r["items"]} <= {"" if i is None else str(i) for i, _ in items}


def test_common_passage_of_many_items_makes_no_pairs(spark):
    """Items that share a passage are one class of windows, whatever their number."""
    passage = prose(9, 40)
    items = items_frame(spark, [(i, f"{prose(500 + i, 3)} {passage}") for i in range(80)])
    known, members = decontaminate.item_classes(items)
    kinds = known.groupBy("class").count().collect()
    assert len(kinds) <= 2 * 80 and max(r["count"] for r in kinds) >= 31
    got = decontaminate.report(docs_frame(spark, [(i, f"{prose(i, 8)} {passage}") for i in range(50)]), items).collect()
    assert {(r["n_items"], r["n_hit"] >= 40) for r in got} == {(80, True)}


def test_empty_tables(spark):
    docs, items = docs_frame(spark, [(1, "a b c")]), items_frame(spark, [(1, "a b")])
    assert [r["n_hit"] for r in decontaminate.report(docs, items).collect()] == [2]
    assert [r["n_hit"] for r in decontaminate.report(docs, items.limit(0)).collect()] == [0]
    assert decontaminate.report(docs.limit(0), items).count() == 0
    assert bag_search.search(docs.limit(0), items).count() == 0 and bag_search.search(docs, items.limit(0)).count() == 0


def test_awkward_documents(spark):
    edge = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    items = [(1, "five"), (2, "word1 tail1"), (3, "É ñ 漢字"), (4, "Tie ONE of the same id here tie two of the same")]
    got = decontaminate.report(edge, items_frame(spark, items)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_hits(rows, items)
    found = bag_search.search(edge, items_frame(spark, items)).collect()
    assert sorted(tuple(r) for r in found if r["doc_id"] is not None) == sorted(
        x for x in brute_rank(rows, items) if x[2] is not None)


def brute_rank(docs, items, top=20):
    bags = []
    for doc, text in docs:
        w = words(text)
        if w:
            tf = {}
            for x in w:
                tf[x] = tf.get(x, 0) + 1
            bags.append((doc, len(w), tf))
    n_docs, n_terms = len(bags), sum(b[1] for b in bags)
    df = {}
    for _, _, tf in bags:
        for x in tf:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for doc, n, tf in bags:
            m = 75 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * tf[x]) // (1000 * tf[x] + 12 * m))
                    for x in words(text) if x in tf)
            if s > 0:
                scored.append((-s, (1 << 63) if doc is None else doc, doc))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: x[:2])[:top])]
    return out


@pytest.mark.parametrize("entries", [1 << 19, 40])
def test_ranks_equal_brute_force(spark, corpus, entries):
    """With copies, ties and repeated ids; in one block of items and in many."""
    docs, items = corpus
    docs = docs + [(1000 + i, docs[i % 7][1]) for i in range(150)] + [(900 - i, docs[3][1]) for i in range(30)]
    got = bag_search.search(docs_frame(spark, docs), items_frame(spark, items), entries=entries).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_rank(docs, items)))


def test_long_items_score_exactly(spark):
    """An item with sums beyond 2^53 is added up in whole numbers."""
    docs = [(i, prose(i, 30, 50)) for i in range(20)]
    index = bag_search.Index(np.array([0, 0]), np.array([0, 1]), np.array([9_100_000_001, 3]), 2)
    assert not index.exact
    s = index.scores(np.array([0, 0, 1]), np.array([0, 1, 1]), np.array([999_999, 999_998, 7]), 2)
    assert s.tolist() == [[9_100_000_001 * 999_999 + 3 * 999_998], [21]]
    items = [(1, " ".join(docs[0][1] for _ in range(5)))]
    got = bag_search.search(docs_frame(spark, docs), items_frame(spark, items)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_rank(docs, items))


def test_a_class_of_copies_is_scored_once(spark, tmp_path):
    text = prose(1, 60)
    docs = docs_frame(spark, [(i, text) for i in range(300, 0, -1)])
    bags = docs.selectExpr("doc_id", "cast(60 as long) n", "cast('12345678' as binary) bag", "doc_id row", "doc_id id")
    bags.write.parquet(str(tmp_path / "bags"))
    bags = spark.read.parquet(str(tmp_path / "bags"))
    members = bag_search._classes(bags, 20).collect()
    assert len(members) == 20 and [r["doc_id"] for r in sorted(members, key=lambda r: r["nth"])] == list(range(1, 21))
    plan = bag_search._classes(bags, 20)._jdf.queryExecution().toString()
    assert "row_number(), 20, Partial" in plan          # cut before the shuffle
