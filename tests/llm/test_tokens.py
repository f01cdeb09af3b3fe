"""Tokenizing and packing: exact against the tokenizers library, exact round trips."""
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from paneltide.llm import bin_packing, bpe
from paneltide.llm.queries import QUERIES
from tests.llm.helpers import ODD, docs_of, edge_docs, prose, stored

SMALL = "/root/testdata/sf0.001"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
MORE = ["\x1c\x1d a\x85b\xa0c d", "x́ ́y", "ΑΣ Σας İstanbul", "ab" * 800 + " " * 40, " \n\n  lead and trail \t "]


def test_bpe_equals_the_library(spark, tmp_path):
    t = Tokenizer.from_file(BYTE)
    texts = [*ODD, *MORE]
    for r in bpe.digests(stored(spark, tmp_path, docs_of(spark, texts)), BYTE).collect():
        ids = t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = t.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_bpe_on_documents_and_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["text"] for r in docs.collect()}
    t = Tokenizer.from_file(BYTE)
    coded = bpe.encode(docs, BYTE)
    assert all(r["ids"] == t.encode(truth[r["doc_id"]], add_special_tokens=False).ids for r in coded.collect())
    assert {r["doc_id"]: r["text"] for r in bpe.decode(coded, BYTE).collect()} == truth


def test_stale_entries_and_a_full_cache():
    c = bpe.Codec(bpe.codec(BYTE).vocabulary)
    t = Tokenizer.from_file(BYTE)
    old, bpe.CACHE = bpe.CACHE, 3
    try:
        for text in ("aaaa aaa aa banana bananas ananas", "the theft thefts of there " * 5):
            assert c.encode(text) == t.encode(text, add_special_tokens=False).ids
    finally:
        bpe.CACHE = old


def check_packing(rows, texts):
    t = Tokenizer.from_file(WORD)
    by_bin, used = {}, 0
    for d, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        used += len(ids)
        pieces = sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(ids), 2048))
        for r in pieces:
            part = ids[r["start"]:r["start"] + 2048]
            assert r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for r in rows:
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_bin), -(-used // 2048)


def test_packing_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    bins, least = check_packing(QUERIES["op9_min_bin_slack"](spark, SMALL).collect(), texts)
    assert bins <= least + 2


def test_packing_odd_texts_and_ids(spark, tmp_path):
    texts = [*ODD, *MORE, prose(1, 5000), "a " * 2047, "a " * 2048]
    rows = bin_packing.pack(stored(spark, tmp_path, docs_of(spark, texts)), WORD, with_ids=True).collect()
    check_packing(rows, dict(enumerate(texts)))
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_fill_is_the_fullest_combination():
    rng = np.random.default_rng(3)
    for _ in range(60):
        counts = {int(k): int(v) for k, v in zip(rng.integers(3, 40, 5), rng.integers(1, 4, 5))}
        room = int(rng.integers(5, 90))
        sums = {0}
        for n, c in counts.items():
            for _ in range(c):
                sums |= {s + n for s in sums if s + n <= room}
        got = bin_packing.fill(counts, room)
        assert sum(n * k for n, k in got.items()) == max(sums) and all(k <= counts[n] for n, k in got.items())


def test_plan_places_every_rank_once():
    rng = np.random.default_rng(5)
    histogram = {int(n): int(c) for n, c in zip(rng.integers(1, 2049, 300), rng.integers(1, 5000, 300))} | {2048: 7, 100: 10 ** 6}
    rows, bins = bin_packing.plan(histogram)
    least = -(-sum(n * c for n, c in histogram.items()) // 2048)
    assert bins <= least * 1.02 + 2
    for n, c in histogram.items():
        starts = sorted(r[1] for r in rows if r[0] == n)
        assert starts[0] == 0 and len(set(starts)) == len(starts) and starts[-1] < c


def test_edge_rows_keep_the_id_type(spark, tmp_path):
    out = bpe.digests(stored(spark, tmp_path, edge_docs(spark)), BYTE)
    assert dict(out.dtypes)["doc_id"] == "bigint"


def test_pieces_apart_equal_the_whole(monkeypatch):
    """Stops inside and behind words, contractions, marks of composition, special tokens in
    any case, and caches that are full at once; the ids are those of the whole text."""
    import random

    from tokenizers import Tokenizer

    from paneltide.llm import bin_packing
    library = Tokenizer.from_file(WORD)
    rng = random.Random(3)
    parts = ["word", "Word", "it's", "IT'S", ".'s", "a.b", "3.14", "x,y;z", "...", "?!", "é", "́.", "É.", "ç,a", "….", ".…",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|>.", "a<b", "<|", "|>", "ΣΑΣ.", "İ.", "漢字.", "don't.re", " ", "　x", "1,2", ":)", "\x00", "'", "'.ll"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "\n", "\t"]) for _ in range(rng.randrange(30))) for _ in range(300)]
    for size in (500_000, 3):
        monkeypatch.setattr(bin_packing, "CACHE", size)
        for a in range(0, len(texts), 50):
            bounds, ids = bin_packing._token_ids(pa.array(texts[a:a + 50]), WORD)
            for i, t in enumerate(texts[a:a + 50]):
                assert ids[bounds[i]:bounds[i + 1]].tolist() == [*library.encode(t, add_special_tokens=False).ids, 0], t


def test_pieces_of_one_key_are_told_apart(monkeypatch):
    coder = bin_packing.Encoder(WORD)
    raw, start, stop = np.frombuffer(b"onetwo", np.uint8), np.array([0, 3]), np.array([3, 6])
    key = np.array([7], np.uint64)
    pieces, at = coder.known(raw, key, np.array([1], np.uint64), start[:1], stop[:1])
    one = pieces.taken(at)[1].tolist()
    pieces, at = coder.known(raw, key, np.array([2], np.uint64), start[1:], stop[1:])
    assert pieces.taken(at)[1].tolist() == coder.tokenizer.encode("two", add_special_tokens=False).ids != one
