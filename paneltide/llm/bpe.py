"""Byte-level BPE encoding and decoding.

The vocabulary, merge ranks and special tokens come from a tokenizer file (its
path is a parameter). A text is cut at special tokens, then into pre-tokens;
each pre-token is encoded by a priority queue of merge ranks over a doubly
linked list of symbols: the lowest rank, leftmost first, is merged, its two
neighbours' pairs are queued, and queue entries whose symbols have changed
since are skipped as stale. Decoding concatenates vocabulary strings and maps
them back to bytes; invalid UTF-8 becomes U+FFFD.

Encoded pre-tokens are kept in a bounded cache per worker.

Defined cases: a null text is empty (no ids); repeated rows are encoded alike;
a very long run without spaces takes n log n steps; an empty table gives an
empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.common import ready

# Fixed value: the pre-token pattern of byte-level BPE.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHE = 200_000                # pre-tokens per generation
CACHED_LENGTH = 64             # longer pre-tokens are not kept


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1
    bytes for themselves, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Token ids, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, text: str):
        data = json.loads(text)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # (left id, right id) -> (rank, merged id)
        self.merges = {(self.ids[a], self.ids[b]): (r, self.ids[a + b]) for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        self.strings = {i: s for s, i in self.ids.items()}
        self.alphabet = byte_alphabet()
        self.byte_ids = [self.ids[c] for c in self.alphabet]
        back = {c: b for b, c in enumerate(self.alphabet)}
        self.bytes = {i: bytes(back[c] for c in s) for i, s in self.strings.items() if all(c in back for c in s)}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") \
            if self.special else None

    def merge(self, symbols: list[int]) -> list[int]:
        """Byte ids of one pre-token -> token ids."""
        n = len(symbols)
        if n < 2:
            return symbols
        merges = self.merges
        queue = []
        for i in range(n - 1):
            m = merges.get((symbols[i], symbols[i + 1]))
            if m is not None:
                queue.append((m[0], i, symbols[i], symbols[i + 1], m[1]))
        if not queue:
            return symbols
        heapq.heapify(queue)
        after = list(range(1, n + 1))          # next symbol; n: none
        before = list(range(-1, n - 1))
        while queue:
            _, i, a, b, merged = heapq.heappop(queue)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue                       # stale: one of the two has changed
            k = after[j]
            symbols[i], symbols[j] = merged, -1
            after[i] = k
            if k < n:
                before[k] = i
                m = merges.get((merged, symbols[k]))
                if m is not None:
                    heapq.heappush(queue, (m[0], i, merged, symbols[k], m[1]))
            h = before[i]
            if h >= 0:
                m = merges.get((symbols[h], merged))
                if m is not None:
                    heapq.heappush(queue, (m[0], h, symbols[h], merged, m[1]))
        return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder with a cache of two generations: when the young one
    is full it becomes the old one, and what is still in use moves back up."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(PRE_TOKEN).findall
        self.young: dict[str, tuple[str, bytes]] = {}
        self.old: dict[str, tuple[str, bytes]] = {}

    def _piece(self, token: str) -> tuple[str, bytes]:
        """(ids joined by commas, decoded bytes) of one pre-token."""
        found = self.old.get(token)
        if found is None:
            v = self.vocabulary
            ids = v.merge([v.byte_ids[b] for b in token.encode()])
            found = ",".join(map(str, ids)), b"".join([v.bytes[i] for i in ids])
        if len(token) <= CACHED_LENGTH:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[token] = found
        return found

    def pieces(self, text: str) -> list[tuple[str, bytes]]:
        v = self.vocabulary
        if v.cut is None or not any(s in text for s in v.special):
            return self._run(text)
        out = []
        for part in v.cut.split(text):
            if part in v.special:
                out.append((str(v.special[part]), part.encode()))
            elif part:
                out += self._run(part)
        return out

    def _run(self, text: str) -> list[tuple[str, bytes]]:
        young, piece = self.young, self._piece
        out = []
        for token in self.split(text):
            found = young.get(token)
            if found is None:
                found = piece(token)
                young = self.young
            out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.pieces(text) for i in ids.split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.vocabulary.bytes[i] for i in ids]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}          # per worker process


def codec(path: str) -> Codec:
    """The codec of the tokenizer file at ``path``, loaded once a process. The
    file is looked up on the worker."""
    if path not in _CODECS:
        with open(path, encoding="utf-8") as f:
            _CODECS[path] = Codec(Vocabulary(f.read()))
    return _CODECS[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(
                [c.encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "ids"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    ready(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(
                [None if ids is None else c.decode(ids) for ids in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "text"])
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of every row."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            n, ids, texts = [], [], []
            for text in batch.column(1):
                pieces = c.pieces(text.as_py() or "")
                joined = ",".join([p[0] for p in pieces])
                n.append(joined.count(",") + 1 if joined else 0)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                raw = b"".join([p[1] for p in pieces]).decode("utf-8", "replace").encode()
                texts.append(hashlib.sha256(raw).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                                   pa.array(texts, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
