"""Shared helpers of the training-data operators."""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.session import scratch_root

ASCII_SPACE = r"[\x20\x09-\x0D]"
ASCII_WORD = r"[^\x20\x09-\x0D]"
SLICE_BYTES = 8 << 20          # text handled at once inside a task


def ready(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers on this machine."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors, deleted when the driver's JVM ends."""
    spark = df.sparkSession
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    app = f"{scratch_root(spark)}/llm-{spark.sparkContext.applicationId}"
    path = f"{app}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    folder = jvm.org.apache.hadoop.fs.Path(app)
    folder.getFileSystem(jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str, label: str) -> DataFrame:
    """A stored copy of ``docs`` with its row numbers in the column ``name``. Numbers follow
    the splits of the input, which change with the cores registered when it is read, so
    they are given once and every reader gets them from the copy."""
    return materialise(docs.withColumn(name, F.monotonically_increasing_id()), label)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def unmix64(x: np.ndarray) -> np.ndarray:
    """The values that ``mix64`` turns into ``x``."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
        x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
        x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
        x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
        x = x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))
        return x - np.uint64(0x9E3779B97F4A7C15)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text
    (a single longer text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def ascii_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none): the number per
    text and all words in order, dictionary-encoded."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    words = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(words), 0)
    mask = real.to_numpy(zero_copy_only=False).astype(bool)
    counts = np.bincount(owner[mask], minlength=len(texts)).astype(np.int64)
    return counts, words.filter(real).dictionary_encode()


def hash_strings(values: pa.Array) -> np.ndarray:
    """A fixed 64-bit hash of each string, the same on every machine."""
    if not len(values):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(words per text, 64-bit hash of every word in order)."""
    counts, words = ascii_words(texts, lower)
    table = hash_strings(words.dictionary)
    return counts, table[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def held_out(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``, is 0 (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0
