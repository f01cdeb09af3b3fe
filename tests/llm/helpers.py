"""Small tables with every awkward case."""
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("row_", T.StringType()), T.StructField("cut", T.LongType()), T.StructField("_text", T.StringType())])

LONG = " ".join(f"word{i % 997} tail{i % 13}," for i in range(20_000)) + "."
ODD = [None, "", " ", "\n\n", "one", "Two words.", "\t a\x0bb\x0cc \r\n", "É ñ 漢字 🙂 ½ don't we'll",
       "!!! ### $$$ %%%", "<|endoftext|> x <|startoftext|>", "a" * 3000, LONG]


def edge_rows():
    rows = [(i, t, "en" if i % 2 else None, "s", None if t is None else len(t), "r", i, "x") for i, t in enumerate(ODD)]
    rows += [(100, "same row again and again, five.", "en", None, 3, None, None, None)] * 3
    rows += [(None, "a row without an id stands here.", "de", "s", 1, "r", 2, "x"), (None, None, None, None, None, None, None, None)]
    rows += [(200, "tie one of the same id here.", "en", "s", 1, "r", 2, "x"), (200, "tie two of the same id here.", "en", "s", 1, "r", 2, "x")]
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def docs_of(spark, texts, lang=None):
    return spark.createDataFrame([(i, t, lang[i] if lang else "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join("w%d" % r.randrange(vocabulary) for _ in range(n))


def stored(spark, tmp_path, df):
    path = str(tmp_path / "documents.parquet")
    df.coalesce(2).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
