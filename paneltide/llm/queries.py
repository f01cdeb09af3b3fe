"""The registered queries of the training-data operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import (bag_search, bin_packing, bpe, decontaminate, language_id, license_scan, line_dedup, line_quality,
                           lm_scoring, prob_minhash, quote_chat, simhash, structure_repair)
from paneltide.llm.oracle import ORACLE as ORACLE  # noqa: F401
from paneltide.session import prepare


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_bloom_lm(spark, sf_dir):
    return lm_scoring.fit_and_score(documents(spark, sf_dir))


def op2_kneser_ney_lid(spark, sf_dir):
    return language_id.fit_and_predict(documents(spark, sf_dir))


def op3_byte_bpe(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op4_quote_chat(spark, sf_dir):
    return quote_chat.format_chats(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op5_line_quality(spark, sf_dir):
    return line_quality.judge(documents(spark, sf_dir)).drop("cleaned")


def op6_simhash(spark, sf_dir):
    return simhash.report(documents(spark, sf_dir))


def op7_license_scan(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


def _cut_report(out: DataFrame) -> DataFrame:
    return out.select(
        "doc_id", "text", F.size("cut").cast("long").alias("n_cut"),
        F.coalesce(F.aggregate("cut", F.lit(0).cast("bigint"), lambda a, x: a + x["length"]), F.lit(0)).alias("chars_cut"),
        F.array_join(F.transform("cut", lambda x: F.concat_ws(":", x["start"], x["length"])), ",").alias("cut_spans"))


def op8_line_dedup(spark, sf_dir):
    return _cut_report(line_dedup.dedupe(documents(spark, sf_dir)))


def op9_min_bin_slack(spark, sf_dir):
    return bin_packing.pack(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op10_prob_minhash(spark, sf_dir):
    return prob_minhash.classes(documents(spark, sf_dir))


def op11_winnowing(spark, sf_dir):
    return decontaminate.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_viterbi_repair(spark, sf_dir):
    return structure_repair.report(prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_bag_search(spark, sf_dir):
    return bag_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_bloom_lm, op2_kneser_ney_lid, op3_byte_bpe, op4_quote_chat, op5_line_quality, op6_simhash, op7_license_scan,
    op8_line_dedup, op9_min_bin_slack, op10_prob_minhash, op11_winnowing,
    op12_viterbi_repair, op13_bag_search, pipeline)}
