"""Every operator and stage on awkward rows and on empty tables."""
import public_tokenizers
import pytest

import corpus_pipeline
from paneltide.llm import (bin_packing, bpe, language_id, license_scan, line_dedup, line_quality, lm_scoring,
                           prob_minhash, quote_chat, simhash)
from tests.llm.helpers import SCHEMA, edge_docs, edge_rows, stored

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PER_ROW = {
    "lm": lm_scoring.fit_and_score, "lid": language_id.fit_and_predict, "bpe": lambda d: bpe.digests(d, BYTE),
    "quality": line_quality.judge, "simhash": simhash.report, "license": license_scan.scan,
    "dedup": line_dedup.dedupe, "minhash": prob_minhash.classes,
}


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("edge"), edge_docs(spark))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("empty"), spark.createDataFrame([], SCHEMA))


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_document(edge, empty, name):
    got = sorted(r["doc_id"] is not None and r["doc_id"] for r in PER_ROW[name](edge).collect())
    assert got == sorted(r[0] is not None and r[0] for r in edge_rows())
    assert PER_ROW[name](empty).count() == 0


def test_packing_covers_every_row(edge, empty):
    rows = bin_packing.pack(edge, WORD).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(edge_rows())
    assert [r["length"] for r in rows if r["doc_id"] in (0, 1, 2, 3)] == [1, 1, 1, 1]
    assert bin_packing.pack(empty, WORD).count() == 0


@pytest.mark.parametrize("at", range(5))
def test_stages_on_awkward_rows(spark, edge, empty, at):
    name, stage = corpus_pipeline.STAGES[at]
    for docs in (edge, empty):
        out = stage(spark, docs, "")
        if at < 4:
            assert out.columns == docs.columns
        out.collect()


def test_defined_results(edge):
    quality = {r["doc_id"]: r for r in line_quality.judge(edge).collect()}
    assert quality[0]["n_words"] == 0 and quality[0]["base_failed"] and not quality[0]["kept"]
    assert quality[6]["n_words"] == 3 and quality[6]["word_chars"] == 3
    lid = {r["doc_id"]: r for r in language_id.fit_and_predict(edge).collect()}
    assert all(lid[i]["lang_pred"] == "und" and lid[i]["score"] == 0 and not lid[i]["accepted"] for i in (0, 1, 2, 3, 8))
    groups = prob_minhash.classes(edge).filter("doc_id = 100").collect()
    assert [r["class_size"] for r in groups] == [3, 3, 3] and sum(r["is_representative"] for r in groups) == 1
    assert all(r["class_size"] == 1 for r in prob_minhash.classes(edge).filter("doc_id < 4").collect())
    dedup = [r for r in line_dedup.dedupe(edge, min_words=6).collect() if r["doc_id"] == 100]
    assert sorted(r["text"] for r in dedup) == ["", "", "same row again and again, five."]


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, extra int"
    rows = [(1, 0, "user", None, 1), (1, 1, None, "> > >", 2), (1, None, "user", "no turn", 3), (None, 0, "user", "", 4),
            (1, 2, "user", "x", 5), (1, 2, "user", "x", 5), (None, 1, "user", "> deep\n>> deeper", 6)]
    out = quote_chat.format_chats(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    got = {(r["conv_id"], r["turn"]): r for r in out}
    assert got[1, 0]["body"] is None and got[1, 0]["reply_to"] is None and got[1, 0]["depth"] == 0
    assert got[1, 2]["reply_to"] == 1 and got[1, 2]["depth"] == 2
    assert got[1, 1]["body"] == "" and got[1, 1]["quoted_lines"] == 1
    assert got[None, 1]["reply_to"] == 0 and got[1, None]["reply_to"] is None and got[1, None]["depth"] is None
    assert quote_chat.format_chats(spark.createDataFrame([], schema)).count() == 0
