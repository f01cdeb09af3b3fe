"""Line quality, licence scan, line dedup and chat formatting against brute force."""
import re

import pytest

from paneltide.llm import license_scan, line_dedup, line_quality, quote_chat
from tests.llm.helpers import ODD, docs_of, prose, stored


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark, tmp_path):
    texts = [t for t in ODD if t is None or len(t) < 5000] + [
        "a b c a b c a b c d", "x y z q x y z\nx y z\nx y z", "| a | b | c |\nIt ends.\nIt ends.", prose(1, 300, 6), "a a a a"]
    for r in line_quality.judge(stored(spark, tmp_path, docs_of(spark, texts))).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_quality(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_line_rules(spark, tmp_path):
    good = prose(2, 80) + "."
    texts = [good, good + "\nHome | News | Shop | More\nAccept cookie settings.", "Home | News | Shop | More\n" * 8 + prose(3, 60) + ".",
             "SHOUT!! NOW!! OR!! NEVER!!\n" + good, good + "\n" + "%%% $$$ ### x.", "no end of sentence\n" + good]
    got = {r["doc_id"]: r for r in line_quality.judge(stored(spark, tmp_path, docs_of(spark, texts))).collect()}
    assert [got[i]["lines_removed"] for i in range(6)] == [0, 2, 8, 1, 1, 1]
    assert got[0]["kept"] and got[1]["kept"] and got[1]["cleaned"] == good and not got[2]["kept"]
    out = line_quality.clean(stored(spark, tmp_path, docs_of(spark, texts))).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out) and {r["doc_id"] for r in out} == {i for i in got if got[i]["kept"]}


@pytest.mark.parametrize("labelled", ["/root/testdata/sf0.1"])
def test_verdict_follows_the_labels(spark, labelled):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{labelled}/labels.parquet").collect()}
    judged = line_quality.judge(spark.read.parquet(f"{labelled}/documents.parquet")).select("doc_id", "n_words", "kept").collect()
    good = [r["kept"] for r in judged if labels.get(r["doc_id"]) == 1 and r["n_words"] >= 50]
    bad = [r["kept"] for r in judged if labels.get(r["doc_id"]) == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def test_license_scan(spark, tmp_path):
    mit = dict(license_scan.TEMPLATES[::-1])["MIT"]
    long_mit = [t for n, t in license_scan.TEMPLATES if n == "MIT"][1]
    texts = [prose(1, 50) + "\nreleased under THE MIT license\n" + prose(2, 50), long_mit.replace(". ", ".\n").replace(", ", ",\n"),
             long_mit.replace("Software", "Program", 1), prose(3, 100), None, "", "All rights reserved", "rights",
             "Released under the MIT License.\n\nReleased under the MIT License.",
             prose(4, 9) + " Released under the MIT License. " + prose(5, 9)]
    assert mit
    got = {r["doc_id"]: r for r in license_scan.scan(stored(spark, tmp_path, docs_of(spark, texts))).collect()}
    assert (got[0]["license"], got[0]["dice"], got[0]["line"], got[0]["n_lines"]) == ("MIT", 1.0, 2, 1)
    assert got[1]["license"] == "MIT" and got[1]["line"] == 0
    assert got[2]["license"] == "MIT" and 0.8 <= got[2]["dice"] < 1
    assert all(got[i]["license"] is None and got[i]["n_lines"] == 0 for i in (3, 4, 5, 7, 9))
    assert got[6]["license"] == "Proprietary" and (got[8]["line"], got[8]["n_lines"]) == (1, 2)


def test_dice_against_brute_force(spark, tmp_path):
    def grams(t):
        w = [x for x in re.split(r"[\W_]+", t.lower()) if x]
        return set(zip(w, w[1:]))
    base = license_scan.TEMPLATES[1][1].split()
    texts = [" ".join(w if (i * 7 + k) % (k + 4) else "other" for i, w in enumerate(base)) for k in range(12)]
    got = {r["doc_id"]: r["dice"] for r in license_scan.scan(stored(spark, tmp_path, docs_of(spark, texts)), threshold=0.5).collect()}
    for i, t in enumerate(texts):
        a = grams(t)
        best = max(2 * len(a & grams(x)) / (len(a) + len(grams(x))) for _, x in license_scan.TEMPLATES)
        assert got[i] == (best if best >= 0.5 else None) or abs(got[i] - best) < 1e-12


def test_row_numbers_are_given_once(spark, tmp_path):
    docs = stored(spark, tmp_path, docs_of(spark, [f"{prose(i % 7, 30)}." for i in range(40)]))
    out = line_dedup.dedupe(docs)
    assert "monotonically_increasing_id" not in out._jdf.queryExecution().toString()
    assert sum(r["text"] != "" for r in out.collect()) == 7


def test_quotes_are_linked_and_removed(spark):
    rows = [(1, 0, "user", "The first idea is about packing bins.\n\nThe second idea is about hashing lines."),
            (1, 1, "assistant", "On Monday user wrote:\n> The first idea is about packing bins.\n\nYes, that works."),
            (1, 2, "user", "> the SECOND idea is\n> about hashing lines.\nAnd this one too?"),
            (1, 3, "assistant", ">> The first idea is about packing bins.\n> Yes, that works.\nGood to hear that again."),
            (1, 4, "user", "No quote in here at all."), (1, 5, "user", "> never written by anybody else\nA dangling quote."),
            (2, 0, "user", "> Yes, that works.\nOther conversation.")]
    got = {(r["conv_id"], r["turn"]): r for r in quote_chat.format_chats(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[1, t]["reply_to"] for t in range(6)] == [None, 0, 0, 1, 3, 4]
    assert [got[1, t]["by_quote"] for t in range(6)] == [False, True, True, True, False, False]
    assert [got[1, t]["depth"] for t in range(6)] == [0, 1, 1, 2, 3, 4]
    assert got[1, 1]["body"] == "Yes, that works." and got[1, 3]["body"] == "Good to hear that again."
    assert got[2, 0]["reply_to"] is None and got[2, 0]["body"] == "Other conversation."


def test_depth_equals_a_walk_over_long_conversations(spark, monkeypatch):
    import random
    monkeypatch.setattr(quote_chat, "RUN", 16)
    r, rows, parent = random.Random(4), [], {}
    for t in range(120):
        own = f"Statement number {t} of this talk."
        if t > 1 and r.random() < 0.3:
            p = r.randrange(t - 1)
            rows.append((7, 3 * t, "user", f"> Statement number {p} of this talk.\n{own}"))
        else:
            p = t - 1
            rows.append((7, 3 * t, "user", own))
        parent[3 * t] = 3 * p if t else None
    depth = {}
    for t in sorted(parent):
        depth[t] = 0 if parent[t] is None else depth[parent[t]] + 1
    got = quote_chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {x["turn"]: x["reply_to"] for x in got} == parent
    assert {x["turn"]: x["depth"] for x in got} == depth
