"""Substring dedup against a plain version, and what it finds and leaves alone."""
import random
import re

from paneltide.llm import line_dedup
from paneltide.llm.byte_terms import PATTERN
from tests.llm.helpers import docs_of, edge_docs, prose, stored

REST = PATTERN.replace("[^", "[").replace("]+", "]*")


def divided(text):
    """(start of each unit and the end of the text, lower-case words and weight of each unit)."""
    starts, bodies, open_ = [], [], False
    for m in re.finditer(f"({PATTERN})({REST})", text):
        word = "".join(c.lower() if c < "\x80" else c for c in m[1])
        if not open_:
            starts.append(m.start())
            bodies.append([[], 0])
        size = len(word.encode())
        bodies[-1][0].append(word)
        bodies[-1][1] += 1 + size // 16
        open_ = size < 10 and not re.search("[\n.!?,;:]", m[2])
    return [*starts, len(text)], bodies


def brute_passages(docs, min_words=line_dedup.MIN_WORDS):
    """[(text after the cuts, spans)] of (id, text) in rank order."""
    seen, out = set(), []
    for _, text in docs:
        starts, bodies = divided(text or "")
        gone = set()
        for j in range(len(bodies)):
            words, weight = [], 0
            for k in range(j, len(bodies)):
                words += bodies[k][0]
                weight += bodies[k][1]
                if weight >= min_words:
                    if tuple(words) in seen:
                        gone.update(range(j, k + 1))
                    seen.add(tuple(words))
                    break
        kept, spans = (text or "")[:starts[0]], []
        for j in range(len(bodies)):
            a, b = starts[j], starts[j + 1]
            if j not in gone:
                kept += text[a:b]
            elif spans and sum(spans[-1]) == a:
                spans[-1] = (spans[-1][0], spans[-1][1] + b - a)
            else:
                spans.append((a, b - a))
        out.append((text if text is None or not spans else kept, spans))
    return out


def check(rows, texts, min_words=line_dedup.MIN_WORDS):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    want = brute_passages(list(enumerate(texts)), min_words)
    for r, (text, spans), old in zip(rows, want, texts):
        assert r["text"] == text and [(c["start"], c["length"]) for c in r["cut"]] == spans
        assert r["n_chars"] == len(text or "")
    return rows


def test_passages_equal_brute_force(spark, tmp_path):
    rng = random.Random(3)

    def sentence():
        return " ".join(rng.choice(["w%d" % rng.randrange(50), "Longwordnumber%d" % rng.randrange(9), "漢字", "É%d" % rng.randrange(5),
                                    "x" * 40]) + rng.choice(["", "", ",", ";"]) for _ in range(rng.randrange(1, 14))) + rng.choice([". ", "! ", ".\n", "\n\n"])
    pool = ["".join(sentence() for _ in range(rng.randrange(2, 9))) for _ in range(25)]
    texts = [rng.choice(["", " ", "...\n"]) + "".join(rng.choice(pool)[rng.choice([0, 0, 7]):] if rng.random() < 0.5 else sentence()
                                                  for _ in range(rng.randrange(0, 9))) for _ in range(200)]
    texts += ["the " * 200, "A b c. " * 50, "漢字" * 400 + "\n" + "漢字" * 400 + "\n", None, "", "\n", texts[0]]
    for least in (line_dedup.MIN_WORDS, 5):
        rows = check(line_dedup.dedupe(stored(spark, tmp_path / str(least), docs_of(spark, texts)), least).collect(), texts, least)
        assert sum(bool(r["cut"]) for r in rows) > 50


def test_cuts_leave_the_rest_as_it_stood(spark, tmp_path):
    passage = prose(5, 70) + "."
    texts = [f"First text. {passage} Its end.", f"start\n{passage.upper()}\nfinish it", f"no break {passage[:-1]} goes on here", prose(6, 49),
             f"Short repeats are left: {' '.join(passage.split()[:20])}."]
    rows = check(line_dedup.dedupe(stored(spark, tmp_path, docs_of(spark, texts))).collect(), texts)
    assert rows[0]["text"] == texts[0] and rows[1]["text"] == "start\nfinish it"
    assert rows[3]["text"] == texts[3] and rows[4]["text"] == texts[4]
    for r, text in zip(rows, texts):
        left, at = "", 0
        for c in r["cut"]:
            left, at = left + text[at:c["start"]], c["start"] + c["length"]
        assert left + text[at:] == r["text"]


def test_every_repeated_stretch_of_fifty_words_is_met(spark, tmp_path):
    """Wherever the stretch begins and ends, and whatever stands around it."""
    rng = random.Random(4)
    source = " ".join("tok%d%s" % (rng.randrange(10_000), rng.choice(["", "", "", "", ",", "."])) for _ in range(900))
    words = source.split()
    texts = [source] + [f"{prose(100 + i, rng.randrange(30), 9999)} {' '.join(words[a:a + 50])} {prose(300 + i, rng.randrange(30), 9999)}"
                        for i, a in enumerate(rng.randrange(850) for _ in range(60))]
    rows = sorted(line_dedup.dedupe(stored(spark, tmp_path, docs_of(spark, texts))).collect(), key=lambda r: r["doc_id"])
    assert rows[0]["text"] == source and all(r["cut"] for r in rows[1:])


def test_shares_on_the_given_documents(spark):
    """Texts that share 50 words with an earlier text lose something; the others mostly stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted(line_dedup.dedupe(docs).collect(), key=lambda r: r["doc_id"])
    old = {r["doc_id"]: r["text"] for r in docs.collect()}
    first, shared = {}, set()
    for d in sorted(old):
        w = [x.lower() for x in re.findall(PATTERN, old[d])]
        for i in range(len(w) - 49):
            if first.setdefault(tuple(w[i:i + 50]), d) != d:
                shared.add(d)
    caught = sum(bool(r["cut"]) for r in rows if r["doc_id"] in shared) / len(shared)
    alone = sum(not r["cut"] for r in rows if r["doc_id"] not in shared) / (len(rows) - len(shared))
    assert caught >= 0.95 and alone >= 0.92, (caught, alone)


def test_awkward_rows(spark, tmp_path):
    edge = stored(spark, tmp_path, edge_docs(spark))
    out = line_dedup.dedupe(edge, min_words=6)
    assert out.columns == [*edge.columns, "cut_"]
    rows = out.collect()
    assert len(rows) == edge.count() and line_dedup.dedupe(edge.limit(0)).count() == 0
    # the smallest id stands first, a null id last; a null text stays
    assert sorted(r["text"] for r in rows if r["doc_id"] == 200) == ["", "tie one of the same id here."] or \
        sorted(r["text"] for r in rows if r["doc_id"] == 200) == ["tie one of the same id here.", "tie two of the same id here."]
    assert {r["text"] for r in rows if r["doc_id"] is None} == {None, "a row without an id stands here."}
