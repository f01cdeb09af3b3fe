"""The pipeline stage by stage against plain Python over what each stage read."""
import corpus_pipeline
from paneltide.llm import language_id
from paneltide.llm.queries import QUERIES, documents, tokenizer_file
from tests.llm.test_near import bag, jaccard
from tests.llm.test_passages import brute_passages
from tests.llm.test_tokens import check_packing

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = documents(spark, SMALL)
    states = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, states[-1], SMALL).write.parquet(path)
        states.append(spark.read.parquet(path))
        if i < 4:
            assert states[-1].columns == docs.columns
    quality, lang, near, cut, packed = [{r["doc_id"]: r for r in s.collect()} for s in states[1:5]] + [states[5].collect()]
    judged = {r["doc_id"]: r for r in QUERIES["op5_line_quality"](spark, SMALL).collect()}
    assert set(quality) == {d for d, r in judged.items() if r["kept"]}
    models = language_id.train(states[1])
    assert set(lang) == {r["doc_id"] for r in language_id.predict(states[1], models).collect() if r["accepted"]}
    bags = {d: bag(r["text"]) for d, r in sorted(lang.items())}
    root = {d: d for d in bags}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for i in bags:
        for j in bags:
            small, large = sorted((sum(bags[i].values()), sum(bags[j].values())))
            if j < i and len(bags[i].keys() & bags[j].keys()) >= 0.5 * min(len(bags[i]), len(bags[j])) and jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert set(near) == {d for d in bags if find(d) == d}
    for (d, _), (text, _) in zip(sorted(near.items()), brute_passages([(d, r["text"]) for d, r in sorted(near.items())])):
        assert cut[d]["text"] == text and cut[d]["n_chars"] == len(text)
    bins, least = check_packing(packed, {d: r["text"] for d, r in cut.items()})
    assert bins <= least + 2 and tokenizer_file("word_bpe_49k.json")


def test_query_is_the_stages(spark):
    assert QUERIES["pipeline"](spark, SMALL).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "near_dedup", "substring_dedup", "packing"]
