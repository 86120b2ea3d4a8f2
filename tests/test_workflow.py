"""The reference's four programs, end to end through files, with the public API."""

import json
import os

from rankeval import (BM25, JM, compare, evaluate, flatten_articles, mean_nonzero, select_queries, train_test)
from rankeval.operators.saved import index_corpus, load_index
from rankeval.sources import read_corpus, read_qrels, read_result_values, read_topics
from rankeval.sources import writers as W


def _lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_index_search_tune_compare(spark, tmp_dir):
    words = ["virus", "spread", "mask", "vaccine", "school", "test", "air", "risk"]
    arts = []
    for i in range(30):
        text = " ".join(words[(i + k) % len(words)] for k in range(3 + i % 5))
        arts.append({"_id": f"d{i}", "title": f"doc {i}", "text": text, "metadata": {"url": f"u{i}", "pubmed_id": str(i)}})
    _lines(f"{tmp_dir}/corpus.jsonl", [json.dumps(a) for a in arts])
    topics = [{"_id": q, "text": "", "metadata": {"query": f"{words[q % 8]} {words[(q + 3) % 8]}", "narrative": ""}}
              for q in range(1, 11)]
    _lines(f"{tmp_dir}/queries.jsonl", [json.dumps(t) for t in topics])
    qrels = ["query-id\tcorpus-id\tscore"] + [f"{q}\td{(q * 7 + k) % 30}\t{1 + k % 2}" for q in range(1, 11) for k in range(4)]
    _lines(f"{tmp_dir}/test.tsv", qrels)

    # 1. index (create_or_append twice: the second run upserts the same ids)
    corpus = flatten_articles(read_corpus(spark, f"{tmp_dir}/corpus.jsonl"))
    index_corpus(corpus, f"{tmp_dir}/idx", partitions=2)
    index_corpus(corpus, f"{tmp_dir}/idx", partitions=2)
    idx = load_index(spark, f"{tmp_dir}/idx")
    assert idx.docs.count() == 30

    # 2. search + evaluate queries 1-5 with BM25, per-query CSV with mean row
    t = read_topics(spark, f"{tmp_dir}/queries.jsonl")
    q = read_qrels(spark, f"{tmp_dir}/test.tsv")
    m = evaluate(idx, select_queries(t, "1-5"), q, BM25(k1=0.4), cut=5)
    assert m.count() == 5
    W.write_metrics_csv(m, f"{tmp_dir}/bm25")
    means = mean_nonzero(m).collect()[0]
    assert 0 < means.rr <= 1

    # 3. train on 1-5, test on 6-10, for both models
    outs = {}
    for name, model in (("jm", JM()), ("bm25", BM25())):
        out = train_test(idx, t, q, model, "1-5", "6-10", "MAP", cut=5)
        W.write_sweep_csv(out["wide"], f"{tmp_dir}/{name}.train")
        W.write_test_csv(out["best"], out["test"], "MAP", f"{tmp_dir}/{name}.test")
        outs[name] = out
    assert outs["jm"]["best"].count() == 1

    # 4. compare the two test files
    runs = read_result_values(spark, f"{tmp_dir}/jm.test", "jm").unionByName(
        read_result_values(spark, f"{tmp_dir}/bm25.test", "bm25"))
    assert runs.count() == 10
    res = compare(runs, "wilcoxon", 0.05, baseline="bm25").collect()
    assert len(res) == 1 and res[0].decision in ("accepted", "rejected") and res[0].n == 5
    assert os.path.isdir(f"{tmp_dir}/bm25")


def test_sweep_is_searched_once(spark):
    """Everything that reads a sweep's rows reads pinned ones."""
    from micro import frames
    from rankeval.operators.index import build_index
    from rankeval.operators.tune import sweep, sweep_means

    docs, topics, qrels = frames(spark)
    swept = sweep(build_index(docs, 2), topics, qrels, [JM()], [(0.1, 0.5)], 5)
    plan = sweep_means(swept)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "LogicalRDD" in plan
