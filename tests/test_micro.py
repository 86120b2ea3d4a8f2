import math

import pytest
from pyspark.sql import functions as F

from micro import DOCS, frames
from rankeval.operators.evaluate import evaluate, judge, mean_nonzero, per_query_metrics, relevant_per_query
from rankeval.operators.index import build_index
from rankeval.operators.models import BM25, JM
from rankeval.operators.search import query_terms, search


def _q(dl):
    """Reference length decoding (4 significant bits above 24)."""
    if dl < 24:
        return dl
    x = dl - 24
    s = max(x.bit_length() - 4, 0)
    return 24 + ((x >> s) << s)


def _bm25(tf, dl, df, n, avgdl, k1, qtf=1):
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return qtf * idf * tf / (tf + k1 * (0.25 + 0.75 * _q(dl) / avgdl))


def _jm(tf, dl, cf, tokens, lam, qtf=1):
    return qtf * math.log(1 + ((1 - lam) * tf / _q(dl)) / (lam * (cf + 1) / (tokens + 1)))


@pytest.fixture(scope="module")
def coll(spark):
    docs, topics, qrels = frames(spark)
    return build_index(docs, 4), topics, qrels


def _text_stats():
    toks = {o: x.split() for o, _, _, x in DOCS}
    n = len(toks)
    total = sum(len(t) for t in toks.values())
    return toks, n, total, total / n


def test_term_and_collection_stats(coll):
    idx, _, _ = coll
    s = idx.stats.filter("field = 'text'").collect()[0]
    toks, n, total, avgdl = _text_stats()
    assert (s.n_docs, s.n_tokens) == (n, total)
    assert s.avgdl == pytest.approx(avgdl)
    t = {r.term: (r.df, r.cf) for r in idx.terms.filter("field = 'text'").collect()}
    assert t["apple"] == (4, 5)
    assert t["fig"] == (1, 1)


def test_bm25_scores_by_hand(coll):
    idx, topics, _ = coll
    toks, n, total, avgdl = _text_stats()
    hits = search(idx, topics, BM25(1.2), 10).filter("query_id = 1").orderBy("rank").collect()
    df = sum(1 for t in toks.values() if "apple" in t)
    expect = {o: _bm25(t.count("apple"), len(t), df, n, avgdl, 1.2) for o, t in toks.items() if "apple" in t}
    assert [h.ord for h in hits] == sorted(expect, key=lambda o: (-round(expect[o], 6), o))
    for h in hits:
        assert h.score == pytest.approx(expect[h.ord], abs=1e-6)


def test_repeated_query_term_counts_twice(coll):
    idx, topics, _ = coll
    qt = {r.term: r.qtf for r in query_terms(topics.filter("query_id = 4")).collect()}
    assert qt == {"apple": 2, "date": 1}
    toks, n, total, avgdl = _text_stats()
    hits = {h.ord: h.score for h in search(idx, topics, JM(0.5), 10).filter("query_id = 4").collect()}
    cf = {w: sum(t.count(w) for t in toks.values()) for w in ("apple", "date")}
    for o, t in toks.items():
        exp = sum(_jm(t.count(w), len(t), cf[w], total, 0.5, qtf) for w, qtf in (("apple", 2), ("date", 1)) if w in t)
        if exp:
            assert hits[o] == pytest.approx(exp, abs=1e-6)


def test_lambda_one_gives_zero_scores_and_ord_ties(coll):
    idx, topics, _ = coll
    hits = search(idx, topics, JM(1.0), 10).filter("query_id = 1").orderBy("rank").collect()
    assert all(h.score == 0.0 for h in hits)
    assert [h.ord for h in hits] == [0, 1, 3, 4]


def test_cut_prefix_property(coll):
    idx, topics, _ = coll
    h2 = search(idx, topics, BM25(0.9), 2).collect()
    h10 = search(idx, topics, BM25(0.9), 10).collect()
    small = {(h.query_id, h.rank, h.ord) for h in h2}
    big = {(h.query_id, h.rank, h.ord) for h in h10 if h.rank <= 2}
    assert small == big


def test_metrics_rules(coll):
    idx, topics, qrels = coll
    m = {r.query_id: r for r in evaluate(idx, topics, qrels, BM25(1.2), 3).collect()}
    assert set(m) == {1, 2, 3, 4}
    # query 2: no hit -> RR = AP = 0, P = NaN, recall = 0 (judged)
    assert (m[2].rr, m[2].ap, m[2].recall) == (0.0, 0.0, 0.0) and math.isnan(m[2].p)
    # query 3: hits but no judgments -> recall NaN
    assert math.isnan(m[3].recall) and m[3].p == 0.0
    # query 1: judged relevant d1 (grade 2) and d3 (grade 1, duplicated); grade 0 ignored
    hits = search(idx, topics, BM25(1.2), 3).filter("query_id = 1").orderBy("rank").collect()
    rel = [h.ord in (1, 3) for h in hits]
    found = sum(rel)
    ap = sum(sum(rel[: i + 1]) / (i + 1) for i, r in enumerate(rel) if r) / found
    first = rel.index(True) + 1
    assert m[1].rr == pytest.approx(1 / first)
    assert m[1].ap == pytest.approx(ap)
    assert m[1].p == pytest.approx(found / len(hits))
    assert m[1].recall == pytest.approx(found / 2)
    # query 4: one of two judged docs exists
    assert m[4].recall <= 0.5


def test_relevant_per_query_collapses_duplicates(coll):
    _, _, qrels = coll
    r = {x.query_id: x.n_relevant for x in relevant_per_query(qrels).collect()}
    assert r == {1: 2, 2: 1, 4: 2}


def test_failed_parse_gives_zero(spark, coll):
    idx, _, qrels = coll
    topics = spark.createDataFrame([(1, "?!"), (2, "")], "query_id long, query string")
    m = evaluate(idx, topics, qrels, BM25(1.2), 10).collect()
    assert all((r.rr, r.ap, r.p, r.recall) == (0.0, 0.0, 0.0, 0.0) for r in m)


def test_float_precision_matches_single_precision(coll):
    import numpy as np
    idx, topics, qrels = coll
    d = {r.query_id: r for r in evaluate(idx, topics, qrels, BM25(1.2), 3, precision="float").collect()}
    hits = search(idx, topics, BM25(1.2), 3).filter("query_id = 1").orderBy("rank").collect()
    acc, cnt = np.float32(0), 0
    for i, h in enumerate(hits, start=1):
        if h.ord in (1, 3):
            cnt += 1
            acc = np.float32(acc + np.float32(np.float32(cnt) / np.float32(i)))
    assert d[1].ap == float(np.float32(acc / np.float32(cnt)))


def test_mean_nonzero_skips_zero_and_nan(spark):
    m = spark.createDataFrame(
        [(1, 0.0, 0.5, float("nan"), 0.0, 10), (2, 1.0, 0.0, 0.5, float("nan"), 10), (3, 0.5, 0.25, 0.0, 0.0, 10)],
        "query_id long, rr double, ap double, p double, recall double, cut int")
    r = mean_nonzero(m).collect()[0]
    assert r.rr == pytest.approx(0.75) and r.ap == pytest.approx(0.375) and r.p == pytest.approx(0.5)
    assert math.isnan(r.recall)


def test_recall_non_decreasing_in_cut_and_metric_ranges(coll):
    idx, topics, qrels = coll
    by_cut = {}
    for cut in (1, 2, 3, 10):
        by_cut[cut] = {r.query_id: r for r in evaluate(idx, topics, qrels, BM25(1.2), cut).collect()}
    for q in by_cut[1]:
        seq = [by_cut[c][q].recall for c in (1, 2, 3, 10)]
        if not any(math.isnan(v) for v in seq):
            assert seq == sorted(seq)
        for c in by_cut:
            r = by_cut[c][q]
            for v in (r.rr, r.ap, r.p, r.recall):
                assert math.isnan(v) or 0.0 <= v <= 1.0


def test_exact_length_option(spark):
    from rankeval.operators.index import build_index
    long_text = " ".join(["w%d" % i for i in range(40)]) + " apple"
    docs = spark.createDataFrame([(0, "a", "", long_text), (1, "b", "", "apple pie")],
                                 "ord long, id string, title string, text string")
    topics = spark.createDataFrame([(1, "apple")], "query_id long, query string")
    idx = build_index(docs, 2)
    byte = {h.ord: h.score for h in search(idx, topics, JM(0.5), 10).collect()}
    exact = {h.ord: h.score for h in search(idx, topics, JM(0.5), 10, length="dl").collect()}
    # 41 tokens is stored as 40 by the one-byte norm; 2 tokens are exact either way
    assert byte[1] == exact[1]
    assert byte[0] == pytest.approx(_jm(1, 41, 2, 43, 0.5), abs=1e-6)
    assert exact[0] != byte[0]
