"""Appending to and searching an index whose documents, batches and candidates are many."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rankeval.operators import index as I
from rankeval.operators import saved
from rankeval.operators import search as S
from rankeval.operators.models import BM25, JM


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _texts(spark, n, seed, first=0, numbers=lambda i: i):
    """Words of a steep distribution; every tenth document is one topic's words and a few more."""
    rng = random.Random(seed)
    words, weights = [f"w{i}" for i in range(300)], [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(first, first + n):
        text = rng.choices(words, weights, k=rng.randint(5, 60))
        if i % 10 == 0:
            text += random.Random(i % 60).choices(words, k=12)
        rows.append((numbers(i), f"d{i}", " ".join(text)))
    return spark.createDataFrame(rows, "ord long, id string, text string")


def _topics(spark):
    rows = [(q, " ".join(random.Random(10 * q).choices([f"w{i}" for i in range(300)], k=12) + ["w0", "w1"])) for q in range(6)]
    return spark.createDataFrame([*rows, (6, "w0 w1 w2"), (7, "w0 nowhere"), (8, "nowhere"), (None, "w3 w250 w0")],
                                 "query_id long, query string")


def _both_ways(monkeypatch, idx, topics, cut):
    """(hits by bounds, hits of all documents, candidates by bounds, all candidates)."""
    q = S.query_terms(topics)
    whole = S.candidates(idx, S.match_ranges(idx, q), S.score_columns(BM25(0.4)))
    monkeypatch.setattr(S, "MIN_BOUNDED_ROWS", 1)
    best = S.best_candidates(idx, q, BM25(0.4), cut)
    hits = _rows(S.search(idx, topics, BM25(0.4), cut))
    monkeypatch.setattr(S, "MIN_BOUNDED_ROWS", 1 << 60)
    return hits, _rows(S.search(idx, topics, BM25(0.4), cut)), best, whole


@pytest.mark.parametrize("part, first", [(20, 50), (4, 1), (1000, 1)])
def test_bounds_find_the_hits_of_a_whole_search(spark, tmp_dir, monkeypatch, part, first):
    monkeypatch.setattr(S, "RARE_PART", part)
    monkeypatch.setattr(S, "FIRST_CUTS", first)
    path = f"{tmp_dir}/b"
    saved.index_corpus(_texts(spark, 1500, 1), path, partitions=2)
    saved.index_corpus(_texts(spark, 200, 2, 1400).drop("ord"), path, partitions=3)  # half of them replace earlier ones
    idx = saved.load_index(spark, path)
    got, want, best, whole = _both_ways(monkeypatch, idx, _topics(spark), 5)
    assert got == want and len(want) > 40
    if part == 4:  # for most topics, most documents are never summed
        assert best.count() < whole.count() / 2
        monkeypatch.setattr(S, "MAX_BROADCAST_PAIRS", 0)
        assert _both_ways(monkeypatch, idx, _topics(spark), 5)[0] == want


def test_bounds_hold_for_texts_under_one_number(spark, tmp_dir, monkeypatch):
    """Two texts of unlike length under a number each have a posting of a term, so a sum may be twice a bound."""
    monkeypatch.setattr(S, "RARE_PART", 4)
    monkeypatch.setattr(S, "FIRST_CUTS", 1)
    twice = _texts(spark, 600, 3, numbers=lambda i: i // 2 if i < 20 else i)
    saved.write_index(I.build_index(twice, 2), f"{tmp_dir}/t", 2)
    got, want, best, _ = _both_ways(monkeypatch, saved.load_index(spark, f"{tmp_dir}/t"), _topics(spark), 5)
    assert got == want and best is not None
    # a term with more postings than there are documents has a negative weight: no bound holds
    often = spark.createDataFrame([(0, "a", "x"), (0, "b", "x y"), (0, "c", "x y z"), (1, "d", "x z")], "ord long, id string, text string")
    saved.write_index(I.build_index(often, 2), f"{tmp_dir}/o", 2)
    topics = spark.createDataFrame([(1, "x z")], "query_id long, query string")
    got, want, best, _ = _both_ways(monkeypatch, saved.load_index(spark, f"{tmp_dir}/o"), topics, 5)
    assert got == want and len(want) == 2 and best is None


def test_models_without_bounds_sum_all_documents(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "MIN_BOUNDED_ROWS", 1)
    saved.write_index(I.build_index(_texts(spark, 200, 4), 2), f"{tmp_dir}/j", 2)
    idx = saved.load_index(spark, f"{tmp_dir}/j")
    assert S.best_candidates(idx, S.query_terms(_topics(spark)), JM(0.3), 5) is None


@pytest.mark.parametrize("gigabytes", [0.5, 1, 6, 60])
def test_a_posting_file_is_not_tiny(gigabytes):
    """Files by task, as each task of a bucket writes its own."""
    n = int(gigabytes * 1e9)
    plan = saved.layout(n, 12)
    assert n / (plan.ranges * plan.buckets * saved.per_bucket(n, plan) * plan.groups) >= 1e6
    assert n / (plan.ranges * plan.buckets) <= max(2 * I.TASK_BYTES, plan.groups * saved.FILE_BYTES * 2)


def test_postings_of_a_batch_are_laid_out_by_its_own_bytes(spark, tmp_dir, monkeypatch):
    """A batch that is a small part of the tables it is read from."""
    monkeypatch.setattr(saved, "FILE_BYTES", 1 << 10)
    _texts(spark, 3000, 5).write.parquet(f"{tmp_dir}/in")
    corpus = spark.read.parquet(f"{tmp_dir}/in")
    saved.index_corpus(corpus, f"{tmp_dir}/x")
    some = corpus.filter("ord % 500 = 0").drop("ord")
    saved.index_corpus(some.unionByName(some.withColumn("id", F.concat("id", F.lit("-new")))), f"{tmp_dir}/x")
    first, second = saved._batches(spark, f"{tmp_dir}/x")
    cores = spark.sparkContext.defaultParallelism
    assert first.buckets > 2 * cores and second.buckets == cores
    idx = saved.load_index(spark, f"{tmp_dir}/x")
    assert idx.docs.count() == 3006 and idx.postings.select("ord").distinct().count() == 3006


def test_a_large_slot_is_written_by_several_tasks(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(saved, "SLOT_FILE_BYTES", 1 << 10, raising=False)
    _texts(spark, 2000, 6).write.parquet(f"{tmp_dir}/in")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        saved.index_corpus(spark.read.parquet(f"{tmp_dir}/in"), f"{tmp_dir}/s")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    folders = {d: [f for f in names if f.endswith(".parquet")] for d, _, names in os.walk(f"{tmp_dir}/s/docs")}
    assert max(map(len, folders.values())) > 1
    docs = saved.load_index(spark, f"{tmp_dir}/s").docs
    assert docs.count() == docs.select("ord").distinct().count() == 2000


def test_posting_files_are_sorted_by_term(spark, tmp_dir):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    saved.write_index(I.build_index(_texts(spark, 400, 7), 2), f"{tmp_dir}/f", 3, 12)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{tmp_dir}/f/postings") for f in names if f.endswith(".parquet")]
    assert len(files) == len({(os.path.dirname(f), f.split("_")[-1]) for f in files}) > 12  # one by bucket and group
    for f in files:
        terms = [r.term.encode() for r in spark.read.parquet(f).select("term").coalesce(1).collect()]
        assert terms == sorted(terms)
