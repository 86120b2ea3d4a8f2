import pytest
from pyspark.sql import functions as F

from micro import frames
from rankeval.functions.text import length_norm
from rankeval.operators import index as I
from rankeval.operators import saved
from rankeval.operators.search import search
from rankeval.operators.models import BM25


def test_length_norm_values(spark):
    vals = [0, 1, 23, 24, 25, 40, 41, 55, 100, 333, 5184]
    got = [r.n for r in spark.createDataFrame([(v,) for v in vals], "dl int").select(length_norm("dl").alias("n")).collect()]

    def ref(dl):
        if dl < 24:
            return dl
        x = dl - 24
        s = max(x.bit_length() - 4, 0)
        return 24 + ((x >> s) << s)
    assert got == [ref(v) for v in vals]
    assert got[5:10] == [40, 40, 54, 96, 312]


def test_postings_stay_in_document_partitions(spark):
    docs, topics, _ = frames(spark)
    idx = I.build_index(docs, 4)
    plan = search(idx, topics, BM25(1.2), 10)._jdf.queryExecution().executedPlan().toString()
    # one repartition of the documents and one exchange for the final top-k only
    assert plan.count("REPARTITION_BY_NUM") >= 1
    assert "WindowGroupLimit" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_upsert_last_wins_and_idempotent(spark):
    docs, _, _ = frames(spark)
    base = I.build_index(docs, 2)
    batch = spark.createDataFrame([("d1", "new text one"), ("d7", "brand new")], "id string, text string")
    once = I.upsert(base, batch, 2)
    live = {r.id: r.text for r in once.docs.collect()}
    assert live["d1"] == "new text one" and live["d7"] == "brand new" and len(live) == 6
    twice = I.upsert(once, batch, 2)
    assert sorted(r.id for r in twice.docs.collect()) == sorted(live)
    s = twice.stats.filter("field = 'text'").collect()[0]
    assert s.n_docs == 6
    # replaced postings are gone
    assert twice.postings.filter("term = 'cherry'").count() == 2


def test_create_keeps_duplicates_and_modes(spark, tmp_dir):
    docs, _, _ = frames(spark)
    dup = docs.unionByName(docs.filter("id = 'd0'").withColumn("ord", F.lit(100).cast("long")))
    path = f"{tmp_dir}/idx"
    with pytest.raises(FileNotFoundError):
        saved.index_corpus(dup, path, "append")
    saved.index_corpus(dup, path, "create")
    idx = saved.load_index(spark, path)
    assert idx.docs.filter("id = 'd0'").count() == 2
    batch = spark.createDataFrame([("d0", "zz top"), ("d0", "zz newest")], "id string, text string")
    saved.index_corpus(batch, path, "append")
    idx2 = saved.load_index(spark, path)
    got = [r.text for r in idx2.docs.filter("id = 'd0'").collect()]
    assert len(got) == 1
    # create_or_append on a fresh path de-duplicates
    p2 = f"{tmp_dir}/idx2"
    saved.index_corpus(dup, p2)
    assert saved.load_index(spark, p2).docs.filter("id = 'd0'").count() == 1


def test_persisted_index_gives_same_hits(spark, tmp_dir):
    docs, topics, _ = frames(spark)
    idx = I.build_index(docs, 3)
    saved.write_index(idx, f"{tmp_dir}/p")
    loaded = saved.load_index(spark, f"{tmp_dir}/p")
    a = sorted(tuple(r) for r in search(idx, topics, BM25(0.7), 10).collect())
    b = sorted(tuple(r) for r in search(loaded, topics, BM25(0.7), 10).collect())
    assert a == b


def test_saved_index_prunes_term_partitions_and_keeps_buckets(spark, tmp_dir):
    docs, topics, _ = frames(spark)
    idx = I.build_index(docs, 3)
    saved.write_index(idx, f"{tmp_dir}/tp", buckets=3, groups=4)
    loaded = saved.load_index(spark, f"{tmp_dir}/tp")
    assert len(loaded.bounds["text"]) >= 2 and len(loaded.ranges) == 1
    a = sorted(tuple(r) for r in search(idx, topics, BM25(0.7), 10).collect())
    b = sorted(tuple(r) for r in search(loaded, topics, BM25(0.7), 10).collect())
    assert a == b
    one = topics.filter("query_id = 1")
    plan = search(loaded, one, BM25(0.7), 10)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,apple)" in plan  # few terms: literals that reach the files
    many = spark.createDataFrame([(1, "apple " + " ".join(f"t{i}" for i in range(70)))], "query_id long, query string")
    plan = search(loaded, many, BM25(0.7), 10)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert "Bucketed: true" in plan or "bucketed" in plan.lower()
    # the per-(query, doc) sum sits directly on the bucketed scan: the final aggregate is
    # followed by its partial aggregate, with no exchange in between
    lines = [l.strip(" :+-") for l in plan.splitlines()]
    import re
    final = [i for i, l in enumerate(lines)
             if re.match(r"HashAggregate\(keys=\[query_id#\d+L?, ord#", l) and "partial_" not in l]
    assert final and all("partial_sum" in lines[i + 1] for i in final)


def test_create_or_append_equals_create_of_last_wins(spark, tmp_dir):
    a = spark.createDataFrame([("x1", "alpha beta"), ("x2", "gamma")], "id string, text string")
    b = spark.createDataFrame([("x2", "gamma delta"), ("x3", "eps")], "id string, text string")
    p = f"{tmp_dir}/ca"
    saved.index_corpus(a, p, partitions=2)
    saved.index_corpus(b, p, partitions=2)
    got = saved.load_index(spark, p)
    union = a.withColumn("v", F.lit(0)).unionByName(b.withColumn("v", F.lit(1)))
    expect = {r.id: r.text for r in union.orderBy("v").collect()}
    assert {r.id: r.text for r in got.docs.collect()} == expect
    s = got.stats.filter("field = 'text'").collect()[0]
    assert (s.n_docs, s.n_tokens) == (3, 5)
    assert {r.term: r.df for r in got.terms.filter("field = 'text'").collect()} == \
        {"alpha": 1, "beta": 1, "gamma": 1, "delta": 1, "eps": 1}
