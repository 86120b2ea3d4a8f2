"""Ranking on large collections, batches of a saved index, pruning on its default layout."""

import json
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from micro import frames
from rankeval.operators import index as I
from rankeval.operators import numbering, saved
from rankeval.operators.evaluate import evaluate, judge
from rankeval.operators.models import BM25, JM, model_from_name
from rankeval.operators.search import fetch_hits, search
from rankeval.streaming import index_stream


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _stats(idx):
    terms = idx.terms.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")
    return _rows(terms), _rows(idx.stats.select("field", "n_docs", "n_tokens", F.round("avgdl", 9)))


def test_term_of_every_document_still_ranks(spark):
    """200,000 documents that all hold the term: its idf is about 2.5e-6, and tf decides."""
    n = 200_000
    docs = spark.range(n).select(
        F.col("id").alias("ord"), F.col("id").cast("string").alias("id"), F.lit("").alias("title"),
        F.repeat(F.lit("the "), (F.col("id") % 20 + 1).cast("int")).alias("text"))
    topics = spark.createDataFrame([(1, "the")], "query_id long, query string")
    hits = search(I.build_index(docs, 8), topics, BM25(1.2), 10).orderBy("rank").collect()
    assert [h.ord for h in hits] == list(range(19, 200, 20))
    idf = math.log1p(0.5 / (n + 0.5))
    assert hits[0].score == pytest.approx(idf * 20 / (20 + 1.2 * (0.25 + 0.75 * 20 / 10.5)), rel=1e-6)


def test_null_ids_are_all_kept(spark, tmp_dir):
    docs = spark.createDataFrame([(None, "a b"), (None, "c"), ("x", "d"), ("x", "e")], "id string, text string").coalesce(1)
    saved.index_corpus(docs, f"{tmp_dir}/n")
    idx = saved.load_index(spark, f"{tmp_dir}/n")
    assert sorted((r.id or "", r.text) for r in idx.docs.collect()) == [("", "a b"), ("", "c"), ("x", "e")]
    saved.index_corpus(spark.createDataFrame([(None, "f")], "id string, text string"), f"{tmp_dir}/n")
    assert sorted((r.id or "") for r in saved.load_index(spark, f"{tmp_dir}/n").docs.collect()) == ["", "", "", "x"]


def test_numbers_of_a_batch_never_collide(spark):
    base = I.build_index(spark.createDataFrame([(0, "d0", "apple")], "ord long, id string, text string"), 2)
    up = I.upsert(base, spark.createDataFrame([(0, "dNEW", "apple")], "ord long, id string, text string"), 2)
    assert len({r.ord for r in up.docs.collect()}) == 2
    topics = spark.createDataFrame([(1, "apple")], "query_id long, query string")
    assert search(up, topics, BM25(1.2), 10).count() == 2


def test_explicit_version_wins(spark):
    docs = spark.createDataFrame([("x", "new", 5), ("x", "old", 3), ("y", "one", 1)], "id string, text string, version int")
    got = {r.id: r.text for r in I.build_index(docs.coalesce(1), 2, dedup=True).docs.collect()}
    assert got == {"x": "new", "y": "one"}


def test_stream_batch_keeps_the_newer_file(spark, tmp_dir):
    """One micro-batch with a small older and a larger newer file: file time decides, not file size."""
    src = f"{tmp_dir}/in"
    os.makedirs(src)

    def write(name, rows, when):
        with open(f"{src}/{name}", "w") as f:
            f.write("\n".join(json.dumps({"_id": i, "title": "t", "text": x, "metadata": {"url": "u", "pubmed_id": "p"}}) for i, x in rows) + "\n")
        os.utime(f"{src}/{name}", (when, when))
    write("b-old.jsonl", [("d1", "OLD")], 1_000_000_000)
    write("a-new.jsonl", [("d1", "NEW")] + [(f"f{i}", "filler " * 50) for i in range(200)], 1_500_000_000)
    index_stream(spark, src, f"{tmp_dir}/idx", f"{tmp_dir}/ck", partitions=2, available_now=True).awaitTermination(180)
    assert [r.text for r in saved.load_index(spark, f"{tmp_dir}/idx").docs.filter("id = 'd1'").collect()] == ["NEW"]


def _corpus(spark, n, word="w", first=0):
    return spark.range(first, first + n).select(
        F.concat(F.lit("d"), F.col("id")).alias("id"), F.concat(F.lit("title "), F.col("id") % 7).alias("title"),
        F.concat_ws(" ", F.lit(word), F.concat(F.lit("t"), F.col("id") % 13), F.concat(F.lit("u"), F.col("id"))).alias("text"))


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_segments_equal_a_rebuild_and_compact(spark, tmp_dir):
    first, second, third = _corpus(spark, 60), _corpus(spark, 20, "changed", 50), _corpus(spark, 5, "again", 0)
    for batch in (first, second, third):
        saved.index_corpus(batch, f"{tmp_dir}/s", partitions=2)
    union = first.withColumn("version", F.lit(1)).unionByName(second.withColumn("version", F.lit(2))).unionByName(
        third.withColumn("version", F.lit(3)))
    rebuilt, seg = I.build_index(union, 2, dedup=True), saved.load_index(spark, f"{tmp_dir}/s")
    assert len(seg.ranges) == 3 and seg.replaced is not None
    live = ("id", "title", "text")
    assert _rows(seg.docs.select(*live)) == _rows(rebuilt.docs.select(*live)) and _stats(seg) == _stats(rebuilt)
    topics = spark.createDataFrame([(1, "w t3 again u4"), (2, "changed t1")], "query_id long, query string")

    def scores(idx):
        return _rows(search(idx, topics, JM(0.3), 100).join(idx.docs, "ord").select("query_id", "id", "score"))
    want = scores(rebuilt)
    assert scores(seg) == want
    # batches are merged by a new index of the old one's documents
    saved.index_corpus(seg.docs.drop("ord", "slot"), f"{tmp_dir}/m", "create", partitions=2)
    whole = saved.load_index(spark, f"{tmp_dir}/m")
    assert len(whole.ranges) == 1 and _stats(whole) == _stats(rebuilt) and scores(whole) == want


def test_create_starts_over(spark, tmp_dir):
    saved.index_corpus(_corpus(spark, 30), f"{tmp_dir}/c", partitions=2)
    saved.index_corpus(_corpus(spark, 5, "other"), f"{tmp_dir}/c", partitions=2)
    saved.index_corpus(_corpus(spark, 7, "fresh"), f"{tmp_dir}/c", "create", partitions=2)
    idx = saved.load_index(spark, f"{tmp_dir}/c")
    assert idx.docs.count() == 7 and idx.replaced is None and idx.terms.filter("term = 'other'").count() == 0


def test_a_batch_that_was_not_finished_is_not_read(spark, tmp_dir, monkeypatch):
    saved.index_corpus(_corpus(spark, 30), f"{tmp_dir}/u", partitions=2)
    before = _rows(saved.load_index(spark, f"{tmp_dir}/u").docs)

    def lost(*_):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(saved, "_stats", lost)
        with pytest.raises(RuntimeError):
            saved.index_corpus(_corpus(spark, 10, "changed"), f"{tmp_dir}/u", partitions=2)
    assert _rows(saved.load_index(spark, f"{tmp_dir}/u").docs) == before
    saved.index_corpus(_corpus(spark, 10, "changed"), f"{tmp_dir}/u", partitions=2)
    docs = saved.load_index(spark, f"{tmp_dir}/u").docs
    assert docs.count() == 30 and docs.filter("text like 'changed%'").count() == 10


def test_append_writes_the_batch_only(spark, tmp_dir):
    written = []
    for n in (200, 4000):
        path = f"{tmp_dir}/a{n}"
        saved.index_corpus(_corpus(spark, n), path, partitions=2)
        saved.index_corpus(_corpus(spark, 20, "changed", 10), path, partitions=2)
        second = saved._batches(spark, path)[1].batch
        written.append(sum(_bytes(f"{path}/{t}/batch={second}") for t in ("docs", "postings", "terms", "replaced", "stats")))
    assert written[1] < 1.1 * written[0]


def _scans(df):
    """(name of a column only that scan has, files read) of the executed plan's file scans."""
    df.collect()
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(p.finalPhysicalPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(p.plan())
        elif name == "FileSourceScanExec":
            found.append((p.output().mkString(","), int(p.metrics().apply("numFiles").value())))
        else:
            children = p.children()
            plans += [children.apply(i) for i in range(children.size())]
    return found


def test_a_search_opens_the_groups_of_its_terms_only(spark, tmp_dir):
    saved.write_index(I.build_index(_corpus(spark, 3000).withColumn("ord", F.monotonically_increasing_id()), 8), f"{tmp_dir}/p", 4, 40)
    idx = saved.load_index(spark, f"{tmp_dir}/p")
    assert len(idx.bounds["text"]) > 15
    files = sum(1 for d, _, names in os.walk(f"{tmp_dir}/p/postings") for f in names if f.endswith(".parquet") and "field=text" in d)
    three = spark.createDataFrame([(1, "u17 u2044 u951")], "query_id long, query string")
    hits = search(idx, three, BM25(1.2), 10)
    assert sorted(r.ord for r in hits.collect()) == [r.ord for r in idx.docs.filter("id in ('d17', 'd2044', 'd951')").orderBy("ord").collect()]
    opened = [n for out, n in _scans(search(idx, three, BM25(1.2), 10)) if "norm" in out]
    assert opened and max(opened) <= 3 * 4 < files / 5
    # many terms: the same by dynamic pruning
    many = spark.createDataFrame([(1, " ".join(f"u{100 + i}" for i in range(80)))], "query_id long, query string")
    opened = [n for out, n in _scans(search(idx, many, BM25(1.2), 10)) if "norm" in out]
    assert opened and max(opened) < files / 5


def test_hits_open_their_slots_only(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(saved, "SLOT_BYTES", 1)  # as many slots as the input has bytes, up to MAX_SLOTS
    monkeypatch.setattr(saved, "MAX_SLOTS", 60)
    monkeypatch.setattr(saved, "MIN_SLOT_DOCS", 1)
    saved.write_index(I.build_index(_corpus(spark, 3000).withColumn("ord", F.col("id").substr(2, 9).cast("long")), 8), f"{tmp_dir}/h", 4)
    idx = saved.load_index(spark, f"{tmp_dir}/h")
    assert idx.docs.select("slot").distinct().count() == 60
    topics = spark.createDataFrame([(1, "u17 u20"), (2, "u1999")], "query_id long, query string")
    qrels = spark.createDataFrame([(1, "d17", 1)], "query_id long, doc_id string, score int")
    for small in (True, False):  # slots 0 and 39 of 60
        for look in (lambda: judge(search(idx, topics, BM25(1.2), 10), idx.docs, qrels, small),
                     lambda: fetch_hits(search(idx, topics, BM25(1.2), 10), idx.docs, broadcast_ok=small)):
            assert sorted(r.id for r in look().collect()) == ["d17", "d1999", "d20"]
            opened = [n for out, n in _scans(look()) if "id#" in out and "slot#" in out]
            assert opened and max(opened) <= 4
    # more than a thousand hits, all in one slot of documents each: no limit on their number
    all_ = spark.createDataFrame([(q, f"u{50 * q + 1} u{50 * q + 7}") for q in range(10)], "query_id long, query string")
    opened = [n for out, n in _scans(fetch_hits(search(idx, all_, BM25(1.2), 1000), idx.docs, broadcast_ok=False)) if "slot#" in out and "id#" in out]
    assert opened and max(opened) <= 20


@pytest.mark.parametrize("terabytes", [0.001, 1, 10, 25, 100, 400])
def test_layout_by_formula(terabytes):
    n = int(terabytes * 1e12)
    plan = saved.layout(n, 8)
    assert plan.buckets <= 4096 < 100_000 and plan.ranges * plan.buckets * plan.groups <= 1.1e6 and plan.slots <= 100_000
    if terabytes >= 1:
        assert plan.ranges * plan.buckets >= 900 and n / (plan.ranges * plan.buckets * plan.groups) >= 8e6
        assert 3 * 1.5 / plan.groups < 0.05
    if terabytes >= 10:
        assert plan.ranges > 1


def test_groups_hold_equal_shares_and_heavy_terms_stand_alone(spark):
    """Zipf-like document frequencies: three terms open less than a twentieth of the postings."""
    n, docs = 30_000, 1_000_000
    df = spark.range(1, n + 1).select(F.lit("text").alias("field"), F.concat(F.lit("w"), F.col("id")).alias("term"),
                                      F.least(F.lit(docs * 0.9), F.lit(docs * 2.0) / F.col("id")).cast("long").alias("df"))
    bounds = saved.term_bounds(df, 96)["text"]
    share = {}
    rows = df.collect()
    total = sum(r.df for r in rows)
    for r in rows:
        g = saved.group_of(r.term, bounds)
        share.setdefault(g, []).append((r.df / total, r.term))
    light = [sum(s for s, _ in members) for members in share.values() if len(members) > 1]
    assert max(light) < 0.0167 and len(share) < 3 * 96
    heavy = [members[0] for members in share.values() if len(members) == 1]
    assert all(s < 0.09 for s, _ in heavy) and sum(sorted(light)[-3:]) < 0.05
    got = df.select("term", saved.term_group(F.col("term"), bounds).alias("g")).collect()
    assert all(r.g == saved.group_of(r.term, bounds) for r in got)


def test_term_group_of_odd_terms(spark):
    bounds = sorted(["b", "é", "日本", "🙂", "b\0", "zz"], key=lambda t: t.encode())
    terms = ["", "a", "b", "b\0", "ba", "z", "zz", "zzz", "é", "éa", "日", "日本", "🙂", "🙃"]
    got = spark.createDataFrame([(t,) for t in terms], "t string").select("t", saved.term_group(F.col("t"), bounds).alias("g")).collect()
    assert [r.g for r in got] == [saved.group_of(t, bounds) for t in terms]
    assert saved.group_of("b", bounds) != saved.group_of("ba", bounds)


def test_several_ranges_search_without_a_shuffle_of_postings(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(saved, "MAX_BUCKETS", 2)
    whole = I.build_index(_corpus(spark, 400).withColumn("ord", F.col("id").substr(2, 9).cast("long")), 4)
    saved.write_index(whole, f"{tmp_dir}/r", 6)
    idx = saved.load_index(spark, f"{tmp_dir}/r")
    assert len(idx.ranges) == 3
    topics = spark.createDataFrame([(1, "w t3 u4"), (2, "t1 u399 u200")], "query_id long, query string")
    want, got = search(whole, topics, BM25(0.9), 50), search(idx, topics, BM25(0.9), 50)
    assert _rows(got) == _rows(want) and _stats(idx) == _stats(whole)
    plan = got._jdf.queryExecution().executedPlan().toString()
    lines = [x.strip(" :+-") for x in plan.splitlines()]
    final = [i for i, x in enumerate(lines) if re.match(r"HashAggregate\(keys=\[query_id#\d+L?, ord#", x) and "partial_" not in x]
    assert len(final) == 3 and all("partial_sum" in lines[i + 1] for i in final)
    swept = search(idx, topics, [(BM25(), [0.4, 0.9]), (JM(), [0.3])], 50)
    assert _rows(swept.filter("model = 'bm25' and param = 0.9").drop("model", "param")) == _rows(want)


def test_numbers_do_not_depend_on_parallelism(spark, tmp_dir):
    import random

    rnd = random.Random(3)
    os.makedirs(f"{tmp_dir}/n")
    expect = []
    for name, n in (("b.json", 700), ("a.json", 30), ("c.json", 1500)):
        rows = [f"{name}-{i}" for i in range(n)]
        expect.append((name, rows))
        with open(f"{tmp_dir}/n/{name}", "w") as f:
            f.write("\n".join(json.dumps({"id": r, "text": "x" * rnd.randint(0, 90)}) for r in rows) + "\n")
    want = {r: k for k, r in enumerate(r for _, rows in sorted(expect) for r in rows)}
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    for block, parts in (("128m", "1"), ("4k", "1"), ("16k", "13"), ("1k", "3")):
        spark.conf.set(sizes[0], block)
        spark.conf.set(sizes[1], parts)
        try:
            with numbering.same_blocks(spark):
                docs = spark.read.schema("id string, text string").json(f"{tmp_dir}/n")
                got = {r.id: r.ord for r in numbering.numbered(docs, 5).select("id", "ord").collect()}
        finally:
            for s in sizes:
                spark.conf.unset(s)
        assert got == {k: v + 5 for k, v in want.items()}


def test_grades_and_undefined_metrics(spark):
    docs, topics, qrels = frames(spark)
    idx = I.build_index(docs, 2)
    judged = {(r.query_id, r.id): (r.grade, r.rel) for r in judge(search(idx, topics, BM25(1.2), 10), idx.docs, qrels).collect()}
    assert judged[(1, "d1")] == (2, True) and judged[(1, "d0")] == (0, False) and judged[(3, "d0")] == (None, False)
    nan = {r.query_id: r for r in evaluate(idx, topics, qrels, BM25(1.2), 3).collect()}
    zero = {r.query_id: r for r in evaluate(idx, topics, qrels, BM25(1.2), 3, undefined="zero").collect()}
    assert math.isnan(nan[2].p) and math.isnan(nan[3].recall)
    assert zero[2].p == 0.0 and zero[3].recall == 0.0 and zero[1] == nan[1]
    with pytest.raises(ValueError):
        evaluate(idx, topics, qrels, BM25(1.2), 3, undefined="x")


@pytest.mark.parametrize("bad", [lambda: BM25(float("inf")), lambda: BM25(-1), lambda: BM25(1, 2), lambda: JM(0), lambda: JM(1.1),
                                 lambda: model_from_name("bm25", math.inf), lambda: JM(float("nan"))])
def test_parameters_are_checked(bad):
    with pytest.raises(ValueError):
        bad()


def test_shared_folder_is_required_on_a_cluster(spark):
    from rankeval.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(*_):
                return None
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session)


def test_layout_sample_of_one_file_is_dealt_to_all_tasks(spark, tmp_dir):
    path = f"{tmp_dir}/one"
    spark.range(2_000).select(F.col("id").alias("ord"), F.lit("a b").alias("text"), F.lit(0).cast("long").alias("slot")).coalesce(1).write.parquet(path)
    written = spark.read.parquet(path)
    sample = saved._sample(written, 1 << 16, 0, 1_999)
    assert written.rdd.getNumPartitions() == 1
    assert sample.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sample.count() == 2_000


def test_term_groups_are_compiled_conditions(spark):
    bounds = [f"b{i:02d}" for i in range(40)]
    df = spark.createDataFrame([("b07",), (None,)], "t string").select(saved.term_group(F.col("t"), bounds).alias("g"))
    assert [r.g for r in df.collect()] == [8, 0]
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_judgments_count_frequent_terms_of_candidates_only(spark, tmp_dir):
    """Against brute force; two texts of one number count as one document."""
    import random

    from rankeval.sources import fixtures as fx
    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 14)))) for i in range(25)]
    docs = [(i // 2 if i < 20 else i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(150)]
    docs += [(200 + i, f"x {t} y") for i, t in items]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_dir}/benchmark.parquet")
    flat = spark.createDataFrame(docs, "ord long, text string").select("ord", F.col("ord").alias("id"), F.lit("t").alias("title"), "text")
    got = fx.qrels(spark, tmp_dir, I.build_index(flat, 3))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" in plan  # terms of a candidate's item are looked up, not joined with every document
    held, whole = {}, set()
    df = {w: len({(o, len(t.split())) for o, t in docs if w in t.split()}) for w in words}
    for item, text in items:
        terms = text.split()
        rare = sorted(terms, key=lambda w: (df[w], w))[: len(terms) // 2 + 1]
        for o in {o for o, _ in docs}:
            texts = {len(t.split()): set() for n, t in docs if n == o}
            for n, t in docs:
                if n == o:
                    texts[len(t.split())] |= set(t.split())  # texts of one length are one document
            n = sum(len(set(terms) & t) for t in texts.values())
            if any(set(rare) & t for t in texts.values()) and 2 * n >= len(terms):
                held[item, o] = int(4 * n >= 3 * len(terms))
                if n == len(terms) and any(f" {text} " in f" {t} " for m, t in docs if m == o):
                    whole.add((item, o))
    expected = {k: 2 if k in whole else v for k, v in held.items()}
    assert {(r.query_id, r.doc_id): r.score for r in got.collect()} == expected


# ---- tasks of bounded size ----

def test_tasks_hold_a_bounded_part_of_the_input(spark, monkeypatch):
    size = 6 << 30
    for cores in (4, 12, 400):
        plan = saved.layout(size, cores)
        assert plan.ranges * plan.buckets * saved.per_bucket(size, plan) * 2 * I.TASK_BYTES >= size
    assert saved.per_bucket(1 << 20, saved.layout(1 << 20, 12)) == 1
    monkeypatch.setattr(I, "input_bytes", lambda df: size)
    assert I.partitions_of(spark.range(1)) * I.TASK_BYTES >= size


def test_several_tasks_of_a_bucket_change_no_row(spark, tmp_dir, monkeypatch):
    docs = spark.range(200).select(F.col("id").alias("ord"), F.col("id").cast("string").alias("id"), F.lit("t").alias("title"),
                                   F.concat_ws(" ", F.lit("all"), (F.col("id") % 7).cast("string")).alias("text"))
    topics = spark.createDataFrame([(1, "all 3")], "query_id long, query string")
    found = []
    for n in (1, 3):
        monkeypatch.setattr(saved, "per_bucket", lambda n_bytes, plan, n=n: n)
        path = f"{tmp_dir}/tasks-{n}"
        saved.index_corpus(docs, path, "create", partitions=2)
        files = [os.path.join(d, f) for d, _, fs in os.walk(f"{path}/postings") for f in fs if f.endswith(".parquet")]
        text = [f for f in files if "field=title" in f]
        assert len(text) == 2 * n
        buckets = {f: int(re.search(r"_(\d{5})\.c\d+", f)[1]) for f in text}
        for f, b in buckets.items():
            own = spark.read.parquet(f).select(F.pmod(F.hash("ord"), F.lit(2)).alias("b")).distinct().collect()
            assert [r.b for r in own] == [b]
        idx = saved.load_index(spark, path)
        found.append((_rows(idx.postings.select(*I.POSTING_COLUMNS)), _stats(idx), _rows(search(idx, topics, BM25(1.2), 10))))
    assert found[0] == found[1]


def test_buckets_of_the_collection_do_not_grow_with_the_input(spark, tmp_dir, monkeypatch):
    """More documents, more buckets of about the same size, so that a task of a sweep sums the scores of so many documents at
    most; the documents are dealt out once, by slot."""
    from rankeval.operators.tune import sweep
    from rankeval.session import path_bytes
    from rankeval.sources import fixtures as fx

    words = F.concat_ws(" ", *[F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(40)).cast("string")) for i in range(12)])
    spark.range(600).select(F.col("id").alias("doc_id"), words.alias("text"), F.lit("s").alias("source"),
                            F.lit("en").alias("lang")).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.range(5).select(F.col("id").alias("item_id"), words.alias("text")).write.parquet(f"{tmp_dir}/benchmark.parquet")
    size, found = path_bytes(spark, f"{tmp_dir}/documents.parquet"), []
    for buckets in (4, 9):
        monkeypatch.setattr(fx, "COLLECTION_BUCKET_BYTES", -(-size // buckets), raising=False)
        monkeypatch.setattr(fx, "_SAVED", {})
        idx, topics, qrels = fx.saved_collection(spark, tmp_dir)
        base = next(iter(fx._SAVED.values()))
        assert [r.buckets for r in spark.read.parquet(f"{base}/index/batches").collect()] == [buckets]
        found.append((_rows(idx.postings.select(*I.POSTING_COLUMNS)), _stats(idx), _rows(qrels),
                      _rows(sweep(idx, topics, qrels, ["jm"]))))
    assert found[0] == found[1]
    assert len(found[0][3]) == 55
