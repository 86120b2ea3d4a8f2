"""Benchmark: index build, evaluation, parameter sweeps and comparisons.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  The index is built from ``documents`` and written once to
a new folder below ``BENCH_SCRATCH`` or the session's checkpoint folder (timed as ``index_build``); every later step reads the
saved index, as a search service would.  Each step runs to completion through the
``noop`` sink, so the full plan executes without collecting rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from rankeval.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app="rankeval-bench")
    from rankeval.operators import compare as C
    from rankeval.operators import evaluate as E
    from rankeval.operators import index as I
    from rankeval.operators import saved
    from rankeval.operators import search as S
    from rankeval.operators import tune as T
    from rankeval.operators.models import BM25, JM
    from rankeval.sources import fixtures as fx

    from rankeval.session import checkpoint_dir

    scratch = f"{os.environ.get('BENCH_SCRATCH') or checkpoint_dir(spark)}/rankeval-bench-{uuid.uuid4().hex}"
    times: dict[str, float] = {}

    def run(name, fn):
        t0 = time.perf_counter()
        df = fn()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    # Warm-up (not timed): JIT and codegen of the same code paths on a small index built
    # from the benchmark passages of the same directory.
    from pyspark.sql import functions as F
    bench_docs = fx.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("ord"), F.col("item_id").alias("id"), F.lit("").alias("title"), "text")
    warm = saved.load_index(spark, saved.write_index(I.build_index(bench_docs, cpus), f"{scratch}/warm", cpus))
    no_qrels = spark.createDataFrame([], "query_id long, doc_id long, score int")
    E.evaluate(warm, fx.topics(spark, sf_dir), no_qrels, BM25(0.4), 10).write.format("noop").mode("overwrite").save()
    T.sweep(warm, fx.topics(spark, sf_dir), no_qrels, [JM()], [T.LAMBDA_GRID], 10).write.format("noop").mode(
        "overwrite").save()

    path = f"{scratch}/index"
    run("index_build", lambda: (saved.write_index(fx.index(spark, sf_dir, cpus), path, cpus), None)[1])
    idx = saved.load_index(spark, path)
    topics = fx.topics(spark, sf_dir)

    def write_qrels():
        fx.qrels(spark, sf_dir, idx).write.parquet(f"{scratch}/qrels")
    run("qrels_derive", lambda: (write_qrels(), None)[1])
    qrels = spark.read.parquet(f"{scratch}/qrels")

    run("bm25_search", lambda: S.search(idx, topics, BM25(0.4), 10))
    run("bm25_eval", lambda: E.evaluate(idx, topics, qrels, BM25(0.4), 10))
    run("jm_eval", lambda: E.evaluate(idx, topics, qrels, JM(0.2), 10))
    run("sweep_k1", lambda: T.sweep(idx, topics, qrels, [BM25()], [T.K1_GRID], 10))
    run("sweep_lambda", lambda: T.sweep(idx, topics, qrels, [JM()], [T.LAMBDA_GRID], 10))
    n = topics.count()
    train, test = fx.train_test_ranges(spark, sf_dir)
    run("train_test", lambda: T.train_test(idx, topics, qrels, JM(), train, test, "MAP", 10)["test"])

    def runs_df():
        sw = T.sweep(idx, topics, qrels, [BM25(), JM()], [(0.4, 1.2, 2.0), (0.1, 0.5)], 10, "double")
        from pyspark.sql import functions as F
        return sw.select(F.concat("model", F.lit(":"), F.col("param").cast("string")).alias("run"),
                         "query_id", F.col("ap").alias("value"))
    run("runs_write", lambda: (runs_df().write.parquet(f"{scratch}/runs"), None)[1])
    runs = spark.read.parquet(f"{scratch}/runs")
    run("compare_t", lambda: C.compare(runs, "t", 0.05, baseline="bm25:0.4"))
    run("compare_wilcoxon", lambda: C.compare(runs, "wilcoxon", 0.05, baseline="bm25:0.4"))

    # Steady state (not in the total): the same search and evaluation once more, with
    # generated code and JIT already warm.
    warm_times: dict[str, float] = {}
    for name, fn in (("bm25_search", lambda: S.search(idx, topics, BM25(0.4), 10)),
                     ("bm25_eval", lambda: E.evaluate(idx, topics, qrels, BM25(0.4), 10))):
        t0 = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        warm_times[name] = round(time.perf_counter() - t0, 3)

    # Scale of the inputs (not timed): rows in, for the scaling curve across sf.
    rows = {
        "documents": fx.table(spark, sf_dir, "documents").count(),
        "postings": idx.postings.count(),
        "topics": n,
        "judgments_positive": qrels.filter("score > 0").count(),
    }
    total = round(sum(times.values()), 3)
    label = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(label)
    except ValueError:
        sf = label
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus, "rows": rows, "warm": warm_times}))
    spark.stop()


if __name__ == "__main__":
    main()
