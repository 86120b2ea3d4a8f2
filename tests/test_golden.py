"""Arithmetic checks against the reference's published result files.

The per-query rows are the reference's own outputs (fixed values); our averaging
and arg-max operators must reproduce its summary rows from them.
"""

import pytest
from pyspark.sql import functions as F

from rankeval.operators.evaluate import mean_nonzero
from rankeval.operators.tune import LAMBDA_GRID, best_param

# BM25 k1 0.4, cut 10, queries 1-20 (query, RR, AP@N, P@N, Recall@N).
BM25_ROWS = [
    (1, 1.0, 0.9626543209876544, 0.9, 0.0141287284144427),
    (2, 0.3333333333333333, 0.3604166666666666, 0.4, 0.012738853503184714),
    (3, 0.5, 0.6226190476190476, 0.5, 0.007961783439490446),
    (4, 0.0, 0.0, 0.0, 0.0),
    (5, 0.3333333333333333, 0.594047619047619, 0.6, 0.009771986970684038),
    (6, 1.0, 1.0, 0.9, 0.009384775808133473),
    (7, 1.0, 1.0, 1.0, 0.02079002079002079),
    (8, 1.0, 0.6071428571428572, 0.4, 0.006329113924050633),
    (9, 1.0, 0.7440476190476192, 0.7, 0.03664921465968586),
    (10, 1.0, 0.6756802721088436, 0.7, 0.014736842105263158),
    (11, 1.0, 0.9333333333333332, 0.6, 0.014457831325301205),
    (12, 0.25, 0.25, 0.2, 0.003246753246753247),
    (13, 0.25, 0.25, 0.2, 0.002306805074971165),
    (14, 1.0, 0.8412257495590829, 0.9, 0.03529411764705882),
    (15, 1.0, 0.5873015873015873, 0.3, 0.0070921985815602835),
    (16, 1.0, 0.9484126984126983, 0.6, 0.015503875968992248),
    (17, 1.0, 0.9085317460317459, 0.8, 0.011976047904191617),
    (18, 1.0, 0.8385912698412697, 0.8, 0.012738853503184714),
    (19, 1.0, 0.8142857142857143, 0.5, 0.04504504504504504),
    (20, 1.0, 1.0, 0.9, 0.01282051282051282),
]
BM25_MEAN = (0.8245614035087719, 0.733594236915039, 0.6263157894736843, 0.015419650564869842)

# JM test run at lambda 0.001, MAP@10, queries 21-30, and its mean.
TEST_ROWS = [(21, 0.2777777910232544), (22, 0.7152777910232544), (23, 0.6178571581840515),
             (24, 0.9765431880950928), (25, 0.38749998807907104), (26, 0.8850000500679016),
             (27, 0.8802579641342163), (28, 0.6251323223114014), (29, 0.5253968238830566),
             (30, 0.9888888597488403)]
TEST_MEAN = 0.687963193655014

# Training means per lambda (corrected labels), MAP@10, queries 1-20.
TRAIN_MEANS = [0.666865449594824, 0.6604884349201855, 0.6533246938335268, 0.6458012967517501,
               0.6434244533118448, 0.6349858488691481, 0.6539916937288485, 0.648514313917411,
               0.6338013434096387, 0.559281387552619, 0.27465986566884176]


def test_nonzero_means_reproduce_summary_row(spark):
    m = spark.createDataFrame([(*r, 10) for r in BM25_ROWS],
                              "query_id long, rr double, ap double, p double, recall double, cut int")
    r = mean_nonzero(m).collect()[0]
    for got, want in zip((r.rr, r.ap, r.p, r.recall), BM25_MEAN):
        assert got == pytest.approx(want, rel=1e-12)


def test_test_split_mean(spark):
    v = spark.createDataFrame(TEST_ROWS, "query_id long, value double")
    got = v.agg(F.avg(F.when(F.col("value") > 0, F.col("value")))).collect()[0][0]
    assert got == pytest.approx(TEST_MEAN, rel=1e-12)


def test_best_lambda_is_first_maximum(spark):
    means = spark.createDataFrame([("jm", "MAP", g, m) for g, m in zip(LAMBDA_GRID, TRAIN_MEANS)],
                                  "model string, metric string, param double, mean double")
    b = best_param(means).collect()
    assert [(r.param, r.mean) for r in b] == [(0.001, TRAIN_MEANS[0])]


def test_best_param_ties_nan_and_nonpositive(spark):
    means = spark.createDataFrame(
        [("jm", "MAP", 0.1, 0.5), ("jm", "MAP", 0.2, 0.5), ("jm", "MAP", 0.3, float("nan")),
         ("bm25", "P", 1.0, 0.0), ("bm25", "P", 2.0, float("nan"))],
        "model string, metric string, param double, mean double")
    b = {(r.model, r.metric): r.param for r in best_param(means).collect()}
    assert b == {("jm", "MAP"): 0.1}
