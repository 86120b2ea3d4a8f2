import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankeval.functions.signed_rank import upper_tails
from rankeval.operators.compare import compare, compare_all, run_pairs, signed_ranks, unpaired, welch_t, wilcoxon_exact


def _brute_wilcoxon(x, y):
    d = [b - a for a, b in zip(x, y)]
    m = [abs(v) for v in d]
    order = sorted(m)
    rank = {v: (order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in set(m)}
    wp = sum(rank[abs(v)] for v in d if v > 0)
    n = len(d)
    wmax = max(wp, n * (n + 1) / 2 - wp)
    ge = sum(1 for bits in itertools.product((0, 1), repeat=n) if sum((j + 1) for j in range(n) if bits[j]) >= wmax)
    return wmax, 2 * ge / 2 ** n


def _runs(spark, x, y):
    rows = [("a", i, v) for i, v in enumerate(x)] + [("b", i, v) for i, v in enumerate(y)]
    runs = spark.createDataFrame(rows, "run string, query_id long, value double")
    pairs = spark.createDataFrame([("a", "b")], "run_a string, run_b string")
    return run_pairs(runs, pairs)


@pytest.mark.parametrize("x,y", [
    ([0.1, 0.5, 0.3, 0.9, 0.4, 0.2], [0.3, 0.5, 0.1, 1.0, 0.7, 0.2]),            # a zero and ties
    ([0.2, 0.4, 0.6, 0.8, 1.0, 0.1, 0.3, 0.5, 0.7, 0.9], [0.3, 0.5, 0.5, 0.9, 0.9, 0.2, 0.2, 0.6, 0.8, 1.0]),
])
def test_wilcoxon_exact_matches_enumeration(spark, x, y):
    r = wilcoxon_exact(_runs(spark, x, y)).collect()[0]
    wmax, p = _brute_wilcoxon(x, y)
    assert r.w_max == pytest.approx(wmax)
    assert r.p == pytest.approx(p, abs=1e-12)


def test_wilcoxon_null_table_n10():
    assert upper_tails(10, np.array([45.0, 55.0, 55.5, 27.5]))[:3] == pytest.approx([43 / 1024, 1 / 1024, 0.0])


def test_null_tables_against_all_subsets():
    for n in range(1, 21):
        sums = np.zeros(1, np.int64)
        for rank in range(1, n + 1):
            sums = np.concatenate([sums, sums + rank])
        top = n * (n + 1) / 2
        w = np.arange(top / 2, top + 1, 0.5)
        assert upper_tails(n, w) == pytest.approx([(sums >= x).mean() for x in w], rel=1e-12, abs=0)


def test_null_tails_of_many_pairs():
    """Exact integers of Python for n = 200, and tails beyond 1,000 pairs down to the range of doubles."""
    n, least = 200, 14_000
    top = n * (n + 1) // 2
    bound = top - least
    counts = [1] + [0] * bound
    for rank in range(1, n + 1):
        for s in range(bound, rank - 1, -1):
            counts[s] += counts[s - rank]
    exact = [sum(counts[: top - w + 1]) / 2 ** n for w in (least, least + 1000, least + 4000)]
    assert upper_tails(n, np.array([least, least + 1000, least + 4000])) == pytest.approx(exact, rel=1e-11)
    assert upper_tails(1500, np.array([1500 * 1501 / 4]))[0] == pytest.approx(0.5, abs=1e-3)
    middle, spread = 2000 * 2001 / 4, math.sqrt(2000 * 2001 * 4001 / 24)
    assert upper_tails(2000, np.array([middle + 3 * spread]))[0] == pytest.approx(0.00135, rel=0.02)
    assert 0 < upper_tails(2000, np.array([middle + 30 * spread]))[0] < 1e-190


def test_a_thousand_pairs_of_a_thousand_topics(spark):
    runs = spark.range(1001).select(F.concat(F.lit("r"), F.col("id")).alias("run"), F.explode(F.sequence(F.lit(1), F.lit(1000))).alias("query_id"),
                                    F.col("id").alias("k")).withColumn("value", F.rand(7) + F.col("k") * 1e-4).drop("k")
    got = compare(runs, "wilcoxon", 0.05, baseline="r0").agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high")).first()
    assert got.n == 1000 and 0 <= got.low < 0.05 < got.high <= 1.01


def test_all_pairs_equal_one_pair_at_a_time(spark):
    import random

    rnd = random.Random(5)
    rows = [(f"r{k}", q, float("nan") if rnd.random() < 0.05 else round(rnd.random() + k / 20, 1), "MAP" if k < 7 else "P")
            for k in range(9) for q in range(30) if not (k == 3 and q % 5 == 0) and not (k == 5 and q > 24)]
    runs = spark.createDataFrame(rows, "run string, query_id long, value double, metric string").repartition(3)
    whole = compare_all(runs, 0.1, tile=100).collect()
    names = {f"r{k}" for k in range(7)}
    assert {(r.run_a, r.run_b) for r in whole if r.metric == "MAP"} == set(itertools.combinations(sorted(names), 2))
    assert {(r.run_a, r.run_b) for r in whole if r.metric == "P"} == {("r7", "r8")}
    assert sorted(map(str, compare_all(runs, 0.1, tile=2).collect())) == sorted(map(str, whole))
    pairs = spark.createDataFrame(sorted({(r.run_a, r.run_b) for r in whole}), "run_a string, run_b string")
    one = {(r.run_a, r.run_b): r for r in wilcoxon_exact(run_pairs(runs.drop("metric"), pairs)).collect()}
    missing = {r.asDict()["run_a"] + r.run_b + r.missing_in: 0 for r in unpaired(runs, pairs).collect()}
    for r in unpaired(runs, pairs).collect():
        missing[r.run_a + r.run_b + r.missing_in] += 1
    for r in whole:
        assert (r.only_a, r.only_b) == tuple(missing.get(r.run_a + r.run_b + side, 0) for side in ("run_b", "run_a"))
        if r.test == "wilcoxon":
            e = one[r.run_a, r.run_b]
            assert (r.n, r.statistic) == (e.n, e.w_max) and r.p == pytest.approx(e.p)
    same = [r for r in whole if r.test == "t" and r.only_a == r.only_b == 0]
    t = {(r.run_a, r.run_b): r for r in welch_t(run_pairs(runs.drop("metric"), pairs)).collect()}
    assert len(same) > 5
    for r in same:
        e = t[r.run_a, r.run_b]
        assert (math.isnan(r.statistic) and math.isnan(e.t)) or (r.statistic == pytest.approx(e.t) and r.p == pytest.approx(e.p))


def test_runs_of_different_metrics_are_no_pair(spark):
    runs = spark.createDataFrame([("a", 1, 0.5, "MAP"), ("b", 1, 0.4, "P")], "run string, query_id long, value double, metric string")
    with pytest.raises(Exception, match="different metrics"):
        compare(runs, "t", 0.05, baseline="a").collect()
    assert compare_all(runs).collect() == [] and compare_all(runs.limit(0)).collect() == []


def test_signed_ranks_average_ties(spark):
    s = {r.m: r.avg_rank for r in signed_ranks(_runs(spark, [0.0, 0.0, 0.0, 0.0], [1.0, -1.0, 2.0, 0.0])).collect()}
    assert s == {0.0: 1.0, 1.0: 2.5, 2.0: 4.0}


@pytest.mark.parametrize("df,t", [(1, 12.706204736), (2, 4.302652730), (10, 2.228138852)])
def test_welch_p_value_at_table_points(spark, df, t):
    from rankeval.functions.stats import welch_p_value
    p = spark.range(1).select(welch_p_value(F.lit(t), F.lit(float(df))).alias("p")).collect()[0].p
    assert p == pytest.approx(0.05, abs=2e-5)


def test_welch_statistic(spark):
    x = [0.1, 0.4, 0.35, 0.8, 0.5]
    y = [0.3, 0.45, 0.6, 0.9, 0.75]
    r = welch_t(_runs(spark, x, y)).collect()[0]
    mx, my = sum(x) / 5, sum(y) / 5
    vx = sum((v - mx) ** 2 for v in x) / 4
    vy = sum((v - my) ** 2 for v in y) / 4
    t = (mx - my) / math.sqrt(vx / 5 + vy / 5)
    dof = (vx / 5 + vy / 5) ** 2 / ((vx / 5) ** 2 / 4 + (vy / 5) ** 2 / 4)
    assert r.t == pytest.approx(t) and r.df == pytest.approx(dof)
    assert 0 < r.p < 1


def test_compare_decision_and_baseline(spark):
    rows = [("base", i, 0.1 * i) for i in range(10)] + [("better", i, 0.1 * i + 0.5) for i in range(10)] \
        + [("same", i, 0.1 * i) for i in range(10)]
    runs = spark.createDataFrame(rows, "run string, query_id long, value double")
    d = {(r.run_b, r.test): r.decision for r in
         compare(runs, "t", 0.05, baseline="base").unionByName(compare(runs, "wilcoxon", 0.05, baseline="base")).collect()}
    assert d[("better", "wilcoxon")] == "rejected"
    assert d[("same", "t")] == "accepted"


@pytest.mark.parametrize("df,t,p", [
    (1e5, 2.0, 0.0455026), (1e6, 2.0, 0.0455003), (1e7, 2.0, 0.0455003), (1e9, 2.0, 0.0455003), (1e9, 0.0, 1.0),
    (1.0, 1.0, 0.5), (1.0, 1e6, 6.366198e-7), (3.5, 0.0, 1.0), (30.0, 10.0, 4.5752514e-11)])
def test_welch_p_value_for_any_df(spark, df, t, p):
    from rankeval.functions.stats import welch_p_value
    got = spark.range(1).select(welch_p_value(F.lit(t), F.lit(df)).alias("p")).first().p
    assert got == pytest.approx(p, rel=2e-5)


def test_nan_differences_count_but_are_never_positive(spark):
    nan = float("nan")
    r = wilcoxon_exact(_runs(spark, [1.0, 2.0, 3.0, 4.0, nan, 1.0], [0.5, 1.0, 1.5, 2.0, 1.0, nan])).first()
    assert (r.n, r.w_plus, r.w_max) == (6, 0.0, 21.0) and r.p == pytest.approx(0.03125)


def test_normal_approximation_is_explicit(spark):
    from rankeval.operators.compare import wilcoxon
    x, y = [0.0] * 40, [(-1) ** i * (1 + i % 7) + 0.5 for i in range(40)]
    exact, normal = (wilcoxon(_runs(spark, x, y), m).first() for m in ("exact", "normal"))
    assert normal.w_max == exact.w_max and normal.p == pytest.approx(exact.p, abs=0.02)
    with pytest.raises(ValueError):
        wilcoxon(_runs(spark, x, y), "other")
    many = _runs(spark, [0.0] * 1500, [1.0 + i for i in range(1500)])
    assert wilcoxon(many, "exact").first().p == 0.0  # 2 / 2**1500 is below the least double
    assert wilcoxon(many, "normal").first().p < 1e-100


@pytest.mark.parametrize("z,p", [(0.0, 1.0), (1.0, 0.3173105), (1.959964, 0.05), (5.0, 5.733e-7), (30.0, 9.8134e-198)])
def test_normal_tail(spark, z, p):
    from rankeval.functions.stats import _normal_two_sided
    assert spark.range(1).select(_normal_two_sided(F.lit(z)).alias("p")).first().p == pytest.approx(p, rel=1e-4)
