"""Significance tests over many run pairs at once.

Input is a long table ``runs(run, query_id, value[, metric])``.  Pairs to compare are given
explicitly (a ``pairs(run_a, run_b)`` table), as every run against one baseline, or are
all pairs of runs of the same metric; x = run_a, y = run_b.  All statistics are grouped by (run_a, run_b).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.functions.signed_rank import tails
from rankeval.functions.stats import nan, welch_p_value, wilcoxon_normal_p
from rankeval.session import cut_lineage

PAIR = ("run_a", "run_b")


def baseline_pairs(runs: DataFrame, baseline: str) -> DataFrame:
    """Every other run against ``baseline`` (one pair per run)."""
    return (runs.select(F.col("run").alias("run_b")).distinct()
            .filter(F.col("run_b") != baseline)
            .select(F.lit(baseline).alias("run_a"), "run_b"))


def run_pairs(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Aligned values ``run_a, run_b, query_id, x, y`` (equi-joins on run and query).

    Where ``runs`` tells the metric, a pair of runs of different metrics is an error.
    """
    metric = ["metric"] if "metric" in runs.columns else []
    a = runs.select(F.col("run").alias("run_a"), "query_id", F.col("value").alias("x"), *[F.col(m).alias("metric_a") for m in metric])
    b = runs.select(F.col("run").alias("run_b"), "query_id", F.col("value").alias("y"), *[F.col(m).alias("metric_b") for m in metric])
    joined = pairs.select(*PAIR).join(a, "run_a").join(b, ["run_b", "query_id"])
    x = F.col("x")
    if metric:
        x = F.when(F.col("metric_a").eqNullSafe(F.col("metric_b")), x).otherwise(F.raise_error(F.concat(
            F.lit("runs of different metrics: "), "run_a", F.lit(", "), "run_b")).cast("double"))
    return joined.select(*PAIR, "query_id", x.alias("x"), "y")


def unpaired(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Queries present in only one run of a pair (reported, never silently misaligned)."""
    a = pairs.join(runs.select(F.col("run").alias("run_a"), "query_id"), "run_a")
    b = pairs.join(runs.select(F.col("run").alias("run_b"), "query_id"), "run_b")
    only_a = a.join(b, [*PAIR, "query_id"], "left_anti").withColumn("missing_in", F.lit("run_b"))
    only_b = b.join(a, [*PAIR, "query_id"], "left_anti").withColumn("missing_in", F.lit("run_a"))
    return only_a.select(*PAIR, "query_id", "missing_in").unionByName(only_b.select(*PAIR, "query_id", "missing_in"))


def welch_t(paired: DataFrame) -> DataFrame:
    """Two-sided unequal-variance two-sample t-test per pair.

    ``run_a, run_b, n, t, df, p``; p is NaN when n < 2 or both variances are 0.
    """
    s = paired.groupBy(*PAIR).agg(*[f(c).alias(f"{name}_{c}") for c in "xy" for name, f in MOMENTS.items()])
    t, dof = _welch(*[[F.col(f"{name}_{c}") for name in MOMENTS] for c in "xy"])
    return _with_welch_p(s.select(*PAIR, F.col("n_x").alias("n"), t.alias("t"), dof.alias("df")))


MOMENTS = {"n": F.count, "mean": F.avg, "var": F.var_samp}


def _welch(x: list[Column], y: list[Column]) -> tuple[Column, Column]:
    """t and its degrees of freedom from count, mean and variance of two samples."""
    (n_x, m_x, v_x), (n_y, m_y, v_y) = x, y
    a, b = v_x / n_x, v_y / n_y
    ok = (n_x >= 2) & (n_y >= 2) & (a + b > 0)
    t = F.when(ok, (m_x - m_y) / F.sqrt(a + b)).otherwise(nan())
    dof = F.when(ok, (a + b) * (a + b) / (a * a / (n_x - 1) + b * b / (n_y - 1))).otherwise(nan())
    return t, dof


def _with_welch_p(tested: DataFrame) -> DataFrame:
    return tested.withColumn("p", F.when(F.isnan("t"), nan()).otherwise(welch_p_value(F.abs(F.col("t")), F.col("df"))))


def signed_ranks(paired: DataFrame) -> DataFrame:
    """C4: rank of |y - x| within each pair, ties averaged, zero differences kept.

    Ties are handled on the grouped level: one row per (pair, |d|) carries its count
    and the number of positive differences, and a running sum over the distinct
    values gives the average rank.  A tie group holding most of the rows is one
    aggregated row, so it never concentrates in a single window partition.

    A NaN difference (a metric that is undefined for a topic) is one of the pairs and ranks above
    all numbers, but is never positive.
    """
    d = paired.withColumn("d", F.col("y") - F.col("x")).withColumn("m", F.abs("d"))
    groups = d.groupBy(*PAIR, "m").agg(F.count(F.lit(1)).alias("c"), F.sum(((F.col("d") > 0) & ~F.isnan("d")).cast("int")).alias("pos"))
    w = Window.partitionBy(*PAIR).orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = groups.withColumn("upto", F.sum("c").over(w)).withColumn(
        "avg_rank", F.col("upto") - F.col("c") + (F.col("c") + F.lit(1)) / F.lit(2.0))
    return ranked.select(*PAIR, "m", "c", "pos", "avg_rank")


def ranked_rows(paired: DataFrame) -> DataFrame:
    """C4 per query: ``run_a, run_b, query_id, d, rank``."""
    d = paired.withColumn("d", F.col("y") - F.col("x")).withColumn("m", F.abs("d"))
    return d.join(signed_ranks(paired), [*PAIR, "m"]).select(*PAIR, "query_id", "d", F.col("avg_rank").alias("rank"))


def wilcoxon(paired: DataFrame, method: str = "exact") -> DataFrame:
    """Signed-rank test per pair: ``run_a, run_b, n, w_plus, w_max, p``.

    W+ sums the ranks of positive differences; ``n`` counts all pairs, zeros and NaN
    included, and these go to W-.  ``method="normal"`` is the normal approximation with tie
    correction; it is never chosen silently.
    """
    g = signed_ranks(paired).groupBy(*PAIR).agg(
        F.sum("c").alias("n"), F.sum(F.col("pos") * F.col("avg_rank")).alias("w_plus"),
        F.sum(F.pow(F.col("c"), 3.0) - F.col("c")).alias("ties"))
    return signed_rank_p(g, method).select(*PAIR, "n", "w_plus", "w_max", "p")


def signed_rank_p(sums: DataFrame, method: str = "exact") -> DataFrame:
    """``w_max`` and ``p`` for rows with n, w_plus and ties.

    The exact null distribution depends on ``n`` only: one table is computed per distinct ``n`` (``signed_rank.tails``)
    and looked up by all rows, which are pinned first, since both need them.
    """
    if method not in ("exact", "normal"):
        raise ValueError(f"unknown method {method!r}")
    total = F.col("n") * (F.col("n") + 1) / F.lit(2.0)
    stats = sums.withColumn("w_max", F.greatest(F.col("w_plus"), total - F.col("w_plus")))
    if method == "normal":
        return stats.withColumn("p", wilcoxon_normal_p(F.col("w_max"), F.col("n"), F.col("ties")))
    stats = cut_lineage(stats.withColumn("n", F.col("n").cast("long")))
    return stats.join(tails(stats), ["n", "w_max"], "left").withColumn("p", F.lit(2.0) * F.col("tail")).drop("tail")


def wilcoxon_exact(paired: DataFrame) -> DataFrame:
    """C3 by the exact null distribution."""
    return wilcoxon(paired, "exact")


def decide(tested: DataFrame, alpha: float) -> DataFrame:
    """``rejected`` when p < alpha, else ``accepted`` (NaN is accepted)."""
    reject = ~F.isnan("p") & (F.col("p") < F.lit(float(alpha)))
    return tested.withColumn("decision", F.when(reject, "rejected").otherwise("accepted"))


def compare(runs: DataFrame, test: str = "t", alpha: float = 0.05, pairs: DataFrame | None = None,
            baseline: str | None = None, method: str = "exact") -> DataFrame:
    """Compare runs pairwise; ``test="t"`` is Welch's t-test, anything else the Wilcoxon test (by ``method``)."""
    if pairs is None:
        if baseline is None:
            raise ValueError("give pairs or a baseline run")
        pairs = baseline_pairs(runs, baseline)
    paired = run_pairs(runs, pairs)
    if test == "t":
        res = welch_t(paired).select(*PAIR, "n", F.col("t").alias("statistic"), "p")
        name = "t"
    else:
        res = wilcoxon(paired, method).select(*PAIR, "n", F.col("w_max").alias("statistic"), "p")
        name = "wilcoxon"
    return decide(res.withColumn("test", F.lit(name)), alpha)


# ---- all pairs of runs ----

#: Runs of a tile: pairs are formed tile by tile, so a run's values travel once per tile, not once per run.
TILE = 64


def _tiled(per_run: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """The rows of runs in the first and in the second role of every pair (i, j) of tiles, i <= j."""
    runs = per_run.count()
    n = max(1, -(-runs // tile))
    own = per_run.withColumn("tile", F.pmod(F.xxhash64("run"), F.lit(n)).cast("int"))
    first = own.select("*", F.col("tile").alias("i"), F.explode(F.sequence(F.col("tile"), F.lit(n - 1))).alias("j"))
    second = own.select("*", F.explode(F.sequence(F.lit(0), F.col("tile"))).alias("i"), F.col("tile").alias("j"))
    return first.drop("tile"), second.drop("tile")


def _with_metric(runs: DataFrame) -> DataFrame:
    return runs if "metric" in runs.columns else runs.withColumn("metric", F.lit(""))


def all_pairs_t(runs: DataFrame, tile: int = TILE) -> DataFrame:
    """C2 for all runs ``run_a < run_b`` of a metric: ``metric, run_a, run_b, n_a, n_b, t, df, p``.

    The test is unpaired: count, mean and variance of each run's own values are all it needs, so no
    topic is joined.
    """
    moments = cut_lineage(_with_metric(runs).groupBy("metric", "run").agg(*[f("value").alias(name) for name, f in MOMENTS.items()]))
    first, second = ([F.struct("run", *MOMENTS).alias(c)] for c in "xy")
    one, two = _tiled(moments, tile)
    keys = ["metric", "i", "j"]
    joined = one.select(*keys, *first).join(two.select(*keys, *second), keys).filter("i < j or x.run < y.run")
    a, b = F.when(F.col("x.run") < F.col("y.run"), F.col("x")).otherwise(F.col("y")), F.when(
        F.col("x.run") < F.col("y.run"), F.col("y")).otherwise(F.col("x"))
    pairs = joined.select("metric", a.alias("a"), b.alias("b"))
    t, dof = _welch(*[[F.col(f"{c}.{name}") for name in MOMENTS] for c in "ab"])
    return _with_welch_p(pairs.select("metric", F.col("a.run").alias("run_a"), F.col("b.run").alias("run_b"),
                                      F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"), t.alias("t"), dof.alias("df")))


def _rank_sums(d: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of differences: sum of the average ranks (by absolute value, NaN last) of the positive ones, and c^3 - c
    summed over groups of equal absolute values."""
    rows, width = d.shape
    if not width:
        return np.zeros(rows), np.zeros(rows)
    m = np.abs(d)
    order = np.argsort(m, axis=1, kind="stable")
    m = np.take_along_axis(m, order, 1)
    new = np.ones(m.shape, bool)
    new[:, 1:] = (m[:, 1:] != m[:, :-1]) & ~(np.isnan(m[:, 1:]) & np.isnan(m[:, :-1]))
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, m.size])
    rank = np.repeat(start % width + (size + 1) / 2, size).reshape(m.shape)
    ties = np.bincount(start // width, weights=size.astype(float) ** 3 - size, minlength=rows)
    return (rank * np.take_along_axis(positive, order, 1)).sum(1), ties


def _tile_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """All pairs of a tile's runs with another's (or its own): matched topics, unmatched ones, rank sums."""
    types = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.float64()] * 2
    names_ = ["metric", *PAIR, "only_a", "only_b", "n", "w_plus", "ties"]
    if not left.num_rows or not right.num_rows:  # a tile that no run fell into
        return pa.Table.from_arrays([pa.array([], t) for t in types], names_)
    topics = np.unique(np.concatenate([t.column("topics").combine_chunks().flatten().to_numpy(zero_copy_only=False) for t in (left, right)]))

    def dense(table: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
        values, there = np.full((table.num_rows, len(topics)), np.nan), np.zeros((table.num_rows, len(topics)), bool)
        for k, (ids, own) in enumerate(zip(table.column("topics").to_pylist(), table.column("values").to_pylist())):
            at = np.searchsorted(topics, ids)
            values[k, at], there[k, at] = [np.nan if v is None else v for v in own], True
        return table.column("run").to_pylist(), values, there

    names, x, here = dense(left)
    others, y, there = dense(right)
    same = left.column("i")[0].as_py() == left.column("j")[0].as_py()
    out: list[tuple] = []
    for k, name in enumerate(names):
        pick = np.array([not same or name < o for o in others], bool)
        if not pick.any():
            continue
        swap = np.array([name > o for o in others])[pick]
        both = there[pick] & here[k]
        d = np.where(swap[:, None], x[k] - y[pick], y[pick] - x[k])
        if both.all():
            sums, ties = _rank_sums(d, d > 0)
        else:
            each = [_rank_sums(r[None, b], r[None, b] > 0) for r, b in zip(d, both)]
            sums, ties = (np.array([e[i][0] for e in each]) for i in (0, 1))
        n, only_x, only_y = both.sum(1), (here[k] & ~there[pick]).sum(1), (there[pick] & ~here[k]).sum(1)
        for i, (o, s) in enumerate(zip(np.array(others, object)[pick], swap)):
            pair = (o, name, only_y[i], only_x[i]) if s else (name, o, only_x[i], only_y[i])
            out.append((*pair, n[i], sums[i], ties[i]))
    metric = left.column("metric")[0].as_py()
    columns = list(zip(*[(metric, *row) for row in out])) or [()] * len(types)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names_)


def all_pairs_ranks(runs: DataFrame, tile: int = TILE) -> DataFrame:
    """C4 for all runs ``run_a < run_b`` of a metric: ``metric, run_a, run_b, only_a, only_b, n, w_plus, ties``.

    ``n`` counts the topics of both runs; ``only_a`` and ``only_b`` report those of one alone.  Two tiles of
    runs at a time, as matrices of runs by topics.
    """
    values = _with_metric(runs).groupBy("metric", "run").agg(
        F.sort_array(F.collect_list(F.struct(F.col("query_id").cast("long").alias("q"), F.col("value").cast("double").alias("v")))).alias("own"))
    per_run = cut_lineage(values.select("metric", "run", F.col("own.q").alias("topics"), F.col("own.v").alias("values")))
    one, two = _tiled(per_run, tile)
    keys = ["metric", "i", "j"]
    ddl = "metric string, run_a string, run_b string, only_a long, only_b long, n long, w_plus double, ties double"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _tile_pairs(left, right)

    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(run, ddl)


def compare_all(runs: DataFrame, alpha: float = 0.05, method: str = "exact", tile: int = TILE) -> DataFrame:
    """C1-C5 for all pairs of runs of the same metric: ``metric, run_a, run_b, test, n, only_a, only_b, statistic, p,
    decision``; ``n`` counts the topics that both runs have (as does the signed-rank test; Welch's test takes each run's own)."""
    ranks = cut_lineage(all_pairs_ranks(runs, tile))
    keys = ["metric", *PAIR]
    counted = [*keys, "n", "only_a", "only_b"]
    t = all_pairs_t(runs, tile).join(ranks.select(*counted), keys).select(
        *counted, F.lit("t").alias("test"), F.col("t").alias("statistic"), "p")
    w = signed_rank_p(ranks, method).select(*counted, F.lit("wilcoxon").alias("test"), F.col("w_max").alias("statistic"), "p")
    return decide(t.unionByName(w), alpha)
