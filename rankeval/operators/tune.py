"""Parameter tuning (F4, T1-T7): sweep a grid on training topics, pick the best
value, apply it to test topics.

The whole grid is one job: every grid value is a column of the same scoring
aggregation (see ``search.candidates``), then ranked and judged per
(model, param, query).  There is no loop over grid values and no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankeval.operators.evaluate import (
    METRIC_NAMES, hits_bounded, judge, nonzero_mean, per_query_metrics,
)
from rankeval.operators.models import BM25, JM
from rankeval.operators.search import candidates, match_ranges, query_terms, search, select_queries, top_k
from rankeval.session import cut_lineage

# The two parameter grids (intended decimals, not accumulated floats).
LAMBDA_GRID = (0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
K1_GRID = (0.4, 0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0)


def default_grid(model) -> tuple[float, ...]:
    return K1_GRID if model.name == "bm25" else LAMBDA_GRID


def _model(model):
    if isinstance(model, str):
        return {"bm25": BM25(), "jm": JM()}[model]
    return model


def sweep(index, topics: DataFrame, qrels: DataFrame, models=("jm",), grids=None, cut: int = 10,
          precision: str = "float", field: str = "text", length: str = "norm") -> DataFrame:
    """Per (model, param, query) metrics for every grid value, all models in one job.

    Returns ``model, param, query_id, rr, ap, p, recall, cut``.  ``precision="float"``
    reproduces the single-precision accumulation of the reference's tuning program.
    The rows (topics x values) are pinned: means, tables and comparisons read them several
    times, and none of them may search again.
    """
    ms = [_model(m) for m in models]
    gs = grids or [default_grid(m) for m in ms]
    scorers = list(zip(ms, gs))
    runs = sum(len(g) for g in gs)
    small = hits_bounded(topics, cut, runs, field)
    hits = search(index, topics, scorers, cut, field, length, broadcast_ok=small or None)
    judged = judge(hits, index.docs, qrels, small)
    params = F.array(*[
        F.struct(F.lit(m.name).alias("model"), F.lit(float(p)).alias("param"))
        for m, g in scorers for p in g
    ])
    return cut_lineage(per_query_metrics(judged, topics, qrels, cut, keys=("model", "param"), params=params,
                                         precision=precision))


def sweep_means(swept: DataFrame, metric: str | None = None) -> DataFrame:
    """T4: non-zero mean of each metric per (model, param); long form ``model, metric, param, mean``."""
    names = [metric] if metric else list(METRIC_NAMES)
    means = swept.groupBy("model", "param").agg(*[nonzero_mean(METRIC_NAMES[n]).alias(n) for n in names])
    return means.unpivot(["model", "param"], names, "metric", "mean")


def best_param(means: DataFrame) -> DataFrame:
    """T5: per (model, metric) the parameter with the highest mean.

    Strictly greater from 0: NaN and non-positive means never win; on equal means
    the smallest parameter wins.  A (model, metric) with no candidate has no row.
    """
    ok = means.filter(~F.isnan("mean") & (F.col("mean") > 0))
    return ok.groupBy("model", "metric").agg(
        F.min_by(F.struct("param", "mean"), F.struct(-F.col("mean"), F.col("param"))).alias("best")
    ).select("model", "metric", F.col("best.param").alias("param"), F.col("best.mean").alias("mean"))


def sweep_wide(swept: DataFrame, metric: str, grid) -> DataFrame:
    """Query x parameter table of one metric plus the ``-`` row of means.

    Columns are the grid values in order (as text labels); ``query`` is text.
    """
    col = METRIC_NAMES[metric]
    labels = [str(g) for g in grid]
    cols = [F.col(f"`{l}`") for l in labels]
    long = swept.select("query_id", F.col("param").cast("string").alias("label"), F.col(col).alias("v"), "cut")
    body = (long.groupBy(F.col("query_id").cast("string").alias("query"), "cut")
            .pivot("label", labels).agg(F.first("v")))
    means = (long.groupBy("label").agg(nonzero_mean("v").alias("v"), F.max("cut").alias("cut"))
             .groupBy("cut").pivot("label", labels).agg(F.first("v"))
             .select(F.lit("-").alias("query"), "cut", *cols))
    return body.select(F.lit(metric).alias("metric"), "query", "cut", *cols).unionByName(
        means.select(F.lit(metric).alias("metric"), "query", "cut", *cols))


def train_test(index, topics: DataFrame, qrels: DataFrame, model, train, test, metric: str = "MAP",
               cut: int = 10, grid=None, precision: str = "float", field: str = "text",
               length: str = "norm") -> dict[str, DataFrame]:
    """F4 + T3-T7 + T6: tune on ``train`` topics, evaluate the best value on ``test``.

    The best value stays a one-row DataFrame; the test run reads it as a scalar
    subquery inside the scoring expression, so nothing returns to the driver.  When
    no value has a positive mean the test run raises an error.
    """
    m = _model(model)
    g = tuple(grid or default_grid(m))
    train_topics = select_queries(topics, train)
    test_topics = select_queries(topics, test)
    swept = sweep(index, train_topics, qrels, [m], [g], cut, precision, field, length)
    means = sweep_means(swept, metric)
    best = best_param(means)
    param = best.select("param").scalar()
    guarded = F.coalesce(param, F.raise_error(F.lit("no parameter value with a positive mean")).cast("double"))
    qterms = query_terms(test_topics, field)
    cols = [(m.name, 0.0, m.term_score(guarded, length=length))]
    small = hits_bounded(test_topics, cut, 1, field)
    hits = top_k(candidates(index, match_ranges(index, qterms, field, broadcast_ok=small or None), cols), cut).select(
        "query_id", "rank", "ord", "score")
    judged = judge(hits, index.docs, qrels, small)
    test_metrics = per_query_metrics(judged, test_topics, qrels, cut, precision=precision)
    test_values = test_metrics.select("query_id", F.col(METRIC_NAMES[metric]).alias("value"))
    test_mean = test_values.agg(nonzero_mean("value").alias("mean"))
    return {
        "sweep": swept,
        "means": means,
        "best": best,
        "wide": sweep_wide(swept, metric, g),
        "test": test_values,
        "test_mean": test_mean,
    }
