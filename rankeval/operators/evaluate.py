"""Judging and evaluation.

Metrics follow the reference's definitions exactly:

* RR      1 / rank of the first relevant hit within the cut, else 0
* AP      sum of precision at each relevant hit / number of relevant hits *found*; 0 if none
* P       relevant hits / hits returned (NaN with no hits)
* Recall  relevant hits / judged-relevant documents (NaN when the query has none)
* a topic whose text analyses to no term (a failed parse) gets 0 everywhere
* means use only values > 0 (NaN never counts); NaN if none qualifies
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.functions.stats import nan, safe_div
from rankeval.functions.text import tokens
from rankeval.operators.search import look_up, query_terms, search
from rankeval.session import bounded

METRICS = ("rr", "ap", "p", "recall")
METRIC_NAMES = {"MRR": "rr", "MAP": "ap", "P": "p", "R": "recall"}  # P6 selector names
MAX_BROADCAST_HITS = 500_000  # rows of a few numbers: under 32 MB


def positive_qrels(qrels: DataFrame) -> DataFrame:
    """judged-relevant pairs (grade > 0), duplicates collapsed."""
    return qrels.filter(F.col("score") > 0).select("query_id", "doc_id").distinct()


def relevant_per_query(qrels: DataFrame) -> DataFrame:
    """Number of judged-relevant documents per query."""
    return positive_qrels(qrels).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))


def judge(hits: DataFrame, docs: DataFrame, qrels: DataFrame, broadcast_hits: bool = False) -> DataFrame:
    """J7 (id only) + J8: attach the external id, the judged grade (null: not judged; the highest of
    repeated judgments) and the relevance flag (grade > 0) to every hit.

    ``broadcast_hits`` must only be set with a proof that hits are small (``hits_bounded``).  Only two
    columns of the document table are read, and of a saved index only the hits' slots (``look_up``).
    """
    with_id = look_up(docs, hits, ["id"], broadcast_hits)
    grades = qrels.groupBy("query_id", F.col("doc_id").alias("id")).agg(F.max("score").alias("grade"))
    return with_id.join(grades, ["query_id", "id"], "left").withColumn("rel", F.coalesce(F.col("grade") > 0, F.lit(False)))


def precision_at_rank(judged: DataFrame, keys=()) -> DataFrame:
    """Running relevant count and precision at every rank."""
    w = (Window.partitionBy(*keys, "query_id").orderBy("rank")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (judged.withColumn("rel_so_far", F.sum(F.col("rel").cast("int")).over(w))
            .withColumn("precision", F.col("rel_so_far") / F.col("rank")))


def _float(c):
    return c.cast("float")


def per_query_metrics(judged: DataFrame, topics: DataFrame, qrels: DataFrame, cut: int,
                      keys=(), params: DataFrame | None = None, precision: str = "double",
                      undefined: str = "nan") -> DataFrame:
    """E2-E6 (and E9 with ``precision="float"``): one row per selected topic.

    ``undefined``: what P without hits and recall without judgments are, ``nan`` or ``zero``.

    ``keys`` are extra run keys (e.g. ``model, param``); ``params`` then lists the run
    key values so that topics without hits still get a row for every run.
    """
    if undefined not in ("nan", "zero"):
        raise ValueError(f"unknown value for undefined metrics {undefined!r}")
    keys = list(keys)
    ranked = precision_at_rank(judged, keys)
    rel = F.col("rel")
    if precision == "float":
        # Single-precision accumulation, in rank order, like the tuning program.
        prec = _float(F.col("rel_so_far") / F.col("rank"))
        agg = ranked.groupBy(*keys, "query_id").agg(
            F.count(F.lit(1)).alias("n_hits"),
            F.sum(rel.cast("int")).alias("n_rel"),
            F.min(F.when(rel, F.col("rank"))).alias("first_rel"),
            F.array_sort(F.collect_list(F.when(rel, F.struct("rank", prec.alias("prec"))))).alias("precs"),
        ).withColumn(
            "ap_sum",
            F.aggregate(F.col("precs"), F.lit(0.0).cast("float"), lambda acc, s: _float(acc + s["prec"])),
        )
    else:
        agg = ranked.groupBy(*keys, "query_id").agg(
            F.count(F.lit(1)).alias("n_hits"),
            F.sum(rel.cast("int")).alias("n_rel"),
            F.min(F.when(rel, F.col("rank"))).alias("first_rel"),
            F.sum(F.when(rel, F.col("precision"))).alias("ap_sum"),
        )
    base = topics.select("query_id", (F.size(tokens(F.col("query"))) == 0).alias("parse_failed"))
    if params is not None:
        base = base.select("*", F.inline(params))
    rows = (base.join(agg, [*keys, "query_id"], "left")
            .join(relevant_per_query(qrels), "query_id", "left"))
    n_rel = F.coalesce(F.col("n_rel"), F.lit(0))
    n_rel_judged = F.coalesce(F.col("n_relevant"), F.lit(0))
    if precision == "float":
        rr = F.when(F.col("first_rel").isNotNull(), _float(F.lit(1.0) / F.col("first_rel"))).otherwise(0.0)
        ap = F.when(n_rel > 0, _float(F.col("ap_sum") / n_rel)).otherwise(0.0)
        p = F.when(F.coalesce(F.col("n_hits"), F.lit(0)) > 0, _float(n_rel / F.col("n_hits"))).otherwise(nan())
        recall = F.when(n_rel_judged > 0, _float(n_rel / n_rel_judged)).otherwise(nan())
    else:
        rr = F.when(F.col("first_rel").isNotNull(), F.lit(1.0) / F.col("first_rel")).otherwise(0.0)
        ap = F.when(n_rel > 0, F.col("ap_sum") / n_rel).otherwise(0.0)
        p = safe_div(n_rel, F.coalesce(F.col("n_hits"), F.lit(0)))
        recall = safe_div(n_rel, n_rel_judged)
    if undefined == "zero":
        p, recall = (F.when(F.isnan(c), 0.0).otherwise(c) for c in (p, recall))
    failed = F.col("parse_failed")
    out = [
        F.when(failed, 0.0).otherwise(rr).cast("double").alias("rr"),
        F.when(failed, 0.0).otherwise(ap).cast("double").alias("ap"),
        F.when(failed, 0.0).otherwise(p).cast("double").alias("p"),
        F.when(failed, 0.0).otherwise(recall).cast("double").alias("recall"),
    ]
    return rows.select(*keys, "query_id", *out, F.lit(cut).alias("cut"))


def nonzero_mean(c: str):
    """E7 aggregate: mean of the values > 0 (NaN never counts), NaN when none."""
    v = F.col(c)
    return F.coalesce(F.avg(F.when(~F.isnan(v) & (v > 0), v)), nan())


def mean_nonzero(metrics: DataFrame, keys=()) -> DataFrame:
    """One row per run with the non-zero means of all four metrics."""
    return metrics.groupBy(*keys).agg(*[nonzero_mean(m).alias(m) for m in METRICS], F.max("cut").alias("cut"))


def with_mean_row(metrics: DataFrame) -> DataFrame:
    """Per-query rows (query id as text) followed by the ``-`` mean row."""
    body = metrics.select(F.col("query_id").cast("string").alias("query"), *METRICS, "cut")
    means = mean_nonzero(metrics).select(F.lit("-").alias("query"), *METRICS, "cut")
    return body.unionByName(means)


def select_metric(metrics: DataFrame, name: str, keys=()) -> DataFrame:
    """Pick one metric by its command-line name (MRR, MAP, P, R; case-sensitive)."""
    if name not in METRIC_NAMES:
        raise ValueError(f"unknown metric {name!r}")
    return metrics.select(*keys, "query_id", F.lit(name).alias("metric"), F.col(METRIC_NAMES[name]).alias("value"))


def metrics_long(metrics: DataFrame, keys=()) -> DataFrame:
    """P6, all four at once: (keys, query_id, metric, value)."""
    return metrics.unpivot([*keys, "query_id"], list(METRICS), "metric", "value")


def hits_bounded(topics: DataFrame, cut: int, runs: int = 1, field: str = "text") -> bool:
    """Proof that hits fit a broadcast: (query-term rows) x cut x runs <= MAX_BROADCAST_HITS.

    Only topics with at least one term have hits, so query-term rows bound the number
    of topics with hits; the same proof also covers broadcasting the query terms.
    """
    return bounded(query_terms(topics, field), max(MAX_BROADCAST_HITS // (max(cut, 1) * max(runs, 1)), 1))


def evaluate(index, topics: DataFrame, qrels: DataFrame, model, cut: int = 10,
             precision: str = "double", field: str = "text", length: str = "norm",
             undefined: str = "nan") -> DataFrame:
    """Search + judge + per-query metrics for one model: ``query_id, rr, ap, p, recall, cut``.

    ``length="norm"`` scores with the one-byte length norm (library-like), ``"dl"``
    with exact document lengths.  A ``cut`` of 0 asks for no hits: like a failed parse, every metric is 0.
    """
    if cut == 0:
        return topics.select("query_id", *[F.lit(0.0).alias(m) for m in METRICS], F.lit(0).alias("cut"))
    small = hits_bounded(topics, cut, 1, field)
    hits = search(index, topics, model, cut, field, length, broadcast_ok=small or None)
    judged = judge(hits, index.docs, qrels, small)
    return per_query_metrics(judged, topics, qrels, cut, precision=precision, undefined=undefined)
