"""Report sinks (S8-S11, with P4/P7 rendering).

Every report goes to its own directory (``mode`` defaults to ``errorifexists``), so
a re-run never appends a second header to an earlier file.  Rows are ordered over the
part files (tasks write ranges of topics side by side; a small report is one file);
``single_file=True`` asks for exactly one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankeval.functions.text import query_echo, tokens
from rankeval.operators.evaluate import METRICS, mean_nonzero, with_mean_row
from rankeval.session import cut_lineage

METRIC_HEADERS = {"rr": "RR", "ap": "AP@N", "p": "P@N", "recall": "Recall@N"}


def _ordered(df: DataFrame, order, single_file: bool) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered.coalesce(1) if single_file else ordered


def write_metrics_csv(metrics: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """``Query,RR,AP@N,P@N,Recall@N,Cut`` per topic, then the ``-`` row of non-zero means."""
    rows = with_mean_row(metrics).withColumn("_last", (F.col("query") == "-").cast("int")).withColumn(
        "_q", F.expr("try_cast(query AS BIGINT)"))
    out = _ordered(rows, ["_last", "_q"], single_file).select(
        F.col("query").alias("Query"), *[F.col(m).alias(METRIC_HEADERS[m]) for m in METRICS], F.col("cut").alias("Cut"))
    out.write.mode(mode).option("header", True).csv(path)


def write_sweep_csv(wide: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """Wide training table ``Metrica,Query,Cut,<grid values...>`` plus the mean row."""
    labels = [c for c in wide.columns if c not in ("metric", "query", "cut")]
    rows = wide.withColumn("_last", (F.col("query") == "-").cast("int")).withColumn(
        "_q", F.expr("try_cast(query AS BIGINT)"))
    out = _ordered(rows, ["_last", "_q"], single_file).select(
        F.col("metric").alias("Metrica"), F.col("query").alias("Query"), F.col("cut").alias("Cut"),
        *[F.col(f"`{l}`") for l in labels])
    out.write.mode(mode).option("header", True).csv(path)


def _fmt(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def write_test_csv(best: DataFrame, test_values: DataFrame, metric: str, path: str,
                   mode: str = "errorifexists", single_file: bool = False) -> None:
    """Line 1 ``<best>,<metric>``; then ``<query>,<value>``; then ``-,<non-zero mean>``."""
    test_values = cut_lineage(test_values)  # the lines and their mean are of one search
    head = best.select(F.lit(0).alias("_part"), F.lit(None).cast("bigint").alias("_q"),
                       F.concat_ws(",", _fmt("param"), F.lit(metric)).alias("value"))
    body = test_values.select(F.lit(1).alias("_part"), F.col("query_id").cast("bigint").alias("_q"),
                              F.concat_ws(",", _fmt("query_id"), _fmt("value")).alias("value"))
    mean = test_values.agg(mean_nonzero_value()).select(
        F.lit(2).alias("_part"), F.lit(None).cast("bigint").alias("_q"),
        F.concat_ws(",", F.lit("-"), _fmt(F.col("m"))).alias("value"))
    lines = head.unionByName(body).unionByName(mean)
    _ordered(lines, ["_part", "_q"], single_file).select("value").write.mode(mode).text(path)


def mean_nonzero_value():
    v = F.col("value")
    return F.coalesce(F.avg(F.when(~F.isnan(v) & (v > 0), v)), F.lit(float("nan"))).alias("m")


def hits_report(topics: DataFrame, shown_hits: DataFrame, metrics: DataFrame, field: str = "text") -> DataFrame:
    """S9, one row per line of the report: per topic the query, its parsed echo, the shown hits (stored fields, score,
    relevant Yes/No) and the metrics; then the overall means.

    Columns ``part`` (0 topics, 1 means), ``topic``, ``place`` (0 the topic's head, its hits by rank, then its metrics),
    ``line`` and ``value``; the first four order the report.  No topic's hits are gathered in one row or task.
    ``shown_hits`` has ``query_id, rank, id, title, text, url, pubmedId, score, rel``.
    """
    def lines(df: DataFrame, part: int, topic, place, *values) -> DataFrame:
        return df.select(F.lit(part).alias("part"), topic.cast("bigint").alias("topic"), place.cast("bigint").alias("place"),
                         F.posexplode(F.array(*values)).alias("line", "value"))

    def stored(label: str, c: str) -> F.Column:
        return F.concat(F.lit(label), F.coalesce(_fmt(c), F.lit("null")))

    topic, none = F.col("query_id"), F.lit("")
    # The labels of the report's layout.
    head = lines(topics, 0, topic, F.lit(0), F.lit("-" * 71), none, F.concat(F.lit("Query: "), F.col("query")),
                 F.concat(F.lit("Parsed query: "), query_echo(tokens(F.col("query")), field)), none)
    hits = lines(shown_hits, 0, topic, F.col("rank"), stored("Document with id: ", "id"), stored("Title: ", "title"),
                 stored("Text: ", "text"), stored("Url: ", "url"), stored("PubmedId: ", "pubmedId"),
                 F.concat(F.lit("Score: "), _fmt("score")),
                 F.concat(F.lit("Relevant: "), F.when(F.col("rel"), "Yes").otherwise("No")), none)
    last = F.lit((1 << 62))
    figures = lines(metrics, 0, topic, last, F.concat(
        F.lit("Metrics = {RR="), _fmt("rr"), F.lit(", AP@N="), _fmt("ap"), F.lit(", P@N="), _fmt("p"), F.lit(", Recall@N="),
        _fmt("recall"), F.lit("}")), none)
    means = lines(mean_nonzero(metrics), 1, F.lit(None), F.lit(0), *[
        F.concat(F.lit(label), _fmt(c)) for label, c in (("MRR: ", "rr"), ("M@P: ", "ap"), ("Recall@N: ", "recall"), ("P@N: ", "p"))])
    return head.unionByName(hits).unionByName(figures).unionByName(means)


def write_hits_report(report: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """The lines in order over the part files (ranges of topics, ranks and lines side by side)."""
    _ordered(report, ["part", "topic", "place", "line"], single_file).select(F.coalesce("value", F.lit("")).alias("value")).write.mode(
        mode).text(path)
