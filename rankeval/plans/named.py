"""Named queries: one per operator of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the generated tables (documents, benchmark) through the derived
test collection in ``rankeval.sources.fixtures``; nothing runs on made-up input.
Doubles that come out of multi-row sums are rounded to 9 decimals, and scores are in
single precision, so the report is stable under summation order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankeval.functions.text import query_echo, tokens
from rankeval.operators import compare as C
from rankeval.operators import evaluate as E
from rankeval.operators import index as I
from rankeval.operators import saved
from rankeval.operators import search as S
from rankeval.operators import tune as T
from rankeval.operators.models import BM25, JM
from rankeval.session import checkpoint_dir, cut_lineage
from rankeval.sources import fixtures as fx
from rankeval.sources import readers as R
from rankeval.sources import writers as W

# Fixed run settings of the named queries (the reference's published runs).
BM25_K1 = 0.4
JM_LAMBDA = 0.2
CUT = 10
TOP = 5
ONE_QUERY = 7
QUERY_RANGE = "1-20"
ALPHA = 0.05
RUNS = ((BM25(), (0.4, 1.2, 2.0)), (JM(), (0.1, 0.5)))
RECALL_RUNS = ("bm250.4", "jm0.5")
BASELINE_RUN = "bm25:0.4"
R9 = 9


def _r(c, d=R9):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


class Collection:
    """The derived test collection of one scale-factor directory, saved once per
    application (bucketed, term-partitioned index and judgments in the checkpoint
    folder) and read back by every query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.index, self.topics, self.qrels = fx.saved_collection(spark, sf_dir)


def _metrics_out(m: DataFrame, keys=()) -> DataFrame:
    return m.select(*keys, F.col("query_id").cast("bigint").alias("query_id"),
                    *[_r(c).alias(c) for c in E.METRICS], F.col("cut").cast("bigint").alias("cut"))


# --- sources, projections, analysis ------------------------------------------------

def _scratch(spark, name: str) -> str:
    """A new path in the shared folder for a file round trip."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rankeval-{name}-{uuid.uuid4().hex}"


def docs_flatten(spark, sf):
    """S1 + P1: the corpus written as nested JSON lines, read and flattened."""
    path = _scratch(spark, "corpus")
    fx.nested_corpus(spark, sf).write.json(path)
    return I.flatten_articles(R.read_corpus(spark, path))


def topics_file(spark, sf):
    """Topics written as JSON lines with their ids as strings, read back."""
    path = _scratch(spark, "topics")
    fx.topics(spark, sf).select(
        F.col("query_id").cast("string").alias("_id"), F.lit("").alias("text"),
        F.struct(F.col("query").alias("query"), F.lit("").alias("narrative")).alias("metadata")).write.json(path)
    return R.read_topics(spark, path).select(F.col("query_id").cast("bigint").alias("query_id"), "query")


def qrels_file(spark, sf):
    """S3 + F6: judgments as tab-separated lines, some with empty fields at the end, some too short to count."""
    path = _scratch(spark, "qrels")
    c = Collection(spark, sf)
    line = F.concat_ws("\t", "query_id", "doc_id", "score")
    lines = c.qrels.select(F.explode(F.array(
        F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(line, F.lit("\t"))).otherwise(line),
        F.when(F.pmod("doc_id", F.lit(3)) == 0, F.concat_ws("\t", "query_id", "doc_id", F.lit(""))).otherwise("")))
        .alias("query-id\tcorpus-id\tscore"))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0002").csv(path)
    return R.read_qrels(spark, path).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("score").cast("bigint").alias("score"))


def metrics_file(spark, sf):
    """The per-topic report, read back."""
    path = _scratch(spark, "metrics")
    W.write_metrics_csv(_metrics(spark, sf, BM25(BM25_K1)), path)
    back = spark.read.option("header", True).schema("query string, rr double, ap double, p double, recall double, cut long").csv(path)
    return back.select("query", *[_r(c).alias(c) for c in E.METRICS], "cut")


def hits_file(spark, sf):
    """The hits report; every line that comes back, with how often it occurs (numbers in millionths)."""
    path = _scratch(spark, "hits")
    c = Collection(spark, sf)
    small = E.hits_bounded(c.topics, CUT)
    h = S.search(c.index, c.topics, BM25(BM25_K1), CUT, broadcast_ok=small or None)
    j = cut_lineage(E.judge(h, c.index.docs, c.qrels, small))  # for the metrics and for the shown hits
    metrics = E.per_query_metrics(j, c.topics, c.qrels, CUT)
    shown = S.fetch_hits(j.select("query_id", "rank", "ord", "score", "rel"), c.index.docs, TOP, broadcast_ok=small)
    W.write_hits_report(W.hits_report(c.topics, shown, metrics), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    numbers = F.regexp_extract_all("value", F.lit(r"([0-9.E-]+|NaN)(?=[,}]|$)"), 1)
    millionths = F.transform(numbers, _millionths)
    figures = F.col("value").rlike(r"^(Score: |Metrics = \{RR=|MRR: |M@P: |Recall@N: |P@N: )")
    value = F.when(figures, F.concat_ws(" ", F.regexp_extract("value", r"^[^:=]*", 0), F.array_join(millionths, " "))).otherwise(F.col("value"))
    return lines.select(value.alias("value")).groupBy("value").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def _millionths(x):
    number = x.try_cast("double")
    return F.when(F.isnan(number), "NaN").otherwise(F.round(number * 1e6).cast("bigint").cast("string"))


def sweep_file(spark, sf):
    """The training table, read back."""
    path = _scratch(spark, "sweep")
    W.write_sweep_csv(T.sweep_wide(_sweep(spark, sf, JM()), "MAP", T.LAMBDA_GRID), path)
    labels = [str(g) for g in T.LAMBDA_GRID]
    columns = ", ".join(f"`{x}` double" for x in labels)
    back = spark.read.option("header", True).schema(f"metric string, query string, cut long, {columns}").csv(path)
    return back.select("metric", "query", "cut", *[_r(F.col(f"`{x}`")).alias(x) for x in labels])


def test_file(spark, sf):
    """S11 + S12: the test report, read back as a run."""
    path = _scratch(spark, "test")
    c = Collection(spark, sf)
    train, test = fx.train_test_ranges(spark, sf)
    out = T.train_test(c.index, c.topics, c.qrels, JM(), train, test, "MAP", CUT)
    W.write_test_csv(out["best"], out["test"], "MAP", path)
    return R.read_result_values(spark, path, "jm").select("run", "query_id", "metric", _r("value").alias("value"))


def _appended(spark, sf) -> I.Index:
    """Created, then appended to in the same mode."""
    path = _scratch(spark, "index")
    saved.index_corpus(fx.corpus(spark, sf), path)
    saved.index_corpus(fx.upsert_batch(spark, sf), path)
    return saved.load_index(spark, path)


def append_docs(spark, sf):
    docs = _appended(spark, sf).docs
    return docs.select(F.col("id").cast("bigint").alias("id"), "title", "url", "pubmedId",
                       F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def append_terms(spark, sf):
    t = _appended(spark, sf).terms.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")
    return t.select("field", "term", F.col("df").cast("bigint").alias("df"), F.col("cf").cast("bigint").alias("cf"))


def append_stats(spark, sf):
    s = _appended(spark, sf).stats
    return s.select("field", F.col("n_docs").cast("bigint").alias("n_docs"),
                    F.col("n_tokens").cast("bigint").alias("n_tokens"), _r("avgdl").alias("avgdl"))


def append_search(spark, sf):
    """J1-J5 over an index of two batches."""
    return _hits_out(S.search(_appended(spark, sf), fx.topics(spark, sf), BM25(BM25_K1), CUT)).drop("ord")


def tokenize(spark, sf):
    c = fx.corpus(spark, sf)
    t = tokens(F.col("text"))
    return c.select(F.col("ord").cast("bigint").alias("ord"), F.size(t).cast("bigint").alias("dl"),
                    F.array_join(t, " ").alias("terms"))


#: One word or break of every class of the analyser around a document's own fields: %n its number, %c its length, %l its
#: language, %s its source.
CLASS_SAMPLE = ('%l·%s %l:%s %l..%s %n;%c %n,%c %n·%c v%n.%c_%l __ %l_%n %sתל"%l צה"ל ג\u05f3%n %l"%s ①%n%c² '
                'カタカナ%l漢字ひらー ไทย%l ສະບາຍດີ 한국어%n 👍🏽👩\u200d👩\u200d👧%l 🇫🇷🇩🇪%n 1\ufe0f\u20e3 ❤\ufe0f© %l\u00ad%s %le\u0301%s')


def tokenize_classes(spark, sf):
    """P2 on one sample of every class of characters per document, made of its own fields."""
    sample = F.lit(CLASS_SAMPLE)
    for mark, c in (("%n", F.col("doc_id").cast("string")), ("%c", F.col("n_chars").cast("string")),
                    ("%l", F.coalesce("lang", F.lit(""))), ("%s", F.coalesce("source", F.lit("")))):
        sample = F.replace(sample, F.lit(mark), c)
    return fx.table(spark, sf, "documents").select(F.col("doc_id").cast("bigint").alias("ord"), tokens(sample).alias("words"))


def query_terms(spark, sf):
    q = S.query_terms(fx.topics(spark, sf))
    return q.select(F.col("query_id").cast("bigint").alias("query_id"), "term", F.col("qtf").cast("bigint").alias("qtf"))


def query_echo_q(spark, sf):
    t = fx.topics(spark, sf)
    return t.select(F.col("query_id").cast("bigint").alias("query_id"), "query",
                    query_echo(tokens(F.col("query"))).alias("parsed"))


def term_freq(spark, sf):
    p = Collection(spark, sf).index.postings
    return p.select("field", "term", F.col("ord").cast("bigint").alias("ord"), F.col("tf").cast("bigint").alias("tf"))


def doc_length(spark, sf):
    l = Collection(spark, sf).index.lengths
    return l.select("field", F.col("ord").cast("bigint").alias("ord"), F.col("dl").cast("bigint").alias("dl"))


def length_norm(spark, sf):
    l = Collection(spark, sf).index.lengths
    return l.select("field", F.col("ord").cast("bigint").alias("ord"), F.col("dl").cast("bigint").alias("dl"),
                    F.col("norm").cast("bigint").alias("norm"))


def term_stats(spark, sf):
    t = Collection(spark, sf).index.terms
    return t.select("field", "term", F.col("df").cast("bigint").alias("df"), F.col("cf").cast("bigint").alias("cf"))


def collection_stats(spark, sf):
    s = Collection(spark, sf).index.stats
    return s.select("field", F.col("n_docs").cast("bigint").alias("n_docs"),
                    F.col("n_tokens").cast("bigint").alias("n_tokens"), _r("avgdl").alias("avgdl"))


def query_select_one(spark, sf):
    return S.select_queries(fx.topics(spark, sf), ONE_QUERY).select(
        F.col("query_id").cast("bigint").alias("query_id"), "query")


def query_select_range(spark, sf):
    return S.select_queries(fx.topics(spark, sf), QUERY_RANGE).select(
        F.col("query_id").cast("bigint").alias("query_id"), "query")


def qrels_positive(spark, sf):
    return E.positive_qrels(Collection(spark, sf).qrels).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("doc_id").cast("bigint").alias("doc_id"))


def qrels_all(spark, sf):
    return Collection(spark, sf).qrels.select(F.col("query_id").cast("bigint").alias("query_id"),
                                      F.col("doc_id").cast("bigint").alias("doc_id"),
                                      F.col("score").cast("bigint").alias("score"))


def relevant_per_query(spark, sf):
    return E.relevant_per_query(Collection(spark, sf).qrels).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("n_relevant").cast("bigint").alias("n_relevant"))


# --- search --------------------------------------------------------------------

def or_match(spark, sf):
    c = Collection(spark, sf)
    m = S.match(c.index, S.query_terms(c.topics))
    return m.select(F.col("query_id").cast("bigint").alias("query_id"), "term",
                    F.col("ord").cast("bigint").alias("ord"), F.col("tf").cast("bigint").alias("tf"),
                    F.col("qtf").cast("bigint").alias("qtf"))


def _hits_out(h):
    return h.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("ord").cast("bigint").alias("ord"), "score")


def bm25_topk(spark, sf):
    c = Collection(spark, sf)
    return _hits_out(S.search(c.index, c.topics, BM25(BM25_K1), CUT))


def jm_topk(spark, sf):
    c = Collection(spark, sf)
    return _hits_out(S.search(c.index, c.topics, JM(JM_LAMBDA), CUT))


def judged_hits(spark, sf):
    c = Collection(spark, sf)
    h = S.search(c.index, c.topics, BM25(BM25_K1), CUT)
    j = E.judge(h, c.index.docs, c.qrels, E.hits_bounded(c.topics, CUT))
    return j.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("ord").cast("bigint").alias("ord"), F.col("id").cast("bigint").alias("id"), "score", "rel")


def hits_top_m(spark, sf):
    c = Collection(spark, sf)
    small = E.hits_bounded(c.topics, CUT)
    h = S.search(c.index, c.topics, BM25(BM25_K1), CUT, broadcast_ok=small or None)
    j = E.judge(h, c.index.docs, c.qrels, small).filter(F.col("rank") <= TOP)
    shown = S.fetch_hits(j.select("query_id", "rank", "ord", "score", "rel"), c.index.docs,
                         fields=("id", "title", "url", "pubmedId"), broadcast_ok=small)
    return shown.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                        F.col("id").cast("bigint").alias("id"), "title", "url", "pubmedId", "score",
                        F.when(F.col("rel"), "Yes").otherwise("No").alias("relevant"))


def precision_at_rank(spark, sf):
    c = Collection(spark, sf)
    h = S.search(c.index, c.topics, BM25(BM25_K1), CUT)
    p = E.precision_at_rank(E.judge(h, c.index.docs, c.qrels, E.hits_bounded(c.topics, CUT)))
    return p.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("rank").cast("bigint").alias("rank"),
                    F.col("rel_so_far").cast("bigint").alias("rel_so_far"), _r("precision").alias("precision"))


def _metrics(spark, sf, model, precision="double"):
    c = Collection(spark, sf)
    return E.evaluate(c.index, c.topics, c.qrels, model, CUT, precision)


def metrics_bm25(spark, sf):
    return _metrics_out(_metrics(spark, sf, BM25(BM25_K1)))


def metrics_jm(spark, sf):
    return _metrics_out(_metrics(spark, sf, JM(JM_LAMBDA)))


def metrics_long(spark, sf):
    """All four metrics in long form, selected by their command-line names."""
    m = _metrics(spark, sf, BM25(BM25_K1))
    names = {v: k for k, v in E.METRIC_NAMES.items()}
    long = E.metrics_long(m)
    return long.select(F.col("query_id").cast("bigint").alias("query_id"),
                       F.element_at(F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))]),
                                    F.col("metric")).alias("metric"),
                       _r("value").alias("value"))


def metrics_float(spark, sf):
    return _metrics_out(_metrics(spark, sf, JM(JM_LAMBDA), "float"))


def mean_nonzero(spark, sf):
    m = E.mean_nonzero(_metrics(spark, sf, BM25(BM25_K1)))
    return m.select(*[_r(c).alias(c) for c in E.METRICS], F.col("cut").cast("bigint").alias("cut"))


def metrics_with_mean_row(spark, sf):
    m = E.with_mean_row(_metrics(spark, sf, BM25(BM25_K1)))
    return m.select("query", *[_r(c).alias(c) for c in E.METRICS], F.col("cut").cast("bigint").alias("cut"))


# --- tuning --------------------------------------------------------------------

def _train(spark, sf):
    c = Collection(spark, sf)
    return c, S.select_queries(c.topics, fx.train_test_ranges(spark, sf)[0])


def _sweep(spark, sf, model):
    c, train = _train(spark, sf)
    return T.sweep(c.index, train, c.qrels, [model], None, CUT)


def sweep_k1(spark, sf):
    return _metrics_out(_sweep(spark, sf, BM25()), ("model", "param"))


def sweep_lambda(spark, sf):
    return _metrics_out(_sweep(spark, sf, JM()), ("model", "param"))


def _both(spark, sf):
    c, train = _train(spark, sf)
    return T.sweep(c.index, train, c.qrels, [BM25(), JM()], None, CUT)


def sweep_means(spark, sf):
    m = T.sweep_means(_both(spark, sf))
    return m.select("model", "metric", "param", _r("mean").alias("mean"))


def _best(spark, sf, model):
    m = T.best_param(T.sweep_means(_sweep(spark, sf, model)))
    return m.select("model", "metric", "param", _r("mean").alias("mean"))


def best_k1(spark, sf):
    return _best(spark, sf, BM25())


def best_lambda(spark, sf):
    return _best(spark, sf, JM())


def sweep_wide(spark, sf):
    w = T.sweep_wide(_sweep(spark, sf, JM()), "MAP", T.LAMBDA_GRID)
    labels = [str(g) for g in T.LAMBDA_GRID]
    return w.select("metric", "query", F.col("cut").cast("bigint").alias("cut"), *[_r(F.col(f"`{l}`")).alias(l) for l in labels])


def test_split_eval(spark, sf):
    c = Collection(spark, sf)
    train, test = fx.train_test_ranges(spark, sf)
    out = T.train_test(c.index, c.topics, c.qrels, JM(), train, test, "MAP", CUT)
    return out["test"].select(F.col("query_id").cast("bigint").alias("query_id"), _r("value").alias("value"))


# --- index maintenance -----------------------------------------------------------

def upsert_last_wins(spark, sf):
    base = Collection(spark, sf).index
    up = I.upsert(base, fx.upsert_batch(spark, sf))
    dl = up.lengths.filter(F.col("field") == "text").select("ord", "dl")
    return up.docs.join(dl, "ord", "left").select(F.col("id").cast("bigint").alias("id"), F.sha2("text", 256).alias("text_sha256"),
                                                   F.coalesce("dl", F.lit(0)).cast("bigint").alias("dl"))


def create_docs(spark, sf):
    """The stored documents of a corpus with repeated ids, created and opened."""
    path = _scratch(spark, "create")
    saved.index_corpus(fx.duplicate_corpus(spark, sf), path, "create")
    docs = saved.load_index(spark, path).docs
    return docs.select(F.col("id").cast("bigint").alias("id"), "title", "url", "pubmedId", F.sha2("text", 256).alias("text_sha256"))


def create_keeps_dups(spark, sf):
    idx = I.build_index(fx.duplicate_corpus(spark, sf))
    return idx.stats.select("field", F.col("n_docs").cast("bigint").alias("n_docs"),
                            F.col("n_tokens").cast("bigint").alias("n_tokens"), _r("avgdl").alias("avgdl"))


# --- comparison ----------------------------------------------------------------

def runs(spark, sf) -> DataFrame:
    """AP@10 per topic of five runs, and the recall of two of them (undefined for topics without
    judgments), in one sweep job: ``run, query_id, value``."""
    c = Collection(spark, sf)
    sw = T.sweep(c.index, c.topics, c.qrels, [m for m, _ in RUNS], [g for _, g in RUNS], CUT, "double")
    name = F.concat("model", F.lit(":"), F.col("param").cast("string"))
    values = F.array(F.struct(name.alias("run"), F.col("ap").alias("value")),
                     F.struct(F.when(F.concat("model", F.col("param").cast("string")).isin(*RECALL_RUNS),
                                     F.concat(name, F.lit(":recall"))).alias("run"), F.col("recall").alias("value")))
    return sw.select(F.col("query_id").cast("bigint").alias("query_id"), F.inline(values)).filter("run IS NOT NULL")


def _paired(spark, sf):
    r = runs(spark, sf)
    return C.run_pairs(r, C.baseline_pairs(r, BASELINE_RUN))


def run_pairs(spark, sf):
    p = _paired(spark, sf)
    return p.select("run_a", "run_b", "query_id", _r("x").alias("x"), _r("y").alias("y"))


def welch_t(spark, sf):
    w = C.welch_t(_paired(spark, sf))
    return w.select("run_a", "run_b", F.col("n").cast("bigint").alias("n"), _r("t", 6).alias("t"),
                    _r("df", 6).alias("df"), _r("p", 6).alias("p"))


def signed_ranks(spark, sf):
    s = C.ranked_rows(_paired(spark, sf))
    return s.select("run_a", "run_b", "query_id", _r("d").alias("d"), _r("rank").alias("rank"))


def wilcoxon_exact(spark, sf):
    w = C.wilcoxon_exact(_paired(spark, sf))
    return w.select("run_a", "run_b", F.col("n").cast("bigint").alias("n"), _r("w_plus").alias("w_plus"),
                    _r("w_max").alias("w_max"), _r("p").alias("p"))


def compare_decision(spark, sf):
    r = runs(spark, sf)
    out = None
    for test in ("t", "wilcoxon"):
        d = C.compare(r, test, ALPHA, baseline=BASELINE_RUN)
        out = d if out is None else out.unionByName(d)
    return out.select("run_a", "run_b", "test", F.col("n").cast("bigint").alias("n"), "decision")


def compare_all_pairs(spark, sf):
    """C1-C5 over all pairs of the runs of each metric, without a baseline."""
    is_recall = F.col("run").endswith(":recall")
    r = runs(spark, sf).withColumn("metric", F.when(is_recall, "R").otherwise("MAP"))
    out = C.compare_all(r, ALPHA)
    return out.select("metric", "run_a", "run_b", "test", F.col("n").cast("bigint").alias("n"),
                      (F.col("only_a") + F.col("only_b")).cast("bigint").alias("unmatched"),
                      _r("statistic", 6).alias("statistic"), _r("p", 6).alias("p"), "decision")


def test_files_compared(spark, sf):
    """The reports of both models on the test topics, read back with their metric and compared."""
    c = Collection(spark, sf)
    train, test = fx.train_test_ranges(spark, sf)
    read = None
    for model in (JM(), BM25()):
        path = _scratch(spark, f"test-{model.name}")
        out = T.train_test(c.index, c.topics, c.qrels, model, train, test, "MAP", CUT)
        W.write_test_csv(out["best"], out["test"], "MAP", path)
        own = R.read_result_values(spark, path, model.name)
        read = own if read is None else read.unionByName(own)
    found = C.compare_all(read, ALPHA)
    return found.select("metric", "run_a", "run_b", "test", F.col("n").cast("bigint").alias("n"),
                        _r("statistic", 6).alias("statistic"), _r("p", 6).alias("p"), "decision")


QUERIES = {
    "docs_flatten": docs_flatten,
    "topics_file": topics_file,
    "qrels_file": qrels_file,
    "metrics_file": metrics_file,
    "hits_file": hits_file,
    "sweep_file": sweep_file,
    "test_file": test_file,
    "append_docs": append_docs,
    "append_terms": append_terms,
    "append_stats": append_stats,
    "append_search": append_search,
    "tokenize": tokenize,
    "tokenize_classes": tokenize_classes,
    "query_terms": query_terms,
    "query_echo": query_echo_q,
    "term_freq": term_freq,
    "doc_length": doc_length,
    "length_norm": length_norm,
    "term_stats": term_stats,
    "collection_stats": collection_stats,
    "query_select_one": query_select_one,
    "query_select_range": query_select_range,
    "qrels_derived": qrels_all,
    "qrels_positive": qrels_positive,
    "relevant_per_query": relevant_per_query,
    "or_match": or_match,
    "bm25_topk": bm25_topk,
    "jm_topk": jm_topk,
    "hits_top_m": hits_top_m,
    "judged_hits": judged_hits,
    "precision_at_rank": precision_at_rank,
    "metrics_bm25": metrics_bm25,
    "metrics_jm": metrics_jm,
    "mean_nonzero": mean_nonzero,
    "metrics_with_mean_row": metrics_with_mean_row,
    "metrics_float": metrics_float,
    "metrics_long": metrics_long,
    "sweep_k1": sweep_k1,
    "sweep_lambda": sweep_lambda,
    "sweep_means": sweep_means,
    "best_k1": best_k1,
    "best_lambda": best_lambda,
    "sweep_wide": sweep_wide,
    "test_split_eval": test_split_eval,
    "upsert_last_wins": upsert_last_wins,
    "create_keeps_dups": create_keeps_dups,
    "run_pairs": run_pairs,
    "welch_t": welch_t,
    "signed_ranks": signed_ranks,
    "wilcoxon_exact": wilcoxon_exact,
    "compare_decision": compare_decision,
    "compare_all_pairs": compare_all_pairs,
    "test_files_compared": test_files_compared,
    "create_docs": create_docs,
}
