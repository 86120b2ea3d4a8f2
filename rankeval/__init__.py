"""rankeval: text-retrieval indexing, ranking and evaluation as Spark DataFrame jobs.

Every public function takes and returns DataFrames and stays lazy; nothing is
collected to the driver.  Shuffle layout, broadcast decisions and skew handling
are documented next to each operator.
"""

from rankeval.operators.index import Index, build_index, flatten_articles
from rankeval.operators.saved import index_corpus, load_index, write_index
from rankeval.operators.models import BM25, JM, model_from_name
from rankeval.operators.search import select_queries, query_terms, search, fetch_hits
from rankeval.operators.evaluate import (
    positive_qrels,
    relevant_per_query,
    judge,
    per_query_metrics,
    mean_nonzero,
    with_mean_row,
    evaluate,
)
from rankeval.operators.tune import K1_GRID, LAMBDA_GRID, sweep, sweep_means, best_param, sweep_wide, train_test
from rankeval.operators.compare import run_pairs, welch_t, signed_ranks, wilcoxon_exact, compare, compare_all

__all__ = [
    "Index", "build_index", "index_corpus", "load_index", "write_index", "flatten_articles",
    "BM25", "JM", "model_from_name",
    "select_queries", "query_terms", "search", "fetch_hits",
    "positive_qrels", "relevant_per_query", "judge", "per_query_metrics", "mean_nonzero",
    "with_mean_row", "evaluate",
    "K1_GRID", "LAMBDA_GRID", "sweep", "sweep_means", "best_param", "sweep_wide", "train_test",
    "run_pairs", "welch_t", "signed_ranks", "wilcoxon_exact", "compare", "compare_all",
]
