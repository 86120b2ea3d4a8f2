"""Hand-made micro collection shared by the tests.

Five documents of 1-6 tokens, four topics: one with hits, one without any hit,
one without judgments, one with a repeated term; judgments with grades 0, 1, 2 and
a duplicate row.
"""

from pyspark.sql import types as T

DOCS = [
    # ord, id, title, text
    (0, "d0", "alpha", "apple banana"),
    (1, "d1", "beta", "apple apple cherry"),
    (2, "d2", "gamma", "banana cherry date elder fig grape"),
    (3, "d3", "delta", "apple"),
    (4, "d4", "eps", "cherry banana apple date"),
]
TOPICS = [
    (1, "apple"),            # hits everywhere apple occurs
    (2, "zucchini"),          # no hit at all
    (3, "banana cherry"),     # no judgments
    (4, "apple apple date"),  # repeated term
]
QRELS = [
    (1, "d1", 2),
    (1, "d3", 1),
    (1, "d0", 0),
    (1, "d3", 1),   # duplicate
    (2, "d2", 1),
    (4, "d4", 1),
    (4, "d9", 1),   # judged but not in the corpus
]


def frames(spark):
    docs = spark.createDataFrame(
        [(o, i, t, x, None, None) for o, i, t, x in DOCS],
        "ord long, id string, title string, text string, url string, pubmedId string")
    topics = spark.createDataFrame(TOPICS, "query_id long, query string")
    qrels = spark.createDataFrame(QRELS, "query_id long, doc_id string, score int")
    return docs, topics, qrels
