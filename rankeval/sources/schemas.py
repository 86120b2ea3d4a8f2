"""Input schemas of the test-collection files (declared, never inferred)."""

from pyspark.sql import types as T

META_DOC = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("pubmed_id", T.StringType()),
])

# One JSON object per line.
CORPUS_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("metadata", META_DOC),
])

META_TOPIC = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("narrative", T.StringType()),
])

# One JSON object per line; only _id and metadata.query are used.
TOPICS_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()),  # published files have numbers or strings
    T.StructField("text", T.StringType()),
    T.StructField("metadata", META_TOPIC),
])

# S3: tab separated, one header line.
QRELS_SCHEMA = T.StructType([
    T.StructField("query_id", T.IntegerType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("score", T.IntegerType()),
])
