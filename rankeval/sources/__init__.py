from rankeval.sources.schemas import CORPUS_SCHEMA, TOPICS_SCHEMA, QRELS_SCHEMA
from rankeval.sources.readers import read_corpus, read_topics, read_qrels, read_result_values, topics_from_raw

__all__ = ["CORPUS_SCHEMA", "TOPICS_SCHEMA", "QRELS_SCHEMA", "read_corpus", "read_topics", "read_qrels",
           "read_result_values", "topics_from_raw"]
