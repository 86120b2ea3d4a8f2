"""Continuous indexing: new corpus files are upserted into the saved index.

The reference indexes a file in ``append`` / ``create_or_append`` mode; here the
same open modes run once per micro-batch of a file stream.  Each micro-batch is
one ``index_corpus`` call (upsert by id, last version wins) that writes a new segment
at the cost of the batch, so readers always see a consistent version and a batch
that is replayed after a failure only replaces the same ids again (idempotent).  Inside
a batch the version of a row is its file's time, its file and its place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rankeval.operators.index import flatten_articles
from rankeval.operators.saved import index_corpus
from rankeval.sources.readers import file_version
from rankeval.sources.schemas import CORPUS_SCHEMA


def index_stream(spark: SparkSession, source_dir: str, index_path: str, checkpoint: str,
                 mode: str = "create_or_append", partitions: int | None = None,
                 available_now: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that indexes JSON-lines article files arriving in ``source_dir``.

    ``checkpoint`` must be a shared, durable folder (the stream's progress lives
    there).  ``available_now=True`` processes what is present and stops.
    """
    reader = spark.readStream.schema(CORPUS_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(source_dir).withColumn("version", file_version())
    articles = flatten_articles(raw)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        index_corpus(batch, index_path, mode, partitions)

    writer = articles.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
