"""Test collection derived from the generated tables (documents, benchmark).

* corpus:  one document per ``documents`` row; ``ord = id = doc_id``; title = source and
           language; url = source; pubmedId = lang.
* topics:  one topic per ``benchmark`` item; query = the whole passage.
* qrels:   by the share of the passage's distinct tokens that the document holds: grade 2 when
           the document holds the whole passage as one run of tokens, else 1 from
           ``RELEVANT_SHARE`` on, else 0 from ``JUDGED_SHARE`` on; below that, not judged.

The judgments are computed with the index itself: per (item, document) the number of the
item's distinct tokens among the document's postings, summed in the document partitions;
only documents that hold all of them are checked for the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.functions.text import tokens
from rankeval.operators.index import TASK_BYTES, Index, build_index
from rankeval.operators.search import MAX_BROADCAST_QUERY_TERMS
from rankeval.session import bounded, cut_lineage, partitions_for

# Fixed values of the derived collection (shares as fractions of whole numbers).
RELEVANT_SHARE = (3, 4)
JUDGED_SHARE = (1, 2)
# Bytes of documents in a bucket of the saved collection, about: a search sums the scores of a bucket's documents for all
# topics and settings in the memory of one task, so buckets must not grow with the input.
COLLECTION_BUCKET_BYTES = 2 * TASK_BYTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The corpus; with ``partitions``, hash-partitioned on ``ord`` before any per-document work."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    if partitions:
        d = d.repartition(partitions, "doc_id")
    return d.select(
        F.col("doc_id").alias("ord"),
        F.col("doc_id").alias("id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        "text",
        F.col("source").alias("url"),
        F.col("lang").alias("pubmedId"),
    )


def nested_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus in the JSON-lines article shape (for S1/P1 round trips)."""
    c = corpus(spark, sf_dir)
    return c.select(
        F.col("id").cast("string").alias("_id"), "title", "text",
        F.struct(F.col("url").alias("url"), F.col("pubmedId").alias("pubmed_id")).alias("metadata"),
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def index(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> Index:
    n = partitions or partitions_for(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return build_index(corpus(spark, sf_dir, n), n, prepartitioned=True)


def _run(c) -> F.Column:
    """Tokens as one string in which whole tokens can be found."""
    return F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))


def qrels(spark: SparkSession, sf_dir: str, idx: Index | None = None) -> DataFrame:
    """``query_id, doc_id, score`` as described in the module docstring."""
    idx = idx or index(spark, sf_dir)
    items = table(spark, sf_dir, "benchmark").select("item_id", tokens(F.col("text")).alias("toks")).filter(
        F.size("toks") > 0)
    terms = items.select("item_id", F.size(F.array_distinct("toks")).alias("need"),
                         F.explode(F.array_distinct("toks")).alias("term"))
    # a document that holds half of an item's terms misses at most half of them, so of that many of its rarest and n more it
    # holds n: those find candidates, and the other, frequent terms are counted for candidates alone
    df = idx.terms.filter("field = 'text'").select("term", "df")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("df", F.lit(0)), "term"))
    half, least = F.floor(F.col("need") / 2), F.floor(F.col("need") / 4) + 1
    terms = terms.join(df, "term", "left").select(
        "item_id", "need", "term", least.alias("least"), (place <= half + 1).alias("rare"), (place <= half + least).alias("first"))
    small = bounded(terms, MAX_BROADCAST_QUERY_TERMS)

    def side(part: DataFrame) -> DataFrame:
        return F.broadcast(part) if small else part

    postings = idx.field_postings("text").select("ord", "term")
    # texts under one number are counted as one document, but miss more terms: one rare term is enough there
    again = idx.docs.groupBy("ord").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    found = cut_lineage(
        postings.join(side(terms.filter("first")), "term").groupBy("ord", "item_id", "need", "least")
        .agg(F.count(F.lit(1)).alias("got"), F.max("rare").alias("rare"))
        .filter("rare").join(again, "ord", "left").filter("got >= least or texts > 1").select("ord", "item_id", "need", "got"))
    others = terms.filter("not first")
    own = others.groupBy("item_id").agg(F.collect_list("term").alias("others"))  # an item's own words
    rest = (postings.join(side(others.select("term").distinct()), "term", "left_semi")
            .join(found.join(side(own), "item_id").select("ord", "item_id", "others"), "ord")
            .filter(F.array_contains("others", F.col("term"))).groupBy("ord", "item_id").agg(F.count(F.lit(1)).alias("more")))
    held = (found.join(rest, ["ord", "item_id"], "left")
            .select("ord", "item_id", "need", (F.col("got") + F.coalesce("more", F.lit(0))).alias("got"))
            .filter(F.col("got") * JUDGED_SHARE[1] >= F.col("need") * JUDGED_SHARE[0]))
    whole = (idx.docs.select("ord", "text").join(held.filter("got = need").select("ord", "item_id"), "ord")
             .join(items.select("item_id", _run(F.col("toks")).alias("passage")), "item_id")
             .filter(F.contains(_run(tokens(F.col("text"))), F.col("passage")))
             .select("ord", "item_id", F.lit(2).alias("grade")))
    grade = F.when(F.col("got") * RELEVANT_SHARE[1] >= F.col("need") * RELEVANT_SHARE[0], 1).otherwise(0)
    return (held.join(whole, ["ord", "item_id"], "left").join(idx.docs.select("ord", "id"), "ord")
            .select(F.col("item_id").alias("query_id"), F.col("id").alias("doc_id"),
                    F.coalesce("grade", grade).cast("int").alias("score")))


def split_topics(t: DataFrame, lo: int, hi: int) -> DataFrame:
    return t.filter(F.col("query_id").between(lo, hi))


def train_test_ranges(spark: SparkSession, sf_dir: str) -> tuple[tuple[int, int], tuple[int, int]]:
    """All topics, split in the middle of their id range: (train, test)."""
    lo, hi = table(spark, sf_dir, "benchmark").agg(F.min("item_id"), F.max("item_id")).first()
    if lo is None:
        return (0, 0), (1, 1)
    middle = (lo + hi) // 2
    return (lo, middle), (middle + 1, max(hi, middle + 1))


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revised versions of every 10th document plus new ids (for S6/S7/A7)."""
    c = corpus(spark, sf_dir)
    revised = c.filter(F.col("id") % 10 == 0).withColumn("text", F.concat("text", F.lit(" revised")))
    new = c.filter(F.col("id") % 100 == 1).withColumn("id", F.col("id") + 10_000_000)
    return revised.drop("ord").unionByName(new.drop("ord"))


def duplicate_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus plus every 20th document again under a new internal number."""
    c = corpus(spark, sf_dir)
    return c.unionByName(c.filter(F.col("id") % 20 == 0).withColumn("ord", F.col("ord") + 20_000_000))


# ---------------------------------------------------------------------------
# Saved collection: built once per Spark application and scale-factor directory,
# written to the shared checkpoint folder, then read like any saved index.

_SAVED: dict[tuple[str, str], str] = {}


def saved_collection(spark: SparkSession, sf_dir: str) -> tuple[Index, DataFrame, DataFrame]:
    """(index, topics, qrels) of the derived collection, materialised once.

    The index is written with :func:`write_index` (bucketed on ord, term-partitioned)
    and the judgments as Parquet, under ``spark.checkpoint.dir``; later calls in the
    same application read them back instead of re-deriving them.
    """
    import os
    import uuid

    from rankeval.operators.saved import MAX_FILES, MAX_GROUPS, load_index, write_index
    from rankeval.session import checkpoint_dir

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    base = _SAVED.get(key)
    if base is None:
        base = f"{checkpoint_dir(spark).rstrip('/')}/rankeval-collection-{uuid.uuid4().hex}"
        n = min(partitions_for(spark, f"{sf_dir.rstrip('/')}/documents.parquet", COLLECTION_BUCKET_BYTES), MAX_FILES // MAX_GROUPS)
        # only the documents are written, by slot: they are not dealt out by number first
        write_index(build_index(corpus(spark, sf_dir), n, prepartitioned=True), f"{base}/index", n)
        qrels(spark, sf_dir, load_index(spark, f"{base}/index")).write.parquet(f"{base}/qrels")
        _SAVED[key] = base
    return load_index(spark, f"{base}/index"), topics(spark, sf_dir), spark.read.parquet(f"{base}/qrels")
