"""Index construction (P1, P5, A1-A5, A7) and in-memory upserts; ``saved`` keeps an index on disk.

Layout: a *document-partitioned* index.  The corpus is hash-partitioned once on
the internal document number ``ord``; tokenising, term frequencies and lengths are
then computed inside each partition (no further shuffle), and at search time the
per-(query, document) score sum runs in the same partitions.  Only the small
per-query top-k lists and the term statistics cross the network.

Tables (all plain DataFrames):

* ``docs``     ord, id, title, text, url, pubmedId   (stored fields; saved: also slot)
* ``lengths``  field, ord, dl, norm                  (A2, P5; only non-empty fields)
* ``postings`` field, term, ord, tf, dl, norm        (A1; length denormalised so scoring needs no join)
* ``terms``    field, term, df, cf                   (A3, A4)
* ``stats``    field, n_docs, n_tokens, avgdl        (A5)
"""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankeval.functions.text import length_norm, tokens
from rankeval.operators.numbering import numbered
from rankeval.session import input_bytes

FIELDS = ("title", "text")
DOC_COLUMNS = ("ord", "id", "title", "text", "url", "pubmedId")
POSTING_COLUMNS = ("field", "term", "ord", "tf", "dl", "norm")


@dataclass(frozen=True)
class Index:
    docs: DataFrame
    lengths: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    # Lazily built indexes keep each field's postings separately: searching one field
    # then analyses only that field and keeps the document partitioning.
    by_field: dict = dc_field(default_factory=dict, compare=False)
    # Saved indexes: the postings of each document range, each bucketed on ord (see ``saved``); a search
    # sums scores inside every range and only then unites them.
    ranges: tuple = ()
    # Saved indexes: per field the terms at which a term group starts; postings and term statistics lie in
    # directories by group.
    bounds: dict = dc_field(default_factory=dict, compare=False)
    # Saved indexes with appended batches: numbers of replaced documents, and the changes of df and cf (one
    # row per batch and term), which ``terms`` adds up; a search adds up those of its own terms only.
    replaced: DataFrame | None = None
    term_changes: DataFrame | None = None

    @property
    def grouped(self) -> bool:
        return bool(self.bounds)

    def field_ranges(self, field: str) -> list[DataFrame]:
        """The field's postings range by range; of replaced documents too."""
        if not self.ranges:
            return [self.field_postings(field)]
        return [r.filter(F.col("field") == field) for r in self.ranges]

    def live(self, rows: DataFrame) -> DataFrame:
        """Rows (with ``ord``) of documents that no later batch replaced."""
        return rows if self.replaced is None else rows.join(self.replaced, "ord", "left_anti")

    def field_postings(self, field: str) -> DataFrame:
        if field in self.by_field:
            return self.by_field[field]
        return self.postings.filter(F.col("field") == field)


def flatten_articles(articles: DataFrame) -> DataFrame:
    """Nested JSON article -> stored fields (id, title, text, url, pubmedId[, version])."""
    return articles.select(
        *[F.col(c) for c in articles.columns if c == "version"],
        F.col("_id").alias("id"),
        "title",
        "text",
        F.col("metadata.url").alias("url"),
        F.col("metadata.pubmed_id").alias("pubmedId"),
    )


def assign_ord(corpus: DataFrame, base: DataFrame | None = None, first: int = 0) -> DataFrame:
    """Give every document a unique internal number after the base index's maximum (or from ``first`` on)."""
    if base is not None:
        first = base.agg(F.coalesce(F.max("ord") + 1, F.lit(0)).alias("m")).scalar()
    return numbered(corpus, first)


def _docs(corpus: DataFrame) -> DataFrame:
    cols = []
    for c in DOC_COLUMNS:
        cols.append(F.col(c) if c in corpus.columns else F.lit(None).cast("string").alias(c))
    return corpus.select(*cols)


def analyze_field(docs: DataFrame, field: str) -> DataFrame:
    """A1 for one field: postings ``field, term, ord, tf, dl, norm``.

    The grouping keys contain ``ord``, so a hash partitioning of ``docs`` on ``ord``
    already satisfies them and no exchange is planned.  Empty fields produce no
    postings.  ``explode_outer`` plus a null filter is used instead of ``explode``:
    for ``explode`` Catalyst infers ``size(tokens) > 0`` and pushes it below the
    repartition, which would tokenise every document again in the scan stage.
    """
    toks = docs.select("ord", tokens(F.col(field)).alias("toks"))
    with_len = toks.withColumn("dl", F.size("toks")).withColumn("norm", length_norm(F.col("dl")))
    return (
        with_len.select(F.lit(field).alias("field"), "ord", "dl", "norm", F.explode_outer("toks").alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("field", "ord", "dl", "norm", "term")
        .agg(F.count(F.lit(1)).cast("int").alias("tf"))
        .select("field", "term", "ord", "tf", "dl", "norm")
    )


def lengths_of(postings: DataFrame) -> DataFrame:
    """A2: per (field, document) length, from that document's postings (no shuffle)."""
    return postings.groupBy("field", "ord").agg(F.max("dl").alias("dl"), F.max("norm").alias("norm"))


def analyze(docs: DataFrame, fields=FIELDS) -> tuple[DataFrame, DataFrame, dict]:
    """A1 + A2 for all fields: (lengths, postings, postings by field).

    The union over fields is used for statistics and for writing; a filter on the
    field prunes the other branches.
    """
    by_field = {f: analyze_field(docs, f) for f in fields}
    postings = None
    lengths = None
    for f in fields:
        p, l = by_field[f], lengths_of(by_field[f])
        postings = p if postings is None else postings.unionByName(p)
        lengths = l if lengths is None else lengths.unionByName(l)
    return lengths, postings, by_field


def term_stats(postings: DataFrame) -> DataFrame:
    """A3 + A4: document and collection frequency per (field, term).

    Partial aggregation runs before the shuffle, so a term present in every
    document still sends one row per partition, not one per document.
    """
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")
    )


def collection_stats(lengths: DataFrame) -> DataFrame:
    """A5: documents with the field, total tokens, average length (exact lengths)."""
    return lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("dl").alias("n_tokens"),
        F.avg(F.col("dl").cast("double")).alias("avgdl"),
    )


def last_wins(corpus: DataFrame) -> DataFrame:
    """One row per ``id``, the latest: the highest ``version`` where the corpus has that column
    (any orderable type, e.g. file time, file name and place in the file), then the highest ``ord``.

    A null id names no document, so rows with one replace nothing and are all kept.
    """
    order = F.struct("version", "ord") if "version" in corpus.columns else F.col("ord")
    latest = corpus.filter(F.col("id").isNotNull()).groupBy("id").agg(F.max_by("ord", order).alias("ord"))
    return corpus.join(latest, ["id", "ord"], "left_semi").unionByName(corpus.filter(F.col("id").isNull()))


def renumbered(batch: DataFrame, base: DataFrame | None = None, first: int = 0) -> DataFrame:
    """The latest documents of a batch under numbers the base does not use; numbers that the batch
    brings only order its versions."""
    if "ord" in batch.columns:
        batch = batch.drop("ord") if "version" in batch.columns else batch.withColumnRenamed("ord", "version")
    return _docs(last_wins(assign_ord(batch, base, first)))


# Bytes of documents that one task analyses: its words are counted in memory, whatever the corpus.
TASK_BYTES = 16 << 20


def partitions_of(corpus: DataFrame, target_bytes: int = TASK_BYTES) -> int:
    """Document partitions for a corpus: about ``target_bytes`` of its input each, at least the
    cluster's default parallelism; with input of unknown size, ``spark.sql.shuffle.partitions``."""
    spark = corpus.sparkSession
    size = input_bytes(corpus)
    if size is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, -(-size // target_bytes))


def build_index(corpus: DataFrame, partitions: int | None = None, fields=FIELDS, dedup: bool = False,
                prepartitioned: bool = False) -> Index:
    """Lazily build an index from a flat corpus (``id, title, text, url, pubmedId[, ord]``).

    ``partitions``: number of document partitions (index shards).  The corpus is
    hash-partitioned on ``ord`` once; everything downstream reuses that layout.
    ``dedup=True`` keeps only the last version of each id (create_or_append/append
    semantics); the default keeps duplicates like create mode (S5).
    ``prepartitioned=True`` states that the corpus is already hash-partitioned on
    ``ord`` (e.g. repartitioned before expensive per-document projections).
    """
    corpus = assign_ord(corpus)
    docs = _docs(last_wins(corpus) if dedup else corpus)
    n = partitions or 0
    if dedup or not prepartitioned:
        n = partitions or partitions_of(corpus)
        docs = docs.repartition(n, "ord")
    lengths, postings, by_field = analyze(docs, fields)
    return Index(docs, lengths, postings, term_stats(postings), collection_stats(lengths), by_field)


def upsert(base: Index, batch: DataFrame, partitions: int | None = None, fields=FIELDS) -> Index:
    """Replace documents whose id reappears, add the rest (last version wins).

    Work is proportional to the batch plus one anti-join pass over the base tables;
    statistics are re-aggregated from the live postings (replaced documents no
    longer count).
    """
    new_docs = renumbered(batch, base.docs)
    n = partitions or int(new_docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    new_docs = new_docs.repartition(n, "ord")
    replaced = base.docs.join(new_docs.select("id"), "id", "left_semi").select("ord")
    docs = _docs(base.docs).join(replaced, "ord", "left_anti").unionByName(new_docs)
    new_lengths, new_postings, _ = analyze(new_docs, fields)
    lengths = base.lengths.join(replaced, "ord", "left_anti").unionByName(new_lengths)
    postings = (base.postings.select(*POSTING_COLUMNS).join(replaced, "ord", "left_anti")
                .unionByName(new_postings))
    return Index(docs, lengths, postings, term_stats(postings), collection_stats(lengths))


def with_field(index: Index, field: str) -> Index:
    return replace(index, postings=index.field_postings(field))
