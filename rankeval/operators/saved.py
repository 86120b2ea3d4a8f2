"""Saved indexes (S4-S7): what a batch writes, and reading the union of the batches.

A write of documents is a *batch*.  Below the index path it leaves Parquet tables in folders of its own name:

* ``docs``      the stored fields, in directories of ``slot = ord div slot_docs``: a lookup of hits reads their slots only
* ``postings``  one bucketed table per *range* of document numbers (``buckets`` buckets on ``ord`` inside a range), with
                directories by field and term group, files sorted by term
* ``terms``     df and cf (with the losses by replaced documents), in the same directories
* ``replaced``  numbers of the earlier documents that the batch replaces
* ``stats``     n_docs and n_tokens per field (with the losses)

and, last, one row in ``batches``, which readers go by.  ``create`` starts over; ``append`` adds a batch at the cost of the
batch: of the base it reads ids, and the postings of replaced documents.  To merge many batches, create a new index from
the documents of the old one.  One writer at a time.

A *term group* is a range of terms, chosen from the term statistics of a bounded sample of documents so that every group
holds about the same share of the postings; a term that holds such a share by itself is a group alone.  Only the layout
depends on the sample: every posting is in the group of its term.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.operators.index import (
    FIELDS, Index, POSTING_COLUMNS, TASK_BYTES, _docs, analyze, last_wins, lengths_of, renumbered, term_stats,
)
from rankeval.operators.numbering import numbered, same_blocks
from rankeval.session import cut_lineage, input_bytes, path_bytes

# Layout: bytes of documents of a batch of unknown size, and per posting file, at least; most posting files of a batch,
# buckets of a range, term groups of all fields and slots; the groups grow with the square root of the input from this part on.
BUCKET_BYTES, FILE_BYTES, GROUP_BYTES = 1 << 30, 8 << 20, 64 << 20
MAX_FILES, MAX_BUCKETS, MIN_GROUPS, MAX_GROUPS = 1_000_000, 4096, 4, 96
# Bytes of documents of a slot, and in one of its files, about.
SLOT_BYTES, SLOT_FILE_BYTES, MAX_SLOTS = 512 << 20, 64 << 20, 100_000
# Least documents of a slot, so that later batches do not add slots by the document.
MIN_SLOT_DOCS = 1 << 16
# Documents whose terms decide the term groups, about, and the slots they are taken from.
SAMPLE_DOCS, SAMPLE_SLOTS = 20_000, 16

BATCH_FIELDS = {"batch": "string", "place": "int", "first_ord": "long", "next_ord": "long", "ranges": "int", "buckets": "int",
                "slot_docs": "long", "docs_ddl": "string", "bounds": "map<string, array<string>>"}
BATCHES_DDL = ", ".join(f"{n} {t}" for n, t in BATCH_FIELDS.items())


@dataclass(frozen=True)
class Layout:
    ranges: int
    buckets: int  # of one range
    groups: int
    slots: int


def layout(n_bytes: int, parallelism: int, buckets: int | None = None, groups: int | None = None) -> Layout:
    """Layout of a batch of ``n_bytes`` of documents; ``buckets`` and ``groups`` override the totals."""
    # a task writes a file per group, and every reader opens them: few groups, of many buckets, unless the input is large
    groups = groups or max(MIN_GROUPS, min(isqrt(n_bytes // GROUP_BYTES), MAX_GROUPS))
    total = buckets or max(parallelism, min(n_bytes // (groups * FILE_BYTES), MAX_FILES // MAX_GROUPS))
    ranges = -(-total // MAX_BUCKETS)
    return Layout(ranges, -(-total // ranges), groups, max(1, min(-(-n_bytes // SLOT_BYTES), MAX_SLOTS)))


def per_bucket(n_bytes: int, plan: Layout) -> int:
    """Tasks that write a bucket, and so its files per field and term group."""
    return max(1, -(-n_bytes // (plan.ranges * plan.buckets * 2 * TASK_BYTES)))


# ---- term groups ----

def term_bounds(weights: DataFrame, groups: int) -> dict[str, list[str]]:
    """Per field the terms at which a group starts, in byte order, from (field, term, df).

    Groups are shared out to the fields by their postings.  A term with half a group's share of them stands alone; the
    others are packed in order up to that share, so no packed group exceeds one and a half shares.
    """
    total = {r.field: r.n for r in weights.groupBy("field").agg(F.sum("df").alias("n")).collect()}
    everything = sum(total.values())
    out: dict[str, list[str]] = {f: [] for f in FIELDS}
    for field, n in sorted(total.items()):
        k = max(1, round(groups * n / everything))
        share = n / k
        own = weights.filter(F.col("field") == field)
        heavy = own.filter(F.col("df") >= share / 2).select("term")  # at most 2 k rows
        upto = Window.orderBy("term").rowsBetween(Window.unboundedPreceding, -1)
        light = own.filter(F.col("df") < share / 2).withColumn(
            "pack", F.floor(F.coalesce(F.sum("df").over(upto), F.lit(0)) / F.lit(share)))
        starts = {r.term for r in light.groupBy("pack").agg(F.min("term").alias("term")).collect()}
        for r in heavy.collect():
            starts |= {r.term, r.term + "\0"}  # the next string in byte order starts the group behind
        out[field] = sorted(starts, key=lambda t: t.encode("utf-8", "surrogatepass"))
    return out


def group_of(term: str, bounds: list[str]) -> int:
    return bisect_right([b.encode("utf-8", "surrogatepass") for b in bounds], term.encode("utf-8", "surrogatepass"))


def term_group(term: Column, bounds: list[str]) -> Column:
    """Number of bounds up to the term, by halving (as ``group_of``): nested conditions, which are compiled."""
    if not bounds:
        return F.lit(0)

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(term >= F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


# ---- writing ----

def slot_of(slot_docs: int) -> Column:
    return F.expr(f"ord div {int(slot_docs)}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _batches(spark: SparkSession, path: str) -> list:
    """Rows of the batches, in order (one small row each)."""
    fs, p = _fs(spark, f"{path}/batches")
    return sorted(spark.read.schema(BATCHES_DDL).parquet(f"{path}/batches").collect(), key=lambda r: r.place) if fs.exists(p) else []


def index_exists(spark: SparkSession, path: str) -> bool:
    return bool(_batches(spark, path.rstrip("/")))


def _posting_table(path: str, batch: str, k: int) -> tuple[str, str]:
    """Catalog name and folder of a range; the name has the batch's own token, so no other write ever had it."""
    return f"rankeval_{batch}_{k}", f"{path}/postings/batch={batch}/range={k}"


def _slots(spark: SparkSession, path: str, rows: list) -> DataFrame:
    """Stored documents of the batches, with ``slot``; its column metadata tells the documents per slot and the slots."""
    ddl = rows[0].docs_ddl
    folders = [f"{path}/docs/batch={r.batch}" for r in rows]
    docs = spark.read.schema(f"{ddl}, slot long").option("basePath", f"{path}/docs").parquet(*folders).drop("batch")
    slots = 1 + (max(r.next_ord for r in rows) - 1) // rows[0].slot_docs - min(r.first_ord for r in rows) // rows[0].slot_docs
    return docs.withMetadata("slot", {"docs": rows[0].slot_docs, "slots": max(slots, 1)})


def _write(path: str, docs: DataFrame, n_bytes: int, place: int, first: int, rows: list, buckets: int | None,
           groups: int | None, by_slot: bool) -> None:
    """One batch; ``rows`` are those of the earlier batches."""
    spark, batch = docs.sparkSession, uuid.uuid4().hex
    parallelism = spark.sparkContext.defaultParallelism
    base = read_index(spark, path, rows) if rows else None
    if rows:
        slot_docs = rows[0].slot_docs
    else:
        low, high = docs.agg(F.min("ord"), F.max("ord")).first()
        slots = layout(n_bytes, parallelism, buckets, groups).slots
        slot_docs = max(MIN_SLOT_DOCS, -(-((high or 0) - (low or 0) + 1) // slots))
    slotted = docs.withColumn("slot", slot_of(slot_docs))
    if by_slot:  # rows that come in any order: each slot's to one task, or to a task per file of a new index's large slots
        files = 1 if rows else max(1, min(-(-n_bytes // SLOT_FILE_BYTES), SLOT_BYTES // SLOT_FILE_BYTES))
        slotted = slotted.repartition("slot", F.pmod(F.xxhash64("ord"), F.lit(files)))
    slotted.sortWithinPartitions("slot", "ord").write.partitionBy("slot").parquet(f"{path}/docs/batch={batch}")
    # the postings are laid out by what was written: the input may be read several times, or not be a batch's alone
    n_bytes = path_bytes(spark, f"{path}/docs/batch={batch}")
    plan = layout(n_bytes, parallelism, buckets, groups)
    row = {"batch": batch, "place": place, "first_ord": first, "ranges": plan.ranges, "buckets": plan.buckets,
           "slot_docs": slot_docs, "docs_ddl": docs.schema.toDDL(), "next_ord": first + 1}
    written = _slots(spark, path, [Row(**row)])
    low, high = written.agg(F.min("ord"), F.max("ord")).first()
    row["next_ord"] = first if high is None else max(first, high + 1)
    if rows:
        bounds = rows[0].bounds
    else:  # the sample is analysed once
        bounds = term_bounds(cut_lineage(term_stats(analyze(_sample(written, slot_docs, low, high))[1])), plan.groups)
    row["bounds"] = bounds
    if base is not None:
        base.docs.select("ord", "id").join(written.select("id"), "id", "left_semi").select("ord").write.parquet(
            f"{path}/replaced/batch={batch}")
        replaced = spark.read.schema("ord long").parquet(f"{path}/replaced/batch={batch}")
    width = -(-((high or 0) - (low or 0) + 1) // plan.ranges)
    for k in range(plan.ranges):
        start = (low or 0) + k * width
        slots = F.col("slot").between(start // slot_docs, (start + width - 1) // slot_docs)
        part = written.filter(slots & F.col("ord").between(start, start + width - 1)).drop("slot")
        # several tasks to a bucket, each with rows of that bucket alone
        tasks = plan.buckets * per_bucket(n_bytes, plan)
        _write_range(path, batch, k, part.repartition(tasks, "ord"), plan.buckets, bounds)
    new = reduce(DataFrame.unionByName, [_range(spark, path, batch, k, plan.buckets) for k in range(plan.ranges)])
    change, count = term_stats(new), _stats(lengths_of(new))
    if base is not None:
        lost = base.postings.select(*POSTING_COLUMNS).join(replaced, "ord", "left_semi")
        change = change.unionByName(term_stats(lost).select(
            "field", "term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"))).groupBy("field", "term").agg(
            F.sum("df").alias("df"), F.sum("cf").alias("cf"))
        count = count.unionByName(_stats(lengths_of(lost)).select(
            "field", (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens")))
    (change.withColumn("tg", _field_group(bounds)).repartition("field", "tg").sortWithinPartitions("field", "tg", "term")
     .write.partitionBy("field", "tg").parquet(f"{path}/terms/batch={batch}"))
    count.coalesce(1).write.parquet(f"{path}/stats/batch={batch}")
    spark.createDataFrame([tuple(row[c] for c in BATCH_FIELDS)], BATCHES_DDL).coalesce(1).write.mode("append").parquet(f"{path}/batches")


def _sample(written: DataFrame, slot_docs: int, low: int | None, high: int | None) -> DataFrame:
    """About ``SAMPLE_DOCS`` documents from up to ``SAMPLE_SLOTS`` slots spread over the batch, dealt out to all tasks: a
    slot's file may be one task's, and the analysis of its sample must not be."""
    first, last = (low or 0) // slot_docs, (high or 0) // slot_docs
    slots = sorted({first + (last - first) * i // max(SAMPLE_SLOTS - 1, 1) for i in range(SAMPLE_SLOTS)})
    spread = written.filter(F.col("slot").isin(slots))
    every = max(1, spread.count() // SAMPLE_DOCS)  # numbers may have gaps
    return spread.filter(F.pmod(F.xxhash64("ord"), F.lit(every)) == 0).repartition(
        written.sparkSession.sparkContext.defaultParallelism, "ord")


def _field_group(bounds: dict[str, list[str]]) -> Column:
    out = F.lit(0)
    for field, starts in bounds.items():
        out = F.when(F.col("field") == field, term_group(F.col("term"), starts)).otherwise(out)
    return out


@contextmanager
def open_files(spark: SparkSession, files: int):
    """Within, a task may keep so many files open, so that its rows are not sorted by file once more."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write_range(path: str, batch: str, k: int, docs: DataFrame, buckets: int, bounds: dict) -> None:
    table, folder = _posting_table(path, batch, k)
    _, _, by_field = analyze(docs)
    # groups are ranges of terms and a task has rows of one bucket: by field and term, its rows come file by file
    postings = reduce(DataFrame.unionByName, [
        p.sortWithinPartitions("term").withColumn("tg", term_group(F.col("term"), bounds.get(f) or [])) for f, p in by_field.items()])
    with open_files(docs.sparkSession, sum(len(starts) + 1 for starts in bounds.values())):
        (postings.write.format("parquet").bucketBy(buckets, "ord").partitionBy("field", "tg")
         .option("path", folder).saveAsTable(table))


def _range(spark: SparkSession, path: str, batch: str, k: int, buckets: int) -> DataFrame:
    """The bucketed postings of a range, registered in this session's catalog."""
    table, folder = _posting_table(path, batch, k)
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (term STRING, ord BIGINT, tf INT, dl INT, norm INT, field STRING, tg INT) "
                  f"USING parquet PARTITIONED BY (field, tg) CLUSTERED BY (ord) INTO {buckets} BUCKETS "
                  f"LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def _stats(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("n_tokens"))


# ---- reading ----

def read_index(spark: SparkSession, path: str, rows: list) -> Index:
    """The union of the batches ``rows``."""
    ranges = [_range(spark, path, r.batch, k, r.buckets) for r in rows for k in range(r.ranges)]
    later = [f"{path}/replaced/batch={r.batch}" for r in rows[1:]]
    # numbers are never given twice, so a number that any batch replaces is dead in all of them
    replaced = spark.read.schema("ord long").parquet(*later).distinct() if later else None
    names = [r.batch for r in rows]
    terms = spark.read.schema("term string, df long, cf long, batch string, field string, tg int").option(
        "basePath", f"{path}/terms").parquet(*[f"{path}/terms/batch={b}" for b in names]).drop("batch")
    changes = terms if later else None
    if later:
        terms = terms.groupBy("field", "tg", "term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0")
    stats = spark.read.schema("field string, n_docs long, n_tokens long").parquet(*[f"{path}/stats/batch={b}" for b in names])
    stats = stats.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter(
        "n_docs > 0").withColumn("avgdl", F.col("n_tokens") / F.col("n_docs"))
    docs, postings = _slots(spark, path, rows), reduce(DataFrame.unionByName, ranges)
    if replaced is not None:
        docs, postings = (x.join(replaced, "ord", "left_anti") for x in (docs, postings))
    return Index(docs, lengths_of(postings), postings, terms, stats, ranges=tuple(ranges), bounds=dict(rows[0].bounds),
                 replaced=replaced, term_changes=changes)


def load_index(spark: SparkSession, path: str) -> Index:
    """Open a saved index."""
    path = path.rstrip("/")
    rows = _batches(spark, path)
    if not rows:
        raise FileNotFoundError(f"no index at {path}")
    return read_index(spark, path, rows)


def _clear(spark: SparkSession, path: str) -> None:
    """What an index left at ``path``; its list of batches first, so that no reader meets half of it."""
    for r in _batches(spark, path):
        for k in range(r.ranges):
            spark.sql(f"DROP TABLE IF EXISTS {_posting_table(path, r.batch, k)[0]}")
    for name in ("batches", "docs", "postings", "terms", "replaced", "stats"):
        fs, p = _fs(spark, f"{path}/{name}")
        fs.delete(p, True)


def _bytes_of(corpus: DataFrame) -> int:
    return input_bytes(corpus) or BUCKET_BYTES


def write_index(index: Index, path: str, buckets: int | None = None, groups: int | None = None) -> str:
    """Save the documents of a lazily built index as a new index (S5); returns the path."""
    spark, path = index.docs.sparkSession, path.rstrip("/")
    _clear(spark, path)
    docs = _docs(index.docs)
    _write(path, docs, _bytes_of(docs), 0, 0, [], buckets, groups, by_slot=True)
    return path


def index_corpus(corpus: DataFrame, path: str, mode: str = "create_or_append", partitions: int | None = None,
                 groups: int | None = None) -> str:
    """Index sink with the three open modes; ``partitions`` is the number of buckets, else by ``layout``.

    * ``create``: new index from the corpus, duplicate ids kept (S5).
    * ``append``: upsert by id into the existing index as a new batch, at the cost of the batch; error if
      none exists (S6).
    * ``create_or_append``: append when an index exists, else create with de-duplication (S7).
    """
    spark, path = corpus.sparkSession, path.rstrip("/")
    if mode not in ("create", "append", "create_or_append"):
        raise ValueError(f"unknown open mode {mode!r}")
    rows = [] if mode == "create" else _batches(spark, path)
    if mode == "append" and not rows:
        raise FileNotFoundError(f"append needs an existing index at {path}")
    n_bytes = _bytes_of(corpus)
    with same_blocks(spark):
        if rows:
            first = rows[-1].next_ord
            docs = renumbered(corpus, first=first)
            _write(path, docs, n_bytes, rows[-1].place + 1, first, rows, partitions, groups, by_slot=True)
            return path
        _clear(spark, path)
        with_ord = numbered(corpus)
        dedup = mode == "create_or_append"
        _write(path, _docs(last_wins(with_ord) if dedup else with_ord), n_bytes, 0, 0, [], partitions, groups,
               by_slot=dedup or "ord" in corpus.columns)
    return path
