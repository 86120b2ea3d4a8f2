"""Document numbers that follow the place of a row in its input files.

A row of a file scan is named by its file, the file's block it was read from and its place in that block.  The rows of
every block are counted once (as many rows as the input has blocks); running sums over the blocks, by file name and by
place in the file, give each block its first number, and a row's number is that plus its place.  A file has the same rows
in the same order however it is cut into blocks, so numbers depend neither on parallelism nor on partition numbers.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.session import bounded, cut_lineage

# Largest table of blocks that is broadcast (rows of two numbers: 64 MB).
MAX_BROADCAST_BLOCKS = 4_000_000
# Steps of a plan behind which a row still is the row of its place in its file.
ROW_BY_ROW = {"FileSourceScanExec", "ProjectExec", "FilterExec", "ColumnarToRowExec", "WholeStageCodegenExec", "InputAdapter"}


@contextmanager
def same_blocks(spark: SparkSession):
    """Within, every scan of the same files cuts them alike: blocks of ``spark.sql.files.maxPartitionBytes``, one per task,
    whatever the number of cores is at the time."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def is_plain_scan(df: DataFrame) -> bool:
    """Rows straight from the files of one scan, through projections and filters only."""
    step = df._jdf.queryExecution().executedPlan()
    while step.getClass().getSimpleName() in ROW_BY_ROW:
        if step.children().isEmpty():
            return step.getClass().getSimpleName() == "FileSourceScanExec"
        step = step.children().head()
    return False


def block_numbers(rows: DataFrame) -> DataFrame:
    """(key, shift): what to add to the place of a row in its task, per block; ``rows`` has file, block, place."""
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("low"))
    # one row per block of the input: a single task sorts them
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(F.xxhash64("file", "block").alias("key"),
                         (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"))


def numbered(corpus: DataFrame, first=0) -> DataFrame:
    """``corpus`` with ``ord``, a unique number from ``first`` (a number or Column) on; an ``ord`` it has is kept.

    Scans of files are numbered by the place of their rows, in two scans (under ``same_blocks`` when both are to be run
    at once; a block that the first scan did not see is an error).  Anything else may compute its rows in another order
    the next time, so the rows are pinned with a reliable checkpoint in the shared folder first.
    """
    if "ord" in corpus.columns:
        return corpus
    first = F.lit(first) if isinstance(first, int) else first
    if not is_plain_scan(corpus):
        return cut_lineage(corpus.withColumn("ord", F.monotonically_increasing_id() + first))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = corpus.select("*", F.input_file_name().alias("__file"), F.input_file_block_start().alias("__block"),
                           place.alias("__place"))
    blocks = cut_lineage(block_numbers(placed.select(
        F.col("__file").alias("file"), F.col("__block").alias("block"), F.col("__place").alias("place"))))
    if blocks.count() != blocks.select("key").distinct().count():
        raise ValueError("two blocks of the input share a hash: rename a file")
    small = bounded(blocks, MAX_BROADCAST_BLOCKS)
    keyed = placed.withColumn("key", F.xxhash64("__file", "__block"))
    joined = keyed.join(F.broadcast(blocks) if small else blocks, "key", "left")
    shift = F.coalesce("shift", F.raise_error(F.lit("the input was cut into other blocks than before")).cast("long"))
    return joined.withColumn("ord", first + shift + F.col("__place")).drop("key", "shift", "__file", "__block", "__place")
