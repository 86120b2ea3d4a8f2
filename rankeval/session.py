"""Session helpers: sane defaults for local runs, shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "rankeval") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's own session."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RANKEVAL_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder (``spark.checkpoint.dir``).

    Only a local session without one (tests, the bench) gets a scratch folder of its own; on a
    cluster a machine-local folder would be lost with its machine, so an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="rankeval-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` provably holds at most ``max_rows`` rows.

    Runs ``limit(max_rows + 1).count()``: it stops early on large inputs, so the
    check costs at most ``max_rows + 1`` rows of work.  Call it only on small,
    cheap inputs (topics, grids), never on a corpus-sized plan.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, from file-system metadata (no Spark job)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables and files a DataFrame reads, by the planner's statistics (no Spark job);
    None when one of them is of unknown size (the planner then assumes the largest number)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(x >= 1 << 62 for x in sizes) else sum(sizes)


def partitions_for(spark: SparkSession, path: str, target_bytes: int = 256 << 20) -> int:
    """Number of partitions for data stored at ``path``: about ``target_bytes`` each,
    and never fewer than the cluster's default parallelism."""
    return max(spark.sparkContext.defaultParallelism, -(-path_bytes(spark, path) // target_bytes))
