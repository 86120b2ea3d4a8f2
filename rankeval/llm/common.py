"""Helpers shared by the training-data operators: shared-folder tables and column hygiene."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankeval.session import checkpoint_dir

#: ASCII white space that separates words in every operator here (bytes.split() splits on the same set).
WORD = r"[^\x20\x09-\x0D]+"


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends there.

    The folder is the cluster's ``spark.checkpoint.dir``, so the table survives lost executors and
    later readers never recompute (non-deterministic or costly) work upstream.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def struct_of(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StructType.fromDDL(f"x {t}")["x"].dataType) for n, t in fields])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: At most this many keys can each have one part in ``HOT_KEYS`` of all rows.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, per_key: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` with the columns of ``per_key``, a written table with one row per key and the number ``n`` of rows of it.

    Keys with so many rows that at most ``HOT_KEYS`` of them exist are joined by a broadcast, so no task gets all rows of
    one; the others by a shuffle.  Keys are not null.
    """
    least = per_key.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0] // HOT_KEYS + 1
    hot = F.broadcast(per_key.filter(F.col(n) >= least))
    rest = rows.join(hot.select(key), key, "left_anti").join(per_key.filter(F.col(n) < least), key)
    return rows.join(hot, key).unionByName(rest)
