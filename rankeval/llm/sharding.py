"""Reproducible global shuffle: Feistel permutation with cycle walking over global row numbers.

Every row gets its rank in the total order of the key columns (0 .. N-1).  A keyed Feistel network over
the product domain a x b (a = ceil(sqrt N), b = ceil(N / a), so a * b >= N and fewer than a points lie
outside) permutes the rank; a point outside [0, N) is permuted again until it falls inside (cycle walking).
With p the permuted number, shard = p mod n and slot = p div n: shard sizes differ by at most one row
(law ``rows``), slots are gapless, and both can be computed for any row number without looking at data.

DataFrame functions only.  One shuffle (the range partitioning that gives ranks); the permutation is a
column expression.

Defined cases: a null text has size 1 and checksum 0; null ids sort first; rows equal in all key columns
are interchangeable and get consecutive ranks; an empty table gives an empty result; columns of the input
that are named like an output column are replaced.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialise, table

SHARDS = 8
SEED = 42
ROUNDS = 8
#: Round function: products of two numbers below 2**31 stay inside a signed 64-bit integer.
PRIME, MULT_1, MULT_2 = 2147483647, 1103515245, 1566083941


def round_keys(seed: int) -> list[int]:
    """Keys from the seed by the minimal-standard generator."""
    keys, state = [], seed % (PRIME - 1) + 1
    for _ in range(ROUNDS):
        state = state * 48271 % PRIME
        keys.append(state)
    return keys


def domain(n: int) -> tuple[int, int]:
    a = max(1, isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _f_int(v: int, k: int) -> int:
    h = (v * MULT_1 + k) % PRIME
    h = ((h ^ (h >> 15)) * MULT_2) % PRIME
    return h ^ (h >> 13)


def permute_int(x: int, a: int, b: int, keys: list[int]) -> int:
    """The permutation of a * b points for one number (used for the walk bound and by tests)."""
    left, right = x % a, x // a
    for i, k in enumerate(keys):
        if i % 2 == 0:
            left = (left + _f_int(right, k)) % a
        else:
            right = (right + _f_int(left, k)) % b
    return right * a + left


def walk_bound(n: int, a: int, b: int, keys: list[int]) -> int:
    """Most further permutations a point of [0, n) can need to come back into [0, n).

    Follows only the a * b - n < sqrt(n) + 1 points outside, from those that no outside point leads to
    (points on a cycle wholly outside are never reached).
    """
    outside = {x: permute_int(x, a, b, keys) for x in range(n, a * b)}
    most = 0
    for x in outside.keys() - set(outside.values()):
        steps = 1
        while (x := outside[x]) >= n:
            steps += 1
        most = max(most, steps)
    return most


def _f_col(v: Column, k: Column) -> Column:
    h = F.pmod(v * F.lit(MULT_1).cast("long") + k, F.lit(PRIME).cast("long"))
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 15)) * F.lit(MULT_2).cast("long"), F.lit(PRIME).cast("long"))
    return h.bitwiseXOR(F.shiftright(h, 13))


def permute(x: Column, a: int, b: int, keys: list[int]) -> Column:
    """The permutation of a * b points as a column: a fold over pairs of round keys."""
    la, lb = F.lit(a).cast("long"), F.lit(b).cast("long")
    pairs = F.array(*[F.struct(F.lit(keys[i]).cast("long").alias("e"), F.lit(keys[i + 1]).cast("long").alias("o"))
                      for i in range(0, len(keys), 2)])

    def left_half(s: Column, k: Column) -> Column:
        return F.struct(F.pmod(s["l"] + _f_col(s["r"], k["e"]), la).alias("l"), s["r"].alias("r"), k["o"].alias("o"))

    def right_half(s: Column) -> Column:
        return F.struct(s["l"].alias("l"), F.pmod(s["r"] + _f_col(s["l"], s["o"]), lb).alias("r"))

    start = F.struct(F.pmod(x, la).alias("l"), F.floor(x / la).cast("long").alias("r"))

    # transform() over a one-element array binds the half round's result to a name, so it is computed once
    def merge(s: Column, k: Column) -> Column:
        return F.element_at(F.transform(F.array(left_half(s, k)), right_half), 1)

    return F.aggregate(pairs, start, merge, lambda s: s["r"] * la + s["l"])


def number_rows(df: DataFrame, keys: list[str], out: str = "row_no") -> tuple[DataFrame, int]:
    """Add each row's rank in the order of ``keys`` (gapless from 0); also the number of rows.

    Range partitions sorted inside are written to the shared folder together with a per-partition running
    number; offsets come from one count per partition.
    """
    placed = df.drop(out).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(placed.withColumn("__place", F.monotonically_increasing_id()), "rows")
    part, within = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    n = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    # one row per range partition: the running sum and the broadcast side are bounded by the partition count
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return numbered.withColumn(out, F.col("__before") + within).drop("__part", "__before", "__place"), n


def feistel_shards(df: DataFrame, keys: list[str], n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long) of the seeded global shuffle."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    numbered, n = number_rows(df.drop("shard", "slot", "__x"), keys, "__x")
    a, b = domain(n)
    round_key = round_keys(seed)
    out = numbered.withColumn("__x", permute(F.col("__x"), a, b, round_key))
    for _ in range(walk_bound(n, a, b, round_key)):
        out = out.withColumn("__x", F.when(F.col("__x") >= n, permute(F.col("__x"), a, b, round_key))
                             .otherwise(F.col("__x")))
    return (out.withColumn("shard", F.pmod("__x", F.lit(n_shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("__x") / n_shards).cast("long")).drop("__x"))


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    return feistel_shards(docs, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _perm_sql(source: str, x: str) -> str:
    """SELECT that adds ``y``, the permutation of column ``x`` of ``source`` (columns a, b must be there)."""
    sql = f"SELECT *, {x} % a AS l, {x} // a AS r FROM {source}"
    for i, k in enumerate(round_keys(SEED)):
        arg = "r" if i % 2 == 0 else "l"
        sql = f"SELECT * REPLACE (({arg} * {MULT_1} + {k}) % {PRIME} AS h) FROM ({sql})" if i else \
            f"SELECT *, ({arg} * {MULT_1} + {k}) % {PRIME} AS h FROM ({sql})"
        sql = f"SELECT * REPLACE ((xor(h, h >> 15) * {MULT_2}) % {PRIME} AS h) FROM ({sql})"
        new = "(l + xor(h, h >> 13)) % a AS l" if i % 2 == 0 else "(r + xor(h, h >> 13)) % b AS r"
        sql = f"SELECT * REPLACE ({new}) FROM ({sql})"
    return f"SELECT * EXCLUDE (l, r, h), r * a + l AS y FROM ({sql})"


def shard_sql(rows: str, order: str, n_shards: int = SHARDS) -> str:
    """DuckDB: ``rows`` (a query) with x (row number) and y (permuted, walked) in CTE ``placed``."""
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS x, count(*) OVER () AS n FROM ({rows})),
sized AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a,
          CAST(ceil(n / ceil(sqrt(n))) AS BIGINT) AS b FROM numbered),
walk AS ({_perm_sql('(SELECT x, n, a, b FROM sized)', 'x')}
         UNION ALL
         SELECT x, n, a, b, y FROM ({_perm_sql('(SELECT x, n, a, b, y AS z FROM walk WHERE y >= n)', 'z')})),
placed AS (SELECT s.*, CAST(w.y % {n_shards} AS INTEGER) AS shard, w.y // {n_shards} AS slot
           FROM sized s JOIN walk w ON s.x = w.x AND w.y < w.n)"""
