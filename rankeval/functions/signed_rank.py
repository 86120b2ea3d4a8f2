"""Exact null distribution of the signed-rank sum (C3), one computation per number of pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def upper_tails(n: int, w: np.ndarray) -> np.ndarray:
    """P(W >= w) for the sum W of a random subset of the ranks 1..n, for values at or above its middle n(n+1)/4.

    W and n(n+1)/2 - W are alike, so P(W >= w) = P(W <= n(n+1)/2 - w): one pass over the ranks on the probabilities of the
    sums up to the largest of these bounds, halved at every step.  Halving is exact; what leaves the range of doubles on
    the way is smaller than any tail that is itself in that range, so there is no limit on ``n``.
    """
    if n <= 0:
        return np.full(len(w), np.nan)
    low = np.floor(n * (n + 1) / 2 - np.asarray(w, float))
    top = int(max(low.max(initial=-1), 0))
    p = np.zeros(top + 1)
    p[0] = 1.0
    for rank in range(1, n + 1):
        reach = min(rank * (rank + 1) // 2, top)  # sums beyond are impossible so far
        if rank <= reach:
            with_rank = p[: reach + 1 - rank].copy()
            p[rank: reach + 1] += with_rank
        p[: reach + 1] *= 0.5
    cumulated = np.cumsum(p)
    return np.where(low < 0, 0.0, cumulated[np.clip(low, 0, top).astype(np.int64)])


def tails(requests: DataFrame) -> DataFrame:
    """(n, w_max, tail) of the distinct rows (n, w_max): a task computes one table per distinct ``n``.

    There are at most n(n+1) + 1 distinct values of a signed-rank statistic, so a group is bounded by its ``n``.
    """
    def run(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        return table.select(["n", "w_max"]).append_column("tail", pa.array(upper_tails(n, table.column("w_max").to_numpy())))

    return requests.select("n", "w_max").distinct().groupBy("n").applyInArrow(run, "n long, w_max double, tail double")
