"""Scoring models (J2, J3) as Column expressions over a matched-postings row.

A matched row carries: ``tf`` (term frequency in the document), ``norm`` (document
length after the one-byte encoding), ``dl`` (exact length), ``qtf`` (times the term
occurs in the query), ``df`` / ``cf`` (document / collection frequency of the term)
and the collection statistics ``n_docs``, ``n_tokens``, ``avgdl``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isfinite

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


@dataclass(frozen=True)
class BM25:
    """BM25 with saturation ``k1`` and length normalisation ``b`` (fixed 0.75 in the reference).

    score = qtf * ln(1 + (N - df + 0.5) / (df + 0.5)) * tf / (tf + k1 * (1 - b + b * len / avgdl))
    """

    k1: float = 1.2
    b: float = 0.75
    name = "bm25"
    param_name = "k1"

    def __post_init__(self):
        self.check(self.k1)
        if not 0 <= self.b <= 1:
            raise ValueError("b must be in [0, 1]")

    @staticmethod
    def check(k1: float) -> None:
        if not (k1 >= 0 and isfinite(k1)):
            raise ValueError("k1 must be finite and >= 0")

    @property
    def param(self) -> float:
        return self.k1

    def term_score(self, param: float | Column | None = None, length: str = "norm") -> Column:
        k1 = _lit(self.k1 if param is None else param)
        b = F.lit(self.b)
        tf = F.col("tf").cast("double")
        k = k1 * ((F.lit(1.0) - b) + b * F.col(length).cast("double") / F.col("avgdl"))
        return self.term_bound() * tf / (tf + k)

    def term_bound(self) -> Column:
        """Of a term in at most ``n_docs`` documents: no score of a posting is above this, and none is negative."""
        n, df = F.col("n_docs").cast("double"), F.col("df").cast("double")
        idf = F.log1p((n - df + F.lit(0.5)) / (df + F.lit(0.5)))
        return F.col("qtf") * idf


@dataclass(frozen=True)
class JM:
    """Jelinek-Mercer smoothed language model with weight ``lam`` on the collection.

    score = qtf * ln(1 + ((1 - lam) * tf / len) / (lam * (cf + 1) / (n_tokens + 1)))
    lam = 1 gives 0 for every match (all hits tie).
    """

    lam: float = 0.1
    name = "jm"
    param_name = "lambda"

    def __post_init__(self):
        self.check(self.lam)

    @staticmethod
    def check(lam: float) -> None:
        if not 0 < lam <= 1:
            raise ValueError("lambda must be in (0, 1]")

    @property
    def param(self) -> float:
        return self.lam

    def term_score(self, param: float | Column | None = None, length: str = "norm") -> Column:
        lam = _lit(self.lam if param is None else param)
        p_coll = (F.col("cf").cast("double") + F.lit(1.0)) / (F.col("n_tokens").cast("double") + F.lit(1.0))
        p_doc = (F.lit(1.0) - lam) * F.col("tf").cast("double") / F.col(length).cast("double")
        return F.col("qtf") * F.log1p(p_doc / (lam * p_coll))


def model_from_name(name: str, value: float):
    """Model by name, as on the reference command line; unknown names are an error."""
    if name == "bm25":
        return BM25(k1=float(value))
    if name == "jm":
        return JM(lam=float(value))
    raise ValueError(f"unknown model {name!r}")
