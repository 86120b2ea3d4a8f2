"""Soft-membership mixing of documents to target token totals per domain.

1. A classifier over hashed words is fitted on labelled documents (at most ``SAMPLE``, the lowest by a hash of the
   id): naive Bayes on the distinct words of a text, of which only those count that stand out in a domain by
   ``MIN_Z`` deviations and a factor of e**``MIN_WEIGHT``.  What chance has is in proportion to a domain's distinct
   words, not documents: long texts hold more of any word, and length is no sign of a domain.  Rates are smoothed by
   ``PSEUDO``.  Absence counts for words in fewer than ``RARE`` of the documents (a short text lacks frequent words
   whatever its domain).
2. Every whole text gets posteriors over the domains, rounded to 1 / ``RESOLUTION``, and its number of words t.
3. Nonnegative rates r minimise  1/2 sum_k (T_k - target_k)^2 / mass_k  with  T_k = sum_i r_i t_i p_ik  by projected
   gradient descent from r = 1, in the metric of the token counts: r_i <- max(0, r_i - sum_k p_ik (T_k - target_k)
   / mass_k), with Nesterov's momentum.  With this scaling the largest eigenvalue is 1, so the unit step is safe
   whatever the corpus.  The update depends on a document only through its posteriors, so each iteration sums over
   the table of distinct posterior vectors (bounded by the resolution and the number of domains), into which documents
   are folded by a partial aggregation first; the sums of an iteration are one number per domain.
4. A rate becomes copies: its whole part, and one more with probability equal to the fraction, drawn from a hash of
   the id (a fraction within ``SNAP`` of a whole number counts as whole).

DataFrame functions only.  The broadcast side is the weight table, at most ``BUCKETS`` rows.

Defined cases: null and wordless texts have no tokens and the posteriors of a text without weighted words; rows that
share a doc_id are one document (posteriors from all their words); without labelled documents there are no domains and
every rate is 1; an empty table gives an empty result; input columns named like outputs are replaced.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise, table

BUCKETS, SAMPLE, SEED = 1 << 18, 20_000, 42
PSEUDO, MIN_DOCS, MIN_Z, MIN_WEIGHT, RARE = 2.0, 10, 5.0, 0.7, 0.1
RESOLUTION, SNAP = 100, 0.05
ITERATIONS, TOLERANCE = 60, 1e-5
#: Separators of classifier words and of tokens.
CUT, SPACE = r"[\x20\x09-\x0D.,;:!?'\"()-]+", r"[\x20\x09-\x0D]+"
#: Default targets: expected tokens of each domain as a multiple of what the corpus has.
MULTIPLES = {"good": 1.0, "poor": 0.5, "toxic": 0.0}


def label_domain(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, else good or poor by quality."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(
        F.col("quality") == 0, "poor").alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL")


def token_count(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    return F.size(words).cast("long")


def _buckets(docs: DataFrame) -> DataFrame:
    """(doc_id, bucket): the distinct words of each text, hashed."""
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), CUT))
    return docs.select("doc_id", F.explode(words).alias("word")).filter("word != ''").select(
        "doc_id", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket"))


def fit(docs: DataFrame, domains: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[float], DataFrame]:
    """Names, scores of a text without weighted words, and the weight table (bucket, w_0, w_1, ...)."""
    unique = domains.groupBy("doc_id").agg(F.min("domain").alias("domain"))
    chosen = unique.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    chosen = materialise(chosen, "labelled")
    held = materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "sample")  # SAMPLE ids
    size = {r["domain"]: r["n"] for r in held.groupBy("domain").agg(F.countDistinct("doc_id").alias("n")).collect()}
    names, total = sorted(size), sum(size.values())
    seen = _buckets(held).distinct().join(F.broadcast(chosen), "doc_id")
    counted = materialise(seen.groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n_{i}") for i, d in enumerate(names)]), "words")
    mass = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)) for i in range(len(names))]).first()
    overall = F.col("n") / F.lit(float(max(total, 1)))
    expected = [F.col("n") * F.lit(mass[i + 1] / max(mass[0], 1)) for i in range(len(names))]
    present = [F.log((F.col(f"n_{i}") + PSEUDO) / (e + PSEUDO)) for i, e in enumerate(expected)]
    share = [F.least((F.col(f"n_{i}") + PSEUDO * overall) / (size[d] + PSEUDO), F.lit(0.999)) for i, d in enumerate(names)]
    spare = F.greatest(1 - overall, F.lit(0.001))
    absent = [F.when(overall < RARE, F.log((1 - x) / spare)).otherwise(0.0) for x in share]
    weights = [c for i, w in enumerate(present) for c in (absent[i].alias(f"a_{i}"), (w - absent[i]).alias(f"w_{i}"))]
    none = F.lit(False)
    marked = [(F.abs(F.col(f"n_{i}") - e) / F.sqrt(e + 0.5) >= MIN_Z) & (F.abs(w) >= MIN_WEIGHT)
              for i, (e, w) in enumerate(zip(expected, present))]
    table_ = counted.filter((F.col("n") >= MIN_DOCS) & reduce(lambda a, b: a | b, marked, none)).select("bucket", *weights)
    table_ = materialise(table_, "weights")
    lacking = table_.agg(F.lit(0.0), *[F.coalesce(F.sum(f"a_{i}"), F.lit(0.0)) for i in range(len(names))]).first()[1:]
    return names, [log(size[d] / total) + a for d, a in zip(names, lacking)], table_


def posteriors(docs: DataFrame, base: list[float], weights: DataFrame) -> DataFrame:
    """(doc_id, p_0, p_1, ...) for the documents that hold a weighted word."""
    scored = _buckets(docs).join(F.broadcast(weights), "bucket").groupBy("doc_id").agg(
        *[F.sum(f"w_{i}").alias(f"s_{i}") for i in range(len(base))])
    return scored.select("doc_id", *_rounded([F.col(f"s_{i}") + F.lit(b) for i, b in enumerate(base)]))


def _rounded(scores: list[Column]) -> list[Column]:
    """Softmax shares rounded to 1 / RESOLUTION; the largest takes up the rounding, so they sum to 1."""
    n, top = len(scores), F.greatest(*scores, F.lit(-1e300))
    e = [F.exp(x - top) for x in scores]
    share = [F.round(x / reduce(lambda a, b: a + b, e) * RESOLUTION).cast("int") for x in e]
    spare = F.lit(RESOLUTION) - reduce(lambda a, b: a + b, share)
    largest = F.greatest(*share, F.lit(-1))
    out = []
    for i in range(n):
        first = reduce(lambda a, b: a & b, [share[j] < largest for j in range(i)], F.lit(True))
        out.append((share[i] + F.when((share[i] == largest) & first, spare).otherwise(0)).cast("int").alias(f"p_{i}"))
    return out


def rate_column(steps: list[tuple[float, list[float]]], n: int, ahead: float | None = None) -> Column:
    """The rate after the steps (momentum, gradient per domain): a fold of projected updates.  With ``ahead``, the
    point that this momentum extrapolates to, where the next gradient is taken."""
    if not n:
        return F.lit(1.0)
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("before"))
    rows = F.array(*[F.array(F.lit(float(m)), *[F.lit(float(g)) for g in gradient]) for m, gradient in steps]) if steps else \
        F.array().cast("array<array<double>>")

    def update(s: Column, row: Column) -> Column:
        move = reduce(lambda a, b: a + b, [F.col(f"p_{i}") / F.lit(float(RESOLUTION)) * F.get(row, F.lit(i + 1)) for i in range(n)])
        point = s["r"] + F.get(row, F.lit(0)) * (s["r"] - s["before"])
        return F.struct(F.greatest(F.lit(0.0), point - move).alias("r"), s["r"].alias("before"))

    last = F.lit(0.0 if ahead is None else float(ahead))
    return F.aggregate(rows, start, update, lambda s: s["r"] + last * (s["r"] - s["before"]))


def solve(mass: DataFrame, targets: list[float], natural: list[float]) -> list[tuple[float, list[float]]]:
    """Steps of the projected gradient with Nesterov's momentum; ``targets`` and ``natural`` are totals per domain."""
    n, steps, before = len(natural), [], None
    for k in range(ITERATIONS):
        momentum = k / (k + 3.0)
        point = rate_column(steps, n, momentum)
        now = mass.agg(*[F.coalesce(F.sum(point * F.col("tokens") * F.col(f"p_{i}") / RESOLUTION), F.lit(0.0)) for i in range(n)]).first()
        steps.append((momentum, [(x - t) / m if m > 0 else 0.0 for x, t, m in zip(now, targets, natural)]))
        if before is not None and all(abs(x - y) <= TOLERANCE * m for x, y, m in zip(now, before, natural)):
            break
        before = now
    return steps


def mix(docs: DataFrame, domains: DataFrame, multiples: dict[str, float] | None = None) -> tuple[DataFrame, list[str]]:
    """(doc_id, tokens, p_0.., rate, copies), one row per distinct doc_id, and the names of the domains."""
    multiples = MULTIPLES if multiples is None else multiples
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    names, base, weights = fit(narrow, domains)
    tokens = narrow.groupBy("doc_id").agg(F.sum(token_count(F.col("text"))).alias("tokens"))
    n = len(names)
    if not n:
        return tokens.withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1)), names
    scored = posteriors(narrow, base, weights)
    default = _rounded([F.lit(b) for b in base])
    scored = materialise(
        tokens.alias("t").join(scored.alias("s"), F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left").select(
            "t.doc_id", "t.tokens", *[F.coalesce(f"s.p_{i}", default[i]).alias(f"p_{i}") for i in range(n)]), "posteriors")
    columns = [f"p_{i}" for i in range(n)]
    # bounded by the resolution and the number of domains, whatever the corpus: one small file
    mass = materialise(scored.groupBy(*columns).agg(F.sum("tokens").alias("tokens")).coalesce(1), "mass")
    natural = mass.agg(*[F.coalesce(F.sum(F.col("tokens") * F.col(c) / RESOLUTION), F.lit(0.0)) for c in columns]).first()
    targets = [multiples.get(d, 1.0) * m for d, m in zip(names, natural)]
    steps = solve(mass, targets, [float(x) for x in natural])
    rated = scored.withColumn("rate", F.round(rate_column(steps, n), 6))
    near = F.round("rate")
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 32).cast("long")) / float(1 << 32)
    copies = F.when(F.abs(F.col("rate") - near) <= SNAP, near).otherwise(
        F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int"))
    return rated.withColumn("copies", copies.cast("int")), names


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated, names = mix(table(spark, sf_dir, "documents"), label_domain(table(spark, sf_dir, "labels")))
    return rated.select("doc_id", "tokens", *[(F.col(f"p_{i}") / RESOLUTION).alias(f"p_{d}") for i, d in enumerate(names)],
                        "rate", "copies")


def apply_rates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: every row as often as its copies say."""
    rated, _ = mix(docs, label_domain(labels))
    own, copies, copy = fresh(docs, "rated_id"), fresh(docs, "copies"), fresh(docs, "copy")
    rated = rated.select(F.col("doc_id").alias(own), F.col("copies").alias(copies)).filter(F.col(copies) > 0)
    joined = docs.join(rated, F.col("doc_id").eqNullSafe(F.col(own)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[f"`{c}`" for c in docs.columns])
