"""Query selection, matching, scoring and top-k.

Plan shape for ``search`` (one job for all queries and all parameter values):

    postings[field]  --(broadcast hash join on (tg, term), size checked;
                        dynamic partition pruning on tg for a saved index)-->  matched
    matched          --(sum per query, doc; stays in the document partitions)-->
    candidates       --(partial top-k per partition: WindowGroupLimit, or a bounded heap
                        per setting for several settings)-->
    exchange on query (at most k rows per query, setting and partition) --> final top-k

A saved index has its postings in ranges of document numbers: match and sum run range by range,
and the candidates are united.  For a model with bounds of its term scores, a large search of a saved
index sums the rare terms first and matches the frequent ones for those documents alone that can still
be among the best (``best_candidates``): the same hits, without a sum per query and document.

A frequent term never causes a skewed shuffle: postings are never shuffled by term.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankeval.functions.text import query_echo, tokens
from rankeval.functions.topk import greatest_k
from rankeval.operators.index import Index, term_stats
from rankeval.operators.saved import group_of, slot_of, term_group
from rankeval.session import bounded, cut_lineage

# Largest query-term table we broadcast (rows: one per distinct (query, term)).
# A term has at most 255 characters, so this many rows stay far under 100 MB.
MAX_BROADCAST_QUERY_TERMS = 100_000
# Columns of the collection statistics.
COLLECTION = ("n_docs", "n_tokens", "avgdl")
# Most query terms that are handed to a scan as literals.
MAX_TERM_LITERALS = 64
# Matched rows of a search from which on it looks for the documents that can be among the best first.
MIN_BOUNDED_ROWS = 5_000_000
# A query's rare terms have a posting in one of so many documents together, at most; documents that are scored first, times
# the hits asked for.
RARE_PART, FIRST_CUTS = 20, 50
# Scores are kept in single precision: bounds are compared with more room than its rounding takes.
ROOM = 1e-6
# Most (query, document) rows that are broadcast (rows of two numbers: 40 MB in memory, about).
MAX_BROADCAST_PAIRS = 500_000


def select_queries(topics: DataFrame, selector: str | int | tuple[int, int] = "all") -> DataFrame:
    """``all``, a single id, or an inclusive range ``"a-b"`` / ``(a, b)``."""
    if selector == "all" or selector is None:
        return topics
    if isinstance(selector, int):
        return topics.filter(F.col("query_id") == selector)
    if isinstance(selector, tuple):
        a, b = selector
    else:
        text = str(selector).strip()
        if "-" in text:
            a_s, b_s = text.split("-", 1)
            a, b = int(a_s), int(b_s)
        else:
            return topics.filter(F.col("query_id") == int(text))
    if b < a:
        raise ValueError(f"empty query range {a}-{b}")
    return topics.filter(F.col("query_id").between(a, b))


def query_terms(topics: DataFrame, field: str = "text") -> DataFrame:
    """Analysed topic terms with their in-query multiplicity ``qtf``."""
    return (
        topics.select("query_id", F.explode(tokens(F.col("query"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count(F.lit(1)).cast("int").alias("qtf"))
        .withColumn("field", F.lit(field))
    )


def parsed_queries(topics: DataFrame, field: str = "text") -> DataFrame:
    """Topics with their parsed-query echo."""
    return topics.select("query_id", "query", query_echo(tokens(F.col("query")), field).alias("parsed"))


def query_statistics(index: Index, qterms: DataFrame, broadcast_ok: bool, field: str = "text") -> DataFrame:
    """Per (query, term): qtf plus the statistics both models read.

    Rows are bounded by the query-term table, which is the broadcast side of the
    lookup in the term statistics.  The collection statistics of the field are one
    row, read once as a scalar subquery (a join on the constant field would plan as
    a nested-loop join) and kept as one struct column.
    """
    keys = ["term"]
    q = qterms.drop("field")
    if index.grouped:
        keys = ["tg", "term"]
        q = q.withColumn("tg", term_group(F.col("term"), index.bounds.get(field) or []))
    q = F.broadcast(q) if broadcast_ok else q
    if field in index.by_field:
        # Lazily built index: aggregate df / cf for the query terms only.
        tstats = term_stats(index.by_field[field].join(q.select(*keys), keys, "left_semi")).select(*keys, "df", "cf")
    else:
        changed = index.term_changes is not None
        tstats = (index.term_changes if changed else index.terms).filter(F.col("field") == field).select(*keys, "df", "cf")
        if changed:  # changes of several batches: add up those of the query terms
            tstats = (tstats.join(q.select(*keys), keys, "left_semi").groupBy(*keys)
                      .agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter("df > 0"))
    coll = (index.stats.filter(F.col("field") == field)
            .select(F.struct("n_docs", "n_tokens", "avgdl").alias("c")).scalar())
    return tstats.join(q, keys).select(
        F.lit(field).alias("field"), "query_id", *keys, "qtf", "df", "cf", coll.alias("coll"))


def match_ranges(index: Index, qterms: DataFrame, field: str = "text",
                 max_broadcast: int = MAX_BROADCAST_QUERY_TERMS, broadcast_ok: bool | None = None) -> list[DataFrame]:
    """J1 per document range of the index (one for an index in memory), of replaced documents too.

    ``broadcast_ok`` is a caller's proof that the query-term table is small; without
    it the row count is checked here.
    """
    ok = bounded(qterms, max_broadcast) if broadcast_ok is None else broadcast_ok
    qstats = query_statistics(index, qterms, ok, field)
    side = F.broadcast(qstats) if ok else qstats
    return [_matched(p, side, _term_keys(index)) for p in _postings_of(index, qterms, field, ok)]


def _term_keys(index: Index) -> list[str]:
    return ["tg", "term"] if index.grouped else ["term"]


def _postings_of(index: Index, qterms: DataFrame, field: str, ok: bool) -> list[DataFrame]:
    """The field's postings per document range, of the query terms alone where those are few."""
    few = []
    if ok and index.grouped:
        # few terms: as literals they reach the scan, and files sorted by term skip the rest
        few = [r.term for r in qterms.select("term").distinct().limit(MAX_TERM_LITERALS + 1).collect()]
    out = []
    for postings in index.field_ranges(field):
        if 0 < len(few) <= MAX_TERM_LITERALS:
            bounds = index.bounds.get(field) or []
            postings = postings.filter(reduce(or_, [(F.col("tg") == group_of(t, bounds)) & (F.col("term") == t) for t in few]))
        out.append(postings)
    return out


def _matched(postings: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    return postings.join(side.drop("field"), keys).select(
        "*", *[F.col("coll")[c].alias(c) for c in COLLECTION]).drop("coll")


def match(index: Index, qterms: DataFrame, field: str = "text",
          max_broadcast: int = MAX_BROADCAST_QUERY_TERMS, broadcast_ok: bool | None = None) -> DataFrame:
    """Postings of the query terms with everything a model needs (OR semantics)."""
    return index.live(reduce(DataFrame.unionByName, match_ranges(index, qterms, field, max_broadcast, broadcast_ok)))


def score_columns(scorers, length: str = "norm") -> list[tuple[str, float, Column]]:
    """One (model name, parameter, term-score Column) per scorer.

    ``scorers`` is a model instance or a list of ``(model, [params])`` pairs.
    """
    if hasattr(scorers, "term_score"):
        return [(scorers.name, float(scorers.param), scorers.term_score(length=length))]
    out = []
    for model, params in scorers:
        for p in params:
            model.check(p)
            out.append((model.name, float(p), model.term_score(p, length=length)))
    return out


def candidates(index: Index, matched: list[DataFrame], cols: list[tuple[str, float, Column]]) -> DataFrame:
    """Per (query, doc) one sum of term scores per setting: columns s0, s1, ...

    All parameter values are summed side by side in one aggregation, so a sweep never multiplies
    the matched rows.  The sum stays inside the partitions of each document range.
    """
    sums = [F.sum(c).alias(f"s{i}") for i, (_, _, c) in enumerate(cols)]
    return index.live(reduce(DataFrame.unionByName, [m.groupBy("query_id", "ord").agg(*sums) for m in matched]))


def _kept(score: Column) -> Column:
    """The sum is taken in double precision and kept in single precision: a relative precision, so
    frequent terms of a large collection, whose weights are tiny, rank like any other, while
    summation-order noise does not reorder equal scores."""
    return score.cast("float").cast("double")


def top_k(cands: DataFrame, cut: int, runs: int = 1) -> DataFrame:
    """Best ``cut`` documents per setting and query, ties by lower ``ord``: run, query_id, rank, ord, score.

    One setting: ``row_number() <= cut`` is planned as a partial WindowGroupLimit before the exchange
    and a final one after it.  Several: a bounded heap per query and setting, in each partition and
    again behind the exchange, so the candidates are never multiplied by the settings nor sorted for each.
    """
    if cut <= 0:
        raise ValueError("cut must be positive")
    if runs == 1:
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("ord"))
        return (cands.select(F.lit(0).alias("run"), "query_id", "ord", _kept(F.col("s0")).alias("score"))
                .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cut))
    best = [greatest_k(F.struct(_kept(F.col(f"s{i}")).alias("score"), (-F.col("ord")).alias("minus")), cut) for i in range(runs)]
    heaps = cands.groupBy("query_id").agg(*[b.alias(f"b{i}") for i, b in enumerate(best)])
    each = heaps.select("query_id", F.posexplode(F.array(*[F.col(f"b{i}") for i in range(runs)])).alias("run", "hits"))
    hits = each.select("run", "query_id", F.posexplode("hits").alias("place", "hit"))
    return hits.select("run", "query_id", (-F.col("hit.minus")).alias("ord"), F.col("hit.score").alias("score"),
                       (F.col("place") + 1).alias("rank")).filter(F.col("rank") <= cut)


def best_candidates(index: Index, qterms: DataFrame, model, cut: int, field: str = "text", length: str = "norm") -> DataFrame | None:
    """J4 for every document that can be among the best ``cut`` of its query: columns query_id, ord, s0.

    The rare terms of a query are summed for all documents, all its terms for the best documents by that sum.  The ``cut``-th
    best of those scores is reached by ``cut`` documents; as no term score is negative, a document whose sum over the rare terms
    and the bounds of all other terms together stay below it is not a hit, and every other document is summed with all
    terms.  Where the bounds of the other terms alone reach it, those are all documents of the query.

    ``qterms`` can be broadcast.  None where that saves nothing or no bound holds: for a model without bounds, an index that is
    not saved, a small search, or a term with more postings than there are documents (texts under one number).
    """
    if not index.ranges or not hasattr(model, "term_bound"):
        return None
    rarest = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, 0)
    stats = cut_lineage(query_statistics(index, qterms, True, field).withColumn(
        "rare", F.sum("df").over(rarest) * RARE_PART <= F.col("coll.n_docs")))
    rows, few_enough = stats.agg(F.sum("df"), F.bool_and(F.col("df") <= F.col("coll.n_docs"))).first()
    if not few_enough or rows < MIN_BOUNDED_ROWS:
        return None
    # every text under a number may have a posting of a term
    texts = index.docs.filter("ord is not null").groupBy("ord").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    bound = F.when(F.col("rare"), 0.0).otherwise(model.term_bound()) * F.lit(texts or 1)
    rest = stats.withColumns({c: F.col("coll")[c] for c in COLLECTION}).groupBy("query_id").agg(F.sum(bound).alias("rest"))
    cols, keys, postings = score_columns(model, length), _term_keys(index), _postings_of(index, qterms, field, True)

    def of_terms(terms: DataFrame) -> DataFrame:
        return candidates(index, [_matched(p, F.broadcast(terms.drop("rare")), keys) for p in postings], cols)

    def of_pairs(pairs: DataFrame) -> DataFrame:
        side = F.broadcast(pairs) if bounded(pairs, MAX_BROADCAST_PAIRS) else pairs
        terms = F.broadcast(stats.drop("rare"))
        return candidates(index, [_matched(p.join(side, "ord"), terms, ["query_id", *keys]) for p in postings], cols)

    rare = cut_lineage(of_terms(stats.filter("rare")))
    first = cut_lineage(top_k(rare, FIRST_CUTS * cut).select("query_id", "ord"))
    scored = cut_lineage(of_pairs(first))
    reached = top_k(scored, cut).filter(F.col("rank") == cut).select("query_id", (F.col("score") * F.lit(1 - ROOM)).alias("reached"))
    limits = cut_lineage(reached.join(rest, "query_id").filter("rest < reached"))  # a row per query at most
    out = scored.join(F.broadcast(limits.select("query_id")), "query_id", "left_semi")
    more = cut_lineage(rare.join(F.broadcast(limits), "query_id").filter(F.col("s0") + F.col("rest") >= F.col("reached"))
                       .select("query_id", "ord").join(first, ["query_id", "ord"], "left_anti"))
    if not more.isEmpty():
        out = out.unionByName(of_pairs(more))
    others = cut_lineage(stats.join(F.broadcast(limits), "query_id", "left_anti"))
    return out if others.isEmpty() else out.unionByName(of_terms(others.select(stats.columns)))


def label_runs(hits: DataFrame, cols: list[tuple[str, float, Column]]) -> DataFrame:
    """Replace the integer ``run`` by its ``model`` name and ``param`` value."""
    models = F.array(*[F.lit(m) for m, _, _ in cols])
    params = F.array(*[F.lit(float(p)) for _, p, _ in cols])
    idx = F.col("run") + 1
    return hits.select(F.element_at(models, idx).alias("model"), F.element_at(params, idx).alias("param"),
                       *[c for c in hits.columns if c != "run"])


def search(index: Index, topics: DataFrame, model, cut: int = 10, field: str = "text",
           length: str = "norm", broadcast_ok: bool | None = None) -> DataFrame:
    """Rank documents for every topic: ``query_id, rank, ord, score``.

    ``model`` is a model instance, or a list of ``(model, params)`` for a sweep, in
    which case the output also carries ``model`` and ``param``.
    """
    qterms = query_terms(topics, field)
    ok = bounded(qterms, MAX_BROADCAST_QUERY_TERMS) if broadcast_ok is None else broadcast_ok
    cols = score_columns(model, length)
    cands = best_candidates(index, qterms, model, cut, field, length) if ok else None
    if cands is None:
        cands = candidates(index, match_ranges(index, qterms, field, broadcast_ok=ok), cols)
    hits = top_k(cands, cut, len(cols))
    if hasattr(model, "term_score"):
        return hits.select("query_id", "rank", "ord", "score")
    return label_runs(hits, cols).select("model", "param", "query_id", "rank", "ord", "score")


def look_up(docs: DataFrame, hits: DataFrame, columns, small: bool = False) -> DataFrame:
    """Stored columns of the hits' documents.

    Stored documents of a saved index lie in directories by slot (``ord div`` the documents per slot).  The distinct
    slots of the hits (at most as many as the index has) are broadcast and prune them at run time, whatever the number
    of hits; the hits are pinned first, so that both uses of them are one computation.  ``small``: a proof (from
    ``evaluate.hits_bounded``) that the hits themselves can be broadcast.
    """
    layout = docs.schema["slot"].metadata if "slot" in docs.columns else {"slots": 1}
    if layout["slots"] == 1:
        return docs.select("ord", *columns).join(F.broadcast(hits) if small else hits, "ord")
    hits = cut_lineage(hits.withColumn("slot", slot_of(layout["docs"])))
    # the filter holds for all of them; the planner prunes by a side only if that has one
    slots = F.broadcast(hits.select("slot").distinct().filter("slot is not null and slot >= 0"))
    stored = docs.select("slot", "ord", *columns).join(slots, "slot", "left_semi")
    return stored.join(F.broadcast(hits) if small else hits, ["slot", "ord"]).drop("slot")


def fetch_hits(hits: DataFrame, docs: DataFrame, top: int | None = None,
               fields=("id", "title", "text", "url", "pubmedId"), broadcast_ok: bool = False) -> DataFrame:
    """J6 + J7: keep ranks <= ``top`` and attach stored fields (``look_up``)."""
    h = hits if top is None else hits.filter(F.col("rank") <= top)
    return look_up(docs, h, fields, broadcast_ok)
