"""DuckDB SQL for every named query, over the pre-registered raw tables.

Written independently of the Spark code: plain SQL, brute force where that is
simpler (e.g. judgments by testing every document against every passage).
"""

from __future__ import annotations

from rankeval.functions import text as T
from rankeval.plans import named as N
from rankeval.operators.tune import K1_GRID, LAMBDA_GRID

# The same word rules for a matcher without look-around, intersections or possessive quantifiers.
_E = r"(?:\p{M}|[^\P{Cf}\x{200B}])*"
_NOT = r"\p{Han}\p{Hiragana}\p{Katakana}" + T.KATAKANA_MARKS + "".join(rf"\p{{{x}}}" for x in T.WITHOUT_SPACES)
_LETTER = rf"(?:[^\P{{L}}{_NOT}]|[^\P{{Nl}}\p{{Han}}]|[{T.CIRCLED}]){_E}"
_HEBREW = rf"[^\P{{L}}\P{{Hebrew}}]{_E}"
_UNIT = rf"(?:{_HEBREW}(?:\"{_E}{_HEBREW})*'?|{_LETTER})"
_LETTERS = rf"{_UNIT}(?:(?:[{T.MID_LETTER}{T.MID_BOTH}]{_E})?{_UNIT})*"
_DIGITS = rf"\p{{Nd}}{_E}(?:(?:[{T.MID_NUMBER}{T.MID_BOTH}]{_E})?\p{{Nd}}{_E})*"
_WORD = rf"(?:(?:{_LETTERS}|{_DIGITS})+|(?:[\p{{Katakana}}{T.KATAKANA_MARKS}]{_E})+)"
_JOIN = rf"(?:[\p{{Pc}}\x{{202F}}]{_E})"
_ONE = rf"[{T.EMOJI}](?:[\x{{1F3FB}}-\x{{1F3FF}}]|\p{{M}}|[^\P{{Cf}}\x{{200B}}\x{{200D}}])*"
_EMOJI = rf"(?:[0-9#*]\x{{FE0F}}?\x{{20E3}}|[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|{_ONE}(?:\x{{200D}}+{_ONE})*){_E}"
_SPACELESS = "|".join(rf"[^\P{{L}}\P{{{x}}}]" for x in T.WITHOUT_SPACES)
_PATTERN = (rf"{_EMOJI}|[\p{{Han}}\p{{Hiragana}}]{_E}|(?:(?:{_SPACELESS}){_E})+"
            rf"|{_JOIN}*{_WORD}(?:{_JOIN}+{_WORD})*{_JOIN}*|{_JOIN}+")
RUNS = "regexp_extract_all(lower(coalesce({x}, '')), '" + _PATTERN.replace("'", "''").replace("{", "{{").replace("}", "}}") + "')"


def tok(x: str) -> str:
    """Word runs, each run longer than 255 characters cut into 255-character pieces."""
    runs = RUNS.format(x=x)
    return (f"flatten(list_transform({runs}, lambda w: CASE WHEN length(w) <= 255 THEN [w] ELSE "
            f"list_transform(range(0, (length(w) + 254) // 255), lambda i: substr(w, i * 255 + 1, 255)) END))")


def norm(dl: str) -> str:
    x = f"({dl} - 24)"
    s = f"greatest(length(bin({x})) - 4, 0)"
    return f"(CASE WHEN {dl} < 24 THEN {dl} ELSE 24 + (({x} >> {s}) << {s}) END)"


BASE = f"""
corpus AS (
  SELECT doc_id AS ord, doc_id AS id,
         concat_ws(' ', source, lang) AS title,
         text, source AS url, lang AS pubmedId
  FROM documents),
toks AS (
  SELECT 'text' AS field, ord, {tok('text')} AS tk FROM corpus
  UNION ALL
  SELECT 'title' AS field, ord, {tok('title')} AS tk FROM corpus),
lengths AS (
  SELECT field, ord, len(tk)::BIGINT AS dl, {norm('len(tk)::BIGINT')}::BIGINT AS norm FROM toks WHERE len(tk) > 0),
postings AS (
  SELECT field, term, ord, count(*)::BIGINT AS tf, dl, norm
  FROM (SELECT t.field, t.ord, unnest(t.tk) AS term, l.dl, l.norm
        FROM toks t JOIN lengths l ON l.field = t.field AND l.ord = t.ord)
  GROUP BY field, term, ord, dl, norm),
terms AS (SELECT field, term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS cf FROM postings GROUP BY field, term),
stats AS (SELECT field, count(*)::BIGINT AS n_docs, sum(dl)::BIGINT AS n_tokens, avg(dl::DOUBLE) AS avgdl
          FROM lengths GROUP BY field),
topics AS (
  SELECT item_id AS query_id, text AS query FROM benchmark),
qterms AS (
  SELECT query_id, term, count(*)::BIGINT AS qtf
  FROM (SELECT query_id, unnest({tok('query')}) AS term FROM topics) GROUP BY query_id, term),
qrels AS (
  SELECT query_id, doc_id, CASE WHEN got = need AND contains(run, passage) THEN 2 WHEN got * 4 >= need * 3 THEN 1 ELSE 0 END AS score
  FROM (
    SELECT b.item_id AS query_id, d.id AS doc_id, len(b.terms) AS need, len(list_intersect(b.terms, d.terms)) AS got,
           d.run, b.passage
    FROM (SELECT item_id, list_distinct({tok('text')}) AS terms, ' ' || array_to_string({tok('text')}, ' ') || ' ' AS passage
          FROM benchmark) b,
         (SELECT id, list_distinct({tok('text')}) AS terms, ' ' || array_to_string({tok('text')}, ' ') || ' ' AS run
          FROM corpus) d)
  WHERE need > 0 AND got * 2 >= need),
qpos AS (SELECT DISTINCT query_id, doc_id FROM qrels WHERE score > 0),
nrel AS (SELECT query_id, count(*)::BIGINT AS n_relevant FROM qpos GROUP BY query_id),
matched AS (
  SELECT q.query_id, p.term, p.ord, p.tf, p.dl, p.norm, q.qtf, t.df, t.cf, s.n_docs, s.n_tokens, s.avgdl
  FROM postings p
  JOIN qterms q ON q.term = p.term
  JOIN terms t ON t.field = p.field AND t.term = p.term
  JOIN stats s ON s.field = p.field
  WHERE p.field = 'text')"""


#: The same collection after the append: revised documents and new ones under numbers after the others.
LIVE_BASE = BASE.replace("""  FROM documents),
toks""", """  FROM (
    SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text || ' revised' ELSE text END AS text, source, lang FROM documents
    UNION ALL SELECT doc_id + 10000000, text, source, lang FROM documents WHERE doc_id % 100 = 1)),
toks""")


def bm25(k1) -> str:
    return (f"qtf * ln(1.0::DOUBLE + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf::DOUBLE"
            f" / (tf::DOUBLE + {float(k1)!r}::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * norm::DOUBLE / avgdl))")


def jm(lam) -> str:
    lam = f"{float(lam)!r}::DOUBLE"
    return (f"qtf * ln(1.0::DOUBLE + ((1.0::DOUBLE - {lam}) * tf::DOUBLE / norm::DOUBLE)"
            f" / ({lam} * ((cf + 1.0::DOUBLE) / (n_tokens + 1.0::DOUBLE))))")


def hits_cte(name: str, expr: str, model: str = "", param: float = 0.0, topics: str = "topics",
             cut: int = N.CUT) -> str:
    """Top-cut hits of one model setting: model, param, query_id, rank, ord, score."""
    return f"""{name} AS (
  SELECT '{model}' AS model, {float(param)!r}::DOUBLE AS param, query_id,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ord ASC)::BIGINT AS rank, ord, score
  FROM (SELECT m.query_id, m.ord, sum({expr})::FLOAT::DOUBLE AS score
        FROM matched m WHERE m.query_id IN (SELECT query_id FROM {topics}) GROUP BY m.query_id, m.ord)
  QUALIFY rank <= {cut})"""


def judged_cte(name: str, hits: str) -> str:
    return f"""{name} AS (
  SELECT h.*, c.id, (qp.doc_id IS NOT NULL) AS rel
  FROM {hits} h JOIN corpus c ON c.ord = h.ord
  LEFT JOIN qpos qp ON qp.query_id = h.query_id AND qp.doc_id = c.id)"""


def metrics_cte(name: str, judged: str, topics: str = "topics", precision: str = "double",
                runs: str | None = None) -> str:
    """Per (model, param, query) metrics; ``runs`` is a CTE of (model, param) rows."""
    runs_join = f"CROSS JOIN {runs} r" if runs else "CROSS JOIN (SELECT DISTINCT model, param FROM " + judged + ") r"
    if precision == "float":
        agg = f"""SELECT model, param, query_id, count(*) AS n_hits, sum(rel::INT) AS n_rel,
                min(CASE WHEN rel THEN rank END) AS first_rel,
                list_reduce(list(prec ORDER BY rank) FILTER (WHERE rel), lambda a, x: (a + x)::FLOAT, 0::FLOAT) AS ap_sum
              FROM (SELECT *, ((sum(rel::INT) OVER (PARTITION BY model, param, query_id ORDER BY rank
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE / rank)::FLOAT AS prec FROM {judged})
              GROUP BY model, param, query_id"""
        rr = "(1.0::DOUBLE / a.first_rel)::FLOAT::DOUBLE"
        ap = "(a.ap_sum::DOUBLE / a.n_rel)::FLOAT::DOUBLE"
        p = "(coalesce(a.n_rel, 0)::DOUBLE / a.n_hits)::FLOAT::DOUBLE"
        rc = "(coalesce(a.n_rel, 0)::DOUBLE / nr.n_relevant)::FLOAT::DOUBLE"
    else:
        agg = f"""SELECT model, param, query_id, count(*) AS n_hits, sum(rel::INT) AS n_rel,
                min(CASE WHEN rel THEN rank END) AS first_rel,
                sum(CASE WHEN rel THEN prec END) AS ap_sum
              FROM (SELECT *, (sum(rel::INT) OVER (PARTITION BY model, param, query_id ORDER BY rank
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::DOUBLE / rank AS prec FROM {judged})
              GROUP BY model, param, query_id"""
        rr = "1.0::DOUBLE / a.first_rel"
        ap = "a.ap_sum / a.n_rel"
        p = "coalesce(a.n_rel, 0)::DOUBLE / a.n_hits"
        rc = "coalesce(a.n_rel, 0)::DOUBLE / nr.n_relevant"
    return f"""{name} AS (
  SELECT r.model, r.param, t.query_id,
    CASE WHEN len({tok('t.query')}) = 0 THEN 0.0 WHEN a.first_rel IS NOT NULL THEN {rr} ELSE 0.0 END AS rr,
    CASE WHEN len({tok('t.query')}) = 0 THEN 0.0 WHEN coalesce(a.n_rel, 0) > 0 THEN {ap} ELSE 0.0 END AS ap,
    CASE WHEN len({tok('t.query')}) = 0 THEN 0.0 WHEN coalesce(a.n_hits, 0) > 0 THEN {p} ELSE 'NaN'::DOUBLE END AS p,
    CASE WHEN len({tok('t.query')}) = 0 THEN 0.0 WHEN coalesce(nr.n_relevant, 0) > 0 THEN {rc} ELSE 'NaN'::DOUBLE END AS recall,
    {N.CUT}::BIGINT AS cut
  FROM {topics} t {runs_join}
  LEFT JOIN ({agg}) a ON a.query_id = t.query_id AND a.model = r.model AND a.param = r.param
  LEFT JOIN nrel nr ON nr.query_id = t.query_id)"""


def nz(c: str) -> str:
    return f"coalesce(avg(CASE WHEN NOT isnan({c}) AND {c} > 0 THEN {c} END), 'NaN'::DOUBLE)"


def q(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n" + body


def r9(c: str, alias: str | None = None, d: int = 9) -> str:
    return f"round({c}, {d}) AS {alias or c}"


M4 = ", ".join(r9(c) for c in ("rr", "ap", "p", "recall"))

_MIDDLE = "(SELECT (min(query_id) + max(query_id)) // 2 FROM topics)"
TRAIN = f"train AS (SELECT * FROM topics WHERE query_id <= {_MIDDLE})"
TEST = f"test AS (SELECT * FROM topics WHERE query_id > {_MIDDLE})"


def grid_ctes(model: str, grid, topics: str, precision: str = "float", prefix: str = "g") -> tuple[list[str], str]:
    ctes, parts = [], []
    for i, v in enumerate(grid):
        expr = bm25(v) if model == "bm25" else jm(v)
        ctes.append(hits_cte(f"{prefix}h{i}", expr, model, v, topics))
        parts.append(f"SELECT * FROM {prefix}h{i}")
    ctes.append(f"{prefix}hits AS ({' UNION ALL '.join(parts)})")
    ctes.append(f"{prefix}runs AS (SELECT * FROM (VALUES "
                + ", ".join(f"('{model}', {float(v)!r}::DOUBLE)" for v in grid) + ") v(model, param))")
    ctes.append(judged_cte(f"{prefix}judged", f"{prefix}hits"))
    ctes.append(metrics_cte(f"{prefix}metrics", f"{prefix}judged", topics, precision, f"{prefix}runs"))
    return ctes, f"{prefix}metrics"


def _runs_sql(pairs: str = f"a.run = '{N.BASELINE_RUN}' AND b.run <> '{N.BASELINE_RUN}'") -> tuple[list[str], str]:
    ctes, parts = [], []
    for m, grid in N.RUNS:
        c, name = grid_ctes(m.name, grid, "topics", "double", prefix=m.name)
        ctes += c
        parts.append(f"SELECT model || ':' || param::VARCHAR AS run, query_id::BIGINT AS query_id, ap AS value FROM {name}")
        wanted = ", ".join(f"'{x}'" for x in N.RECALL_RUNS)
        parts.append(f"SELECT model || ':' || param::VARCHAR || ':recall', query_id::BIGINT, recall FROM {name} "
                     f"WHERE model || param::VARCHAR IN ({wanted})")
    ctes.append(f"runs AS ({' UNION ALL '.join(parts)})")
    return [*ctes, *_tests_sql(pairs)], "runs"


def _tests_sql(pairs: str) -> list[str]:
    """Both tests over the CTE runs(run, query_id, value), for the pairs a, b that the condition tells."""
    ctes = []
    ctes.append(f"""paired AS (
  SELECT a.run AS run_a, b.run AS run_b, a.query_id, a.value AS x, b.value AS y
  FROM runs a JOIN runs b ON a.query_id = b.query_id
  WHERE {pairs})""")
    ctes.append("""ranks AS (
  SELECT run_a, run_b, query_id, y - x AS d,
    (rank() OVER (PARTITION BY run_a, run_b ORDER BY abs(y - x)))
    + (count(*) OVER (PARTITION BY run_a, run_b, abs(y - x)) - 1) / 2.0 AS rnk
  FROM paired)""")
    ctes.append("""wsr AS (
  SELECT run_a, run_b, count(*) AS n, coalesce(sum(CASE WHEN d > 0 AND NOT isnan(d) THEN rnk END), 0)::DOUBLE AS w_plus
  FROM ranks GROUP BY run_a, run_b)""")
    ctes.append("""wsr2 AS (
  SELECT *, greatest(w_plus, n * (n + 1) / 2.0 - w_plus) AS w_max,
    list_reduce(range(1, n + 1),
      lambda c, j: list_transform(c, lambda v, s: v + CASE WHEN s - 1 >= j THEN c[s - j] ELSE 0 END),
      list_transform(range(0, (n * (n + 1) / 2)::BIGINT + 1), lambda s: CASE WHEN s = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
    ) AS dist
  FROM wsr)""")
    ctes.append("""wilcox AS (
  SELECT run_a, run_b, n, w_plus, w_max,
    2.0 * list_sum(list_filter(list_transform(dist, lambda v, s: CASE WHEN s - 1 >= w_max THEN v ELSE 0 END), lambda v: v > 0))
      / pow(2.0, n) AS p
  FROM wsr2)""")
    ctes.append("""welch0 AS (
  SELECT run_a, run_b, count(x) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS vx, var_samp(y) AS vy
  FROM paired GROUP BY run_a, run_b)""")
    ctes.append("""welch1 AS (
  SELECT run_a, run_b, n,
    CASE WHEN n >= 2 AND vx / n + vy / n > 0 THEN (mx - my) / sqrt(vx / n + vy / n) ELSE 'NaN'::DOUBLE END AS t,
    CASE WHEN n >= 2 AND vx / n + vy / n > 0
      THEN pow(vx / n + vy / n, 2) / (pow(vx / n, 2) / (n - 1) + pow(vy / n, 2) / (n - 1)) ELSE 'NaN'::DOUBLE END AS df
  FROM welch0)""")
    ctes.append("""welch AS (
  SELECT run_a, run_b, n, t, df,
    CASE WHEN isnan(t) THEN 'NaN'::DOUBLE ELSE
      (SELECT sum(CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                  * pow(sin(i * asin(sqrt(df / (df + t * t))) / 2000.0), df - 1))
       FROM range(0, 2001) r(i)) * asin(sqrt(df / (df + t * t)))
      / ((SELECT sum(CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                  * pow(sin(i * (pi() / 2) / 2000.0), df - 1))
       FROM range(0, 2001) r(i)) * (pi() / 2)) END AS p
  FROM welch1)""")
    return ctes


def _sql() -> dict[str, str]:
    bm = hits_cte("hits", bm25(N.BM25_K1), "bm25", N.BM25_K1)
    jmh = hits_cte("hits", jm(N.JM_LAMBDA), "jm", N.JM_LAMBDA)
    judged = judged_cte("judged", "hits")
    met = metrics_cte("metrics", "judged")
    met_f = metrics_cte("metrics", "judged", precision="float")
    out: dict[str, str] = {}
    out["docs_flatten"] = q(body="SELECT id::VARCHAR AS id, title, text, url, pubmedId FROM corpus")
    out["tokenize"] = q(body=f"SELECT ord::BIGINT AS ord, len({tok('text')})::BIGINT AS dl, "
                             f"array_to_string({tok('text')}, ' ') AS terms FROM corpus")
    out["tokenize_classes"] = (f"SELECT ord, {tok('sample')} AS words FROM (SELECT doc_id::BIGINT AS ord, replace(replace(replace("
                               f"replace('{N.CLASS_SAMPLE}', '%n', doc_id::VARCHAR), '%c', n_chars::VARCHAR), '%l', coalesce(lang, '')), "
                               f"'%s', coalesce(source, '')) AS sample FROM documents)")
    out["query_terms"] = q(body="SELECT query_id::BIGINT AS query_id, term, qtf FROM qterms")
    out["query_echo"] = q(body=f"SELECT query_id::BIGINT AS query_id, query, "
                               f"array_to_string(list_transform({tok('query')}, lambda t: 'text:' || t), ' ') AS parsed FROM topics")
    out["term_freq"] = q(body="SELECT field, term, ord::BIGINT AS ord, tf FROM postings")
    out["doc_length"] = q(body="SELECT field, ord::BIGINT AS ord, dl FROM lengths")
    out["length_norm"] = q(body="SELECT field, ord::BIGINT AS ord, dl, norm FROM lengths")
    out["term_stats"] = q(body="SELECT field, term, df, cf FROM terms")
    out["collection_stats"] = q(body="SELECT field, n_docs, n_tokens, round(avgdl, 9) AS avgdl FROM stats")
    out["query_select_one"] = q(body=f"SELECT query_id::BIGINT AS query_id, query FROM topics WHERE query_id = {N.ONE_QUERY}")
    a, b = N.QUERY_RANGE.split("-")
    out["query_select_range"] = q(body=f"SELECT query_id::BIGINT AS query_id, query FROM topics "
                                       f"WHERE query_id BETWEEN {a} AND {b}")
    out["qrels_derived"] = q(body="SELECT query_id::BIGINT AS query_id, doc_id::BIGINT AS doc_id, score::BIGINT AS score FROM qrels")
    out["qrels_positive"] = q(body="SELECT query_id::BIGINT AS query_id, doc_id::BIGINT AS doc_id FROM qpos")
    out["relevant_per_query"] = q(body="SELECT query_id::BIGINT AS query_id, n_relevant FROM nrel")
    out["or_match"] = q(body="SELECT query_id::BIGINT AS query_id, term, ord::BIGINT AS ord, tf, qtf FROM matched")
    out["bm25_topk"] = q(bm, body="SELECT query_id::BIGINT AS query_id, rank, ord::BIGINT AS ord, score FROM hits")
    out["jm_topk"] = q(jmh, body="SELECT query_id::BIGINT AS query_id, rank, ord::BIGINT AS ord, score FROM hits")
    out["judged_hits"] = q(bm, judged, body="SELECT query_id::BIGINT AS query_id, rank, ord::BIGINT AS ord, "
                                          "id::BIGINT AS id, score, rel FROM judged")
    out["hits_top_m"] = q(bm, judged, body=f"""SELECT j.query_id::BIGINT AS query_id, j.rank, j.id::BIGINT AS id,
        c.title, c.url, c.pubmedId, j.score, CASE WHEN j.rel THEN 'Yes' ELSE 'No' END AS relevant
        FROM judged j JOIN corpus c ON c.ord = j.ord WHERE j.rank <= {N.TOP}""")
    out["precision_at_rank"] = q(bm, judged, body="""SELECT query_id::BIGINT AS query_id, rank,
        (sum(rel::INT) OVER w)::BIGINT AS rel_so_far, round((sum(rel::INT) OVER w)::DOUBLE / rank, 9) AS precision
        FROM judged WINDOW w AS (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
    mout = f"SELECT query_id::BIGINT AS query_id, {M4}, cut FROM metrics"
    out["metrics_bm25"] = q(bm, judged, met, body=mout)
    out["metrics_jm"] = q(jmh, judged, met, body=mout)
    out["metrics_float"] = q(jmh, judged, met_f, body=mout)
    out["metrics_long"] = q(bm, judged, met, body=" UNION ALL ".join(
        f"SELECT query_id::BIGINT AS query_id, '{k}' AS metric, round({v}, 9) AS value FROM metrics"
        for k, v in (("MRR", "rr"), ("MAP", "ap"), ("P", "p"), ("R", "recall"))))
    out["mean_nonzero"] = q(bm, judged, met, body="SELECT " + ", ".join(
        f"round({nz(c)}, 9) AS {c}" for c in ("rr", "ap", "p", "recall")) + ", max(cut) AS cut FROM metrics")
    out["metrics_with_mean_row"] = q(bm, judged, met, body=f"""
        SELECT query_id::VARCHAR AS query, {M4}, cut FROM metrics
        UNION ALL
        SELECT '-' AS query, """ + ", ".join(f"round({nz(c)}, 9) AS {c}" for c in ("rr", "ap", "p", "recall"))
        + ", max(cut) AS cut FROM metrics")
    k_ctes, k_m = grid_ctes("bm25", K1_GRID, "train", prefix="k")
    l_ctes, l_m = grid_ctes("jm", LAMBDA_GRID, "train", prefix="l")
    sw = f"SELECT model, param, query_id::BIGINT AS query_id, {M4}, cut FROM {{m}}"
    out["sweep_k1"] = q(TRAIN, *k_ctes, body=sw.format(m=k_m))
    out["sweep_lambda"] = q(TRAIN, *l_ctes, body=sw.format(m=l_m))
    names = {"MRR": "rr", "MAP": "ap", "P": "p", "R": "recall"}

    def means_cte(src: str, name: str = "means") -> str:
        parts = [f"SELECT model, '{k}' AS metric, param, {nz(v)} AS mean FROM {src} GROUP BY model, param"
                 for k, v in names.items()]
        return f"{name} AS ({' UNION ALL '.join(parts)})"

    out["sweep_means"] = q(TRAIN, *k_ctes, *l_ctes, f"allm AS (SELECT * FROM {k_m} UNION ALL SELECT * FROM {l_m})",
                           means_cte("allm"), body="SELECT model, metric, param, round(mean, 9) AS mean FROM means")
    best_body = """SELECT model, metric, param, round(mean, 9) AS mean FROM (
        SELECT *, row_number() OVER (PARTITION BY model, metric ORDER BY mean DESC, param ASC) AS rn
        FROM means WHERE NOT isnan(mean) AND mean > 0) WHERE rn = 1"""
    out["best_k1"] = q(TRAIN, *k_ctes, means_cte(k_m), body=best_body)
    out["best_lambda"] = q(TRAIN, *l_ctes, means_cte(l_m), body=best_body)
    labels = [str(g) for g in LAMBDA_GRID]
    cols = ", ".join(f"round(max(CASE WHEN param = {g!r}::DOUBLE THEN ap END), 9) AS \"{lab}\""
                     for g, lab in zip(LAMBDA_GRID, labels))
    mcols = ", ".join(f"round(max(CASE WHEN param = {g!r}::DOUBLE THEN mean END), 9) AS \"{lab}\""
                      for g, lab in zip(LAMBDA_GRID, labels))
    out["sweep_wide"] = q(TRAIN, *l_ctes, means_cte(l_m), body=f"""
        SELECT 'MAP' AS metric, query_id::VARCHAR AS query, max(cut) AS cut, {cols} FROM {l_m} GROUP BY query_id
        UNION ALL
        SELECT 'MAP' AS metric, '-' AS query, {N.CUT}::BIGINT AS cut, {mcols} FROM means WHERE metric = 'MAP'""")
    # Best lambda on train, then the test topics at that lambda (all grid values, pick the best).
    t_ctes, t_m = grid_ctes("jm", LAMBDA_GRID, "test", prefix="t")
    out["test_split_eval"] = q(TRAIN, TEST, *l_ctes, means_cte(l_m), *t_ctes, f"""best AS (
        SELECT param FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, param ASC) AS rn FROM means
        WHERE metric = 'MAP' AND NOT isnan(mean) AND mean > 0) WHERE rn = 1)""",
        body=f"SELECT query_id::BIGINT AS query_id, round(ap, 9) AS value FROM {t_m} WHERE param = (SELECT param FROM best)")
    out["upsert_last_wins"] = q(f"""batch AS (
        SELECT id, concat(text, ' revised') AS text FROM corpus WHERE id % 10 = 0
        UNION ALL SELECT id + 10000000 AS id, text FROM corpus WHERE id % 100 = 1),
      live AS (SELECT id, text FROM corpus WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT id, text FROM batch)""",
        body=f"SELECT id::BIGINT AS id, sha256(text) AS text_sha256, len({tok('text')})::BIGINT AS dl FROM live")
    live = """batch AS (
        SELECT id, title, concat(text, ' revised') AS text, url, pubmedId FROM corpus WHERE id % 10 = 0
        UNION ALL SELECT id + 10000000 AS id, title, text, url, pubmedId FROM corpus WHERE id % 100 = 1),
      live AS (SELECT id, title, text, url, pubmedId FROM corpus WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT * FROM batch)"""
    words = f"""words AS (
        SELECT field, id, unnest(tk) AS term FROM (SELECT 'text' AS field, id, {tok('text')} AS tk FROM live
                                                   UNION ALL SELECT 'title', id, {tok('title')} FROM live))"""
    out["append_docs"] = q(live, body="SELECT id::BIGINT AS id, title, url, pubmedId, length(text)::BIGINT AS n_chars, "
                                      "sha256(text) AS text_sha256 FROM live")
    out["append_terms"] = q(live, words, body="SELECT field, term, count(DISTINCT id)::BIGINT AS df, count(*)::BIGINT AS cf "
                                              "FROM words GROUP BY field, term")
    out["append_stats"] = q(live, words, body="SELECT field, count(DISTINCT id)::BIGINT AS n_docs, count(*)::BIGINT AS n_tokens, "
                                              "round(count(*) / count(DISTINCT id), 9) AS avgdl FROM words GROUP BY field")
    # the collection's own search SQL, over the live documents: which number breaks a tie is the index's own affair
    lived = q(bm, body="SELECT query_id::BIGINT AS query_id, rank, score FROM hits").replace(BASE, LIVE_BASE)
    out["append_search"] = lived
    out["topics_file"] = q(body="SELECT query_id::BIGINT AS query_id, query FROM topics")
    out["qrels_file"] = out["qrels_derived"]
    out["metrics_file"] = out["metrics_with_mean_row"]
    out["sweep_file"] = out["sweep_wide"]
    out["test_file"] = out["test_split_eval"].replace("SELECT query_id::BIGINT AS query_id, round(ap", "SELECT 'jm' AS run, 'MAP' AS metric, query_id::BIGINT AS query_id, round(ap")
    def millionths(x: str) -> str:
        return f"CASE WHEN isnan({x}) THEN 'NaN' ELSE round({x} * 1000000)::BIGINT::VARCHAR END"

    figures = " || ' ' || ".join(millionths(f"m.{c}") for c in ("rr", "ap", "p", "recall"))
    out["hits_file"] = q(bm, judged, met, f"""shown AS (
        SELECT j.id, c.title, c.text, c.url, c.pubmedId, j.score, j.rel FROM judged j JOIN corpus c ON c.ord = j.ord WHERE j.rank <= {N.TOP}),
      means AS (SELECT {", ".join(f"{nz(c)} AS {c}" for c in ("rr", "ap", "p", "recall"))} FROM metrics),
      lines AS (SELECT 'Document with id: ' || id AS value FROM shown
        UNION ALL SELECT 'Title: ' || coalesce(title, 'null') FROM shown
        UNION ALL SELECT unnest(string_split('Text: ' || coalesce(text, 'null'), chr(10))) FROM shown
        UNION ALL SELECT 'Url: ' || coalesce(url, 'null') FROM shown UNION ALL SELECT 'PubmedId: ' || coalesce(pubmedId, 'null') FROM shown
        UNION ALL SELECT 'Score ' || {millionths("score")} FROM shown
        UNION ALL SELECT 'Relevant: ' || CASE WHEN rel THEN 'Yes' ELSE 'No' END FROM shown UNION ALL SELECT '' FROM shown
        UNION ALL SELECT unnest(['{"-" * 71}', '', '']) FROM topics
        UNION ALL SELECT unnest(string_split('Query: ' || query, chr(10))) FROM topics
        UNION ALL SELECT 'Parsed query: ' || array_to_string(list_transform({tok('query')}, lambda t: 'text:' || t), ' ') FROM topics
        UNION ALL SELECT 'Metrics  ' || {figures} FROM metrics m UNION ALL SELECT '' FROM metrics
        UNION ALL SELECT 'MRR ' || {millionths("rr")} FROM means UNION ALL SELECT 'M@P ' || {millionths("ap")} FROM means
        UNION ALL SELECT 'Recall@N ' || {millionths("recall")} FROM means UNION ALL SELECT 'P@N ' || {millionths("p")} FROM means)""",
        body="SELECT value, count(*)::BIGINT AS n FROM lines GROUP BY value")
    out["create_keeps_dups"] = q(f"""dup AS (SELECT * FROM corpus UNION ALL SELECT * FROM corpus WHERE id % 20 = 0),
      dlen AS (SELECT 'text' AS field, len({tok('text')}) AS dl FROM dup UNION ALL
               SELECT 'title' AS field, len({tok('title')}) AS dl FROM dup)""",
        body="SELECT field, count(*)::BIGINT AS n_docs, sum(dl)::BIGINT AS n_tokens, round(avg(dl::DOUBLE), 9) AS avgdl "
             "FROM dlen WHERE dl > 0 GROUP BY field")
    r_ctes, _ = _runs_sql()
    out["run_pairs"] = q(*r_ctes, body="SELECT run_a, run_b, query_id, round(x, 9) AS x, round(y, 9) AS y FROM paired")
    out["welch_t"] = q(*r_ctes, body="SELECT run_a, run_b, n::BIGINT AS n, round(t, 6) AS t, round(df, 6) AS df, "
                                     "round(p, 6) AS p FROM welch")
    out["signed_ranks"] = q(*r_ctes, body="SELECT run_a, run_b, query_id, round(d, 9) AS d, round(rnk, 9) AS rank FROM ranks")
    out["wilcoxon_exact"] = q(*r_ctes, body="SELECT run_a, run_b, n::BIGINT AS n, round(w_plus, 9) AS w_plus, "
                                            "round(w_max, 9) AS w_max, round(p, 9) AS p FROM wilcox")
    out["compare_decision"] = q(*r_ctes, body=f"""
        SELECT run_a, run_b, 't' AS test, n::BIGINT AS n,
               CASE WHEN NOT isnan(p) AND p < {N.ALPHA} THEN 'rejected' ELSE 'accepted' END AS decision FROM welch
        UNION ALL
        SELECT run_a, run_b, 'wilcoxon' AS test, n::BIGINT AS n,
               CASE WHEN NOT isnan(p) AND p < {N.ALPHA} THEN 'rejected' ELSE 'accepted' END AS decision FROM wilcox""")
    def both_tests(metric: str, extra: str) -> str:
        decision = f"CASE WHEN NOT isnan(p) AND p < {N.ALPHA} THEN 'rejected' ELSE 'accepted' END AS decision"
        return " UNION ALL ".join(
            f"SELECT {metric} AS metric, run_a, run_b, '{test}' AS test, n::BIGINT AS n, {extra}round({statistic}, 6) AS statistic, "
            f"round(p, 6) AS p, {decision} FROM {src}" for test, statistic, src in (("t", "t", "welch"), ("wilcoxon", "w_max", "wilcox")))

    a_ctes, _ = _runs_sql("a.run < b.run AND (a.run LIKE '%:recall') = (b.run LIKE '%:recall')")
    out["compare_all_pairs"] = q(*a_ctes, body=both_tests("CASE WHEN run_a LIKE '%:recall' THEN 'R' ELSE 'MAP' END", "0::BIGINT AS unmatched, "))
    u_ctes, u_m = grid_ctes("bm25", K1_GRID, "test", prefix="u")

    def best_cte(name: str, means: str) -> str:
        return (f"{name} AS (SELECT param FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, param ASC) AS rn FROM {means} "
                "WHERE metric = 'MAP' AND NOT isnan(mean) AND mean > 0) WHERE rn = 1)")

    out["test_files_compared"] = q(
        TRAIN, TEST, *l_ctes, means_cte(l_m, "lmeans"), *t_ctes, *k_ctes, means_cte(k_m, "kmeans"), *u_ctes,
        best_cte("lbest", "lmeans"), best_cte("kbest", "kmeans"),
        f"""runs AS (SELECT 'jm' AS run, query_id::BIGINT AS query_id, ap AS value FROM {t_m} WHERE param = (SELECT param FROM lbest)
        UNION ALL SELECT 'bm25', query_id::BIGINT, ap FROM {u_m} WHERE param = (SELECT param FROM kbest))""",
        *_tests_sql("a.run < b.run"), body=both_tests("'MAP'", ""))
    out["create_docs"] = q("dup AS (SELECT * FROM corpus UNION ALL SELECT * FROM corpus WHERE id % 20 = 0)",
                           body="SELECT id::BIGINT AS id, title, url, pubmedId, sha256(text) AS text_sha256 FROM dup")
    return out


SQL = _sql()
