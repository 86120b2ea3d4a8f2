"""Phrase collocations against plain counting; the quicksort against counters."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from rankeval.llm import phrases as Q


def plain(docs, least=Q.LEAST, cover=Q.COVER, top=Q.TOP):
    """lang -> rows (rank, phrase, a, l, r, n, score)."""
    counts = {}
    for lang, text in docs:
        f = counts.setdefault("und" if lang is None else lang, Counter())
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            w = [x for x in re.split(r"[ \t]", piece) if x]
            for k in (1, 2, 3):
                f.update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if len(p) == 2 and any(len(x) == 3 and p in (x[:2], x[1:]) and 100 * b >= cover * a for x, b in cands.items()):
                continue
            score, _, l, r = min((Fraction(1_000_000 * a * a, f[p[:k]] * f[p[k:]]).__floor__(), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        rows.sort()
        if n:
            out[lang] = [(i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(rows[:top])]
    return {lang: rows for lang, rows in out.items() if rows}


def found(spark, docs, **options):
    frame = spark.createDataFrame([(lang, text, i, i) for i, (lang, text) in enumerate(docs)], "lang string, text string, n long, word long").repartition(3)
    out = {}
    for r in Q.collocations(frame, **options).collect():
        out.setdefault(r.lang, []).append((r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score))
    return {lang: sorted(rows) for lang, rows in out.items()}


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    words = ["the", "of", "new", "york", "city", "a", "b", "É", "Ab", "x-y", "日本", "..", "ab,cd", "tab\tbed", "line\nfeed", "end."]
    docs = [(rnd.choice(["en", "fr", None, ""]), " ".join(rnd.choices(words, [9, 5, 4, 4, 3, 2, 2, 1, 3, 1, 1, 1, 1, 1, 1, 2], k=rnd.randint(0, 60))))
            for _ in range(n)]
    return docs + [("en", None), (None, ""), ("en", " \t\n"), ("fr", "a a a a a a a a a a a a a a a a"), ("en", "new york city. " * 20), ("und", "the the")] * 2


@pytest.mark.parametrize("least,cover,top", [(10, 50, 2000), (3, 80, 7), (1, 100, 2000)])
def test_against_plain_counting(spark, least, cover, top):
    docs = corpus(least)
    assert found(spark, docs, least=least, cover=cover, top=top) == plain(docs, least, cover, top)


def test_small_blocks_and_texts_in_parts_change_nothing(spark, monkeypatch):
    docs = corpus(5, 20)
    want = plain(docs, 3)
    rows = Q.blocks(spark.createDataFrame(docs, "lang string, text string").coalesce(1), size=7)
    assert rows.filter("pos = 0").count() > 20
    monkeypatch.setattr(Q.blocks, "__defaults__", (7,))
    assert found(spark, docs, least=3) == want


def test_quicksort_against_counters():
    rnd = np.random.default_rng(4)
    for n, vocabulary, least in ((0, 3, 1), (1, 3, 1), (500, 3, 10), (5000, 40, 10), (5000, 2000, 2), (3000, 5, 1)):
        keys = [rnd.integers(1, vocabulary + 1, n), rnd.integers(1, vocabulary + 1, n), rnd.integers(0, vocabulary + 1, n)]
        weight = rnd.integers(1, 4, n)
        got = Q.multikey(keys, weight, least)
        for d in range(3):
            count = Counter()
            for i in range(n):
                p = tuple(int(k[i]) for k in keys[: d + 1])
                if 0 not in p:
                    count[p] += int(weight[i])
            one, total = got[d]
            assert {tuple(int(k[i]) for k in keys[: d + 1]): int(t) for i, t in zip(one, total)} == \
                {p: c for p, c in count.items() if c >= least}


def test_counts_beyond_64_bits_in_products(spark):
    frame = spark.createDataFrame([(3_000_000_000_000, 3_500_000_000_000, 4_000_000_000_000)], "a long, l long, r long")
    got = frame.select(Q._score("a", "l", "r").alias("s")).first().s
    assert got == 1_000_000 * 3_000_000_000_000 ** 2 // (3_500_000_000_000 * 4_000_000_000_000)


def test_empty_table(spark):
    assert Q.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
