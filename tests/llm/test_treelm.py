"""Context-tree weighting against a plain recursive version on small texts."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankeval.llm import treelm as T


def plain(texts, depth=T.DEPTH):
    """(held_out, n_tokens, n_known, train_tokens, base_score, score) per text by dictionaries and recursion."""
    bodies = [(t or "").encode().lower() + b"\xff" for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    nodes = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for b, h in zip(bodies, held):
        if h:
            continue
        x = b"\xff" * depth + b
        for i in range(depth, len(x)):
            for k in range(8):
                decision = (1 << k) | x[i] >> 8 - k
                for d in range(depth + 1):
                    context = x[i - d: i]
                    nodes[context, decision][x[i] >> 7 - k & 1] += 1
                    if d:
                        children[context[1:], decision].add(context)

    def kt(n):
        return math.lgamma(n[0] + .5) + math.lgamma(n[1] + .5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    memo = {}

    def weighted(context, decision):
        """(log weighted probability, share of the own estimate)"""
        if (context, decision) not in memo:
            own = kt(nodes.get((context, decision), [0, 0]))
            if len(context) == depth:
                memo[context, decision] = own, 1.0
            else:
                below = sum(weighted(c, decision)[0] for c in children.get((context, decision), ()))
                w = np.logaddexp(own, below) - math.log(2)
                memo[context, decision] = w, math.exp(own - math.log(2) - w)
        return memo[context, decision]

    counts, tokens = Counter(), 0
    for b, h in zip(bodies, held):
        if not h:
            w = [*b[:-1].split(), b""]
            counts.update(w)
            tokens += len(w)
    out = []
    for b, h in zip(bodies, held):
        w = [*b[:-1].split(), b""]
        base = sum(math.log10((counts[t] + .1) / (tokens + .1 * (len(counts) + 1))) for t in w)
        x, total = b"\xff" * depth + b, 0.0
        for i in range(depth, len(x)):
            for k in range(8):
                decision, bit = (1 << k) | x[i] >> 8 - k, x[i] >> 7 - k & 1
                p, left = 0.0, 1.0
                for d in range(depth + 1):
                    context = x[i - d: i]
                    n = nodes.get((context, decision), [0, 0])
                    share = weighted(context, decision)[1]
                    p += left * share * (n[bit] + .5) / (sum(n) + 1)
                    left *= 1 - share
                total += math.log10(p)
        out.append((h, len(w), sum(counts[t] > 0 for t in w), tokens, base, total))
    return out


def check(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n long").repartition(3)
    rows = sorted(T.score(docs, **options).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for r, e in zip(rows, plain(texts, **options)):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
        assert r.base_score == pytest.approx(e[4], rel=1e-9) and r.score == pytest.approx(e[5], rel=1e-7)


ODD = ["", None, " \t\n", "a", "Aa aa AA", "the cat sat on the mat. the cat sat on the hat", "é 日本語 🙂", "x" * 300, "same", "same"]


def test_odd_texts_against_recursion(spark):
    check(spark, ODD)


def test_documents_against_recursion(spark):
    texts = [r.text[:400] if r.text else r.text for r in
             spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()]
    check(spark, texts, depth=4)


def test_small_blocks_and_small_tree_batches_change_nothing(spark, monkeypatch):
    texts = [f"some words {i % 7} and others {i % 3}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r.score for r in T.score(docs).collect()}
    assert len(whole) == 60
    # the streaming of contexts: any batch size gives whole contexts
    import pyarrow as pa

    context = np.repeat([1, 1, 2, 5, 5, 5, 9], [3, 2, 4, 1, 6, 1, 2])
    for batch_rows in (1, 2, 5, 100):
        for least in (1, 4, 1000):
            monkeypatch.setattr(T, "TREE_ROWS", least)
            seen = []
            batches = [pa.RecordBatch.from_arrays([pa.array(context[i: i + batch_rows])], ["context"]) for i in range(0, len(context), batch_rows)]

            def handle(columns):
                seen.append(columns[0])
                yield from ()

            list(T._by_context(iter(batches), handle))
            assert np.array_equal(np.concatenate(seen), context)
            starts = [set(x.tolist()) for x in seen]
            assert sum(map(len, starts)) == len(set(context.tolist()))


def test_places_finds_every_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 20_000))
    want = np.random.default_rng(2).integers(0, len(keys), 50_000)
    assert np.array_equal(T.Places(keys).of(keys[want]), want)


def test_model_beats_the_base_on_held_out_documents(spark):
    rows = T.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_table_and_null_ids(spark):
    assert T.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = T.score(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")).collect()
    assert len(rows) == 2 and all(r.held_out for r in rows) and all(r.train_tokens == 0 for r in rows)
