"""Near-dedup, decontamination, mixing, sharding, range-ANS output, revisits: brute force and odd inputs."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankeval.llm import decontaminate as D
from rankeval.llm import mixing as M
from rankeval.llm import rans as R
from rankeval.llm import sharding as S
from rankeval.llm import simhash as H
from rankeval.llm import warc as A
from rankeval.llm.common import materialise

LONG = "word " * 200_000


def docs_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, 2, 3) for i, t in zip(ids, texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long, shard long, fp long, rate long")


def bag(df):
    return sorted(map(str, df.collect()))


# ---- sharding ----

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 1000))
def test_permutation_is_a_bijection_after_walking(n, seed):
    a, b = S.domain(n)
    keys = S.round_keys(seed)
    assert sorted(S.permute_int(x, a, b, keys) for x in range(a * b)) == list(range(a * b))
    bound, seen = S.walk_bound(n, a, b, keys), set()
    for x in range(n):
        y, walked = S.permute_int(x, a, b, keys), 0
        while y >= n:
            y, walked = S.permute_int(y, a, b, keys), walked + 1
        assert walked <= bound
        seen.add(y)
    assert seen == set(range(n))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 500])
def test_shards_against_brute_force(spark, n):
    docs = docs_of(spark, [f"t{i}" for i in range(n)], random.Random(1).sample(range(10_000), n)).repartition(5)
    got = S.feistel_shards(docs, ["doc_id"], 8, 42)
    assert [c for c in got.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c != "shard"]
    rows = got.collect()
    a, b = S.domain(n)
    keys = S.round_keys(42)
    for rank, r in enumerate(sorted(rows, key=lambda r: r.doc_id)):
        y = S.permute_int(rank, a, b, keys)
        while y >= n:
            y = S.permute_int(y, a, b, keys)
        assert (r.shard, r.slot) == (y % 8, y // 8)
    assert bag(S.feistel_shards(docs.repartition(2), ["doc_id"], 8, 42)) == sorted(map(str, rows))


def test_shards_with_nulls_and_repeated_ids(spark):
    docs = docs_of(spark, [None, "", "a", "a", LONG, "b", "c", "d", "e"], [None, None, 1, 1, 1, 2, 3, 4, 5])
    rows = S.feistel_shards(docs, ["doc_id"], 4).collect()
    assert len(rows) == 9
    for s in range(4):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (2, 3)
    with pytest.raises(ValueError):
        S.feistel_shards(docs, ["doc_id"], 0)


# ---- SimHash ----

def brute_fingerprint(text):
    import xxhash
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(fps))]


def test_spark_hash_agrees(spark):
    """The contract's hash is Spark's xxhash64 with its own seed."""
    value = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    import xxhash
    assert value % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 200))]
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(100)}"
            texts.append(" ".join(copy))
    texts += [None, "", " \t", "ONE two", "one TWO", LONG, LONG, texts[0]]
    ids = [None if i % 17 == 3 else i for i in range(len(texts))]
    got = H.near_duplicates(docs_of(spark, texts, ids)).collect()
    fps = [brute_fingerprint(t) for t in texts]
    want = sorted(map(str, zip(ids, fps, brute_components(fps, ids))))
    assert sorted(str((r.doc_id, r.fp % (1 << 64), r.component_id)) for r in got) == want
    assert H.near_duplicates(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("tree", [3, 8192])
def test_links_of_dense_and_chained_fingerprints(spark, tree):
    """A cloud of near fingerprints, long chains of single-bit steps and noise; small trees force splitting."""
    rng = random.Random(7)
    fps, x = {0, (1 << 64) - 1}, rng.getrandbits(64)
    for _ in range(150):  # cloud
        fps.add(x ^ sum(1 << b for b in rng.sample(range(64), 2)))
    y = rng.getrandbits(64)
    for b in rng.sample(range(64), 40):  # chain
        y ^= 1 << b
        fps.add(y)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in H.components(H.links(df, 4, tree)).collect()}
    got = [roots.get(f, f) for f in fps]
    want = brute_components(fps, list(range(len(fps))))
    pairs = {}
    assert all(pairs.setdefault(w, g) == g for w, g in zip(want, got)) and len(set(got)) == len(set(want))


def test_bk_forest_finds_all_pairs():
    rng = np.random.default_rng(0)
    group = np.sort(rng.integers(0, 6, 300))
    fps = rng.integers(0, 1 << 12, 300).astype(np.uint64) << np.uint64(20)
    keep = np.unique(np.stack([group.astype(np.uint64), fps]), axis=1)
    group, fps = keep[0].astype(np.int64), keep[1]
    forest = H.Forest(fps, group)
    queries, qgroup = rng.integers(0, 1 << 12, 500).astype(np.uint64) << np.uint64(20), rng.integers(0, 8, 500)
    got = {(int(a), int(b)) for q, m in forest.search(queries, qgroup, 2) for a, b in zip(q, m)}
    want = {(i, j) for i in range(500) for j in range(len(fps))
            if qgroup[i] == group[j] and int(queries[i] ^ fps[j]).bit_count() <= 2}
    assert got == want


def test_dedup_stage_keeps_one_of_each(spark):
    docs = docs_of(spark, ["a b c d e f", "a b c d e f", "x y z w v", "x y z w v", "alone here now"], [5, 3, 9, 9, 1])
    kept = H.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 9]


# ---- decontamination ----

def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], (last + 1 if x == y else max(row[j + 1], row[j]))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=20), st.lists(st.integers(0, 7), max_size=30))
def test_common_subsequence(item, words):
    assert D.common_subsequence(item, words) == brute_lcs(item, words)


def test_gram_times_is_the_matrix_product():
    rng = np.random.default_rng(1)
    weight = np.r_[0, rng.random(9) + 0.1].astype(np.float32)
    words, tile = rng.integers(1, 10, 60), np.sort(rng.integers(0, 7, 60))
    right = rng.random((10, 3))
    dense = np.zeros((7, 10))
    for w, t in zip(words, tile):
        dense[t, w] += weight[w]
    dense = dense[dense.any(1)]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    assert np.allclose(D.gram_times(words, tile, weight, right), dense.T @ (dense @ right), atol=1e-5)


def test_leaks_and_recall_against_brute_force(spark):
    """All verbatim passages and edited ones are found, clean documents are not; recall of candidates is whole."""
    rng = random.Random(11)
    common = ["the", "of", "and", "to", "in", "is"]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(2000)}"
    items = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(20)] + [[f"q{i}" for i in range(200)]]
    texts, want = [], set()
    for d in range(160):
        text = [word() for _ in range(rng.randrange(0, 400))]
        if d % 4 == 0:
            i = (d // 4) % len(items)
            leak = list(items[i])
            if d % 8 == 0:  # paraphrase: every tenth word replaced
                leak[::10] = ["other"] * len(leak[::10])
            at = rng.randrange(len(text) + 1)
            text[at:at] = leak
            want.add((d, i))
        texts.append(" ".join(text).upper() if d % 3 else " ".join(text) + ".")
    texts += [None, "", " . , ", LONG]
    bench = spark.createDataFrame([(i, " ".join(x) + ".", "t") for i, x in enumerate(items)] + [(98, None, "t"), (99, "...", "t")],
                                  "item_id long, text string, doc_id string")
    docs = docs_of(spark, texts)
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()}
    assert got == want
    kept = D.keep_clean(docs, bench)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert D.find_leaks(docs.limit(0), bench).count() == 0 and D.find_leaks(docs, bench.limit(0)).count() == 0
    assert D.keep_clean(docs, bench.limit(0)).count() == len(texts)


def test_leaks_of_the_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()}
    items = [(r.item_id, D.words_of(r.text)) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        words = D.words_of(r.text)
        for i, item in items:
            n = len(item)
            best = max((brute_lcs(item, words[k: k + n + n // 2 + 8]) for k in range(0, max(1, len(words) - n + 1), n)), default=0)
            if best >= 0.9 * n:
                want.add((r.doc_id, i))
    assert want <= got and len(want) >= 0.9 * len(got)


# ---- mixing ----

def test_mixing_against_numpy(spark):
    rng = random.Random(2)
    texts, labels = [], []
    for d in range(300):
        kind = rng.choice(["good", "good", "poor", "toxic"])
        words = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 60))]
        if kind != "good":
            words += [f"{kind}{rng.randrange(3)}"] * rng.randrange(1, 3)
        texts.append(" ".join(words))
        labels.append((d, int(kind != "poor"), int(kind == "toxic")))
    texts += [None, "", LONG]
    lab = spark.createDataFrame(labels[:200] + [(None, 1, 0), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    got, names = M.mix(docs_of(spark, texts), M.label_domain(lab))
    assert names == ["good", "poor", "toxic"]
    rows = sorted(got.collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(texts) and [r.tokens for r in rows] == [len((t or "").split()) for t in texts]
    p = np.array([[r.p_0, r.p_1, r.p_2] for r in rows]) / M.RESOLUTION
    t, rate = np.array([float(r.tokens) for r in rows]), np.array([r.rate for r in rows])
    assert np.allclose(p.sum(1), 1) and (rate >= 0).all()
    held_out = range(200, 300)
    right = sum(names[int(p[d].argmax())] == ("toxic" if labels[d][2] else "good" if labels[d][1] else "poor") for d in held_out)
    assert right >= 90
    mass = t @ p
    goal = mass * [M.MULTIPLES[n] for n in names]
    r = np.ones(len(t))
    for _ in range(20_000):  # plain projected gradient to convergence
        r = np.maximum(0, r - p @ (((r * t) @ p - goal) / mass))
    cost = lambda x: ((((x * t) @ p - goal) ** 2) / mass).sum()
    assert cost(rate) <= cost(r) + 1e-4 * cost(np.ones(len(t)))
    assert np.allclose((rate * t) @ p, (r * t) @ p, atol=0.01 * mass.max())


def test_mixing_odd_tables(spark):
    docs = docs_of(spark, ["a b", "a b", None, "c"], [1, 1, None, 2])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got, names = M.mix(docs, M.label_domain(none))
    assert names == [] and {r.rate for r in got.collect()} == {1.0}
    assert bag(M.apply_rates(docs, none)) == bag(docs)
    one = spark.createDataFrame([(1, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    assert bag(M.apply_rates(docs, one)) == bag(docs)
    assert M.apply_rates(docs.limit(0), one).count() == 0


def test_mixing_plan_runs_no_python(spark):
    rated, _ = M.mix(docs_of(spark, ["a b c"] * 5), M.label_domain(
        spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")))
    for df in (rated, S.feistel_shards(docs_of(spark, ["a"]), ["doc_id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# ---- range-ANS ----

@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70), min_size=1, max_size=1500), min_size=1, max_size=5))
def test_coder_round_trip(blocks):
    blocks = [np.array(b) for b in blocks]
    n = np.bincount(np.concatenate(blocks))
    coder = R.Coder(R.scaled({i: int(k) for i, k in enumerate(n) if k}))
    payloads = coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, coder.decode(payloads)))
    for b, p in zip(blocks, payloads):
        lanes = -(-len(b) // R.STEPS)
        if R.HEADER.unpack_from(p)[4]:  # parallel decoding from the checkpoint
            assert np.array_equal(coder.decode([p], first=1)[0], b[R.EVERY * lanes:])


def test_scaled_frequencies():
    f = R.scaled({0: 10 ** 12, 5: 1, 7: 3}, 8)
    assert f.sum() == 256 and (f[[0, 5, 7]] > 0).all() and f[1] == 0
    assert R.scaled({}).sum() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=6))
def test_join_crc32(parts):
    assert R.join_crc32([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "B", "é", "12", "'s", ".", "!!", " ", "　", "\x1c", "\x85", "中",
                                 "<|endoftext|>", "́", "\r\n", "👍", "n't"]), max_size=14).map("".join))
def test_encoder_equals_the_library(text):
    of = R.encoder(R.vocabulary_path())
    want = of.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(of.encode([text])[0], f"<u{of.width}").tolist() == want


def test_files_round_trip(spark):
    from tokenizers import Tokenizer
    texts = ["hello world", None, "", "hello  world\n again", LONG, "x" * 1000, "hello world"]
    ids = [3, 1, 2, 9, 4, -5, 7]
    path = R.checkpoint_dir(spark) + f"/rans-test-{random.getrandbits(40)}"
    tokens = R.token_table(docs_of(spark, texts, ids), R.vocabulary_path())
    R.write_blocks(tokens, R.scaled(R.id_counts(tokens)), path)
    got = sorted(R.documents_back(spark, path).collect(), key=lambda r: r.doc_id)
    library, start = Tokenizer.from_file(R.vocabulary_path()), 0
    for (d, t), r in zip(sorted(zip(ids, texts)), got):
        want = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    ids = {(r.doc_id, r.block): r.ids for r in R.read_ids(spark, path).collect()}
    assert np.frombuffer(ids[3, 0], "<u4").tolist() == [*library.encode("hello world", add_special_tokens=False).ids, 0]
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.filter("doc_id = 4").count() > 1
    # a damaged block is noticed
    bad = R.checkpoint_dir(spark) + f"/rans-bad-{random.getrandbits(40)}"
    spark.read.parquet(f"{path}/table").write.parquet(f"{bad}/table")
    blocks.withColumn("payload", F.expr("cast(concat(substring(payload, 1, length(payload) - 1), X'5A') as binary)")).write.parquet(
        f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        R.read_ids(spark, bad).count()


def test_empty_output(spark):
    path = R.checkpoint_dir(spark) + f"/rans-empty-{random.getrandbits(40)}"
    tokens = R.token_table(docs_of(spark, []), R.vocabulary_path())
    R.write_blocks(tokens, R.scaled(R.id_counts(tokens)), path)
    assert R.documents_back(spark, path).count() == 0


def test_rows_that_share_an_id_stay_rows(spark):
    """Rows of one id, of several blocks each, keep their texts apart and their input order."""
    from tokenizers import Tokenizer

    texts = ["a b c " * 40_000, "unlike " * 80_000, "last", None, "none either"]
    path = R.checkpoint_dir(spark) + f"/rans-ids-{random.getrandbits(40)}"
    docs = docs_of(spark, texts, [5, 5, 5, None, None]).coalesce(1)
    tokens = R.token_table(docs, R.vocabulary_path())
    R.write_blocks(tokens, R.scaled(R.id_counts(tokens)), path)
    got = sorted(R.documents_back(spark, path).collect(), key=lambda r: r.start)
    library, start = Tokenizer.from_file(R.vocabulary_path()), 0
    for d, t, r in zip([None, None, 5, 5, 5], [None, "none either", *texts[:3]], got):
        want = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    assert len(got) == 5
    counts = R.id_counts(tokens)
    assert sum(counts.values()) == start and counts[0] >= 5


def test_first_pieces_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(R, "FIRST_BYTES", 50_000)
    of = R.Encoder(R.vocabulary_path())
    for k in range(40):
        of.encode([f"word{k}x{i}" + "y" * (k * 30) for i in range(100)])
        assert sum(len(a) + len(b) for a, b in of.first.items()) <= 50_000


# ---- odd ids and column names ----

def test_keep_first_loses_no_unlike_row(spark):
    texts = [" ".join(random.Random(k).choices(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"], k=40)) for k in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, __id long")
    assert sorted(r["__id"] for r in H.keep_first(docs).collect()) == [0, 1, 2, 3, 4]
    # rows alike in every column are one; copies under other ids go, the least id stays, null ids are last
    more = docs.unionByName(docs).unionByName(spark.createDataFrame(
        [(0, texts[0], "en", 9), (7, texts[1], "en", 10), (None, texts[5], "en", 11), (3, texts[5], "en", 12)], docs.schema))
    kept = H.keep_first(more)
    assert kept.columns == docs.columns
    assert sorted(r["__id"] for r in kept.collect()) == [1, 2, 3, 4, 9, 12]


def test_clashing_columns_of_the_stages(spark):
    from rankeval.llm import quality as Q

    good = " ".join(random.Random(1).choices(["the", "of", "and", "house", "water", "light"], k=30))
    names = ("__id", "__copies", "__lang", "__text", "lang_", "text_", "copies", "copy", "rated_id", "h1", "h2", "fp")
    docs = spark.createDataFrame([(i, good + f" {i}", "en", *[i] * len(names)) for i in range(4)],
                                 "doc_id long, text string, lang string, " + ", ".join(f"{n} long" for n in names))
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    for out in (Q.keep_good(docs), H.keep_first(docs), M.apply_rates(docs, labels)):
        assert out.columns == docs.columns
        for r in out.collect():
            assert {r[n] for n in names} == {r.doc_id}
    assert Q.score(docs).count() == 4


def test_hot_components_and_fingerprints(spark, monkeypatch):
    """The broadcast and the shuffled way of the counted join give the same classes."""
    from rankeval.llm import common

    rnd = random.Random(2)
    texts = [" ".join(rnd.choices("abcdefgh", k=30)) for _ in range(30)]
    docs = docs_of(spark, texts * 3 + [texts[0]] * 60)
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    some = bag(H.near_duplicates(docs))
    monkeypatch.setattr(common, "HOT_KEYS", 1)
    assert bag(H.near_duplicates(docs)) == some
    monkeypatch.setattr(common, "HOT_KEYS", 10 ** 9)
    assert bag(H.near_duplicates(docs)) == some


def test_item_ids_of_another_type(spark):
    text = " ".join(random.Random(3).choices([f"w{i}" for i in range(200)], k=60))
    docs = docs_of(spark, [f"before {text} after", "nothing here", None])
    for kind in ("int", "string", "smallint"):
        items = spark.createDataFrame([(1, text)], "item_id long, text string").select(F.col("item_id").cast(kind), "text")
        rows = D.find_leaks(docs, items).collect()
        assert [(r.doc_id, str(r.item_id)) for r in rows] == [(0, "1")]


# ---- revisits ----

SCHEMA = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, payload_digest string, slice long"


def test_canonical_url(spark):
    cases = {"HTTP://User@Example.COM:80?b=2&utm_source=x&a=1#f": "http://example.com/?a=1&b=2",
             "https://example.com:443/A%20b": "https://example.com/A%20b", "https://example.com:80/": "https://example.com:80/",
             "http://example.com/?ref=x": "http://example.com/", "mailto:a@b#c": "mailto:a@b", " ": None, None: None}
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select("u", A.canonical_url(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in rows} == cases


def test_revisits_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        hot = rng.random() < 0.4
        url = "http://hot.example/" if hot else rng.choice([f"http://e{rng.randrange(20)}.example/p#x", None])
        ts = rng.choice([None, *[rng.randrange(0, 400_000) // 500 * 500] * 20])
        kind = rng.choice(["response", "revisit"])
        headers = rng.choice([None, {}, {"etag": f'"{rng.randrange(2)}"', "age": str(i), "content-type": f"t{i}"},
                              {"etag": f'W/"{rng.randrange(2)}"'}, {"last-modified": f"d{rng.randrange(2)}", "connection": "x"}])
        rows.append((i, url, ts, kind, rng.choice([200, 200, 206]) if kind == "response" else 304, headers,
                     rng.choice([None, f"p{rng.randrange(2)}"]), 1))
    df = spark.createDataFrame(rows + [r for r in rows if r[3] == "revisit"][:3], SCHEMA)
    got = sorted(map(str, (tuple(r) for r in A.resolve_revisits(df, 7_000).select(
        "record_id", "outcome", "response_id", F.array_sort(F.map_entries("headers")).alias("h")).collect())))
    want = []
    for r in rows + [r for r in rows if r[3] == "revisit"][:3]:
        if r[3] != "revisit":
            continue
        key = r[1] and r[1].split("#")[0]
        full = [x for x in rows if x[3] == "response" and x[4] == 200 and x[1] and x[1].split("#")[0] == key and x[2] is not None
                and r[2] is not None and x[2] < r[2]]
        found, outcome, merged = None, "no_url" if key is None else "no_earlier_response", None
        if full and key is not None:
            found = max(full, key=lambda x: (x[2], x[0]))
            new, old = r[5] or {}, found[5] or {}
            weak = lambda e: e and e.removeprefix("W/")
            tests = [a == b for a, b in ((weak(new.get("etag")), weak(old.get("etag"))),
                                         (new.get("last-modified"), old.get("last-modified")), (r[6], found[6]))
                     if a is not None and b is not None]
            outcome = "no_validator" if not tests else "resolved" if all(tests) else "validator_mismatch"
            merged = {**old, **{k: v for k, v in new.items() if k not in A.KEPT}}
        ok = outcome == "resolved"
        h = sorted(merged.items()) if ok else None
        want.append((r[0], outcome, found[0] if ok else None, h))
    plain = [(r[0], r[1], r[2], r[3] and [tuple(e) for e in r[3]] if r[3] is not None else None) for r in (
        tuple(x) for x in A.resolve_revisits(df, 7_000).select(
            "record_id", "outcome", "response_id", F.array_sort(F.map_entries("headers")).alias("h")).collect())]
    assert sorted(map(str, plain)) == sorted(map(str, want)) and len(got) == len(want)
    assert A.resolve_revisits(df.limit(0)).count() == 0


def test_materialise_reads_what_it_wrote(spark):
    df = spark.range(5).withColumn("x", F.lit(None).cast("string"))
    assert bag(materialise(df, "t")) == bag(df)


def test_leak_across_segments(spark, monkeypatch):
    """A passage that spans the border of two segments of a long text is found."""
    item = [f"q{i}" for i in range(40)]
    words = ["the", "of", "and"] * 100
    docs = docs_of(spark, [" ".join(words[:n] + item + words) for n in (0, 100, 120, 127, 128, 200)] + [" ".join(words)])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(f"r{i}" for i in range(20)))], "item_id long, text string")
    (search, numbered), = D.searchers(docs, bench)
    monkeypatch.setattr(D, "SEGMENT", 128)
    texts = {r.doc_id: np.frombuffer(r.words, "<i4") for r in numbered.collect()}
    found = search.leaks([texts[d] for d in range(7)])
    assert [sorted(f) for f in found] == [[0]] * 6 + [[]]


# ---- token files: what is done once ----

def test_blocks_are_coded_behind_the_exchange(spark):
    """Dealing the documents out by ranges reads them twice; they are coded after that."""
    tokens = R.token_table(docs_of(spark, ["text 1", "text 2"], [2, 1]), R.vocabulary_path())
    plan = R.coded(tokens, R.scaled(R.id_counts(tokens)))._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("MapInArrow") < plan.index("RepartitionByExpression" if "RepartitionByExpression" in plan else "Exchange range")


def test_runs_of_blocks():
    assert list(R.runs_of([], 5)) == []
    assert list(R.runs_of([1, 2, 3, 9, 1, 1], 5)) == [(0, 2), (2, 1), (3, 1), (4, 2)]


def test_closing_marks_use_the_ids_of_the_word():
    of = R.Encoder(R.vocabulary_path())
    of.encode(["x wordlike"])
    asked, tokenize = [], of.tokenize
    of.tokenize = lambda x: asked.append(x) or tokenize(x)
    assert of.encode(["y wordlike, wordlike!"])[0] == of.plain("y wordlike, wordlike!")
    assert asked == []
