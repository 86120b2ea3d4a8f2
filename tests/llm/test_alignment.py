"""Cross-tokenizer alignment against a plain version that knows nothing of pieces or blocks."""

import hashlib
from collections import Counter, defaultdict

import pytest

from rankeval.llm import alignment

P = pytest.importorskip("public_tokenizers")
PATHS = [str(P.path(n)) for n in (alignment.A_VOCABULARY, alignment.B_VOCABULARY)]


def plain(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte = alignment._byte_of()

    def spelled_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    rows = []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        e = a.encode(" " + text, add_special_tokens=False)
        left = [(i, bytes(byte[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        right = [(i, spelled_b(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            rows.append(None)
            continue
        groups, i, j = [], 0, 0
        while i < len(left):
            x, y = [left[i][0]], [right[j][0]]
            na, nb = len(left[i][1]), len(right[j][1])
            i, j = i + 1, j + 1
            while na != nb:
                if na < nb:
                    x.append(left[i][0])
                    na, i = na + len(left[i][1]), i + 1
                else:
                    y.append(right[j][0])
                    nb, j = nb + len(right[j][1]), j + 1
            groups.append((x, y))
        rows.append((len(left), len(right), groups))
    count = Counter()
    for r in rows:
        if r:
            count.update({(x, y) for g in r[2] for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for g in r[2] for x in g[0] for y in g[1]]
        digest = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in r[2])
        out.append((r[0], r[1], len(r[2]), len(links), sum(count[p] == highest[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(digest.encode()).hexdigest()))
    return out


def spark_rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = alignment.align(docs, *PATHS).collect()
    assert len(got) == len(texts)
    return [tuple(r[m] for m in (*alignment.MEASURES, "groups_sha256")) for r in sorted(got, key=lambda r: r.doc_id)]


ODD = ["", None, " ", "  two  spaces ", "a", "a b", "a\nb  c\td", "line\n next", "<s> </s> <|endoftext|> [INST]", "▁ marked ▁x",
       "ﬁ ligature é é", "日本語 の テキスト", "🙂🙂 emoji 👩‍👩‍👧", " nbsp  sep", "\x00nul \x1f x", "don't 3.14,15 x's",
       "a" * 700, "ab " * 300, "same text here", "same text here", "same text here", "\r\n\r\n end ", "!!! ??? ...", "tab\t\ttab  x"]


def test_odd_texts_against_plain_version(spark):
    assert spark_rows(spark, ODD) == plain(ODD)


def test_given_documents_against_plain_version(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    assert spark_rows(spark, texts) == plain(texts)


def test_small_blocks_and_wide_groups_change_nothing(spark, monkeypatch):
    texts = ["".join(chr(0x4E00 + (i * 37 + j) % 400) for j in range(60)) + f" w{i % 3} tail" for i in range(40)] + ODD
    of = alignment.Pieces(*PATHS)
    whole = of.learn([t for t in texts if t])
    monkeypatch.setattr(alignment, "WIDE", 3)
    again = of.learn([t for t in texts if t])
    assert whole.texts == again.texts and all(getattr(whole, f).tolist() == getattr(again, f).tolist()
                                              for f in ("good", "measures", "sizes", "codes", "times"))
    # one text per block: counts still come from all of them
    monkeypatch.setattr(alignment, "BLOCK", 1)
    monkeypatch.setattr(alignment, "SLICE", 1)
    block = alignment.Block(of)
    block.add([b"k"], ["a b a b"], [3])
    pairs = [b for b in block.rows(0) if b.column(1)[0].as_py() == 0]
    assert set(pairs[0].column(3).to_pylist()) == {3}


def test_both_libraries_of_the_first_vocabulary_agree_on_every_character():
    of = alignment.Pieces(*PATHS)
    assert of.fast and of.splits
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    texts = [f" a{chr(c)}1{chr(c)}  {chr(c)}!{chr(c)} {chr(c)}" for c in points]
    for i in range(0, len(texts), 4096):
        for text, e in zip(texts[i: i + 4096], of.a.encode_batch(texts[i: i + 4096], add_special_tokens=False)):
            assert of._ids_a(text).tolist() == e.ids


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, *PATHS).collect() == []
    docs = spark.createDataFrame([(None, "x y"), (None, None), (7, "x y")], "doc_id long, text string")
    got = sorted(alignment.align(docs, *PATHS).collect(), key=str)
    assert len(got) == 3 and sorted((r.doc_id, r.n_a > 0) for r in got if r.doc_id) == [(7, True)]
