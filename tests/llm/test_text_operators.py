"""Quality rules, extraction, chat machine, secret scan: brute force, round trips and odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankeval.llm import chat, htmlmain, quality, secrets

LONG = "word " * 300_000
ODD_TEXTS = [None, "", " \n\t", "one", LONG, "é" * 1000, "a\x00b", "x y", "\n\n\n", "same line\nsame line\nsame line"]


def docs_of(spark, texts, extra=True):
    rows = [(i, t, "en" if i % 3 else None, "s", 0, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long")
    return df if extra else df.drop("kept")


# ---- quality rules ----

def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#é ", max_size=80))
def test_base_counts(text):
    assert quality.base_counts(text, quality.words_of(text)) == brute_base(text)


def test_repeat_words_many_distinct_words():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(100, 120)]
    assert quality.repeat_words(words) == brute_base(" ".join(words))[4] == 40


def test_distance_is_jensen_shannon():
    import numpy as np
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 2])
    assert quality.distance(p, p) == 0
    assert quality.distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)
    a, b = p / 4, q / 4
    m = (a + b) / 2
    kl = lambda x: sum(v * math.log2(v / w) for v, w in zip(x, m) if v)
    assert quality.distance(p, q) == pytest.approx(((kl(a) + kl(b)) / 2) ** 0.5)


def test_quality_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "and", "to", "in"] * 6 + [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 300))) for _ in range(60)]
    texts += ["| $$$ ### %%% " * 80, " ".join(f"Q{i}X$" for i in range(200)), *ODD_TEXTS]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.score(df).collect()}
    total, classes = Counter(), Counter()
    for t in texts:
        total.update(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()))
        classes.update(dict(zip(quality.CLASSES, quality.char_classes(t or "").tolist())))
    common = sorted(total, key=lambda w: (-total[w], w))[:quality.COMMON]
    for i, t in enumerate(texts):
        r, base = got[i], brute_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        own = Counter(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()))

        def jsd(a, b):
            a, b = [x / sum(a) for x in a], [x / sum(b) for x in b]
            kl = lambda x: sum(v * math.log2(2 * v / (p + q)) for v, p, q in zip(x, a, b) if v)
            return max(0, (kl(a) + kl(b)) / 2) ** 0.5
        if base[0] >= quality.MIN_WORDS:
            pick = lambda c: [c[w] for w in common] + [sum(c.values()) - sum(c[w] for w in common)]
            assert r.word_distance == pytest.approx(jsd(pick(own), pick(total)), abs=1e-9)
        else:
            assert r.word_distance is None
        if len(t or "") >= quality.MIN_CHARS:
            assert r.char_distance == pytest.approx(
                jsd(quality.char_classes(t).tolist(), [classes[c] for c in quality.CLASSES]), abs=1e-9)
        off = (r.char_distance or 0) > quality.MAX_CHAR_DISTANCE or (r.word_distance or 0) > quality.MAX_WORD_DISTANCE
        assert r.kept == (not r.base_failed and not off)
    assert not got[60].kept and not got[61].kept


def test_quality_stage_keeps_columns_and_rows(spark):
    docs = docs_of(spark, ODD_TEXTS + ["The quick brown fox jumps over the lazy dog near a river bank today ."] * 2)
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [10, 11]
    assert quality.score(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


# ---- extraction ----

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-notice">We use cookies. Accept them all please.</div><header><h1>Site</h1></header>
<nav><ul><li><a href=x>Home</a></ul></nav><div id="content"><h1>Title of it</h1>
<p>First para &eacute; with   <i>ital</i>ic &lt;b&gt; text&#8212;that runs on.<p>Second<!-- no --> one.
<div class="ad-box">Buy now! Great prices.</div><ul><li>Item one</li><li>Item two</ul><form><label>Name</label><input></form>
<script>var a="<p>x</p>"</script><div class="comments"><h3>Comments</h3><p>I liked this article a lot, thank you.</p></div>
</div><aside><p>Related text that is not part of it at all.</p></aside><footer>&copy; 2020</footer></body></html>"""


def test_page():
    assert htmlmain.main_text(PAGE) == \
        "Title of it\nFirst para é with italic <b> text—that runs on.\nSecond one.\nItem one\nItem two"


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<p class='x", "<!-- open", "<script>x", "&am", "</p></div>"])
def test_odd_pages(html):
    assert isinstance(htmlmain.main_text(html), str)


def test_truncated_page_keeps_article():
    assert htmlmain.main_text("<article><p>One sentence here.</p><p>Cut off at &am") == "One sentence here.\nCut off at &am"


def test_quotes_hide_angle_brackets():
    assert htmlmain.main_text('<article><p title="a > b">Text of it.</p></article>') == "Text of it."


@pytest.mark.parametrize("page,text", [
    ('<article class="ad-free"><p>Some text of it here.</p></article>', "Some text of it here."),
    ('<main class="has-sidebar no-ads"><p>Some text of it here.</p></main>', "Some text of it here."),
    ('<main class="sidebar"><p>Some text of it here.</p></main>', "Some text of it here."),
    ('<div id="main-content" class="col side"><p>Some text of it here.</p></div>', "Some text of it here."),
    ('<div class="sidebar"><p>Some text of it here.</p></div>', ""),
    ('<div id="sidebar" class="main-col"><p>Some text of it here.</p></div>', ""),
    ('<div class="post-comments"><p>Some text of it here.</p></div>', ""),
    ('<article><p>Energy is <math><mi>E</mi></math> always.</p></article>', "Energy is E always."),
    ('<article><p>A <object>fallback</object> text here.<select><option>One</select></p></article>', "A fallback text here."),
])
def test_names_and_embedded_text(page, text):
    assert htmlmain.main_text(page) == text


#: Pages on which single blocks score on the wrong side, with their text.
DOUBTFUL = [
    ("<article><p>A long sentence that goes on and on.</p><p><a href=x>See here</a></p><p>Another long sentence that is text.</p></article>",
     "A long sentence that goes on and on.\nSee here\nAnother long sentence that is text."),
    ("<main><h1>A title of the page</h1><p>First sentence of the text.</p><h2><a href=#b>Part two</a></h2><p>The end of it is here.</p></main>",
     "A title of the page\nFirst sentence of the text.\nPart two\nThe end of it is here."),
    ("<div><p>A text without any labelled container around it.</p><div><a href=x>more</a> of it</div><p>It goes on for one more sentence.</p></div>",
     "A text without any labelled container around it.\nmore of it\nIt goes on for one more sentence."),
]


def test_the_cut_is_better_than_the_sign_of_the_score():
    for page, text in DOUBTFUL:
        blocks = htmlmain.blocks_of(page)
        by_sign = "\n".join(b.text for b in blocks if htmlmain.score(b) > 0)
        assert by_sign != text and htmlmain.main_text(page) == text
    # neighbours do not pull boilerplate across the border of its container
    page = "<article><p>A long sentence that goes on and on.</p><div class=ad>Buy it now.</div><p>Another long sentence of it.</p></article>"
    assert "Buy" not in htmlmain.main_text(page)


def independent_score(block):
    """The classifier again, from the block's ancestors."""
    w, words = htmlmain.WEIGHTS, len(block.text.split())
    s = w["bias"] + w["log_words"] * np.log1p(words) + w["link_density"] * min(1.0, block.linked / len(block.text))
    s += w["container_" + block.node.kind[0]] if block.node.kind else 0.0
    s += w["hidden"] * block.node.hidden
    s += {"p": w["paragraph"], "li": w["list_item"], **{f"h{i}": w["heading"] for i in range(1, 7)}}.get(block.node.tag, 0.0)
    s += w["sentence_end"] * block.text.endswith(tuple(".!?…\"”»:;,)"))
    return s + w["legal"] * (block.text.startswith("©") or words <= 30 and "all rights reserved" in block.text.lower())


def test_scores_against_independent_version(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()] + [PAGE, *[p for p, _ in DOUBTFUL]]
    for page in pages:
        for b in htmlmain.blocks_of(page):
            assert htmlmain.score(b) == pytest.approx(independent_score(b))


def test_nested_pages_are_read_in_linear_time():
    import time

    for page in ("<div>" * 8000 + "text", "<p><button>" + "<div>" * 8000 + "x", "<span>" * 8000 + "text<div></div>" * 8000,
                 "<b>" * 8000 + "x</b>" * 8000):
        begin = time.process_time()
        htmlmain.main_text(page)
        assert time.process_time() - begin < 1.5


def brute_cut(capacity, pairs):
    best = None
    for mask in range(1 << len(capacity)):
        side = [mask >> i & 1 for i in range(len(capacity))]
        cost = sum(c if c > 0 and not s else -c if c < 0 and s else 0 for c, s in zip(capacity, side))
        cost += sum(c for i, j, c in pairs if side[i] != side[j])
        best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=8), st.lists(
    st.tuples(st.integers(0, 7), st.integers(0, 7), st.integers(0, 15)), max_size=14))
def test_minimum_cut(capacity, pairs):
    pairs = [(i, j, c) for i, j, c in pairs if i != j and max(i, j) < len(capacity)]
    side = htmlmain.minimum_cut(capacity, pairs)
    cost = sum(c if c > 0 and not s else -c if c < 0 and s else 0 for c, s in zip(capacity, side))
    cost += sum(c for i, j, c in pairs if side[i] != side[j])
    assert cost == brute_cut(capacity, pairs)


def test_long_page_and_table(spark):
    long = "<article>" + "<p>A sentence of the page.</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", long, "x"), (1, "u", PAGE, "x"), (None, None, None, None)],
                               "page_id long, url string, html string, text string")
    rows = htmlmain.extract(df).collect()
    assert len(rows) == 3 and sorted(r.n_chars for r in rows)[0] == 0
    assert max(r.n_chars for r in rows) == 20_000 * len("A sentence of the page.\n") - 1
    assert htmlmain.extract(df.limit(0)).count() == 0


def test_generated_pages(spark):
    """Independent reading of the generated pages: paragraphs and title inside <article>."""
    from html import unescape
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        inner = re.sub(r"</?b>|<!--.*?-->", "", inner).replace("<br>", " ")
        want = [" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert htmlmain.main_text(r.html) == "\n".join(x for x in want if x)


# ---- chat ----

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "a\n\\"]),
                          st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", "[",
                                                    " ", "\n", "x", "[ROLE]", "é", ">"]), max_size=8).map("".join)), max_size=6))
def test_template_round_trip(turns):
    t = chat.Template()
    formatted = "".join(x for role, text in turns for x, _ in t.segments(role, text))
    assert [(r, x) for r, x, _, _ in t.read(formatted)] == turns
    for _, text in turns:
        assert not any(mark in t.escape(text) for mark in t.control)


def test_machine_order():
    def run(*roles):
        m = chat.Machine(chat.Template())
        for r in roles:
            m.step(r)
        return m.valid, m.fault
    assert run("system", "user", "assistant") == (True, None)
    assert run("user", "assistant", "user") == (False, None)
    assert run("assistant", "user", "assistant") == (False, 0)
    assert run("user", "user", "assistant") == (False, 1)
    assert run("user", "tool", "assistant") == (False, 1)
    assert run() == (False, None)


def test_chat_digests(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["", None, "x\\<s>", "é" * 5, "[INST]"]))
            for c in (1, 2, 3, None) for t in range(rng.randrange(1, 9))]
    rows += [(7, 0, "user", "q"), (7, 0, "user", "q"), (7, 0, "assistant", "a"), (8, 0, "assistant", LONG)]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", chat.F.lit(1))
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] or ""))
        all_ = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256(all_.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[9].valid and not got[7].valid
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# ---- secrets ----

def brute_spans(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A)
        if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "api_key", "APIKEY", "password", "=", ": ", "'", '"', "abcdef", "x", "AKIA",
                                 "ABCDEFGH12345678", "0123456789abcdef", " ", "é", "\n", "ſecret", "a.b-c", "AKIAAKIA"]),
                max_size=12).map("".join))
def test_base_spans(text):
    assert sorted(secrets.base_spans(text)) == brute_spans(text)
    path = secrets.vocabulary_path()
    assert [s for s in secrets.scan(text, path) if s[1] < 3] == brute_spans(text)


def test_token_efficiency():
    path, scan = secrets.vocabulary_path(), secrets.scan
    assert [s[1] for s in scan("use x9Kd82hJs81Qp0aZ72LmN3vB6y now", path)] == [3]
    for plain in ("internationalization2024andlocalization", "user_session_identifier_2024", "550e8400-e29b-41d4-a716-446655440000",
                  "DA39A3EE5E6B4B0D3255BFEF95601890AFD80709", "12345678901234567890123", "2024-01-01/2024-12-31/2025"):
        assert scan(f"see {plain} there", path) == [], plain


def test_secret_table(spark):
    texts = ODD_TEXTS + ["token = 'abcdef123' and x9Kd82hJs81Qp0aZ72LmN3vB6y"] * 2
    got = secrets.scan_secrets(docs_of(spark, texts)).collect()
    assert len(got) == len(texts)
    assert [[s.kind for s in r.spans] for r in got if r.doc_id >= 10] == [["assign", "random"]] * 2
    assert secrets.scan_secrets(docs_of(spark, [])).count() == 0


def test_scan_of_the_documents(spark):
    path = secrets.vocabulary_path()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert [s for s in secrets.scan(r.text, path) if s[1] < 3] == brute_spans(r.text)
