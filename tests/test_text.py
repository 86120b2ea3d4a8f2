from pyspark.sql import functions as F

from rankeval.functions.text import query_echo, tokens


def test_tokens_lowercase_unicode_and_split_long_runs(spark):
    df = spark.createDataFrame([("Don't STOP: naïve café 3.14 x_y " + "a" * 600,)], "t string")
    toks = df.select(tokens("t").alias("k")).collect()[0].k
    assert toks[:6] == ["don't", "stop", "naïve", "café", "3.14", "x_y"]
    assert [len(t) for t in toks[6:]] == [255, 255, 90]


def test_query_echo(spark):
    df = spark.createDataFrame([("Wind Origin wind",)], "q string")
    assert df.select(query_echo(tokens("q")).alias("e")).collect()[0].e == "text:wind text:origin text:wind"


def test_word_rules(spark):
    """Inner apostrophes and points, digits with commas, marks, ideographs, edges."""
    cases = {
        "don't U.S. e.g. rock'n'roll 'quoted' end.": ["don't", "u.s", "e.g", "rock'n'roll", "quoted", "end"],
        "3.14 1,000.5 v1.2 a.1 1.a .5 5. 1,a": ["3.14", "1,000.5", "v1.2", "a", "1", "1", "a", "5", "5", "1", "a"],
        "cafe\u0301 na\u0308ive": ["cafe\u0301", "na\u0308ive"],
        "中文字 かな カタカナ 한국어 abc中def": ["中", "文", "字", "か", "な", "カタカナ", "한국어", "abc", "中", "def"],
        "a_b __ x-y a..b l’eau": ["a_b", "__", "x", "y", "a", "b", "l’eau"],
        "": [], "?!": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", tokens("t").alias("k"))
    assert {r.t: r.k for r in df.collect()} == cases


def test_word_classes(spark):
    """Middle dot, colon, semicolon, quotes in Hebrew, Katakana beside letters, scripts without spaces, emoji."""
    cases = {
        "col·lege a:b a::b a: :b": ["col·lege", "a:b", "a", "b", "a", "b"],
        "3;4 3·4 3:4 1,2;3.4 a;b": ["3;4", "3", "4", "3", "4", "1,2;3.4", "a", "b"],
        'צה"ל ג\'ירף ג\' "ab" a"b': ['צה"ל', "ג'ירף", "ג'", "ab", "a", "b"],
        "カタカナabc カタカナ漢字 ラーメン": ["カタカナ", "abc", "カタカナ", "漢", "字", "ラーメン"],
        "abcไทยdef ສະບາຍ": ["abc", "ไทย", "def", "ສະບາຍ"],
        "👍🏽👍 👩\u200d👩\u200d👧x 🇫🇷🇩🇪 1\ufe0f\u20e3 ❤\ufe0f © 5": ["👍🏽", "👍", "👩\u200d👩\u200d👧", "x", "🇫🇷", "🇩🇪", "1\ufe0f\u20e3", "❤\ufe0f", "5"],
        "x² ½ ⅷ so\u00adft e\u0301te": ["x", "ⅷ", "so\u00adft", "e\u0301te"],
        "a_1.5_b.c _x_": ["a_1.5_b.c", "_x_"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", tokens("t").alias("k"))
    assert {r.t: r.k for r in df.collect()} == cases


def test_emoji_ranges_are_the_property():
    import regex

    from rankeval.functions.text import EMOJI_RANGES
    listed = {c for r in EMOJI_RANGES.split() for c in range(int(r.split("-")[0], 16), int(r.split("-")[-1], 16) + 1)}
    others = {*range(0x30, 0x3A), 0x23, 0x2A, 0xA9, 0xAE, 0x203C, 0x2122, 0x3030, 0x303D, *range(0x1F1E6, 0x1F200)}
    assert listed == {c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and regex.match(r"\p{Emoji}", chr(c))} - others


def test_very_long_run_does_not_overflow(spark):
    df = spark.createDataFrame([("a" * 300_000,), ("a." * 100_000,), ("a1" * 100_000,)], "t string").coalesce(1)
    sizes = [r.n for r in df.select(F.size(tokens("t")).alias("n")).collect()]
    assert sizes == [-(-300_000 // 255), -(-199_999 // 255), -(-200_000 // 255)]


def test_words_of_a_text_are_found_once(spark):
    df = spark.createDataFrame([("a b",)], "t string").select(tokens("t").alias("k"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_plain_words_are_cut_as_by_the_classes(spark):
    import random

    from rankeval.functions import text
    rng = random.Random(3)
    signs = list("abzéßªµ09_.:,;'\"#*- @\n\x00\x7f") + ["\u0301", "\u200d", "\u200b", "\u00ad", "\u20e3", "\ufe0f", "·", "’", "ω", "я",
                                                        "漢", "カ", "א", "ไ", "٣", "👍", "🇫", "ⓐ", "A", "Z"]
    rows = [("".join(rng.choices(signs, k=rng.randint(0, 9))),) for _ in range(5000)]
    found = spark.createDataFrame(rows, "t string").select("t", *[
        F.regexp_extract_all("t", F.lit(p), 1).alias(c) for c, p in (("own", text.TOKEN_PATTERN), ("classes", f"({text._CLASSES})"))])
    assert found.filter("own != classes").limit(5).collect() == []
    assert text.TOKEN_PATTERN != f"({text._CLASSES})"
