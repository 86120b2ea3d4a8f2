"""Quality rules by distribution divergence.

Each document's histogram of character classes and of its language's most common words is compared with the
language's reference by the Jensen-Shannon distance (square root of the base-2 divergence, 0 to 1).  The
references are counted over all documents of the language; the common words are the ``COMMON`` most frequent
ones, everything else is one further bin.  A histogram is judged only from a minimum length on, on both sides,
so short texts are never rejected for noise.

Two passes over the texts: partial word and class counts per language (summed by Spark), then one row per
document.  What the second pass carries is ``COMMON + classes`` numbers per language.

Base rules (exact): a document with fewer than 10 words, or with more than a fifth of its words inside
repeated 5-word windows, fails whatever its distances.

Defined cases: a null text has no words and fails the base; a null language is a language of its own; a language
whose reference is below the minimum length judges nobody; common words with equal counts rank by the word; repeated rows
count and are judged each; very long texts are processed whole; an empty table gives an empty result; extra columns are
ignored by the query and carried by the stage, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, materialise, struct_of, table

COMMON = 50
MIN_CHARS, MIN_WORDS, MIN_REFERENCE_WORDS = 200, 100, 1000
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.36
#: Separators and the symbols counted by the base rule.
SPACES, SYMBOLS, PUNCTUATION = " \t\n\x0b\x0c\r", "#*$%&|<>", ".,;:!?'\"()-"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other_ascii", "other")
WINDOW = 5

_CLASS_OF = np.full(128, CLASSES.index("other_ascii"), np.int8)
for _name, _chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                      ("digit", "0123456789"), ("space", SPACES), ("punctuation", PUNCTUATION), ("symbol", SYMBOLS)):
    for _c in _chars:
        _CLASS_OF[ord(_c)] = CLASSES.index(_name)


def char_classes(text: str) -> np.ndarray:
    """Counts by class; beyond ASCII, cased letters count as lower or upper and the rest as other."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ascii_ = code[code < 128]
    counts = np.bincount(_CLASS_OF[ascii_], minlength=len(CLASSES)).astype(np.int64)
    values, n = np.unique(code[code >= 128], return_counts=True)
    for v, k in zip(values.tolist(), n.tolist()):
        c = chr(v)
        name = "lower" if c.islower() else "upper" if c.isupper() else "other"
        counts[CLASSES.index(name)] += k
    return counts


def words_of(text: str) -> list[str]:
    """Maximal runs without ASCII white space."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more in the list (first ones included)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    code, base = ids[:n], len(index)
    bound = base
    for i in range(1, window):  # exact mixed-radix codes; renumbered whenever the next digit might overflow
        if bound > (1 << 62) // base:
            seen, code = np.unique(code, return_inverse=True)
            bound = len(seen)
        code, bound = code * base + ids[i: n + i], bound * base
    _, inverse, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[inverse] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[twice] += 1
    np.add.at(edge, twice + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms with positive sums."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(x):
        some = x > 0
        return float((x[some] * np.log2(x[some] / m[some])).sum())

    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def _count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, item, n): word counts (kind w) and class counts (kind c), partial."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["lang", "kind", "item", "n"])
        counts.clear()
        return batch

    for batch in batches:
        own: dict[str | None, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            own.setdefault(lang, Counter()).update(words_of(text.lower()))
            for name, n in zip(CLASSES, char_classes(text).tolist()):
                if n:
                    counts[lang, "c", name] += n
        for lang, c in own.items():
            for w, n in c.items():
                counts[lang, "w", w] += n
        if len(counts) > 200_000:
            yield out()
    if counts:
        yield out()


def references(docs: DataFrame, common: int = COMMON) -> dict:
    """Per language: class counts, common words with counts, number of words (collected: bounded per language)."""
    partial = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = partial.mapInArrow(_count_partition, "lang string, kind string, item string, n long")
    counts = materialise(counts.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")), "counts")
    words = counts.filter("kind = 'w'")
    # group limit before the window: each task sends its own top rows per language, not its vocabulary
    top = words.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "item"))).filter(
        F.col("rank") <= common).select("lang", "kind", "item", "n")
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit("t").alias("kind"), F.lit("").alias("item"), "n")
    refs: dict = {}
    for lang, kind, item, n in counts.filter("kind = 'c'").unionByName(top).unionByName(total).collect():
        refs.setdefault(lang, {"c": {}, "w": {}, "t": {}})[kind][item] = n
    out = {}
    for lang, r in refs.items():
        listed = sorted(r["w"], key=lambda w: (-r["w"][w], w))
        known, all_ = [r["w"][w] for w in listed], r["t"].get("", 0)
        out[lang] = (np.array([r["c"].get(c, 0) for c in CLASSES], float), {w: i for i, w in enumerate(listed)},
                     np.array([*known, all_ - sum(known)], float), all_)
    return out


def judge(text: str, ref, max_char: float, max_word: float) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char distance, word distance, kept."""
    words = words_of(text)
    base = base_counts(text, words)
    failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
    char_d = word_d = None
    if ref is not None and ref[3] >= MIN_REFERENCE_WORDS:
        if len(text) >= MIN_CHARS:
            char_d = distance(char_classes(text).astype(float), ref[0])
        if base[0] >= MIN_WORDS:
            hist = np.zeros(len(ref[2]))
            for w, n in Counter(words_of(text.lower())).items():
                hist[ref[1].get(w, -1)] += n
            word_d = distance(hist, ref[2])
    off = (char_d is not None and char_d > max_char) or (word_d is not None and word_d > max_word)
    return (*base, failed, char_d, word_d, not failed and not off)


def score(docs: DataFrame, max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
          carry: bool = False) -> DataFrame:
    """One row per document with its counts, distances and verdict; ``carry`` keeps the input's columns instead
    and returns only the rows kept."""
    lang, text = fresh(docs, "lang_"), fresh(docs, "text_")
    docs = docs.withColumns({lang: F.col("lang").cast("string"), text: F.col("text").cast("string")})
    refs = docs.sparkSession.sparkContext.broadcast(references(docs))  # COMMON + classes numbers per language
    if carry:
        schema = docs.drop(lang, text).schema
    else:
        docs = docs.select("doc_id", lang, text)
        schema = struct_of(
            ("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("n_words", "bigint"), ("word_chars", "bigint"),
            ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"),
            ("char_distance", "double"), ("word_distance", "double"), ("kept", "boolean"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index(text))
            langs = batch.column(names.index(lang)).to_pylist()
            rows = [judge(t.as_py() or "", refs.value.get(own), max_char, max_word) for own, t in zip(langs, texts)]
            if carry:
                kept = batch.filter(pa.array([r[-1] for r in rows], pa.bool_()))
                yield kept.select(schema.names)
                continue
            types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(names.index("doc_id")), *columns], schema.names)

    return docs.mapInArrow(run, schema)


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


def keep_good(docs: DataFrame) -> DataFrame:
    """Pipeline stage: rejected documents go."""
    return score(docs, carry=True)
