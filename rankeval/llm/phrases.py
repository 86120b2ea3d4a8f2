"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

1. Texts are lower-cased (A-Z), cut into pieces and words, and stored as blocks: the block's own words with their
   counts, and a stream of word numbers in which 0 ends a piece.  A block holds about ``BLOCK`` words; a longer text is
   cut into parts, each followed by the next two words, which start no suffix there and only complete phrases.
2. Words are counted per language.  A phrase is never more frequent than its words, so the suffixes of words below the
   least count are abandoned here, and the others get dense global numbers, which go back to the blocks.
3. Every word of a block is a suffix pointer; equal suffixes (to the maximum depth) of a block are folded into one
   weighted pointer, and the pointers are routed by their two leading words, so a frequent leading word is spread over
   all tasks and a pair's suffixes meet in one.
4. In a task all pointers are sorted at once by a three-way multikey quicksort: less and greater parts stay at their
   word, an equal part goes on to the next word; the weight of an equal part is the phrase's count, and a part lighter
   than the least count is abandoned, since no phrase in it can be frequent.
5. The frequent phrases are joined with the counts of their parts, scored with exact integers and ranked.

Defined cases: null text is empty; a null language is ``und``; repeated rows count again, equal scores rank by count and
then by the phrase's bytes; very long texts are processed whole; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, partitions, table

DEPTH, LEAST, COVER, TOP = 3, 10, 50, 2000
#: Words a block closes at; two such numbers and one more fit three times into 63 bits.
BLOCK, BITS = 1 << 20, 21
#: Pointers that one sorting task is dealt, about.
TASK = 1 << 21
#: Marks that end a piece, besides the line breaks 0x0A to 0x0D.
MARKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(0x0A if c in MARKS else 0x20 if c == 0x09 else c for c in range(256))


class Numbers(dict):
    """Numbers of words from 1 on, in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1
        return n


def cut(text: str) -> list[bytes]:
    """Words of a text in order, with b"." where a piece ends (no word holds a point)."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_PLAIN).replace(b"\n", b" . ").split()


def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """(block, pos, lang, word, n, stream): per block one row for each of its words (pos from 1 on), then one with pos 0
    and the stream of positions; 0 ends a piece, a negative number is a word that starts no suffix here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        known: dict[str, Numbers] = {}
        held: list[tuple[str, np.ndarray]] = []
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            base, at, langs, words = {}, 0, [], []
            for lang, own in known.items():
                base[lang], at = at, at + len(own)
                langs += [lang] * len(own)
                words += own
            stream = np.concatenate([np.where(x > 0, x + base[lang], np.where(x < 0, x - base[lang], 0)) for lang, x in held])
            n = np.bincount(stream[stream > 0], minlength=at + 1)[1:]
            for i in range(0, at, 1 << 16):
                k = min(1 << 16, at - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * k, pa.int64()), pa.array(np.arange(i + 1, i + k + 1), pa.int32()),
                     pa.array(langs[i: i + k], pa.string()), pa.array(words[i: i + k], pa.binary()).cast(pa.string()),
                     pa.array(n[i: i + k]), pa.nulls(k, pa.binary())], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([0], pa.int32()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
                 pa.nulls(1, pa.int64()), pa.array([stream.astype("<i4").tobytes()], pa.binary())], names)

        names = ["block", "pos", "lang", "word", "n", "stream"]
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                words = cut(text.as_py() or "")
                lang = lang.as_py()
                for i in range(0, len(words), size):
                    own = known.setdefault(lang, Numbers())
                    own_get = own.__getitem__
                    part = words[i: i + size]
                    x = np.fromiter([0 if w == b"." else own_get(w) for w in part], np.int64, len(part))
                    tail = [0 if w == b"." else -own_get(w) for w in words[i + size: i + size + DEPTH - 1]]
                    held.append((lang, np.r_[x, tail, 0].astype(np.int64)))
                    count += len(part)
                    if count >= size:
                        yield from out()
                        known, held, count, number = {}, [], 0, number + 1
        if held:
            yield from out()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string")).mapInArrow(
        run, "block long, pos int, lang string, word string, n long, stream binary")
    return materialise(rows, "phrase-blocks", compression="zstd")


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with a dense ``id`` from 1 on: places in written parts, plus one offset per part."""
    placed = materialise(rows.withColumn("part", F.spark_partition_id()).withColumn(
        "place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per written part
    offsets = placed.groupBy("part").agg(F.count("*").alias("k")).select(
        "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").withColumn("id", F.col("offset") + F.col("place") + 1).drop(
        "part", "place", "offset")


def _pointers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, pos, id, stream), a block's numbers before its stream: weighted suffix pointers (id1, id2, id3, n)."""
    places: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    for batch in batches:
        pos = batch.column(1).to_numpy()
        number = batch.column(2).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(pos == 0)
        start = 0
        for end in [*ends.tolist(), len(pos)]:
            places.append(pos[start:end])
            ids.append(number[start:end])
            start = end + 1
            if end == len(pos):
                break
            stream = np.frombuffer(batch.column(3)[end].as_py(), "<i4").astype(np.int64)
            word = np.abs(stream)
            of = np.zeros(int(word.max(initial=0)) + 1, np.int64)
            of[np.concatenate(places)] = np.concatenate(ids)
            places, ids = [], []
            word[of[word] == 0] = 0
            word = np.r_[word, 0, 0]
            first, second, third = word[:-2], word[1:-1], word[2:]
            some = (stream > 0) & (first > 0) & (second > 0)
            code, n = np.unique(first[some] << 2 * BITS | second[some] << BITS | third[some], return_counts=True)
            low = (1 << BITS) - 1
            for i in range(0, len(code), 1 << 17):
                c = code[i: i + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[x].astype(np.int32)) for x in (c >> 2 * BITS, c >> BITS & low, c & low)]
                    + [pa.array(n[i: i + (1 << 17)].astype(np.int32))], ["id1", "id2", "id3", "n"])


def pointers(made: DataFrame, words: DataFrame) -> DataFrame:
    back = made.filter("pos > 0").select("block", "pos", "lang", "word").join(
        words.select("lang", "word", "id"), ["lang", "word"]).select("block", "pos", "id", F.lit(None).cast("binary").alias("stream"))
    streams = made.filter("pos = 0").select("block", "pos", F.lit(0).cast("long").alias("id"), "stream")
    rows = back.unionByName(streams).repartition(partitions(made.sparkSession), "block").sortWithinPartitions(
        "block", F.desc("pos")).select("block", "pos", "id", "stream")
    return rows.mapInArrow(_pointers, "id1 int, id2 int, id3 int, n int")


def multikey(keys: list[np.ndarray], weight: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per depth (one pointer of each equal part, its weight) of all equal parts of at least ``least``.

    Three-way multikey quicksort, all open parts in step: each is split by one of its pointers' words; lighter parts
    are abandoned.  Key 0 means that the suffix has ended; such parts are not phrases.
    """
    n = len(weight)
    pointer = np.random.default_rng(0).permutation(n)  # any member of a part is then a random pivot
    part, depth = np.zeros(n, np.int64), np.zeros(1, np.int64)
    found: list[list] = [[] for _ in keys]
    key = keys[0][pointer]
    while len(pointer):
        pivot = np.zeros(len(depth), key.dtype)
        pivot[part] = key
        side = np.sign(key - pivot[part]) + 1
        part = part * 3 + side
        total = np.bincount(part, weights=weight[pointer], minlength=3 * len(depth)).astype(np.int64)
        own = np.repeat(depth, 3)
        equal = np.arange(len(total)) % 3 == 1
        keep = total >= least
        one = np.zeros(len(total), np.int64)
        one[part] = pointer
        for d in range(len(keys)):
            here = np.flatnonzero(equal & keep & (own == d))
            here = here[keys[d][one[here]] != 0]
            found[d].append((one[here], total[here]))
        # an equal part whose word is 0 is the end of its suffixes; at the last depth nothing is left to split
        value = np.zeros(len(total), key.dtype)
        value[part] = key
        keep &= ~(equal & ((value == 0) | (own == len(keys) - 1)))
        own = own + equal
        label = np.cumsum(keep) - 1
        stay = keep[part]
        pointer, part, depth = pointer[stay], label[part[stay]], own[keep]
        level = depth[part]
        key = np.zeros(len(pointer), keys[0].dtype)
        for d in range(len(keys)):
            at = np.flatnonzero(level == d)
            key[at] = keys[d][pointer[at]]
    return [(np.concatenate([x for x, _ in f] or [np.empty(0, np.int64)]),
             np.concatenate([x for _, x in f] or [np.empty(0, np.int64)])) for f in found]


def frequent(points: DataFrame, least: int, tasks: int) -> DataFrame:
    """(id1, id2, id3, a, lead): phrases of two words (id3 0, lead null) and of three, whose ``lead`` is the count of
    their first two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, limit = 0, 4 * TASK

        def folded() -> np.ndarray:
            rows = np.concatenate(held)
            rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
            new = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)])
            return np.c_[rows[new, :3], np.add.reduceat(rows[:, 3], new)]

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(4)], 1).astype(np.int64))
            size += batch.num_rows
            if size > limit:  # copies of a pointer from many blocks become one
                held = [folded()]
                size = len(held[0])
                limit = max(4 * TASK, 2 * size)
        if not size:
            return
        rows = np.concatenate(held)
        held.clear()
        keys = [np.ascontiguousarray(rows[:, d]) for d in range(DEPTH)]
        _, pairs, triples = multikey(keys, rows[:, 3], least)
        lead = {(a, b): n for a, b, n in zip(keys[0][pairs[0]].tolist(), keys[1][pairs[0]].tolist(), pairs[1].tolist())}
        p, t = pairs[0], triples[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[keys[0][p], keys[0][t]]), pa.array(np.r_[keys[1][p], keys[1][t]]),
             pa.array(np.r_[np.zeros(len(p), np.int64), keys[2][t]]), pa.array(np.r_[pairs[1], triples[1]]),
             pa.array([None] * len(p) + [lead[k] for k in zip(keys[0][t].tolist(), keys[1][t].tolist())], pa.int64())],
            ["id1", "id2", "id3", "a", "lead"])

    rows = points.repartition(tasks, "id1", "id2").mapInArrow(run, "id1 long, id2 long, id3 long, a long, lead long")
    return materialise(rows, "phrases")


def _score(a: str, l: str, r: str):
    """floor(1000000 a a / (l r)) in exact decimals."""
    return F.expr(f"(cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))) div "
                  f"(cast({l} as decimal(18,0)) * cast({r} as decimal(18,0)))")


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two or three words."""
    made = blocks(docs)
    counts = materialise(made.filter("pos > 0").groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = numbered(counts.filter(F.col("f") >= least), "phrase-numbers")
    all_words = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    tasks = max(partitions(docs.sparkSession), -(-all_words // TASK))
    found = frequent(pointers(made, words), least, tasks)
    pairs = found.filter("id3 = 0").select("id1", "id2", "a")
    # a phrase inside a longer one that is at least half as frequent goes
    inside = found.filter("id3 > 0").select(
        F.inline(F.array(F.struct("id1", "id2", "a"), F.struct(F.col("id2").alias("id1"), F.col("id3").alias("id2"), "a"))))
    longest = inside.groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    two = pairs.join(longest, ["id1", "id2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).select("id1", "id2", "a")
    three = found.filter("id3 > 0").join(
        pairs.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("a").alias("rest")), ["id2", "id3"])
    both = two.select("id1", "id2", F.lit(0).cast("long").alias("id3"), "a", F.lit(None).cast("long").alias("lead"),
                      F.lit(None).cast("long").alias("rest")).unionByName(three)
    for k in (1, 2, 3):
        own = words.select(F.col("id").alias(f"id{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"),
                           *[F.col("lang")] * (k == 1))
        both = both.join(own, f"id{k}", "left" if k == 3 else "inner")
    first = F.struct(_score("a", "f1", "if(id3 = 0, f2, rest)").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"),
                     F.expr("if(id3 = 0, f2, rest)").alias("r"))
    second = F.when(F.col("id3") > 0, F.struct(_score("a", "lead", "f3").alias("score"), F.lit(2).alias("k"),
                                               F.col("lead").alias("l"), F.col("f3").alias("r")))
    scored = both.withColumn("cut", F.least(first, second)).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


#: DuckDB SQL: pieces, all phrases of one to three words, cuts, containment and ranks.
OP11_SQL = """WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
grams AS (
  SELECT lang, k, w[i : i + k - 1] AS g
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), (SELECT unnest([1, 2, 3]) AS k)
  WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS a FROM grams GROUP BY ALL),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND a >= 10),
longer AS (SELECT lang, x AS g, max(a) AS a FROM (SELECT lang, unnest([g[1:2], g[2:3]]) AS x, a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, g) WHERE c.k = 3 OR longer.a IS NULL OR 100 * longer.a < 50 * c.a),
cuts AS (SELECT lang, k, g, a, unnest(range(1, k)) AS j FROM kept),
scored AS (
  SELECT cuts.lang, cuts.g, cuts.a, j, l.a AS l, r.a AS r,
         (1000000::HUGEINT * cuts.a * cuts.a) // (l.a::HUGEINT * r.a) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.g = cuts.g[1:j] JOIN f r ON r.lang = cuts.lang AND r.g = cuts.g[j + 1:cuts.k]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (
           PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""
