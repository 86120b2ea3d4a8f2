"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions, each named by the bits before it.  Every decision has its own context tree over
the last ``depth`` bytes; a node of the tree holds the zeros and ones that the training texts had there and the
Krichevsky-Trofimov block probability of these counts.  A node's weighted probability is half its own plus half the
product of its children's, so a prediction mixes the estimates of all depths of the current context by how well each
explained the training texts.  A text is scored with the trees as trained: the sum over its bytes and an end mark (byte
0xFF, which also fills the context before a text).  Its code length per byte is -score * log2(10) / bytes.

1. Texts are gathered into blocks of about ``BLOCK`` bytes.  A block's rows, written to the shared folder: its distinct
   grams (context and next byte packed into a number, most recent byte first) with their training counts, its distinct
   words with theirs, and its texts in compressed segments.
2. Counts are summed over blocks.  All grams of the corpus are in the table, those of held-out texts with count 0.
3. Subtrees below the last ``TRUNK`` bytes of context are independent and hold at most 256**(depth - TRUNK + 1) grams: tasks
   weight them whole.  Above, the trees are added up level by level (grouped sums) and the mixtures are carried down
   again (joins with the parent level), then each subtree turns its grams into log probabilities.
4. Log probabilities and word counts go back to the blocks that hold the gram or word, one row each however frequent it is,
   and the block's texts are scored.

The base score is that of a smoothed word-unigram model of the same training texts.

Defined cases: null and empty texts hold the end mark alone; a null doc_id counts as the id of empty text (held out);
repeated rows are texts of their own and train again; very long texts are scored whole; without training texts all
estimates are 1/2; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, partitions, table

DEPTH, TRUNK = 5, 3
FOLDS, SMOOTHING = 10, 0.1
BLOCK, SLICE, SEGMENT, TREE_ROWS = 1 << 25, 1 << 20, 1 << 18, 1 << 18
#: Kinds of a block's rows, in this order; a row's ``place`` is four times its block's number plus its kind.
GRAMS, WORDS, TEXTS = 0, 1, 2
END = b"\xff"
LN2, LN10 = math.log(2), math.log(10)


def grams(bodies: list[bytes], depth: int) -> np.ndarray:
    """Grams of texts (each with its end mark), one per byte: the context's bytes from the most recent on, then the byte."""
    fill = END * depth
    x = np.frombuffer(b"".join([fill + b for b in bodies]), np.uint8).astype(np.int64)
    code = np.zeros(max(len(x) - depth, 0), np.int64)
    for d in range(1, depth + 1):
        code = code << 8 | x[depth - d: len(x) - d]
    code = code << 8 | x[depth:]
    if len(bodies) == 1:
        return code
    sizes = np.array(list(map(len, bodies)))
    ends = np.cumsum(sizes + depth)[:-1] - depth  # places of the fill between texts
    inside = np.ones(len(code), bool)
    inside[(ends[:, None] + np.arange(depth)).ravel()] = False
    return code[inside]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(code, kind="stable")
    code = code[order]
    new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return code[new], np.add.reduceat(n[order], new)


def blocks(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(place, gram, n, data): rows of the three kinds; ``data`` is a word, or a segment of texts with doc_id and held_out
    (an Arrow stream: one column without nulls inside travels to Python much faster than a struct of lists)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        found: list[tuple[np.ndarray, np.ndarray]] = []
        words: Counter = Counter()
        waiting: dict[bool, list[bytes]] = {False: [], True: []}
        size = held_size = segment_size = 0
        segment: list[tuple] = []
        types = {"gram": pa.int64(), "n": pa.int64(), "data": pa.binary()}
        id_kind = pa.null()

        def rows(kind: int, count: int, **columns) -> pa.RecordBatch:
            place = pa.array([number << 2 | kind] * count, pa.int64())
            return pa.RecordBatch.from_arrays([place, *[columns.get(f, pa.nulls(count, t)) for f, t in types.items()]], ["place", *types])

        def count_waiting() -> None:
            for held, bodies in waiting.items():
                if bodies:
                    code, n = np.unique(grams(bodies, depth), return_counts=True)
                    found.append((code, n * 0 if held else n))
                    if len(found) > 8:
                        found[:] = [_merged(found)]
                    tokens = b" ".join([b[:-1] for b in bodies]).split()
                    if held:
                        words.update(dict.fromkeys([*tokens, b""], 0))
                    else:
                        words.update(tokens)
                        words[b""] += len(bodies)
                    bodies.clear()

        def close_segment() -> pa.RecordBatch:
            ids, held, bodies = zip(*segment)
            texts = pa.RecordBatch.from_arrays([pa.array(ids, id_kind), pa.array(held, pa.bool_()), pa.array(bodies, pa.binary())],
                                               ["doc_id", "held_out", "body"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(texts)
            segment.clear()
            return rows(TEXTS, 1, data=pa.array([sink.getvalue().to_pybytes()], pa.binary()))

        def out() -> Iterator[pa.RecordBatch]:
            if segment:
                yield close_segment()
            code, n = _merged(found)
            for i in range(0, len(code), 1 << 17):
                c = code[i: i + (1 << 17)]
                yield rows(GRAMS, len(c), gram=pa.array(c), n=pa.array(n[i: i + (1 << 17)]))
            listed, counts = list(words), list(words.values())
            for i in range(0, len(listed), 1 << 16):
                w = listed[i: i + (1 << 16)]
                yield rows(WORDS, len(w), data=pa.array(w, pa.binary()), n=pa.array(counts[i: i + (1 << 16)], pa.int64()))

        for batch in batches:
            id_kind = batch.column(0).type
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for doc_id, held, text in zip(*[part.column(c).to_pylist() for c in range(3)]):
                    body = (text or "").encode("utf-8", "surrogatepass").lower() + END
                    segment.append((doc_id, held, body))
                    segment_size += len(body)
                    if segment_size > SEGMENT:
                        yield close_segment()
                        segment_size = 0
                    waiting[held].append(body)
                    held_size += len(body)
                    if held_size > SLICE:
                        count_waiting()
                        size, held_size = size + held_size, 0
                if size >= BLOCK:
                    count_waiting()
                    yield from out()
                    found, words, size, held_size, segment_size, number = [], Counter(), 0, 0, 0, number + 1
        count_waiting()
        if found:
            yield from out()

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "place long, gram long, n long, data binary")
    return materialise(rows, "treelm-blocks", compression="zstd")


# ---- trees ----

def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series behind eight steps of the recurrence."""
    y, product = x + 8, np.ones_like(x)
    for i in range(8):
        product *= x + i
    return (y - 0.5) * np.log(y) - y + math.log(2 * math.pi) / 2 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - np.log(product)


def block_probability(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1.0) - math.log(math.pi)


class Subtrees:
    """Weighted trees over sorted grams with their training counts, for contexts of ``low`` to ``depth`` bytes.

    ``levels[d][k]`` has, for the nodes of context length d and decision k, sorted by (context, bits): key, n0, n1, log
    weighted probability, the share of the node's own estimate, the share left for its children, and per gram its node.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int, low: int):
        self.gram, self.levels = gram, {}
        n = n.astype(float)
        for d in range(depth, low - 1, -1):
            key = gram >> 8 * (depth - d + 1) << 8 | gram & 255
            order = np.arange(len(gram)) if d == depth else np.argsort(key, kind="stable")
            key, count = key[order], n[order]
            self.levels[d] = []
            for k in range(8):
                node = key >> 8 - k  # context and the k bits before the decision
                new = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
                bit = key >> 7 - k & 1
                total, ones = np.add.reduceat(count, new), np.add.reduceat(count * bit, new)
                n0, n1, keys = total - ones, ones, node[new]
                own = block_probability(n0, n1)
                if d == depth:
                    weighted, stop, on = own, np.ones(len(own)), np.zeros(len(own))
                else:
                    child = self.levels[d + 1][k]
                    low_bits = child[0] & ((1 << k) - 1)
                    parent = np.searchsorted(keys, child[0] >> 8 + k << k | low_bits)
                    below = np.bincount(parent, weights=child[3], minlength=len(keys))
                    weighted = np.logaddexp(own, below) - LN2
                    stop, on = np.exp(own - LN2 - weighted), np.exp(below - LN2 - weighted)
                at = np.empty(len(gram), np.int64)
                at[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(node)]))
                self.levels[d].append((keys, n0, n1, weighted, stop, on, at))

    def top(self, low: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Nodes of the shortest contexts: context, decision (1, then its bits), n0, n1, log weighted probability."""
        for k, (key, n0, n1, weighted, *_) in enumerate(self.levels[low]):
            yield key >> k, key & ((1 << k) - 1) | 1 << k, n0, n1, weighted

    def log10(self, depth: int, low: int, above: dict[int, tuple[np.ndarray, ...]] | None) -> np.ndarray:
        """log10 probability of each gram's byte; ``above``: by decision depth, for the nodes of length ``low`` in the order
        of ``levels[low]``, the weight left and the mass given to 0 and to 1 by shorter contexts."""
        total = np.zeros(len(self.gram))
        for k in range(8):
            bit = (self.gram >> 7 - k & 1).astype(bool)
            if above is None:
                left, mass = np.ones(len(bit)), np.zeros(len(bit))
            else:
                at = self.levels[low][k][6]
                left, zero, one = (x[at] for x in above[k])
                mass = np.where(bit, one, zero)
            for d in range(low, depth + 1):
                _, n0, n1, _, stop, on, at = self.levels[d][k]
                estimate = (np.where(bit, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1.0)
                mass = mass + left * stop[at] * estimate
                left = left * on[at]
            total += np.log10(mass)
        return total


def _by_context(batches: Iterator[pa.RecordBatch], handle) -> Iterator[pa.RecordBatch]:
    """Calls ``handle`` with the columns of whole contexts (column 0), at least ``TREE_ROWS`` rows at a time."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += batch.num_rows
        if size >= TREE_ROWS:
            columns = [np.concatenate(x) for x in zip(*held)]
            last = int(np.searchsorted(columns[0] != columns[0][-1], False)) if columns[0][0] == columns[0][-1] else \
                int(len(columns[0]) - np.argmax(columns[0][::-1] != columns[0][-1]))
            if last:
                yield from handle([c[:last] for c in columns])
            held, size = [[c[last:] for c in columns]], len(columns[0]) - last
    if size:
        yield from handle([np.concatenate(x) for x in zip(*held)])


def _kt(n0: str, n1: str) -> Column:
    def lgamma(x: Column) -> Column:
        y, product = x + 8, x
        for i in range(1, 8):
            product = product * (x + i)
        return ((y - 0.5) * F.log(y) - y + math.log(2 * math.pi) / 2 + 1 / (12 * y) - 1 / (360 * y * y * y)
                + 1 / (1260 * y * y * y * y * y) - F.log(product))

    return lgamma(F.col(n0) + 0.5) + lgamma(F.col(n1) + 0.5) - lgamma(F.col(n0) + F.col(n1) + 1.0) - math.log(math.pi)


def _level_up(nodes: DataFrame) -> DataFrame:
    """The nodes of contexts one byte shorter, with the shares of their own estimate and of their children."""
    summed = nodes.groupBy(F.shiftright("context", 8).alias("context"), "decision").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below"))
    own = summed.withColumn("own", _kt("n0", "n1"))
    high = F.greatest("own", "below")
    weighted = high + F.log(F.exp(F.col("own") - high) + F.exp(F.col("below") - high)) - LN2
    return own.withColumn("weighted", weighted).select(
        "context", "decision", "n0", "n1", "weighted", F.exp(F.col("own") - LN2 - F.col("weighted")).alias("stop"),
        F.exp(F.col("below") - LN2 - F.col("weighted")).alias("on"))


def _level_down(level: DataFrame, above: DataFrame | None) -> DataFrame:
    """(context, decision, left, zero, one): weight left after this level, and mass given to each bit up to it."""
    if above is None:
        level = level.withColumns({"left": F.lit(1.0), "zero": F.lit(0.0), "one": F.lit(0.0)})
    else:
        level = level.withColumn("parent", F.shiftright("context", 8)).join(
            above.withColumnRenamed("context", "parent"), ["parent", "decision"])
    own, total = F.col("left") * F.col("stop"), F.col("n0") + F.col("n1") + 1.0
    return level.select("context", "decision", (F.col("left") * F.col("on")).alias("left"),
                        (F.col("zero") + own * (F.col("n0") + 0.5) / total).alias("zero"),
                        (F.col("one") + own * (F.col("n1") + 0.5) / total).alias("one"))


def gram_scores(counts: DataFrame, depth: int = DEPTH, trunk: int = TRUNK) -> DataFrame:
    """(gram, lp) of (gram, n): log10 probability of the gram's byte in its context."""
    tasks = partitions(counts.sparkSession)
    rows = counts.select(F.shiftright("gram", 8 * (depth - trunk + 1)).alias("context"), "gram", "n")

    def up(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for context, decision, n0, n1, weighted in Subtrees(columns[1], columns[2], depth, trunk).top(trunk):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (context, decision.astype(np.int32), n0, n1, weighted)],
                                             ["context", "decision", "n0", "n1", "weighted"])

    lowest = materialise(rows.repartition(tasks, "context").sortWithinPartitions("context", "gram").mapInArrow(
        lambda batches: _by_context(batches, up), "context long, decision int, n0 double, n1 double, weighted double"), "treelm-nodes")
    levels = [lowest]
    for _ in range(trunk):  # levels[i]: contexts of trunk - i bytes, at most 256**(trunk - i) * 255 nodes
        levels.append(materialise(_level_up(levels[-1]), "treelm-level"))
    above = None
    for level in reversed(levels[1:]):
        above = _level_down(level, above)
    carried = lowest.select("context", "decision", F.shiftright("context", 8).alias("parent")).join(
        above.withColumnRenamed("context", "parent"), ["parent", "decision"])
    zero = F.lit(0.0)
    both = rows.select("context", F.lit(1).alias("kind"), "gram", "n", zero.alias("left"), zero.alias("zero"), zero.alias("one")).unionByName(
        carried.select("context", F.lit(0).alias("kind"), F.col("decision").cast("long").alias("gram"), F.lit(0).cast("long").alias("n"),
                       "left", "zero", "one"))

    def down(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        context, kind, gram, n = columns[:4]
        own = kind == 1
        trees = Subtrees(gram[own], n[own], depth, trunk)
        node, masses = context[~own] << 8 | gram[~own], [c[~own] for c in columns[4:]]
        order = np.argsort(node)
        above = {}
        for k, (key, *_) in enumerate(trees.levels[trunk]):
            wanted = key >> k << 8 | key & ((1 << k) - 1) | 1 << k
            at = order[np.searchsorted(node, wanted, sorter=order)]
            above[k] = tuple(m[at] for m in masses)
        yield pa.RecordBatch.from_arrays([pa.array(trees.gram), pa.array(trees.log10(depth, trunk, above))], ["gram", "lp"])

    return both.repartition(tasks, "context").sortWithinPartitions("context", "kind", "gram").mapInArrow(
        lambda batches: _by_context(batches, down), "gram long, lp double")


# ---- scoring ----

class Places:
    """Places of 64-bit keys in an array of distinct keys: hash tables of falling size, each for the keys that collided before."""

    FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        rest = np.arange(len(keys))
        while len(rest):
            bits = max(4, int(len(rest) * 4).bit_length())
            factor = self.FACTORS[len(self.tables) % 4] + np.uint64(2 * (len(self.tables) // 4))
            slot = self._slots(keys[rest], factor, bits)
            table = np.zeros(1 << bits, np.int32)
            table[slot] = rest
            self.tables.append((factor, bits, table))
            rest = rest[table[slot] != rest]

    @staticmethod
    def _slots(keys: np.ndarray, factor: np.uint64, bits: int) -> np.ndarray:
        return (keys.view(np.uint64) * factor >> np.uint64(64 - bits)).astype(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """Every wanted key must be there."""
        out = np.empty(len(wanted), np.int64)
        rest = None
        for factor, bits, table in self.tables:
            own = wanted if rest is None else wanted[rest]
            at = table[self._slots(own, factor, bits)]
            hit = self.keys[at] == own
            if rest is None:
                out[:] = at
                rest = np.flatnonzero(~hit)
            else:
                out[rest[hit]] = at[hit]
                rest = rest[~hit]
            if not len(rest):
                return out
        raise KeyError("a gram of the block has no probability")


def _scorer(depth: int, tokens: int, distinct: int):
    """Rows of blocks in the order of ``place``; ``value`` is a gram's log probability or a word's count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        values: list[np.ndarray] = []
        words: dict[bytes, int] = {}
        counts: list[np.ndarray] = []
        model = None
        for batch in batches:
            place = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True])
            for i, j in zip(edges.tolist(), edges[1:].tolist()):
                part, kind = batch.slice(i, j - i), int(place[i]) & 3
                if kind == GRAMS:
                    if model is not None:  # a new block
                        keys, values, words, counts, model = [], [], {}, [], None
                    keys.append(part.column(1).to_numpy(zero_copy_only=False).astype(np.int64))
                    values.append(part.column(2).to_numpy(zero_copy_only=False))
                elif kind == WORDS:
                    words.update(zip(part.column(3).to_pylist(), range(len(words), len(words) + j - i)))
                    counts.append(part.column(2).to_numpy(zero_copy_only=False))
                else:
                    if model is None:
                        c = np.concatenate(counts)
                        model = (Places(np.concatenate(keys)), np.concatenate(values), words,
                                 np.log10((c + SMOOTHING) / (tokens + SMOOTHING * (distinct + 1))), (c > 0).astype(np.int64))
                    for row in part.column(3):
                        yield scored(pa.ipc.open_stream(row.as_buffer()).read_next_batch(), *model)

    def scored(texts: pa.RecordBatch, places: Places, lp, words, unigram, known) -> pa.RecordBatch:
        bodies = texts.column(2).to_pylist()
        sizes = np.array(list(map(len, bodies)))
        score = np.add.reduceat(lp[places.of(grams(bodies, depth))], np.cumsum(sizes) - sizes)
        listed = [[*b[:-1].split(), b""] for b in bodies]
        n = np.array(list(map(len, listed)))
        at = np.fromiter(map(words.__getitem__, [w for t in listed for w in t]), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        return pa.RecordBatch.from_arrays(
            [texts.column(0), texts.column(1), pa.array(n), pa.array(np.add.reduceat(known[at], first)),
             pa.array([tokens] * len(n), pa.int64()), pa.array(np.add.reduceat(unigram[at], first)), pa.array(score)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per row of ``docs``."""
    if not TRUNK < depth <= 6:
        raise ValueError("contexts of 4 to 6 bytes")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = blocks(docs, depth)
    kind = F.col("place").bitwiseAND(F.lit(3))
    own = made.filter(kind == GRAMS).select("place", "gram", "n")
    counts = materialise(own.groupBy("gram").agg(F.sum("n").alias("n")), "treelm-grams")
    scores = gram_scores(counts, depth)
    listed = made.filter(kind == WORDS).select("place", "data", "n")
    words = materialise(listed.groupBy("data").agg(F.sum("n").alias("n")), "treelm-words")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))).first()
    null = {"gram": "long", "value": "double", "data": "binary"}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select("place", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in null.items()])

    back = shaped(own.select("place", "gram").join(scores.withColumnRenamed("lp", "value"), "gram")).unionByName(
        shaped(listed.select("place", "data").join(words.select("data", F.col("n").cast("double").alias("value")), "data"))).unionByName(
        shaped(made.filter(kind == TEXTS).select("place", "data")))
    rows = back.repartition(partitions(docs.sparkSession), F.shiftright("place", 2)).sortWithinPartitions("place")
    return rows.mapInArrow(_scorer(depth, tokens, distinct), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
                           "train_tokens long, base_score double, score double")


def op12_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
