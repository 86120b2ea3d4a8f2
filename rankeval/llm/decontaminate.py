"""Benchmark decontamination by latent semantic retrieval.

1. Words (lower case, letters and digits) of every whole text are written as numbers of the benchmark's
   vocabulary (0: a word no benchmark item has), once, into the shared folder.
2. Document frequencies over all documents give idf weights.  Content words are those in fewer than ``MAX_DF`` of the
   documents, and each item's ``RAREST`` rarest words whatever their frequency, so no item is without any.
3. Distributed randomised SVD of the L2-normalised TF-IDF rows of all passages (tiles of ``TILE`` words of all
   documents, and the benchmark's pieces): tasks add up A'(A Omega), partial sums meet by block of the
   vocabulary, the driver orthonormalises a matrix of vocabulary x rank (bounded by the benchmark), and a second pass
   gives the Ritz vectors.
4. Candidates: every tile and half tile (each overlapping the next by half) whose latent vector has a cosine of
   ``MIN_COSINE`` or more with that of a benchmark piece.  No cap on candidates.
5. Checks on the words: first an exact bound (the content words of the item around the tile, and all its words in a
   window, are at least as many as the common subsequence needs), then the longest common subsequence with the item, in windows of 1.5 times its length around the
   tile.  A share of ``SURE`` decides alone; from ``MAYBE`` on the item's answer (its last sentence, or the last
   third of a single sentence) must also be there by ``ANSWER`` of its words.

Steps 4 and 5 run where the document is; nothing is shuffled.  The benchmark is the stated query set; beyond ``BLOCK_BYTES`` it
is taken in blocks, each with its own vocabulary and space.

Defined cases: null and wordless texts or items match nothing; repeated documents and items each give their own
rows; an empty table on either side gives an empty result; very long texts are read whole, items longer than a tile
are searched by pieces and checked whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import materialise, struct_of, table

RANK, OVERSAMPLE, SEED = 96, 16, 42
TILE, MAX_DF, RAREST = 64, 0.1, 5
MIN_COSINE, SURE, MAYBE, ANSWER = 0.45, 0.8, 0.55, 0.6
BLOCK_BYTES, TERM_BLOCK, SEGMENT = 4 << 20, 512, 1 << 18

WORDS = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


class Benchmark:
    """One block of items: vocabulary numbers from 1, word numbers per item, and where its answer begins."""

    def __init__(self, rows: list[tuple[object, str]]):
        self.number: dict[str, int] = {}
        self.ids, self.items, self.answers = [], [], []
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            sentences = [s for s in map(words_of, SENTENCE.split(text)) if s]
            last = len(sentences[-1]) if len(sentences) > 1 else max(1, len(words) // 3)
            self.ids.append(item_id)
            self.items.append([self.number.setdefault(w, len(self.number) + 1) for w in words])
            self.answers.append(len(words) - last)
        self.size = len(self.number) + 1
        step = TILE // 2
        #: (item, offset) of each piece: a long item is cut into overlapping tiles
        self.pieces = [(i, at) for i, x in enumerate(self.items)
                       for at in (range(0, len(x) - step, step) if len(x) > TILE else (0,))]

    def weights(self, n_docs: int, df: np.ndarray) -> np.ndarray:
        """idf by word number, zero for words that are not content."""
        idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1e-3
        content = df < MAX_DF * n_docs
        for x in self.items:
            rare = np.unique(x)
            content[rare[np.argsort(df[rare], kind="stable")[:RAREST]]] = True
        content[0] = False
        return np.where(content, idf, 0.0).astype(np.float32)


def word_numbers(docs: DataFrame, benchmark: Benchmark) -> DataFrame:
    """(doc_id, words): 32-bit vocabulary numbers of each whole text, written to the shared folder."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    number = docs.sparkSession.sparkContext.broadcast(benchmark.number)  # the block's words: bounded by BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encode(t.as_py(), number.value).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "words"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, struct_of(("doc_id", id_type), ("words", "binary")))
    return materialise(rows, "words", compression="zstd")


def encode(text: str | None, number: dict[str, int]) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(number.get, words, repeat(0)), "<i4", len(words))


def document_frequencies(numbered: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Documents, and per vocabulary number those that hold the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for w in batch.column(0):
                df[np.unique(np.frombuffer(w.as_py(), "<i4"))] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["word", "n"])

    total = numbered.count()
    rows = numbered.select("words").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = np.zeros(size, np.int64)
    for word, n in rows.collect():  # at most one row per word of the benchmark block
        df[word] = n
    return total, df


def _tiles(batch_words: list[np.ndarray], width: int, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Content words of a batch: (word, tile), tiles counted through the batch, and the first tile of each text."""
    counts = np.array([-(-len(w) // width) for w in batch_words], np.int64)
    first = np.cumsum(counts) - counts
    flat = np.concatenate(batch_words) if batch_words else np.empty(0, np.int32)
    sizes = np.array([len(w) for w in batch_words], np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = weight[flat] > 0
    return flat[keep], (np.repeat(first, sizes) + at // width)[keep], first, int(counts.sum())


def gram_times(words: np.ndarray, tile: np.ndarray, weight: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    """A'(A right) of the normalised TF-IDF rows given as (word, tile) occurrences; tile ascending."""
    if not len(words):
        return None
    pair = tile * len(weight) + words
    pair, tf = np.unique(pair, return_counts=True)
    tile, words = np.divmod(pair, len(weight))
    value = (weight[words] * tf).astype(right.dtype)
    begin = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    row = np.cumsum(np.r_[False, tile[1:] != tile[:-1]])
    value /= np.sqrt(np.add.reduceat(value * value, begin, dtype=np.float64)).astype(right.dtype)[row]
    product = np.add.reduceat(value[:, None] * right[words], begin)
    order = np.argsort(words, kind="stable")
    words = words[order]
    begin = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    out = np.zeros_like(right)
    out[words[begin]] = np.add.reduceat(value[order][:, None] * product[row[order]], begin)
    return out


def _distributed_gram_times(numbered: DataFrame, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A'(A right) over the passages of all documents; sums meet by block of vocabulary rows."""
    spark = numbered.sparkSession
    shared = spark.sparkContext.broadcast((weight, right.astype(np.float32)))  # tasks add batches up in double
    columns = right.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, right = shared.value
        total = np.zeros(right.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [np.frombuffer(w.as_py(), "<i4") for w in batch.column(0).slice(at, 256)]
                words, tile, _, _ = _tiles(texts, TILE, weight)
                for part in _pieces(tile):
                    if (y := gram_times(words[part], tile[part], weight, right)) is not None:
                        total += y
        blocks = range(0, len(total), TERM_BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(range(len(blocks))), pa.int32()), pa.array([total[b: b + TERM_BLOCK].tobytes() for b in blocks], pa.binary())],
            ["block", "rows"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                y = np.frombuffer(rows.as_py())
                sums[block] = sums[block] + y if block in sums else y
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([y.tobytes() for y in sums.values()], pa.binary())], ["block", "rows"])

    schema = "block int, rows binary"
    summed = numbered.select("words").mapInArrow(partial, schema).repartition("block").mapInArrow(add, schema)
    out = np.zeros_like(right)
    for block, rows in summed.collect():  # vocabulary x rank numbers
        y = np.frombuffer(rows).reshape(-1, columns)
        out[block * TERM_BLOCK: block * TERM_BLOCK + len(y)] = y
    shared.unpersist()
    return out


def _pieces(tile: np.ndarray, most: int = 1 << 16) -> Iterator[slice]:
    """Slices of about ``most`` occurrences that end between tiles: bounded memory for very long texts."""
    begin = 0
    while begin < len(tile):
        end = begin + most
        if end < len(tile):
            end = int(np.searchsorted(tile, tile[end]))
            end = end if end > begin else int(np.searchsorted(tile, tile[begin], "right"))
        yield slice(begin, min(end, len(tile)))
        begin = end


def latent_space(numbered: DataFrame, benchmark: Benchmark, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (vocabulary x rank) of the passages of documents and benchmark, by randomised SVD."""
    columns = min(rank + OVERSAMPLE, max(1, int((weight > 0).sum())))
    basis = np.random.default_rng(SEED).standard_normal((len(weight), columns)) * (weight > 0)[:, None]
    own = [(np.array(benchmark.items[i][at: at + TILE], np.int64), p) for p, (i, at) in enumerate(benchmark.pieces)]
    words = np.concatenate([w for w, _ in own])
    piece = np.repeat([p for _, p in own], [len(w) for w, _ in own])
    some = weight[words] > 0
    words, piece = words[some], piece[some]

    def times(right: np.ndarray) -> np.ndarray:
        return gram_times(words, piece, weight, right) + _distributed_gram_times(numbered, weight, right)

    basis, _ = np.linalg.qr(times(basis))
    image = times(basis)
    small = basis.T @ image
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32)


def common_subsequence(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence (bit-parallel over the item's positions)."""
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in words:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


class Searcher:
    """Candidate search and checks for one benchmark block; what it holds is bounded by the block."""

    def __init__(self, benchmark: Benchmark, weight: np.ndarray, space: np.ndarray, min_cosine: float = MIN_COSINE):
        self.benchmark, self.weight, self.min_cosine = benchmark, weight, min_cosine
        self.vector = space * weight[:, None]
        rows = np.stack([self.vector[benchmark.items[i][at: at + TILE]].sum(0) for i, at in benchmark.pieces])
        norm = np.linalg.norm(rows, axis=1, keepdims=True)
        self.queries = (rows / np.where(norm > 0, norm, 1)).T.astype(np.float32)
        # items of each content word (flat lists), and per item the content words without which no share of
        # MAYBE is possible even if all its other words were there in order
        content = [np.unique(x)[weight[np.unique(x)] > 0] for x in benchmark.items]
        word, item = np.concatenate(content), np.repeat(np.arange(len(content)), [len(c) for c in content])
        order = np.argsort(word, kind="stable")
        self.holders = item[order]
        self.holders_from = np.searchsorted(word[order], np.arange(benchmark.size + 1))
        self.needed = np.array([int(np.ceil(MAYBE * len(x) - 1e-9)) - int((weight[np.array(x)] == 0).sum()) for x in benchmark.items])
        self.piece_item, self.piece_at = np.array(benchmark.pieces).T
        self.lengths = np.array([len(x) for x in benchmark.items])
        self.slot = np.zeros(benchmark.size, np.int64)
        self.kinds = [np.unique(x, return_counts=True) for x in benchmark.items]

    def candidates(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the tile, piece, cosine); long texts in overlapping segments, so memory is bounded."""
        group, held = [], 0
        for t, words in enumerate(texts):
            for at in range(0, max(1, len(words)), SEGMENT):
                group.append((t, at, words[at: at + SEGMENT + TILE]))
                held += len(group[-1][2])
                if held >= SEGMENT:
                    yield from self._tiled(group)
                    group, held = [], 0
        yield from self._tiled(group)

    def _tiled(self, group: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple[int, int, int, float]]:
        for i, start, piece, cosine in self._candidates([w for _, _, w in group]):
            yield group[i][0], group[i][1] + start, piece, cosine

    def _candidates(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        step = TILE // 4
        words, tile, first, n = _tiles(texts, step, self.weight)
        if not len(words):
            return
        rows = np.zeros((n, self.vector.shape[1]), np.float32)
        for part in _pieces(tile):
            begin = np.flatnonzero(np.r_[True, np.diff(tile[part]) > 0])
            rows[tile[part][begin]] = np.add.reduceat(self.vector[words[part]], begin)
        ends = np.r_[first[1:], n]
        count = self.holders_from[words + 1] - self.holders_from[words]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.holders_from[words], count)
        held = np.sort(self.holders[at] * n + np.repeat(tile, count))
        owner = np.repeat(np.arange(len(first)), np.diff(np.r_[first, n]))
        place = np.arange(n) - first[owner]
        for quarters in (2, 4):  # half tiles and whole tiles, each overlapping the next by half
            joined = rows.copy()
            for k in range(1, quarters):
                inside = np.flatnonzero(owner[k:] == owner[:-k]) if n > k else np.empty(0, np.int64)
                joined[inside] += rows[inside + k]
            norm = np.linalg.norm(joined, axis=1)
            live = np.flatnonzero((norm > 0) & (place % (quarters // 2) == 0))
            for at in range(0, len(live), 8192):
                part = live[at: at + 8192]
                cosine = (joined[part] / norm[part, None]) @ self.queries
                r, p = np.nonzero(cosine >= self.min_cosine)
                near = part[r]
                item, start = self.piece_item[p], place[near] * step - self.piece_at[p]
                low, high = start - self.lengths[item], start + TILE + 2 * self.lengths[item]
                # content words of the item around the tile, counted exactly
                a = item * n + first[owner[near]] + np.clip(low // step, 0, None)
                b = item * n + np.minimum(first[owner[near]] + -(-high // step), ends[owner[near]])
                enough = np.flatnonzero(np.searchsorted(held, b) - np.searchsorted(held, a) >= self.needed[item])
                # and a window somewhere in the text must hold them: one answer for all tiles of a text and item
                pair, back = np.unique(owner[near[enough]] * len(self.lengths) + item[enough], return_inverse=True)
                possible = np.array([self._possible(held, n, first, ends, *divmod(x, len(self.lengths))) for x in pair.tolist()], bool)
                enough = enough[possible[back]]
                for t, q, c, k in zip(owner[near][enough].tolist(), p[enough].tolist(), cosine[r, p][enough].tolist(),
                                      (place[near][enough] * step).tolist()):
                    yield t, k, q, c

    def _possible(self, held: np.ndarray, n: int, first: np.ndarray, ends: np.ndarray, t: int, i: int) -> bool:
        """Whether some window of text t can hold the content words that item i needs (counted by quarter tiles)."""
        needed = int(self.needed[i])
        if needed <= 0:
            return True
        a, b = np.searchsorted(held, (i * n + first[t], i * n + ends[t])).tolist()
        if b - a < needed:
            return False
        tiles, span = held[a:b], (int(self.lengths[i]) * 3 // 2 + 8) // (TILE // 4) + 2
        return bool((tiles[needed - 1:] - tiles[: b - a - needed + 1] < span).any())

    def check(self, words: np.ndarray, i: int, begins: list[int]) -> tuple[float, float, int, int]:
        """Best (share of item i, share of its answer, first word, end) in windows around the places (first words
        of tiles, less their pieces' offsets); overlapping places share their windows."""
        item, answer = self.benchmark.items[i], self.benchmark.answers[i]
        n = len(item)
        width, step, least = n + n // 2 + 8, max(1, n // 4), int(np.ceil(MAYBE * n - 1e-9))
        low = np.clip(np.array(begins) - n, 0, None) // step
        high = np.maximum(low, (np.minimum(np.array(begins) + TILE + 2 * n, len(words)) - n) // step)
        places = set()
        for x, y in zip(low.tolist(), high.tolist()):
            places.update(range(x, y + 1))
        starts = np.array(sorted(places)) * step
        base = int(starts[0])
        part = words[base: int(starts[-1]) + width]
        kinds, times = self.kinds[i]
        self.slot[kinds] = np.arange(1, len(kinds) + 1)
        slot = self.slot[part]
        self.slot[kinds] = 0
        known = slot > 0
        upto, content = np.zeros((2, len(part) + 1), np.int64)
        np.cumsum(known, out=upto[1:])
        np.cumsum(known & (self.weight[part] > 0), out=content[1:])
        starts = np.minimum(starts - base, len(part))
        ends = np.minimum(starts + width, len(part))
        counts = upto[ends] - upto[starts]
        live = np.flatnonzero((counts >= least) & (content[ends] - content[starts] >= self.needed[i]))
        best = (0.0, 0.0, 0, 0)
        for k in live[np.argsort(-counts[live], kind="stable")].tolist():
            if counts[k] <= best[0] * n:
                break
            a, z = int(starts[k]), int(ends[k])
            inside = known[a:z]
            # no common subsequence is longer than what the two bags of words share
            shared = int(np.minimum(np.bincount(slot[a:z][inside], minlength=len(kinds) + 1)[1:], times).sum())
            if shared < max(least, best[0] * n + 1e-9):
                continue
            window = part[a:z][inside].tolist()
            share = common_subsequence(item, window) / n
            if share > best[0]:
                best = (share, common_subsequence(item[answer:], window) / (n - answer), base + a, base + z)
        return best

    def leaks(self, texts: list[np.ndarray]) -> list[dict[int, tuple]]:
        """Per text: item number -> (cosine, share, answer share, first word, end) of what counts as a leak."""
        places: dict[tuple[int, int], tuple[list[int], float]] = {}
        for t, start, piece, cosine in self.candidates(texts):
            i, offset = self.benchmark.pieces[piece]
            begins, most = places.get((t, i), ([], 0.0))
            begins.append(start - offset)
            places[t, i] = begins, max(most, cosine)
        found: list[dict[int, tuple]] = [{} for _ in texts]
        for (t, i), (begins, cosine) in places.items():
            share, answer, a, b = self.check(texts[t], i, begins)
            if share >= SURE or (share >= MAYBE and answer >= ANSWER):
                found[t][i] = (cosine, share, answer, a, b)
        return found


def searchers(docs: DataFrame, benchmark: DataFrame, min_cosine: float = MIN_COSINE) -> Iterator[tuple[Searcher, DataFrame]]:
    """A searcher per benchmark block, with the documents as numbers of its vocabulary."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    for k in range(blocks):
        # one block of the query set: BLOCK_BYTES on average
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        block = Benchmark([(r.item_id, r.text) for r in rows])
        if not block.items:
            continue
        numbered = word_numbers(docs, block)
        weight = block.weights(*document_frequencies(numbered, block.size))
        yield Searcher(block, weight, latent_space(numbered, block, weight), min_cosine), numbered


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per contaminated (doc_id, item_id): cosine, lcs_ratio, answer_ratio, start_word, end_word."""
    spark = docs.sparkSession
    schema = struct_of(
        ("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("item_id", benchmark.schema["item_id"].dataType.simpleString()),
        ("cosine", "double"), ("lcs_ratio", "double"), ("answer_ratio", "double"), ("start_word", "bigint"), ("end_word", "bigint"))
    out = spark.createDataFrame([], schema)
    item_type = to_arrow_type(schema["item_id"].dataType)
    for searcher, numbered in searchers(docs, benchmark, min_cosine):
        shared = spark.sparkContext.broadcast(searcher)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    texts = [np.frombuffer(w.as_py(), "<i4") for w in part.column(1)]
                    rows = [(d, search.benchmark.ids[i], *v) for d, f in zip(part.column(0).to_pylist(), search.leaks(texts))
                            for i, v in sorted(f.items())]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), [
                                part.schema.field(0).type, item_type, pa.float64(), pa.float64(),
                                pa.float64(), pa.int64(), pa.int64()])], schema.names)

        out = out.unionByName(numbered.mapInArrow(run, schema))
    return out


def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: documents that leak an item go.  Texts are judged in place, without a join."""
    out = docs
    for searcher, _ in searchers(docs.select("doc_id", "text"), benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(searcher)
        at = out.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = shared.value
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    part = batch.slice(k, 256)
                    texts = [encode(t.as_py(), search.benchmark.number) for t in part.column(at)]
                    yield part.filter(pa.array([not f for f in search.leaks(texts)], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out
