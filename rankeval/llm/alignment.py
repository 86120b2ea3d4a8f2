"""Alignment of the token sequences that two tokenizers give to the same text.

Texts are deduplicated first: a shuffle by full text leaves each distinct text once, with its multiplicity.  Each is
encoded as space + text by a byte-level BPE (A) and by a SentencePiece model (B); byte offsets at which tokens of both end
cut the sequences into groups, and all A-B pairs of a group are links.

1. In a task texts are gathered into blocks of about ``BLOCK`` bytes.  A text is cut at single spaces between visible
   characters: both vocabularies start a token there (checked when they are opened; if not, a text stays whole), so the
   place is a cut of the alignment too, and every distinct piece of a block is encoded and aligned once.
2. A block's rows, written to the shared folder: its distinct id pairs with the number of documents (multiplicities added)
   that hold them linked, its pieces with their links, and its texts as lists of pieces.
3. Pair counts are summed over all blocks; an A id's highest count marks its best pairs.
4. The counts go back to the blocks that hold the pair (one row per block and pair, however frequent the pair), where
   they are added up over pieces and texts.
5. The measures of a text are joined to all documents that have it.  Texts with so many copies that only a thousand such
   texts can exist are joined by a broadcast; no key of the other join is hot.

Defined cases: null and empty texts, and texts that A's or B's tokens do not spell, have zeros and an empty digest;
repeated rows are documents of their own; null doc_ids are carried; very long texts are aligned whole, and a very large
group by its distinct ids; count ties are all best; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, partitions, table

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK, SLICE, LEARN = 1 << 22, 128, 4096
#: Ids below 2**25 let a piece's number of a batch and both ids share 62 bits.
ID_BITS, WIDE = 25, 1 << 16
HOT_TEXTS = 1000

SPLIT, DOUBLE = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s\s")
#: Fixed value: how a byte-level BPE of this kind cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in plain else next(spare)): b for b in range(256)}


class Pieces:
    """Encodes and aligns distinct pieces (texts that follow a space); results by number, in the order of learning."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = _byte_of()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        if max(len(self.a_bytes), size) > 1 << ID_BITS:
            raise ValueError("vocabularies of more than 2**25 ids")
        # the same vocabulary, its ids being the ranks of its merges, in a library that is several times as fast
        fast = tiktoken.Encoding("a", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)})
        probe = " don't Stop3.14, it's 10 000\n\n  x \t y é日本🙂 " * 3
        self.fast = fast if fast.encode_ordinary(probe) == self.a.encode(probe, add_special_tokens=False).ids else None
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        #: a space after a visible character always starts a token of both
        self.splits = not any(re.search("[^▁]▁", n) for i, n in enumerate(names) if not self.b.is_control(i))
        self.a_more, self.a_last = ([f"{i}{c}" for i in range(len(self.a_bytes))] for c in ",|")
        self.b_more, self.b_last = ([f"{i}{c}" for i in range(size)] for c in ",;")

    def cut(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        if DOUBLE.search(text) or text[0].isspace() or text[-1].isspace():
            return SPLIT.split(text)
        return text.split(" ")

    def _ids_a(self, text: str) -> np.ndarray:
        if self.fast:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)

    def _encode(self, ids_of, size: np.ndarray, pieces: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has: from one call, cut at the pieces' byte lengths."""
        if self.splits:
            ids = ids_of(" ".join(pieces))
            ends, reached = np.cumsum(sizes), np.cumsum(size[ids])
            at = np.searchsorted(reached, ends)
            if len(reached) and at[-1] < len(reached) and np.array_equal(reached[at], ends):
                return ids, np.diff(np.r_[0, at + 1])
        each = [ids_of(p) for p in pieces]
        return np.concatenate(each), np.array(list(map(len, each)), np.int64)

    def _spelled(self, names: list[bytes], ids: np.ndarray, count: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Which pieces their tokens spell."""
        spelled = list(map(names.__getitem__, ids.tolist()))
        if b"".join(spelled) == b"".join(pieces) and np.array_equal(
                np.add.reduceat(np.r_[np.fromiter(map(len, spelled), np.int64, len(spelled)), 0], np.cumsum(count) - count) * (count > 0),
                np.fromiter(map(len, pieces), np.int64, len(pieces))):
            return np.ones(len(pieces), bool)
        ends = [0, *np.cumsum(count).tolist()]
        return np.array([b"".join(spelled[x:y]) == p for x, y, p in zip(ends, ends[1:], pieces)], bool)

    def learn(self, pieces: list[str]) -> "Learnt":
        """Tokens, groups and links of each piece; nothing where a side does not spell it."""
        spelled = [(" " + p).encode() for p in pieces]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        ia, na = self._encode(lambda text: self._ids_a(" " + text), self.a_size, pieces, sizes)
        ib, nb = self._encode(lambda text: np.array(self.b.encode(text), np.int64), self.b_size, pieces, sizes)
        good = self._spelled(self.a_bytes, ia, na, spelled) & self._spelled(self.b_bytes, ib, nb, spelled)
        if not good.all():
            ia, ib = ia[np.repeat(good, na)], ib[np.repeat(good, nb)]
            na, nb = na * good, nb * good
        ea, eb = np.cumsum(self.a_size[ia]), np.cumsum(self.b_size[ib])
        mark = np.zeros(int(ea[-1]) + 1 if len(ea) else 1, np.int8)
        mark[ea] += 1
        mark[eb] += 1
        last_a, last_b = mark[ea] == 2, mark[eb] == 2
        ga, gb = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ka, kb = np.bincount(ga), np.bincount(gb)
        piece_of = np.repeat(np.arange(len(pieces)), na)[last_a]  # piece of each group
        groups = np.bincount(piece_of, minlength=len(pieces))
        links = np.zeros(len(pieces), np.int64)
        np.add.at(links, piece_of, ka * kb)
        # groups as text: A ids, then B ids, group by group
        parts = [(self.a_last if x else self.a_more)[i] for i, x in zip(ia.tolist(), last_a.tolist())]
        parts += [(self.b_last if x else self.b_more)[i] for i, x in zip(ib.tolist(), last_b.tolist())]
        order = np.argsort(np.r_[2 * ga, 2 * gb + 1], kind="stable")
        parts = list(map(parts.__getitem__, order.tolist()))
        to = [0, *np.cumsum(na + nb).tolist()]
        texts = ["".join(parts[x:y])[:-1] for x, y in zip(to, to[1:])]
        # links: every A token of a group with every B token of it
        first_a, first_b = np.cumsum(ka) - ka, np.cumsum(kb) - kb
        wide = ka * kb > WIDE
        some = np.flatnonzero(~wide[ga]) if len(ga) else ga
        times = kb[ga[some]] if len(ga) else ga
        owner = np.repeat(some, times)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times) + first_b[ga[owner]] if len(owner) else owner
        code = [piece_of[ga[owner]] << 2 * ID_BITS | ia[owner] << ID_BITS | ib[at]] if len(owner) else [owner]
        count = [np.ones(len(owner), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            x, n = np.unique(ia[first_a[g]: first_a[g] + ka[g]], return_counts=True)
            y, m = np.unique(ib[first_b[g]: first_b[g] + kb[g]], return_counts=True)
            code.append((piece_of[g] << 2 * ID_BITS | x[:, None] << ID_BITS | y[None, :]).ravel())
            count.append((n[:, None] * m[None, :]).ravel())
        code, count = np.concatenate(code), np.concatenate(count)
        order = np.argsort(code)
        code = code[order]
        new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else order
        total = np.add.reduceat(count[order], new) if len(code) else count
        code = code[new]
        return Learnt(good, texts, np.stack([na, nb, groups, links], 1), np.bincount(code >> 2 * ID_BITS, minlength=len(pieces)),
                      code & ((1 << 2 * ID_BITS) - 1), total)


class Learnt(NamedTuple):
    """Results of pieces: which are spelled, groups as text, (n_a, n_b, n_groups, n_links), and how many distinct links
    each has; then all links, piece by piece, and how often each occurs in its piece."""

    good: np.ndarray
    texts: list[str]
    measures: np.ndarray
    sizes: np.ndarray
    codes: np.ndarray
    times: np.ndarray


@lru_cache(maxsize=1)
def pieces_of(a_path: str, b_path: str) -> Pieces:
    return Pieces(a_path, b_path)


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class Block:
    """Texts of a block: its distinct pieces by number, and per text its key, multiplicity, digest and pieces."""

    def __init__(self, of: Pieces):
        self.of, self.number, self.learnt, self.groups, self.bad = of, {}, [], [], set()
        self.keys, self.times, self.digests, self.texts, self.bytes = [], [], [], [], 0

    def add(self, keys: list[bytes], texts: list[str], times: list[int]) -> None:
        cut = [self.of.cut(t) for t in texts]
        new = list(set().union(*cut).difference(self.number))
        for i in range(0, len(new), LEARN):
            part = new[i: i + LEARN]
            found = self.of.learn(part)
            at = len(self.number)
            self.number.update(zip(part, range(at, at + len(part))))
            self.bad.update((np.flatnonzero(~found.good) + at).tolist())
            self.groups += found.texts
            self.learnt.append(found._replace(texts=[]))
        get, groups = self.number.__getitem__, self.groups.__getitem__
        for key, pieces, m, text in zip(keys, cut, times, texts):
            numbers = list(map(get, pieces))
            self.bytes += len(text)
            self.keys.append(key)
            self.times.append(m)
            if self.bad and not self.bad.isdisjoint(numbers):
                self.digests.append("")
                self.texts.append(np.empty(0, np.int32))
                continue
            self.digests.append(hashlib.sha256(";".join(map(groups, numbers)).encode()).hexdigest())
            self.texts.append(np.array(numbers, np.int32))

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        sizes, code, occurrences, measures = (np.concatenate([getattr(x, f) for x in self.learnt])
                                              for f in ("sizes", "codes", "times", "measures"))
        self.learnt, self.groups = [], []
        self.number.clear()
        pairs, pair = np.unique(code, return_inverse=True)
        del code
        start = np.cumsum(sizes) - sizes
        weight = np.zeros(len(pairs), np.int64)
        times = np.array(self.times, np.int64)
        ends = np.cumsum([len(x) for x in self.texts])
        begin = 0
        while begin < len(self.texts):  # documents that hold a pair, some texts at a time: each counts once
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + (1 << 17), "right")))
            own = np.concatenate(self.texts[begin:end])
            text = np.repeat(np.arange(begin, end), [len(x) for x in self.texts[begin:end]])
            own = _distinct(text << 32 | own)
            text, own = own >> 32, own & ((1 << 32) - 1)
            each = sizes[own]
            at = np.arange(int(each.sum())) + np.repeat(start[own] - np.cumsum(each) + each, each)
            both = _distinct(np.repeat(text, each) << 32 | pair[at])
            np.add.at(weight, both & ((1 << 32) - 1), times[both >> 32])
            begin = end

        def batch(kind: int, rows: int, **columns) -> pa.RecordBatch:
            filled = {"block": pa.array([number] * rows, pa.int64()), "kind": pa.array([kind] * rows, pa.int32())} | columns
            return pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(rows, f.type)) for f in ROWS], ROWS.names)

        for i in range(0, len(pairs), 1 << 16):
            p = pairs[i: i + (1 << 16)]
            yield batch(0, len(p), pair=pa.array(p), n=pa.array(weight[i: i + (1 << 16)]))
        pieces = b"".join([np.array([len(sizes), len(pair)], "<i8").tobytes(), sizes.astype("<i4").tobytes(), pair.astype("<i4").tobytes(),
                           occurrences.astype("<i8").tobytes(), measures.astype("<i8").tobytes()])
        yield batch(1, 1, data=pa.array([zstandard.ZstdCompressor(1).compress(pieces)], pa.binary()))
        for i in range(0, len(self.keys), 1024):
            j = slice(i, i + 1024)
            yield batch(2, len(self.keys[j]), key=pa.array(self.keys[j], pa.binary()), n=pa.array(self.times[j], pa.int64()),
                        digest=pa.array(self.digests[j], pa.string()),
                        data=pa.array([x.astype("<i4").tobytes() for x in self.texts[j]], pa.binary()))


ROWS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("pair", pa.int64()), ("n", pa.int64()),
                  ("key", pa.binary()), ("digest", pa.string()), ("data", pa.binary())])
ROWS_DDL = "block long, kind int, pair long, n long, key binary, digest string, data binary"


def blocks(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of all blocks from (key, text, n): kind 0 pairs, 1 the pieces, 2 the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        of, number = pieces_of(a_path, b_path), TaskContext.get().partitionId() << 32
        block = Block(of)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                block.add(*[part.column(c).to_pylist() for c in range(3)])
                if block.bytes >= BLOCK:
                    yield from block.rows(number)
                    block, number = Block(of), number + 1
        if block.keys:
            yield from block.rows(number)

    return materialise(texts.select("key", "text", "n").mapInArrow(run, ROWS_DDL), "alignment-blocks", compression="zstd")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block in the order of their kind, pairs with corpus-wide counts: the measures of its texts."""
    held: list[tuple[np.ndarray, ...]] = []
    values = np.zeros((0, 6), np.int64)
    for batch in batches:
        kinds = batch.column(1).to_numpy()
        edges = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1], True])
        for i, j in zip(edges.tolist(), edges[1:].tolist()):
            part = batch.slice(i, j - i)
            if kinds[i] == 0:
                held.append(tuple(part.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4)))
            elif kinds[i] == 1:
                for data in part.column(7):
                    raw = zstandard.ZstdDecompressor().decompress(data.as_py())
                    n, links = np.frombuffer(raw, "<i8", 2).tolist()
                    sizes = np.frombuffer(raw, "<i4", n, 16).astype(np.int64)
                    pair = np.frombuffer(raw, "<i4", links, 16 + 4 * n)
                    times = np.frombuffer(raw, "<i8", links, 16 + 4 * (n + links))
                    measures = np.frombuffer(raw, "<i8", 4 * n, 16 + 4 * n + 12 * links).reshape(-1, 4)
                    code, count, best = (np.concatenate([h[c] for h in held]) if held else np.empty(0, np.int64) for c in range(3))
                    held, order = [], np.argsort(code)
                    sums = [np.r_[0, np.cumsum(times * x[order][pair])] for x in (best, count)]
                    ends = np.cumsum(sizes)
                    values = np.c_[measures, *[s[ends] - s[ends - sizes] for s in sums]]
            else:
                rows = [np.frombuffer(x.as_py(), "<i4") for x in part.column(7)]
                size = np.array(list(map(len, rows)), np.int64)
                at = np.r_[0, np.cumsum(size)]
                total = np.vstack([np.zeros((1, 6), np.int64), np.cumsum(values[np.concatenate(rows)], axis=0)])
                total = total[at[1:]] - total[at[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(5), part.column(3), part.column(6), *[pa.array(np.ascontiguousarray(c)) for c in total.T]],
                    ["key", "n", "groups_sha256", *MEASURES])


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def text_measures(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(key, n, groups_sha256, measures) of each distinct text (key, text, n: its number of documents)."""
    made = blocks(texts, a_path, b_path)
    own = made.filter("kind = 0").select("block", "pair", "n")
    counts = materialise(own.groupBy("pair").agg(F.sum("n").alias("count")), "alignment-pairs")
    a_id = F.shiftright("pair", ID_BITS)
    # at most one row per id of A's vocabulary
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("highest"))
    counted = counts.withColumn("a", a_id).join(F.broadcast(highest), "a").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    back = own.select("block", "pair").join(counted, "pair").select(
        "block", F.lit(0).alias("kind"), "pair", "count", "best", F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("binary").alias("data"))
    rest = made.filter("kind > 0").select(
        "block", "kind", "pair", F.col("n").alias("count"), F.lit(None).cast("long").alias("best"), "key", "digest", "data")
    rows = back.unionByName(rest).repartition(partitions(made.sparkSession), "block").sortWithinPartitions("block", "kind")
    return materialise(rows.mapInArrow(
        _finish, "key binary, n long, groups_sha256 string, " + ", ".join(f"{m} long" for m in MEASURES)), "alignment-texts")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, the measures and groups_sha256, one row per row of ``docs``."""
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", text.alias("text"))
    some = docs.filter("text is not null and text <> ''")
    key = F.unhex(F.substring(F.sha2("text", 256), 1, 32))
    distinct = some.groupBy("text").agg(F.count("*").alias("n")).select(key.alias("key"), "text", "n")
    found = text_measures(distinct, a_path, b_path)
    # a text with at least this many copies is one of at most HOT_TEXTS
    copies = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // HOT_TEXTS + 1
    keyed, out = some.select("doc_id", key.alias("key")), [*MEASURES, "groups_sha256"]
    hot = F.broadcast(found.filter(F.col("n") >= copies).drop("n"))
    return keyed.join(hot, "key").select("doc_id", *out).unionByName(
        keyed.join(hot.select("key"), "key", "left_anti").join(found.filter(F.col("n") < copies), "key").select("doc_id", *out)
    ).unionByName(docs.filter("text is null or text = ''").select(
        "doc_id", *[F.lit(0).cast("long").alias(m) for m in MEASURES], F.lit("").alias("groups_sha256")))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(table(spark, sf_dir, "documents"), *[str(public_tokenizers.path(n)) for n in (A_VOCABULARY, B_VOCABULARY)])
