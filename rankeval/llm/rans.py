"""Token-id output in a static range-ANS format.

Texts are encoded by a byte-level BPE vocabulary; every document ends with ``END``.  One frequency table, counted
over all ids of the corpus and scaled to 2**PRECISION, is shared by all blocks.

File format: a folder of Parquet files whose rows are blocks in ascending (doc_id, row, block) order, plus a folder
``table`` with the frequency of each id.  A block holds at most ``BLOCK`` ids of one document and can be decoded alone:

    header   magic "RB01", ids, lanes, words, checkpoints, crc32 of the ids (little-endian unsigned 32-bit)
    states   one 64-bit start state per lane
    checkpoints  each: words read so far, then one state per lane, every ``EVERY`` steps
    words    32-bit renormalisation words in the order in which the decoder reads them

Lane j of a block codes the ids j, j + lanes, j + 2 * lanes, ...; all lanes share one word stream.  Lanes of many
blocks are coded together with numpy, one step at a time.  A decoder may start at any checkpoint.

Steps: encode texts (written to the shared folder), count ids, range-partition them by document, code blocks and
write; then read the files back, check every checksum, and add up ``start`` with one offset per partition.

Defined cases: a null text is empty and has the end id alone; rows that share a doc_id are documents of their own, in the
order of their input rows (``row``, fixed when the ids are written); null ids come first; a very long text becomes many
blocks; ids with equal counts share the frequency table as counted; an empty table gives an empty result; extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, struct_of, table
from rankeval.session import checkpoint_dir

VOCABULARY, END = "byte_bpe_50k.json", 0
PRECISION, BLOCK, STEPS, EVERY = 20, 1 << 16, 512, 256
CACHE, FIRST_BYTES = 600_000, 1 << 24
#: Ids that are decoded together, about.
AT_ONCE = 1 << 20
HEADER, MAGIC = struct.Struct("<4sIIIII"), b"RB01"
LOW = np.uint64(1 << 31)

#: A single space before a character that is no white space always starts a new token of this vocabulary.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPLIT, UNSAFE = re.compile(r" (?=\S)"), re.compile(r" (?=\s|\Z)")


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Encoder:
    """Ids of texts by the tokenizers library, remembering the ids of space-separated pieces.

    Letters go straight to the library's model, and marks that close them are looked up (the vocabulary's pattern cuts
    between letters, marks and line feeds); other pieces go through the whole pipeline.  Pieces are kept for one to two
    generations of ``CACHE``: frequent ones stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.width = 2 if self.size <= 1 << 16 else 4
        self.kind = next(k for k in ("HI" if self.width == 2 else "IL") if array(k).itemsize == self.width)
        self.tokenize = self.tokenizer.model.tokenize
        self.alphabet = _byte_alphabet()
        self.space = self.alphabet[32]
        self.later: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.first_bytes = 0
        self.closing: dict[str, bytes] = {"": b"", "\n": self.plain("\n")}

    def pack(self, ids: list[int]) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def plain(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str, space: str) -> bytes | None:
        """Ids of letters with closing marks, after a space or not; None if the text is anything else."""
        letters, closing = text, b""
        if not text.isalpha():
            letters = text.rstrip(MARKS)
            if not letters.isalpha():
                return None
            tail = text[len(letters):]
            if tail not in self.closing:
                if len(self.closing) > CACHE // 8:
                    self.closing = {"": b"", "\n": self.closing["\n"]}
                self.closing[tail] = self.plain(tail)
            closing = self.closing[tail]
            if space and (ids := self.later.get(letters)) is not None:
                return ids + closing
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.alphabet)
        return self.pack([t.id for t in self.tokenize(space + letters)]) + closing

    def lines(self, piece: str) -> bytes | None:
        """Ids of words joined by single line feeds, the first one after a space."""
        parts = [self.word(x, "" if i else self.space) for i, x in enumerate(piece.split("\n"))]
        return None if None in parts else self.closing["\n"].join(parts)

    def find(self, piece: str) -> bytes:
        """Ids of `` piece``: those of the older generation, or new ones; kept."""
        ids = self.old.get(piece)
        if ids is None:
            ids = self.lines(piece) if "\n" in piece else self.word(piece, self.space)
        if ids is None:
            ids = self.plain(" " + piece)
        self.later[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of ``width`` bytes per text."""
        if len(self.later) > CACHE:
            self.old, self.later = self.later, {}
        out, get, find = [], self.later.get, self.find
        for text in texts:
            head, *pieces = SPLIT.split(text) if UNSAFE.search(text) else text.split(" ")
            ids = self.first.get(head)
            if ids is None:
                ids = self.plain(head)
                if len(head) < FIRST_BYTES // 64:  # long heads are not met again
                    self.first_bytes += len(head) + len(ids) + 200
                    if self.first_bytes > FIRST_BYTES:
                        self.first.clear()
                        self.first_bytes = 0
                    self.first[head] = ids
            out.append(ids + b"".join([get(p) or find(p) for p in pieces]))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def token_table(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """(doc_id, row, ids, width, counts): little-endian ids of each whole text with the end id; and one row per task with
    how often it saw each id (``counts``, little-endian 64-bit).  Written to the shared folder."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        of = encoder(path)
        tail, row = of.pack([end]), TaskContext.get().partitionId() << 33
        seen, id_kind = np.zeros(of.size, np.int64), pa.null()

        def rows(doc_ids, first, ids, counts) -> pa.RecordBatch:
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.arange(first, first + n), pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([of.width] * n, pa.int32()), pa.array(counts, pa.binary())], ["doc_id", "row", "ids", "width", "counts"])

        for batch in batches:
            id_kind = batch.column(0).type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [x + tail for x in of.encode([t.as_py() or "" for t in part.column(1)])]
                joined = b"".join(ids)
                for k in range(0, len(joined), 1 << 22):
                    seen += np.bincount(np.frombuffer(joined[k: k + (1 << 22)], f"<u{of.width}"), minlength=len(seen))
                yield rows(part.column(0), row, ids, [None] * len(ids))
                row += len(ids)
        if seen.any():
            yield rows(pa.nulls(1, id_kind), row, [None], [seen.astype("<i8").tobytes()])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, struct_of(("doc_id", id_type), ("row", "bigint"), ("ids", "binary"), ("width", "int"), ("counts", "binary")))
    return materialise(rows, "tokens", compression="zstd")


def unpack(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{width}").astype(np.int64)


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """Occurrences of every id (as many rows as the vocabulary has ids, whatever the corpus), from the tasks' own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                own = np.frombuffer(counts.as_py(), "<i8")
                total = own + np.r_[total, np.zeros(len(own) - len(total), np.int64)]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counted = tokens.filter("counts IS NOT NULL").select("counts").mapInArrow(run, "id long, n long")
    return {r.id: r.n for r in counted.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def scaled(counts: dict[int, int], precision: int = PRECISION) -> np.ndarray:
    """Frequencies by id that sum to 2**precision; every id that occurs gets at least 1."""
    size = max(counts, default=0) + 1
    n = np.zeros(size, np.int64)
    for i, c in counts.items():
        n[i] = c
    some = n > 0
    if some.sum() > 1 << precision:
        raise ValueError("more ids than the frequency table has slots")
    freq = np.zeros(size, np.int64)
    if some.any():
        # shares of what is left after one slot each, exact in Python integers; the rest to the most frequent id
        left, total = (1 << precision) - int(some.sum()), int(n.sum())
        freq[some] = [1 + int(c) * left // total for c in n[some]]
        freq[int(np.argmax(n))] += (1 << precision) - int(freq.sum())
    return freq


class Coder:
    """Codes blocks with one frequency table; lanes of all blocks of a call advance together."""

    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.m = np.uint64(precision)
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.int32), freq)

    @staticmethod
    def _layout(sizes: np.ndarray):
        """Blocks by falling number of steps (so the lanes at work are always a prefix), and by lane: its block (in
        that order), its first id, the distance between its ids, and its steps; per block also its lanes."""
        lanes = np.maximum(1, -(-sizes // STEPS))
        order = np.argsort(-(-(-sizes // lanes)), kind="stable")
        base = (np.cumsum(sizes) - sizes)[order]
        sizes, lanes = sizes[order], lanes[order]
        block = np.repeat(np.arange(len(sizes)), lanes)
        place = np.arange(len(block)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        stride = lanes[block]
        return order, lanes, block, base[block] + place, stride, (sizes[block] - place + stride - 1) // stride

    @staticmethod
    def _prefixes(lanes: np.ndarray, longest: np.ndarray) -> np.ndarray:
        """Lanes at work at each step: those of the blocks with more steps."""
        steps = int(longest.max(initial=0))
        blocks = np.searchsorted(-longest, -np.arange(steps), "left")
        return np.r_[0, np.cumsum(lanes)][blocks]

    def encode(self, blocks: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(b) for b in blocks], np.int64)
        order, lanes, block, at, stride, steps = self._layout(sizes)
        longest = -(-sizes[order] // lanes)
        prefix, ids = self._prefixes(lanes, longest), np.concatenate(blocks)
        x = np.full(len(block), LOW, np.uint64)
        words, owner, marks = [], [], {}
        for t in range(len(prefix) - 1, -1, -1):
            k = prefix[t]
            y, idle = x[:k], np.flatnonzero(steps[:k] <= t)  # idle: lanes that end one step before their block
            s = ids.take(at[:k] + t * stride[:k], mode="clip")
            f = self.freq[s]
            out = y >= f << (np.uint64(63) - self.m)
            out[idle] = False
            words.append((y[out] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            owner.append(block[:k][out])
            z = np.where(out, y >> np.uint64(32), y)
            q = z // f
            z = (q << self.m) + (z - q * f) + self.cum[s]
            z[idle] = LOW
            x[:k] = z
            if t and t % EVERY == 0:
                marks[t] = (x.copy(), len(words))
        ahead = {t: np.bincount(np.concatenate(owner[n:]), minlength=len(blocks)) if n < len(owner) else np.zeros(len(blocks), np.int64)
                 for t, (_, n) in marks.items()}
        words.reverse()
        owner.reverse()
        word, own = (np.concatenate(words), np.concatenate(owner)) if words else (np.empty(0, "<u4"), np.empty(0, np.int64))
        word = word[np.argsort(own, kind="stable")]  # by block, in the order of steps and lanes
        count = np.bincount(own, minlength=len(blocks))
        ends, lane_ends, result = np.cumsum(count), np.cumsum(lanes), [b""] * len(blocks)
        for i, j in enumerate(order.tolist()):
            b, a, z = blocks[j], int(lane_ends[i] - lanes[i]), int(lane_ends[i])
            own_marks = [t for t in sorted(marks) if t < longest[i]]
            parts = [HEADER.pack(MAGIC, len(b), int(lanes[i]), int(count[i]), len(own_marks), zlib.crc32(b.astype("<u4").tobytes())),
                     x[a:z].astype("<u8").tobytes()]
            for t in own_marks:
                parts += [struct.pack("<I", int(ahead[t][i])), marks[t][0][a:z].astype("<u8").tobytes()]
            result[j] = b"".join([*parts, word[ends[i] - count[i]: ends[i]].tobytes()])
        return result

    def decode(self, payloads: list[bytes], first: int = 0) -> list[np.ndarray]:
        """Ids of each block; with ``first`` > 0 those from checkpoint ``first`` on (blocks must have it)."""
        heads = [HEADER.unpack_from(p) for p in payloads]
        if any(h[0] != MAGIC for h in heads):
            raise ValueError("not a block of this format")
        sizes = np.array([h[1] for h in heads], np.int64)
        order, lanes, block, at, stride, steps = self._layout(sizes)
        prefix = self._prefixes(lanes, -(-sizes[order] // lanes))
        states, words, skip = [], [], []
        for j in order.tolist():
            p, (_, _, n, count, marks, _) = payloads[j], heads[j]
            place, skipped = HEADER.size, 0
            tail = place + 8 * n + marks * (4 + 8 * n)
            if first:
                place += 8 * n + (first - 1) * (4 + 8 * n) + 4
                skipped = struct.unpack_from("<I", p, place - 4)[0]
            states.append(np.frombuffer(p, "<u8", n, place))
            words.append(np.frombuffer(p, "<u4", count, tail))
            skip.append(skipped)
        x = np.concatenate(states).astype(np.uint64) if states else np.empty(0, np.uint64)
        # a damaged block may ask for words it does not have: it gets any, and its checksum fails
        word = np.concatenate([*words, np.zeros(1, "<u4")]).astype(np.uint64)
        counts = np.array([len(w) for w in words], np.int64)
        read = np.cumsum(counts) - counts + np.array(skip, np.int64)
        total = int(sizes.sum())
        out, mask = np.zeros(total + 1, np.int64), np.uint64((1 << int(self.m)) - 1)
        for t in range(first * EVERY, len(prefix)):
            k = prefix[t]
            y, idle = x[:k], np.flatnonzero(steps[:k] <= t)
            low = y & mask
            s = self.slot[low]
            to = at[:k] + t * stride[:k]
            to[idle] = total
            out[to] = s
            y = self.freq[s] * (y >> self.m) + low - self.cum[s]
            y[idle] = LOW
            need = np.flatnonzero(y < LOW)
            if len(need):
                owner = block[need]  # ascending: lanes of a block lie together
                begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                size = np.diff(np.r_[begin, len(owner)])
                rank = np.arange(len(owner)) - np.repeat(begin, size)
                y[need] = (y[need] << np.uint64(32)) | word.take(read[owner] + rank, mode="clip")
                read[owner[begin]] += size
            x[:k] = y
        base = np.cumsum(sizes) - sizes
        skipped = [min(first * EVERY * h[2], h[1]) for h in heads]
        return [out[b + k: b + z] for b, z, k in zip(base.tolist(), sizes.tolist(), skipped)]


def coded(tokens: DataFrame, freq: np.ndarray) -> DataFrame:
    """(doc_id, row, block, payload) in ascending (doc_id, row, block) order."""
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            docs, numbers, blocks = [], [], []

            def out() -> pa.RecordBatch:
                done = pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(docs, pa.int64())) for c in (0, 1)], pa.array(numbers, pa.int32()),
                     pa.array(coder.encode(blocks), pa.binary())], ["doc_id", "row", "block", "payload"])
                docs.clear(), numbers.clear(), blocks.clear()
                return done

            held = 0
            for i, (ids, width) in enumerate(zip(batch.column(2), batch.column(3))):
                values = unpack(ids.as_py(), width.as_py())
                for k in range(0, len(values), BLOCK):
                    docs.append(i)
                    numbers.append(k // BLOCK)
                    blocks.append(values[k: k + BLOCK])
                    held += len(blocks[-1])
                    if held > 1 << 21:
                        yield out()
                        held = 0
            if docs:
                yield out()

    # coded behind the exchange: finding its ranges reads the tokens twice, and must not code them twice
    order = ["doc_id", "row"]
    dealt = tokens.filter("ids IS NOT NULL").select("doc_id", "row", "ids", "width").repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).mapInArrow(
        run, struct_of(("doc_id", id_type), ("row", "bigint"), ("block", "int"), ("payload", "binary")))


def write_blocks(tokens: DataFrame, freq: np.ndarray, path: str) -> None:
    """Code ``tokens`` and write the format's files to ``path``."""
    spark = tokens.sparkSession
    coded(tokens, freq).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq) if f], "id long, freq long").coalesce(1).write.parquet(
        f"{path}/table")


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/table").collect()  # at most one row per id of the vocabulary
    freq = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        freq[r.id] = r.freq
    return freq


def stored_checksum(payload: bytes) -> int:
    return HEADER.unpack_from(payload)[5]


def stored_size(payload: bytes) -> int:
    return HEADER.unpack_from(payload)[1]


def runs_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """(first, number) of consecutive items: as many as have at most ``most`` together, or one that is larger alone."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield first, i - first
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes) - first


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, row, block, ids) decoded from the files, or with ``digest`` (doc_id, row, block, crc, n_bytes) of the decoded
    ids; raises on a checksum that does not hold."""
    freq = read_table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_id"].dataType.simpleString()
    results = (("crc", "bigint"), ("n_bytes", "bigint")) if digest else (("ids", "binary"),)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            sizes = [stored_size(p.as_buffer()) for p in batch.column(3)]
            for at, n in runs_of(sizes, AT_ONCE):
                part = batch.slice(at, n)
                payloads, ids, crcs = part.column(3).to_pylist(), [], []
                for p, values in zip(payloads, coder.decode(payloads)):
                    ids.append(values.astype("<u4").tobytes())
                    crcs.append(zlib.crc32(ids[-1]))
                    if crcs[-1] != stored_checksum(p):
                        raise ValueError("checksum of a block does not hold")
                out = [pa.array(crcs, pa.int64()), pa.array(list(map(len, ids)), pa.int64())] if digest else [pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *out], ["doc_id", "row", "block", *[n for n, _ in results]])

    return blocks.mapInArrow(run, struct_of(("doc_id", id_type), ("row", "bigint"), ("block", "int"), *results))


def _zeros(crc: int, n: int) -> int:
    """The checksum register after n further zero bytes (square-and-multiply over GF(2) matrices)."""
    matrix = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit

    def times(mat, vec):
        total, i = 0, 0
        while vec:
            if vec & 1:
                total ^= mat[i]
            vec, i = vec >> 1, i + 1
        return total

    n *= 8
    while n:
        if n & 1:
            crc = times(matrix, crc)
        matrix, n = [times(matrix, c) for c in matrix], n >> 1
    return crc


def join_crc32(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation from (crc32, length in bytes) of its parts."""
    total = 0
    for crc, n in parts:
        total = crc ^ _zeros(total, n) if total else crc
    return total


def documents_back(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files alone."""
    ids = read_ids(spark, path, digest=True)
    id_type = ids.schema["doc_id"].dataType.simpleString()
    parts = ids.select("doc_id", "row", F.struct("block", "crc", F.col("n_bytes").alias("n")).alias("part"))
    grouped = materialise(parts.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("part")).alias("parts")), "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, number = 0, TaskContext.get().partitionId()
        for batch in batches:
            start, n, crc = [], [], []
            for row in batch.column(1).to_pylist():
                start.append(total)
                n.append(sum(p["n"] for p in row) // 4)
                crc.append(join_crc32([(p["crc"], p["n"]) for p in row]))
                total += n[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([number] * len(n), pa.int32()), pa.array(start, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "part", "start", "n_tokens", "ids_crc32"])

    ordered = grouped.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "parts").mapInArrow(run, struct_of(
        ("doc_id", id_type), ("part", "int"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")))
    ordered = materialise(ordered, "starts")
    # one row per range partition
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offset = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ordered.join(F.broadcast(offset), "part").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def op8_rans_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-rans-{uuid.uuid4().hex}"
    tokens = token_table(table(spark, sf_dir, "documents"), vocabulary_path())
    write_blocks(tokens, scaled(id_counts(tokens)), path)
    return documents_back(spark, path)
