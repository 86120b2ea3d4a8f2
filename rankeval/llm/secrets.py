"""Secret scans by token efficiency.

A byte-pair vocabulary learnt from ordinary text spends few tokens on words and many on random strings.  Long
runs of key characters whose ratio of characters to tokens is at most ``MAX_RATIO`` are reported, except known
digests (hex digits in the length of a common digest) and identifiers (UUIDs, plain numbers, times,
words joined by separators).  Three pattern rules (assignments, access keys, long hex strings) are the base and
stay whatever the ratio says; a run that touches a base span is not reported twice.

One pass over the texts in Arrow batches, no shuffle.  The vocabulary is loaded once per Python worker from the
path in the parameter.

Defined cases: a null text is empty and has no spans; spans are in code points, end exclusive; very long texts
are scanned whole (a run longer than ``PIECE`` is tokenised in pieces, which changes its count by at most one
token each); repeated rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import struct_of, table

VOCABULARY = "byte_bpe_50k.tiktoken"
MIN_RUN, MAX_RATIO, PIECE = 20, 2.2, 4096

#: Fixed patterns of the base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
NUMBER = re.compile(r"[0-9+/_=-]+")
JOINED = re.compile(r"([A-Za-z]{2,}[0-9]{0,4}|[0-9]+)([+/_=-]+([A-Za-z]{2,}[0-9]{0,4}|[0-9]+))+[+/_=-]*")


@lru_cache(maxsize=4)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path) as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern rules, leftmost and non-overlapping per kind."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def ordinary(run: str) -> bool:
    """Known digests and identifiers, and runs without both letters and digits."""
    if NUMBER.fullmatch(run) or not any(map(str.isdigit, run)) or UUID.fullmatch(run):
        return True
    return (len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run) is not None) or JOINED.fullmatch(run) is not None


def ratio(run: str, path: str) -> float:
    """Characters per token."""
    encode = encoding(path).encode_ordinary
    return len(run) / sum(len(encode(run[i: i + PIECE])) for i in range(0, len(run), PIECE))


def scan(text: str, path: str, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """All spans (start, kind, end), ordered: the base's and those of low token efficiency."""
    spans = sorted(base_spans(text))
    found, at, reach = [], 0, 0
    for m in RUN.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach > m.start():
            continue  # touches a base span
        if not ordinary(m[0]) and ratio(m[0], path) <= max_ratio:
            found.append((m.start(), 3, m.end()))
    return sorted(spans + found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(docs: DataFrame, path: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end), ordered by start, then kind."""
    path = path or vocabulary_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t.as_py() or "", path, max_ratio)]
                    for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, struct_of(("doc_id", id_type), ("spans", "array<struct<kind: string, start: bigint, end: bigint>>")))


def op6_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"),
        count("random").alias("n_random"))
