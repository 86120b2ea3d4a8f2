"""Named queries of the training-data operators and, where SQL expresses them, their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from .alignment import op13_tokenizer_alignment
from .chat import op4_chat_machine
from .decontaminate import op1_latent_decontamination
from .htmlmain import op3_minimum_cut
from .mixing import op5_soft_mixing
from .phrases import OP11_SQL, op11_phrase_collocations
from .quality import op2_divergence_rules
from .rans import op8_rans_blocks
from .secrets import op6_token_efficiency
from .sharding import op10_feistel_shards, shard_sql
from .simhash import op7_simhash_bktree
from .treelm import op12_context_tree_scores
from .warc import OP9_SQL, op9_revisit_resolution

QUERIES = {
    "op1_latent_decontamination": op1_latent_decontamination,
    "op2_divergence_rules": op2_divergence_rules,
    "op3_minimum_cut": op3_minimum_cut,
    "op4_chat_machine": op4_chat_machine,
    "op5_soft_mixing": op5_soft_mixing,
    "op6_token_efficiency": op6_token_efficiency,
    "op7_simhash_bktree": op7_simhash_bktree,
    "op8_rans_blocks": op8_rans_blocks,
    "op9_revisit_resolution": op9_revisit_resolution,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_context_tree_scores": op12_context_tree_scores,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
    "pipeline": corpus_pipeline.run,
}


def _crc32_sql(hex_text: str) -> str:
    """DuckDB has no crc32: a fold over the bytes (a column of hex digits) with the table of the reflected
    polynomial 0xEDB88320."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    bytes_ = f"list_transform(range(1, strlen({hex_text}), 2), lambda i: CAST('0x' || substr({hex_text}, i, 2) AS BIGINT))"
    return (f"xor(4294967295, list_reduce({bytes_}, lambda c, v: xor({table}[(xor(c, v) & 255) + 1], c >> 8), "
            "CAST(4294967295 AS BIGINT)))")


def _escaped_length_sql(text: str) -> str:
    """Code points of a text after the chat template's escapes: one more per control string and backslash."""
    marks = r"\\\\|</?s>|\\[/?INST\\]|<</?SYS>>|\\[/?ROLE\\]".replace("\\\\", "\\")
    return f"length({text}) + len(regexp_extract_all({text}, '{marks}'))"


#: The marks around a system, user and assistant text have 19, 18 and 6 code points.
_CHAT_SQL = f"""WITH rows_ AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
placed AS (SELECT *, row_number() OVER w - 1 AS position, lag(role) OVER w AS before FROM rows_
           WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
judged AS (SELECT *, (coalesce(before, 'begin'), role) IN (('begin', 'system'), ('begin', 'user'), ('system', 'user'),
           ('user', 'assistant'), ('assistant', 'user')) AS allowed,
           CASE role WHEN 'system' THEN 19 WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 END AS marks FROM placed)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marks + {_escaped_length_sql("text")}) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AND arg_max(role, position) = 'assistant' AS valid,
  min(position) FILTER (NOT allowed) AS first_fault
FROM judged GROUP BY conv_id"""

SQL: dict[str, str] = {
    "op4_chat_machine": _CHAT_SQL,
    "op9_revisit_resolution": OP9_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op10_feistel_shards": f"""WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         {_crc32_sql("h")} AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents)),
{shard_sql("SELECT * FROM docs", "doc_id, text_crc32, size")}
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, slot, CAST(NULL AS INTEGER) AS grown_shard FROM placed""",
}
