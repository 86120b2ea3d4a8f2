import json
import os

from rankeval.operators.saved import load_index
from rankeval.streaming import index_stream


def _write(path, arts):
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(a) for a in arts) + "\n")


def _art(i, text):
    return {"_id": i, "title": "t", "text": text, "metadata": {"url": "u", "pubmed_id": "p"}}


def test_stream_upserts_batches(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    _write(f"{src}/a.jsonl", [_art("x1", "one two"), _art("x2", "three")])
    q = index_stream(spark, src, f"{tmp_dir}/idx", f"{tmp_dir}/ckpt", partitions=2, available_now=True)
    q.awaitTermination(120)
    _write(f"{src}/b.jsonl", [_art("x2", "three revised"), _art("x3", "four")])
    q = index_stream(spark, src, f"{tmp_dir}/idx", f"{tmp_dir}/ckpt", partitions=2, available_now=True)
    q.awaitTermination(120)
    idx = load_index(spark, f"{tmp_dir}/idx")
    docs = {r.id: r.text for r in idx.docs.collect()}
    assert docs == {"x1": "one two", "x2": "three revised", "x3": "four"}
    s = idx.stats.filter("field = 'text'").collect()[0]
    assert (s.n_docs, s.n_tokens) == (3, 5)
