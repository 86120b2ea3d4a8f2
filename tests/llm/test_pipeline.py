"""The pipeline against the stages' brute-force rules, and the registry."""

import corpus_pipeline
from rankeval.llm import decontaminate as D
from rankeval.llm import quality as Q
from rankeval.llm import registry, simhash
from rankeval.llm.common import table

SF = "/root/testdata/sf0.001"


def test_registry_has_every_operator():
    names = list(registry.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"} and len(names) == 14
    assert set(registry.SQL) <= set(names) and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_on_the_documents(spark):
    docs = table(spark, SF, "documents")
    steps, now = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        now = now.cache()
        if name != "feistel_sharding":
            assert now.columns == docs.columns, name
        steps.append(now)
    ids = [sorted(r.doc_id for r in s.select("doc_id").collect()) for s in steps]
    texts = {r.doc_id: r.text for r in docs.collect()}
    # quality: what the operator keeps; every base failure goes
    assert ids[1] == sorted(r.doc_id for r in Q.score(docs).filter("kept").collect())
    failed = {d for d, t in texts.items() if (b := Q.base_counts(t, Q.words_of(t)))[0] < 10 or 100 * b[4] > 20 * b[0]}
    assert not failed & set(ids[1])
    # near-dedup: the least id of each component of all pairs
    fps = [simhash.fingerprint(texts[d]) for d in ids[1]]
    least = []
    for i, d in enumerate(ids[1]):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in range(len(fps)):
                if j not in seen and (fps[k] ^ fps[j]).bit_count() <= 4:
                    seen.add(j)
                    todo.append(j)
        if d == min(ids[1][j] for j in seen):
            least.append(d)
    assert ids[2] == least
    # decontamination: no kept document holds an item, and what went does
    items = [" ".join(D.words_of(r.text)) for r in table(spark, SF, "benchmark").collect()]
    leaking = {d for d in ids[2] if any(f" {i} " in f" {' '.join(D.words_of(texts[d]))} " for i in items)}
    assert set(ids[2]) - set(ids[3]) == leaking
    # mixing keeps or repeats rows of its input only
    assert set(ids[4]) <= set(ids[3]) and len(ids[4]) > 0.6 * len(ids[3])
    # sharding keeps every row and balances
    assert ids[5] == ids[4]
    sizes = [r["count"] for r in steps[5].groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_run_writes_between_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {*table(spark, SF, "documents").columns, "shard", "slot"}
    rows = out.collect()
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
