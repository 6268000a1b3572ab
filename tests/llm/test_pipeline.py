from __future__ import annotations

import corpus_pipeline
from cedeflow.llm.covering_simhash import near_duplicates
from cedeflow.llm.pfair_mix import BLOCK_DOCS, mixed
from cedeflow.llm.queries import ORACLE_SQL, QUERIES
from cedeflow.llm.storage import written

SF = "/root/testdata/sf0.001"


def test_stages(spark, docs_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF))
        ids, old = {r.doc_id for r in docs.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= old and docs.count() == len(ids)
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "simhash_near_dedup":
            firsts = {r.component_id for r in near_duplicates(before).select("component_id").collect()}
            assert ids == firsts
        if name in ("source_mixing", "sentencepiece"):
            assert ids == old
        sizes.append(len(ids))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "source_mixing", "sentencepiece"]
    assert 0 < sizes[-1] < sizes[0]
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


def test_the_tokens_keep_the_order_of_the_mix(spark, frame):
    sizes = {"a": 900, "b": 300, "c": 100}
    rows = [(i, "some words here", "en", s, 15) for k, (s, n) in enumerate(sizes.items()) for i in range(1000 * k, 1000 * k + n)]
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", *rows)
    wanted = [r.doc_id for r in mixed(docs).orderBy("position").select("row.doc_id").collect()]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        stage = written(corpus_pipeline.mixing(spark, docs, SF))
        assert len(stage.inputFiles()) > 1
    finally:
        spark.conf.set(name, before)
    got = corpus_pipeline.tokens(spark, stage, SF).orderBy("mix_position").collect()
    assert [r.doc_id for r in got] == wanted and len({r.mix_position for r in got}) == len(rows)
    blocks = {s: -(-n // BLOCK_DOCS) for s, n in sizes.items()}
    seen, done, slots = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0), 0
    for r in got:
        if seen[r.source] % BLOCK_DOCS == 0:
            done[r.source] += 1
            slots += 1
            assert all(abs(done[s] - slots * blocks[s] / sum(blocks.values())) < 1 for s in sizes)
        seen[r.source] += 1
