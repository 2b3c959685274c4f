import corpus_pipeline
from conftest import SF_CHECK
from llm_cases import documents  # noqa: F401
from strata.llm import queries, quality
from strata.llm.common import materialise


def test_stages_apply_their_decisions(spark):
    docs = queries.table(spark, SF_CHECK, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialise(stage(spark, seen[-1], SF_CHECK), name))
    start, good, cut, single, clean, packed = seen
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup",
                                                     "benchmark_decontamination", "best_fit_packing"]
    assert all(x.columns == docs.columns for x in (good, cut, single, clean))
    field = quality.train(start, queries.table(spark, SF_CHECK, "labels"))
    kept = {r["doc_id"] for r in quality.score(start, field).where("kept").collect()}
    assert {r["doc_id"] for r in good.select("doc_id").collect()} == kept
    assert cut.count() == good.count() and cut.where("n_chars <> length(text)").count() == 0
    before = {r["doc_id"]: r["text"] for r in good.collect()}
    changed = [r for r in cut.collect() if r["text"] != before[r["doc_id"]]]
    assert changed and all(len(r["text"]) < len(before[r["doc_id"]]) for r in changed)
    from strata.llm import simhash

    groups = {r["component"] for r in simhash.near_duplicates(cut).collect()}
    assert {r["doc_id"] for r in single.collect()} == groups
    from strata.llm import decontam

    hit = {r["doc_id"] for r in decontam.contaminated(single, queries.table(spark, SF_CHECK, "benchmark")).collect()}
    assert hit and {r["doc_id"] for r in clean.collect()} == groups - hit
    assert {r["doc_id"] for r in packed.collect()} == groups - hit
    ran = corpus_pipeline.run(spark, SF_CHECK)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, ran.select(columns).collect())) == sorted(map(tuple, packed.select(columns).collect()))


def test_empty_and_null_documents_pass_through(spark, documents):  # noqa: F811
    docs = documents([(None, None), (1, None), (2, "")])
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_CHECK), name)
    assert docs.count() == 0


def test_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and sum(n.startswith("op") and "_" in n for n in names) == 13
