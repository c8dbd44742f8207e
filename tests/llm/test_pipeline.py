import corpus_pipeline
import __spark_entry__ as entry
from footfall.llm import queries
from footfall.llm.common import table
from tests.llm.test_ngram_join import by_brute_force as near_by_brute_force

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_input(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept.append((before, docs))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            assert docs.exceptAll(before).isEmpty()  # rows go, none change
    good, exact, near, clean, packed = kept
    assert 0 < good[1].count() < good[0].count()

    rows = exact[0].collect()
    best = {}
    for r in rows:
        best[(r.text or "").lower()] = max(best.get((r.text or "").lower(), -1), r.doc_id)
    assert {r.doc_id for r in exact[1].collect()} == set(best.values())

    classes = near_by_brute_force([(r.doc_id, r.text) for r in near[0].collect()])
    assert {r.doc_id for r in near[1].collect()} == {c[1] for c in classes}

    items = [" ".join(r.text.lower().split()) for r in table(spark, SF, "benchmark").collect()]
    leaky = {r.doc_id for r in clean[0].collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert {r.doc_id for r in clean[1].collect()} == {r.doc_id for r in clean[0].collect()} - leaky
    assert {r.doc_id for r in packed[1].collect()} == {r.doc_id for r in packed[0].collect()}


def test_queries_are_registered_once_per_operator():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(queries.ORACLES) <= set(queries.QUERIES)
