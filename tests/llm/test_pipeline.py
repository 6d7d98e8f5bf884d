import inspect

import pyarrow as pa

import corpus_pipeline
from dimflow.llm.common import stored, table
from dimflow.llm.queries import QUERIES
from tests.llm.data import empty
from tests.llm.test_lines import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        docs = stored(stage(spark, docs, SF), "test-stage")
        seen.append(docs)
        if name != "best-fit packing":
            assert docs.columns == columns
    toxic, lines, near, mixed, packed = seen
    first = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    left = {r.doc_id for r in toxic.collect()}
    assert {d for d, t in labels.items() if t == 0 and d in first} <= left
    want = {d: t for d, t in brute(sorted((r.doc_id, r.text, k) for k, r in enumerate(toxic.collect())), 10)}
    assert {r.doc_id: r.text for r in lines.collect()} == {d: t for d, t in want.items() if t.strip() or t == first[d]}
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    assert {r.doc_id for r in near.collect()} <= {r.doc_id for r in lines.collect()}
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    assert packed.filter("piece = 0").count() == mixed.count()


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0
    assert empty(spark).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(q.name[2:].split("_")[0]) for q in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_workers_get_few_texts_at_once(spark):
    """Long texts: a batch of Spark's 10,000 would hold them all. A smaller number of the session's own stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = table(spark, SF, "documents")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    try:
        for stage, own, most in (("toxic_documents", "10000", 500), ("near_duplicates", "0", 500), ("near_duplicates", "7", 7),
                                 ("target_weights", "10000", 500), ("best_fit_packing", "10000", 500)):
            spark.conf.set(name, own)
            getattr(corpus_pipeline, stage)(spark, docs.filter("false"), SF)
            found = [r.n for r in spark.range(0, 1200, 1, 1).mapInArrow(sizes, "n long").collect()]
            assert sum(found) == 1200 and max(found) == most
    finally:
        spark.conf.set(name, before)
