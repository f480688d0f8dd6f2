import os

import __spark_entry__ as E
import corpus_pipeline
from ledgerspark.llm import common
from ledgerspark.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = common.table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        assert 0.5 * before < docs.count() <= before
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_awkward_documents_pass_every_stage(spark):
    from cases import AWKWARD
    rows = [(k, t, None, None, len(t or "")) for k, t in enumerate(AWKWARD)] + [(None, "x", "", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "test")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, "
                                      "n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = common.stored(stage(spark, empty, SF), "test")
        assert empty.count() == 0


def test_registered():
    assert set(REGISTRY) <= set(E.queries())
    assert len(REGISTRY) == 14 and os.path.exists(corpus_pipeline.__file__)
