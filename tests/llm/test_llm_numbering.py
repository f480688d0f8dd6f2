"""Row numbers that are joined across jobs must not depend on how the input is split into tasks."""

import pytest

import corpus_pipeline
from cases import changed, prose
from ledgerspark.llm import common
from ledgerspark.llm.queries import op2_lm_scoring, op4_ngram_jaccard_join


@pytest.fixture()
def moving_splits(spark, scratch, monkeypatch):
    """A folder with documents in files of unlike sizes, read in another number of tasks once
    a table was stored, as after a lost executor."""
    texts = []
    for f in range(12):
        base = prose(f, 150 + 40 * f)
        texts += [base, changed(base, f, 3), *[prose(1000 + 50 * f + k, 80) for k in range(f)]]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    for lo in range(0, len(rows), 9):
        spark.createDataFrame(rows[lo:lo + 9], "doc_id long, text string, lang string, "
                              "source string, n_chars long").coalesce(1).write.mode("append") \
            .parquet(f"{scratch}/documents.parquet")
    old, name = common.stored, "spark.sql.files.minPartitionNum"

    def stored(*args, **options):
        out = old(*args, **options)
        spark.conf.set(name, "64")
        return out
    monkeypatch.setattr(common, "stored", stored)
    spark.conf.set(name, "1")
    yield scratch, len(texts)
    spark.conf.unset(name)


def test_near_duplicates(spark, moving_splits):
    path, n = moving_splits
    got = {r["doc_id"]: r["component_id"] for r in op4_ngram_jaccard_join(spark, path).collect()}
    assert len(got) == n and n - len(set(got.values())) == 12


def test_pipeline_stage(spark, moving_splits):
    path, n = moving_splits
    docs = common.table(spark, path, "documents")
    out = corpus_pipeline.one_of_each_group(spark, docs, path)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) == n - 12


def test_scores(spark, moving_splits):
    path, n = moving_splits
    got = op2_lm_scoring(spark, path).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(n))
