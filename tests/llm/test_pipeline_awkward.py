"""The pipeline's stages on awkward rows and on empty tables."""

import pytest
from tables import awkward, empty  # noqa: F401  fixtures

import corpus_pipeline
from salescompass.llm.storage import stored


@pytest.fixture(scope="module")
def folder(spark, awkward, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("tables"))
    rows, _ = awkward
    labels = [(r[0], int(bool(r[1]) and len(r[1]) > 60), 0) for r in rows] + [(None, 1, 1), (3, None, None), (6, 0, 1), (6, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "one two"), (None, None), (3, ""), (None, "z a b c y")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bare"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_each_stage_keeps_the_columns(spark, awkward, folder, stage):  # noqa: F811
    _, df = awkward
    out = stage(spark, df, folder)
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    known = {r["doc_id"] for r in df.select("doc_id").collect()}
    assert {r["doc_id"] for r in out.select("doc_id").collect()} <= known


def test_all_stages_in_a_row(spark, awkward, folder):  # noqa: F811
    _, docs = awkward
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), f"awkward-{name}")
    rows = docs.collect()
    assert rows and sorted(r["row"] for r in rows) == list(range(len(rows)))


def test_all_stages_on_empty_tables(spark, empty, bare):  # noqa: F811
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, bare), f"empty-{name}")
        assert docs.count() == 0
