"""The inverted index that skips ranges, and the index that follows its documents, against a full search."""

import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from salescompass.operators import postings, search
from salescompass.streaming import segments

TOPICS = ["sea", "hill", "town", "farm", "mine", "wood"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents on six topics that share their common words, and short questions on each."""
    rng = random.Random(2)
    rows = []
    for i in range(1200):
        topic = TOPICS[i % 6]
        words = [topic] * 6 + [rng.choice(["and", "of", "in"]) for _ in range(rng.randrange(4, 12))]
        rows.append((i, " ".join(words + [f"{topic}{rng.randrange(60)}" for _ in range(8)])))
    rows += [(1200, ""), (1201, None), (1202, rows[5][1]), (1203, rows[5][1])]
    asked = [(f"q{i}", f"{TOPICS[i % 6]}{i} and {TOPICS[i % 6]}{i + 1} of nowhere") for i in range(24)] + [("none", "nowhere"), ("empty", "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache(), spark.createDataFrame(asked, "query_id string, text string").cache()


def index_of(docs):
    documents = search.index_documents(docs)
    return search.Index(documents, search.term_stats(documents), search.corpus_stats(documents))


def rows(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize(("size", "queries"), [(16, 256), (64, 5)])
def test_postings_give_the_rows_of_a_full_search(spark, corpus, tmp_path, monkeypatch, size, queries):
    docs, asked = corpus
    monkeypatch.setattr(postings, "QUERY_BLOCK", queries)
    index = index_of(docs)
    postings.write_blocks(postings.posting_blocks(index, size), str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))

    def keep(name, df):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    found = postings.search_postings(search.query_terms(asked), index, blocks, keep)
    assert rows(found.best) == rows(search.search_topk(search.query_terms(asked), index))
    read, there = found.blocks_read()
    assert 0 < read < there / 2, (read, there)  # other topics' ranges are skipped


def test_only_the_folders_of_the_terms_are_read(spark, corpus, tmp_path):
    docs, _ = corpus
    index = index_of(docs)
    postings.write_blocks(postings.posting_blocks(index), str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    one = search.query_terms(spark.createDataFrame([("q", "house")], "query_id string, text string"))

    def keep(name, df):
        if name == "bounds":
            scans = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line and "top:double" in line]
            assert scans and all("bucket#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
            assert all("ReadSchema: struct<term:string,range:int,top:double>" in x for x in scans)  # the postings are left out
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    found = postings.search_postings(one, index, blocks, keep)
    assert rows(found.best) == rows(search.search_topk(one, index))
    assert blocks.select("bucket").distinct().count() == postings.BUCKETS


def test_a_term_in_all_documents_is_cut_into_bounded_blocks(spark):
    docs = spark.createDataFrame([(i, f"same same word{i % 50}") for i in range(2000)], "doc_id long, text string")
    blocks = postings.posting_blocks(index_of(docs), 100).collect()
    assert max(r["n"] for r in blocks) <= 100 and sum(r["n"] for r in blocks if r["term"] == "same") == 2000


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in plan if "Exchange hashpartitioning(" in line]


def test_postings_are_shuffled_once_and_packed(spark, corpus, tmp_path, monkeypatch):
    docs, asked = corpus
    index, written, parquet = index_of(docs), {}, DataFrameWriter.parquet

    def spy(writer, path, *args, **options):
        written[path] = writer._df
        parquet(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    postings.write_blocks(postings.posting_blocks(index), str(tmp_path / "blocks"))
    dealt = [line for line in exchanges(written[str(tmp_path / "blocks")]) if "_part" not in line]
    assert len(dealt) == 1 and "hashpartitioning(bucket" in dealt[0] and "slice" in dealt[0]

    def keep(name, df):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    found = postings.search_postings(search.query_terms(asked), index, spark.read.parquet(str(tmp_path / "blocks")), keep)
    for scored in (written[str(tmp_path / "probed")], found.best):  # a query's terms are not repeated for every range
        assert not [line for line in exchanges(scored) if "term#" in line and "range#" in line]


def test_ranges_cut_between_batches_and_slices_give_whole_blocks(spark, monkeypatch):
    rng = random.Random(4)
    texts = {i: [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 9))] for i in range(300)}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    monkeypatch.setattr(postings, "SLICE", 2)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    try:
        spark.conf.set(batch, "7")
        blocks = postings.posting_blocks(index_of(docs), 16).collect()
    finally:
        spark.conf.set(batch, before)
    assert len({(r["term"], r["range"]) for r in blocks}) == len(blocks)
    ranges = {}
    for r in blocks:
        assert r["n"] == len(r["docs"]) == len(r["parts"]) and r["top"] == max(r["parts"])
        for doc in r["docs"]:
            ranges.setdefault(doc, set()).add(r["range"])
    assert all(len(found) == 1 for found in ranges.values())
    assert sorted((r["term"], doc) for r in blocks for doc in r["docs"]) == sorted((t, i) for i, w in texts.items() for t in set(w))
    avg = sum(map(len, texts.values())) / len(texts)
    for r in blocks:
        for doc, part in zip(r["docs"], r["parts"]):
            tf, length = texts[doc].count(r["term"]), len(texts[doc])
            assert part == pytest.approx(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg)))


CHANGE = "doc_id long, text string, kind string, deleted boolean, at int"


def fresh(spark, state):
    return index_of(spark.createDataFrame([(i, t, k) for i, (t, k) in state.items()], "doc_id long, text string, kind string"))


def test_index_follows_its_documents(spark, tmp_path):
    rng = random.Random(3)
    schema = spark.createDataFrame([], CHANGE).schema
    index = segments.SegmentedIndex(spark, str(tmp_path), schema, most=3)
    asked = search.query_terms(spark.createDataFrame([(f"q{i}", f"w{i} w{i + 1} w{i + 2}") for i in range(20)], "query_id string, text string"))
    state, names = {}, []
    for batch in range(6):
        changes = []
        for at in range(40):
            doc, text = rng.randrange(60), " ".join(f"w{rng.randrange(25)}" for _ in range(rng.randrange(12)))
            deleted = rng.random() < 0.3
            changes.append((doc, None if deleted else text, rng.choice("ab"), deleted, at))
            state.pop(doc, None)
            if not deleted:
                state[doc] = (text, changes[-1][2])
        changes.append((None, "no id", "a", False, 99))
        index.apply(spark.createDataFrame(changes, CHANGE).repartition(3), batch)
        names.append(index.segments())
        view, whole = index.view(), fresh(spark, state)
        assert rows(search.search_topk(asked, view)) == rows(search.search_topk(asked, whole))
        only = F.col("kind") == "a"
        assert rows(search.search_topk(asked, view, where=only)) == rows(search.search_topk(asked, whole, where=only))
        assert sorted(view.terms.collect()) == sorted(whole.terms.collect()) and view.corpus.first() == whole.corpus.first()
        if batch == 2:  # the same batch again changes nothing
            index.apply(spark.createDataFrame(changes, CHANGE), batch)
            assert rows(search.search_topk(asked, index.view())) == rows(search.search_topk(asked, whole))
    assert names[2] == ["000000000-000000000", "000000001-000000001", "000000002-000000002"]
    assert names[3] == ["000000000-000000003"]  # merged
    assert names[5] == ["000000000-000000003", "000000004-000000004", "000000005-000000005"]


def test_unfinished_segments_are_not_read(spark, tmp_path):
    index = segments.SegmentedIndex(spark, str(tmp_path), spark.createDataFrame([], CHANGE).schema)
    assert index.view().documents.count() == 0 and index.view().corpus.first()["docs"] == 0
    index.apply(spark.createDataFrame([(1, "one", "a", False, 0)], CHANGE), 0)
    files = index.live(index.segments()).inputFiles()
    spark.createDataFrame([(1,)], "doc_id long").write.parquet(str(tmp_path / "dead/segment=000000001-000000001"))
    assert index.view().documents.count() == 1
    index.apply(spark.createDataFrame([(2, "two", "a", False, 0)], CHANGE), 1)
    assert set(files) <= set(index.live(index.segments()).inputFiles())  # the first segment's files stay as they are
