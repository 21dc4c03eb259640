import numpy as np
import pytest
from pyspark.sql import functions as F

from salescompass.operators import rows, search, vectors
from salescompass.operators.attribution import flow_state, merge_flow_batch
from salescompass.operators.skew import broadcast_within, dimension_join, heavy_keys, skew_join


def collected(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def hot(spark):
    """3000 rows, a third of them on key 7, and some null keys."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(3000).select(key.alias("k"), "id").cache()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_join(spark, hot, how):
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.union(spark.createDataFrame([(7, -1)], "k long, v long"))  # not unique
    heavy = heavy_keys(hot, "k", rows_per_task=100)["k"]
    assert heavy == {7: 1000 + hot.filter("id % 3 > 0 and k = 7").count()}
    salted = skew_join(hot, right, "k", how, heavy=heavy, rows_per_task=100)
    assert "_salt" in salted._jdf.queryExecution().toString()
    assert collected(salted) == collected(hot.join(right, "k", how))


def test_skew_join_spreads_copies(spark):
    copies = spark.range(1000).select(F.lit("x").alias("k"), F.lit(1).alias("v"), F.monotonically_increasing_id().alias("_row"))
    one = spark.createDataFrame([("x", 2)], "k string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = skew_join(copies, one, "k", spread_by=F.col("_row"), rows_per_task=50)
    per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(per_task) == 1000 and len(per_task) > 1 and max(per_task) < 700


def test_dimension_join_beyond_the_limit(spark, hot):
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = collected(hot.join(right, "k", how))
        assert collected(dimension_join(hot, right, "k", how)) == plain
        assert collected(dimension_join(hot, right, "k", how, limit=399 * 8)) == plain


def test_many_keys_above_the_floor_are_all_found(spark):
    """The floor is absolute: 3,000 heavy keys are 3,000 heavy keys in a table of any size."""
    df = spark.range(3000 * 12).select((F.col("id") % 3000).alias("k")).union(spark.range(50_000).select((F.col("id") + 10_000).alias("k")))
    heavy = heavy_keys(df, "k", rows_per_task=10)["k"]
    assert set(heavy) == set(range(3000)) and set(heavy.values()) == {12.0}
    right = df.distinct().withColumn("v", F.col("k") * 2)
    joined = skew_join(df.withColumn("_row", F.monotonically_increasing_id()), right, "k", spread_by=F.col("_row"), heavy=heavy, rows_per_task=10)
    assert joined.count() == df.count() and joined.filter("v != 2 * k").isEmpty()


def test_sampled_heavy_keys(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    heavy = heavy_keys(df, "k", rows_per_task=50_000)["k"]
    assert set(heavy) == {-1} and abs(heavy[-1] / 200_000 - 1) < 0.2
    plan = df.sample(0.01, 1).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_small_inputs_have_no_heavy_keys(hot):
    assert heavy_keys(hot, "k") == {"k": {}}


def test_skew_join_rejects_right(spark, hot):
    with pytest.raises(ValueError):
        skew_join(hot, hot, "k", "right")


def test_broadcast_needs_small_count(spark):
    df = spark.range(10)
    assert "broadcast" in broadcast_within(df, 10, 240)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in broadcast_within(df, 11, 240)._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize("step", [1, 997])
def test_number_rows(spark, step):
    df = spark.range(1000).select((F.col("id") * step % 1009).alias("key"))
    got = rows.number_rows(df, "key").orderBy("key").collect()
    assert [r["n"] for r in got] == list(range(len(got)))


def test_number_rows_with_clustered_null_and_repeated_keys(spark):
    clustered = spark.range(400).select((F.lit(10**12) + F.col("id")).alias("key"))
    df = clustered.union(spark.range(200).select(F.lit(7).cast("long"))).union(spark.range(3).select(F.lit(None).cast("long")))
    got = rows.number_rows(df, "key").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(603))
    assert [r["key"] for r in got] == [None] * 3 + [7] * 200 + [10**12 + i for i in range(400)]
    assert rows.number_rows(df.limit(0), "key").count() == 0


def test_repeat_and_shuffle(spark):
    df = spark.range(10)
    assert collected(rows.repeat_rows(df, 3).groupBy("copy").count()) == [(0, 10), (1, 10), (2, 10)]
    shuffled = rows.shuffle_rows(df, seed=1)
    assert sorted(r["id"] for r in shuffled.collect()) == list(range(10))
    assert [r["id"] for r in shuffled.collect()] == [r["id"] for r in rows.shuffle_rows(df, seed=1).collect()]


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-08"), (3, "2024-01-08"), (4, None)], "id int, d string")
    assert {r["id"] for r in rows.latest_snapshot(df, "d").collect()} == {2, 3}


def test_merge_flow_batch(spark, ws):
    flows = ws.table("fund_flows")
    older, newer = F.col("flow_date") < "1998-01-01", F.col("flow_date") >= "1998-01-01"
    merged = merge_flow_batch(flow_state(flows.filter(older)), flows.filter(newer))
    assert collected(merged) == collected(flow_state(flows))


# -- search -------------------------------------------------------------------------------------
def brute_bm25(docs, query, k):
    import math
    import re
    from collections import Counter

    words = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in docs}
    avg = sum(map(len, words.values())) / len(words)
    scores = {}
    for i, w in words.items():
        tf, score = Counter(w), 0.0
        for term in set(re.findall(r"[^\W_]+", query.lower())):
            if tf[term]:
                df = sum(term in other for other in words.values())
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                score += idf * tf[term] * 2.2 / (tf[term] + 1.2 * (0.25 + 0.75 * len(w) / avg))
        if score:
            scores[i] = round(score, 6)
    return sorted(scores.items(), key=lambda e: (-e[1], e[0]))[:k]


DOCS = [
    (1, "Growth fund, equity growth"), (2, "Bond fund"), (3, "bond FUND"), (4, ""), (5, "Éclair équity / fund-of-fund"), (6, "unrelated"),
]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in DOCS], "doc_id int, text string, odd int").repartition(3)
    documents = search.index_documents(docs).cache()
    return search.Index(documents, search.term_stats(documents), search.corpus_stats(documents))


@pytest.mark.parametrize(("max_terms", "cells"), [(1000, 10**6), (2, 1)])
def test_search_against_brute_force(spark, index, max_terms, cells, monkeypatch):
    monkeypatch.setattr(search, "CELLS", cells)
    questions = [(1, "growth fund"), (2, "BOND bond"), (3, "équity"), (4, "nothing here"), (5, "fund")]
    queries = search.query_terms(spark.createDataFrame(questions, "query_id int, text string"))
    found = search.search_topk(queries, index, k=2, max_terms=max_terms).orderBy("query_id", "rank").collect()
    for query_id, question in questions:
        mine = [(r["doc_id"], r["score"]) for r in found if r["query_id"] == query_id]
        assert mine == brute_bm25(DOCS, question, 2)
    assert all(r["odd"] == r["doc_id"] % 2 for r in found)


def test_search_filter(spark, index):
    queries = search.query_terms(spark.createDataFrame([(1, "bond")], "query_id int, text string"))
    assert [r["doc_id"] for r in search.search_topk(queries, index, where=F.col("odd") == 1).collect()] == [3]


def test_search_shuffles_no_pairs(spark, index):
    """Only each task's best rows are exchanged, by query."""
    queries = search.query_terms(spark.createDataFrame([(1, "bond fund")], "query_id int, text string"))
    plain = search.Index(index.documents.drop("odd"), index.terms, index.corpus)
    plan = search.search_topk(queries, plain)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(query_id" in plan and "MapInArrow" in plan


# -- vectors ------------------------------------------------------------------------------------
def test_vector_chunks():
    rng = np.random.default_rng(5)
    ids, data, asked = np.arange(30), rng.normal(size=(30, 4)), rng.normal(size=(9, 4))
    whole = vectors._best(np.arange(9), asked, ids, data, 3)
    parts = [vectors._best_of_chunk(np.array([q]), asked[q : q + 1], ids, data, 3) for q in range(9)]
    assert whole.to_numpy().tolist() == [row for part in parts for row in part.to_numpy().tolist()]


@pytest.mark.parametrize("limits", [{}, {"max_broadcast": 0, "rows_per_block": 7}])
def test_vectors_against_brute_force(spark, limits, monkeypatch):
    monkeypatch.setattr(vectors, "CELLS", 100)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(60, 8))
    data[10:20] = data[0]  # exact copies tie
    data[30] = 0
    asked = rng.normal(size=(15, 8))
    vectors_df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, vector array<double>")
    found = vectors.vector_topk(queries, vectors_df.repartition(5), k=4, **limits).orderBy("query_id", "rank").collect()

    norm = np.linalg.norm(data, axis=1)
    norm[norm == 0] = 1
    scores = np.round((data / norm[:, None]) @ (asked / np.linalg.norm(asked, axis=1)[:, None]).T, 6)
    for q in range(15):
        best = sorted(range(60), key=lambda i: (-scores[i, q], i))[:4]
        assert [r["vec_id"] for r in found if r["query_id"] == q] == best


def test_vectors_without_queries(spark):
    queries = spark.createDataFrame([], "query_id int, vector array<double>")
    data = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert vectors.vector_topk(queries, data).count() == 0
