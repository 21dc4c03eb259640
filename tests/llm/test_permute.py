from pyspark.sql import functions as F

from salescompass.llm.permute import permuted, with_permuted


def test_permutes_every_range(spark):
    sizes = spark.createDataFrame([(n,) for n in [0, *range(1, 70), 1000, 4099]], "n long")
    rows = sizes.filter("n > 0").withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    out = rows.withColumn("y", permuted(F.col("x"), F.col("n"), F.lit("k"), F.col("n")))
    bad = out.groupBy("n").agg(F.countDistinct("y").alias("d"), F.min("y").alias("low"), F.max("y").alias("high")).filter("d != n or low != 0 or high != n - 1")
    assert bad.count() == 0
    assert sizes.filter("n = 0").select(permuted(F.lit(0), F.col("n"), F.lit(1)).alias("y")).first()["y"] is None


def test_keys_differ_and_runs_agree(spark):
    rows = spark.range(500)
    of = lambda key: [r["y"] for r in rows.select(permuted(F.col("id"), F.lit(500), F.lit(key)).alias("y")).collect()]
    assert of(1) == of(1) != of(2)
    same_place = sum(a == b for a, b in zip(of(1), range(500)))
    assert same_place < 12  # one is expected of a random permutation


def test_written_out_rounds_give_the_same_numbers(spark):
    sizes = spark.createDataFrame([(n,) for n in [0, *range(1, 40), 1000]], "_n long")
    rows = sizes.withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("_n") - 1, F.lit(0).cast("long")))))
    key = (F.lit("k"), F.col("_n"))
    both = with_permuted(rows, "y", F.col("_x"), F.col("_n"), *key).withColumn("z", permuted(F.col("_x"), F.col("_n"), *key))
    assert both.columns == ["_n", "_x", "y", "z"] and both.filter("not (y <=> z)").count() == 0
    assert both.filter("y is null").count() == 1
