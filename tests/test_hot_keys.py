"""Join-heavy queries on data where one advisor, order and supplier hold a third of the rows."""

import os

import duckdb
import pytest
from check_oracle import compare
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as contract
from salescompass.operators import skew

HOT = {  # file -> {column: value put on every third row}
    "lineitem": {"l_orderkey": 7, "l_suppkey": 3, "l_partkey": 5},
    "orders": {"o_custkey": 9},
    "events": {"user_id": 5},
}
QUERIES = [
    "landing_layout", "activity_counts", "aum_summary", "dt_advisor_engagement_score", "dt_fund_flow_attribution",
    "dt_territory_heat_map", "pipeline_signals", "win_rate", "stream_ingest", "incremental_flow_merge", "dq_report",
]


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("hot")
    for name in os.listdir(SF_DIR):
        df = spark.read.parquet(f"{SF_DIR}/{name}")
        third = F.pmod(F.xxhash64(*df.columns), F.lit(3)) == 0
        for column, value in HOT.get(name.removesuffix(".parquet"), {}).items():
            df = df.withColumn(f"_{column}", F.when(third, F.lit(value).cast("long")).otherwise(F.col(column)))
        for column in HOT.get(name.removesuffix(".parquet"), {}):
            df = df.drop(column).withColumnRenamed(f"_{column}", column)
        df.write.parquet(f"{out}/{name}")
    return str(out)


@pytest.fixture(scope="module")
def duck(hot_dir):
    con = duckdb.connect()
    for name in os.listdir(hot_dir):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{hot_dir}/{name}/*.parquet'")
    return con


def test_hot_keys_are_found(spark, hot_dir):
    heavy = skew.heavy_keys(spark.read.parquet(f"{hot_dir}/lineitem.parquet"), "l_orderkey", rows_per_task=100)
    assert set(heavy["l_orderkey"]) == {7}


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_when_spread(spark, hot_dir, duck, name, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    assert compare(contract.queries()[name](spark, hot_dir), duck, contract.oracle_sql()[name]) is None
