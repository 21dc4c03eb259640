"""Invariants of the tables, writers, metric layer and plans."""

import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salescompass import schemas
from salescompass.operators.alerts import alert_report
from salescompass.operators.attribution import flow_attribution, flow_totals
from salescompass.plans import derived, semantic
from salescompass.plans.registry import QUERIES
from salescompass.sources import sinks
from salescompass.sources.workspace import Workspace


def test_attribution_keeps_every_flow(ws):
    total = F.sum("flow_amount")
    assert ws.table("fund_flow_attribution").agg(total, F.sum("transaction_count")).first() == ws.table("fund_flows").agg(
        total, F.count(F.lit(1))
    ).first()


def test_engagement_is_unique_per_advisor(ws):
    scores = ws.table("advisor_engagement_score")
    assert scores.count() == scores.select("advisor_id").distinct().count() == ws.table("advisor_dim").filter("active").count()


def test_heat_map_counts_every_advisor(ws):
    per_date = ws.table("territory_heat_map").groupBy("as_of_date").agg(F.sum("advisor_count").alias("n")).collect()
    assert len(per_date) == 1
    assert {r["n"] for r in per_date} == {ws.table("advisor_engagement_score").count()}


def test_derived_tables_are_written_once(ws):
    built = derived.build_all(ws)
    assert set(built) == set(derived.TARGET_LAG)
    assert Workspace(ws.spark, ws.source_dir).table("fund_flows").inputFiles() == ws.table("fund_flows").inputFiles()


def test_failed_build_leaves_nothing(spark, ws):
    def write(path, fail):
        sinks.append(spark.range(3), path)
        if fail:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ws.stored("tried_table", lambda path: write(path, True))
    assert ws.stored("tried_table", lambda path: write(path, False)).count() == 3


def test_landing_columns_are_declared(ws):
    for name in ("territory_dim", "fund_dim", "advisor_dim", "fund_flows", "opportunity"):
        declared = {f.name: f.dataType for f in schemas.LANDING[name].fields}
        for field in ws.table(name).schema.fields:
            assert field.name in declared
            if name == "fund_flows":
                assert field.dataType == declared[field.name]


def test_external_table(spark, ws):
    ws.table("opportunity").limit(3).createOrReplaceTempView("other_opportunity")
    swapped = Workspace(spark, ws.source_dir, {"opportunity": lambda: spark.table("other_opportunity")})
    assert swapped.table("opportunity").count() == 3
    assert swapped.table("fund_dim").count() == ws.table("fund_dim").count()


def test_snapshot_run_twice(spark, tmp_path):
    path = str(tmp_path / "history")
    for day, score in (("2024-01-01", 1), ("2024-01-08", 2), ("2024-01-08", 3)):
        df = spark.createDataFrame([(day, score)], "d string, score int")
        sinks.write_snapshot(df.withColumn("d", F.to_date("d")), path, "d")
    assert sorted((r["d"], r["score"]) for r in spark.read.parquet(path).collect()) == [
        (dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 8), 3),
    ]


def test_writers(spark, tmp_path):
    hot = spark.range(1000).select(F.lit("T1").alias("t"), F.col("id"), (F.col("id") % 5).alias("d"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2000b")  # the rows are few
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    sinks.write_balanced(hot.repartition(8), str(tmp_path / "c"), ["t"], ["d"], ["t"])
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    # one group, several files
    assert len({r[0] for r in spark.read.parquet(str(tmp_path / "c")).select(F.input_file_name()).collect()}) > 1
    sinks.write_balanced(hot, str(tmp_path / "b"), ["t", F.col("d") % 2], ["d"])
    for name in "cb":
        assert spark.read.parquet(str(tmp_path / name)).count() == 1000
    assert dict(sinks.stamped(hot).dtypes)["row_timestamp"] == "timestamp_ntz"


def test_finish_works_on_the_shuffled_rows(spark, tmp_path):
    """Wide columns are worked out after the shuffle, in the order and without the helpers of the layout."""
    path, seen = str(tmp_path / "t"), []
    narrow = spark.range(500, numPartitions=4).select("id", (F.col("id") % 3).alias("t"))

    def finish(rows):
        seen.append((rows.columns, rows._jdf.queryExecution().optimizedPlan().toString()))
        return rows.select(F.repeat(F.col("id").cast("string"), 50).alias("wide"), "id", "t")

    sinks.write_balanced(narrow, path, ["t", F.col("id") % 2], ["id"], finish=finish)
    ((columns, below),) = seen
    assert columns == ["id", "t"] and "RebalancePartitions" in below
    written = spark.read.parquet(path)
    assert written.columns == ["wide", "id", "t"] and written.count() == 500
    assert written.filter(F.col("wide") != F.repeat(F.col("id").cast("string"), 50)).isEmpty()
    assert all(f.endswith(".zstd.parquet") for f in written.inputFiles())


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark, ws):
    """The disk holds the files of one job at a time, whatever the driver has collected."""
    flag = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, set_before, frames = _shuffle_files(spark), spark.conf.get(flag, None), []

    def write(path):
        frames.append(spark.range(1000).repartition(3).groupBy(F.col("id") % 10).count())
        sinks.overwrite(frames[0], path)

    assert ws.stored("counted_ids", write).count() == 10
    assert spark.conf.get(flag, None) == set_before
    deadline = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    # the count that the test itself asked for may leave one
    assert len({name.split("_")[1] for name in left}) <= 1
    assert len(frames[0].collect()) == 10


def test_attribution_is_written_where_the_joins_leave_it(spark, tmp_path, monkeypatch):
    """No shuffle of the joined rows only to lay them out; every file is in the order of the flow date."""
    day = dt.date(2024, 1, 1)
    flows = [(f"F{i % 7}", f"A{i % 5}", "T1", Decimal(i), day + dt.timedelta(days=i * 37 % 200), "INFLOW") for i in range(300)]
    tables = {
        "fund_flows": spark.createDataFrame(flows, "fund_id string, advisor_id string, territory_id string, flow_amount decimal(18,2), flow_date date, flow_type string"),
        "fund_dim": spark.createDataFrame([(f"F{i}", f"fund {i}", "c") for i in range(7)], "fund_id string, fund_name string, fund_category string"),
        "advisor_dim": spark.createDataFrame([(f"A{i}", "a", "T9") for i in range(5)], "advisor_id string, advisor_name string, territory_id string"),
        "territory_dim": spark.createDataFrame([("T1", "t")], "territory_id string, territory_name string"),
        "advisor_engagement_score": spark.createDataFrame([("A1", Decimal(100))], "advisor_id string, aum_amount decimal(18,2)"),
    }
    plans = []

    class Tables:
        def table(self, name):
            return tables[name]

        def stored(self, name, write):
            write(str(tmp_path / name))
            return spark.read.parquet(str(tmp_path / name))

    def written(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return overwrite(df, *args)

    overwrite = sinks.overwrite
    monkeypatch.setattr(sinks, "overwrite", written)
    table = derived._attribution(Tables())
    assert len(plans) == 1 and "Rebalance" not in plans[0]
    assert table.agg(F.sum("flow_amount"), F.sum("transaction_count")).first() == (Decimal(sum(range(300))), 300)
    for file in table.inputFiles():
        days = [r["flow_date"] for r in spark.read.parquet(file).collect()]
        assert days == sorted(days)


# -- metric layer -------------------------------------------------------------------------------
def test_registry_rows(spark):
    counts = semantic.describe(spark).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in counts} == {"fact": 14, "dimension": 18, "metric": 14}


def test_registry_size():
    tables = semantic.SEMANTIC.values()
    assert [sum(len(getattr(t, part)) for t in tables) for part in ("facts", "dimensions", "metrics")] == [14, 18, 14]


def test_metric_query_rejects_unknown(ws):
    with pytest.raises(ValueError):
        semantic.metric_query("territory", ws.table("territory_heat_map"), ["avg_heat_score"], ["flow_type"])


def test_synonyms(spark):
    terms = spark.createDataFrame([("Wholesaler",), (" AUM ",), ("???",)], "term string")
    rows = semantic.synonym_resolve(terms, semantic.synonyms(spark)).collect()
    found = {(r["term"], r["logical_table"], r["canonical"]) for r in rows}
    assert found == {
        ("Wholesaler", "advisor_eng", "advisor_name"), ("Wholesaler", "territory", "territory_mgr"),
        (" AUM ", "advisor_eng", "total_aum"), ("???", None, None),
    }


# -- plans --------------------------------------------------------------------------------------
def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(ws):
    text = plan(QUERIES["aum_summary"](ws))
    assert "GreaterThanOrEqual(flow_date" in text and "LessThanOrEqual(flow_date" in text
    assert "ReadSchema: struct<advisor_id:string,flow_amount:decimal(18,2),flow_date:date>" in text
    text = plan(QUERIES["no_calls_14d"](ws))
    assert "GreaterThanOrEqual(ts" in text


def test_snapshot_prunes_partitions(ws):
    text = plan(QUERIES["latest_snapshot"](ws))
    assert "PartitionFilters: [isnotnull(score_date" in text


def test_top_k_does_not_sort_everything(ws):
    assert "TakeOrderedAndProject" in plan(QUERIES["vq_top_advisors_by_aum"](ws))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith("stream_")}))
def test_no_cross_joins(ws, name):
    text = plan(QUERIES[name](ws))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_alert_rows_union(ws):
    rows = [QUERIES[n](ws) for n in QUERIES if n.startswith("alert_") and n not in ("alert_report", "alert_history", "alert_history_6h")]
    assert alert_report(rows).count() == 5


def test_metrics_add_up_to_the_current_book(ws):
    """Totals count every advisor once, whatever the history holds."""
    from salescompass.plans.registry import QUERIES

    total = lambda name, column: sum(r[column] for r in QUERIES[name](ws).collect())
    kpi = QUERIES["kpi_overview"](ws).first()
    engaged = ws.table("advisor_engagement_score")
    assert float(total("metric_total_aum", "total_aum")) == pytest.approx(float(kpi["total_aum"]))
    assert total("metric_total_advisor_count", "total_advisor_count") == engaged.count()
    assert QUERIES["dt_territory_heat_map"](ws).count() == ws.table("territory_dim").filter("active").count()
    assert QUERIES["semantic_facts_advisor_eng"](ws).count() == engaged.count()


def test_metrics_by_run_date_keep_all_runs(ws):
    from salescompass.plans import semantic

    history = ws.table("advisor_engagement_history")
    by_date = semantic.metric_query("advisor_eng", history, ["total_calls_30d"], ["score_date"])
    assert by_date.count() == len(derived.SNAPSHOT_DAYS_BACK)
    assert semantic.semantic_rows("advisor_eng", history, all_runs=True).count() == history.count()


def test_account_is_read_by_its_external_name(spark, ws):
    with pytest.raises(KeyError, match="external"):
        ws.table("account")
    given = spark.createDataFrame([("C1", "A1", "T001", "Name", "2024-01-02 03:04:05")], "account_id string, advisor_id string, territory_id string, account_name string, last_activity string")
    shared = Workspace(spark, ws.source_dir, {"account": lambda: given})
    assert dict(shared.table("account").dtypes)["last_activity"] == "timestamp_ntz"


def test_attribution_counts_copies_in_the_dimensions(spark):
    """A dimension row that is there n times counts n times, without an aggregate over the joined facts."""
    day = dt.date(2024, 1, 2)
    flows = spark.createDataFrame(
        [("F1", "A1", "T1", Decimal(5), day, "INFLOW"), ("F1", "A1", "T1", Decimal(7), day, "INFLOW"), ("F2", "A2", "T1", None, day, "OUTFLOW"), (None, "A1", "T1", Decimal(1), day, "INFLOW")],
        "fund_id string, advisor_id string, territory_id string, flow_amount decimal(18,2), flow_date date, flow_type string",
    )
    funds = spark.createDataFrame([("F1", "one", "c")] * 2 + [("F2", None, "c"), (None, "none", "c")], "fund_id string, fund_name string, fund_category string")
    advisors = spark.createDataFrame([("A1", "a", "T9")] * 3 + [("A2", "b", "T9"), ("A2", "other", "T9")], "advisor_id string, advisor_name string, territory_id string")
    territories = spark.createDataFrame([("T1", "t")], "territory_id string, territory_name string")
    engagement = spark.createDataFrame([("A1", Decimal(100))], "advisor_id string, aum_amount decimal(18,2)")
    out = flow_attribution(flows, funds, advisors, territories, engagement)
    found = {(r.fund_id, r.advisor_name, r.flow_amount, r.transaction_count, r.capture_rate) for r in out.collect()}
    assert found == {("F1", "a", Decimal(72), 12, Decimal(72)), ("F2", "b", None, 1, None), ("F2", "other", None, 1, None)}
    assert out.schema["flow_amount"].dataType.simpleString() == "decimal(28,2)"
    totals = flow_totals(flows, territories, "advisor_id")._jdf.queryExecution().executedPlan().toString()
    assert totals.count("Exchange hashpartitioning") == 1 and "hashpartitioning(advisor_id" in totals
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in above


def test_shuffles_start_with_partitions_in_proportion_to_the_input(spark, tmp_path):
    """A task's share does not grow with the input when the session's number of partitions is fixed."""
    flag = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "events.parquet").mkdir()
    with open(tmp_path / "events.parquet" / "part-0", "wb") as file:
        file.truncate(1_000_000_000)
    assert spark.conf.get(flag, None) is None
    try:
        Workspace(spark, str(tmp_path))
        assert int(spark.conf.get(flag)) == 63
        Workspace(spark, str(tmp_path / "events.parquet" / "none"))
        assert int(spark.conf.get(flag)) == 63
        numbers = spark.range(1000).groupBy(F.col("id") % 100).count()
        numbers.collect()
        assert "hashpartitioning" in numbers._jdf.queryExecution().executedPlan().toString()
        assert ", 63)" in numbers._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(flag)
