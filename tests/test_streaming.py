import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from salescompass.operators.attribution import flow_state
from salescompass.streaming import ingest, refresh


def message(n, **changes):
    event = {
        "event_id": f"E{n}", "advisor_id": f"A{n % 3}", "territory_id": "T001", "event_type": "CALL",
        "event_timestamp": f"2024-01-0{n % 9 + 1}T10:00:00.123456+02:00", "fund_id": None, "aum_amount": 10.5,
        "opportunity_id": None, "metadata": {"source": "s"}, "row_timestamp": "2024-01-09T10:00:00+00:00",
    }
    event.update(changes)
    return json.dumps({k: v for k, v in event.items() if v is not ...})


class Feed:
    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, str(root), 0
        os.makedirs(f"{self.root}/in")
        self.paths = [f"{self.root}/{part}" for part in ("events", "dead", "stats", "checkpoint")]

    def deliver(self, *lines):
        with open(f"{self.root}/in/{self.files}.json", "w") as out:
            out.write("\n".join(lines) + "\n")
        self.files += 1

    def run(self):
        ingest.ingest_stream(ingest.read_files(self.spark, f"{self.root}/in"), *self.paths).awaitTermination()

    def read(self, part):
        return self.spark.read.parquet(f"{self.root}/{part}")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_good_and_bad_lines(feed):
    feed.deliver(
        message(1), message(2, metadata=...), message(3, event_id=None), "{broken", "[]",
        message(4, event_timestamp="yesterday"), message(5, aum_amount=...), message(1),
    )
    feed.run()
    rows = {r["event_id"]: r for r in feed.read("events").withColumn("m", F.to_json("metadata")).collect()}
    assert set(rows) == {"E1", "E2", "E5"}
    assert str(rows["E1"]["event_timestamp"]) == "2024-01-02 10:00:00.123456"  # wall time kept
    assert (rows["E1"]["m"], rows["E2"]["m"]) == ('{"source":"s"}', "{}")
    assert rows["E5"]["aum_amount"] is None
    errors = sorted((r["value"][:7], r["error"].split(",")[0]) for r in feed.read("dead").collect())
    assert errors == [
        ("[]", "malformed"), ('{"event', "missing event_id"), ('{"event', "missing event_timestamp"), ("{broken", "malformed"),
    ]
    stats = feed.read("stats").first()
    assert (stats["received"], stats["inserted"], stats["errors"]) == (8, 3, 4)


def test_later_repeat_and_idle_run_add_nothing(feed):
    feed.deliver(message(1), message(2))
    feed.run()
    feed.deliver(message(2), message(3))
    feed.run()
    feed.run()
    assert sorted(r["event_id"] for r in feed.read("events").collect()) == ["E1", "E2", "E3"]
    assert feed.read("stats").agg(F.sum("inserted")).first()[0] == 3


def test_batch_run_again_changes_nothing(spark, feed):
    feed.deliver(*[message(n) for n in range(20)], "{broken")
    handle = ingest.land_batch(*feed.paths[:3])
    batch = spark.read.text(f"{feed.root}/in")
    handle(batch, 0)
    before = [sorted(map(str, feed.read(p).collect())) for p in ("events", "dead", "stats")]
    handle(batch, 0)
    assert [sorted(map(str, feed.read(p).collect())) for p in ("events", "dead", "stats")] == before


def test_a_batch_is_not_kept_in_memory(spark, feed, monkeypatch):
    """What is kept of a batch while it lands is on disk, and the lines only of the bad rows."""
    feed.deliver(*[message(n) for n in range(2000)], "{broken")
    stored = lambda: {r.id(): (r.memSize(), r.diskSize()) for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    kept, before, unpersist = [], stored(), DataFrame.unpersist

    def seen(df, *args):
        sizes = [size for rdd, size in stored().items() if rdd not in before]
        kept.append((sizes, [r["value"] for r in df.filter("value is not null").collect()]))
        return unpersist(df, *args)

    monkeypatch.setattr(DataFrame, "unpersist", seen)
    ingest.land_batch(*feed.paths[:3])(spark.read.text(f"{feed.root}/in"), 0)
    ((sizes, lines),) = kept
    assert sizes and all(memory == 0 and disk > 0 for memory, disk in sizes)
    assert lines == ["{broken"]
    assert feed.read("events").count() == 2000 and [r["value"] for r in feed.read("dead").collect()] == ["{broken"]


def test_much_repeated_message(feed):
    feed.deliver(*[message(7)] * 500, message(8))
    feed.run()
    assert feed.read("events").count() == 2


def day(n, date):
    return message(n, event_timestamp=f"{date}T10:00:00+00:00")


def test_batch_borders_do_not_matter(spark, tmp_path):
    """Repeats, dates out of order and a late first delivery: the same rows in one batch and in four."""
    files = [
        [day(0, "2024-01-05"), day(1, "2024-01-05")], [day(1, "2024-01-05"), day(2, "2024-01-06"), day(1, "2024-01-02")],
        [day(3, "1970-01-01"), day(0, "2024-01-05")], [day(3, "1970-01-01"), day(4, "2024-01-07")],
    ]
    landed = []
    for options in ({}, {"maxFilesPerTrigger": 1}):
        feed = Feed(spark, tmp_path / str(len(options)))
        for lines in files:
            feed.deliver(*lines)
        raw = ingest.read_files(spark, f"{feed.root}/in", **options)
        ingest.ingest_stream(raw, *feed.paths).awaitTermination()
        landed.append(sorted((r["event_id"], str(r["event_date"])) for r in feed.read("events").collect()))
        stats = feed.read("stats").agg(F.count("*"), F.sum("received"), F.sum("inserted")).first()
        assert tuple(stats) == (4 if options else 1, 9, 6)
    assert landed[0] == landed[1] and ("E3", "1970-01-01") in landed[0] and len(landed[0]) == 6


def test_lookup_reads_only_the_days_of_the_batch(spark, feed):
    import datetime as dt

    feed.deliver(*[day(n, f"2024-01-{n:02d}") for n in range(1, 10)], day(11, "1970-01-01"))
    feed.run()
    found = ingest.landed_on(spark, f"{feed.root}/events", [dt.date(1970, 1, 1), dt.date(2024, 1, 9)])
    plan = found.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "event_date" in plan.split("PartitionFilters")[1][:80]
    assert sorted(r["event_id"] for r in found.collect()) == ["E11", "E9"]
    assert ingest.landed_on(spark, f"{feed.root}/nothing", [dt.date(1970, 1, 1)]) is None


def test_refresh_keeps_latest_version(spark, feed):
    target = f"{feed.root}/counts"

    def run():
        changes = spark.readStream.text(f"{feed.root}/in")
        rebuild = lambda: spark.read.text(f"{feed.root}/in").agg(F.count(F.lit(1)).alias("n"))
        refresh.refresh_stream(changes, rebuild, target, f"{feed.root}/refresh_checkpoint").awaitTermination()
        return refresh.latest_version(spark, target).first()["n"]

    feed.deliver("a", "b")
    assert run() == 2
    feed.deliver("c")
    assert run() == 3


def test_unfinished_versions_are_not_read_and_old_ones_go(spark, feed):
    target = f"{feed.root}/counts"
    rebuild = lambda: spark.read.text(f"{feed.root}/in").agg(F.count(F.lit(1)).alias("n"))
    for n in range(5):
        feed.deliver(str(n))
        changes = spark.readStream.text(f"{feed.root}/in")
        refresh.refresh_stream(
            changes, rebuild, target, f"{feed.root}/refresh_checkpoint", keep=2,
            history=f"{feed.root}/history", as_of=lambda: "2024-01-01 00:00:00",
        ).awaitTermination()
    assert [v[-1] for v in refresh.finished_versions(spark, target)] == ["3", "4"]
    spark.range(7).write.parquet(f"{target}/version=000000009")
    os.remove(f"{target}/version=000000009/_SUCCESS")
    assert refresh.latest_version(spark, target).first()["n"] == 5
    history = spark.read.parquet(f"{feed.root}/history").drop("refresh")
    assert history.count() == 5 and history.columns == ["name", "schema_name", "refresh_action", "refresh_start_time"]


def test_flow_state_stream_equals_batch(spark, ws, tmp_path):
    flows = ws.table("fund_flows")
    source, state = str(tmp_path / "flows"), str(tmp_path / "state")
    month = F.date_format("flow_date", "yyyy-MM")
    last = flows.agg(F.max(month)).first()[0]

    def files():
        """Files of the months without late flows."""
        return {f for m, path in refresh._state_months(spark, state, 99).items() if m != last for f in spark.read.parquet(path).inputFiles()}

    before = None
    for kept in (month != last, month == last):
        flows.filter(kept).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(flows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        refresh.merge_flows_stream(stream, state, str(tmp_path / "checkpoint")).awaitTermination()
        if before is None:
            before = files()
    assert before and before == files()  # months without new flows keep their files
    merged, whole = refresh.current_flows(spark, state).drop("month"), flow_state(flows)
    assert merged.exceptAll(whole.select(merged.columns)).isEmpty()
    assert merged.count() == whole.count()


def test_flow_merge_keeps_earlier_flows_without_a_date(spark, ws, tmp_path):
    flows = ws.table("fund_flows").limit(40)
    dates = F.when(F.crc32(F.col("advisor_id").cast("string")) % 2 == 0, F.col("flow_date"))
    flows = spark.createDataFrame(flows.withColumn("flow_date", dates).collect(), flows.schema)
    source, state = str(tmp_path / "flows"), str(tmp_path / "state")
    undated = flows.filter("flow_date is null")
    for batch in (flows, undated, flows):
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(flows.schema).parquet(source)
        refresh.merge_flows_stream(stream, state, str(tmp_path / "checkpoint")).awaitTermination()
    merged, whole = refresh.current_flows(spark, state).drop("month"), flow_state(flows.unionAll(undated).unionAll(flows))
    assert not undated.isEmpty() and merged.count() == whole.count()
    assert merged.exceptAll(whole.select(merged.columns)).isEmpty()


def test_no_task_writes_a_whole_delivery(spark, tmp_path):
    """A delivery's messages come in files of bounded size, however many they are."""
    from salescompass.plans import registry
    from salescompass.sources.workspace import Workspace

    n = F.col("id")
    events = spark.range(0, 30_000, 1, 6).select(
        n.alias("event_id"), F.timestamp_seconds(n).cast("timestamp_ntz").alias("ts"), (n % 7).alias("user_id"), F.lit("error").alias("event_type"),
        F.lit(1.0).alias("value"), F.to_json(F.struct(F.sha2(n.cast("string"), 512).alias("k"))).alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    customers = spark.range(7).select(n.alias("c_custkey"), F.lit("c").alias("c_name"), F.lit(0).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"))
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(1).select(F.lit(0).alias("n_nationkey"), F.lit(0).alias("n_regionkey")).write.parquet(str(tmp_path / "nation.parquet"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "200k")
    try:
        sent = spark.read.text(registry._feed(Workspace(spark, str(tmp_path)))).withColumn("file", F.input_file_name())
    finally:
        spark.conf.set(setting, before)
    largest = sent.groupBy("delivery", "file").count().groupBy("delivery").agg(F.max("count"), F.sum("count")).collect()
    assert sent.count() == 60_000 and len(largest) == 3
    assert all(most <= every / 2 for _, most, every in largest)
