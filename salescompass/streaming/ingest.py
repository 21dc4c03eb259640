"""Event messages -> landing table.

One query reads the source once, in batches of bounded size.  Each batch is parsed, split
into good rows and dead letters, reduced to one row per event, checked against the rows
already landed and appended.  Delivery is at least once, so the same message may come again,
in the same batch or much later.  A repeat has the event id and the event date of its first
delivery, whatever batch either comes in, so looking at the landed rows of the batch's own
dates finds it however late it is; late first deliveries land like any other.

A batch that is run again after a failure finds its own rows landed and adds none, and its
dead letters and counters overwrite the folder named after the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from salescompass.schemas import ADVISOR_EVENTS, MESSAGE

REQUIRED = ("event_id", "advisor_id", "territory_id", "event_type", "event_timestamp", "row_timestamp")
EMPTY_METADATA = "{}"
EVENT_KEY = ("event_date", "event_id")
FILES_PER_BATCH = 1000
KAFKA_PER_BATCH = 5_000_000

SINK = T.StructType(
    [f for f in ADVISOR_EVENTS] + [T.StructField("batch_id", T.LongType()), T.StructField("event_date", T.DateType())]
)


def read_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Streaming lines of a growing folder, one message per line, so many files at a time."""
    return spark.readStream.options(**{"maxFilesPerTrigger": FILES_PER_BATCH, **options}).schema("value string").text(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Streaming values of a topic (needs Spark's Kafka package on the class path)."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    source = source.option("maxOffsetsPerTrigger", KAFKA_PER_BATCH)
    return source.options(**options).load().select(F.col("value").cast("string").alias("value"))


def parse(raw: DataFrame) -> DataFrame:
    """Text lines -> typed columns plus ``value`` and ``error`` (null for a good row).

    Absent keys become null, absent metadata ``{}``; a time's offset is dropped and its
    wall time kept.  Metadata stays JSON text here, because rows are compared later.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    message = F.from_json("value", MESSAGE, options)
    typed = raw.select("value", message.alias("m")).select(
        "value",
        *[F.col(f"m.{c}").alias(c) for c in ("event_id", "advisor_id", "territory_id", "event_type")],
        F.col("m.event_timestamp").try_cast("timestamp_ntz").alias("event_timestamp"),
        F.col("m.fund_id").alias("fund_id"),
        F.col("m.aum_amount").try_cast("decimal(18,2)").alias("aum_amount"),
        F.col("m.opportunity_id").alias("opportunity_id"),
        F.coalesce("m.metadata", F.lit(EMPTY_METADATA)).alias("metadata"),
        F.col("m.row_timestamp").try_cast("timestamp_ntz").alias("row_timestamp"),
        F.col("m._corrupt").alias("_corrupt"),
    )
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    error = F.when(F.col("_corrupt").isNotNull(), "malformed").when(missing != "", F.concat(F.lit("missing "), missing))
    return typed.withColumn("error", error).drop("_corrupt")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error", "value")


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).select("value", "error")


def one_per_event(rows: DataFrame) -> DataFrame:
    """One row per event (id and date): the earliest loaded.

    ``min`` is combined on the map side, so a message repeated a million times
    leaves each task as one row.
    """
    rest = [c for c in rows.columns if c not in (*EVENT_KEY, "row_timestamp")]
    first = F.min(F.struct("row_timestamp", *rest)).alias("r")
    return rows.groupBy(*EVENT_KEY).agg(first).select(*EVENT_KEY, "r.*").select(*rows.columns)


def landed_on(spark: SparkSession, sink: str, days: list) -> DataFrame | None:
    """Landed rows of the given days: only their partitions are read.  None before the first landing."""
    try:
        table = spark.read.schema(SINK).parquet(sink)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.filter(F.col("event_date").isin(days))


def not_landed(rows: DataFrame, landed: DataFrame | None) -> DataFrame:
    """Rows whose event is not landed yet."""
    if landed is None:
        return rows
    return rows.join(landed.select(*EVENT_KEY), list(EVENT_KEY), "left_anti")


def land_batch(sink: str, dead_letters: str, stats: str) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler for ``foreachBatch``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        is_bad = F.col("error").isNotNull()
        parsed = parse(batch).withColumn("event_date", F.to_date("event_timestamp"))
        # kept on disk, because what a batch leaves in an executor's memory would grow with it and is taken
        # from its sorts; the line itself is of use in a bad row only
        parsed = parsed.withColumn("value", F.when(is_bad, F.col("value"))).persist(StorageLevel.DISK_ONLY)
        received, errors, days = parsed.agg(
            F.count(F.lit(1)), F.count_if(is_bad), F.collect_set(F.when(~is_bad, F.col("event_date")))
        ).first()
        landed = landed_on(spark, sink, days) if days else None
        (
            not_landed(one_per_event(good_rows(parsed)), landed)
            .withColumn("metadata", F.coalesce(F.try_parse_json("metadata"), F.parse_json(F.lit(EMPTY_METADATA))))
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            # AQE merges small dates and splits a crowded one
            .hint("rebalance", "event_date")
            .write.mode("append")
            .partitionBy("event_date")
            .parquet(sink)
        )
        bad_rows(parsed).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
        # rows of this batch, however often it ran: files of other batches are skipped by their statistics
        inserted = landed_on(spark, sink, days).filter(F.col("batch_id") == batch_id).count() if days else 0
        counters = spark.createDataFrame([(received, inserted, errors)], "received long, inserted long, errors long")
        counters.write.mode("overwrite").parquet(f"{stats}/batch_id={batch_id}")
        parsed.unpersist()

    return handle


def ingest_stream(
    raw: DataFrame, sink: str, dead_letters: str, stats: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start the ingest query; default trigger takes what is there and stops."""
    return (
        raw.writeStream.foreachBatch(land_batch(sink, dead_letters, stats))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def landed_events(spark: SparkSession, sink: str) -> DataFrame:
    """The landed table in its declared column order."""
    return spark.read.schema(SINK).parquet(sink).select(*ADVISOR_EVENTS.fieldNames())
