"""Landing tables derived from the given star-schema files.

Each function reads only the columns it needs and returns the landing table's columns;
a projection over one file stays a projection, so filters and column choices made by the
caller reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescompass.operators.skew import broadcast_within, heavy_keys, skew_join, spread

# --- fixed values: how source codes read in the landing tables ----------------------
EVENT_TYPES = {
    "click": "CALL", "purchase": "MEETING", "view": "EMAIL", "signup": "EVENT_ATTENDANCE", "error": "AUM_UPDATE",
}
FLOW_TYPES = {"R": "OUTFLOW", "A": "TRANSFER", "N": "INFLOW"}
REGIONS = ["East", "Central", "West"]
TIERS = ["PLATINUM"] * 2 + ["GOLD"] * 3 + ["SILVER"] * 3 + ["BRONZE"] * 2  # by id % 10
ORDER_STAGES = {"F": "Closed Won", "P": "Closed Lost"}
PRIORITY_STAGES = {"1": "Negotiation", "2": "Proposal/Quote", "3": "Qualification"}  # else Prospecting
# -------------------------------------------------------------------------------------


_SCHEMAS: dict[tuple[str, str], object] = {}


def read(spark: SparkSession, source_dir: str, name: str) -> DataFrame:
    """One source file; its schema is looked up once per application."""
    path = f"{source_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _lookup(key: Column, values: dict, otherwise: Column | None = None) -> Column:
    expr = None
    for source, target in values.items():
        expr = F.when(key == source, target) if expr is None else expr.when(key == source, target)
    return expr if otherwise is None else expr.otherwise(otherwise)


def _pick(index: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def territory_key(region_key: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad((region_key + 1).cast("string"), 3, "0"))


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def territory_dim(spark: SparkSession, source_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return read(spark, source_dir, "region").select(
        territory_key(key).alias("territory_id"),
        F.col("r_name").alias("territory_name"),
        _pick(key % 3, REGIONS).alias("region"),
        _id("Manager_", key).alias("territory_mgr"),
        F.lit(True).alias("active"),
    )


def fund_dim(spark: SparkSession, source_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, source_dir, "part").select(
        _id("F", F.col("p_partkey")).alias("fund_id"),
        F.col("p_name").alias("fund_name"),
        F.col("p_type").alias("fund_category"),
        F.col("p_brand").alias("asset_class"),
        F.when(size % 5 != 0, _id("BM_", size)).alias("benchmark"),
    )


def _nations(spark: SparkSession, source_dir: str, n_nations: int) -> DataFrame:
    return broadcast_within(read(spark, source_dir, "nation").select("n_nationkey", "n_regionkey"), n_nations)


def advisor_dim(spark: SparkSession, source_dir: str, n_nations: int) -> DataFrame:
    nations = _nations(spark, source_dir, n_nations)
    return (
        read(spark, source_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _id("A", F.col("c_custkey")).alias("advisor_id"),
            F.col("c_name").alias("advisor_name"),
            territory_key(F.col("n_regionkey")).alias("territory_id"),
            _pick((F.col("c_custkey") % 10).cast("int"), TIERS).alias("tier"),
            (F.col("c_acctbal") >= 0).alias("active"),
        )
    )


def advisor_events(spark: SparkSession, source_dir: str, n_customers: int) -> DataFrame:
    """Events without the territory, which only ``located_events`` needs (it costs a join)."""
    key = F.col("event_id")
    user = F.when(key % 2 == 0, F.col("user_id")).otherwise(key % n_customers)
    return read(spark, source_dir, "events").select(
        _id("E", key).alias("event_id"),
        _id("A", user).alias("advisor_id"),
        _lookup(F.col("event_type"), EVENT_TYPES).alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.lit(None).cast("string").alias("fund_id"),
        (F.col("value").cast("decimal(18,2)") * 100_000).cast("decimal(18,2)").alias("aum_amount"),
        F.lit(None).cast("string").alias("opportunity_id"),
        F.col("props").alias("metadata"),
        F.col("ts").alias("row_timestamp"),
    )


def located_events(events: DataFrame, advisors: DataFrame) -> DataFrame:
    """Events with their advisor's territory; one advisor may hold a third of the events."""
    where = advisors.select("advisor_id", "territory_id")
    positioned = events.withColumn("_row", F.monotonically_increasing_id())
    heavy = heavy_keys(events, "advisor_id")["advisor_id"]
    # events of unknown advisors stay, without a territory
    return skew_join(positioned, where, "advisor_id", "left", spread_by=F.col("_row"), heavy=heavy).drop("_row")


def flow_items(spark: SparkSession, source_dir: str, n_suppliers: int, n_nations: int) -> DataFrame:
    """Line items with their buyer and the supplier's territory, in the narrow columns of the files.

    Both joins are balanced against heavy orders and suppliers.  The spread is the row's
    position in its file split, taken at the scan, because exact copies of a row would
    hash alike.
    """
    items = read(spark, source_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate", F.monotonically_increasing_id().alias("_row"),
    )
    items = spread(items)
    orders = read(spark, source_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    nations = _nations(spark, source_dir, n_nations)
    suppliers = (
        read(spark, source_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), territory_key(F.col("n_regionkey")).alias("territory_id"))
    )
    suppliers = broadcast_within(suppliers, n_suppliers)
    heavy = heavy_keys(read(spark, source_dir, "lineitem"), "l_orderkey", "l_suppkey")
    joined = skew_join(items, suppliers, "l_suppkey", spread_by=F.col("_row"), heavy=heavy["l_suppkey"])
    joined = skew_join(joined, orders, "l_orderkey", spread_by=F.col("_row"), heavy=heavy["l_orderkey"])
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "territory_id", "l_extendedprice", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )


def as_flows(items: DataFrame) -> DataFrame:
    """The landing columns of ``flow_items``, each from its own row: their texts need no shuffle."""
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return items.select(
        F.concat(_id("L", F.col("l_orderkey")), _id("-", F.col("l_linenumber"))).alias("flow_id"),
        _id("F", F.col("l_partkey")).alias("fund_id"),
        _id("A", F.col("o_custkey")).alias("advisor_id"),
        "territory_id",
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).cast("decimal(18,2)").alias("flow_amount"),
        F.to_date("l_shipdate").alias("flow_date"),
        _lookup(F.col("l_returnflag"), FLOW_TYPES).alias("flow_type"),
        F.col("l_linestatus").alias("share_class"),
        F.col("l_shipdate").alias("row_timestamp"),
    )


def fund_flows(spark: SparkSession, source_dir: str, n_suppliers: int, n_nations: int) -> DataFrame:
    """Line items with the buyer as advisor and the supplier's territory."""
    return as_flows(flow_items(spark, source_dir, n_suppliers, n_nations))


def opportunity(spark: SparkSession, source_dir: str, n_funds: int) -> DataFrame:
    key = F.col("o_orderkey")
    created = F.to_date("o_orderdate")
    by_priority = _lookup(F.substring("o_orderpriority", 1, 1), PRIORITY_STAGES, F.lit("Prospecting"))
    return read(spark, source_dir, "orders").select(
        _id("O", key).alias("opportunity_id"),
        _id("A", F.col("o_custkey")).alias("advisor_id"),
        _lookup(F.col("o_orderstatus"), ORDER_STAGES, by_priority).alias("stage"),
        F.when(key % 50 != 0, F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        _id("F", key % n_funds).alias("fund_id"),
        created.alias("created_date"),
        F.date_add(created, 60).alias("close_date"),
        F.date_add(created, (key % 60).cast("int")).alias("last_modified"),
        F.col("o_orderdate").alias("row_timestamp"),
    )
