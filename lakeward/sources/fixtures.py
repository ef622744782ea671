"""Order-event view over the driver's TPC-H-like tables (test input only).

The joins belong to the fixture, not to the engine: they turn ``lineitem``
into an append-only stream of order events with real duplicate deliveries,
late arrivals, NULL keys and mixed case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.sources.layout import shuffles_dropped, small_splits

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order events with the numbers that their ids are made of."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # No hints: Spark broadcasts a side by its size in bytes, the rest is shuffled by key.
    customer_region = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                       .join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name"))
    order_region = orders.join(customer_region, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_custkey", "r_name")
    joined = li.join(order_region, F.col("l_orderkey") == F.col("o_orderkey"))

    return joined.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 101 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("custkey"),
        F.col("r_name").alias("region"),
        F.when(F.col("l_returnflag") == "R", F.lit("CANCELLED"))
        .when(F.col("l_linestatus") == "F", F.lit("Delivered"))
        .otherwise(F.lit("created"))
        .alias("status"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("order_amount"),
        F.col("l_shipdate").alias("event_ts"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("l_suppkey") % 1440).cast("int"), F.lit(0)))
        .alias("ingestion_ts"),
        F.concat(F.lit("batch_"), F.col("l_suppkey") % 4).alias("source_file"),
    )


def _with_ids(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        F.concat(F.lit("evt-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("event_id"),
        F.concat(F.lit("ord-"), F.col("l_orderkey")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("custkey")).alias("customer_id"),
        "region", "status", "order_amount", "event_ts", "ingestion_ts", "source_file",
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns: event_id, order_id, customer_id, region, status, order_amount,
    event_ts, ingestion_ts, source_file (contract order + lineage last)."""
    return _with_ids(_numbered_events(spark, sf_dir))


# Shapes of the four CSV batches written from the view (test input).
#   batch_0: contract order
#   batch_1: columns in reverse order (allowed drift)
#   batch_2: contract + additive ``source_system`` (allowed drift)
#   batch_3: contract order ("clean") or, in the "breaking" variant, ``status``
#            renamed to ``state`` and some amounts not numbers
# In the "line breaks" variant some customers of batch_1 have a line break in their name.
CONTRACT_ORDER = ("event_id", "order_id", "customer_id", "region", "status",
                  "order_amount", "event_ts", "ingestion_ts")
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
#: Folder of the staged view, beside the batches.
STAGED = "staged_order_events"


def write_csv_batches(spark: SparkSession, sf_dir: str, root: str, variant: str = "clean") -> str:
    """Write the order-event view as four CSV batch directories under
    ``root``; returns the glob that matches them (``root/*.csv``).

    The view is materialised once as Parquet, with numbers for its ids, then each batch is
    written from it (one scan each), so the fixture joins run only once. The batches are gzipped, about a quarter of
    their text, in files of a small split each, which a reader can't split. The Parquet, ``STAGED``, stays for the caller to delete."""
    root = root.rstrip("/")
    staged = f"{root}/{STAGED}"
    with shuffles_dropped(spark):
        _numbered_events(spark, sf_dir).write.mode("overwrite").option("compression", "zstd").parquet(staged)
    events = _with_ids(spark.read.parquet(staged))
    text = events.select(
        "source_file", "event_id", "order_id", "customer_id", "region", "status",
        F.col("order_amount").cast("string").alias("order_amount"),
        F.date_format("event_ts", CSV_TS_FORMAT).alias("event_ts"),
        F.date_format("ingestion_ts", CSV_TS_FORMAT).alias("ingestion_ts"),
    )
    for k in range(4):
        part = text.where(F.col("source_file") == f"batch_{k}").drop("source_file")
        if k == 1:
            if variant == "line breaks":
                part = part.withColumn("customer_id", F.when(F.length("event_id") % 2 == 0, F.concat("customer_id", F.lit("\nsecond line")))
                                       .otherwise(F.col("customer_id")))
            part = part.select(*reversed(CONTRACT_ORDER))
        elif k == 2:
            part = part.withColumn("source_system", F.concat(F.lit("erp-"), F.length("event_id") % 3))
        elif k == 3 and variant == "breaking":
            part = part.withColumn(
                "order_amount",
                F.when(F.minute(F.col("ingestion_ts").cast("timestamp")) % 7 == 3, F.lit("not-a-decimal"))
                .otherwise(F.col("order_amount")),
            ).withColumnRenamed("status", "state")
        with small_splits(spark):
            (part.write.mode("overwrite").option("header", "true")
             .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
             .csv(f"{root}/batch_{k}.csv"))
    return f"{root}/*.csv"
