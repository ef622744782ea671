"""Helpers that several operators share: tables, stage cuts, hot-key joins."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.session import scratch_path

#: Rows in one Arrow batch: bounds what a task holds in Python at a time.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: later
    plans start from files that survive the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete what ``cut`` wrote, once no later plan starts from it."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.cut_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def worker_state(name: str, make):
    """A value kept for the life of one Python worker, so that tasks that run in
    the same worker share vocabularies and caches."""
    holder = sys.modules.setdefault("_lakeward_worker_state", types.ModuleType("_lakeward_worker_state"))
    if name not in holder.__dict__:
        holder.__dict__[name] = make()
    return holder.__dict__[name]


def salted_lookup(rows: DataFrame, mapping: DataFrame, key: Sequence[str], salt_of: str, salts: int = 64, how: str = "left") -> DataFrame:
    """``rows`` joined (left or inner) with ``mapping`` (unique on ``key``), for a key that may
    hold a third of all rows: the mapping first meets the distinct (key, salt)
    pairs, at most ``salts`` for a key, and the rows then join on key and salt. Both
    are merge joins: neither side is of a known size, so neither is broadcast."""
    key = list(key)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
    pairs = salted.select(*key, "_salt").distinct().join(mapping.hint("merge"), key, how)
    return salted.join(pairs.hint("merge"), [*key, "_salt"], how).drop("_salt")


class BoundedCache(dict):
    """A dict that computes missing values and holds two generations of at most
    ``limit`` entries; the older one goes when the younger is full."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
