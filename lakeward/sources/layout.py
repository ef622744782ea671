"""Layer locations under a warehouse root, Parquet sink and scan, publication.

A run writes its layers to a folder of its own, ``_versions/<id>``, laid out like the
root itself, and then appends one row to the publication log, ``_published``. Readers
take the version of the last row. A run that ends before that leaves the earlier version in
place, whole; a reader that has resolved a version keeps reading it. The log's row becomes
visible with the rename of one small file. A root without a log is read as it
stands, so layers written to the plain paths stay readable.

Silver can be written in buckets of its key, sorted by it. Its readers go through a table
of the session's catalog that names the buckets, so what groups or joins by the key needs no
shuffle. The tables are external: dropping one leaves the files.
"""

from __future__ import annotations

import contextlib
import hashlib
import time
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward import config as C

LOG = "_published"
VERSIONS = "_versions"
#: What a run found out about its input files, beside the layers.
LEDGER = "contract_ledger.parquet"
LOG_SCHEMA = "version string, sequence bigint, published_at bigint, silver_buckets int"
#: What silver is bucketed by.
BUCKET_KEY = "event_id"
#: Rows of bronze that one bucket of silver may take: what bounds the memory of the task that sorts and writes it.
BUCKET_ROWS = 500_000
#: What a task reads of a layer whose rows it sorts by key before the shuffle: 128 MB of files are over 1 GB of rows.
SORTED_SPLIT = 32 << 20
#: What a pass shuffles of a layer by key, in bytes of the layer's files, which are about 0.4 of what the shuffle writes.
PASS_BYTES = 256 << 20
#: Each pass reads the whole layer, so their number is bounded.
MOST_PASSES = 3
#: Published versions that a build leaves in place.
KEPT_VERSIONS = 2


def layer_paths(root: str) -> dict[str, str]:
    """Five artifact paths (plain strings: ``s3://b/k`` must keep its ``//``)."""
    root = root.rstrip("/")
    return {layer: f"{root}/{rel}" for layer, rel in C.LAYER_DIRS.items()}


def relative_paths(root: str, paths: dict[str, str]) -> dict[str, str]:
    """Paths relative to ``root``, or to the version they are in, where possible (portable summary)."""
    prefix = root.rstrip("/") + "/"

    def short(path: str) -> str:
        if not path.startswith(prefix):
            return path
        rest = path[len(prefix):]
        return rest.split("/", 2)[2] if rest.startswith(f"{VERSIONS}/") else rest

    return {k: short(p) for k, p in paths.items()}


# ------------------------------------------------------------------ publication

def new_version(root: str) -> str:
    """The root of a version that nobody reads yet."""
    return f"{root.rstrip('/')}/{VERSIONS}/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"


def _log_rows(spark: SparkSession, root: str) -> list:
    log = f"{root.rstrip('/')}/{LOG}"
    if not _exists(spark, log):
        return []
    return spark.read.schema(LOG_SCHEMA).parquet(log).orderBy(F.desc("sequence"), F.desc("published_at"), F.desc("version")).collect()


def publications(spark: SparkSession, root: str) -> list[str]:
    """Ids of the published versions, the last one first; none for a root without a log."""
    return [r["version"] for r in _log_rows(spark, root)]


def current_root(spark: SparkSession, root: str) -> str:
    """Where the layers of the last published version are, laid out as under ``root``."""
    return _current(spark, root)[0]


def _current(spark: SparkSession, root: str) -> tuple[str, int]:
    """The last published version's root and its silver's buckets."""
    rows = _log_rows(spark, root)
    plain = root.rstrip("/")
    return (f"{plain}/{VERSIONS}/{rows[0]['version']}", rows[0]["silver_buckets"] or 0) if rows else (plain, 0)


def current_buckets(spark: SparkSession, root: str) -> int:
    """Buckets of the last published version's silver, 0 for none."""
    return _current(spark, root)[1]


def publish(spark: SparkSession, root: str, version_root: str, silver_buckets: int = 0) -> None:
    """Make a written version the one that readers take."""
    log = f"{root.rstrip('/')}/{LOG}"
    row = (version_root.rsplit("/", 1)[-1], len(publications(spark, root)) + 1, time.time_ns() // 1000, silver_buckets)
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def drop_old_versions(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Delete published versions but for the last ``keep``; returns their ids. Folders of
    runs that never published stay: a run may still be writing one."""
    old = publications(spark, root)[max(keep, 1):]
    gone = []
    for version in old:
        folder = f"{root.rstrip('/')}/{VERSIONS}/{version}"
        spark.sql(f"drop table if exists {_bucket_table(layer_paths(folder)[C.SILVER])}")
        if drop_folder(spark, folder):
            gone.append(version)
    return gone


def drop_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder; False if there is none."""
    path, fs = _hadoop_file(spark, folder)
    return fs.delete(path, True)


def _hadoop_file(spark: SparkSession, path: str) -> tuple:
    """A path as Hadoop has it, and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_file(spark, path)
    return fs.exists(p)


# ------------------------------------------------------------------ layers

def current_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """layer -> path in the last published version."""
    return layer_paths(current_root(spark, root))


def write_layer(df: DataFrame, path: str) -> None:
    """Full overwrite of one layer. Each layer has its own path, so a plan
    never overwrites what it reads."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def add_to_layer(df: DataFrame, path: str) -> None:
    """Further rows of a layer that ``write_layer`` began."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def passes_for(spark: SparkSession, path: str) -> int:
    """In how many passes a written layer is shuffled by key: shuffle files stay until all rows are through, and are
    larger than the layer itself."""
    p, fs = _hadoop_file(spark, path)
    return min(MOST_PASSES, max(1, -(-fs.getContentSummary(p).getLength() // PASS_BYTES)))


def share_of(df: DataFrame, key: str, number: int, shares: int) -> DataFrame:
    """One of ``shares`` parts of a frame that have no key in common. Not by the hash that deals rows out
    in a shuffle: of that, a share would meet but a part of the tasks."""
    return df if shares == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(shares)) == number)


@contextlib.contextmanager
def session_conf(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings that hold within the block; ``__`` stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """What a write, or a frame made and collected, within the block has shuffled is deleted when it
    ends. Otherwise the files stay until the driver happens to collect its garbage: over a build,
    more than all its layers."""
    return session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def small_splits(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Scans within the block read ``SORTED_SPLIT`` a task, or less if the session says so."""
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return session_conf(spark, spark__sql__files__maxPartitionBytes=str(min(now, SORTED_SPLIT)))


def _bucket_table(path: str) -> str:
    return f"lakeward_silver_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a layer in buckets of ``key``, sorted by it. A frame that was last shuffled by the key (as
    the dedupe is) is shuffled into the buckets themselves: one task and one file for each."""
    spark = df.sparkSession
    name = f"{_bucket_table(path)}_writer"
    with shuffles_dropped(spark), session_conf(spark, spark__sql__shuffle__partitions=str(buckets), spark__sql__adaptive__coalescePartitions__enabled="false"):
        df.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"drop table if exists {name}")


def buckets_for(rows: int, least: int) -> int:
    """Buckets of silver made from so many rows: ``least``, or as many as hold ``BUCKET_ROWS`` each."""
    return max(least, -(-rows // BUCKET_ROWS))


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A layer that ``write_bucketed`` wrote, through a table that knows the buckets."""
    name = _bucket_table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"create table if not exists {name} ({columns}) using parquet clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{place}'")
    return spark.table(name)


def read_layer(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_footers(spark: SparkSession, path: str) -> DataFrame:
    """A layer through the reader that answers counts, and greatest and least dates and
    numbers, from the file footers alone where nothing is filtered or grouped. Timestamps,
    texts and decimals are scanned as ever."""
    others = [x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip().lower() != "parquet"]
    # Holds when the plan is made and is of no effect on the usual reader.
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    with session_conf(spark, spark__sql__sources__useV1SourceList=",".join(others)):
        return spark.read.parquet(path)


def read_layers(spark: SparkSession, root: str, register_views: bool = False) -> dict[str, DataFrame]:
    """The layers of the last published version."""
    version, buckets = _current(spark, root)
    out = {}
    for layer, path in layer_paths(version).items():
        bucketed = buckets and layer == C.SILVER
        out[layer] = read_bucketed(spark, path, BUCKET_KEY, buckets) if bucketed else read_layer(spark, path)
        if register_views:
            out[layer].createOrReplaceTempView(layer)
    return out


def read_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """The contract ledger of the last published version, if it has one."""
    path = f"{current_root(spark, root)}/{LEDGER}"
    return spark.read.parquet(path) if layer_exists(spark, path) else None


def layer_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` resolves to a readable Parquet dataset (metadata only)."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def missing_layers(spark: SparkSession, root: str) -> list[str]:
    """Artifact paths, as ``layer_paths`` has them, that the last published version lacks."""
    plain = layer_paths(root)
    return [plain[layer] for layer, path in current_paths(spark, root).items() if not layer_exists(spark, path)]


def assert_layers_exist(spark: SparkSession, root: str) -> None:
    missing = missing_layers(spark, root)
    if missing:
        raise FileNotFoundError(f"missing built artifacts: {', '.join(missing)}")
