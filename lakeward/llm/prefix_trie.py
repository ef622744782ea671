"""A trie of conversation prefixes, screened by a count-min sketch (operator 12).

Every prefix of a conversation has a digest of 128 bits: the XOR of two hashes of each turn's
place, role and text (a SHA-256 digest within), so digests of prefixes are running XORs, and the
parent's is the prefix's own without its last turn. Rows are turns, never whole conversations:
a conversation may hold a third of all turns.

Screening. All prefix digests go into a count-min sketch of two rows, whose cells the
cluster counts (partial sums, then one row for each cell met). What the tasks need of it
is whether a cell counts more than one: a bitmap of 16 bits a prefix, at most ``sketch_bytes``
long. More prefixes than that fit are screened in rounds: conversations are dealt to rounds by their
first turn, so all rows of a node are in one round, and each round reads only its own rows. An
estimate of one proves a prefix to be in one conversation only:

* a prefix whose parent is proven, too, is part of a tail: its row is complete in the task that
  holds it, and is put out without a shuffle;
* a proven prefix below an unproven one only looks up its parent's smallest member;
* only unproven prefixes are grouped by digest, exactly. A collision in the sketch makes more rows
  go this way, never another result.

Sums over subtrees need no walk by levels. Each node's saved tokens are owned by its smallest
member, and each leaf by its smallest member; running sums from a conversation's end give what it
owns below each of its prefixes, and a node's total is the sum over its members. Ends are
hashed from sorted pieces: tasks join sorted ids to pieces of text, one hash streams over the
pieces of its node.

Defined cases: rows of a null conv_id belong to no conversation and are ignored; null roles and
texts are empty; a null turn comes first, equal turns are ordered by SHA-256 of role and text;
repeated rows are turns of their own; columns besides these four are ignored; an empty table gives an
empty result, without a root.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, salted_lookup
from lakeward.llm.running import running
from lakeward.session import scratch_path

#: A head has at most this many turns.
MOST_HEAD = 8
#: Conversations whose ids fall into one run of so many share the first one's head.
FAMILY = 5
#: Cells of each of the two rows for each prefix; a power of two.
CELLS = 8
#: Longest bitmap of one round: 32 MB hold 2**24 prefixes.
SKETCH_BYTES = 32 << 20
#: Bits of one bitmap that Spark's bitmap_construct_agg makes.
BITMAP_BITS = 32768
#: Bytes of joined ids in one piece.
PIECE = 1 << 16
NODE = ["p1", "p2", "depth"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def narrow_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, n_bytes): a digest of role and text in place of both."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(whole, 256).alias("mark"), F.octet_length(text).cast("long").alias("n_bytes"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, mark, n_bytes, len): the turns of the rebuilt conversations, and a row
    of depth 0 for each conversation; len is the number of turns."""
    turns = running(cut(narrow_turns(conversations), "turns"), "conv_id", [F.asc_nulls_first("turn"), F.asc("mark")], name="places")
    turns = turns.select("conv_id", (F.col("idx") + 1).alias("pos"), "mark", "n_bytes")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where((F.col("conv_id") == base) & (F.col("pos") <= MOST_HEAD)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "mark", "n_bytes"))).alias("head"))  # at most MOST_HEAD turns
    kept = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", kept).withColumn("base", base)
    headed = convs.join(heads.hint("merge"), "base", "left").withColumn(
        "head", F.filter("head", lambda t: t["pos"] <= F.col("h"))).withColumn("b", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    headed = headed.withColumn("b", F.greatest("b", F.lit(0).cast("long")))
    infos = cut(headed.select("conv_id", "h", "b", "head", (F.col("b") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len")), "conversations")
    own = salted_lookup(turns, infos.select("conv_id", "h", "b", "len"), ["conv_id"], "pos", how="inner").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("b")).alias("depth"), "mark", "n_bytes", "len")
    lent = infos.select("conv_id", "len", F.inline("head")).select("conv_id", F.col("pos").alias("depth"), "mark", "n_bytes", "len")
    roots = infos.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("mark"), F.lit(0).cast("long").alias("n_bytes"), "len")
    return own.unionAll(lent).unionAll(roots)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, n_bytes, len, v1, v2, p1, p2): v the hashes of the turn, p of the prefix."""
    keyed = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(i), "depth", "mark")).otherwise(F.lit(0).cast("long")).alias(f"v{i}") for i in (1, 2)]
    table = cut(turns.select("conv_id", "depth", "n_bytes", "len", *keyed), "keyed")
    return running(table, "conv_id", [F.asc("depth")], xors=["v1", "v2"], name="prefixes").select(
        "conv_id", "depth", "n_bytes", "len", "v1", "v2", F.col("run_v1").alias("p1"), F.col("run_v2").alias("p2"))


def shared_cells(rows: DataFrame, width: int) -> np.ndarray:
    """The sketch's bitmap: a bit for each cell, set where it counts more than one prefix."""
    cells = F.array(F.pmod("p1", F.lit(width)), F.pmod("p2", F.lit(width)) + F.lit(width))
    counts = rows.where("depth > 0").select(F.explode(cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    packed = counts.where("n > 1").groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    # bitmap_bucket_number counts from 1, and the bits of cell c are those of bucket (c - 1) // BITMAP_BITS + 1.
    out = np.zeros(2 * width // 8 + BITMAP_BITS // 4, np.uint8)
    for row in packed.toLocalIterator():
        at = row["bucket"] * (BITMAP_BITS // 8)
        out[at : at + BITMAP_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def proven(spark: SparkSession, bitmap: np.ndarray, width: int):
    """Column function: true where the sketch estimates a prefix digest at one."""
    sketch = spark.sparkContext.broadcast(bitmap)

    def is_set(cells: np.ndarray) -> np.ndarray:
        bits = sketch.value
        # Cell c > 0 is bit (c - 1) % BITMAP_BITS of bucket (c - 1) // BITMAP_BITS + 1; cell 0 is bit 0 of bucket 0.
        at = np.where(cells > 0, cells - 1 + BITMAP_BITS, 0)
        return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1

    @F.arrow_udf("boolean")
    def single(p1: pa.Array, p2: pa.Array) -> pa.Array:
        a, b = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (p1, p2))
        return pa.array((is_set(a & (width - 1)) & is_set((b & (width - 1)) + width)) == 0)

    return single


def screened(rows: DataFrame, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``rows`` with single (the estimate is one) and under_single (the parent's is, and there is one)."""
    spark = rows.sparkSession
    n = rows.where("depth > 0").count()
    rounds = max(1, -(-n * 2 * CELLS // (8 * sketch_bytes)))
    width = 1 << max(12, (-(-n // rounds) * CELLS - 1).bit_length())
    parent = [F.col("p1").bitwiseXOR(F.col("v1")), F.col("p2").bitwiseXOR(F.col("v2"))]
    path = scratch_path(spark, "screened")
    if rounds > 1:
        # All rows of a node have the first turn in common, hence the round.
        first = salted_lookup(rows, rows.where("depth <= 1").groupBy("conv_id").agg(F.max_by("p1", "depth").alias("first")), ["conv_id"], "depth")
        rows_at = scratch_path(spark, "rounds")
        first.withColumn("round", F.pmod(F.xxhash64("first"), F.lit(rounds))).drop("first").write.partitionBy("round").parquet(rows_at)
    for i in range(rounds):
        part = rows if rounds == 1 else spark.read.parquet(rows_at).where(F.col("round") == i).drop("round")
        single = proven(spark, shared_cells(part, width), width)
        marked = part.withColumn("single", (F.col("depth") > 0) & single("p1", "p2")).withColumn("under_single", (F.col("depth") > 1) & single(*parent))
        marked.write.mode("append").parquet(path)
    return spark.read.schema(marked.schema).parquet(path)


def joined_ids(batches):
    """mapInArrow body over rows (p1, p2, depth, conv_id) sorted so: pieces of comma-joined ids."""

    def piece(key, ids):
        return pa.RecordBatch.from_pylist([dict(zip(NODE, key)) | {"first": ids[0], "ids": ",".join(map(str, ids))}], PIECES)

    key, ids = None, []
    for batch in batches:
        p1, p2, depth, convs = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        starts = np.flatnonzero(np.r_[True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1]) | (depth[1:] != depth[:-1])]) if len(convs) else []
        for a, b in zip(starts, [*starts[1:], len(convs)]):
            now = (int(p1[a]), int(p2[a]), int(depth[a]))
            if ids and (now != key or len(ids) * 20 > PIECE):
                yield piece(key, ids)
                ids = []
            key = now
            ids += convs[a:b].tolist()
    if ids:
        yield piece(key, ids)


def hashed_pieces(batches):
    """mapInArrow body over pieces sorted by node and first id: one digest for each node."""
    key, sha = None, None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            now = tuple(row[c] for c in NODE)
            if now == key:
                sha.update(b",")
            else:
                if sha:
                    out.append(dict(zip(NODE, key)) | {"ends_sha256": sha.hexdigest()})
                key, sha = now, hashlib.sha256()
            sha.update(row["ids"].encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, ENDS)
    if sha:
        yield pa.RecordBatch.from_pylist([dict(zip(NODE, key)) | {"ends_sha256": sha.hexdigest()}], ENDS)


_KEY = [("p1", pa.int64()), ("p2", pa.int64()), ("depth", pa.int64())]
PIECES = pa.schema([*_KEY, ("first", pa.int64()), ("ids", pa.string())])
ENDS = pa.schema([*_KEY, ("ends_sha256", pa.string())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, depth, ends_sha256) from rows (p1, p2, depth, conv_id)."""
    spread = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*NODE, "conv_id"]
    table = cut(ends.select(*keys), "ends")
    pieces = table.repartitionByRange(spread, *keys).sortWithinPartitions(*keys).mapInArrow(
        joined_ids, "p1 long, p2 long, depth long, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed_pieces, "p1 long, p2 long, depth long, ends_sha256 string")


def parent_of(rows: DataFrame) -> list[Column]:
    return [F.col("p1").bitwiseXOR(F.col("v1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("v2")).alias("p2"), (F.col("depth") - 1).alias("depth")]


def trie(conversations: DataFrame, sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256),
    one row per node."""
    rows = screened(prefixes(rebuilt(conversations)), sketch_bytes)
    own_end = F.when(F.col("depth") == F.col("len"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_ENDS))
    alone = [F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("len")).cast("long").alias("n_children"),
             F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), own_end.alias("ends_sha256")]
    tails = rows.where("single and under_single").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *alone)

    # Exact groups of the prefixes that the sketch doesn't prove single. A prefix below a proven one is
    # single whatever its own estimate.
    open_rows = rows.where("not single")
    groups = cut(open_rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("v1").alias("v1"),
        F.max("v2").alias("v2"), F.max("under_single").alias("under_single")), "nodes")
    tops = cut(rows.where("single and not under_single"), "tops")  # the first proven prefix of each tail
    children = tops.select(*parent_of(tops)).unionAll(groups.where("depth > 0 and not under_single").select(*parent_of(groups)))
    below = children.groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = cut(groups.join(below.hint("merge"), NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted")

    # What each conversation owns below each of its open prefixes, from its end on.
    known = salted_lookup(open_rows.select("conv_id", "len", *NODE), nodes.select(*NODE, "conv", "n_convs", "n_children", "n_bytes"), NODE, "conv_id", how="inner")
    owns = F.col("conv") == F.col("conv_id")
    leaf = (F.col("depth") == F.col("len")) & owns & (F.col("n_children") == 0)
    owned = known.select("conv_id", *NODE, leaf.cast("long").alias("leaves"),
                         F.when(owns, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(F.lit(0)).alias("saved"), F.lit(True).alias("open"))
    proven_ends = rows.where("single and depth = len").select("conv_id", *NODE, F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), F.lit(False).alias("open"))
    paths = running(cut(owned.unionAll(proven_ends), "owned"), "conv_id", [F.desc("depth")], sums=["leaves", "saved"], name="paths")
    totals = paths.where("open").groupBy(*NODE).agg(F.sum("run_leaves").alias("n_leaves"), F.sum("run_saved").alias("saved_tokens"))
    ends = end_digests(open_rows.where("depth = len").select(*NODE, "conv_id"))

    smallest = nodes.select(*NODE, F.col("conv").alias("parent_conv_id"))
    whole = nodes.join(totals.hint("merge"), NODE).join(ends.hint("merge"), NODE, "left").select(
        F.col("conv").alias("conv_id"), *NODE, "v1", "v2", "under_single", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    result = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    asking = whole.where("depth > 0 and not under_single").select("conv_id", *parent_of(whole), *result).unionAll(
        tops.select("conv_id", *parent_of(tops), *alone))
    answered = salted_lookup(asking, smallest, NODE, "conv_id").select("conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id", *result)
    settled = whole.where("depth = 0 or under_single").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("conv_id")).alias("parent_conv_id"), *result)
    return tails.unionAll(answered).unionAll(settled)
