"""Exact duplicates by a tree merge of sorted digest runs (operator 7).

One pass over the texts writes a narrow digest table; ``slot`` is the number of
the partition that made a row. Each slot is sorted by digest and collapsed to one
row per digest: a run. Then the runs of ``FAN_IN`` neighbouring slots meet in
binomial rounds, dealt by (group of slots, digest), merged in digest order and
collapsed again, until one group is left. A digest has at most one row for each
run, so a text with a third of all rows is never gathered anywhere, and the last
round is still dealt by digest over all tasks. Results go back down through
(digest, slot) pairs, of which a hot digest has one for each slot.

Every merge compares 128 bits of SHA-256, an independent XXH64 and the length;
rows that differ in any of them are not merged.

Defined cases: a null text counts as empty; empty texts form one group; a null id
loses ties against any id; of rows that repeat an id and a text, one (the first
read) stays; columns beside id and text are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut

#: log2 of the runs that one merge takes.
FAN_IN_BITS = 3
#: The characters that equality ignores.
SPACE = b" \t\n\v\f\r"

KEY = ["d1", "d2", "probe", "n_bytes"]
DIGESTS = "doc_id long, slot int, pos long, n_chars long, sha binary, d1 long, d2 long, probe long, n_bytes long"
RUNS = "grp int, d1 long, d2 long, probe long, n_bytes long, keep_chars long, keep_id long, keep_slot int, keep_pos long, copies long"


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: where it was read, its digest and its length."""

    def digests(batches):
        from pyspark import TaskContext

        slot, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            norm = [(t or b"").translate(None, SPACE) for t in texts]
            sha = [hashlib.sha256(t).digest() for t in norm]
            lead = np.frombuffer(b"".join(s[:16] for s in sha), np.int64).reshape(-1, 2)
            probe = np.array([xxhash.xxh64_intdigest(t) for t in norm], np.uint64).view(np.int64)
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(n, slot, np.int32)), pa.array(np.arange(pos, pos + n)),
                    batch.column(2), pa.array(sha, pa.binary()), pa.array(lead[:, 0]), pa.array(lead[:, 1]),
                    pa.array(probe), pa.array([len(t) for t in norm], pa.int64()),
                ],
                names=["doc_id", "slot", "pos", "n_chars", "sha", *KEY],
            )
            pos += n

    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.length(text).cast("long").alias("n_chars"))
    return narrow.mapInArrow(digests, DIGESTS)


def merge_sorted(batches):
    """Collapse rows sorted by (grp, key, best first) to one row per (grp, key).
    Only the last row of a batch waits for the next batch."""
    names = ["grp", *KEY]
    held = None
    for batch in batches:
        rows = pa.Table.from_arrays(batch.columns, names=batch.schema.names)
        if held is not None:
            rows = pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in names])
        first = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        copies = np.add.reduceat(rows.column("copies").to_numpy(), first)
        best = rows.take(pa.array(first))
        best = best.set_column(best.schema.get_field_index("copies"), "copies", pa.array(copies))
        held = best.slice(best.num_rows - 1)
        if best.num_rows > 1:
            yield from best.slice(0, best.num_rows - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def merged(runs: DataFrame) -> DataFrame:
    """Sort what each partition holds by digest and merge it."""
    order = [F.col(c) for c in ["grp", *KEY]]
    best = [F.desc("keep_chars"), F.asc_nulls_last("keep_id"), F.asc("keep_slot"), F.asc("keep_pos")]
    return runs.sortWithinPartitions(*order, *best).mapInArrow(merge_sorted, RUNS)


def tree_merge(digests: DataFrame, fan_in_bits: int = FAN_IN_BITS) -> DataFrame:
    """(key, keep_chars, keep_id, keep_slot, keep_pos, copies), one row per digest."""
    runs = merged(digests.select(
        F.col("slot").alias("grp"), *KEY, F.col("n_chars").alias("keep_chars"), F.col("doc_id").alias("keep_id"),
        F.col("slot").alias("keep_slot"), F.col("pos").alias("keep_pos"), F.lit(1).cast("long").alias("copies")))
    last = digests.agg(F.max("slot")).first()[0] or 0
    while last:
        last >>= fan_in_bits
        runs = merged(runs.withColumn("grp", F.shiftright("grp", fan_in_bits)).repartition("grp", *KEY))
    return runs.drop("grp")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document."""
    digests = cut(digest_table(docs, id_col, text_col), "digests")
    groups = tree_merge(digests)
    where = digests.select(*KEY, "slot").distinct().join(groups.hint("merge"), KEY)
    rows = digests.join(where.hint("merge"), [*KEY, "slot"])
    return rows.select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        ((F.col("slot") == F.col("keep_slot")) & (F.col("pos") == F.col("keep_pos"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
