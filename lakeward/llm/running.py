"""Running values within groups of any size.

Rows are dealt by range of (group, order), so a group that holds a third of all
rows is spread over as many tasks as it fills. Each task numbers and totals its own
rows; what a group carries from one task into the next is one row for each task,
added up on the driver (never more rows than partitions) and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut


def walker(columns: Sequence[str], group: str, sums: Sequence[str], xors: Sequence[str]):
    """mapInArrow body over rows sorted by group: adds the place in the task (``_at``), the
    place in the group (``idx``) and the running values, as far as this task sees."""
    place = {c: i for i, c in enumerate(columns)}
    values = [*sums, *xors]

    def walk(batches):
        from pyspark import TaskContext

        part, at, first = TaskContext.get().partitionId(), 0, None
        held, n_held, total = None, 0, dict.fromkeys(values, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(place[group]).to_numpy(zero_copy_only=False).astype(np.int64)
            first = int(keys[0]) if first is None else first
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
            goes_on = held == int(keys[0])
            idx = np.arange(n) - starts[run]
            idx[: n if len(starts) == 1 else starts[1]] += n_held if goes_on else 0
            made = {}
            for c in values:
                x = batch.column(place[c]).to_numpy(zero_copy_only=False).astype(np.int64)
                step = np.bitwise_xor if c in xors else np.add
                acc = step.accumulate(x)
                before = np.r_[np.int64(0), acc[starts[1:] - 1]]
                before[0] = (total[c] if c in xors else -total[c]) if goes_on else 0
                made[c] = acc ^ before[run] if c in xors else acc - before[run]
                total[c] = int(made[c][-1])
            held, n_held = int(keys[-1]), int(idx[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), pa.array(idx),
                 pa.array(keys == first), *[pa.array(made[c]) for c in values]],
                names=[*columns, "_part", "_at", "idx", "_head", *[f"run_{c}" for c in values]])
            at += n

    return walk


def carried(edges: list, sums: Sequence[str], xors: Sequence[str]) -> list[tuple]:
    """(part, rows, values...) that the first group of each task brings from earlier ones."""
    out, before = [], None
    for e in sorted(edges, key=lambda e: e["_part"]):
        last = e["last"]
        more = [0] * (1 + len(sums) + len(xors))
        if before is not None and before[0] == e["first"]:
            more = before[1]
            out.append((e["_part"], *more))
        own = [last["idx"] + 1, *(last[f"run_{c}"] for c in (*sums, *xors))]
        if last["group"] == e["first"]:
            plain = 1 + len(sums)
            own = [a + b for a, b in zip(own[:plain], more[:plain])] + [a ^ b for a, b in zip(own[plain:], more[plain:])]
        before = (last["group"], own)
    return out


def running(rows: DataFrame, group: str, order: Sequence[Column], sums: Sequence[str] = (), xors: Sequence[str] = (), name: str = "running") -> DataFrame:
    """``rows`` with ``idx`` (from 0 within ``group``, a column of integers without nulls,
    in the given order) and ``run_<c>``, the sum or XOR of the long column c over the group's rows
    up to and with this one. The order must be total but for rows that are equal."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *order]
    values = [*sums, *xors]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["_part int", "_at long", "idx long", "_head boolean"]
                       + [f"`run_{c}` long" for c in values])
    walked = rows.repartitionByRange(spread, *keys).sortWithinPartitions(*keys).mapInArrow(walker(rows.columns, group, sums, xors), schema)
    placed = cut(walked, name)
    end = F.struct(F.col(group).alias("group"), "idx", *[f"run_{c}" for c in values])
    edges = placed.groupBy("_part").agg(F.min_by(group, "_at").alias("first"), F.max_by(end, "_at").alias("last")).collect()
    extra = carried(edges, sums, xors)
    plain = [F.col(c) for c in rows.columns]
    if not extra:
        return placed.select(*plain, "idx", *[f"run_{c}" for c in values])
    names = ["rows", *values]
    offsets = rows.sparkSession.createDataFrame(extra, ", ".join(["_part int", *[f"`_more_{c}` long" for c in names]]))
    # At most one row for each task of the range shuffle.
    joined = placed.join(F.broadcast(offsets), "_part", "left")
    more = {c: F.when(F.col("_head"), F.coalesce(F.col(f"_more_{c}"), F.lit(0))).otherwise(F.lit(0)).cast("long") for c in names}
    return joined.select(
        *plain, (F.col("idx") + more["rows"]).alias("idx"),
        *[(F.col(f"run_{c}") + more[c]).alias(f"run_{c}") for c in sums],
        *[F.col(f"run_{c}").bitwiseXOR(more[c]).alias(f"run_{c}") for c in xors])
