"""Bitmaps of bounded size that spare rows a shuffle.

The cluster sets the bits (Spark's own bitmap aggregates, one row of 4 kB for each 32,768
bits that hold any), the driver joins them and every task gets a copy: ``FOR_EACH`` bits a key, at most ``BITS``. A set
bit proves nothing, an unset one proves that a key isn't wanted, so a join that follows gives the same rows
with or without the bitmap; on more keys than bits it spares less."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 16 MB.
BITS = 1 << 27
FOR_EACH = 16
#: Bits of one bitmap that Spark's bitmap_construct_agg makes.
LOT = 32768


def cell_of(key: Column, bits: int = BITS) -> Column:
    """1 to ``bits``: the place of a key."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + F.lit(1)


def bitmap_of(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of the keys in one column."""
    cells = keys.select(cell_of(F.col(key), bits).alias("cell"))
    lots = cells.groupBy(F.bitmap_bucket_number("cell").alias("lot")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    out = np.zeros((-(-bits // LOT), LOT // 8), np.uint8)
    for row in lots.toLocalIterator():
        out[row["lot"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def possibly_in(rows: DataFrame, key: str, keys: DataFrame, most: int = BITS) -> DataFrame:
    """``rows`` without such whose ``key`` is not in the column of that name of ``keys``, a written
    table (some others may stay): what a semi join would keep is kept."""
    bits = max(LOT, min(most, 1 << (FOR_EACH * keys.count()).bit_length()))
    held = rows.sparkSession.sparkContext.broadcast(bitmap_of(keys, key, bits))

    @F.arrow_udf("boolean")
    def is_set(cells: pa.Array) -> pa.Array:
        at = cells.to_numpy(zero_copy_only=False).astype(np.int64) - 1
        return pa.array((held.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return rows.where(is_set(cell_of(F.col(key), bits)))
