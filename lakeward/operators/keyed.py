"""Keep the top row per key.

``keep_latest`` is the one ranking primitive of the engine: duplicate
deliveries (per ``event_id``) and latest state (per ``order_id``) are both
"rank rows of a key by an ordering and keep rank 1".

Plan shape (``strategy="window"``): ``row_number() ... = 1`` is rewritten by
Catalyst into a partial ``WindowGroupLimit`` *before* the shuffle, so each
map task forwards at most one row per key. A key that holds a third of all
rows therefore costs one row per map task on the wire, not a third of the
data in one reducer.

``strategy="aggregate"`` expresses the same thing as ``max_by`` over a struct
ordering key, which Catalyst plans as partial/final sort aggregation (same
pre-shuffle reduction, with a sort on either side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.desc_nulls_last()


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    *,
    strategy: str = "window",
    rank_col: str = "_rank",
) -> DataFrame:
    """Rows of ``df`` that rank first within ``keys``.

    ``order_desc`` lists the ordering columns, highest first, NULLs last. Pass
    enough columns to make the order total (or at least to make ties
    indistinguishable in the output); the result is then deterministic.
    """
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_desc])
        return (
            df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) == 1)
            .drop(rank_col)
        )
    if strategy == "aggregate":
        cols = df.columns
        # Struct comparison orders NULL below any value, so max == "desc nulls last".
        ordering = F.struct(*[F.col(c) for c in order_desc])
        row = F.struct(*[F.col(c) for c in cols])
        return (
            df.groupBy(*keys)
            .agg(F.max_by(row, ordering).alias("_top"))
            .select("_top.*")
            .select(*cols)
        )
    raise ValueError(f"unknown strategy {strategy!r}")


def rank_column(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    rank_col: str,
    upto: int = 1,
) -> DataFrame:
    """``df`` plus its ``row_number`` within ``keys`` (star plus computed column), for the
    first ``upto`` rows of a key: no task ever holds all rows of a hot key."""
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_desc])
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= upto)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))
