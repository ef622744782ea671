"""Sharding by a hierarchical weighted hash tree (operator 13).

A cluster is a tree: regions hold racks, racks hold shards, shards have weights and
every other node weighs what its children do. A key descends from the root: at each
node, every child draws ln(u) / weight, with u a hash of the child's name and the key
in (0, 1), and the largest draw wins. A child so wins in proportion to its weight, and
since no draw depends on a sibling, a changed weight moves keys only into or out of the
subtrees whose weights change. A descent costs the sum of the fan-outs on its path, not
the number of shards.

``Tree.grown`` adds one shard as a region of its own: no old weight changes, so the
new shard takes rows only into itself (law ``key``). The tree is a literal of the
plan: rows need no shuffle to learn their shards. Slots within a shard come from one range
shuffle of narrow rows (``running``), in the order of doc_id, CRC-32 and size.

Defined cases: a null text has no bytes (size 8, CRC-32 0), like an empty one; a null id is a
key of its own (the empty text) and comes first in its shard; rows that repeat an id
share a shard and get slots of their own; equal texts (groups) aren't kept together, since
the id alone decides; columns beside id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut
from lakeward.llm.running import running

ROOT = "root"
#: Hex digits of SHA-256 that make a draw; 13 are exact in a double.
DIGITS = 13


@dataclass(frozen=True)
class Tree:
    """Weights of shards by their place: {(region, rack, shard): weight > 0}."""

    weights: dict[tuple[int, int, int], float]

    @classmethod
    def regular(cls, regions: int, racks: int, shards: int) -> Tree:
        """Regions of ``racks`` racks of ``shards`` shards of weight 1, shards numbered through."""
        return cls({(r, r * racks + k, (r * racks + k) * shards + s): 1.0 for r in range(regions) for k in range(racks) for s in range(shards)})

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a rack and region of its own."""
        region, rack, shard = (max(at[i] for at in self.weights) + 1 for i in range(3))
        return Tree({**self.weights, (region, rack, shard): weight})

    def children(self) -> dict[str, list[tuple[str, int, float]]]:
        """Node -> (name, number, weight) of its children."""
        out: dict[str, dict[str, list]] = {}
        for (region, rack, shard), weight in sorted(self.weights.items()):
            if not weight > 0:
                raise ValueError(f"the weight of shard {shard} must be above 0")
            above = ROOT
            for name, number in ((f"region{region}", region), (f"rack{rack}", rack), (f"shard{shard}", shard)):
                node = out.setdefault(above, {}).setdefault(name, [name, number, 0.0])
                node[2] += weight
                above = name
        return {node: [tuple(c) for c in below.values()] for node, below in out.items()}


def unit_draw(name: Column, key: Column) -> Column:
    """A number in (0, 1) from the child's name and the key."""
    digits = F.substring(F.sha2(F.concat_ws(":", name, key), 256), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**DIGITS))


def winner(node: Column, children: Column, key: Column) -> Column:
    """struct(draw, number, name) of the child of ``node`` that wins the key."""
    draws = F.transform(F.element_at(children, node), lambda c: F.struct(
        (F.log(unit_draw(c["name"], key)) / c["weight"]).alias("draw"), c["number"].alias("number"), c["name"].alias("name")))
    return F.array_max(draws)


def descend(docs: DataFrame, tree: Tree, key: Column, prefix: str = "") -> DataFrame:
    """``docs`` with the columns region, rack and shard (names after ``prefix``)."""
    below = F.create_map(*[x for node, kids in tree.children().items() for x in (
        F.lit(node), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(i).alias("number"), F.lit(w).alias("weight")) for n, i, w in kids]))])
    out, node = docs, F.lit(ROOT)
    for level in ("region", "rack", "shard"):
        out = out.withColumn(f"_{prefix}{level}", winner(node, below, key))
        node = F.col(f"_{prefix}{level}")["name"]
    return out.select(*docs.columns, *[F.col(f"_{prefix}{level}")["number"].alias(f"{prefix}{level}") for level in ("region", "rack", "shard")])


def sharded(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack), one row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = descend(rows, tree, key)
    placed = descend(placed, tree.grown(), key, "grown_").drop("grown_region", "grown_rack")
    # The number of the row parts rows that are equal in all else, so none of their ranges gets too long.
    table = cut(placed.withColumn("_row", F.monotonically_increasing_id()), "shards")
    slots = running(table, "shard", [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("size"), F.asc("_row")], name="slots")
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("idx").alias("slot"), "grown_shard", "region", "rack")
