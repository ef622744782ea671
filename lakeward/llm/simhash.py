"""SimHash near-duplicates by deletion-variant signatures (operator 10).

A fingerprint has 64 bits, each the majority over the XXH64 of the word shingles.
Two fingerprints that differ in at most three bits, cut into two segments of 32,
differ by at most one bit in one of the segments. So each segment is indexed in
32 variants, each with one bit blanked: such a pair agrees in the variant of the
differing bit, and a pair with an equal segment in variant 0. Fingerprints meet
by an equality join on (segment, blanked bit, rest) and the join itself counts
the differing bits, so it puts out true links only.

A variant that more than ``HOT`` fingerprints share is joined on a finer key as
well: the other segment then differs in at most three of its four bytes, so one
byte is equal, and each byte in turn joins the key. No link is lost and no
variant is capped. Equal fingerprints are one node.

Defined cases: a null text counts as empty; a text without words has fingerprint
zero and links like any other; fewer words than a shingle give one shingle;
repeated rows and ids are rows of their own with the same component; a null id is
never the least of a component unless all its ids are null; columns beside id and
text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut, salted_lookup
from lakeward.llm.components import components

SEED = 42
HOT = 64
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text: bytes, width: int) -> list[bytes]:
    """Word shingles of the text, ASCII letters lower-cased, repeats included."""
    words = text.translate(LOWER).split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def fingerprint(text: bytes, width: int = 3) -> int:
    """Unsigned 64-bit fingerprint; a bit is set if over half the hashes set it."""
    grams = shingles(text, width)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), 1 << 16):
        part = grams[at : at + (1 << 16)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(grams)).tobytes(), "big")


def fingerprint_column(text: Column, width: int = 3) -> Column:
    """long: the fingerprint of each text, as a signed number."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        prints = [fingerprint(t or b"", width) for t in texts.cast(pa.binary()).to_pylist()]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return fingerprints(text)


def variants(prints: DataFrame) -> DataFrame:
    """(fp, seg, bit, rest): 64 rows for each fingerprint."""
    segments = F.array(
        F.struct(F.lit(0).alias("seg"), F.shiftrightunsigned("fp", 32).alias("value")),
        F.struct(F.lit(1).alias("seg"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("value")),
    )
    cut_in_two = prints.select("fp", F.inline(segments))
    blanked = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.struct(
        i.alias("bit"), F.col("value").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), i))).alias("rest")))
    # One long holds segment (bit 37), blanked bit (bits 32 to 36) and the rest.
    return cut_in_two.select("fp", "seg", F.inline(blanked)).select(
        "fp", (F.shiftleft(F.col("seg").cast("long"), 37) + F.shiftleft(F.col("bit").cast("long"), 32) + F.col("rest")).alias("variant"))


def links(prints: DataFrame, distance: int = 3, hot: int = HOT) -> DataFrame:
    """(a, b): pairs a < b of distinct fingerprints (column fp) that differ in at most
    ``distance`` bits, which two segments and one blank allow up to 3."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with one blanked bit find at most 3 differing bits")
    spread = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = variants(prints.repartition(spread, "fp"))
    shared = keyed.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(shared.hint("merge"), "variant")
    in_first = F.shiftrightunsigned("variant", 37) == 0
    other = F.when(in_first, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    finer = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: j.cast("long") * 256 + F.call_function(
        "shiftrightunsigned", other, j * 8).bitwiseAND(F.lit(255)))
    fine = F.when(F.col("n") > hot, finer).otherwise(F.array(F.lit(-1).cast("long")))
    index = cut(members.select("fp", "variant", F.explode(fine).alias("fine")), "simhash-index")
    left = index.withColumnRenamed("fp", "a")
    right = index.withColumnRenamed("fp", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance)
    # A pair with an equal segment agrees in all its variants; it counts in that of bit 0.
    blank = F.shiftrightunsigned("variant", 32).bitwiseAND(F.lit(31))
    place = (blank + F.when(in_first, F.lit(32)).otherwise(F.lit(0))).cast("int")
    once = (blank == 0) | (F.call_function("shiftrightunsigned", differ, place).bitwiseAND(F.lit(1)) == 1)
    return left.join(right.hint("merge"), ["variant", "fine"]).where(near & once).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    prints = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprint_column(F.col(text_col), width).alias("fp")), "fingerprints")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), distance))
    placed = nodes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = salted_lookup(placed.select("fp", "root"), least, ["root"], "fp").select("fp", "component_id")
    rows = salted_lookup(prints.withColumn("_row", F.coalesce("doc_id", F.lit(0))), of_print, ["fp"], "_row")
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
