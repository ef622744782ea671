"""Importance resampling towards a target (operator 11).

Features are runs of one to three words, hashed into buckets by CRC-32; the gain of a
bucket is the log ratio of its smoothed share in the target texts and in all documents,
a document weighs the sum of its features' gains, and noise of the Gumbel kind drawn from
its id makes the highest scores a sample in proportion to the weights' exponentials.

CRC-32 is affine over XOR, so the CRC of any span is the XOR of what each byte
contributes at its distance from the span's end, and a constant of the span's length.
``POSITION`` holds the contribution of each byte at each of ``BLOCK`` distances. The
spans of a text (a word is in six of them) are laid out end to end, looked up at once and folded
by ``bitwise_xor.reduceat``. A longer span is cut into blocks from its end; the XOR of each
block moves on by the blocks behind it, one linear map for each bit of their number, and a
second ``reduceat`` joins them. Texts are read in pieces that end between words, layouts in
slices, so memory depends on the longest word's bytes once, not on its spans.

The texts are hashed once: the buckets, two bytes a feature, are written piece by piece, and
read for the counts (each task sends one row for each bucket it met) and for the weights. No
text is shuffled; only texts of several pieces meet in a group. The gains are a fixed 80 kB.
Ranks come from a range sort of the rows that can be drawn.

Defined cases: a null text has no words; a null id hashes as the empty text and ranks behind
equal scores of other ids; rows that repeat an id are drawn each on its own;
columns beside id and text are ignored; no documents give an empty result, no target texts a
T of 0.
"""

from __future__ import annotations

import math
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut
from lakeward.llm.running import running

BUCKETS = 10_000
#: Longest run of words that makes a feature.
RUN = 3
#: Documents of fewer words are never drawn.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Distances from the end that the table covers.
BLOCK = 64
#: Bytes of text in a piece, and of spans in one layout.
PIECE = 1 << 18
LAYOUT = 1 << 18

#: Pieces in one Arrow batch that leaves a task.
BATCH = 256
NAMES = ["_row", "doc_id", "alone", "n_words", "n_features", "found"]
TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
NOTHING = (0, np.zeros(0, np.uint32))

#: a-z for A-Z; blanks for all that is no letter, digit or part of a character beyond ASCII.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def byte_table() -> np.ndarray:
    """What one byte contributes to a CRC-32 when nothing follows it."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


def after_zero(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The contribution ``crc`` once a byte more follows."""
    return table[crc & 255] ^ crc >> 8


def position_table(block: int = BLOCK) -> np.ndarray:
    """[distance from the end * 256 + byte] -> contribution."""
    table = byte_table()
    rows = [table]
    for _ in range(block - 1):
        rows.append(after_zero(rows[-1], table))
    return np.concatenate(rows)


def shift_maps(block: int, levels: int) -> list[np.ndarray]:
    """For each level j four tables of 256, one for each byte of a contribution: their
    XOR is the contribution once ``block << j`` bytes more follow."""
    table = byte_table()
    basis = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)
    for _ in range(block):
        basis = after_zero(basis, table)
    bits = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(bool)
    maps = []
    for _ in range(levels):
        maps.append(np.stack([np.bitwise_xor.reduce(np.where(bits, basis[8 * i : 8 * i + 8], np.uint32(0)), axis=1) for i in range(4)]))
        basis = moved(basis, maps[-1])
    return maps


def moved(crc: np.ndarray, maps: np.ndarray) -> np.ndarray:
    return maps[0][crc & 255] ^ maps[1][crc >> 8 & 255] ^ maps[2][crc >> 16 & 255] ^ maps[3][crc >> 24]


POSITION = position_table()
#: Enough for spans of 2 GB, the longest text there is.
SHIFTS = shift_maps(BLOCK, 26)


#: The CRC-32 of n zero bytes for n below this many: what the length alone adds.
SHORT = 1 << 12
LENGTH = np.array([zlib.crc32(bytes(n)) for n in range(SHORT)], np.uint32)


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of so many zero bytes, for any length."""
    if int(lengths.max()) < SHORT:
        return LENGTH.take(lengths)
    # The register starts as ones and moves on like a contribution; the last XOR stays apart.
    blocks, state = lengths // BLOCK, LENGTH.take(lengths % BLOCK) ^ np.uint32(0xFFFFFFFF)
    for j, maps in enumerate(SHIFTS):
        far = np.flatnonzero(blocks >> j & 1)
        state[far] = moved(state[far], maps)
    return state ^ np.uint32(0xFFFFFFFF)


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each span data[start:end], none of them empty."""
    lengths = ends - starts
    n_blocks = -(-lengths // BLOCK)
    first = np.cumsum(n_blocks) - n_blocks
    if len(starts) == int(n_blocks.sum()):
        span, behind, stop, size = None, np.zeros(len(starts), np.int32), ends, lengths
    else:
        span = np.repeat(np.arange(len(starts)), n_blocks)
        behind = np.arange(len(span)) - first[span]  # blocks between this one and the end
        stop = ends[span] - behind * BLOCK
        size = np.minimum(BLOCK, stop - starts[span])
    folded = np.empty(len(stop), np.uint32)
    filled = np.cumsum(size)
    at = 0
    while at < len(stop):
        to = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + LAYOUT, "right")))
        n = size[at:to]
        offset = np.cumsum(n) - n
        # Distance 0 is the last byte of the block.
        place = np.arange(int(offset[-1] + n[-1]), dtype=np.int32)
        distance = np.repeat((offset + n - 1).astype(np.int32), n) - place
        value = data.take(place + np.repeat((stop[at:to] - n - offset).astype(np.int32), n))
        folded[at:to] = np.bitwise_xor.reduceat(POSITION.take(distance << 8 | value), offset)
        at = to
    for j, maps in enumerate(SHIFTS):
        if not (behind >> j).any():
            break
        far = np.flatnonzero(behind >> j & 1)
        folded[far] = moved(folded[far], maps)
    return (folded if span is None else np.bitwise_xor.reduceat(folded, first)) ^ length_constants(lengths)


def pieces(text: bytes, size: int = PIECE):
    """The text folded, in pieces of about ``size`` bytes that end between words."""
    at = 0
    while at < len(text):
        to = at + size
        piece = text[at:to].translate(FOLD)
        while to < len(text) and piece[-1] != 32:
            more = text[to : to + size].translate(FOLD)
            gap = more.find(b" ")
            piece += more if gap < 0 else more[: gap + 1]
            to += len(more) if gap < 0 else gap + 1
        yield piece
        at = to


def feature_buckets(text: bytes, run: int = RUN, buckets: int = BUCKETS):
    """(words, buckets of the features) for each piece of the text."""
    kept: list[bytes] = []
    for piece in pieces(text):
        words = piece.split()
        if not words:
            continue
        n_old, line = len(kept), kept + words
        data = np.frombuffer(b" ".join(line), np.uint8)
        sizes = np.fromiter(map(len, line), np.int64, len(line))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        lo, hi = [], []
        for n in range(1, run + 1):
            # Runs that end in a word of this piece.
            last = np.arange(max(n - 1, n_old), len(line))
            lo.append(starts[last - n + 1])
            hi.append(ends[last])
        yield len(words), span_crcs(data, np.concatenate(lo), np.concatenate(hi)) % np.uint32(buckets)
        kept = line[max(0, len(line) - run + 1) :] if run > 1 else []


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, alone, n_words, n_features, found): one row per piece of a text; found
    holds the buckets as little-endian uint16, alone tells that the piece is the whole text."""

    def rows_of(batch):
        for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            text = text.as_py() or b""
            alone = len(text) <= PIECE
            found = feature_buckets(text)
            # A text without words has a row too.
            for n, hashed in [next(found, NOTHING)] if alone else chain([NOTHING], found):
                yield row, doc, alone, n, len(hashed), hashed.astype("<u2").tobytes()

    def feature(batches):
        for batch in batches:
            rows = rows_of(batch)
            while held := list(islice(rows, BATCH)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), TYPES)], names=NAMES)

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), text_col)
    return rows.mapInArrow(feature, ", ".join(f"{n} {t}" for n, t in zip(NAMES, ("long", "long", "boolean", "long", "long", "binary"))))


def bucket_counts(pieces: DataFrame) -> DataFrame:
    """(bucket, n): features of all texts. Each task sends at most one row for each bucket."""

    def count(batches):
        seen = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for found in batch.column(0):
                seen += np.bincount(np.frombuffer(found.as_py(), "<u2"), minlength=BUCKETS)
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(seen[met])], names=["bucket", "n"])

    return pieces.select("found").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gain_table(source: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """The gain of each bucket from the counts of both sides."""
    n_source, n_target = float(sum(source.values())), float(sum(target.values()))
    return np.array([math.floor(1000.0 * math.log((target.get(b, 0) + 1.0) * (n_source + BUCKETS) / ((source.get(b, 0) + 1.0) * (n_target + BUCKETS))))
                     for b in range(BUCKETS)], np.int64)


def weighed(pieces: DataFrame, gains: np.ndarray) -> DataFrame:
    """(_row, doc_id, n_words, n_features, weight), one row per document."""

    @F.arrow_udf("long")
    def weight(found: pa.Array) -> pa.Array:
        return pa.array([int(gains[np.frombuffer(x.as_py(), "<u2")].sum()) for x in found], pa.int64())

    rows = pieces.select("_row", "doc_id", "alone", "n_words", "n_features", weight("found").alias("weight"))
    sums = [F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")]
    long_texts = rows.where(~F.col("alone")).groupBy("_row", "doc_id").agg(*sums)
    return rows.where("alone").drop("alone").unionAll(long_texts)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words), one row per document; rank is
    null for those not drawn."""
    pieces_of = cut(featured(docs, id_col, text_col), "features")
    source = {r["bucket"]: r["n"] for r in bucket_counts(pieces_of).collect()}  # at most BUCKETS rows
    wanted = {r["bucket"]: r["n"] for r in bucket_counts(featured(target.withColumn("_none", F.lit(0)), "_none")).collect()}
    weights = weighed(pieces_of, gain_table(source, wanted))
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = cut(weights.withColumn("score", F.col("weight") + noise), "weights")
    long_enough = F.col("n_words") >= LEAST_WORDS
    n = rows.where(long_enough).count() * percent // 100
    # A bound that at least n scores reach, from one pass: only rows above it are sorted.
    low = rows.where(long_enough).agg(F.percentile_approx("score", max(0.0, 1 - percent / 100 - 0.01), 10_000).alias("low")).first()["low"]
    hopeful = long_enough & (F.col("score") >= F.lit(low if low is not None else 0))
    if rows.where(hopeful).count() < n:
        hopeful = long_enough
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    ranked = running(rows.where(hopeful).withColumn("_all", F.lit(0).cast("long")), "_all", order, name="ranks")
    drawn = ranked.withColumn("rank", F.when(F.col("idx") < n, F.col("idx") + 1))
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    return drawn.select(*columns).unionAll(rows.where(~hopeful).withColumn("rank", F.lit(None).cast("long")).select(*columns))
