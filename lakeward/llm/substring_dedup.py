"""Passages that repeat across documents, by MinHash over paragraphs (operator 9).

Near copies. A paragraph is a line; long lines are cut at sentence starts that a hash of the next
few bytes picks, so a passage that stands inside different lines is cut alike in each, but for its
ends. Paragraphs meet if they agree in a band of their MinHash signature over word shingles. Bands of
``ROWS`` rows keep unlike paragraphs apart, and their number follows from the target recall at the least
similarity. In each bucket all are compared with one leader, the paragraph that shares most buckets with
others (of edited copies that is as a rule the one they were made from), by the exact Jaccard
similarity; those that fail are compared with all others of the bucket. Before any pair meets its
shingles, 256 bits of each paragraph rule out pairs that can't reach the similarity. Verified links
make components. Of each component the document of least id keeps its paragraphs.

Equal passages are found wherever they begin and end. Of every ``span_words / 2`` word grams of
that length in a row, the one of least hash is an anchor, so each run of ``span_words`` words that two documents share
holds a common anchor, and the grams of anchors in a row leave no gap. First the anchors' hashes are
counted, 8 bytes each; only those of several documents make rows. Anchors in a row that all repeat a
smaller document make a run, and only at the two ends of a run each gram is looked up by itself, among the
grams beside the same anchor in other documents.

Paragraphs and runs that repeat a document of smaller id and touch or overlap make a span,
whichever documents they repeat; it is reported with the least of them if it has
``span_words`` words or more.

Equal paragraphs are one node, and each task sends a paragraph's bands at most once for every ``HELD``
paragraphs it has read, so a passage that a third of all documents hold makes no large bucket. Tables that a
later one replaces are deleted.

Defined cases: null and empty texts have no paragraphs; a paragraph shorter than a shingle
is one shingle; repeats inside one document alone aren't reported; rows that
repeat an id count as one document, and equal ones among them as one row; each row
of null id is a document of its own that keeps its paragraphs only if no other does; columns beside id and text are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.bitsets import possibly_in
from lakeward.llm.common import cut, drop_cut, salted_lookup
from lakeward.llm.components import components

WIDTH, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.95, 4
#: A sentence start is a cut if its hash is divisible by this.
CUT_EVERY, CUT_BYTES = 8, 12
SPAN_WORDS = 24
#: Paragraphs after which a task forgets which ones it has sent.
HELD = 200_000
#: Fewer shingles have no unequal neighbour: 4 of 5 shingles in common is the least that reaches the similarity.
LEAST_SHINGLES = math.ceil(SIMILARITY / (1 - SIMILARITY) - 1e-9)
SEED = 42
#: Leaders of a bucket, and steps that labels spread over links before the rest is compared.
LEADERS, SPREAD = 6, 4
#: Columns of 64 bits that mark a unit's shingles.
BITS = [f"bits{k}" for k in range(8)]
#: Rows of null id count down from here.
LAST_ID = (1 << 63) - 1

BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - SIMILARITY**ROWS))
SENTENCE = re.compile(r"[.!?][ \t]+(?=\S)|\n")
KEY = "doc_id long, doc long, row long"
UNITS = f"{KEY}, first int, start int, n_chars int, n_words int, h long, bands array<long>"
PIECE = "first int, last int, start int, stop int"
ANCHORS = f"{KEY}, at array<int>, h array<long>"
#: Bytes that part words, as in bytes.split(), a random number for each byte, an odd base and its inverse.
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
BYTE = np.random.default_rng(SEED).integers(0, 1 << 63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 random-looking bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit_ranges(text: str) -> list[tuple[int, int]]:
    """Start and end of the units of a text that hold any word."""
    out, start = [], 0
    for end in SENTENCE.finditer(text):
        at = end.end()
        if end[0] == "\n" or zlib.crc32(text[at : at + CUT_BYTES].encode()) % CUT_EVERY == 0:
            if at > start and not text[start:at].isspace():
                out.append((start, at))
            start = at
    if start < len(text) and not text[start:].isspace():
        out.append((start, len(text)))
    return out


def shingled(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of units, one unit after another, and where each
    unit begins."""
    sizes = np.array([len(w) for w in words])
    codes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for unit in words for w in unit), np.uint64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    grams = np.maximum(sizes - WIDTH + 1, 1)
    begin = np.cumsum(grams) - grams
    at = np.arange(grams.sum()) - np.repeat(begin - first, grams)
    left = np.repeat(first + sizes, grams) - at  # words from here to the unit's end
    padded = np.append(codes, np.zeros(WIDTH, np.uint64))
    gram = np.zeros(len(at), np.uint64)
    for k in range(WIDTH):
        gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + np.where(left > k, padded[at + k], np.uint64(0)))
    return gram, begin


def signatures(words: list[list[bytes]]) -> np.ndarray:
    """Band keys (units x BANDS) of units given as words."""
    gram, begin = shingled(words)
    keys = np.zeros((len(words), BANDS), np.uint64)
    seeds = np.random.default_rng(SEED).integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(words), band, np.uint64)
        for row in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(mixed(gram ^ seeds[band, row]), begin))
        keys[:, band] = key
    return keys.view(np.int64)


def unit_hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), SEED)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, doc, row, text): doc is the id or, for a null id, a number of the row's own;
    row tells different texts of one id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nulls = cut(rows.where("doc_id is null").withColumn("doc", F.lit(LAST_ID) - F.monotonically_increasing_id()), "null-ids")
    both = rows.where("doc_id is not null").withColumn("doc", F.col("doc_id")).unionByName(nulls)
    return both.select("doc_id", "doc", F.xxhash64("text").alias("row"), "text")


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_table(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Of all words of the texts in turn: hash, text, and start and end in code points."""
    parts = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(parts).lower() + b"\n", np.uint8)
    space = SPACE[raw]
    begin = np.flatnonzero(~space & np.r_[True, space[:-1]])
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    total = np.r_[np.uint64(0), np.cumsum(BYTE[raw] * powers(BASE, len(raw)), dtype=np.uint64)]
    code = mixed((total[end] - total[begin]) * powers(INVERSE, len(raw))[begin])
    text = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), begin, "right")
    before = np.cumsum([0, *(len(t) + 1 for t in texts)])[text]
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return code, text, points[begin] - before, points[end] - before


def word_grams(code: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; grams that cross texts are among them."""
    n = max(len(code) - k + 1, 0)
    gram = np.zeros(n, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(BASE) + code[j : j + n]
    return mixed(gram)


def anchors_of(gram: np.ndarray, text: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the least gram (the last of equal ones) of each w grams in a row of one text."""
    n = len(text) - k - w + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = gram[:n].copy(), np.arange(n)
    for j in range(1, w):
        less = gram[j : j + n] <= best
        best[less], at[less] = gram[j : j + n][less], np.flatnonzero(less) + j
    return np.unique(at[text[:n] == text[k + w - 2 :]])


def anchor_table(texts: DataFrame, k: int, w: int) -> DataFrame:
    """ANCHORS: one row for each text that has any, in the order of the text."""

    def rows(batches):
        for batch in batches:
            for lot in range(0, batch.num_rows, 200):
                part = batch.slice(lot, 200)
                code, text, _, _ = word_table([t or "" for t in part.column(3).to_pylist()])
                gram = word_grams(code, k)
                at = anchors_of(gram, text, k, w)
                if not len(at):
                    continue
                own = text[at]
                who, begin = np.unique(own, return_index=True)
                ends = pa.array(np.r_[begin, len(at)].astype(np.int32))
                place = (at - np.searchsorted(text, own)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(who)) for c in range(3)), pa.ListArray.from_arrays(ends, pa.array(place)),
                     pa.ListArray.from_arrays(ends, pa.array(gram[at].view(np.int64)))],
                    names=["doc_id", "doc", "row", "at", "h"])

    return texts.mapInArrow(rows, ANCHORS)


def gram_pieces(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(KEY, PIECE, h, low) of texts with common anchors: their runs, which repeat document
    ``low``, and the grams beside anchors at which some document's run ends. Of the latter
    only those beside the text's own run ends have a place."""

    def rows(batches):
        for batch in batches:
            for lot in range(0, batch.num_rows, 100):
                part = batch.slice(lot, 100)
                code, text, start, stop = word_table([t or "" for t in part.column(3).to_pylist()])
                gram, offset = word_grams(code, k), np.searchsorted(text, np.arange(part.num_rows + 1))
                out = []
                for n, (runs, beside) in enumerate(zip(part.column(4).to_pylist(), part.column(5).to_pylist())):
                    size = offset[n + 1] - offset[n]
                    given, asked = np.zeros(max(size - k + 1, 0), bool), np.zeros(max(size - k + 1, 0), bool)
                    for x in beside or ():
                        if x["before"]:
                            given[max(x["at"] - k + 1, 0) : x["at"]] = True
                        if x["after"]:
                            given[x["at"] + 1 : x["at"] + k] = True
                    for x in runs or ():
                        asked[max(x["from"] - k + 1, 0) : x["from"]] = True
                        asked[x["to"] + 1 : x["to"] + k] = True
                    spots = np.flatnonzero(given | asked)
                    first = np.r_[np.array([x["from"] for x in runs or ()], np.int64), spots]
                    last = np.r_[np.array([x["to"] for x in runs or ()], np.int64), spots] + k
                    low = np.r_[np.array([x["low"] for x in runs or ()], np.int64), np.zeros(len(spots), np.int64)]
                    is_run = np.arange(len(first)) < len(first) - len(spots)
                    placed = np.r_[np.ones(len(first) - len(spots), bool), asked[spots]]
                    h = np.r_[np.zeros(len(first) - len(spots), np.int64), gram[offset[n] + spots].view(np.int64)]
                    out.append((np.full(len(first), n), first, last, start[offset[n] + first], stop[offset[n] + last - 1], h, low, is_run, placed))
                who, *place, h, low, is_run, placed = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(who)) for c in range(3)), *(pa.array(x.astype(np.int32), mask=~placed) for x in place),
                     pa.array(h, mask=is_run), pa.array(low, mask=~is_run)],
                    names=["doc_id", "doc", "row", "first", "last", "start", "stop", "h", "low"])

    met = possibly_in(texts, "doc", wanted).join(wanted.hint("merge"), ["doc", "row"])
    return met.select("doc_id", "doc", "row", "text", "runs", "beside").mapInArrow(rows, f"{KEY}, {PIECE}, h long, low long")


def equal_pieces(texts: DataFrame, span_words: int) -> DataFrame:
    """(KEY, PIECE, keep): word ranges that stand in a document of smaller id too; every
    run of ``span_words`` that does is covered from end to end."""
    k = (span_words + 1) // 2
    # Anchors are at most w <= k words apart, so the grams of neighbours touch.
    table = cut(anchor_table(texts, k, min(k, span_words - k + 1)), "anchors")
    common = cut(table.select("doc", F.explode("h").alias("h")).groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
                 .where("low != high").drop("high"), "common-anchors")
    each = table.select("doc", "row", F.posexplode(F.arrays_zip("at", "h")).alias("nth", "x")).select("doc", "row", "nth", "x.at", "x.h")
    met = cut(possibly_in(each, "h", common).join(common.hint("merge"), "h"), "met-anchors")
    drop_cut(table)
    # A run: anchors in a row, each of which stands in a smaller document.
    text = Window.partitionBy("doc", "row").orderBy("nth")
    own = met.where("low < doc")
    apart = lambda c: F.coalesce(F.abs(c - F.col("nth")) > 1, F.lit(True))
    ends = own.withColumn("opens", apart(F.lag("nth").over(text))).withColumn("closes", apart(F.lead("nth").over(text)))
    ends = cut(ends.withColumn("run", F.sum(F.col("opens").cast("int")).over(text)), "anchors-in-runs")
    runs = ends.groupBy("doc", "row", "run").agg(F.min("at").alias("from"), F.max("at").alias("to"), F.min("low").alias("low"))
    # What a run's end asks for only documents of smaller ids can give.
    last = lambda c: F.max(F.when(F.col(c), F.col("doc"))).alias(c)
    asked = ends.where("opens or closes").groupBy("h").agg(last("opens"), last("closes"))
    gives = lambda c: F.coalesce(F.col("doc") < F.col(c), F.lit(False))
    given = met.select("h", "doc", "row", "at").join(asked.hint("merge"), "h").select(
        "doc", "row", "at", gives("opens").alias("before"), gives("closes").alias("after")).where("before or after")
    beside = given.groupBy("doc", "row").agg(F.collect_list(F.struct("at", "before", "after")).alias("beside"))
    own_runs = runs.groupBy("doc", "row").agg(F.collect_list(F.struct("from", "to", "low")).alias("runs"))
    wanted = cut(beside.join(own_runs.hint("merge"), ["doc", "row"], "full").select("doc", "row", "runs", "beside"), "wanted")
    drop_cut(met)
    drop_cut(ends)
    pieces = cut(gram_pieces(texts, wanted, k), "pieces")
    drop_cut(wanted)
    grams = pieces.where("low is null")
    least = grams.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low != high").drop("high")
    more = grams.where("first is not null").drop("low").join(least.hint("merge"), "h").where("low < doc")
    return pieces.where("low is not null").drop("h").unionByName(more.drop("h")).withColumnRenamed("low", "keep")


def paragraph_units(texts: DataFrame) -> DataFrame:
    """One row per paragraph: where it is, its hash and its band keys; these are null for one the
    task has lately read and for one too short to have an unequal neighbour."""

    def units(batches):
        sent: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                where, words, owner = [], [], []
                for row, text in enumerate(part.column(3).to_pylist()):
                    first = upto = 0
                    for start, end in unit_ranges(text or ""):
                        own = text[start:end].encode().lower().split()
                        first, upto = first + len(text[upto:start].encode().split()), end
                        if own:
                            where.append((first, start, end - start, len(own)))
                            first += len(own)
                            words.append(own)
                            owner.append(row)
                if not words:
                    continue
                hashes = list(map(unit_hash, words))
                fresh = [n for n, h in enumerate(hashes) if len(words[n]) >= WIDTH + LEAST_SHINGLES - 1 and not (h in sent or sent.add(h))]
                if len(sent) > HELD:
                    sent.clear()
                keys = signatures([words[n] for n in fresh]) if fresh else np.zeros((0, BANDS), np.int64)
                place = np.array(where, np.int32)
                # The list of a paragraph without bands is empty and null.
                has = np.zeros(len(words), bool)
                has[fresh] = True
                ends = np.r_[0, np.cumsum(has * BANDS)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(owner)) for c in range(3)), *(pa.array(place[:, k]) for k in range(4)),
                     pa.array(np.array(hashes, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()), mask=pa.array(~has))],
                    names=["doc_id", "doc", "row", "first", "start", "n_chars", "n_words", "h", "bands"])

    return texts.mapInArrow(units, UNITS)


def shared_buckets(units: DataFrame) -> DataFrame:
    """(key, h) of the buckets with two unequal paragraphs or more. Buckets come sorted, so a task holds a
    batch at a time."""

    def runs(batches):
        held = None  # the last row, and whether it went out
        for batch in batches:
            if not batch.num_rows:
                continue
            key, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if held is not None:
                key, h = np.r_[held[0], key], np.r_[held[1], h]
            same_key = np.r_[False, key[1:] == key[:-1]]
            repeated = np.r_[False, (h[1:] == h[:-1]) & same_key[1:]]
            key, h = key[~repeated], h[~repeated]
            same_key = np.r_[False, key[1:] == key[:-1]]
            out = same_key.copy()
            out[:-1] |= same_key[1:]  # the first of its bucket, once there is a second
            if held is not None and held[2]:
                out[0] = False
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(h[out])], names=["key", "h"])
            went = bool(out[-1]) or (held is not None and len(key) == 1 and held[2])
            held = (key[-1], h[-1], went)

    rows = units.where("bands is not null").select("h", F.explode("bands").alias("key"))
    return rows.select("key", "h").repartition("key").sortWithinPartitions("key", "h").mapInArrow(runs, "key long, h long")


def led(buckets: DataFrame) -> DataFrame:
    """(a, b): each paragraph with the leaders of its buckets."""
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n"))
    degree = buckets.join(sizes.hint("merge"), "key").groupBy("h").agg(F.sum("n").alias("met"))
    drawn = [F.max_by("h", F.xxhash64("key", "h", F.lit(r))) for r in range(1, LEADERS)]
    leaders = buckets.join(degree.hint("merge"), "h").groupBy("key").agg(F.array_distinct(F.array(F.max_by("h", F.struct("met", "h")), *drawn)).alias("leaders"))
    pairs = buckets.join(leaders.hint("merge"), "key").select("h", F.explode("leaders").alias("l")).where("h != l")
    return pairs.select(F.least("h", "l").alias("a"), F.greatest("h", "l").alias("b")).distinct()


def may_be_near() -> Column:
    """A condition that every pair (a, b) of sufficient similarity J meets: of the shingles of
    both sides together it has at most (1 - J) / (1 + J) on one side only, each of which changes one bit."""
    changed = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in BITS), F.lit(0))
    return changed <= (1 - SIMILARITY) / (1 + SIMILARITY) * (F.col("a_grams") + F.col("b_grams")) + 1e-9


def marks_of(sets: DataFrame, side: str) -> DataFrame:
    """The bits and shingle numbers, named for one side of pairs."""
    return sets.select(F.col("h").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in BITS), F.size("grams").alias(f"{side}_grams"))


def near_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bits don't rule out."""
    both = pairs.join(marks_of(sets, "a").hint("merge"), "a").join(marks_of(sets, "b").hint("merge"), "b")
    return both.where(may_be_near()).select("a", "b")


def labels_of(links: DataFrame, steps: int = SPREAD) -> DataFrame:
    """(h, label) of linked paragraphs: the least hash within some steps. Equal labels are linked."""
    ways = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    out = ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
    for _ in range(steps - 1):
        beside = ways.join(out.withColumnRenamed("a", "b").hint("merge"), "b").groupBy("a").agg(F.min("label").alias("near"))
        out = out.join(beside.hint("merge"), "a").select("a", F.least("label", "near").alias("label"))
    return out.withColumnRenamed("a", "h")


def shingle_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, BITS, grams) of the units in (doc, hs): from one document that holds each, its
    shingle hashes, and 512 bits each of which tells whether an odd number of them fall on it."""

    def sets(batches):
        schema = pa.schema([("h", pa.int64()), *((c, pa.int64()) for c in BITS), ("grams", pa.list_(pa.int64()))])
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part, words, own = batch.slice(at, 100), [], []
                for text, hs in zip(*(c.to_pylist() for c in part.columns)):
                    asked = set(hs)
                    for start, end in unit_ranges(text or ""):
                        unit = text[start:end].encode().lower().split()
                        h = unit_hash(unit) if unit else 0
                        h -= (h >> 63) << 64
                        if unit and h in asked:
                            words.append(unit)
                            own.append(h)
                if words:
                    gram, begin = shingled(words)
                    grams = [np.unique(g) for g in np.split(gram, begin[1:])]
                    first = np.cumsum([0, *map(len, grams[:-1])])
                    gram = np.concatenate(grams)
                    grams = [g.view(np.int64) for g in grams]
                    bit, column = np.uint64(1) << (gram >> np.uint64(58)), gram >> np.uint64(52) & np.uint64(len(BITS) - 1)
                    bits = [np.bitwise_xor.reduceat(np.where(column == k, bit, np.uint64(0)), first).view(np.int64) for k in range(len(BITS))]
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *map(pa.array, bits), pa.array(grams, pa.list_(pa.int64()))], schema=schema)

    found = possibly_in(texts.select("doc", "text"), "doc", wanted).join(wanted.hint("merge"), "doc").select("text", "hs")
    return found.mapInArrow(sets, f"h long, {', '.join(f'{c} long' for c in BITS)}, grams array<long>").dropDuplicates(["h"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose units have a Jaccard similarity of SIMILARITY or more."""
    a = sets.select(F.col("h").alias("a"), F.col("grams").alias("_a"))
    b = sets.select(F.col("h").alias("b"), F.col("grams").alias("_b"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    common = F.size(F.array_intersect("_a", "_b"))
    return both.where(common >= SIMILARITY * (F.size("_a") + F.size("_b") - common) - 1e-9).select("a", "b")


def unit_links(texts: DataFrame, units: DataFrame, of_unit: DataFrame) -> DataFrame:
    """(a, b): verified links between unequal paragraphs that share a band."""
    buckets = cut(shared_buckets(units), "buckets")
    wanted = of_unit.join(buckets.select("h").distinct().hint("merge"), "h").groupBy(F.col("low").alias("doc")).agg(F.collect_list("h").alias("hs"))
    sets = cut(shingle_sets(texts, cut(wanted, "wanted-paragraphs")), "shingles")
    good = cut(verified(near_pairs(led(buckets), sets), sets), "spokes")
    # Those that lack their bucket's most frequent label are held against the others of another label.
    label = cut(labels_of(good), "labels")
    placed = buckets.join(marks_of(sets, "h").hint("merge"), "h").join(label.hint("merge"), "h", "left").withColumn("label", F.coalesce("label", "h"))
    members = cut(placed, "members")
    counts = members.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    side = lambda rows, s: rows.select("key", *(F.col(c).alias(c.replace("h", s, 1) if c.startswith("h") else f"{s}_{c}")
                                                for c in ["h", "label", *(f"h_{c}" for c in (*BITS, "grams"))]))
    alone = side(members.join(main.hint("merge"), "key").where("label != main"), "a")
    met = alone.join(side(members, "b").hint("merge"), "key").where((F.col("a_label") != F.col("b_label")) & may_be_near())
    more = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut(good.unionAll(verified(more, sets)), "paragraph-links")
    for old in (buckets, sets, label, members, good):
        drop_cut(old)
    return links


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span_words: int = SPAN_WORDS) -> DataFrame:
    """(doc_id, span_start, span_chars, n_words, keep_doc_id): code points of a text
    that repeat a document of smaller id."""
    texts = keyed(docs, id_col, text_col)
    units = cut(paragraph_units(texts), "units")
    of_unit = cut(units.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")), "unit-documents")
    roots = components(unit_links(texts, units, of_unit)).withColumnRenamed("node", "h")
    placed = of_unit.join(roots.hint("merge"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    across = placed.groupBy("root").agg(F.min("low").alias("keep"), F.max("high").alias("last")).where("keep != last")
    repeated = salted_lookup(placed.select("h", "root"), across.select("root", "keep"), ["root"], "h", how="inner").select("h", "keep")
    again = salted_lookup(units.drop("bands"), repeated, ["h"], "doc", how="inner").where("doc != keep").select(
        "doc_id", "doc", "row", "first", (F.col("first") + F.col("n_words")).alias("last"), "start", (F.col("start") + F.col("n_chars")).alias("stop"), "keep")
    pieces = again.unionByName(equal_pieces(texts, span_words))
    # Pieces that touch or overlap make a span, whichever documents they repeat.
    row = Window.partitionBy("doc", "row").orderBy("first", "last", "stop", "start", "keep")
    met = F.coalesce(F.col("first") > F.max("last").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = pieces.withColumn("_fresh", met.cast("int")).withColumn("_run", F.sum("_fresh").over(row.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "doc_id", "doc", "row", "_run").agg(F.min("start").alias("span_start"), F.max("stop").alias("_end"),
                                            (F.max("last") - F.min("first")).alias("n_words"), F.min("keep").alias("keep"))
    null = texts.where("doc_id is null").select(F.col("doc").alias("keep"), F.lit(True).alias("_null"))
    told = salted_lookup(spans.where(F.col("n_words") >= span_words), null, ["keep"], "doc")
    return told.select("doc_id", "span_start", (F.col("_end") - F.col("span_start")).alias("span_chars"), F.col("n_words").cast("long").alias("n_words"),
                       F.when(F.col("_null").isNull(), F.col("keep")).alias("keep_doc_id"))
