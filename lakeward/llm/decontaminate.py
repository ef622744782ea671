"""Benchmark passages in documents (operator 5).

A document leaks an item if some run of its words has a word edit distance of at
most ``RATE`` times the item's words to the item. Words are compared lower-cased
and without ASCII punctuation.

1. Spots. By the q-gram lemma such a run shares at least n - q + 1 - q * e word
   q-grams with its item of n words at e edits, all within n + e words. Start
   positions that break this can't pass the verification and are not embedded.
2. CGK embedding. At every other start an item-sized window is embedded: a
   pointer walks the words, writing the word under it at each step, and moves on
   or stays as a random bit of (step, word) says. Words edited away let the walk
   fall into step again, so a small edit distance gives a small Hamming distance.
3. Bit sampling. Each repetition walks with its own bits and samples ``SAMPLED``
   places; windows and items that agree in them are candidates. The number of
   repetitions follows from the collision rate at the greatest allowed distance,
   measured on edited copies of all items of about a length, and the target recall.
   Items whose length doesn't reach it are candidates at all their spots.
4. Verification. A bit-parallel edit distance over the words around the
   candidates decides.

Items come to the driver in blocks of at most ``BLOCK_BYTES`` of text and each
block is one pass over the documents, so the index in a task is bounded however
large the benchmark is.

Defined cases: null and empty texts leak nothing; an item without words matches
nothing; items of up to four words must appear unchanged; repeated items and rows
give a result each; null ids are carried along; other columns are ignored; an
empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits allowed for each word of an item: a similarity of 0.8 or more.
RATE = 0.2
SAMPLED, RECALL, SEED = 2, 0.97, 11
#: Repetitions drawn together, draws before a length is verified at all spots, and
#: edited copies that recall is measured on at least.
DRAWN, DRAWS, COPIES = 48, 8, 64
BLOCK_BYTES = 8 << 20
#: Words that a task looks at together, and windows that it embeds together.
WORDS_AT_ONCE, STARTS_AT_ONCE = 400_000, 4096

PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)
FOUND = "array<struct<item:int,distance:int,start:int>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PUNCTUATION).split()


def codes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """64 random-looking bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def edits(n: int, rate: float = RATE) -> int:
    return math.floor(rate * n + 1e-9)


def least_distance(pattern: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """Least edit distance of the pattern to any run of the text's words, and where
    the first such run ends; bit-parallel over the pattern."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[bytes, int] = defaultdict(int)
    for i, word in enumerate(pattern):
        at[word] |= 1 << i
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, word in enumerate(text):
        eq = at.get(word, 0)
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(across | plus) & full)
        low = plus & across
        score += bool(up & top) - bool(low & top)
        up, low = (up << 1) & full, (low << 1) & full
        plus, minus = low | (~(down | up) & full), up & down
        if score < best:
            best, end = score, j + 1
    return best, end


class Size:
    """Items of about equal length, with the tables that find them."""

    def __init__(self, items: list[int], words: list[list[bytes]], rng: np.random.Generator, rate: float):
        lengths = [len(words[i]) for i in items]
        self.items, self.rate = items, rate
        self.least, self.most = min(lengths), max(lengths)
        self.gram = min(3, min(-(-(n - edits(n, rate)) // (edits(n, rate) + 1)) for n in lengths))
        self.shared = max(1, min(n - self.gram + 1 - self.gram * edits(n, rate) for n in lengths))
        self.span = self.most + edits(self.most, rate)
        self.steps = max(1, 3 * self.least // 2)
        self.places, self.bits = np.zeros((0, min(SAMPLED, self.steps)), np.int64), np.zeros((0, self.steps // 64 + 1), np.uint64)
        self.keys, self.owners = [], []
        self.tables = self._enough([codes_of(words[i]) for i in items], rng)

    def _draw(self, rng: np.random.Generator) -> None:
        """More repetitions."""
        places = np.sort(np.stack([rng.choice(self.steps, self.places.shape[1], replace=False) for _ in range(DRAWN)]), axis=1)
        self.places = np.concatenate([self.places, places])
        self.bits = np.concatenate([self.bits, rng.integers(0, 1 << 63, (DRAWN, self.bits.shape[1]), dtype=np.uint64)])

    def _lined(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The codes one after another, each with blanks that a walk can't leave, and their starts."""
        gap = np.zeros(self.steps + 1, np.uint64)
        starts = np.cumsum([0, *(len(c) + len(gap) for c in codes[:-1])])
        return np.concatenate([x for c in codes for x in (c, gap)]), starts

    def key(self, table: int, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sampled places of the embedding of the window at each start, as one number."""
        padded = np.append(codes, np.uint64(0))
        bits = [mixed(padded ^ b) for b in self.bits[table]]
        pointer, out = starts.astype(np.int64), np.zeros(len(starts), np.uint64)
        places = set(self.places[table].tolist())
        last = int(self.places[table][-1])
        for step in range(last + 1):
            here = np.minimum(pointer, len(codes))
            if step in places:
                out = mixed(out * np.uint64(3) + padded[here])
            pointer = pointer + ((bits[step >> 6][here] >> np.uint64(step & 63)) & np.uint64(1)).astype(np.int64)
        return out

    def _enough(self, codes: list[np.ndarray], rng: np.random.Generator) -> int | None:
        """Repetitions that reach the target recall at the greatest distance over all
        items, or None if none of the draws does."""
        copies, times = [], max(2, -(-COPIES // len(codes)))
        for code in codes:
            for _ in range(times):
                copy = code.tolist()
                for kind in rng.integers(0, 3, edits(len(code), self.rate)):
                    where = int(rng.integers(0, len(copy)))
                    if kind != 1:
                        copy.insert(where, int(rng.integers(0, 1 << 63)))
                    if kind != 0 and len(copy) > 1:
                        del copy[min(where + (kind == 2), len(copy) - 1)]
                copies.append(np.array(copy, np.uint64))
        lined, edited, found = self._lined(codes), self._lined(copies), np.zeros(len(copies), bool)
        for t in range(DRAWN * DRAWS):
            if t == len(self.places):
                self._draw(rng)
            keys = self.key(t, *lined)
            found |= self.key(t, *edited) == np.repeat(keys, times)
            order = np.argsort(keys, kind="stable")
            self.keys.append(keys[order])
            self.owners.append(np.array(self.items)[order])
            if found.mean() >= RECALL:
                return t + 1
        return None

    def candidates(self, codes: np.ndarray, first: int, last: int) -> dict[int, tuple[int, int]]:
        """Items that collide with a window starting in [first, last]: first and last such start."""
        if self.tables is None:
            return dict.fromkeys(self.items, (first, last))
        out: dict[int, tuple[int, int]] = {}
        for at in range(first, last + 1, STARTS_AT_ONCE):
            starts = np.arange(at, min(last + 1, at + STARTS_AT_ONCE))
            for t in range(self.tables):
                keys = self.key(t, codes, starts)
                left, right = np.searchsorted(self.keys[t], keys, "left"), np.searchsorted(self.keys[t], keys, "right")
                for w in np.flatnonzero(right > left):
                    for item in self.owners[t][left[w] : right[w]].tolist():
                        low, high = out.get(item, (starts[w], starts[w]))
                        out[item] = (min(low, starts[w]), max(high, starts[w]))
        return out


class Index:
    """A block of items."""

    def __init__(self, ids: list, texts: list[str | None], rate: float = RATE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.ids, self.rate = ids, rate
        self.words = [words_of(t) for t in texts]
        by_size = defaultdict(list)
        for i, words in enumerate(self.words):
            if words:
                by_size[math.floor(math.log(len(words)) / math.log(1.3)) if len(words) > 4 else -len(words)].append(i)
        self.sizes = [Size(items, self.words, rng, rate) for _, items in sorted(by_size.items())]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for ws in self.words for w in ws}))}
        self.grams = {}
        for q in sorted({s.gram for s in self.sizes}):
            marks: dict[int, int] = defaultdict(int)
            for k, size in enumerate(self.sizes):
                for i in size.items if size.gram == q else []:
                    for code in self._codes(np.array([self.vocabulary[w] for w in self.words[i]], np.int64), q)[1].tolist():
                        marks[code] |= 1 << k
            codes = np.array(sorted(marks), np.int64)
            self.grams[q] = codes, np.array([marks[c] for c in codes.tolist()], np.int64)

    def _codes(self, ids: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next q words are all known, and a number for those words."""
        n = len(ids) - q + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids >= 0
        at = np.flatnonzero(np.logical_and.reduce([known[k : k + n] for k in range(q)]))
        code = ids[at]
        for k in range(1, q):
            code = code * len(self.vocabulary) + ids[at + k]
        return at, code

    def spots(self, ids: np.ndarray, doc_of: np.ndarray):
        """(size, first start, last start) of the ranges that may hold a leak."""
        for q, (codes, marks) in self.grams.items():
            at, code = self._codes(ids, q)
            found = np.searchsorted(codes, code)
            found[found == len(codes)] = 0
            hit = codes[found] == code
            at, mark = at[hit], marks[found[hit]]
            for k, size in enumerate(self.sizes):
                if size.gram != q:
                    continue
                own = at[(mark >> k) & 1 == 1]
                if len(own) < size.shared:
                    continue
                head, tail = own[: len(own) - size.shared + 1], own[size.shared - 1 :]
                near = (tail - head <= size.span - q) & (doc_of[tail] == doc_of[head])
                first, last = tail[near] + q - size.span, head[near]
                if len(first):
                    # Ranges in order of their first start; overlapping ones of a document become one.
                    docs = doc_of[last]
                    new = np.r_[True, (first[1:] > np.maximum.accumulate(last)[:-1] + 1) | (docs[1:] != docs[:-1])]
                    begin = np.flatnonzero(new)
                    for a, b in zip(first[begin], np.maximum.reduceat(last, begin)):
                        yield size, int(doc_of[b]), int(a), int(b)

    def leaks(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text, the items it leaks with the least distance and a start word."""
        out: list[list[dict]] = [[] for _ in texts]
        if not self.sizes:
            return out
        group, n = [], 0
        for d, text in enumerate(texts):
            words = words_of(text)
            group.append((d, words))
            n += len(words)
            if n >= WORDS_AT_ONCE:
                self._leaks(group, out)
                group, n = [], 0
        self._leaks(group, out)
        return out

    def _leaks(self, group: list[tuple[int, list[bytes]]], out: list[list[dict]]) -> None:
        known, ids, begins, at = self.vocabulary.get, [], [], 0
        for _, words in group:
            begins.append(at)
            ids.append(np.fromiter(map(known, words, repeat(-1)), np.int64, len(words)))
            ids.append(np.array([-1]))
            at += len(words) + 1
        if not group:
            return
        doc_of = np.repeat(np.arange(len(group)), [len(words) + 1 for _, words in group])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for size, g, first, last in self.spots(np.concatenate(ids), doc_of):
            words = group[g][1]
            first, last = max(0, first - begins[g]), last - begins[g]
            slack = edits(size.most, size.rate)
            near = words[first : last + size.span + slack]
            for item, (low, high) in size.candidates(codes_of(near), 0, last - first).items():
                pattern = self.words[item]
                allowed = edits(len(pattern), size.rate)
                lead = max(0, int(low) - slack)
                distance, end = least_distance(pattern, near[lead : int(high) + len(pattern) + 2 * slack + 1])
                if distance <= allowed:
                    start = first + lead + max(0, end - len(pattern))
                    best[g, item] = min(best.get((g, item), (distance, start)), (distance, start))
        for (g, item), (distance, start) in sorted(best.items()):
            out[group[g][0]].append({"item": item, "distance": distance, "start": start})


def leaks_column(text: Column, index: Index) -> Column:
    """array<struct<item, distance, start>> of each text; item counts within the block."""

    @F.arrow_udf(FOUND)
    def leaks(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item", pa.int32()), ("distance", pa.int32()), ("start", pa.int32())]))
        return pa.array(index.leaks(texts.to_pylist()), kind)

    return leaks(text)


def blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int = BLOCK_BYTES):
    """Indexes over the items, each over at most ``limit`` bytes of text."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        if ids and size + len(row["t"] or "") > limit:
            yield Index(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"] or "")
    if ids:
        yield Index(ids, texts)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, item_words, start_word): one row for each document
    and item that it leaks, with the least distance found."""
    out = None
    for index in blocks(benchmark, item_col, item_text):
        names = docs.sparkSession.createDataFrame(
            [(i, None if v is None else int(v), len(w)) for i, (v, w) in enumerate(zip(index.ids, index.words))],
            "item int, item_id long, item_words int")
        found = docs.select(F.col(id_col).alias("doc_id"), F.explode(leaks_column(F.col(text_col), index)).alias("f"))
        rows = found.select("doc_id", "f.*").join(F.broadcast(names), "item").select(
            "doc_id", "item_id", "distance", "item_words", F.col("start").alias("start_word"))
        out = rows if out is None else out.unionAll(rows)
    return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, item_words int, start_word int") if out is None else out


def leaking(docs: DataFrame, benchmark: DataFrame, flag: str, text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with a boolean column ``flag``: whether the text leaks any item."""
    out = docs.withColumn(flag, F.lit(False))
    for index in blocks(benchmark, item_col, item_text):
        out = out.withColumn(flag, F.col(flag) | (F.size(leaks_column(F.col(text_col), index)) > 0))
    return out
