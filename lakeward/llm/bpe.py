"""Byte-level BPE encoding and decoding (operator 1).

Encoding keeps the symbols of a pre-token in a doubly linked list and the
mergeable neighbours in a priority queue ordered by merge rank and position.
An entry is stale, and skipped, when one of its two symbols has changed since
it was queued. Decoding concatenates the vocabulary strings of the ids.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to an empty text; a text of any length is encoded whole; added tokens
inside a text become their one id, as the vocabulary file declares them;
repeated rows are encoded each; columns beside the id and the text are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import BoundedCache, worker_state

# Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE_ENTRIES = 450_000
CACHED_CHARS = 64


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 upwards in order."""
    printable = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], int], merged: list[int]) -> list[int]:
    """Merge a list of symbol ids by rank, leftmost first among equal ranks.
    ``ranks`` maps a pair of ids to its rank, ``merged`` a rank to the new id.

    Queue entries are rank * n + position; ``pair`` holds the rank of the pair
    that now starts at a position, so an entry of another rank is stale."""
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of = ranks.get
    ids, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
    pair = list(map(rank_of, zip(ids, ids[1:])))
    queue = [rank * n + at for at, rank in enumerate(pair) if rank is not None]
    pair.append(None)
    heapq.heapify(queue)
    while queue:
        rank, at = divmod(heapq.heappop(queue), n)
        if pair[at] != rank:
            continue  # stale
        gone = right[at]
        beyond = right[gone]
        ids[at] = symbol = merged[rank]
        ids[gone] = pair[gone] = None
        right[at] = beyond
        if beyond < n:
            left[beyond] = at
            pair[at] = fresh = rank_of((symbol, ids[beyond]))
            if fresh is not None:
                heapq.heappush(queue, fresh * n + at)
        else:
            pair[at] = None
        before = left[at]
        if before >= 0:
            pair[before] = fresh = rank_of((ids[before], symbol))
            if fresh is not None:
                heapq.heappush(queue, fresh * n + before)
    return [i for i in ids if i is not None]


class ByteBPE:
    """A byte-level BPE vocabulary in the JSON format of public tokenizers."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        symbols = byte_symbols()
        self.of_byte = [vocab[s] for s in symbols]
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.piece = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.piece.update({i: content.encode() for content, i in self.added.items()})
        self.added_at = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.split = regex.compile(SPLIT)
        # Anything but single spaces between characters that are not space.
        self.uneven = re.compile(r" \s|\s |\0|^ ")
        self.code = "H" if max(self.piece) < 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.chunks = BoundedCache(self._chunk, cache_entries)

    def _word(self, word: str) -> bytes:
        ids = merge_symbols(list(map(self.of_byte.__getitem__, word.encode())), self.ranks, self.merged)
        return array(self.code, ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):  # one run of letters
            return self._word(chunk)
        words = self.split.findall(chunk)
        if len(words) < 2:
            return self._word(chunk)
        return b"".join([self.chunks[w] if len(w) <= CACHED_CHARS else self._word(w) for w in words])

    def _plain(self, text: str) -> bytes:
        if self.uneven.search(text):
            return self._chunk(text) if len(text) > CACHED_CHARS else self.chunks[text]
        # Here each space starts a pre-token, so a text may be cut before it.
        chunks = text.replace(" ", "\0 ").split("\0")
        if max(map(len, chunks)) > CACHED_CHARS:
            return b"".join([self.chunks[c] if len(c) <= CACHED_CHARS else self._chunk(c) for c in chunks])
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, self.dtype)
        found, parts, at = self.added_at.finditer(text) if self.added_at else (), [], 0
        for match in found:
            if match.start() > at:
                parts.append(self._plain(text[at : match.start()]))
            parts.append(array(self.code, [self.added[match.group()]]).tobytes())
            at = match.end()
        if at < len(text):
            parts.append(self._plain(text[at:]))
        return np.frombuffer(b"".join(parts), self.dtype)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.piece.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


def vocabulary(path: str) -> ByteBPE:
    return worker_state(f"bpe:{path}", lambda: ByteBPE(path))


def encode_column(text: Column, path: str) -> Column:
    """array<int>: the ids of each text."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        encoded = [bpe.encode(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, encoded)], dtype=np.int32)
        ids = np.concatenate([np.zeros(0, np.int32), *encoded], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))

    return encode(text)


def decode_column(ids: Column, path: str) -> Column:
    """string: the text of each id list (null: empty)."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        empty = np.zeros(0, np.int32)
        return pa.array([bpe.decode(x.values.to_numpy() if x.is_valid else empty) for x in lists], pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) for every row of ``docs``."""
    ids = docs.select(F.col(id_col).alias("doc_id"), encode_column(F.col(text_col), path).alias("ids"))
    return ids.withColumn("decoded", decode_column(F.col("ids"), path))


def with_digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ``more`` of encoded documents."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
