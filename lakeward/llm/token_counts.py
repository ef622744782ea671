"""Token counts of whole texts (operator 2).

A text is cut at ASCII white space, where this kind of vocabulary never joins
tokens (its pre-tokenizer drops white space, its normalizer composes nothing
across it and its added tokens hold none). The pieces that a worker has not yet
counted go to the tokenizer in batches of about equal bytes; only their lengths
stay, and a text's count is the sum over its pieces. Added tokens inside a text
count as the library counts them, since no cut falls inside one.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); white space
alone has no tokens; a piece without white space is counted whole, however
long; repeated rows are counted each; other columns are ignored. A sentencepiece
model joins pieces across white space, so there the text is encoded whole.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import worker_state

#: A full stop or comma after an ASCII letter starts a token of its own.
MARK = re.compile(rb"(?<=[A-Za-z])(?=[.,])")
#: Bytes of text in one call of the tokenizer.
BATCH_BYTES = 1 << 18
#: Pieces whose count a worker keeps, and the longest of them in bytes.
KEPT_PIECES = 800_000
KEPT_BYTES = 64


def safe_pieces(text: bytes) -> list[bytes]:
    """Cut where the vocabulary never joins tokens. It lower-cases, so pieces are
    lower-cased first, except where an added token may be written."""
    return MARK.sub(b" ", text.lower()).split() if b"<|" not in text else text.split()


def byte_batches(pieces, limit: int):
    """Lists of pieces of about ``limit`` bytes; a longer piece goes alone."""
    batch, size = [], 0
    for piece in pieces:
        if batch and size + len(piece) > limit:
            yield batch
            batch, size = [], 0
        batch.append(piece)
        size += len(piece)
    if batch:
        yield batch


class PieceCounter:
    """Counts by white-space pieces with a tokenizers .json file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept: dict[bytes, int] = {}

    def lengths(self, pieces: list[bytes]) -> list[int]:
        texts = [p.decode() for p in pieces]
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[bytes | None]) -> list[int]:
        split = [safe_pieces(t or b"") for t in texts]
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        new = set().union(*split) - self.kept.keys() if split else set()
        counts = self.kept
        brief = sorted(p for p in new if len(p) <= KEPT_BYTES)
        for batch in byte_batches(brief, BATCH_BYTES):
            counts.update(zip(batch, self.lengths(batch), strict=True))
        long = sorted(p for p in new if len(p) > KEPT_BYTES)
        if long:
            counts = dict(self.kept)
            for batch in byte_batches(long, BATCH_BYTES):
                counts.update(zip(batch, self.lengths(batch), strict=True))
        return [sum(map(counts.__getitem__, pieces)) for pieces in split]


class WholeCounter:
    """Counts whole texts with a sentencepiece .model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: list[bytes | None]) -> list[int]:
        out: list[int] = []
        for batch in byte_batches([t or b"" for t in texts], BATCH_BYTES):
            out += map(len, self.model.encode([t.decode() for t in batch], num_threads=1))
        return out


def counter(path: str):
    return worker_state(f"counter:{path}", lambda: (WholeCounter if path.endswith(".model") else PieceCounter)(path))


def count_column(text: Column, path: str) -> Column:
    """long: the tokens of each text."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(counter(path).count(pc.cast(texts, pa.binary()).to_pylist()), pa.int64())

    return count(text)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        count_column(text, path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
