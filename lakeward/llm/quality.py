"""Quality of a text by a byte-level convolutional network (operator 6).

A text's bytes are cut into overlapping chunks that cover it whole. Each byte
gets a learned vector; learned filters eight bytes wide slide over a chunk at a
stride of four and are max-pooled over it. The chunk vectors are combined over the
document by their greatest value and their mean, and one logistic unit makes the
probability. All features are learned.

Training runs on the driver over a bounded sample of labelled rows: at most
``SAMPLE`` ids for each class, those with the smallest hash, as far as their texts have
``SAMPLE_BYTES`` bytes together (in the order of the hash; a text that doesn't fit is left out whole). Training and scoring
read every chunk of a text, pooled in slices. Ids, languages, sources and labels are never inputs of a score.

Defined cases: null and empty texts are scored as one chunk of padding; a text
longer than any sample is scored in slices of bounded size; labels without a
text, or with a null quality, are ignored; of several labels of an id the
greatest counts, and of several texts of an id the first in byte order is learned from; without labels every score is 0.5, and with one class only, that
class's rate; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK, OVERLAP = 512, 32
STEP, WIDTH = 4, 8
VECTOR, FILTERS = 8, 32
#: Labelled rows of each class that training reads at most.
SAMPLE = 1500
#: Bytes of text that training reads at most.
SAMPLE_BYTES = 64 << 20
EPOCHS, BATCH, RATE, SEED = 10, 48, 5e-3, 7
#: Chunks that are scored or learned from at a time: bounds memory for any length of text.
SLICE = 512


def chunks_of(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover the text, padded with zero bytes."""
    stride = CHUNK - OVERLAP
    n = max(1, -(-(len(text) - OVERLAP) // stride))
    padded = np.zeros(n * stride + OVERLAP, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::stride]


@dataclass
class Net:
    embed: np.ndarray  # 256 x VECTOR
    first: np.ndarray  # STEP * VECTOR x FILTERS, for the first half of a filter's bytes
    second: np.ndarray  # the same for the second half
    bias: np.ndarray
    weight: np.ndarray  # of the document's vector
    offset: float
    mean: np.ndarray
    scale: np.ndarray

    def blocks(self, chunks: np.ndarray) -> np.ndarray:
        return self.embed[chunks].reshape(len(chunks), CHUNK // STEP, STEP * VECTOR)

    def filtered(self, blocks: np.ndarray) -> np.ndarray:
        flat = blocks.reshape(-1, STEP * VECTOR)
        one = (flat @ self.first).reshape(len(blocks), -1, FILTERS)
        two = (flat @ self.second).reshape(len(blocks), -1, FILTERS)
        return one[:, :-1] + two[:, 1:]

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Chunk vectors: max-pooled filters."""
        return np.maximum(self.filtered(self.blocks(chunks)).max(axis=1) + self.bias, 0)

    def score(self, text: bytes) -> float:
        chunks = chunks_of(text)
        return float(self.scores(chunks, np.array([0]))[0])

    def scores(self, chunks: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One score for each document; ``starts`` are their first chunks."""
        vectors = np.concatenate([self.pooled(chunks[i : i + SLICE]) for i in range(0, len(chunks), SLICE)])
        sizes = np.diff(np.r_[starts, len(chunks)])[:, None]
        docs = np.concatenate([np.maximum.reduceat(vectors, starts), np.add.reduceat(vectors, starts) / sizes], axis=1)
        logit = ((docs - self.mean) / self.scale) @ self.weight + self.offset
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))


def gradients(net: Net, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The mean weighted log loss over documents of so many chunks each (x: all chunks in turn), and its
    gradients by embed, first, second, bias, weight and offset."""
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    top, hidden = np.zeros((len(x), FILTERS), np.int64), np.zeros((len(x), FILTERS), net.first.dtype)
    slices = [slice(i, i + SLICE) for i in range(0, len(x), SLICE)]
    for part in slices:
        conv = net.filtered(net.blocks(x[part]))
        top[part] = conv.argmax(axis=1)
        hidden[part] = np.maximum(np.take_along_axis(conv, top[part][:, None], axis=1)[:, 0] + net.bias, 0)
    greatest = np.maximum.reduceat(hidden, begin)
    doc = np.concatenate([greatest, np.add.reduceat(hidden, begin) / sizes[:, None]], axis=1)
    z = (doc - net.mean) / net.scale
    p = 1 / (1 + np.exp(-np.clip(z @ net.weight + net.offset, -30, 30)))
    loss = float(-(weights * np.log(np.where(labels == 1, p, 1 - p))).mean())
    err = ((p - labels) * weights / len(sizes)).astype(net.first.dtype)
    g_doc = err[:, None] * (net.weight / net.scale)[None]
    of = np.repeat(np.arange(len(sizes)), sizes)
    # The greatest value's gradient goes to the first chunk that reaches it.
    reach = hidden == greatest[of]
    rank = np.cumsum(reach, axis=0)
    before = np.concatenate([np.zeros((1, FILTERS), rank.dtype), rank])[begin]
    g_hidden = (np.where(reach & (rank == before[of] + 1), g_doc[of, :FILTERS], 0) + g_doc[of, FILTERS:] / sizes[of, None]) * (hidden > 0)
    # Only the winning position of each filter passes a gradient on.
    g_first, g_second, g_embed = np.zeros_like(net.first), np.zeros_like(net.second), np.zeros_like(net.embed)
    kernel = np.concatenate([net.first, net.second]).T.reshape(FILTERS, WIDTH, VECTOR)
    for part in slices:
        chunks, at_top, g_part = x[part], top[part], g_hidden[part]
        line, blocks = np.arange(len(chunks))[:, None], net.blocks(chunks)
        g_first += np.einsum("rf,rfi->if", g_part, blocks[line, at_top])
        g_second += np.einsum("rf,rfi->if", g_part, blocks[line, at_top + 1])
        spots = (at_top * STEP)[:, :, None] + np.arange(WIDTH)
        back = (g_part[:, :, None, None] * kernel).reshape(-1, VECTOR)
        hit = chunks[line[:, :, None], spots].ravel()
        g_embed += np.stack([np.bincount(hit, back[:, d], 256) for d in range(VECTOR)], axis=1).astype(net.embed.dtype)
    return loss, [g_embed, g_first, g_second, g_hidden.sum(axis=0), z.T @ err, np.array([err.sum()], err.dtype)]


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = SEED) -> Net:
    """Fit on all chunks of the texts; ``weights`` give each class its
    share among all labelled rows."""
    rng = np.random.default_rng(seed)
    parts = [chunks_of(t) for t in texts]
    chunks = np.concatenate(parts)
    starts = np.cumsum([0, *map(len, parts)])
    net = Net(
        rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32), *(rng.normal(0, 0.2, (STEP * VECTOR, FILTERS)).astype(np.float32) for _ in range(2)),
        np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), 0.0, np.zeros(1, np.float32), np.ones(1, np.float32))
    net.embed[0] = 0
    vectors = np.concatenate([net.pooled(chunks[i : i + SLICE]) for i in range(0, len(chunks), SLICE)])
    docs = np.concatenate([np.maximum.reduceat(vectors, starts[:-1]), np.add.reduceat(vectors, starts[:-1]) / np.diff(starts)[:, None]], axis=1)
    net.mean, net.scale = docs.mean(axis=0), docs.std(axis=0) + 0.05
    offset = np.zeros(1, np.float32)
    params = [net.embed, net.first, net.second, net.bias, net.weight, offset]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    n = len(parts)
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, n, BATCH):
            pick = order[at : at + BATCH]
            rows = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in pick])
            _, grads = gradients(net, chunks[rows], np.array([starts[d + 1] - starts[d] for d in pick]), labels[pick], weights[pick])
            grads[4] = grads[4] + 1e-4 * net.weight
            step += 1
            for p_, g_, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g_ - m)
                v += 0.001 * (g_ * g_ - v)
                p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.embed[0] = 0
            net.offset = float(offset[0])
    return net


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from learning."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) == 1


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", target: str = "quality") -> Net | float:
    """A net, or the rate of class 1 where the labels don't have both classes."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(target).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    drawn = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    few = known.where("y = 1").orderBy(drawn).limit(SAMPLE).unionAll(known.where("y != 1").orderBy(drawn).limit(SAMPLE))
    # At most 2 * SAMPLE ids: small enough for any task.
    body = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    found = (docs.select(F.col(id_col).alias("doc_id"), body.alias("body")).join(F.broadcast(few), "doc_id")
             .groupBy("doc_id", "y").agg(F.min("body").alias("body")))
    # One row for each id by now, so this window has a bounded number of them.
    upto = F.sum(F.length("body")).over(Window.partitionBy(F.lit(0)).orderBy(drawn, "doc_id"))
    rows = found.withColumn("_upto", upto).where(F.col("_upto") <= SAMPLE_BYTES).drop("_upto").collect()
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["y"] == 1 for r in rows], np.float32)
    if not len(y) or y.min() == y.max():
        ones = totals.get(1, 0)
        return ones / sum(totals.values()) if totals else 0.5
    share = totals[1] / sum(totals.values())
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())).astype(np.float32)
    return train([bytes(r["body"]) for r in rows], y, weights)


def score_column(text: Column, model: Net | float) -> Column:
    """double: the probability of class 1 for each text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if isinstance(model, float):
            return pa.array(np.full(len(texts), model))
        bodies = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        out, at = [], 0
        while at < len(bodies):  # as many documents as fill some slices
            parts, n = [], 0
            while at < len(bodies) and n < SLICE:
                parts.append(chunks_of(bodies[at]))
                n += len(parts[-1])
                at += 1
            if len(parts) == 1:
                out.append(model.scores(parts[0], np.array([0])))
            else:
                out.append(model.scores(np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])])))
        return pa.array(np.concatenate([np.zeros(0), *out]))

    return score(text)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    model = learn(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(F.col(id_col)), F.lit(False)).alias("held_out"),
                         score_column(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
