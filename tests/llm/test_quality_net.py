"""The convolutional network against a naive forward pass, its gradients against
differences, and what its training reads."""

from __future__ import annotations

import numpy as np
import pytest

from lakeward.llm import quality
from lakeward.llm.common import prepare


def small_net(rng, dtype=np.float64) -> quality.Net:
    make = lambda *shape: rng.normal(0, 0.4, shape).astype(dtype)
    half = (quality.STEP * quality.VECTOR, quality.FILTERS)
    return quality.Net(make(256, quality.VECTOR), make(*half), make(*half), make(quality.FILTERS), make(2 * quality.FILTERS), 0.3,
                       make(2 * quality.FILTERS), np.abs(make(2 * quality.FILTERS)) + 0.5)


def naive_score(net: quality.Net, text: bytes) -> float:
    """Byte by byte: chunks, filters, pools, one logistic unit."""
    stride = quality.CHUNK - quality.OVERLAP
    vectors, at = [], 0
    while at == 0 or at + quality.OVERLAP < len(text):
        chunk = text[at : at + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        best = np.full(quality.FILTERS, -np.inf)
        for spot in range(0, quality.CHUNK - quality.WIDTH + 1, quality.STEP):
            seen = np.concatenate([net.embed[b] for b in chunk[spot : spot + quality.WIDTH]])
            best = np.maximum(best, seen @ np.concatenate([net.first, net.second]))
        vectors.append(np.maximum(best + net.bias, 0))
        at += stride
    doc = np.concatenate([np.max(vectors, axis=0), np.mean(vectors, axis=0)])
    return 1 / (1 + np.exp(-(((doc - net.mean) / net.scale) @ net.weight + net.offset)))


@pytest.mark.parametrize("size", [0, 1, 31, 32, 33, 511, 512, 513, 992, 993, 2000, 30_000])
def test_scores_equal_a_naive_forward_pass(size):
    rng = np.random.default_rng(size)
    net, text = small_net(rng), rng.integers(1, 256, size, dtype=np.uint8).tobytes()
    assert net.score(text) == pytest.approx(naive_score(net, text), abs=1e-9)


def test_chunks_cover_the_whole_text():
    text = np.arange(1, 256, dtype=np.uint8).tobytes() * 23
    chunks = quality.chunks_of(text)
    stride = quality.CHUNK - quality.OVERLAP
    assert b"".join(c[:stride].tobytes() for c in chunks).ljust(len(text) + quality.CHUNK, b"\0").startswith(text[: len(chunks) * stride])
    assert chunks[-1].tobytes().rstrip(b"\0") == text[(len(chunks) - 1) * stride :]


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(quality, "SLICE", 3)  # documents span slices
    rng = np.random.default_rng(4)
    net = small_net(rng)
    texts = [rng.integers(97, 101, n, dtype=np.uint8).tobytes() for n in (700, 40, 2600)]
    parts = [quality.chunks_of(t) for t in texts]
    x, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    labels, weights = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    _, grads = quality.gradients(net, x, sizes, labels, weights)
    step = 1e-6
    for param, grad in zip([net.embed, net.first, net.second, net.bias, net.weight], grads):
        flat = param.reshape(-1)
        spots = np.argsort(-np.abs(grad.reshape(-1)))[:12].tolist() + rng.integers(0, flat.size, 12).tolist()
        for i in spots:
            kept = flat[i]
            ends = []
            for move in (step, -step):
                flat[i] = kept + move
                ends.append(quality.gradients(net, x, sizes, labels, weights)[0])
            flat[i] = kept
            assert grad.reshape(-1)[i] == pytest.approx((ends[0] - ends[1]) / (2 * step), rel=1e-4, abs=1e-7)
    for move in (step, -step):
        net.offset += move
        ends.append(quality.gradients(net, x, sizes, labels, weights)[0])
        net.offset -= move
    assert grads[5][0] == pytest.approx((ends[-2] - ends[-1]) / (2 * step), rel=1e-4)


def learned_from(spark, monkeypatch, docs, labels, **more):
    got = []
    monkeypatch.setattr(quality, "train", lambda texts, y, w: got.append((texts, y.tolist())) or 0.5)
    for name, value in more.items():
        monkeypatch.setattr(quality, name, value)
    quality.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    return got[0]


def test_training_takes_one_text_of_each_id_by_rule(spark, monkeypatch):
    prepare(spark)
    labels = [(i, i % 2) for i in range(12)]
    docs = [(i, t) for i in range(12) for t in (f"b{i}", f"a{i}", f"c{i}")] + [(3, None)]
    texts, y = learned_from(spark, monkeypatch, docs, labels)
    again = learned_from(spark, monkeypatch, docs[::-1], labels)
    assert again == (texts, y) and set(texts) <= {f"a{i}".encode() for i in range(12)} | {b""} and len(texts) == len(y)


def test_training_reads_a_bounded_number_of_bytes(spark, monkeypatch):
    prepare(spark)
    labels = [(i, i % 2) for i in range(60)]
    docs = [(i, "x" * 100) for i in range(60)]
    texts, y = learned_from(spark, monkeypatch, docs, labels, SAMPLE_BYTES=1050)
    assert len(texts) == 10 and 0 < sum(y) < 10
