"""Importance resampling, the prefix trie and sharding against brute force, and the
cases they define."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeward.llm import importance, prefix_trie, sharding
from lakeward.llm.common import cut, prepare
from lakeward.llm.running import carried, running

# ------------------------------------------------------------------ running values


def test_running_values_cross_task_borders(spark):
    prepare(spark)
    rng = random.Random(3)
    # Group 7 holds most rows and so spans tasks.
    data = [(7 if rng.random() < 0.7 else rng.randrange(5), i, rng.randrange(-9, 99), rng.getrandbits(62)) for i in range(4000)]
    rows = cut(spark.createDataFrame(data, "g long, o long, a long, x long").repartition(5), "test-running")
    out = running(rows, "g", [F.asc("o")], sums=["a"], xors=["x"])
    got = {(r["g"], r["o"]): (r["idx"], r["run_a"], r["run_x"]) for r in out.collect()}
    state = defaultdict(lambda: [0, 0, 0])
    for g, o, a, x in sorted(data):
        n, total, mix = state[g]
        state[g] = [n + 1, total + a, mix ^ x]
        assert got[g, o] == (n, total + a, mix ^ x)
    assert len(got) == len(data)


def test_carried_over_tasks_that_hold_one_group():
    edge = lambda p, first, last, idx, a: {"_part": p, "first": first, "last": {"group": last, "idx": idx, "run_a": a}}
    # Group 2 begins in task 0, fills tasks 1 and 3 (2 is empty) and ends in task 4.
    edges = [edge(4, 2, 5, 0, 1), edge(0, 1, 2, 1, 10), edge(3, 2, 2, 6, 20), edge(1, 2, 2, 4, 7)]
    assert carried(edges, ["a"], []) == [(1, 2, 10), (3, 7, 17), (4, 14, 37)]


# ------------------------------------------------------------------ importance resampling

def features(text: str | None) -> tuple[int, list[int]]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_crc_of_spans_of_any_length():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)
    sizes = [1, 2, 63, 64, 65, 128, 129, 4095, 4096, 4097, 64 * 64 + 1, 70_000, 299_999]
    starts = np.array([rng.integers(0, 300_001 - n) for n in sizes])
    ends = starts + sizes
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert importance.span_crcs(data, starts, ends).tolist() == want
    # Spans of one layout that don't fill a block each, and one alone.
    short = np.array([3, 5, 9, 9]), np.array([4, 9, 10, 70])
    assert importance.span_crcs(data, *short).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(*short)]


LONG = " ".join(f"w{i % 977}" for i in range(200_000)) + " " + "x" * 600_000 + " " + "end of it " * 5


@pytest.mark.parametrize("text", ["", " \t!", "a", "A b-C", "Éa ÄB ß z　q", "x" * 1_000_000, " " * 600_000, LONG], ids=range(8))
def test_features_of_odd_and_long_texts(text):
    found = list(importance.feature_buckets(text.encode()))
    assert (sum(n for n, _ in found), sorted(int(b) for _, f in found for b in f)) == (lambda n, f: (n, sorted(f)))(*features(text))


def expected(docs, target, percent=5):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, text in docs:
        np.add.at(s, features(text)[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (float(s.sum()) + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in range(10000)]
    out = []
    for doc, text in docs:
        n, f = features(text)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    best = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(best[: len(best) * percent // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


def drawn(spark, docs, target, schema="doc_id long, text string, weight string", **more):
    frame = spark.createDataFrame([(d, t, "clash") for d, t in docs], schema)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    return importance.resampled(frame, goal, **more).collect()


def test_resampling_equals_brute_force(spark):
    prepare(spark)
    rng = random.Random(8)
    word = lambda: rng.choice("alpha beta gamma delta Epsilon ζeta eta9 theta".split()) + rng.choice(["", "s", "!"])
    docs = [(i, " ".join(word() for _ in range(rng.choice([0, 5, 19, 20, 40, 120])))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, "!!! ??"), (403, "word " * 70_000), (404, LONG), (405, " " * 300_000)]
    target = [" ".join(word() for _ in range(30)) for _ in range(9)] + [None, ""]
    got = drawn(spark, docs, target)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got), key=repr) == expected(docs, target)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len([r for r in got if r["n_words"] >= 20]) * 5 // 100 + 1))


def test_resampling_ties_nulls_and_empty_tables(spark):
    prepare(spark)
    # One id and text many times: equal scores, each row drawn on its own; null ids last among equals.
    same = [(5, "one two three four " * 6)] * 100
    got = drawn(spark, same + [(None, "one two three four " * 6)] * 3, [])
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5] and len(got) == 103
    assert drawn(spark, [], ["a b c"]) == []
    few = drawn(spark, [(1, "too short"), (None, None)], [])
    assert [r["rank"] for r in few] == [None, None]


# ------------------------------------------------------------------ prefix trie

def trie_of(rows):
    """Nodes by brute force: (conv_id, depth, parent, n, children, leaves, saved, ends)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    ends = {p: hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest() for p, m in members.items()}
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], ends[p]) for p, m in members.items()), key=repr)


def made(spark, rows, schema="conv_id long, turn long, role string, text string, depth string", **more):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], schema)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in prefix_trie.trie(frame, **more).collect()), key=repr)


def conversations(rng, n, first=("hi", "hello", "ünï")):
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(first) if t < 2 or rng.random() < 0.6 else f"text {rng.randrange(10**6)}"))
    return rows


def test_trie_equals_brute_force(spark):
    prepare(spark)
    rng = random.Random(2)
    rows = conversations(rng, 150)
    rows += [(c, t, r, x) for c in (-7, -5, 1000, 1001, 1002) for t, r, x in [(0, "user", "hi"), (0, "user", "hi"), (None, None, None), (3, "a", None), (3, None, "a")]]
    rows += [(2001, t, "user", f"long {t}") for t in range(700)] + [(None, 0, "user", "nobody's")] + rows[:40]
    rng.shuffle(rows)
    want = trie_of(rows)
    assert made(spark, rows) == want
    # Rounds of a small sketch, and one so small that nearly every cell is shared, change nothing.
    assert made(spark, rows, sketch_bytes=600) == want
    assert made(spark, rows, sketch_bytes=100_000) == want


def test_trie_of_many_copies_and_of_nothing(spark):
    prepare(spark)
    rows = [(c, t, "user", f"turn {t}") for c in range(900) for t in range(3)]
    assert made(spark, rows) == trie_of(rows)
    assert made(spark, []) == []
    # Turnless conversations: all turns are among the first h and the head's owner is absent.
    lost = [(c, 0, "u", "x") for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    assert made(spark, lost) == trie_of(lost) and made(spark, lost)[0][1] == 0


def test_the_sketch_proves_no_shared_prefix_single(spark):
    prepare(spark)
    rng = np.random.default_rng(6)
    digests = rng.integers(-(2**63), 2**63 - 1, (3000, 2))
    digests = np.concatenate([digests, digests[:500], [[0, 0], [5, 0]]])
    rows = spark.createDataFrame([(1, int(a), int(b)) for a, b in digests], "depth long, p1 long, p2 long")
    for width in (1 << 12, 1 << 15, 1 << 17):
        single = prefix_trie.proven(spark, prefix_trie.shared_cells(rows, width), width)
        marks = {(r["p1"], r["p2"]): r["one"] for r in rows.select("p1", "p2", single("p1", "p2").alias("one")).collect()}
        cells = defaultdict(int)
        for a, b in digests:
            cells[0, int(a) % width] += 1
            cells[1, int(b) % width] += 1
        assert marks == {(int(a), int(b)): min(cells[0, int(a) % width], cells[1, int(b) % width]) == 1 for a, b in digests}


def test_ends_are_hashed_over_pieces(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(prefix_trie, "PIECE", 400)
    ids = list(range(-50, 3000, 7))
    rows = spark.createDataFrame([(1, 2, 0, c) for c in ids] + [(1, 3, 1, 9)], "p1 long, p2 long, depth long, conv_id long").repartition(6)
    got = {(r["p1"], r["p2"], r["depth"]): r["ends_sha256"] for r in prefix_trie.end_digests(rows).collect()}
    assert got == {(1, 2, 0): hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (1, 3, 1): hashlib.sha256(b"9").hexdigest()}


# ------------------------------------------------------------------ sharding

def shard_of(tree, key: str) -> int:
    below, node = tree.children(), sharding.ROOT
    for _ in range(3):
        draw = lambda c: math.log((int(hashlib.sha256(f"{c[0]}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / c[2]
        node, number, _ = max(below[node], key=lambda c: (draw(c), c[1]))
    return number


UNEVEN = sharding.Tree({(0, 0, 0): 1.0, (0, 0, 1): 3.0, (0, 1, 2): 0.5, (1, 2, 3): 2.0, (1, 3, 4): 1.0, (1, 3, 5): 1.0})


@pytest.mark.parametrize("tree", [sharding.Tree.regular(2, 3, 4), UNEVEN, sharding.Tree({(0, 0, 0): 1.0})], ids=["regular", "uneven", "one"])
def test_shards_slots_and_growth(spark, tree):
    prepare(spark)
    texts = ["one", "", None, "twö " * 100, "one"]
    docs = [(i, texts[i % 5], "clash") for i in range(1500)] + [(3, "again", "clash"), (None, "x", "clash"), (None, None, "clash")]
    got = sharding.sharded(spark.createDataFrame(docs, "doc_id long, text string, shard string"), tree).collect()
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), shard_of(tree, "" if d is None else str(d)),
                    shard_of(tree.grown(), "" if d is None else str(d))) for d, t, _ in docs), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got), key=repr) == want
    new = max(s for _, _, s in tree.weights) + 1
    assert all(r["grown_shard"] in (r["shard"], new) for r in got) and any(r["grown_shard"] == new for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append((r["slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"]))
    for rows in slots.values():
        rows.sort()
        assert [s for s, *_ in rows] == list(range(len(rows))) and [x[1:] for x in rows] == sorted(x[1:] for x in rows)


def test_shards_follow_their_weights():
    n = 20_000
    counts = defaultdict(int)
    for i in range(n):
        counts[shard_of(UNEVEN, str(i))] += 1
    total = sum(UNEVEN.weights.values())
    for (_, _, shard), weight in UNEVEN.weights.items():
        share = weight / total
        assert abs(counts[shard] - n * share) < 5 * math.sqrt(n * share * (1 - share))


def test_a_changed_weight_moves_keys_only_within_its_subtrees():
    heavier = sharding.Tree({**UNEVEN.weights, (0, 1, 2): 2.0})
    place = {shard: at for at in UNEVEN.weights for shard in [at[2]]}
    moved = 0
    for i in range(6000):
        a, b = shard_of(UNEVEN, str(i)), shard_of(heavier, str(i))
        if a != b:
            moved += 1
            # Into region 0 from the other, or within region 0 into rack 1: no other subtree gained.
            assert place[b][0] == 0 and (place[a][0] == 1 or place[b][1] == 1)
    assert moved > 100


def test_sharding_of_nothing_and_bad_weights(spark):
    prepare(spark)
    none = sharding.sharded(spark.createDataFrame([], "doc_id long, text string"), UNEVEN)
    assert none.collect() == [] and none.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    with pytest.raises(ValueError, match="above 0"):
        sharding.Tree({(0, 0, 0): 0.0}).children()
