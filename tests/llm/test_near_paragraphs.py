"""Near copies of paragraphs against brute-force Jaccard, edit distances of leaks, and
texts of a megabyte and more."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from lakeward.llm import bpe, decontaminate, exact_dedup, simhash, substring_dedup, token_counts, warc
from lakeward.llm.common import cut, prepare, table
from lakeward.llm.components import components


def shingles(words: list[bytes]) -> set:
    n = substring_dedup.WIDTH
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def near_pairs(texts: list[str]) -> dict[tuple[int, int], float]:
    """Unequal paragraphs by hash with a Jaccard similarity of 0.8 or more, each pair that has a shingle in common tried."""
    sets = {}
    for text in texts:
        for start, end in substring_dedup.unit_ranges(text or ""):
            words = text[start:end].encode().lower().split()
            if words:
                sets[int(np.uint64(substring_dedup.unit_hash(words)).astype(np.int64))] = shingles(words)
    held = defaultdict(list)
    for h, grams in sets.items():
        for g in grams:
            held[g].append(h)
    tried = {(a, b) for hs in held.values() for i, a in enumerate(hs) for b in hs[i + 1 :]}
    out = {}
    for a, b in tried:
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= substring_dedup.SIMILARITY:
            out[min(a, b), max(a, b)] = j
    return out


def linked(spark, docs):
    texts = substring_dedup.keyed(docs, "doc_id", "text")
    units = cut(substring_dedup.paragraph_units(texts), "test-units")
    from pyspark.sql import functions as F

    of_unit = cut(units.groupBy("h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")), "test-unit-documents")
    links = substring_dedup.unit_links(texts, units, of_unit)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    return {(min(r), max(r)) for r in map(tuple, links.collect())}, roots


def edited(rng, words: list[str], n: int) -> str:
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_paragraphs_are_recalled(spark):
    prepare(spark)
    rng = random.Random(1)
    rows, doc = [], 0
    for _ in range(60):  # one paragraph, and copies of it with up to a few words changed
        words = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([20, 60, 90, 150]))]
        for n in [0, *(rng.randrange(1, 4) for _ in range(rng.randrange(1, 9)))]:
            rows.append((doc, f"{' '.join(f'u{rng.randrange(10**6)}' for _ in range(30))}\n{edited(rng, words, n)}\nlast line of {doc}"))
            doc += 1
    want = near_pairs([t for _, t in rows])
    got, roots = linked(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(want) > 100 and got <= set(want)  # every link is exact
    together = [roots.get(a) is not None and roots.get(a) == roots.get(b) for a, b in want]
    assert np.mean(together) >= 0.95


def test_near_paragraphs_of_the_documents(spark):
    prepare(spark)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = near_pairs([r["text"] for r in docs.select("text").collect()])
    got, roots = linked(spark, docs)
    assert got <= set(want)
    together = [roots.get(a) is not None and roots.get(a) == roots.get(b) for a, b in want]
    print(f"{sum(together)} of {len(want)} near pairs in one component")
    assert want and np.mean(together) >= 0.9


def test_copies_of_an_edited_paragraph_are_spans(spark):
    prepare(spark)
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**5)}" for _ in range(100)]
    rows = [(i, f"{' '.join(f'u{rng.randrange(10**6)}' for _ in range(40))}\n{edited(rng, words, 0 if i == 5 else 1)}") for i in range(5, 40)]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(got) == list(range(6, 40)) and {r["keep_doc_id"] for r in got.values()} == {5}
    assert all(r["n_words"] == 100 for r in got.values())
    # Of copies that tie in all but their ids the smallest id keeps.
    same = [(i, " ".join(words)) for i in (9, 3, 7)]
    ties = substring_dedup.repeated_spans(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["keep_doc_id"]) for r in ties) == [(7, 3), (9, 3)]


# ------------------------------------------------------------------ leaks

def best_window(pattern: list[bytes], words: list[bytes]) -> int:
    """The least word edit distance of the pattern to any run of words."""
    row = [0] * (len(words) + 1)
    for i, p in enumerate(pattern, 1):
        above, row = row, [i]
        for j, w in enumerate(words, 1):
            row.append(min(above[j - 1] + (p != w), above[j] + 1, row[-1] + 1))
    return min(row)


def test_leaks_have_least_distances_and_starts(spark):
    prepare(spark)
    rng = random.Random(4)
    say = lambda n, s="n": [f"{s}{rng.randrange(3000)}" for _ in range(n)]
    items = [say(n, "q") for n in (5, 8, 12, 20, 33, 50, 50, 3, 1)]
    items[6] = items[5]  # repeated items give a result each
    docs = []
    for d in range(60):
        words, place = say(rng.randrange(0, 60)), None
        item = rng.choice(items)
        copy = list(item)
        for _ in range(rng.randrange(decontaminate.edits(len(item)) + 2)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        docs.append((d, " ".join(words + copy + say(rng.randrange(0, 30)))))
    docs += [(100, None), (101, "")]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.benchmark_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    want = {}
    for d, text in docs:
        words = decontaminate.words_of(text)
        for i, item in enumerate(items):
            distance = best_window([w.encode() for w in item], words)
            if distance <= decontaminate.edits(len(item)):
                want[d, i] = distance
    # The target recall is 0.97; what is found has the least distance there is.
    assert len(want) > 40 and len(got) >= 0.9 * len(want)
    assert all(want[k] == r["distance"] for k, r in got.items())
    texts = dict(docs)
    for (d, i), r in got.items():
        words, item = decontaminate.words_of(texts[d]), [w.encode() for w in items[i]]
        near = words[r["start_word"] : r["start_word"] + len(item) + want[d, i]]
        # The run that begins there, give or take the edits, is the leak.
        lead = max(0, r["start_word"] - want[d, i])
        assert best_window(item, words[lead : r["start_word"] + len(item) + want[d, i]]) == want[d, i] and near
        assert r["item_words"] == len(item)


# ------------------------------------------------------------------ long texts

LONG = [
    "x" * 1_200_000, " " * 1_200_000, "\n".join(f"line {i} of a long text, said once." for i in range(40_000)),
    "".join(chr(97 + (i * i) % 26) for i in range(1_000_000)), "été 中文 🙂 " * 70_000]


@pytest.fixture(scope="module")
def long_docs(spark):
    prepare(spark)
    rows = [(i, t) for i, t in enumerate([*LONG, LONG[2]])]
    return cut(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "long-docs")


def test_long_texts_tokens(spark, long_docs):
    byte_path, word_path = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    byte, word = Tokenizer.from_file(byte_path), Tokenizer.from_file(word_path)
    ids = {r["doc_id"]: r for r in bpe.with_digests(bpe.encode_documents(long_docs, byte_path)).collect()}
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(long_docs, word_path).collect()}
    for i in (1, 2, 4):
        want = byte.encode(LONG[i], add_special_tokens=False).ids
        assert ids[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert ids[i]["decoded_sha256"] == hashlib.sha256(byte.decode(want, skip_special_tokens=False).encode()).hexdigest()
        assert counts[i] == len(word.encode(LONG[i], add_special_tokens=False).ids)
    assert all(ids[i]["n_tokens"] > 0 and counts[i] >= 0 for i in range(len(LONG)))


def test_long_texts_copies(spark, long_docs):
    kept = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(long_docs).collect()}
    assert kept[5]["keep_id"] == 2 and sum(r["kept"] for r in kept.values()) == len(LONG)
    near = {r["doc_id"]: r for r in simhash.near_duplicates(long_docs).collect()}
    assert near[5]["component_id"] == 2 and near[1]["fingerprint"] == "0" * 16
    grams = [" ".join(w) for w in zip(*(LONG[2].lower().split()[k:] for k in range(3)))]
    ones = np.zeros(64, int)
    for g in grams:
        ones += np.array([xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1 for b in range(64)])
    assert int(near[2]["fingerprint"], 16) == sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))
    spans = substring_dedup.repeated_spans(long_docs).collect()
    assert [(r["doc_id"], r["span_start"], r["span_chars"], r["keep_doc_id"]) for r in spans if r["doc_id"] == 5] == [(5, 0, len(LONG[2]), 2)]


def test_archives_of_repeated_and_null_ids(spark):
    prepare(spark)
    rows = [(1, "http://h/1", "same"), (1, "http://h/1", "same"), (2, "http://h/2", "same"), (None, "http://h/n", "same"), (None, None, "own"), (3, "u", "")]
    got = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    told = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    assert len(got) == len(rows)
    assert told == sorted([("1", 4, "revisit", 2), ("1", 4, "revisit", 2), ("2", 4, "response", None), ("None", 4, "revisit", 2), ("None", 3, "response", None), ("3", 0, "response", None)])
