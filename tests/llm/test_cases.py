"""Classifier, URL filters and the pipeline against brute force, and the cases that
every operator defines: null and empty texts, clashing columns, empty tables."""

from __future__ import annotations

import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from lakeward.llm import bpe, decontaminate, exact_dedup, html_extract, quality, simhash, substring_dedup, token_counts, url_filters, warc
from lakeward.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def auc(y: np.ndarray, score: np.ndarray) -> float:
    one, zero = score[y == 1][:, None], score[y == 0][None]
    return float((one > zero).mean() + (one == zero).mean() / 2)


def test_quality_ranks_held_out_documents(spark):
    prepare(spark)
    sf = "/root/testdata/sf0.01"
    rows = quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
    marks = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert auc(np.array([marks[r["doc_id"]] for r in held]), np.array([r["score"] for r in held])) > 0.85


def test_quality_defined_cases(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate([None, "", "x" * 300_000, "some words", "some words"])],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, ones).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    got = [r["score"] for r in quality.quality_scores(docs, both).orderBy("doc_id").collect()]
    assert got[0] == got[1] and got[3] == got[4] and all(0 <= s <= 1 for s in got)


def test_quality_learns_from_all_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(2)
    make = lambda y: bytes(rng.integers(97, 123, 9000, dtype=np.uint8))[: 700 + 400] + (b"QZ!? " * 60 if y else b"") + bytes(rng.integers(97, 123, 9000, dtype=np.uint8))
    y = np.arange(120) % 2
    texts = [make(k) for k in y]
    read = []
    whole = quality.chunks_of
    monkeypatch.setattr(quality, "chunks_of", lambda t: read.append(len(whole(t))) or whole(t))
    net = quality.train(texts[:80], y[:80].astype(np.float32), np.ones(80, np.float32))
    assert read == [len(whole(t)) for t in texts[:80]] and min(read) > 5
    assert auc(y[80:], np.array([net.score(t) for t in texts[80:]])) > 0.95


def active(entries, url: str | None, at) -> list[tuple[str, str, str]]:
    """The entries that hold for one capture, by replaying each pattern's history."""
    if url is None or at is None or not (m := re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", url)):
        return []
    host = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", m[1])).lower()
    path = (host + "/" + "/".join(p for p in m[2].split("/") if p)).lower() + "/"
    out = []
    for name, kind, pattern in sorted({e[:3] for e in entries if None not in e}):
        past = sorted((e[3], e[4]) for e in entries if e[:3] == (name, kind, pattern) and e[3] is not None and e[3] <= at)
        fits = f".{host}".endswith(f".{pattern}") if kind == "domain" else path.startswith(pattern.rstrip("/") + "/")
        if past and past[-1][1] == "add" and fits and host:
            out.append((name, kind, pattern))
    return out


def test_url_filters_equal_a_replay_of_the_lists(spark):
    rng = random.Random(4)
    day = lambda: datetime.date(2024, 1, 1) + datetime.timedelta(rng.randrange(200))
    hosts = ["a.test", "b.a.test", "xa.test", "c.test", "u@c.test:80"]
    captures = [(i, rng.choice(["http://", "HTTPS://"]) + rng.choice(hosts) + rng.choice(["", "/", "/en", "/en/x?q=/no", "/english"]), day(), "n")
                for i in range(300)] + [(900, None, day(), "n"), (901, "no url", day(), "n"), (902, "http://a.test/", None, "n"), (None, "http://a.test/", day(), "n")]
    entries = [(rng.choice("pq"), kind, pattern, day(), rng.choice(["add", "add", "remove"]))
               for kind, pattern in [("domain", "a.test"), ("domain", "c.test"), ("prefix", "a.test/en"), ("prefix", "c.test")] for _ in range(6)]
    entries += [entries[0], ("p", "domain", "a.test", None, "add"), (None, "domain", "a.test", day(), "add")]
    got = url_filters.url_filter(spark.createDataFrame(captures, "id long, url string, at date, lists string"),
                                 spark.createDataFrame(entries, "list string, kind string, pattern string, at date, action string")).collect()
    want = sorted((repr(i), url, len(hits := active(entries, url, at)), ",".join(sorted({h[0] for h in hits}))) for i, url, at, _ in captures if url)
    assert sorted((repr(r["id"]), r["url"], r["n_entries"], r["lists"]) for r in got if r["url"]) == want
    assert len(got) == len(captures) and all(r["blocked"] == (r["n_entries"] > 0) for r in got)


def fingerprint(text: str | None) -> int:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints: dict[int, int]) -> dict[int, int]:
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_simhash_equals_brute_force(spark):
    prepare(spark)
    docs = table(spark, SF, "documents")
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in docs.collect()}
    groups = components(prints)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {d: (f"{p:016x}", groups[d]) for d, p in prints.items()}


def write(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"{name}.parquet"))


def test_pipeline_equals_brute_force_stage_by_stage(spark, tmp_path):
    prepare(spark)
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    noise = " ".join(f"stone{i} river" for i in range(40))
    top = max(d[0] for d in docs)
    docs += [(top + 1, f"{noise} {items[0][1]} {noise}", "en", "s", 1), (top + 2, None, None, None, None), (top + 3, "", "en", "s", 0),
             (top + 4, docs[0][1], "en", "s", 1), (top + 5, (docs[1][1] or "") + " ", "en", "s", 1)]
    labels = [tuple(r) for r in table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()]
    write(spark, tmp_path, documents=(docs, DOCS), benchmark=(items, table(spark, SF, "benchmark").schema), labels=(labels, "doc_id long, quality int, toxic int"))
    sf = str(tmp_path)
    model = quality.learn(table(spark, sf, "documents"), table(spark, sf, "labels"))
    kept = [d for d in docs if model.score((d[1] or "").encode()) >= 0.5]

    groups: dict[str, tuple] = {}
    for d in kept:
        bare, rank = re.sub("[\x20\x09-\x0d]", "", d[1] or ""), (-len(d[1] or ""), d[0])
        if bare not in groups or rank < groups[bare][0]:
            groups[bare] = (rank, d)
    kept = [d for _, d in groups.values()]

    root = components({d[0]: fingerprint(d[1]) for d in kept})
    kept = [d for d in kept if root[d[0]] == d[0]]

    questions = [decontaminate.words_of(t) for _, t in items]
    leaks = lambda words: any(q and decontaminate.least_distance(q, words)[0] <= decontaminate.edits(len(q)) for q in questions)
    kept = [d for d in kept if not leaks(decontaminate.words_of(d[1]))]

    library = Tokenizer.from_file(PATH)
    want = {}
    for d in kept:
        ids = library.encode(d[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[d[0]] = (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert top + 1 not in got and got == want


def test_every_stage_takes_odd_and_empty_tables(spark, tmp_path):
    """Nulls, repeated rows, a clashing column and a table without rows."""
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x" * 200_000, "en", "s", 1), (3, "one two three", None, "s", 1)]
    write(spark, tmp_path, benchmark=([(None, None), (1, ""), (2, "one two three")], "item_id long, text string"),
          labels=([(1, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int"), documents=(rows, DOCS))
    sf = str(tmp_path)
    for data in (rows, []):
        docs = spark.createDataFrame([(*r, "k") for r in data], DOCS + ", _kept_id string")
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, sf)
            assert got.count() <= len(data), name
            if name != "bpe":
                assert got.columns == corpus_pipeline.COLUMNS
    kept = corpus_pipeline.decontaminate_filter(spark, spark.createDataFrame(rows, DOCS), sf).collect()
    assert sorted(repr(r["doc_id"]) for r in kept) == ["1", "1", "2", "None"]


@pytest.mark.parametrize("empty", [False, True])
def test_operators_take_clashing_columns_and_empty_tables(spark, empty):
    prepare(spark)
    texts = [None, "", "a b c d e f g", "a b c d e f g"]
    clash = ", ".join(f"{c} string" for c in ("h", "fp", "n_tokens", "kept", "rank", "score", "root", "key"))
    docs = spark.createDataFrame([] if empty else [(i, t, *"zzzzzzzz") for i, t in enumerate(texts)], f"doc_id long, text string, {clash}")
    pages = docs.selectExpr("doc_id as page_id", "concat('http://h.test/', doc_id) as url", "text as html", "h", "kept", "root")
    items = spark.createDataFrame([(7, "a b c d e")], "item_id long, text string")
    n = 0 if empty else len(texts)
    assert bpe.with_digests(bpe.encode_documents(docs, PATH)).count() == n
    assert token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json")).count() == n
    assert html_extract.main_texts(pages).count() == n
    assert warc.archived(pages).count() == n
    assert decontaminate.benchmark_leaks(docs, items).where("doc_id >= 2").count() == (0 if empty else 2)
    assert decontaminate.benchmark_leaks(docs, items.limit(0)).count() == 0
    assert exact_dedup.exact_duplicates(docs).where("kept").count() == (0 if empty else 2)
    assert substring_dedup.repeated_spans(docs, span_words=3).count() == (0 if empty else 1)
    assert simhash.near_duplicates(docs).count() == n
