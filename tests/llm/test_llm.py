"""The training-data operators against libraries, brute force and defined cases."""

from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeward.llm import bpe, decontaminate, exact_dedup, html_extract, simhash, substring_dedup, token_counts, warc
from lakeward.llm.common import prepare

ODD = [None, "", " \t\n", "a" * 3000, "  x  y ", "don't, I'LL", "x <|endoftext|> y", "naïve 中文 🙂", "tab\tand\nline  end "]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    texts = [*ODD, "the same text here", "the  same text here ", "other words stand in this one"]
    rows = [(i, t, "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, h string")


def test_bpe_equals_the_library(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for row in bpe.encode_documents(docs, path).join(docs.select("doc_id", "text"), "doc_id").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_token_counts_equal_the_library(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for row in token_counts.token_counts(docs, path).join(docs.select("doc_id", "text"), "doc_id").collect():
        text = row["text"] or ""
        assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert row["n_bytes"] == len(text.encode()) and row["over_limit"] == (row["n_tokens"] > 2048)


def test_exact_duplicates(spark, docs):
    got = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs.repartition(5)).collect()}
    assert got[10]["keep_id"] == 10 and not got[9]["kept"] and got[9]["group_size"] == 2
    assert got[2]["group_size"] == 3 and got[2]["kept"]  # null, empty and white space; most code points stay
    same = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "doc_id long, text string")
    assert sum(r["kept"] for r in exact_dedup.exact_duplicates(same).collect()) == 1
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_simhash_links_equal_brute_force(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(8):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    values = sorted(np.array(sorted(prints), np.uint64).view(np.int64).tolist())
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    for hot in (1, 64):  # with and without the finer key
        assert {tuple(r) for r in simhash.links(df, hot=hot).collect()} == want


def test_simhash_defined_cases(docs):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert got[0]["fingerprint"] == "0" * 16 and {got[i]["component_id"] for i in (0, 1, 2)} == {0}


def test_decontamination_finds_edited_passages():
    rng = random.Random(5)
    items = [" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) for n in (5, 12, 25, 40, 60) for _ in range(8)]
    index = decontaminate.Index(list(range(len(items))), items)
    texts, want = [], []
    for i in range(len(items)):
        words = items[i].split()
        for _ in range(decontaminate.edits(len(words))):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        noise = [f"n{rng.randrange(3000)}" for _ in range(80)]
        texts.append(" ".join([*noise[:40], *words, *noise[40:]]))
        want.append(i)
    texts += [" ".join(f"n{rng.randrange(3000)}" for _ in range(100)), None, ""]
    got = index.leaks(texts)
    assert np.mean([any(x["item"] == i for x in g) for g, i in zip(got, want)]) >= 0.9
    assert not any(got[-3:])


def test_warc_round_trip(spark):
    prepare(spark)
    bodies = [None, "", "same", "same", "x" * 200_000, "\x1f\x8b\x08" * 50] + [f"page {i} " * 40 for i in range(60)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", b) for i, b in enumerate(bodies)], "page_id long, url string, html string")
    rows = warc.decided(pages)
    from lakeward.session import scratch_path

    files = warc.write_archives(rows, scratch_path(spark, "warc-test"))
    got = {r["page_id"]: r for r in warc.read_archives(spark, files, split_bytes=700).collect()}
    assert sorted(got) == list(range(len(bodies)))
    assert got[2]["record_type"] == "revisit" and got[2]["refers_to"] == 3 and got[0]["refers_to"] == 1
    assert all(bytes(r["payload"]).decode() == (bodies[i] or "") for i, r in got.items() if r["record_type"] == "response")


def test_html_extraction():
    page = html_extract.Page(
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a>Menu</a></nav>"
        "<div class='ad'>Buy</div><article><h1>Head</h1><p>One &amp;  two<br>three<p>Four <b>bold</b></p>"
        "<div class='share'>Share</div></article><section id='comments'><p>Nice</p></section><footer>F</footer>")
    assert page.text(set()) == "Head\n\nOne & two three\n\nFour bold"
    assert html_extract.Page("").text(set()) == "" and html_extract.Page("plain").text(set()) == "plain"
    wrapper = html_extract.inferred([("h", f"<body><p>Fixed</p><p>v{i}</p></body>") for i in range(9)])["h"]
    assert html_extract.constants(wrapper) in (set(), {html_extract.mark("Fixed")})


def test_repeated_passages(spark):
    prepare(spark)
    rng = random.Random(9)
    say = lambda n: " ".join(" ".join(f"w{rng.randrange(4000)}" for _ in range(7)) + "." for _ in range(n))
    passage = say(9)
    rows = [(i, say(6) + (" " + passage if i % 4 == 0 else "")) for i in range(24)] + [(99, None), (100, "")]
    got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == {4, 8, 12, 16, 20} and {r["keep_doc_id"] for r in got} == {0}


def test_passages_inside_lines_to_their_ends(spark):
    prepare(spark)
    rng = random.Random(3)
    say = lambda n: [f"é{rng.randrange(10**6)}" for _ in range(n)]
    rows, wanted = [], {}
    for i, n in enumerate([23, 24, 25, 30, 51, 51, 51, 60, 80, 120] * 4):
        passage = say(n)
        for doc in (2 * i, 2 * i + 1):
            before = " ".join(say(60 + rng.randrange(60))) + " "
            text = " ".join(passage)
            rows.append((doc, before + text + " " + " ".join(say(60 + rng.randrange(60)))))
            if n >= 24 and doc % 2:
                wanted[doc] = (len(before), len(text), n, doc - 1)
    got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == wanted and len(got) == len(wanted)


def test_repeated_runs_against_brute_force(spark):
    prepare(spark)
    rng = random.Random(5)
    pool = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (24, 26, 31, 40, 55, 90)]
    rows = []
    for doc in range(60):
        words = []
        for _ in range(6):
            a = rng.choice(pool)
            at = rng.randrange(len(a))
            words += a[at : at + rng.randrange(5, 60)] + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(3))]
        rows.append((doc, rng.choice([" ", "\n", "  "]).join(words)))
    got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    seen: set[tuple] = set()
    for doc, text in rows:
        at = [m.start() for m in re.finditer(r"\S+", text)]
        words = text.split()
        runs = [tuple(words[i : i + 24]) for i in range(len(words) - 23)]
        needed = {p for i, r in enumerate(runs) if r in seen for p in at[i : i + 24]}
        told = {p for r in got if r["doc_id"] == doc for p in at if r["span_start"] <= p < r["span_start"] + r["span_chars"]}
        assert needed <= told
        seen.update(runs)


def test_runs_over_several_documents(spark):
    prepare(spark)
    rng = random.Random(7)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    one, middle, two = say(20) + ".", say(20) + ".", say(20) + "."
    rows = [(1, f"{say(30)}.\n{middle}\n{say(30)}."), (5, f"{say(30)}.\n{one}\n{middle}\n{two}"), (9, f"{one}\n{middle}\n{two}\n{say(30)}.")]
    got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["span_start"], r["n_words"], r["keep_doc_id"]) for r in got] == [(9, 0, 60, 1)]


def test_rows_that_repeat_an_id_and_null_ids(spark):
    prepare(spark)
    rng = random.Random(8)
    say = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(10)) + "."
    text = "\n".join(say() for _ in range(5))
    other = text + "\n" + say()
    rows = [(1, text), (2, text), (2, text), (2, other), (None, text), (None, other)]
    got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["span_start"], r["n_words"], r["keep_doc_id"]) for r in got) == [("2", 0, 50, 1)] * 2 + [("None", 0, 50, 1), ("None", 0, 60, 1)]
    alone = substring_dedup.repeated_spans(spark.createDataFrame([(None, text), (None, text)], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["n_words"], r["keep_doc_id"]) for r in alone] == [(None, 50, None)]


def test_wrapper_decides_in_pages_with_articles(spark):
    prepare(spark)
    say = lambda i: f"Own words of page {i} that no other page has."
    rows = [(i, f"http://h.test/{i}", f"<body><article><h1>News {i}</h1><p>{say(i)}</p><div>Share this</div></article></body>") for i in range(3)]
    rows += [(i, f"http://g.test/{i}", f"<body><main><p>Please wait</p></main><div><p>{say(i)}</p></div></body>") for i in (3, 4)]
    rows += [(i, "http://copies.test/", f"<body><article><h1>Title</h1><p>{say(9)}</p><p>Seen {i}</p></article></body>") for i in (5, 6)]
    got = {r["page_id"]: r["text"] for r in html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"News {i}\n\n{say(i)}" for i in range(3)) and all(got[i] == say(i) for i in (3, 4))
    assert all(got[i] == f"Title\n\n{say(9)}\n\nSeen {i}" for i in (5, 6))


@pytest.mark.parametrize("page, wanted", [
    ("<main><h1>Title</h1><p>Lead</p><article><p>Long main text</p></article></main>", "Title\n\nLead\n\nLong main text"),
    ("<article><h1>Title</h1><div itemprop=articleBody><p>Long main text</p></div></article>", "Title\n\nLong main text"),
    ("<article><p>First text</p></article><p>between</p><article><p>Second</p></article>", "First text\n\nSecond"),
    ("<div class='content has-sidebar'><article><p>Text</p></article></div><div class=sidebar>Side words</div>", "Text"),
    ("<div class='widget-area with-comments'><article><p>Text</p></article><div class=comments>C</div></div>", "Text"),
    ("<article><header class='entry-header'><h1>Title</h1></header><p>Text</p></article>", "Title\n\nText"),
    ("<article class='has-sidebar'><p>Text</p></article>", "Text"),
    ("<div class='has-sidebar'><p>Most of the text of this page</p></div><div class=ad>Buy</div>", "Most of the text of this page"),
    ("<article><p>Article text</p></article><section id=comments><article><p>Nice one</p></article></section>", "Article text"),
])
def test_articles_are_kept_whole(page, wanted):
    assert html_extract.Page(f"<body>{page}</body>").text(set()) == wanted


def constant_texts(pages):
    found = html_extract.constants(html_extract.inferred([("h", p) for p in pages])["h"])
    return [[t for t, m in zip(page.texts, page.marks()) if m in found] for page in map(html_extract.Page, pages)]


def test_wrappers_of_small_hosts_menus_and_long_pages():
    assert constant_texts([f"<body><p>Fixed</p><div>v{i}</div></body>" for i in range(2)]) == [["Fixed"]] * 2
    menu = "<ul>" + "".join(f"<li><a>{x}</a></li>" for x in ("Home", "About", "Help", "Jobs")) + "</ul>"
    pages = [f"<body>{menu}{''.join(f'<p>text {i} {k}</p>' for k in range(2 + i))}<div>Imprint</div></body>" for i in range(3)]
    assert constant_texts(pages) == [["Home", "About", "Help", "Jobs", "Imprint"]] * 3
    rng = random.Random(4)
    long = lambda i: "".join(f"<div class=c{k}>f{k}</div>" + (f"<p class=x{i}z{k}>own {i} {k}</p>" if rng.random() < 0.5 else "") for k in range(500))
    assert constant_texts([f"<body>{long(i)}</body>" for i in range(2)]) == [[f"f{k}" for k in range(500)]] * 2


@pytest.mark.parametrize("draws", [0, decontaminate.DRAWS])
def test_long_benchmark_items_reach_the_target_recall(monkeypatch, draws):
    monkeypatch.setattr(decontaminate, "DRAWS", draws)
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    items = [[word() for _ in range(800)] for _ in range(4)]
    texts = []
    for item in items * 12:
        copy = list(item)
        for _ in range(160):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join([word() for _ in range(30)] + copy + [word() for _ in range(30)]))
    index = decontaminate.Index(list(range(4)), [" ".join(i) for i in items])
    assert (index.sizes[0].tables is None) == (draws == 0)
    found = [any(x["item"] == n % 4 for x in leaks) for n, leaks in enumerate(index.leaks(texts))]
    assert sum(found) >= 0.97 * len(found) and (draws or all(found))
