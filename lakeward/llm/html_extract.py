"""Main text of web pages by wrapper inference (operator 3).

A page becomes a stream of tags and texts. Streams of one host are aligned one
after another into a wrapper, a union-free regular expression: adjacent repeats
fold into a group that may repeat, tags that only some streams have become an
optional group, and texts that differ become a slot, while a text that all of them
share stays as a constant. Wrappers are made in each partition, then merged in
rounds of eight partitions, so a host with a third of all pages is never gathered
anywhere; a wrapper is as large as a page's structure, not its host.

For every page, texts that the wrapper holds constant over all pages of the host (two at
least) are the host's, the others the page's own. In a repeated group those texts are
constant that each page has there. Where a host's pages are copies of each other, so
that constants are most of an article, they stay.

Tags and class words are hints within that: the main text is what stands in elements
named or marked as article or main, from the outermost on and all of them, if they hold
any of the page's own text, and else all of the body; without parts that are navigation,
headers, footers, asides, scripts or, by their class, id or role, adverts, notices,
comments and the like. A class name counts if all its words say so (``social-science`` doesn't).
Neither class words nor forms rule out an element that holds the page's
longest article or, where no article stands apart from it, over half of its text. In an
article, headings, paragraphs, list items and cells stay even where all pages share them. In
texts outside articles, ones that only some pages have are constant from
``CONSTANT_PAGES`` pages on.

End tags that HTML leaves out (of paragraphs, list items, cells) are implied.
Character references are decoded, white space inside a block becomes one space,
and blocks are joined in page order by two newlines.

Defined cases: null and empty html give an empty text; a page that is no markup is
one block; unclosed elements end with the page; a page without a url or host has
no wrapper; repeated rows get a row each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import html as markup
import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import cut, salted_lookup
from lakeward.llm.url_filters import host_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s<>\"']?[^\s<>]*+)|[\"'])*+)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW = re.compile(r"(script|style|noscript|template|textarea|title|iframe|svg|select|math)\Z", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
APART = frozenset("nav header footer aside form button dialog menu head input object canvas audio video".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion "
    "recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split())
#: Words that may stand beside those in a class name without changing what it means; with any
#: other word (social-science, related-work, has-sidebar) it names something else.
BESIDE_NAMES = frozenset(
    "area bar block body bottom box btn button buttons col column container content fixed form global group head inner item items layer left link "
    "links list main menu module nav outer overlay page panel post right row section site slot sticky strip text title top unit wrap wrapper zone".split())
MAIN_NAMES = frozenset("article main articlebody".split())
#: Elements whose texts are prose: in an article they stay although all pages of the host share them.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th caption figcaption blockquote pre summary".split())
#: End tags that HTML leaves out: what opens closes these, up to the elements that hold them.
BLOCKS = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: (members, what opens and closes the nearest member, what a member isn't closed across).
IMPLIED = (
    (("p",), BLOCKS, ("td", "th", "button", "object", "caption", "body")), (("li",), ("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dt", "dd"), ("dl",)),
    (("option",), ("option",), ("select",)), (("tr",), ("tr",), ("table",)), (("td", "th"), ("td", "th"), ("table", "tr")))
MEMBER, CLOSES, HOLDS = ({name: sum(1 << i for i, group in enumerate(IMPLIED) if name in group[k]) for group in IMPLIED for name in group[k]} for k in range(3))
#: Class words that an article's own parts may have.
OWN_NAMES = frozenset(["header"])
#: Marks of texts in articles lie above those of others; the mark that counts pages.
INSIDE, PAGES = 1 << 32, -1
FAN_IN_BITS = 3
#: Pages that must agree on a text that not all have, longest repeat that is tried, and
#: the size of the pieces that long alignments fall into.
CONSTANT_PAGES, LONGEST_REPEAT, ALIGN_CELLS = 8, 16, 1 << 20


def tokens(page: str):
    """("<", name, attributes, end), (">", name), ("t", text) in page order; what raw
    elements such as scripts hold is passed over."""
    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            break
        if found.start() > at:
            yield ("t", page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            yield (">", name)
        else:
            yield ("<", name, found[3])
            if RAW.match(name) and not found[0].endswith("/>"):
                close = re.compile(f"</{name}\\s*>", re.I).search(page, at)
                at = close.start() if close else len(page)
    if at < len(page):
        yield ("t", page[at:])


def names_of(attributes: str) -> tuple[set[str], set[str], set[str]]:
    """Words of class, id and role, those of them that name a part apart, and the values of
    role and itemprop."""
    words, apart, roles = set(), set(), set()
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() in ("class", "id", "role"):
            for one in value.split():
                own = {w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", one) if w}
                words |= own
                told = own & APART_NAMES
                if told and all(w in BESIDE_NAMES or not w.isalpha() for w in own - told):
                    apart |= told
        if name.lower() in ("role", "itemprop"):
            roles.add(value.lower())
    return words, apart, roles


class Page:
    """Texts of a page's body with what stands around them."""

    def __init__(self, page: str):
        self.stream: list[str] = []  # tags, and "#" for each text
        self.texts: list[str] = []
        self.block: list[int] = []  # of each text; a number for each block
        self.apart: list[bool] = []
        self.main: list[int] = []  # the outermost article that a text stands in, or -1
        self.path: list[int] = []  # hash of the tags around a text in its article, or 0
        self.prose: list[bool] = []
        # Of each element: name, parent, ruled out by tag, by class words, an article, outermost article, path.
        nodes: list[tuple[str, int, bool, bool, bool, int, int]] = [("", -1, False, False, False, -1, 0)]
        stack, owner, block = [0], [], 0
        opened = Counter({"": 1})  # names on the stack
        scope = [0]  # of each element on the stack, a bit for each group of IMPLIED that has an open member in reach
        for token in tokens(page):
            at = stack[-1]
            if token[0] == "t":
                if not token[1].isspace():
                    self.stream.append("#")
                    self.texts.append(token[1])
                    self.block.append(block)
                    owner.append(at)
                elif self.texts and self.block[-1] == block and nodes[owner[-1]][2] == nodes[at][2]:
                    self.texts[-1] += " "
                continue
            name = token[1]
            block += name not in INLINE
            if token[0] == ">":
                self.stream.append(f"/{name}")
                while opened[name]:
                    last = nodes[stack.pop()][0]
                    scope.pop()
                    opened[last] -= 1
                    if last == name:
                        break
                continue
            implied = scope[-1] & CLOSES.get(name, 0)
            while scope[-1] & implied:
                last = nodes[stack.pop()][0]
                scope.pop()
                opened[last] -= 1
                implied &= ~MEMBER.get(last, 0)
            at = stack[-1]
            words, told, roles = names_of(token[2]) if token[2] else (set(), set(), set())
            self.stream.append(".".join([name, *sorted(words)]))
            if name == "br" and self.texts and self.block[-1] == block:
                self.texts[-1] += " "
            if name in VOID:
                continue
            main = nodes[at][5]
            marked = name in ("article", "main") or bool(roles & MAIN_NAMES)
            # A header inside an article is the article's own.
            out = nodes[at][2] or bool(RAW.match(name)) or (name in APART and name != "form" and not (main >= 0 and name == "header"))
            named = name not in ("html", "body") and (name == "form" or bool(told - (OWN_NAMES if main >= 0 else set())))
            if main < 0 and marked:
                main = len(nodes)
            nodes.append((name, at, out, named, marked, main, zlib.crc32(name.encode(), nodes[at][6]) if main >= 0 else 0))
            stack.append(len(nodes) - 1)
            opened[name] += 1
            scope.append(scope[-1] & ~HOLDS.get(name, 0) | MEMBER.get(name, 0))
        sizes = [0] * len(nodes)
        for text, at in zip(self.texts, owner):
            if not nodes[at][2]:
                sizes[at] += len(text)
        for at in range(len(nodes) - 1, 0, -1):
            sizes[nodes[at][1]] += sizes[at]
        ruled = self.ruled_out(nodes, sizes)
        for at in owner:
            self.apart.append(nodes[at][2] or ruled[at])
            self.main.append(nodes[at][5])
            self.path.append(nodes[at][6])
            while nodes[at][0] in INLINE:
                at = nodes[at][1]
            self.prose.append(nodes[at][0] in PROSE)

    @staticmethod
    def ruled_out(nodes: list, sizes: list[int]) -> list[bool]:
        """Which elements class words rule out, with all that they hold."""
        last = list(range(len(nodes)))  # the last element inside each
        for at in range(len(nodes) - 1, 0, -1):
            last[nodes[at][1]] = max(last[nodes[at][1]], last[at])
        marked = [at for at in range(1, len(nodes)) if nodes[at][4] and sizes[at]]
        longest = sorted(marked, key=lambda m: -sizes[m])
        ruled = [False] * len(nodes)
        for at in range(1, len(nodes)):
            ruled[at] = ruled[nodes[at][1]]
            if ruled[at] or not nodes[at][3]:
                continue
            within = next((sizes[m] for m in longest if at <= m <= last[at]), 0)
            beside = next((sizes[m] for m in longest if m > last[at] or last[m] < at), 0)
            ruled[at] = beside >= within if beside else not within and 2 * sizes[at] <= sizes[0]
        return ruled

    def marks(self) -> list[int]:
        """Of each text, a number that equal texts of other pages share, in articles if they stand alike."""
        return [INSIDE + zlib.crc32(" ".join(t.split()).encode(), path) if main >= 0 else mark(t)
                for t, main, path in zip(self.texts, self.main, self.path)]

    def text(self, constant: set[int]) -> str:
        """The main text; ``constant`` are the texts that the host's wrapper fixes."""
        size = lambda some: sum(len(self.texts[i]) for i in some)
        kept = [i for i, apart in enumerate(self.apart) if not apart]
        inside = [i for i in kept if self.main[i] >= 0]
        if inside and set(inside) <= constant and not set(kept) - set(inside) <= constant:
            inside = []  # a region that is the host's: what varies stands elsewhere
        if inside:
            kept = inside
            # The article's own headings and paragraphs stay, whatever other pages have, and so does
            # the rest where it is most of the article: the pages are copies of each other.
            constant = {i for i in constant.intersection(inside) if not self.prose[i]}
            if 2 * size(constant) > size(inside):
                constant = set()
        if not set(kept) <= constant:
            kept = [i for i in kept if i not in constant]
        blocks: dict[int, list[str]] = {}
        for i in kept:
            blocks.setdefault(self.block[i], []).append(self.texts[i])
        clean = [" ".join(markup.unescape("".join(parts)).split()) for parts in blocks.values()]
        return "\n\n".join(c for c in clean if c)


# A wrapper is a list of items: a tag is a string; a text is ["#", constant or None,
# pages]; a repeated group ["+", items, marks that all pages have there, pages]; an
# optional group ["?", items]. A text between "^" and "$" at the start counts the pages.


def shape(item) -> str:
    """An item's structure without its texts."""
    if isinstance(item, str):
        return item
    return "#" if item[0] == "#" else item[0] + "(" + " ".join(map(shape, item[1])) + ")"


def slotted(items: list) -> list:
    """The items with all texts open."""
    return [i if isinstance(i, str) else ["#", None, i[2]] if i[0] == "#" else [i[0], slotted(i[1]), *([[], i[3]] if i[0] == "+" else [])] for i in items]


def held(items: list) -> set[int]:
    """Marks that all pages have in these items."""
    return {m for i in items if not isinstance(i, str) and i[0] != "?" for m in ([i[1]] if i[0] == "#" else i[2]) if m is not None}


def seen(items: list) -> int:
    """Pages that have texts in these items."""
    return max((i[2] if i[0] == "#" else i[3] if i[0] == "+" else seen(i[1]) for i in items if not isinstance(i, str)), default=0)


def group(body: list, run: list) -> list:
    """A repeated group for a run that repeats ``body``."""
    return ["+", slotted(body), sorted(held(run)), seen(run)]


def numbered(shapes: list[str]) -> np.ndarray:
    """Shapes as numbers; a text is -1."""
    numbers = {"#": -1}
    return np.fromiter([numbers.setdefault(x, len(numbers)) for x in shapes], np.int32, len(shapes))


def repeats(ids: np.ndarray, width: int) -> bool:
    """Whether any run of this width is followed by itself (single texts don't count)."""
    if len(ids) < 2 * width:
        return False
    same = ids[:-width] == ids[width:]
    if width == 1:
        return bool((same & (ids[1:] >= 0)).any())
    if np.count_nonzero(same) < width:
        return False
    ends = np.cumsum(same)
    return bool(ends[width - 1] == width or (ends[width:] - ends[:-width] == width).any())


def folded(items: list) -> list:
    """Adjacent repeats as one repeated group each, shortest repeats first."""
    shapes = [shape(i) for i in items]
    ids = numbered(shapes)
    for width in range(1, LONGEST_REPEAT + 1):
        if not repeats(ids, width):
            continue
        out, at = [], 0
        while at < len(items):
            unit = shapes[at : at + width]
            if unit in (["#"], []) or len(unit) < width:
                out.append(items[at])
                at += 1
                continue
            n = 1
            while shapes[at + n * width : at + (n + 1) * width] == unit:
                n += 1
            if n > 1:
                body = items[at : at + width]
                out.append(group(body[0][1] if width == 1 and body[0][0] == "+" else body, items[at : at + n * width]))
                at += n * width
            else:
                out.append(items[at])
                at += 1
        items, shapes = out, [shape(i) for i in out]
        ids = numbered(shapes)
    return items


def bodies(items: list) -> dict[str, list]:
    """The written-out form of every repeated group in the items."""
    out: dict[str, list] = {}
    for item in items:
        if not isinstance(item, str) and item[0] != "#":
            out.update(bodies(item[1]))
            if item[0] == "+":
                out[" ".join(map(shape, item[1]))] = item[1]
    return out


def regrouped(items: list, known: dict[str, list]) -> list:
    """Runs that elsewhere repeat as repeated groups too, from the longest on, and
    groups beside an optional copy of themselves as one."""
    for form, body in sorted(known.items(), key=lambda kv: (-len(kv[1]), kv[0])):
        shapes, out, at, width = [shape(i) for i in items], [], 0, len(body)
        while at < len(items):
            if " ".join(shapes[at : at + width]) == form:
                out.append(group(items[at : at + width], items[at : at + width]))
                at += width
            else:
                out.append(items[at])
                at += 1
        items = out
    out = []
    for item in items:
        if out and not isinstance(item, str) and item[0] == "?" and len(item[1]) == 1 and shape(item[1][0]) == shape(out[-1]) and out[-1][0] == "+":
            continue
        if out and not isinstance(out[-1], str) and out[-1][0] == "?" and len(out[-1][1]) == 1 and shape(out[-1][1][0]) == shape(item) and item[0] == "+":
            out.pop()
        out.append(item)
    return out


def settled(items: list, known: dict[str, list] | None = None) -> list:
    """Fold and regroup until nothing changes."""
    for _ in range(6):
        before = len(items)
        items = folded(items)
        items = folded(regrouped(items, {**bodies(items), **(known or {})}))
        if len(items) == before:
            break
    return items


def joined(a, b):
    """Two items of equal structure as one."""
    if isinstance(a, str):
        return a
    if a[0] == "#":
        return ["#", a[1] if a[1] == b[1] else None, a[2] + b[2]]
    body = [joined(x, y) for x, y in zip(a[1], b[1])]
    return [a[0], body] if a[0] == "?" else ["+", body, sorted(set(a[2]) & set(b[2])), a[3] + b[3]]


def absorbed(a: list, run: list) -> list:
    """A group and a run that is its body written out once, as one group."""
    body = [joined(x, y) for x, y in zip(a[1], run)]
    return [a[0], body] if a[0] == "?" else ["+", body, sorted(set(a[2]) & held(run)), a[3] + seen(run)]


def optional(items: list) -> list:
    """The items as one optional group; single optional groups stay as they are."""
    return items if not items or len(items) == 1 and items[0][0] == "?" else [["?", [x for i in items for x in (i[1] if i[0] == "?" else [i])]]]


def runs_of(items: list) -> list:
    """(item, body) pairs: what an item matches when written out once."""
    return [shape(i) if isinstance(i, str) or i[0] == "#" else " ".join(map(shape, i[1])) for i in items]


def halves(a: list, b: list) -> tuple[int, int]:
    """Where a longest common subsequence passes the middle of a (Hirschberg)."""
    ids = numbered([shape(i) for i in a + b])
    x, y, middle = ids[: len(a)], ids[len(a) :], len(a) // 2

    def lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int32)
        for item in x:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (y == item)))
        return row

    return middle, int(np.argmax(lengths(x[:middle], y) + lengths(x[middle:][::-1], y[::-1])[::-1]))


def aligned(a: list, b: list) -> list:
    """One wrapper for both: equal structure is joined, the rest becomes optional. A
    repeated or optional group also matches its body written out once."""
    lead = 0
    while lead < min(len(a), len(b)) and shape(a[lead]) == shape(b[lead]):
        lead += 1
    head = [joined(x, y) for x, y in zip(a[:lead], b[:lead])]
    a, b = a[lead:], b[lead:]
    tail = 0
    while tail < min(len(a), len(b)) and shape(a[-1 - tail]) == shape(b[-1 - tail]):
        tail += 1
    foot = [joined(x, y) for x, y in zip(a[len(a) - tail :], b[len(b) - tail :])]
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return head + optional(a) + optional(b) + foot
    if len(a) * len(b) > ALIGN_CELLS and len(a) > 1:
        i, j = halves(a, b)
        return head + aligned(a[:i], b[:j]) + aligned(a[i:], b[j:]) + foot
    sa, sb = [shape(i) for i in a], [shape(i) for i in b]
    ra, rb = runs_of(a), runs_of(b)
    la = [0 if isinstance(i, str) or i[0] == "#" else len(i[1]) for i in a]
    lb = [0 if isinstance(i, str) or i[0] == "#" else len(i[1]) for i in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    step = [[""] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            value, way = max((best[i + 1][j], "a"), (best[i][j + 1], "b"))
            if sa[i] == sb[j] and best[i + 1][j + 1] + 1 > value:
                value, way = best[i + 1][j + 1] + 1, "="
            if la[i] and j + la[i] <= len(b) and " ".join(sb[j : j + la[i]]) == ra[i] and best[i + 1][j + la[i]] + la[i] > value:
                value, way = best[i + 1][j + la[i]] + la[i], ">"
            if lb[j] and i + lb[j] <= len(a) and " ".join(sa[i : i + lb[j]]) == rb[j] and best[i + lb[j]][j + 1] + lb[j] > value:
                value, way = best[i + lb[j]][j + 1] + lb[j], "<"
            best[i][j], step[i][j] = value, way
    out, i, j, only_a, only_b = [], 0, 0, [], []
    while i < len(a) or j < len(b):
        way = step[i][j] if i < len(a) and j < len(b) else "a" if i < len(a) else "b"
        if way == "a":
            only_a.append(a[i])
            i += 1
            continue
        if way == "b":
            only_b.append(b[j])
            j += 1
            continue
        out += optional(only_a) + optional(only_b)
        only_a, only_b = [], []
        if way == "=":
            out.append(joined(a[i], b[j]))
            i, j = i + 1, j + 1
        elif way == ">":
            out.append(absorbed(a[i], b[j : j + la[i]]))
            i, j = i + 1, j + la[i]
        else:
            out.append(absorbed(b[j], a[i : i + lb[j]]))
            i, j = i + lb[j], j + 1
    return head + out + optional(only_a) + optional(only_b) + foot


def combined(a: list, b: list) -> list:
    """The wrapper of two wrappers, as short as folding makes it."""
    out = aligned(a, b)
    return out if len(out) == len(a) else settled(out)


def mark(text: str) -> int:
    return zlib.crc32(" ".join(text.split()).encode())


def page_items(page: Page) -> list:
    marks = iter(page.marks())
    return ["^", ["#", PAGES, 1], "$", *(["#", next(marks), 1] if t == "#" else t for t in page.stream)]


def constants(wrapper: list) -> set[int]:
    """Marks of the texts that the wrapper holds constant over all pages, or, outside
    articles, over enough of them."""
    n = wrapper[1][2] if wrapper[:1] == ["^"] else 0

    def found(items: list) -> set[int]:
        out: set[int] = set()
        for item in items:
            if isinstance(item, str):
                continue
            if item[0] == "?":
                out |= found(item[1])
            else:
                pages = seen([item])
                out |= {m for m in held([item]) if 2 <= n <= pages or m < INSIDE and pages >= CONSTANT_PAGES}
                if item[0] == "+":
                    out |= found(item[1])
        return out

    return found(wrapper) - {PAGES}


def inferred(pages) -> dict:
    """host -> wrapper of (host, html) pairs."""
    wrappers: dict[str, list] = {}
    for host, page in pages:
        wrapper = wrappers.get(host)
        items = settled(page_items(Page(page)), bodies(wrapper) if wrapper else None)
        wrappers[host] = combined(wrapper, items) if wrapper else items
    return wrappers


def wrappers_of(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of (host, html) rows; the wrapper is JSON."""
    schema = "host string, slot int, wrapper string"

    def induce(batches):
        from pyspark import TaskContext

        rows = ((h, x) for b in batches for h, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        found = inferred((h, x) for h, x in rows if h and x)
        slot = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"host": list(found), "slot": pa.array([slot] * len(found), pa.int32()), "wrapper": [json.dumps(w) for w in found.values()]},
            schema=pa.schema([("host", pa.string()), ("slot", pa.int32()), ("wrapper", pa.string())]))

    def merge(batches):
        held = None
        for batch in batches:
            for host, slot, wrapper in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[:2] == (host, slot):
                    held = (host, slot, combined(held[2], json.loads(wrapper)))
                else:
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]], pa.int32()), pa.array([json.dumps(held[2])])], names=["host", "slot", "wrapper"])
                    held = (host, slot, json.loads(wrapper))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]], pa.int32()), pa.array([json.dumps(held[2])])], names=["host", "slot", "wrapper"])

    found = cut(pages.select("host", "html").mapInArrow(induce, schema), "wrappers")
    last = found.agg(F.max("slot")).first()[0] or 0
    while last:
        last >>= FAN_IN_BITS
        found = found.withColumn("slot", F.shiftright("slot", FAN_IN_BITS)).repartition("host", "slot").sortWithinPartitions("host", "slot").mapInArrow(merge, schema)
    return found.select("host", "wrapper")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text), one row per page."""

    @F.arrow_udf("string")
    def extract(htmls: pa.Array, wrappers: pa.Array) -> pa.Array:
        known: dict[str, set[int]] = {}
        out = []
        for body, wrapper in zip(htmls.to_pylist(), wrappers.to_pylist()):
            page = Page(body or "")
            fixed: set[int] = set()
            if wrapper:
                if wrapper not in known:
                    known[wrapper] = constants(json.loads(wrapper))
                fixed = {i for i, m in enumerate(page.marks()) if m in known[wrapper]}
            out.append(page.text(fixed))
        return pa.array(out, pa.string())

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"),
                        F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host")).withColumn("_spread", F.xxhash64("page_id", "url"))
    met = salted_lookup(rows, wrappers_of(rows), ["host"], "_spread")
    return met.select("page_id", "url", extract("html", "wrapper").alias("text"))
