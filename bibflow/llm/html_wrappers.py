"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over tags and text slots:
sequence, optional ``( )?`` and repeated ``( )+`` groups, no alternatives.

Inference.  A page is read as a balanced stream of block tags (named by tag,
class and id) and text slots, and the page's own expression is formed; streams
of the same host are then aligned with the host's expression one after another.
Aligning the contents of two elements resolves each mismatch in order: a tag
that recurs next to itself becomes a repeated group, a tag that only one side
has becomes optional, tags that come in another order become one repeated group
of optional tags, and different strings at the same place become a text slot
(a string that never differs stays a fixed string).  In this form a tag occurs
once in the content of its parent, so a slot is named by its path, the size of a
wrapper depends on the template and not on the number of pages, and two wrappers
merge like two streams.  Tasks align their own pages and emit one wrapper per
host; these are merged in two levels, so a host with very many pages is never one group.

Extraction.  A host's slots are judged once: slots inside menus, headers,
footers, side bars, notices, adverts, forms and comments (elements with such a
tag, class name, or first or last word of a class name) are left out; the
article's other slots are the main text, fixed strings included.  On pages
without an article, the element that holds nearly all varying text of the body
counts as one, and of what stands outside it fixed strings (inside repeated
groups too) and link lists go.  Names are weighed against the text: one word of
a class name leaves out no element with most of a host's varying text; where
whole names would leave out nearly all of it, neither do they, and an article
with little of the text is part of the body.  All pages are then read again and
the kept slots' texts joined block by block.

Elements more than ``MAX_DEPTH`` deep are read as part of the last one above
that depth: their text stays.  An element of ``HIDDEN`` that is never closed hides
nothing, one of ``RAW`` all that follows.

Null html counts as empty and gives an empty text; a url without a host belongs
to host ''; pages that no rule matches give an empty text; repeated rows are
separate pages; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bibflow.llm.common import clean_name, materialize
from bibflow.session import ship_package

#: Pages with different main content that must agree before a string counts as fixed.
FIXED_PAGES = 5
LINK_SHARE = 0.5
#: Names are not believed if they leave less than this share of a host's text.
LITTLE = 0.2
#: An element with this share of the body's varying text holds the main text.
NEARLY_ALL = 0.9
#: Elements deeper than this add no level to a path.
MAX_DEPTH = 256
MERGE_FAN = 256
#: Wrappers a task holds before it emits them.
MAX_HOSTS = 5_000

# HTML element kinds, and words that name parts of a page in class, id and role.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle "
             "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe".split())
HIDDEN = set("noscript template svg object canvas audio video select annotation".split())
LEFT_OUT = set("nav header footer aside form button dialog menu fieldset head".split())
LEFT_OUT_WORDS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar "
                     "navigation breadcrumb breadcrumbs header masthead footer sidebar aside widget notice notices cookie cookies "
                     "consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related "
                     "recommended comment comments disqus respond reply replies contentinfo complementary search form toolbar".split())
ARTICLE_WORDS = set("article post entry story".split())
NO_PART_WORDS = set("no not non has had with without hide hidden show is category cat tag type format status layout".split())
CONTAINERS = set("div section main center form table tbody tr td fieldset dl ul ol aside".split())
CLOSES_P = set("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
               "h5 h6 header hr li main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = set("ul ol dl table td th article section div aside nav main body".split())

#: Quotes count after "=" only, and no part is tried twice, so that stray quotes cost one pass.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*+)(?P<attrs>(?:[^<>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?/][^<>]*+>|<[A-Za-z][^<>]*+>|(?P<text>[^<]++|<)", re.S)
CLOSING = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in RAW | HIDDEN}
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Tags that are left out whatever they hold; others (a form around the page) only if most of the text is elsewhere.
SURE = set("nav header footer aside button menu head".split())
#: Variable parts of ids ("post-1234") would make every page its own template.
DIGITS = re.compile(r"\d+")


def key_of(tag: str, attrs: str) -> str:
    names = [DIGITS.sub("", next(v for v in m.groups()[1:] if v is not None)).strip().lower() for m in NAMES.finditer(attrs)]
    return ".".join([tag, *sorted({w for n in names for w in n.split()})])


def blocks(source: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path of open block elements, text, characters inside links) of every block, in page order.

    Also yields each opened element with text ``None``.
    """
    stack: list[str] = []
    tags: list[str] = []
    text: list[str] = []
    link = linked = 0

    at_once: Counter[str] = Counter()  # open elements by tag
    unclosed: set[str] = set()
    pos, size = 0, len(source)

    def flush() -> Iterator[tuple[tuple[str, ...], str, int]]:
        nonlocal linked
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            yield tuple(stack[:MAX_DEPTH]), joined, min(linked, len(joined))
        linked = 0

    def close(tag: str, scope: set[str]) -> None:
        """Close the innermost ``tag`` unless an element of ``scope`` is open in it."""
        n = len(tags) - 1
        while tags[n] != tag:
            if tags[n] in scope:
                return
            n -= 1
        at_once.subtract(tags[n:])
        del tags[n:], stack[n:]

    while pos < size:
        m = TOKEN.match(source, pos)
        pos = m.end()
        raw = m["text"]
        if raw is not None:
            raw = entities.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if link:
                linked += len(raw)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag == "a":
            link = 0 if m["end"] else 1
            continue
        if tag in INLINE or (tag in VOID and tag != "hr"):
            continue
        if tag in CLOSING:
            if not m["end"] and tag not in unclosed and not (tag in HIDDEN and m["attrs"].endswith("/")):
                shut = CLOSING[tag].search(source, pos)
                if shut or tag in RAW:
                    pos = shut.end() if shut else size
                else:
                    unclosed.add(tag)
            continue
        yield from flush()
        if tag == "hr":
            continue
        if m["end"]:
            if at_once[tag]:
                close(tag, SCOPE if tag == "p" else set())
            continue
        link = 0
        if tag in CLOSES_P and at_once["p"]:
            close("p", SCOPE)
        for same in CLOSES_SAME.get(tag, ()):
            if at_once[same]:
                close(same, SCOPE - {same})
        if m["attrs"].endswith("/") and tag not in CLOSES_P:
            continue
        tags.append(tag)
        at_once[tag] += 1
        stack.append(key_of(tag, m["attrs"]))
        if len(stack) <= MAX_DEPTH:
            yield tuple(stack), None, 0
    yield from flush()


# ---- wrappers -------------------------------------------------------------------------------------------------------
# An element is [order, flags, slot, children]: the keys of its children in order, a flag string per child
# ("+" repeated, "?" optional), its text slot or None, and the child elements.  The order None stands for one repeated
# group of optional children.  A slot is [contents, characters, characters in links, fixed string's checksum or None, blocks]:
# blocks holds the checksums of the blocks that all pages have there (a repeated slot may have fixed ones among others), and
# contents those of up to FIXED_PAGES distinct main contents of these pages, so copies of a page count once however they are
# dealt out; a slot without common blocks needs none.


def new_element() -> list:
    return [[], {}, None, {}]


def checksum(text: str) -> int:
    return crc32(text.encode("utf-8", "surrogatepass"))


def page_wrapper(source: str) -> tuple[list, int]:
    """A page's own expression, and a checksum of its longest block (outside the parts left out, if it has one there)."""
    root = new_element()
    runs: dict[tuple, list[str]] = {}
    slots: dict[tuple, list] = {}
    longest = other = ""
    opened: list[tuple] = []
    for path, text, linked in blocks(source):
        if text is None:
            opened.append(path)
            continue
        s = slots.setdefault(path, [None, 0, 0, 0, set()])
        s[1] += len(text)
        s[2] += linked
        own = checksum(text)
        s[3] = crc32(own.to_bytes(4, "little"), s[3])
        s[4].add(own)
        if len(text) > len(longest):
            if judge(path):
                longest = text
            elif len(text) > len(other):
                other = text
    content = checksum(longest or other)
    for path in opened:
        runs.setdefault(path[:-1], []).append(path[-1])
    for parent in sorted(runs, key=len):
        element = at(root, parent)
        order: list[str] = []
        mixed = False
        for k in runs[parent]:
            if order and order[-1] == k:
                element[1][k] = "+"  # a square: the tag recurs next to itself
            elif k in order:
                mixed = True  # it recurs later: one repeated group of optional tags
            else:
                order.append(k)
                element[1].setdefault(k, "")
                element[3].setdefault(k, new_element())
        element[0] = order
        if mixed:
            element[0], element[1] = None, dict.fromkeys(order, "?")
    for path, s in slots.items():
        s[0], s[4] = [content], sorted(s[4])
        at(root, path)[2] = s
    return root, content


def at(root: list, path: tuple[str, ...]) -> list:
    for k in path:
        root = root[3].setdefault(k, new_element())
    return root


def contents(a: list[int], b: list[int]) -> list[int]:
    """Distinct checksums of both; any FIXED_PAGES of them are enough."""
    if len(a) >= FIXED_PAGES or a == b:
        return a
    return b if len(b) >= FIXED_PAGES else sorted({*a, *b})[:FIXED_PAGES]


def align(a: list, b: list) -> list:
    """The expression that matches all that ``a`` or ``b`` match."""
    if a[2] is None or b[2] is None:
        slot = a[2] or b[2]
    else:
        x, y = a[2], b[2]
        same = x[3] is not None and x[3] == y[3]
        common = x[4] if x[4] == y[4] else sorted({*x[4]} & {*y[4]})
        slot = [contents(x[0], y[0]) if common else [], x[1] + y[1], x[2] + y[2], x[3] if same else None, common]
    children = dict(a[3])
    for k, child in b[3].items():
        children[k] = align(children[k], child) if k in children else child
    flags = {}
    for k in children:
        plus = "+" if "+" in a[1].get(k, "") + b[1].get(k, "") else ""
        missing = k not in a[3] or k not in b[3] or "?" in a[1].get(k, "") + b[1].get(k, "")
        flags[k] = plus + ("?" if missing else "")
    order = None
    if a[0] is not None and b[0] is not None:
        common = [k for k in a[0] if k in b[3]]
        if common == [k for k in b[0] if k in a[3]]:
            order, i, j = [], 0, 0
            for k in [*common, None]:  # optional tags of either side stand before the next common one
                while i < len(a[0]) and a[0][i] != k:
                    order.append(a[0][i])
                    i += 1
                while j < len(b[0]) and b[0][j] != k:
                    order.append(b[0][j])
                    j += 1
                if k is not None:
                    order.append(k)
                    i, j = i + 1, j + 1
    if order is None:
        flags = dict.fromkeys(children, "?")
    return [order, flags, slot, children]


def expression(element: list) -> str:
    """The wrapper as text: ``#`` is a slot, ``"..."`` a fixed string."""
    order, flags, slot, children = element
    out = "" if slot is None else ("#" if slot[3] is None else '"..."')
    parts = []
    for k in order if order is not None else children:
        inner = f"<{k}>{expression(children[k])}</{k.split('.')[0]}>"
        f = flags.get(k, "")
        inner = f"({inner})+" if "+" in f else inner
        parts.append(f"({inner})?" if "?" in f else inner)
    body = "".join(parts)
    return out + (f"({body})+" if order is None else body)


def slots_of(element: list, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], list]]:
    if element[2] is not None:
        yield path, element[2]
    for k, child in element[3].items():
        yield from slots_of(child, (*path, k))


def names_in(key: str) -> set[str]:
    return {name.strip("-_") for name in key.split(".")[1:]}


def is_article(key: str) -> bool:
    tag = key.split(".")[0]
    return tag == "article" or (tag not in ("html", "body") and bool(names_in(key) & ARTICLE_WORDS))


def part_named(key: str, inside: bool) -> str:
    """Whether the names of an element call it a part to leave out: by a 'whole' name, a 'word' of one, or ''."""
    if key.split(".")[0] in ("html", "body"):
        return ""
    own = LEFT_OUT_WORDS - {"header"} if inside else LEFT_OUT_WORDS  # an article's own head is part of it
    names = names_in(key)
    if names & own:
        return "whole"
    if is_article(key):
        return ""
    for name in names:
        words = [w for w in re.split("[-_]+", name) if w]
        if len(words) > 1 and words[0] not in NO_PART_WORDS and (words[0] in own or words[-1] in own) and not (
                words[-1] == "header" and words[0] in ARTICLE_WORDS):
            return "word"
    return ""


NOTHING: frozenset[tuple[str, ...]] = frozenset()


def judge(path: tuple[str, ...], large: frozenset[tuple[str, ...]] = NOTHING, most: frozenset[tuple[str, ...]] = NOTHING) -> str:
    """'article', 'body' or '' (left out); names leave out no element in ``large``, single words of names none in ``most``."""
    inside = False
    for n, k in enumerate(path, 1):
        tag = k.split(".")[0]
        named = "whole" if tag in LEFT_OUT - SURE else part_named(k, inside)
        if named and path[:n] not in (large if named == "whole" else most):
            return ""
        if tag in SURE and not (tag == "header" and inside):
            return ""
        inside = inside or is_article(k) or tag == "main"
    return "article" if inside else "body"


def held_by(chars: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], int]:
    """Characters inside every element."""
    out: dict[tuple[str, ...], int] = {}
    for path, n in chars.items():
        for k in range(1, len(path) + 1) if n else ():
            out[path[:k]] = out.get(path[:k], 0) + n
    return out


def kept_slots(wrapper: list) -> dict[str, list]:
    """Path -> ['article' or 'body', checksums of its fixed blocks] for the slots of the main text."""
    slots = dict(slots_of(wrapper))
    fixed = {path for path, slot in slots.items() if slot[3] is not None and len(slot[0]) >= FIXED_PAGES}
    own = {path: 0 if path in fixed else slot[1] - slot[2] for path, slot in slots.items()}  # varying characters outside links
    inner = {path: n for path, n in own.items() if not any(k.split(".")[0] in SURE for k in path)}
    total = sum(inner.values())
    most = frozenset(path for path, n in held_by(inner).items() if 2 * n > total)

    def choose(large: frozenset[tuple[str, ...]]) -> dict[tuple[str, ...], str]:
        return {path: w for path in slots if (w := judge(path, large, most))}

    where = choose(NOTHING)
    if sum(own[path] for path in where) < LITTLE * total:
        where = choose(most)
    if sum(own[path] for path, w in where.items() if w == "article") < LITTLE * sum(own[path] for path in where):
        where = dict.fromkeys(where, "body")
    body = {path: own[path] for path, w in where.items() if w == "body"}
    holds = [path for path, n in held_by(body).items()
             if n >= NEARLY_ALL * sum(body.values()) and path[-1].split(".")[0] in CONTAINERS]
    holder = max(holds, key=len, default=None)
    out = {}
    for path, w in where.items():
        contents, chars, linked, _, common = slots[path]
        if w == "article" or (holder and path[:len(holder)] == holder):
            out["\n".join(path)] = [w, []]
        elif path not in fixed and linked <= LINK_SHARE * chars:
            out["\n".join(path)] = [w, common if len(contents) >= FIXED_PAGES else []]
    return out


def main_text(source: str, kept: dict[str, list]) -> str:
    """The kept slots' blocks: the article's if the page has any, else the body's.

    A path that the host's wrapper has not seen is left out; wrappers are
    inferred from all pages, so their own pages have none.
    """
    found: dict[str, list[str]] = {"article": [], "body": []}
    for path, text, _ in blocks(source):
        if text is not None:
            where, fixed = kept.get("\n".join(path), ("", ()))
            if where and not (fixed and checksum(text) in fixed):
                found[where].append(text)
    return "\n\n".join(found["article"] or found["body"])


# ---- Spark ----------------------------------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, pages, wrapper as JSON, expression), one row per host, written to the shared folder."""
    ship_package(pages.sparkSession)
    rows = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").cast("string").alias("html"))
    schema = "host string, part int, pages bigint, wrapper string"

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % MERGE_FAN
        held: dict[str, list] = {}  # host -> [pages, wrapper]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([part] * len(held), pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()),
                 pa.array([json.dumps(v[1]) for v in held.values()])], names=["host", "part", "pages", "wrapper"])

        for batch in batches:
            for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                own, _ = page_wrapper(source or "")
                got = held.get(host)
                if got is None:
                    held[host] = [1, own]
                    if len(held) > MAX_HOSTS:
                        yield out()
                        held = {}
                    continue
                got[0] += 1
                got[1] = align(got[1], own)
        if held:
            yield out()

    def merge(keys: list[str]):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            wrapper = None
            for w in pdf["wrapper"]:
                w = json.loads(w)
                wrapper = w if wrapper is None else align(wrapper, w)
            row = {k: pdf[k].iloc[0] for k in keys} | {"pages": int(pdf["pages"].sum())}
            if "part" not in row:
                row["expression"] = expression(wrapper)
            return pd.DataFrame([row | {"wrapper": json.dumps(wrapper)}])
        return run

    parts = rows.mapInArrow(learn, schema).groupBy("host", "part").applyInPandas(merge(["host", "part"]), schema)
    return materialize(parts.groupBy("host").applyInPandas(
        merge(["host"]), "host string, pages bigint, expression string, wrapper string"), "wrappers")


def extract(pages: DataFrame, wrappers: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with its html replaced by hx_text and hx_chars (code points)."""
    ship_package(pages.sparkSession)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(
                [json.dumps(kept_slots(json.loads(w))) for w in batch.column("wrapper").to_pylist()])], names=["hx_host", "hx_kept"])

    kept = materialize(wrappers.select("host", "wrapper").mapInArrow(decide, "hx_host string, hx_kept string"), "kept-slots")
    others = [c for c in pages.columns if c != html]
    names = [clean_name(others, "hx_text"), clean_name(others, "hx_chars")]
    rows = pages.select(F.col(f"`{html}`").cast("string").alias("html"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(others)],
                        host_of(F.col(f"`{url}`")).alias("host"))
    rows = rows.join(kept, F.col("host") == F.col("hx_host"), "left").drop("host", "hx_host")
    schema = StructType([StructField(f"c{k}", pages.schema[c].dataType) for k, c in enumerate(others)]
                        + [StructField("text", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for source, rule in zip(batch.column("html").to_pylist(), batch.column("hx_kept").to_pylist(), strict=True):
                if rule not in rules:
                    if len(rules) > 1000:
                        rules.clear()
                    rules[rule] = json.loads(rule) if rule else {}
                texts.append(main_text(source or "", rules[rule]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f"c{k}") for k in range(len(others))), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema).toDF(*others, *names)


def main_texts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    return extract(pages, infer_wrappers(pages, url, html), url, html)
