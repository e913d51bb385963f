"""Main text of web pages by removal of site templates.

Pages are parsed to elements. Every container's subtree (its tags and text) is hashed; Spark counts, per host,
on how many different pages each hash occurs. A subtree that recurs on many of them belongs to the site, not to
the page, and is deleted, together with what markup says is no article text: menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles. The article's text is then read block by block.

A subtree counts by the different prose around it, and not on pages whose prose is nearly all inside it, so copies
of an article do not make it a template, with or without an article element. Inside an article, or the main
element, containers of paragraphs are deleted only where they recur in the same place: articles share passages.

Subtrees meet only as counts: a host with very many pages ships one row per task and hash.

Defined results: a NULL or empty page has no text; a NULL or malformed address is a host of its own; markup of
any kind is read as far as it goes; repeated rows give the same text each; an empty table gives an empty result;
only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.llm.common import stored

MIN_PAGES = 8  # different pages of a host that a template occurs on, however many pages the host has
MOST_PROSE = 0.75  # of a page's prose: what holds more is its own text

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*+"|'[^']*+'|["'])*+)>""")
_NEXT = re.compile(r"<")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption".split()
)
CONTAINER = BLOCK - set("p h1 h2 h3 h4 h5 h6 li dd dt td th tr pre html body hr caption".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
CLOSES_P = BLOCK - set("td th tr tbody thead tfoot caption dd dt".split()) | {"li", "table"}
DROPPED = set(
    "script style noscript template iframe svg canvas object embed head title nav menu footer aside form button select "
    "textarea input label dialog audio video map math xmp noembed noframes".split()
)
# Words of class, id and role that mark what is no article text.
MARKS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars footer masthead banner contentinfo complementary "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion share sharing social "
    "related recommended recommendations comment comments disqus reply replies respond widget widgets pagination pager "
    "search searchbox toolbar skip".split()
)


# Words that say where a marked box is or how it looks; beside any other word a mark may be the article's own subject
# (share-prices, related-work), as two of the marks always may.
LAYOUT = set(
    "area article aside bar block blocks body bottom box boxes button buttons card cards column container content entry feed "
    "form global group heading icon icons inline inner item items left link links list lists main message meta news off "
    "page panel placeholder post posts primary right secondary section site slot social stories story tags text thread title "
    "top unit view wrap wrapper".split()
)
UNSURE = {"alert", "reply"}


# Words that only say what a layout has: has-sidebar, with-comments, comments-open.
_MODIFIER = re.compile(r"^(?:has|with|without|no)[-_]|[-_](?:open|opened|closed|enabled|disabled)$", re.I)


class Element:
    __slots__ = ("tag", "parent", "children", "dropped", "marked", "unsure", "hash", "prose")

    def __init__(self, tag, parent, dropped=False, marked=(0, False)):
        self.tag, self.parent, self.children, self.dropped = tag, parent, [], dropped
        self.marked, self.unsure = marked
        self.hash, self.prose = None, (0, 0, 0, 0)


def _hidden(attributes: str) -> bool:
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        value = value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _marked(tag: str, attributes: str) -> tuple[int, bool]:
    """0 without a mark; 1 if there are other words beside it, as on a layout's wrapper; 2 if there are only marks.

    Then whether every mark may be part of an article's subject.
    """
    if tag in ("html", "body", "main", "article"):
        return 0, False
    marks = others = sure = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in value.strip("\"'").split():
                if not _MODIFIER.search(token):
                    words = {word.lower() for word in _NAME.findall(token)}
                    found = not words.isdisjoint(MARKS)
                    marks, others = marks + found, others + (not found)
                    subject = [w for w in words - MARKS - LAYOUT if len(w) > 2]
                    sure += bool(words & MARKS - UNSURE) and not subject
    return (0 if not marks else 1 if others else 2), not sure


_SENTENCE = re.compile(r"\w\S*(?:\s+\S+){3,}?[.!?…。]")


def _in_article(node: Element, tag: str) -> bool:
    """Whether a ``tag`` element is around ``node``."""
    while node.parent is not None:
        node = node.parent
        if node.tag == tag:
            return True
    return False


def _has_sentences(node: Element) -> bool:
    """Whether text of ``node``, that of links and of what is dropped aside, holds a sentence."""
    stack: list = [node]
    while stack:
        words: list[str] = []
        for child in stack.pop().children:
            if not isinstance(child, Element):
                words.append(child)
            elif not child.dropped and child.tag != "a":
                stack.append(child)
                words.append(" ".join(t for t in child.children if isinstance(t, str)) if child.tag not in BLOCK else "")
        if _SENTENCE.search(" ".join(words)):
            return True
    return False


def _settle(root: Element) -> None:
    """Drops the marked elements but those that hold the article, or most of the prose of a page without one.

    From the outside in, each level of marked elements is decided at once.
    """
    measured(root)
    order = _in_order(root)
    inside: dict[int, tuple[int, int, int, int]] = {}  # articles and mains: all, and those under no further mark
    for node in reversed(order):
        counts = [int(node.tag == "article"), int(node.tag == "main")] * 2
        for c in node.children:
            if isinstance(c, Element) and not c.dropped:
                a, m, free_a, free_m = inside[id(c)]
                counts[0] += a
                counts[1] += m
                if not c.marked:
                    counts[2] += free_a
                    counts[3] += free_m
        inside[id(node)] = tuple(counts)
    at = 0 if root.prose[0] else 2
    total = root.prose[at]
    articles, mains = inside[id(root)][2:]
    tops = [root]
    while tops:
        level, stack = [], [c for top in tops for c in top.children if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            if node.marked and not node.dropped:
                level.append(node)
            elif not node.dropped:
                stack += [c for c in node.children if isinstance(c, Element)]
        most = max((n.prose[at] for n in level if sum(inside[id(n)][:2])), default=0)
        tops = []
        for node in level:
            a, m = inside[id(node)][:2]
            prose = node.prose[at]
            large = 2 * prose > total if node.marked == 1 else 10 * prose >= 9 * total > 0
            if not articles and not mains:
                keep = (a + m and 2 * prose >= most) or large
            else:
                keep = not articles and a and large
            if not keep and node.unsure and _in_article(node, "article" if articles else "main"):
                keep = _has_sentences(node)
            if keep:
                tops.append(node)
            else:
                node.dropped = True
        articles += sum(inside[id(n)][2] for n in tops)
        mains += sum(inside[id(n)][3] for n in tops)


def parse(page: str | None) -> Element:
    """The page as elements. End tags close what is open; a block closes an open paragraph; the rest is as it comes."""
    root = here = Element("", None)
    page, at = page or "", 0
    opened: set[str] = set()  # an end tag whose name never occurred closes nothing
    marks = 0
    while at < len(page):
        found = _NEXT.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at:
            here.children.append(page[at:stop])
        if not found:
            break
        tag = _TAG.match(page, stop)
        if not tag:
            other = _OTHER.match(page, stop)
            if other:
                at = other.end()
            else:
                here.children.append("<")
                at = stop + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if tag[1]:
            node = here if name in opened else root
            while node.parent is not None and node.tag != name:
                if node.tag in CONTAINER and name not in BLOCK:  # an inline end tag reaches no further
                    node = root
                    break
                node = node.parent
            if node.parent is not None:
                here = node.parent
            continue
        opened.add(name)
        if name in CLOSES_P or name in ("dd", "dt"):
            node = here
            while node.parent is not None and node.tag not in CONTAINER and node.tag not in ("p", "td", "th"):
                if node.tag == name and name in ("li", "dd", "dt"):
                    break
                node = node.parent
            if node.tag == "p" or (node.tag == name and name in ("li", "dd", "dt")):
                here = node.parent
        elif name in ("tr", "td", "th"):
            node = here
            while node.parent is not None and node.tag not in ("table", "tr", "td", "th"):
                node = node.parent
            while node.tag in ("td", "th") or (node.tag == "tr" and name == "tr"):
                here = node = node.parent
        child = Element(name, here, name in DROPPED or _hidden(tag[3]), _marked(name, tag[3]))
        marks += child.marked
        here.children.append(child)
        if name in RAW:
            end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
            child.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in VOID and not tag[0].endswith("/>"):
            here = child
    if marks:
        _settle(root)
    return root


def _in_order(root: Element) -> list[Element]:
    """Elements, parents first; no recursion, pages nest at will."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Element)]
    return order


def measured(root: Element) -> None:
    """Every element's ``prose``: characters and sum of hashes of its outermost prose elements, then of any text.

    Text of links and of what is dropped is left out.
    """
    import xxhash

    for node in reversed(_in_order(root)):
        prose = (0, 0, 0, 0)
        if not node.dropped and node.tag != "a":
            n = [0, 0, 0, 0]
            for child in node.children:
                if isinstance(child, Element):
                    for i, x in enumerate(child.prose):
                        n[i] += x
                elif words := " ".join(child.split()):
                    n[2] += len(words)
                    n[3] += xxhash.xxh3_64_intdigest(words)
            prose = (n[2], n[3], n[2], n[3]) if node.tag in PROSE and n[2] else tuple(n)
        node.prose = prose


def hashed(root: Element) -> None:
    """Every element's hash over its tag, its words and its children's hashes."""
    import xxhash

    for node in reversed(_in_order(root)):
        digest = xxhash.xxh3_64(node.tag)
        for child in node.children:
            digest.update(b"\x00" + child.hash if isinstance(child, Element) else " ".join(child.split()))
        node.hash = digest.digest()


def _articles(root: Element) -> list[Element]:
    """The outermost article elements that are not dropped, or else the main ones."""
    found: dict[str, list[Element]] = {"article": [], "main": []}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        if node.tag in found:
            found[node.tag].append(node)
            if node.tag == "article":
                continue
        stack += [c for c in reversed(node.children) if isinstance(c, Element)]
    return found["article"] or found["main"][:1]


def candidates(root: Element) -> list[tuple[Element, bool, list[bytes]]]:
    """Containers that may be deleted as templates, whether they are inside an article, and their keys.

    A key is the subtree's hash. Containers of prose inside an article have two others, as articles share passages:
    the hash with the place in the article, counted among the siblings from the first and from the last.
    """
    import xxhash

    articles = set(map(id, _articles(root)))
    order, stack = [], [(root, False, b"", 0, 0)]
    while stack:
        node, inside, path, first, last = stack.pop()
        if id(node) in articles:
            inside, path = True, b""
        order.append((node, inside, path, first, last))
        below = xxhash.xxh3_64_digest(path + node.tag.encode("utf-8", "surrogatepass")) if inside else b""
        inner = [c for c in node.children if isinstance(c, Element)]
        stack += [(c, inside, below, n, len(inner) - n) for n, c in enumerate(inner)]
    holds: set[int] = set()  # elements with an article in them
    prose: set[int] = set()  # elements that are or hold prose inside an article
    out = []
    for node, inside, path, first, last in reversed(order):
        if id(node) in articles or any(id(c) in holds for c in node.children):
            holds.add(id(node))
            continue
        if inside and (node.tag in PROSE or any(id(c) in prose for c in node.children)):
            prose.add(id(node))
        if node.tag in CONTAINER:
            keys = [node.hash]
            if id(node) in prose and node.hash:
                keys = [xxhash.xxh3_64_digest(node.hash + path + f"{side}{n}".encode()) for side, n in (("<", first), (">", last))]
            out.append((node, inside, keys))
    return out


def votes(root: Element) -> dict[bytes, int]:
    """The keys of every candidate with a hash of the page's prose around it.

    A candidate that holds nearly all prose is the page's own text; it has no vote. Pages without prose elements
    are judged by all their text but that of links, pages without any text by all that is on them.
    """
    measured(root)
    articles = _articles(root)
    tops = articles or [root]
    total = [sum(t.prose[i] for t in tops) for i in range(4)]
    at = 0 if total[0] else 2
    out = {}
    for node, inside, keys in candidates(root):
        if not node.dropped:
            own = node.prose[at : at + 2] if inside or not articles else (0, 0)
            if not total[at]:
                out |= dict.fromkeys(keys, int.from_bytes(root.hash, "big") >> 1)
            elif MOST_PROSE * total[at] >= own[0]:
                out |= dict.fromkeys(keys, (total[at + 1] - own[1]) % 2**63)
    return out


def text_of(root: Element, templates: set[bytes]) -> str:
    """The blocks of the articles, or of the whole page if it has none, without what is dropped or a template."""
    if templates:
        for node, _, keys in candidates(root):
            node.dropped = node.dropped or not templates.isdisjoint(keys)
    blocks: list[str] = []
    words: list[str] = []

    def flush():
        block = " ".join(entities.unescape("".join(words)).split())
        if block:
            blocks.append(block)
        words.clear()

    articles = _articles(root)
    inside = bool(articles)
    for top in articles or [root]:
        stack: list = [top]
        while stack:
            node = stack.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                words.append(node)
            elif node.dropped or (node.tag == "header" and not inside):
                words.append(" ") if node.tag not in BLOCK else flush()
            else:
                if node.tag == "br":
                    words.append(" ")
                if node.tag in BLOCK:
                    flush()
                    stack.append(None)
                stack += reversed(node.children)
        flush()
    return "\n".join(blocks)


# --- In Spark -------------------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host == "", F.concat(F.lit("?"), F.coalesce(url, F.lit("")))).otherwise(host)


def subtrees(pages: DataFrame) -> DataFrame:
    """page, host, content (a hash of the prose around it) and hash: one row per page and distinct candidate."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hosts, contents, hashes = [], [], [], []
            for key, host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                root = parse(page.as_py())
                hashed(root)
                for h, content in sorted(votes(root).items()):
                    keys.append(key)
                    hosts.append(host)
                    contents.append(content)
                    hashes.append(int.from_bytes(h, "big", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(hosts, pa.int64()), pa.array(contents, pa.int64()), pa.array(hashes, pa.int64())],
                names=["page", "host", "content", "hash"],
            )

    return pages.select("page", "host", "html").mapInArrow(walk, "page long, host long, content long, hash long")


def site_templates(found: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, hash) of the subtrees on enough different pages of their host."""
    counts = found.select("host", "hash", "content").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_pages).select("host", "hash")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    key = F.xxhash64("url", "html")
    keyed = pages.select("page_id", "url", "html", key.alias("page"), F.xxhash64(host_of(F.col("url"))).alias("host"))
    found = stored(subtrees(keyed), "subtrees")
    templates = stored(site_templates(found), "templates")
    marks = found.select("page", "host", "hash").distinct().join(templates, ["host", "hash"])
    marks = stored(marks.groupBy("page").agg(F.collect_set("hash").alias("templates")), "marks")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], *T.StructType.fromDDL("text string, n_chars long")])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, own in zip(batch.column(2), batch.column(3).to_pylist()):
                root = parse(page.as_py())
                if own:
                    hashed(root)
                texts.append(text_of(root, {h.to_bytes(8, "big", signed=True) for h in own or ()}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=schema.names
            )

    rows = keyed.join(marks, "page", "left").select("page_id", "url", "html", "templates")
    return rows.mapInArrow(extract, schema)
