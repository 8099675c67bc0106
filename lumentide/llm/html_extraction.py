"""Main text of web pages by removal of site templates.

First pass: every page is parsed, each element subtree outside plain prose is hashed, and Spark
counts per host on how many different pages a subtree stands (pages with the same article count
once, so copies of a page make no template).  Second pass: subtrees that recur on many pages of
their host are deleted, as are elements whose kind or name says that they are not the article;
the text blocks of what remains of the article, or of the body where a page marks none, are the
result.  Paragraphs, headings and lists inside a marked article are prose and are never taken
for a template, however often they recur.

Semantics: null and empty pages give an empty text; a page without host has no template; a
``br`` is white space; text after an unclosed tag at the end of a page is dropped with the tag;
rows that repeat are pages of their own.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, few_enough

#: A subtree is a template if it is on at least LEAST_PAGES different pages of its host, and on log2 of them where that is more.
LEAST_PAGES = 5
#: So many templates, with so many characters of hosts, are looked up from a broadcast table; beyond, pages meet them by joins, with keys dealt over SALTS.
KNOWN, KNOWN_CHARS, SALTS = 50_000, 8_000_000, 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
#: Elements that stand apart as blocks of text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: A start tag of these ends an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr".split())
#: What a start tag ends, up to one of the elements behind it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
#: Elements that are never the article.
DROPPED = frozenset("head nav aside footer form button select input label object svg canvas audio video map dialog menu".split()) | RAW
#: Words in class, id or role that mark such elements.
MARKS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended related respond search share sharing sidebar signup social sponsor sponsored subscribe teaser teasers toolbar widget widgets".split())
#: Such words on an article: a reader's comment or a teaser of another page.
ASIDE_ARTICLES = frozenset("ad advert advertisement comment comments promo promoted recommended related reply sponsored teaser teasers".split())
#: Subtrees that may be templates.
CONTAINERS = frozenset("nav aside footer header form div section ul ol dl table menu figure details p".split())
PROSE = frozenset("p ul ol dl table figure li blockquote pre h1 h2 h3 h4 h5 h6".split())

_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^>"'\s]*+))*+"""
_TOKEN = re.compile(rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)({_ATTRS})(?:>|\Z)|</[^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "marks", "children", "digest")

    def __init__(self, tag: str, marks: frozenset[str] = frozenset()):
        self.tag, self.marks, self.children, self.digest = tag, marks, [], 0


def _close(node: Node) -> None:
    h = xxhash.xxh64(node.tag.encode())
    for c in node.children:
        h.update(c.digest.to_bytes(8, "little") if isinstance(c, Node) else b"\0" + " ".join(c.split()).encode("utf-8", "surrogatepass"))
    node.digest = h.intdigest()


def parse(page: str) -> Node:
    """The element tree: end tags that may be left out are implied, others that are missing close with their parent."""
    root = Node("#root")
    stack, open_tags = [root], {}

    def pop() -> None:
        node = stack.pop()
        open_tags[node.tag] -= 1
        _close(node)

    def end(tags, barrier=frozenset()) -> None:
        """Closes the nearest open element of the tags, and what is open in it, unless a barrier is nearer."""
        if not any(open_tags.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in barrier:
                return

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(entities.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(entities.unescape(page[at : m.start()]))
        at = m.end()
        if m[1] is None or (m[0][-1] != ">"):
            continue
        tag = m[1].lower()
        if m[0][1] == "/":
            if tag == "br":
                stack[-1].children.append(Node("br"))
            else:
                end((tag,), {"td", "th", "table"} if tag not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot", "body", "html") else frozenset())
            continue
        if tag in ENDS_P:
            end(("p",), {"td", "th", "table", "button"})
        if tag in ENDS:
            for _ in range(3):
                before = len(stack)
                end(ENDS[tag][0], ENDS[tag][1])
                if len(stack) == before:
                    break
        marks = frozenset()
        if m[2] and "=" in m[2]:
            marks = frozenset(w for x in _NAMES.finditer(m[2]) for w in _WORD.findall((x[1] or x[2] or x[3] or "").lower()))
        node = Node(tag, marks)
        stack[-1].children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            node.children.append(page[at : stop.start() if stop else size])
            at = stop.end() if stop else size
            _close(node)
        elif tag not in VOID:
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    while len(stack) > 1:
        pop()
    _close(root)
    return root


def _dropped(node: Node, inside: bool) -> bool:
    """Whether the element's kind or name says that it is no part of an article; a header in an article holds its title."""
    if node.tag in DROPPED or node.tag == "header" and not inside:
        return True
    if node.tag == "article":
        return not ASIDE_ARTICLES.isdisjoint(node.marks)
    if node.tag in ("html", "body", "main", "h1"):
        return False
    return not MARKS.isdisjoint(node.marks - {"header"} if inside else node.marks)


def _roots(root: Node) -> list[tuple[Node, bool]]:
    """The marked articles, else the main element, else the page; with whether it is marked."""
    for wanted in (("article",), ("main",)):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag in wanted or wanted == ("main",) and "main" in node.marks and node.tag in ("div", "section"):
                found.append((node, True))
            else:
                todo += [c for c in reversed(node.children) if isinstance(c, Node) and not _dropped(c, False)]
        if found:
            return found
    return [(root, False)]


def blocks(root: Node, templates: frozenset[int] = frozenset()) -> list[str]:
    """The text blocks of the article, in page order."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(held)).strip()
        held.clear()
        if text:
            out.append(text)

    for top, marked in _roots(root):
        todo: list[Node | str | None] = [top]
        while todo:
            node = todo.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                held.append(node)
            elif node.tag == "br":
                held.append(" ")
            elif node is top or not (_dropped(node, marked) or node.digest in templates and node.tag in CONTAINERS and not (marked and node.tag in PROSE)):
                if node.tag in BLOCKS:
                    flush()
                    todo.append(None)
                todo += reversed(node.children)
        flush()
    return out


def subtrees(root: Node) -> set[int]:
    """Hashes of the subtrees that may be templates; prose of a marked article is not among them."""
    tops = {id(n) for n, marked in _roots(root) if marked}
    found: set[int] = set()
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or id(node) in tops
        if node.tag in CONTAINERS and not (inside and node.tag in PROSE):
            found.add(node.digest)
        todo += [(c, inside) for c in node.children if isinstance(c, Node)]
    return found


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def page_trees(pages: DataFrame) -> DataFrame:
    """host, page (hash of the article), body (hash of the page), tree: of the pages (host, html) the subtrees that may be templates, and 0 for the page itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, page, bodies, tree = [], [], [], []
            for h, text, body in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                root = parse(text)
                article = xxhash.xxh64_intdigest("\n".join(blocks(root)).encode("utf-8", "surrogatepass"))
                found = [0, *subtrees(root)]
                hosts += [h] * len(found)
                page += [article - (1 << 63)] * len(found)
                bodies += [body] * len(found)
                tree += [x - (1 << 63) if x else 0 for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(page, pa.int64()), pa.array(bodies, pa.string()), pa.array(tree, pa.int64())], names=["host", "page", "body", "tree"])

    rows = pages.where("host <> '' and html is not null").select("host", "html", F.md5(F.col("html").cast("binary")).alias("body"))
    return rows.mapInArrow(run, "host string, page long, body string, tree long")


def site_templates(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """host, tree: the hashes of its recurring subtrees, a row for each.  Pages are parsed once for it."""
    rows = page_trees(pages).select("host", "page", "tree")
    counts = rows.distinct().groupBy("host", "tree").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    counts = Scratch(pages.sparkSession, "trees").write(counts)
    whole = counts.where("tree = 0").select("host", F.col("n").alias("of"))
    return counts.where("tree <> 0").join(whole, "host").where(F.col("n") >= F.log2("of")).select("host", "tree")


def page_templates(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """host, body, templates: those on each different page, so that a row is bounded by its page."""
    rows = page_trees(pages).where("tree <> 0").select("host", "body", "tree", F.pmod(F.xxhash64("body"), F.lit(SALTS)).alias("salt"))
    dealt = templates.select("host", "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return rows.join(dealt, ["host", "tree", "salt"], "left_semi").groupBy("host", "body").agg(F.collect_set("tree").alias("templates"))


def extract(pages: DataFrame, known: int = KNOWN) -> DataFrame:
    """page_id, url, text, n_chars of every page (page_id, url, html); known: the most templates to broadcast."""
    pages = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    templates = Scratch(pages.sparkSession, "html").write(site_templates(pages))
    sites: dict[str, set[int]] = {}
    if few_enough(templates, known) and (templates.agg(F.sum(F.length("host"))).first()[0] or 0) <= KNOWN_CHARS:
        for r in templates.collect():
            sites.setdefault(r.host, set()).add(r.tree + (1 << 63))
        source = pages.select("page_id", "url", "html", "host", F.lit(None).cast("array<long>").alias("templates"))
    else:
        keyed = pages.withColumn("body", F.md5(F.col("html").cast("binary")))
        source = keyed.join(page_templates(pages, templates), ["host", "body"], "left").select("page_id", "url", "html", "host", "templates")
    sent = pages.sparkSession.sparkContext.broadcast({h: frozenset(t) for h, t in sites.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none: frozenset[int] = frozenset()
        for batch in batches:
            texts = []
            for body, h, own in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                found = frozenset(x + (1 << 63) for x in own) if own else sent.value.get(h, none)
                texts.append("\n".join(blocks(parse(body), found)) if body else "")
            column = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column, pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
