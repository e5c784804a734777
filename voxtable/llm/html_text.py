r"""HTML extraction by wrapper induction.

Pages of a host share a wrapper. One page of each host (least hash) is its reference; every page's DOM tree is aligned once
with the reference tree by simple tree matching, and its text blocks are stored with the reference node that each is aligned to. From these blocks alone come, by host, as sums:
which nodes are template (their text is that of the reference on CONSTANT of the pages that have it, of LEAST pages at least), which are menus (nearly all of their text,
or of the blocks below them, is link text), and whether the varying text lies in the article or main element. What is left, the varying slots and the blocks that the reference lacks,
is the content. Tags, roles, classes and ids drop what they name (menus, headers, footers, sidebars, notices, adverts, forms, reader
comments); a header inside of an article or main element is the article's own and stays. Names are overruled: one that is a part of a longer name inside of an article ("article-header", "related-work")
drops only what is mostly links, and leaves the rest to the votes; names of a page's layout ("with-sidebar") count for nothing; and an element that holds most of a page's text with its heading or article stays. A page's only article or main element bounds its content unless most of the varying text of
its host lies outside of such elements.

Pages that say nearly the same as the reference cast no vote, so that a text posted often isn't taken for template. A page of which nothing would be left keeps its constant text.

Votes are summed in the tasks first; a host of any share of the pages meets in sums only. References and votes are broadcast if they
fit SMALL bytes together, else joined by host.

Defined cases: null and empty html give an empty text; a null or odd url is a host of its own kind (empty name); hosts of fewer than LEAST + 1 pages that differ go
by tags and names; repeated rows are extracted each; an empty table gives an empty result; truncated and unclosed markup is
read as browsers do, more or less; elements nested deeper than DEPTH become siblings, and no text is lost by it; extra columns are not read.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, stored

SMALL = 16 << 20
#: A node is template if its text is the same on so large a share of at least LEAST pages.
CONSTANT, LEAST = 0.9, 3
#: A page of which so much is as in the reference is a copy of it.
COPY = 0.9
#: Share of link text in a menu.
LINKS = 0.9
#: Pairs of two lists of children up to which a largest matching is found.
CELLS = 2500
#: Elements nested deeper become siblings, as in browsers; no text is lost.
DEPTH = 150

# fixed values: HTML's element classes
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav "
    "ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul caption button svg".split()
)
_CLOSES_P = _BLOCK - {"option", "optgroup", "button", "svg", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}}
_DROPPED = frozenset("nav footer aside form select button dialog menu svg header".split())
_ROLES = re.compile(r"navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu|menubar|toolbar", re.I)
_NAME = re.compile(
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|sidebar|aside|widget|ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|gdpr|newsletter|subscribe|"
    r"signup|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|replies|pagination|pager|popup|modal|overlay|login|search|toolbar|skip|copyright",
    re.I,
)
#: Names that say little as a part of a longer one inside of an article ("article-header"): the element's links and the votes decide.
_WEAK = frozenset("header related search notice menu banner login".split())
#: Heads of names that tell how a whole page is laid out ("with-sidebar").
_LAYOUT = frozenset("with has no without layout".split())
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies)(?:$|[\s_-])", re.I)
#: Elements that hold no page, whatever their share of it.
_SMALL = frozenset("nav footer header select button dialog menu svg".split())
_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>?|<[A-Za-z][^>]*(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


#: An attribute's value without quotes at the end of a tag: a slash there is part of it.
_UNQUOTED = re.compile(r"=[^\s\"']+\Z")
_NUMBERS = re.compile(r"\d+")


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _shape(sign: str, kids: list[str]) -> str:
    """Equal for trees of the same signatures alone."""
    return _digest("\n".join((sign, *kids)))


def _named(names: str, inside: bool) -> str:
    """Whether classes and ids name what is dropped: "soft" or, where the element's links decide, "weak"; else nothing."""
    out = ""
    for word in names.split():
        parts = re.split(r"[_-]+", word.lower())
        hits = [x for x in parts if _NAME.fullmatch(x)] if parts[0] not in _LAYOUT or len(parts) == 1 else ()
        if hits and not (inside and len(parts) > 1 and _WEAK.issuperset(hits)):
            return "soft"
        out = "weak" if hits else out
    return out


def _weighed(root: Node) -> None:
    """Takes back what names and forms drop in error: an element inside of an article whose name says little and whose text isn't mostly links,
    and one that holds most of a page's text and its heading or article (a form may hold all there is)."""
    work, nodes, kept = [(root, False)], [], 0
    while work:
        n, out = work.pop()
        nodes.append(n)
        if n.soft == "weak" and 2 * n.linked < n.plain + n.linked:
            n.dropped = False
        out = out or n.dropped
        kept += 0 if out else max(0, n.chars - n.links)
        work += [(k, out) for k in n.kids]
    heads = set()
    for n in reversed(nodes):
        if n.tag in ("h1", "main", "article") or any(id(k) in heads for k in n.kids):
            heads.add(id(n))
    for n in nodes:
        if n.dropped and n.soft and n.tag not in _SMALL and 2 * n.plain > root.plain and not _COMMENTS.search(n.name):
            n.dropped = not (id(n) in heads or n.tag == "form" and not kept)


class Node:
    """A block element, or an inline one that is dropped. items: text pieces and nodes in page order."""

    __slots__ = ("tag", "name", "items", "dropped", "soft", "inline", "links", "kids", "text", "chars", "size", "shape", "plain", "linked")

    def __init__(self, tag: str, name: str = "", dropped: bool = False, inline: bool = False):
        self.tag, self.name, self.dropped, self.inline = tag, name, dropped, inline
        self.items: list[str | Node] = []
        self.links = 0
        self.soft = ""

    def settle(self) -> None:
        """Kids, own text's digest and length, and the shape, the nodes and the characters outside and inside of links of the tree, here and below."""
        work, order = [self], []
        while work:
            n = work.pop()
            order.append(n)
            n.kids = [x for x in n.items if type(x) is Node]
            own = " ".join(" ".join(x for x in n.items if type(x) is str).split())
            n.text, n.chars = _digest(own), len(own)
            work += n.kids
        for n in reversed(order):
            n.size = 1 + sum(k.size for k in n.kids)
            n.shape = _shape(n.sign, [k.shape for k in n.kids])
            n.plain = max(0, n.chars - n.links) + sum(k.plain for k in n.kids)
            n.linked = min(n.chars, n.links) + sum(k.linked for k in n.kids)

    @property
    def sign(self) -> str:
        """What aligned nodes agree on: the tag, and class and id but for their numbers."""
        return f"{self.tag}.{_NUMBERS.sub('0', self.name)}"


def parsed(html: str) -> Node:
    root = Node("#root")
    stack = [root]
    anchors, at, end = 0, 0, len(html)
    match = _TOKEN.match
    while at < end:
        m = match(html, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if html[m.start()] != "<" or m.end() - m.start() == 1:
                text = unescape(m[0]) if "&" in m[0] else m[0]
                stack[-1].items.append(text)
                if anchors:
                    stack[-1].links += len(text.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            if tag in _BLOCK or stack[-1].inline:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        anchors = 0 if tag in _BLOCK else anchors
                        break
                    if stack[k].tag in ("article", "table") and tag in ("p", "div", "li", "td", "tr"):
                        break
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            continue
        if tag == "br" or tag == "hr":
            stack[-1].items.append("\n")
        if tag in _VOID or m[3].endswith("/") and not _UNQUOTED.search(m[3]):
            continue
        inside = any(n.tag in ("article", "main") for n in stack)
        names, soft, drop = "", "", tag in _DROPPED and not (tag == "header" and inside)
        soft = "soft" if drop else ""
        if m[3]:
            got = {a.lower(): unescape(b or c or d) for a, b, c, d in _ATTRIBUTE.findall(m[3])}
            names = f"{got.get('class', '')} {got.get('id', '')}".strip()
            if not drop and names and tag not in ("html", "body", "article", "main"):
                soft = _named(names, inside)
            if _ROLES.fullmatch(got.get("role", "").strip()):
                soft = "soft"
            drop = drop or bool(soft)
            if "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower():
                drop, soft = True, ""
        if tag == "a":
            anchors += 1
        block = tag in _BLOCK
        if not block and not drop:
            continue
        if block:
            if tag in _CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == "p":
                        del stack[k:]
                        break
                    if not stack[k].inline:
                        break
            for k in range(len(stack) - 1, 0, -1) if tag in _SIBLINGS else ():
                if stack[k].tag in _SIBLINGS[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE[tag]:
                    break
            anchors = anchors if tag != "p" else 0
        if len(stack) > DEPTH:
            stack.pop()
        node = Node(tag, " ".join(names.split()), drop, not block)
        node.soft = soft
        stack[-1].items.append(node)
        stack.append(node)
    root.settle()
    _weighed(root)
    return root


def blocks(root: Node) -> list[tuple[Node, str]]:
    """The blocks of text below a node, in page order, each with the node whose own text it is; dropped nodes are left out."""
    out: list[tuple[Node, str]] = []
    buffer: list[str] = []
    work: list = [iter(root.items)]
    open_ = [root]

    def flush() -> None:
        if text := " ".join("".join(buffer).split()):
            out.append((open_[-1], text))
        buffer.clear()

    while work:
        for x in work[-1]:
            if type(x) is str:
                buffer.append(x)
                continue
            if not x.inline:
                flush()
            if x.dropped:
                continue
            work.append(iter(x.items))
            open_.append(x)
            break
        else:
            flush()
            work.pop()
            open_.pop()
    return out


def flat(root: Node) -> list:
    """A tree as rows in document order: depth, signature, digest of own text."""
    out, work = [], [(root, 0)]
    while work:
        n, depth = work.pop()
        out.append([depth, n.sign, n.text])
        work += [(k, depth + 1) for k in reversed(n.kids)]
    return out


class Reference:
    """A flat tree with its children and the sizes of its subtrees; a node is its place in document order."""

    def __init__(self, rows: list):
        self.rows = rows
        self.kids: list[list[int]] = [[] for _ in rows]
        self.size = [1] * len(rows)
        path: list[int] = []
        parent = [-1] * len(rows)
        for i, r in enumerate(rows):
            del path[r[0] :]
            if path:
                self.kids[path[-1]].append(i)
                parent[i] = path[-1]
            path.append(i)
        for i in range(len(rows) - 1, 0, -1):
            self.size[parent[i]] += self.size[i]
        self.shape = [""] * len(rows)
        for i in range(len(rows) - 1, -1, -1):
            self.shape[i] = _shape(rows[i][1], [self.shape[k] for k in self.kids[i]])


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of pairs, by their first places, in which the second places rise."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        j = bisect_left(tails, y)
        before[k] = at[j - 1] if j else -1
        tails[j : j + 1] = [y]
        at[j : j + 1] = [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _in_turn(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal entries, the first with the first and so on, of which a longest part keeps the order."""
    places = defaultdict(list)
    for k in range(len(b) - 1, -1, -1):
        places[b[k]].append(k)
    return _rising([(k, places[x].pop()) for k, x in enumerate(a) if places.get(x)])


def aligned(page: Node, ref: Reference) -> list[tuple[Node, int]]:
    """Simple tree matching: the pairs of a largest matching of the two trees that keeps signatures, ancestors and order.

    Two lists of children with more than CELLS pairs are parted by children of equal shape first, and what is left between these, if it still has more, is paired by signatures in turn;
    or all are paired in turn, if that gives more pairs. Time grows as n log n of a list's length; such a matching needn't be a largest one."""
    known: dict[tuple[str, str], int] = {}

    def weight(n: Node, i: int) -> int:
        """Pairs in the matching of the trees below and with two nodes of one signature."""
        if not n.kids or not ref.kids[i]:
            return 1
        if n.shape == ref.shape[i]:
            return n.size
        key = (n.shape, ref.shape[i])
        if key not in known:
            known[key] = 1 + sum(weight(x, y) for x, y in matched(n.kids, ref.kids[i]))
        return known[key]

    def matched(a: list[Node], b: list[int]) -> list[tuple[Node, int]]:
        # first and last runs of trees that are equal: no matching of either node is larger, so some largest matching has these pairs
        low, most = 0, min(len(a), len(b))
        while low < most and a[low].shape == ref.shape[b[low]]:
            low += 1
        high = 0
        while high < most - low and a[-1 - high].shape == ref.shape[b[-1 - high]]:
            high += 1
        ends = [*zip(a[:low], b[:low], strict=True), *zip(a[len(a) - high :], b[len(b) - high :], strict=True)]
        a, b = a[low : len(a) - high], b[low : len(b) - high]
        if len(a) * len(b) <= CELLS:
            return ends + grid(a, b)
        by_sign = in_turn(a, b)
        by_shape, x0, y0 = [], 0, 0
        for x, y in [*_in_turn([n.shape for n in a], [ref.shape[i] for i in b]), (len(a), len(b))]:
            c, d = a[x0:x], b[y0:y]
            by_shape += grid(c, d) if len(c) * len(d) <= CELLS else in_turn(c, d)
            by_shape += [(a[x], b[y])] if x < len(a) and y < len(b) else []
            x0, y0 = x + 1, y + 1
        return ends + max(by_shape, by_sign, key=lambda pairs: sum(weight(n, i) for n, i in pairs))

    def in_turn(a: list[Node], b: list[int]) -> list[tuple[Node, int]]:
        return [(a[x], b[y]) for x, y in _in_turn([n.sign for n in a], [ref.rows[i][1] for i in b])]

    def grid(a: list[Node], b: list[int]) -> list[tuple[Node, int]]:
        rows = [[0] * (len(b) + 1)]
        signs = [ref.rows[y][1] for y in b]
        for x in a if b else ():
            above, row, s = rows[-1], [0], x.sign
            for k, y in enumerate(b):
                best = above[k + 1] if above[k + 1] >= row[k] else row[k]
                if s == signs[k] and (both := above[k] + weight(x, y)) > best:
                    best = both
                row.append(best)
            rows.append(row)
        out, x, y = [], len(rows) - 1, len(b)
        while x and y:
            if rows[x][y] == rows[x - 1][y]:
                x -= 1
            elif rows[x][y] == rows[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                out.append((a[x], b[y]))
        return out

    pairs, work = [], [(page, 0)]
    while work:
        n, i = work.pop()
        pairs.append((n, i))
        if n.kids and ref.kids[i]:
            work += matched(n.kids, ref.kids[i])
    return pairs


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each batch, the least page of each host, as a flat tree."""
    for b in batches:
        least: dict[str, tuple[int, str]] = {}
        for host, key, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if html and (host not in least or key < least[host][0]):
                least[host] = (key, html)
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array([x[0] for x in least.values()], pa.int64()), pa.array([json.dumps(flat(parsed(x[1]))) for x in least.values()], pa.string())], ["host", "key", "tree"])


def _lone(root: Node) -> Node | None:
    """The page's only article element, else its only main element."""
    for tag in ("article", "main"):
        found, work = [], [root]
        while work:
            n = work.pop()
            if n.tag == tag:
                found.append(n)
            elif not n.dropped:
                work += n.kids
        if len(found) == 1:
            return found[0]
    return None


def read_page(html: str, ref: Reference) -> tuple[bool, bool, list[dict]]:
    """Whether a page votes, whether it has one article, and its blocks: the reference node of the block (-1: none) and the nearest one around it, whether the node's text is
    as in the reference, whether the block lies in the article and is the first of its node, the node's characters and those of links, and the text."""
    root = parsed(html)
    to = {id(n): i for n, i in aligned(root, ref)}
    article = _lone(root)
    around: dict[int, int] = {}
    inside: set[int] = set()
    work = [(root, -1, False)]
    while work:
        n, near, in_ = work.pop()
        in_ = in_ or n is article
        around[id(n)] = near
        if in_:
            inside.add(id(n))
        near = to.get(id(n), near)
        work += [(k, near, in_) for k in n.kids]
    out, seen, same, total = [], set(), 0, 0
    for n, text in blocks(root):
        i = to.get(id(n), -1)
        as_there = i >= 0 and n.text == ref.rows[i][2]
        first = id(n) not in seen
        seen.add(id(n))
        if first:
            total += n.chars
            same += n.chars if as_there else 0
        out.append({"node": i, "around": around[id(n)], "same": as_there, "inside": id(n) in inside, "first": first, "chars": n.chars, "links": n.links, "text": text})
    return same < COPY * total, article is not None, out


_BLOCK_FIELDS = (("node", pa.int32()), ("around", pa.int32()), ("same", pa.bool_()), ("inside", pa.bool_()), ("first", pa.bool_()), ("chars", pa.int64()), ("links", pa.int64()), ("text", pa.string()))
_BLOCKS = "array<struct<node:int,around:int,same:boolean,inside:boolean,first:boolean,chars:long,links:long,text:string>>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """page_id, url, host, html, tree -> page_id, url, host, votes, article, blocks."""
    trees: dict[str, Reference] = {}
    for b in batches:
        votes, article, found, host = [], [], [], b.column(2).to_pylist()
        for i, html in enumerate(b.column(3).to_pylist()):
            if html and host[i] not in trees:
                if len(trees) > 1000:
                    trees.clear()
                trees[host[i]] = Reference(json.loads(b.column(4)[i].as_py()))
            v, a, x = read_page(html, trees[host[i]]) if html else (False, False, [])
            votes.append(v)
            article.append(a)
            found.append(x)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(votes, pa.bool_()), pa.array(article, pa.bool_()), pa.array(found, pa.list_(pa.struct(_BLOCK_FIELDS)))], ["page_id", "url", "host", "votes", "article", "blocks"])


def joined(rows: DataFrame, by_host: DataFrame, bytes_: Column) -> DataFrame:
    """rows with their host's row: broadcast if these are SMALL together, else a shuffle join (whose skewed hosts AQE splits)."""
    total = by_host.agg(F.sum(bytes_)).first()[0] or 0
    return rows.join(F.broadcast(by_host) if total <= SMALL else by_host, "host", "left")


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, votes, article and blocks of every row (see read_page). Each page is parsed and aligned once."""
    rows = pages.select("page_id", "url", _host(F.col("url")).alias("host"), "html")
    refs = rows.select("host", F.xxhash64("page_id").alias("key"), "html").mapInArrow(_references, "host string, key long, tree string").groupBy("host").agg(F.min_by("tree", "key").alias("tree"))
    found = joined(rows, cut(refs), F.octet_length("tree") + 100).select("page_id", "url", "host", "html", "tree")
    return stored(found.mapInArrow(_read, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, host string, votes boolean, article boolean, blocks {_BLOCKS}"))


def wrappers(read: DataFrame) -> DataFrame:
    """host, template and menu (reference nodes), slots (nodes whose blocks below are menus) and bounded (whether the varying text lies in articles)."""
    votes = read.filter("votes").select("host", F.explode("blocks").alias("b")).select("host", "b.*").filter("first")
    often = F.col("pages") >= LEAST
    by_node = votes.groupBy("host", "node").agg(
        F.count("*").alias("pages"), F.sum(F.col("same").cast("long")).alias("same"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        F.sum(F.when(~F.col("same"), F.greatest(F.col("chars") - F.col("links"), F.lit(0))).otherwise(0)).alias("varying"),
        F.sum(F.when(~F.col("same") & F.col("inside"), F.greatest(F.col("chars") - F.col("links"), F.lit(0))).otherwise(0)).alias("varying_inside"),
    )
    menu = often & (F.col("links") >= LINKS * F.col("chars"))
    nodes = by_node.groupBy("host").agg(
        F.collect_list(F.when((F.col("node") >= 0) & often & (F.col("same") >= CONSTANT * F.col("pages")), F.col("node"))).alias("template"),
        F.collect_list(F.when((F.col("node") >= 0) & menu, F.col("node"))).alias("menu"),
        (2 * F.sum("varying_inside") >= F.sum("varying")).alias("bounded"),
    )
    by_slot = votes.groupBy("host", "around").agg(F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    slots = by_slot.groupBy("host").agg(F.collect_list(F.when((F.col("around") >= 0) & menu, F.col("around"))).alias("slots"))
    return cut(nodes.join(slots, "host"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row."""
    read = read_pages(pages)
    made = wrappers(read)
    rows = joined(read, made, 100 + 4 * (F.size("template") + F.size("menu") + F.size("slots")))
    none = F.array().cast("array<int>")
    template, menu, slots = (F.coalesce(c, none) for c in ("template", "menu", "slots"))
    bounds = F.col("article") & F.coalesce("bounded", F.lit(True))
    main = F.filter("blocks", lambda b: ~bounds | b["inside"])
    linked = lambda b: b["links"] >= LINKS * b["chars"]
    kept = F.filter(main, lambda b: ~(b["same"] & F.array_contains(template, b["node"])) & ~(linked(b) & (F.array_contains(menu, b["node"]) | F.array_contains(slots, b["around"]))))
    left = F.when(F.size(kept) > 0, kept).otherwise(F.when(F.size(main) > 0, main).otherwise(F.col("blocks")))
    return rows.select("page_id", "url", F.array_join(F.transform(left, lambda b: b["text"]), "\n\n").alias("text"))
