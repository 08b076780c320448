"""HTML extraction by wrapper induction over the pages of a host.

Every page is parsed into a tree. A host's reference page is aligned with
every other page of the host: siblings with the same text and label on both
sides hold the order, and what lies between them is aligned by simple tree
matching, each sibling by itself. A node of the reference is *constant* where
at least ``CONSTANT`` of the pages that teach something and have siblings of
its label there have the same text, and *varying* otherwise. Pages with the
same longest block of their own, which the reference does not have, count
once, and one with hardly any text of its own is a copy and teaches nothing;
how much boilerplate it shares does not matter. A host's reference is of its
most frequent layout; every other frequent layout has one besides. A reference
with its flags is a wrapper.

To extract, a page is aligned with its wrappers: constant nodes with the
wrapper's text are template; so are elements that say by tag, role or class
that they are menus, notices, adverts, forms or comments. The content is what
is left of the page's article element, or, where it has none, of the smallest
subtree with most of the text that is left.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from candela.llm import common

CONSTANT, LEAST_PAGES = 0.8, 5
#: Share of the remaining text that a subtree must hold to be gone into.
MOST = 0.7
#: Siblings that tree matching compares at once, and elements inside each other; a deeper one is put beside its parent.
WIDE, DEEP = 64, 200
#: Characters that a page must have besides the reference's, and pages from which on a layout has a reference of its own.
LEAST_TEXT, LAYOUT_PAGES = 40, 2 * LEAST_PAGES

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true)", re.IGNORECASE)

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that ends another one that is still open, up to a limit of the search.
CLOSES = {
    **{t: ({"p"}, frozenset({"td", "th", "li", "body"})) for t in BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dt", "dd"}},
    "li": ({"li", "p"}, frozenset({"ul", "ol", "menu"})),
    "dt": ({"dt", "dd", "p"}, frozenset({"dl"})),
    "dd": ({"dt", "dd", "p"}, frozenset({"dl"})),
    "tr": ({"tr", "td", "th", "p"}, frozenset({"table"})),
    "td": ({"td", "th", "p"}, frozenset({"tr", "table"})),
    "th": ({"td", "th", "p"}, frozenset({"tr", "table"})),
    "option": ({"option"}, frozenset({"select"})),
}
NEVER = frozenset("head script style noscript template iframe svg math nav footer aside form button select textarea dialog menu object canvas audio video input title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of a class or id that mark what is no content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar footer aside "
    "cookie cookies consent gdpr notice notices popup modal overlay alert newsletter subscribe subscription paywall "
    "comment comments reply replies respond disqus share sharing social related recommended widget form login signup search toolbar skip".split()
)
HEADER = frozenset({"header", "masthead"})
#: Words beside a mark that leave it one ("comment-list"); with any other, an article's element is content ("related-work").
STRUCTURE = frozenset(
    "area bar block body bottom box button buttons container content count date form group icon icons inline inner item items label large left "
    "link links list main meta mobile outer panel right row section slot small text thread title top unit wrap wrapper".split()
)
SIZE = re.compile(r"[0-9]+(?:x[0-9]+)?")
#: Only pages without one are searched for the subtree with most text.
MAIN = ("article", "main")
PARTS = re.compile(r"[a-z0-9]+")


def marking(name: str) -> bool:
    """Whether a class or id says no more than that its element is no content."""
    parts = frozenset(PARTS.findall(name))
    return bool(parts & MARKS) and all(p in MARKS or p in STRUCTURE or SIZE.fullmatch(p) for p in parts)


class Node:
    """An element: tag, words of its class and id, whether one of these marks it wholly, role, children (nodes and strings)."""

    __slots__ = ("tag", "marks", "marked", "role", "hidden", "kids", "template")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.marks, self.marked, self.role = tag, frozenset(), False, ""
        self.hidden, self.kids, self.template = False, [], False
        if attributes:
            for name, *value in ATTRIBUTE.findall(attributes):
                value = "".join(value).lower()
                if name.lower() == "role":
                    self.role = value.strip()
                else:
                    self.marks |= frozenset(PARTS.findall(value))
                    self.marked = self.marked or any(map(marking, value.split()))
            self.hidden = bool(HIDDEN.search(attributes))


def parse(page: str) -> Node:
    """Tree of a page. Unclosed and stray tags do what browsers make of them, as far as text goes."""
    root = Node("#")
    stack = [root]
    at = 0
    while True:
        m = TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            stack[-1].kids.append(page[at:end])
        if not m:
            return root
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            continue
        if m[1]:
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        ends, limit = CLOSES.get(tag, ((), ()))
        if ends:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    del stack[k:]
                elif stack[k].tag in limit:
                    break
        node = Node(tag, m[3])
        stack[-1].kids.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s>/])[^>]*>", re.IGNORECASE).search(page, at)
            node.kids.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
        elif tag not in VOID and not m[3].endswith("/") and len(stack) < DEEP:
            stack.append(node)


def refused(node: Node, inside: bool) -> bool:
    """Whether the element says that it is no content. ``inside``: it lies in an article."""
    if node.tag in ("html", "body"):
        return False  # their classes speak of the page as a whole
    if node.tag in NEVER or node.role in ROLES or node.hidden or (node.marked if inside else node.marks & MARKS):
        return True
    return not inside and (node.tag == "header" or bool(node.marks & HEADER))


def texts(node: Node, inside: bool = False) -> Iterator[str | None]:
    """Text of the content in page order; None at each place where a block begins or ends."""
    for kid in node.kids:
        if isinstance(kid, str):
            yield kid
        elif kid.tag in ("br", "hr"):
            yield None
        elif not kid.template and not refused(kid, inside):
            block = kid.tag in BLOCK
            if block:
                yield None
            yield from texts(kid, inside or kid.tag in MAIN)
            if block:
                yield None


def blocks(parts: Iterator[str | None]) -> str:
    """Blocks joined by a line end; character references decoded, white space made one space."""
    out, run = [], []
    for part in [*parts, None]:
        if part is not None:
            run.append(entities.unescape(part))
        elif run:
            if words := "".join(run).split():
                out.append(" ".join(words))
            run = []
    return "\n".join(out)


def weight(node: Node) -> int:
    return sum(len(x) for x in texts(node) if x)


def mains(node: Node, by_class: bool = True) -> list[Node]:
    """The outermost article or main elements outside what is refused; an article inside a main counts before it.

    ``by_class`` false: class and id of what stands around them are not asked.
    """
    out: list[Node] = []
    for kid in node.kids:
        if isinstance(kid, Node) and not kid.template and kid.tag not in NEVER and (not by_class or not refused(kid, False)):
            inner = mains(kid, by_class)
            own = (kid.tag in MAIN or kid.role in ("main", "article")) and not refused(kid, False)
            out += inner if inner and not (own and kid.tag == "article") else [kid] if own else inner
    return out


def content(root: Node) -> str:
    """Main text of a parsed page whose template nodes are marked."""
    # a wrapper around all may be called "with-sidebar"
    found = mains(root) or mains(root, by_class=False)
    if found:
        return blocks(x for node in found for x in (*texts(node, True), None))
    total = weight(root)
    while total:
        best = max((k for k in root.kids if isinstance(k, Node) and not k.template and not refused(k, False)), key=weight, default=None)
        if best is None or weight(best) < MOST * total or best.tag in ("p", "pre"):
            break
        root = best
    return blocks(texts(root))


# --- wrappers ---------------------------------------------------------------
# A tree is (label, hash of the text, length of the text, children, the node).


def fold(node: Node) -> tuple:
    """The tree of a node."""
    own, kids = [], []
    for kid in node.kids:
        if isinstance(kid, str):
            own.append(kid)
        elif kid.tag not in ("script", "style", "head", "br", "meta", "link"):
            kids.append(fold(kid))
    text = " ".join("".join(own).split())
    every = xxhash.xxh64(text.encode())
    for k in kids:
        every.update(k[1].to_bytes(8, "big"))
    label = node.tag + "".join(f".{m}" for m in sorted(node.marks))
    return label, every.intdigest(), len(text) + sum(k[2] for k in kids), kids, node


def match(a: tuple, b: tuple) -> tuple[int, list[tuple[tuple, tuple]]]:
    """The most pairs of nodes that keep labels, parents and order; one of equal texts counts as two."""
    if a[0] != b[0]:
        return 0, []
    n, pairs = aligned(a[3], b[3]) if a[3] and b[3] else (0, [])
    pairs.append((a, b))
    return n + 1 + (a[1] == b[1]), pairs


def aligned(x: list[tuple], y: list[tuple]) -> tuple[int, list[tuple[tuple, tuple]]]:
    """Pairs of siblings and of what is in them: equal ones first, linear in the siblings, then what lies between these."""
    score, pairs = 0, []
    same = itemgetter(0, 1)

    def take(n: int, found: list) -> None:
        nonlocal score
        score += n
        pairs.extend(found)

    parts = [(0, len(x), 0, len(y))]
    while parts:
        i, k, j, m = parts.pop()
        while i < k and j < m and same(x[i]) == same(y[j]):
            take(*match(x[i], y[j]))
            i, j = i + 1, j + 1
        while i < k and j < m and same(x[k - 1]) == same(y[m - 1]):
            k, m = k - 1, m - 1
            take(*match(x[k], y[m]))
        if i == k or j == m:
            continue
        if i + 1 == k and j + 1 == m:
            take(*match(x[i], y[j]))
            continue
        single = []
        shared = not {same(t) for t in x[i:k]}.isdisjoint(map(same, y[j:m]))
        if shared:
            own, other = Counter(map(same, x[i:k])), Counter(map(same, y[j:m]))
            place = {same(t): at for at, t in enumerate(y[j:m], j) if other[same(t)] == 1}
            single = [(at, place[same(t)]) for at, t in enumerate(x[i:k], i) if own[same(t)] == 1 and same(t) in place]
        if shared and not single:
            # repeated ones: the first with the first, and so on
            places: dict[tuple, list[int]] = {}
            for at in range(m - 1, j - 1, -1):
                places.setdefault(same(y[at]), []).append(at)
            single = [(at, places[same(x[at])].pop()) for at in range(i, k) if places.get(same(x[at]))]
        for p, q in rising(single):
            parts.append((i, p, j, q))
            take(*match(x[p], y[q]))
            i, j = p + 1, q + 1
        if single:
            parts.append((i, k, j, m))
            continue
        labels = {t[0] for t in (*x[i:k], *y[j:m])}
        if len(labels) == 1 and not any(t[3] for t in (*x[i:k], *y[j:m])):
            n = min(k - i, m - j)  # any order-keeping pairs are the most
            take(n, list(zip(x[i : i + n], y[j : j + n])))
            continue
        stretches = -(-max(k - i, m - j) // WIDE)
        for s in range(stretches):
            cut = [a + (b - a) * e // stretches for a, b in ((i, k), (j, m)) for e in (s, s + 1)]
            take(*most(x[cut[0] : cut[1]], y[cut[2] : cut[3]]))
    return score, pairs


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of the pairs (by first) whose seconds rise too."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for n, (_, q) in enumerate(pairs):
        k = bisect_left(ends, q)
        ends[k : k + 1], at[k : k + 1] = [q], [n]
        before.append(at[k - 1] if k else -1)
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def most(x: list[tuple], y: list[tuple]) -> tuple[int, list[tuple[tuple, tuple]]]:
    """Simple tree matching of a few siblings."""
    table = [[0] * (len(y) + 1)]
    found: dict[tuple[int, int], tuple[int, list]] = {}
    for i, p in enumerate(x):
        row = [0]
        for j, q in enumerate(y):
            n = 0
            if p[0] == q[0]:
                found[i, j] = match(p, q)
                n = found[i, j][0]
            row.append(max(table[i][j + 1], row[j], table[i][j] + n))
        table.append(row)
    i, j, pairs = len(x), len(y), []
    while i and j:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs += found[i, j][1]
    return table[-1][-1], pairs


def bare(tree: tuple) -> tuple:
    """A folded tree without its nodes, to be stored."""
    return tree[0], tree[1], tree[2], [bare(k) for k in tree[3]]


def numbered(tree: tuple, out: list | None = None) -> list[tuple]:
    """Nodes of a stored tree, in a fixed order."""
    out = [] if out is None else out
    out.append(tree)
    for k in tree[3]:
        numbered(k, out)
    return out


def evidence(page: tuple, reference: tuple) -> tuple[list[int], list[int], int]:
    """Numbers of the reference's nodes that the page could have, of those with the same text, and a hash of the page's own.

    It could have those that are matched, and, in a matched node that has
    children of their label, those that are not. A copy gives none.
    """
    order = {id(n): i for i, n in enumerate(numbered(reference))}
    pairs = match(page, reference)[1]
    shared = {id(p) for p, r in pairs if p[1] == r[1]}
    own = [(n[2] - sum(k[2] for k in n[3]), n[1]) for n in numbered(page) if id(n) not in shared]
    if sum(n for n, _ in own) < LEAST_TEXT:
        return [], [], 0
    seen = {order[id(r)] for _, r in pairs}
    for p, r in pairs:
        labels = {k[0] for k in p[3]}
        for k in r[3]:
            if k[0] in labels and order[id(k)] not in seen:
                seen.update(order[id(n)] for n in numbered(k))
    return sorted(seen), [order[id(r)] for p, r in pairs if p[1] == r[1]], max(own)[1]


def layout(tree: tuple) -> int:
    """Hash of the labels down to the children of the body, of siblings with one label one."""

    def labels(t: tuple, depth: int) -> str:
        kids = [k for k, _ in groupby(labels(k, depth - 1) for k in t[3])] if depth else []
        return f"{t[0]}({' '.join(kids)})"

    return xxhash.xxh64_intdigest(labels(tree, 3)) - (1 << 63)


def with_host(pages: DataFrame, url: str) -> DataFrame:
    """Adds ``__host``; urls without one, and null, share the empty host."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    return pages.withColumn("__host", host)


def wrappers(pages: DataFrame, html: str, url: str) -> DataFrame:
    """Rows (host, layout, wrappers) of the hosts with constant nodes; a wrapper is a stored tree and its constant nodes."""

    def skeleton(cols: dict[str, list]) -> dict[str, list]:
        trees, layouts = [], []
        for t in cols["__text"]:
            whole = fold(parse(t))
            trees.append(json.dumps(bare(whole)))
            layouts.append(layout(whole))
        return {"host": cols["__host"], "layout": layouts, "tree": trees}

    given = with_host(pages, url).select("__host", F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("__text"))
    trees = common.stored(common.map_batches(given, skeleton, "host string, layout long, tree string", slices=True))
    # any page of a layout can be the reference; the smallest hash makes the choice the same in every run
    h = F.xxhash64("tree")
    pages_of = trees.groupBy("host", "layout").agg(F.count_distinct(h).alias("n"))
    first = trees.groupBy("host", "layout").agg(F.min(F.struct(h.alias("h"), "tree")).alias("first"))
    own = common.stored(first.join(pages_of, ["host", "layout"]))
    main = own.groupBy("host").agg(F.max(F.struct("n", "layout")).alias("top")).select("host", "top.layout")
    top = own.join(main, ["host", "layout"]).select("host", F.col("layout").alias("top"), F.col("first").alias("main"))
    both = (F.col("layout") != F.col("top")) & (F.col("n") >= LAYOUT_PAGES)
    references = own.join(top, "host").select(
        "host", "layout", F.when(both, F.array("main", "first")).otherwise(F.array("main")).alias("references")
    )

    def teach(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"host": [], "h": [], "own": [], "nodes": []}
        known: dict[int, tuple] = {}
        for host, text, references in zip(cols["host"], cols["tree"], cols["references"]):
            tree = json.loads(text)
            for r in references:
                if r["h"] not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[r["h"]] = json.loads(r["tree"])
                seen, same, own = evidence(tree, known[r["h"]])
                if seen:
                    equal = set(same)
                    for name, value in (("host", host), ("h", r["h"]), ("own", own - (1 << 63)), ("nodes", [2 * i + (i in equal) for i in seen])):
                        out[name].append(value)
        return out

    taught = common.map_batches(
        trees.select("host", "layout", "tree").join(references, ["host", "layout"]), teach, "host string, h long, own long, nodes array<int>"
    )
    once = taught.groupBy("host", "h", "own").agg(F.min("nodes").alias("nodes"))
    counted = once.select("host", "h", F.explode("nodes").alias("node")).groupBy("host", "h", F.shiftright("node", 1).alias("node"))
    constant = common.stored(
        counted.agg(F.count("*").alias("seen"), F.sum(F.col("node") % 2).alias("same"))
        .where(f"seen >= {LEAST_PAGES} and same >= {CONSTANT} * seen")
        .groupBy("host", "h")
        .agg(F.sort_array(F.collect_list("node")).alias("constant"))
    )
    each = references.select("host", "layout", F.explode("references").alias("r")).select("host", "layout", "r.*")
    wrapper = F.struct("h", "tree", "constant")
    return each.join(constant, ["host", "h"]).groupBy("host", "layout").agg(F.sort_array(F.collect_list(wrapper)).alias("wrappers"))


def extract(
    pages: DataFrame, html: str = "html", url: str = "url", keep: Sequence[str] = ("page_id", "url")
) -> DataFrame:
    """The kept columns and ``text``, the main text of the page: empty if there is none or the html is null."""
    learned = common.stored(wrappers(pages, html, url))
    given = common.keep_and_text(with_host(pages, url), html, [*keep, "__host"])

    def placed(cols: dict[str, list]) -> dict[str, list]:
        return cols | {"__layout": [layout(fold(parse(t))) for t in cols["__text"]]}

    given = common.map_batches(given, placed, StructType([*given.schema.fields, StructField("__layout", LongType())]), slices="__text")
    here = (given["__host"] == learned["host"]) & (given["__layout"] == learned["layout"])
    joined = given.join(learned.withColumnRenamed("wrappers", "__wrappers"), here, "left").select(*[given[f"`{c}`"] for c in given.columns], "__wrappers")

    def run(cols: dict[str, list]) -> dict[str, list]:
        known: dict[int, tuple] = {}
        out = []
        for page, wrappers in zip(cols["__text"], cols["__wrappers"]):
            root = parse(page)
            whole = fold(root) if wrappers else None
            for w in wrappers or ():
                if w["h"] not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[w["h"]] = json.loads(w["tree"])
                tree, fixed = known[w["h"]], set(w["constant"])
                order = {id(n): i for i, n in enumerate(numbered(tree))}
                for p, r in match(whole, tree)[1]:
                    if order[id(r)] in fixed and p[1] == r[1]:
                        p[4].template = True
            out.append(content(root))
        cols["text"] = out
        return cols

    schema = ", ".join(x for x in (common.fields(pages, keep), "text string") if x)
    return common.map_batches(joined, run, schema, slices=True)
