"""Operator 5: main text of web pages by wrapper induction.

Pages of a host with the same outline (the paths of tags down to OUTLINE_DEPTH) have one layout,
and each layout a reference page. Every page's DOM tree is aligned with its layout's reference by
simple tree matching (the largest set of matched nodes that keeps order and parents). The
reference's blocks are slots. A slot that holds few different texts for the different articles of
its layout, one in all of them or some in turn, is template; slots that vary with the article,
and what matches no slot, are content. Near copies count as one article, so copied articles don't
make template of their text; inside an `article` only short blocks that never vary are template.

Where the wrapper leaves it open, as on a host of few pages, HTML itself is heeded: elements for
menus, forms, scripts and the like, and classes and roles named so, aren't content, and an
`article` (or `main`), the one with the most text, of equal ones the first, is where content is.

All pages of a host count. A task sends a row for each different text of a slot that it saw;
they are counted by Spark. Wrappers are broadcast if they are under REFERENCE_BYTES in all, and
joined on host and layout otherwise.

A null or empty page has an empty text, and so has one without any content. A null url has an
empty host. Repeated rows each return. Empty tables give empty results; extra columns are
ignored. Unclosed elements end with their parent, a cut page ends where it ends. Pages of any
length and depth are worked through whole, without recursion; what aligning takes is bounded, see
align(), and layouts of too few pages for a template aren't aligned.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wonweave.llm import common

REFERENCE_BYTES = 16_000_000
OUTLINE_DEPTH = 3
#: Different articles that a layout must have, and the most different texts of a template slot for each of them.
LEAST_ARTICLES, MOST_TEXTS = 3, 0.5
#: Numbers that the weighing of two lists of children takes at most; pairs of shapes that are weighed for two pages.
CELLS, PAIRS = 1 << 22, 1 << 18
#: Numbers up to which two lists are weighed without arrays; numbers that a layout keeps of shapes between pages.
FEW, KEPT = 256, 20_000
#: Inside an article only blocks of so many words can be template.
SHORT_WORDS = 8

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: A start tag closes an open element of these before it (up to an element that isn't named here as its limit).
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
NOT_CONTENT = frozenset("head nav footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu title noembed noframes audio video map datalist".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus footer login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Za-z0-9]+")


class Node:
    __slots__ = ("attrs", "items", "kids", "tag", "text")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs = tag, attrs
        self.items: list[Node | str] = []  # in order
        self.kids: list[Node] = []
        self.text: str | None = None


def parse(page: str) -> Node:
    root = Node("#", "")
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def close(i: int) -> None:
        for n in stack[i:]:
            opened[n.tag] -= 1
        del stack[i:]

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].items.append(page[at:])
            break
        if m.start() > at:
            stack[-1].items.append(page[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if opened[tag]:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            continue
        if tag in CLOSES_P:
            if opened["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag in BLOCK:
                        break
        elif tag in CLOSED_BY:
            if any(opened[t] for t in CLOSED_BY[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in CLOSED_BY[tag]:
                        close(i)
                        break
                    if stack[i].tag in ("ul", "ol", "dl", "table", "select", "menu"):
                        break
        node = Node(tag, m[3])
        stack[-1].items.append(node)
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            node.items.append(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
        if tag in RAW or tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
            opened[tag] += 1
    return root


def below(node: Node) -> Iterator[Node]:
    """In order."""
    todo = node.kids[::-1]
    while todo:
        x = todo.pop()
        yield x
        todo += x.kids[::-1]


def own_text(node: Node) -> str:
    """The text of a node and what isn't a block in it, as one string of single spaces; blocks in it have their own."""
    if node.text is None:
        out, todo = [], node.items[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag in BLOCK:
                out.append(" ")
            elif x.tag not in NOT_CONTENT:
                todo += x.items[::-1]
        node.text = " ".join(html.unescape("".join(out)).split())
    return node.text


class Shapes:
    """Trees of tags, numbered: nodes of one shape have the same tags below them in the same order. What matching has found of pairs of shapes is kept, see align()."""

    def __init__(self):
        self.number: dict[tuple[str, tuple[int, ...]], int] = {}
        self.tag: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.below: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.total: dict[tuple[int, int], int] = {}
        self.held = 0

    def of(self, root: Node) -> dict[int, int]:
        """The shape of each node, by id."""
        out: dict[int, int] = {}
        number = self.number
        for node in reversed([root, *below(root)]):
            key = (node.tag, tuple([out[id(k)] for k in node.kids]) if node.kids else ())
            n = number.get(key)
            if n is None:
                n = number[key] = len(self.tag)
                self.tag.append(key[0])
                self.kids.append(key[1])
                self.size.append(1 + sum(self.size[k] for k in key[1]))
                self.held += 4 + len(key[1])
            out[id(node)] = n
        return out


def _in_order(xs: list[str], ys: list[str]) -> list[tuple[int, int]]:
    """Pairs of equal tags that keep order: each of xs with the next of ys that is left."""
    places: dict[str, list[int]] = {}
    for j, tag in enumerate(ys):
        places.setdefault(tag, []).append(j)
    out, last = [], -1
    for i, tag in enumerate(xs):
        mine = places.get(tag, [])
        k = bisect.bisect_right(mine, last)
        if k < len(mine):
            last = mine[k]
            out.append((i, last))
    return out


def _heaviest(xs: list[int], ys: list[int], weight: Callable[[int, int], int]) -> list[tuple[int, int]]:
    """The heaviest pairs of shapes that keep order."""
    if len(xs) * len(ys) <= FEW:
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            above, row, left = rows[-1], [0], 0
            for j, y in enumerate(ys):
                w = weight(x, y)
                left = max(above[j] + w, above[j + 1], left) if w else max(above[j + 1], left)
                row.append(left)
            rows.append(row)
        return _back(rows, len(xs), len(ys))
    (ux, ix), (uy, iy) = (np.unique(np.array(z, np.int64), return_inverse=True) for z in (xs, ys))
    each = np.array([[weight(int(x), int(y)) for y in uy] for x in ux], np.int32)[:, iy]
    best = np.zeros((len(xs) + 1, len(ys) + 1), np.int32)
    for i, k in enumerate(ix.tolist()):
        np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + each[k]), out=best[i + 1, 1:])
    return _back(best, len(xs), len(ys))


def _back(best: list[list[int]] | np.ndarray, i: int, j: int) -> list[tuple[int, int]]:
    pairs = []
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def align(a: Node, b: Node, shapes: Shapes | None = None, of: dict[int, int] | None = None) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of nodes of equal tags, in order, under matched parents; as many as can be.

    What pairs of nodes weigh follows from their shapes, so it is found once for each pair of shapes. Children of
    like shapes at both ends of two lists go together, which no other matching betters; only what lies between is
    weighed. That takes CELLS numbers for two lists, and PAIRS pairs of shapes for two pages at most; children
    beyond go together in order of their tags, and what is below such a pair isn't matched unless its shape is the same.
    `shapes` and `of` (those of a's nodes) save finding them again for other pages.
    """
    if a.tag != b.tag:
        return []
    shapes = shapes or Shapes()
    of_a, of_b = of or shapes.of(a), shapes.of(b)
    tag, kids, below_of, total = shapes.tag, shapes.kids, shapes.below, shapes.total

    def weight(x: int, y: int) -> int:
        return 0 if tag[x] != tag[y] else shapes.size[x] if x == y else total.get((x, y), 1)

    asked, todo = 0, [(of_a[id(a)], of_b[id(b)])]
    while todo:
        x, y = todo[-1]
        if x == y or (x, y) in total:
            todo.pop()
            continue
        xs, ys = kids[x], kids[y]
        most = min(len(xs), len(ys))
        head = next((k for k in range(most) if xs[k] != ys[k]), most)
        tail = next((k for k in range(most - head) if xs[-1 - k] != ys[-1 - k]), most - head)
        mid_x, mid_y = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        few_x, few_y = dict.fromkeys(mid_x), dict.fromkeys(mid_y)
        weighed = len(mid_x) * len(mid_y) <= CELLS and len(few_x) * len(few_y) <= PAIRS
        first = [(c, d) for c in few_x if kids[c] for d in few_y if c != d and tag[c] == tag[d] and kids[d] and (c, d) not in total] if weighed and asked < PAIRS else []
        if first:
            asked += len(first)
            todo += first
            continue
        todo.pop()
        if not mid_x or not mid_y:
            pairs = []
        elif weighed:
            pairs = _heaviest(mid_x, mid_y, weight)
        else:
            pairs = _in_order([tag[k] for k in mid_x], [tag[k] for k in mid_y])
        found = [*((k, k) for k in range(head)), *((head + i, head + j) for i, j in pairs), *((len(xs) - k, len(ys) - k) for k in range(tail, 0, -1))]
        below_of[x, y] = found
        shapes.held += 4 + len(found)
        total[x, y] = 1 + sum(weight(xs[i], ys[j]) for i, j in found)
    out, nodes = [], [(a, b)]
    while nodes:
        x, y = nodes.pop()
        out.append((x, y))
        sx, sy = of_a[id(x)], of_b[id(y)]
        nodes += zip(x.kids, y.kids, strict=True) if sx == sy else [(x.kids[i], y.kids[j]) for i, j in below_of.get((sx, sy), [])]
    return out


def says_boilerplate(node: Node, inside: bool) -> bool:
    """What the element or its attributes say; a header inside the article that holds its title is content."""
    if node.tag in NOT_CONTENT:
        return True
    if node.tag == "header":
        return not (inside and any(x.tag in ("h1", "h2", "hgroup") for x in below(node)))
    if not node.attrs or node.tag in ("body", "html", "#"):
        return False
    for name, *values in _NAMED.findall(node.attrs):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name == "role" and value in ROLES:
            return True
        if name in ("class", "id") and NAMES.intersection(_WORD.findall(value)):
            return True
    return False


def content_root(root: Node) -> Node:
    """The article with the most text, or main, or the page."""
    for tag in ("article", "main"):
        found, todo = [], root.kids[::-1]
        while todo:
            x = todo.pop()
            if x.tag == tag and not says_boilerplate(x, True):
                found.append(x)
            elif not says_boilerplate(x, False) or x.tag == "body":
                todo += x.kids[::-1]
        if len(found) == 1:
            return found[0]
        if found:
            return max(found, key=lambda n: len(" ".join(blocks(n))))
    return root


_END = object()


def blocks(node: Node, template: frozenset[int] = frozenset(), inside: bool = True) -> list[str]:
    """Texts of the blocks in order, each with single spaces; without what isn't content, and without the own text of the nodes in `template` (by id)."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    todo: list = node.items[::-1]
    while todo:
        x = todo.pop()
        if x is _END:
            end()
        elif isinstance(x, str):
            held.append(x)
        elif says_boilerplate(x, inside):
            if x.tag in BLOCK:
                end()
        else:
            if x.tag in BLOCK:
                end()
                todo.append(_END)
            # of a template node blocks in it are judged by themselves
            todo += [y for y in reversed(x.items) if isinstance(y, Node) and y.tag in BLOCK] if id(x) in template else x.items[::-1]
    end()
    return out


def text_of(root: Node, template: frozenset[int] = frozenset()) -> str:
    top = content_root(root)
    return " ".join(blocks(top, template, top.tag in ("article", "main")))


def host_of(url: str | None) -> str:
    m = re.search(r"://([^/?#]*)", url or "")
    return m[1].translate(_LOWER) if m else ""


_LOWER = {c: c + 32 for c in range(65, 91)}


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def outline(root: Node) -> int:
    """Of the paths of tags down to OUTLINE_DEPTH, each once."""
    found, now = set(), [("", root)]
    for _ in range(OUTLINE_DEPTH):
        now = [(f"{path}/{x.tag}", x) for path, n in now for x in n.kids]
        found.update(path for path, _ in now)
        now = [(path, x) for path, x in now if x.tag not in ("head", "article", "main")]
    return _digest("\n".join(sorted(found)))


class Wrapper:
    """A layout's reference page, its slots in order, and which of them are template or never vary."""

    def __init__(self, page: str, template: tuple[int, ...] = (), constant: tuple[int, ...] = ()):
        self.root = parse(page)
        self.number = {id(n): i for i, n in enumerate(below(self.root))}
        self.template, self.constant = frozenset(template), frozenset(constant)
        self.shapes = Shapes()
        self.of = self.shapes.of(self.root)

    def align(self, root: Node) -> list[tuple[Node, Node]]:
        """align() with the reference; what was found of its shapes is kept for other pages of the layout."""
        if self.shapes.held > KEPT:
            self.shapes = Shapes()
            self.of = self.shapes.of(self.root)
        return align(self.root, root, self.shapes, self.of)

    def slots(self, root: Node) -> list[tuple[int, str]]:
        """(slot, text) of what a page has in the slots."""
        return [(self.number[id(x)], own_text(y)) for x, y in self.align(root) if x.tag in BLOCK and own_text(y)]

    def removed(self, root: Node) -> frozenset[int]:
        """Nodes (by id) of a page that are template."""
        if not self.template:
            return frozenset()
        top = content_root(root)
        article = {id(n) for n in (top, *below(top))} if top.tag in ("article", "main") else set()
        out, pairs = set(), self.align(root)
        matched = {id(y) for _, y in pairs}
        for x, y in pairs:
            slot = self.number.get(id(x))
            if id(y) not in article:
                if slot in self.template:
                    out.add(id(y))
                # a list may be longer than the reference's: more of what is all template is template
                for z in y.kids:
                    if id(z) not in matched and z.tag in BLOCK and id(z) not in article:
                        alike = [self.number[id(c)] in self.template for c in x.kids if c.tag == z.tag]
                        if alike and all(alike):
                            out.add(id(z))
            elif slot in self.constant and len(own_text(y).split()) <= SHORT_WORDS:
                out.add(id(y))
        return frozenset(out)

    def extract(self, root: Node) -> str:
        return text_of(root, self.removed(root))


_WRAPPERS: dict[tuple, Wrapper] = {}


def wrapper(page: str, template: tuple[int, ...] = (), constant: tuple[int, ...] = ()) -> Wrapper:
    key = (hashlib.blake2b(page.encode(), digest_size=16).digest(), template, constant)
    if key not in _WRAPPERS:
        if len(_WRAPPERS) >= 500:
            _WRAPPERS.clear()
        _WRAPPERS[key] = Wrapper(page, template, constant)
    return _WRAPPERS[key]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else ([],) * len(schema), schema, strict=True)], schema=schema)


def _references(keyed: DataFrame) -> DataFrame:
    """host, layout, pages, reference: the smallest page of each layout, one of 200 characters or more if there is. A task sends its smallest, and how many it saw."""
    schema = pa.schema([("host", pa.string()), ("layout", pa.int64()), ("trivial", pa.bool_()), ("size", pa.int64()), ("html", pa.string()), ("pages", pa.int64())])

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[str, int], tuple[bool, int, str]] = {}
        pages: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
                key, mine = (host, outline(parse(page))), (len(page) < 200, len(page), page)
                pages[key] += 1
                if key not in least or mine < least[key]:
                    least[key] = mine
        for key, mine in least.items():
            yield _batch(schema, [(*key, *mine, pages[key])])

    sent = keyed.select("host", "html").mapInArrow(run, "host string, layout long, trivial boolean, size long, html string, pages long")
    return sent.groupBy("host", "layout").agg(F.sum("pages").alias("pages"), F.min(F.struct("trivial", "size", "html")).alias("r")).select("host", "layout", "pages", F.col("r.html").alias("reference"))


def _with_layout(keyed: DataFrame) -> DataFrame:
    """`keyed` with the layout of each page."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = T.StructType([*keyed.schema.fields, T.StructField("layout", T.LongType())])
    schema = to_arrow_schema(wanted)

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([outline(parse(p)) for p in batch.column("html").to_pylist()], pa.int64())], schema=schema)

    return keyed.mapInArrow(run, wanted)


def _over_pages(keyed: DataFrame, wrappers: DataFrame, begin: Callable, schema: T.StructType) -> DataFrame:
    """What begin()(row, root, (reference, template, constant) or None) returns for each page of `keyed`, and at last for None. Wrappers are broadcast where they are small."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow, shared = to_arrow_schema(schema), None
    n = wrappers.agg(F.sum(F.octet_length("reference") + 8 * F.size("template")).alias("b"), F.count("*").alias("n")).first()
    if (n.b or 0) + 100 * n.n <= REFERENCE_BYTES:
        rows = wrappers.select("host", "layout", "reference", "template", "constant").collect()
        shared = keyed.sparkSession.sparkContext.broadcast({(r.host, r.layout): (r.reference, tuple(r.template), tuple(r.constant)) for r in rows})
    else:
        keyed = _with_layout(keyed).join(wrappers, ["host", "layout"], "left")

    @common.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begin()
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                root = parse(row["html"])
                if shared is not None:
                    found = shared.value.get((row["host"], outline(root)))
                else:
                    found = (row["reference"], tuple(row["template"]), tuple(row["constant"])) if row["reference"] is not None else None
                out += work(row, root, found)
            yield _batch(arrow, out)

    return keyed.mapInArrow(run, schema)


def _slots() -> Callable:
    """A row for each different (host, layout, slot, text, article) that a task saw. Of the blocks half as long as the longest the least digest names the article."""
    seen: set[tuple] = set()

    def work(row: dict, root: Node, found: tuple | None) -> list[tuple]:
        texts = [(slot, text.count(" ") + 1, _digest(text)) for slot, text in wrapper(found[0]).slots(root)] if found else []
        if not texts:
            return []
        longest = max(words for _, words, _ in texts)
        article = min(d for _, words, d in texts if 2 * words >= longest)
        where = (row["host"], outline(root))
        new = {(*where, slot, d, article) for slot, _, d in texts} - seen
        if len(seen) < 200_000:
            seen.update(new)
        return list(new)

    return work


def _texts() -> Callable:
    def work(row: dict, root: Node, found: tuple | None) -> list[tuple]:
        return [(row["page_id"], row["url"], wrapper(*found).extract(root) if found and found[1] else text_of(root))]

    return work


def induced(pages: DataFrame) -> DataFrame:
    """host, layout, reference, template, constant (slots) of every layout with template; written to shared storage."""
    keyed = _keyed(pages)
    none = F.array().cast("array<int>")
    smallest = common.staged(_references(keyed), "references")
    # fewer pages have too few articles for a template
    references = smallest.filter(F.col("pages") >= LEAST_ARTICLES).withColumn("template", none).withColumn("constant", none)
    found = _over_pages(keyed, references, _slots, T.StructType.fromDDL("host string, layout long, slot int, text long, article long"))
    counted = found.groupBy("host", "layout", "slot").agg(F.countDistinct("text").alias("n"), F.countDistinct("article").alias("articles"))
    few = counted.filter((F.col("articles") >= LEAST_ARTICLES) & (F.col("n") <= F.greatest(F.lit(1), F.floor(F.col("articles") * MOST_TEXTS))))
    slots = few.groupBy("host", "layout").agg(F.sort_array(F.collect_list("slot")).alias("template"), F.sort_array(F.collect_list(F.when(F.col("n") == 1, F.col("slot")))).alias("constant"))
    out = common.staged(references.select("host", "layout", "reference").join(slots, ["host", "layout"]), "wrappers")
    common.drop(smallest)
    return out


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", common.host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row."""
    return _over_pages(_keyed(pages), induced(pages), _texts, T.StructType.fromDDL("page_id long, url string, text string"))


def digests(found: DataFrame) -> DataFrame:
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
