"""HTML extraction by wrapper induction over pages of one host.

Each page is parsed once into a tree of blocks. Of its slots those that may hold
the article are taken: those inside ``article`` or ``main`` where a page has
one, else those outside navigation, headers, footers, asides, forms and of
nodes named after adverts, notices, comments and the like, with little link text.

Pages with text in the same paths of tags are one layout. Every distinct page is
aligned by simple tree matching with two representatives: a page of its host's most
frequent layout and one of its own layout. A block's slot is the representative's
block that it is aligned with; a block without one is in the slot of its path. What
is template is counted over the whole host: a block (its path and its text) that
stays in one slot on most of the host's distinct pages with that path, or on most of
those of a layout with pages enough. The same words in changing places are none.
Trees travel as skeletons (tags and hashes of texts). Counts are aggregated before
they are shuffled; then a host's constant blocks are taken from each of its pages,
whichever partition it lies in.

Pages with the same whole slot text are copies; each distinct page is
counted once as evidence of what the template is, so copied articles are kept.

Defined cases: null or empty html gives an empty text; a null url belongs to the
empty host; a host of fewer than HOST_PAGES distinct pages has no template but by
names; markup need not be closed and may nest to any depth; inside the article, paragraphs, headings,
tables and the like are text whatever their class or id says, and `side` and `discussion` are not taken as
names of template; equal rows are each returned.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.llm.common import released, sized, stored
from ratecast.llm.url_tree import host_of

#: Pages parsed at once.
BATCH_PAGES = 64
#: Recursion over block trees is in Python frames only, so markup may nest as deep as a page is long.
FRAMES = 10 ** 7
#: A longer path goes on from its hash.
PATH_CHARS = 1000
#: Template: on so many distinct pages at least (of the host, of one layout), and on this share of those with its path.
HOST_PAGES, LAYOUT_PAGES, SAME_SHARE = 3, 8, 0.6
#: Bytes of representatives' skeletons up to which they are broadcast; more are joined by shuffling.
BROADCAST_BYTES = 16 << 20

#: Kinds of elements.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search
section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math object textarea title".split())
DROPPED = frozenset("head nav footer aside form button select option label fieldset dialog menu canvas audio video".split())
CLOSES_P = BLOCKS - {"body", "html"}
ENDS_BEFORE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
LIST_LIKE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
NAMES = re.compile(r"""(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert
|popup|modal|overlay|newsletter|subscri\w*|signup|login|comments?|commentlist|repl(?:y|ies)|respond|disqus|discussion|sidebar
|side|widget\w*|related|recommend\w*|share|sharing|social|breadcrumbs?|nav\w*|menu\w*|pagination|pager|footer|masthead|toolbar
|skip|hidden)(?:$|[\s_-])""", re.I | re.X)
#: Names that also are what an article is about, and elements that hold its text: see ``parse``.
AMBIGUOUS = re.compile(r"(?<![^\s_-])(?:side|discussion)(?![^\s_-])", re.I)
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote dl dt dd figure figcaption table thead tbody tfoot tr td th".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^<>]*$|[^<]+|<", re.S)
RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I) for tag in RAW}
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


class Block:
    """A block element: its children are blocks and texts; ``links`` counts link text, ``sig`` is its
    shape, ``own`` the text of its own."""

    __slots__ = ("tag", "out", "main", "children", "links", "chars", "sig", "size", "own")

    def __init__(self, tag: str, out: bool, main: bool):
        self.tag, self.out, self.main = tag, out, main
        self.children: list = []
        self.links = self.chars = 0
        self.sig, self.size, self.own = 0, 1, ""

    def blocks(self) -> list[Block]:
        return [c for c in self.children if isinstance(c, Block)]


def parse(page: str) -> Block:
    """The block tree of a page, whatever its markup leaves open."""
    root = Block("", False, False)
    stack: list[tuple[str, Block | None]] = [("", root)]  # None: an inline element
    at, link, mains, text = [root], 0, 0, []

    def flush() -> None:
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            if s:
                at[-1].children.append(s)
            text.clear()

    def close(i: int) -> None:
        nonlocal link, mains
        closed = [b for _, b in stack[i:] if b is not None]
        link -= sum(tag == "a" for tag, b in stack[i:] if b is None)
        if closed:
            flush()
            del at[-len(closed):]
            mains -= sum(b.main for b in closed)
        del stack[i:]

    pos = 0
    while pos < len(page):
        m = TOKEN.match(page, pos)
        pos, tag = m.end(), m[2]
        if tag is None:
            s = m[0]
            if s == "<" or s[0] != "<":
                text.append(s)
                at[-1].chars += len(s)
                if link:
                    at[-1].links += len(s)
            continue
        tag = tag.lower()
        if m[1]:  # an end
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][1] is not None and tag not in BLOCKS:
                    break  # inline ends do not close blocks
            continue
        if tag in RAW:
            if m[3][-1:] != "/":
                end = RAW_END[tag].search(page, pos)
                pos = end.end() if end else len(page)
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][1] is not None:
                    break
        if tag in ENDS_BEFORE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ENDS_BEFORE[tag]:
                    close(i)
                    break
                if stack[i][0] in LIST_LIKE.get(tag, ()):
                    break
        if tag == "br" or tag == "img":
            text.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCKS or tag in DROPPED:
            flush()
            names, out = "", False
            if m[3]:
                for k, *v in ATTRIBUTE.findall(m[3]):
                    k, v = k.lower(), "".join(v)
                    out |= k == "role" and v.lower() in ROLES or k == "hidden" and not v
                    if k in ("class", "id"):
                        names += f" {v}"
            inside = mains > 0
            named = tag not in ("html", "body", "article", "main") and bool(NAMES.search(names))
            if inside and named:  # in an article, paragraphs and the like are its text whatever they are called
                named = tag not in TEXTUAL and bool(NAMES.search(AMBIGUOUS.sub(" ", names)))
            out |= tag in DROPPED or tag == "header" and not inside or named
            b = Block(tag, out, tag in ("article", "main"))
            at[-1].children.append(b)
            at.append(b)
            mains += b.main
            stack.append((tag, b))
        elif m[3][-1:] != "/":
            stack.append((tag, None))
            link += tag == "a"
    close(1)
    flush()
    _shape(root)
    return root


def _shape(b: Block) -> None:
    for c in b.blocks():
        _shape(c)
    kids = b.blocks()
    b.size = 1 + sum(c.size for c in kids)
    b.sig = hash((b.tag, b.out, *(c.sig for c in kids)))
    b.own = "\n".join(c for c in b.children if isinstance(c, str))


def match(a: Block, b: Block, memo: dict) -> int:
    """Simple tree matching: the most nodes that two trees share in order, roots alike."""
    if a.tag != b.tag or a.out != b.out:
        return 0
    if a.sig == b.sig:
        return a.size
    key = (a.sig, b.sig)
    if key not in memo:
        memo[key] = 1 + _table(a.blocks(), b.blocks(), memo)[0]
    return memo[key]


def _table(x: list[Block], y: list[Block], memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """(size, pairs of places) of the best order-keeping match of two lists.

    Alike ends match outright: first those with the same text, so that a constant block stays with itself, then
    those of the same shape.
    """
    lo, hi, least = 0, 0, min(len(x), len(y))
    while lo < least and x[lo].sig == y[lo].sig and x[lo].own == y[lo].own:
        lo += 1
    while hi < least - lo and x[-1 - hi].sig == y[-1 - hi].sig and x[-1 - hi].own == y[-1 - hi].own:
        hi += 1
    while lo < least - hi and x[lo].sig == y[lo].sig:
        lo += 1
    while hi < least - lo and x[-1 - hi].sig == y[-1 - hi].sig:
        hi += 1
    pairs = [(i, i) for i in range(lo)] + [(len(x) - 1 - i, len(y) - 1 - i) for i in range(hi)]
    size = sum(x[i].size for i, _ in pairs)
    u, v = x[lo:len(x) - hi], y[lo:len(y) - hi]
    if u and v:
        shape, at = np.unique([q.sig for q in v], return_inverse=True)
        like = [next(q for q in v if q.sig == k) for k in shape.tolist()]
        best = np.zeros((len(u) + 1, len(v) + 1), np.int32)
        gains: dict[int, np.ndarray] = {}
        for i, p in enumerate(u):
            if p.sig not in gains:
                gains[p.sig] = np.array([match(p, q, memo) for q in like], np.int32)[at]
            best[i + 1, 1:] = np.maximum.accumulate(np.maximum(best[i, 1:], best[i, :-1] + gains[p.sig]))
        i, j = len(u), len(v)
        while i and j:
            if best[i, j] == best[i - 1, j]:
                i -= 1
            elif best[i, j] == best[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((lo + i, lo + j))
        size += int(best[-1, -1])
    return size, pairs


def align(a: Block, b: Block, memo: dict) -> Iterator[tuple[Block, Block]]:
    """The pairs of aligned blocks of two trees."""
    todo = [(a, b)]
    while todo:
        p, q = todo.pop()
        yield p, q
        x, y = p.blocks(), q.blocks()
        if x and y:
            todo += [(x[i], y[j]) for i, j in _table(x, y, memo)[1] if x[i].tag == y[j].tag and x[i].out == y[j].out]


def slots(root: Block) -> list[Block]:
    """The blocks that may hold the article, in page order."""
    found: list[Block] = []

    def walk(b: Block, inside: bool, wanted: bool) -> None:
        if b.out:
            return
        inside = inside or b.main
        if inside or not wanted:
            found.append(b)
        for c in b.blocks():
            walk(c, inside, wanted)

    walk(root, False, _has_main(root))
    return found


def _has_main(b: Block) -> bool:
    todo = [b]
    while todo:
        b = todo.pop()
        if b.out:
            continue
        if b.main:
            return True
        todo += b.blocks()
    return False


def preorder(root: Block) -> list[Block]:
    """The blocks of a tree, each before its children; ``skeleton`` and pieces number them so."""
    out, todo = [], [root]
    while todo:
        b = todo.pop()
        out.append(b)
        todo += b.blocks()[::-1]
    return out


def skeleton(root: Block) -> tuple[str, bytes]:
    """The tree below the root as tags (``!``: out, ``)``: its end), and 32 bits for each block's own text."""
    tags: list[str] = []
    todo: list[Block | None] = root.blocks()[::-1]
    while todo:
        b = todo.pop()
        if b is None:
            tags.append(")")
            continue
        tags.append(b.tag + "!" * b.out)
        todo.append(None)
        todo += b.blocks()[::-1]
    own = [digest(b.own) & 0xFFFFFFFF if b.own else 0 for b in preorder(root)]
    return " ".join(tags), np.array(own, "<u4").tobytes()


def from_skeleton(tags: str, own: bytes) -> Block:
    """A tree to align: ``own`` of its blocks are numbers."""
    texts = iter(np.frombuffer(own, "<u4").tolist())
    at = [Block("", False, False)]
    at[0].own = next(texts)

    def end(b: Block) -> None:
        kids = b.blocks()
        b.size = 1 + sum(c.size for c in kids)
        b.sig = hash((b.tag, b.out, *(c.sig for c in kids)))

    for tag in tags.split():
        if tag == ")":
            end(at.pop())
        else:
            b = Block(tag.rstrip("!"), tag[-1] == "!", False)
            b.own = next(texts)
            at[-1].children.append(b)
            at.append(b)
    end(at[0])
    return at[0]


def slots_of(page: Block, like: Block) -> dict[int, int]:
    """Numbers of the page's blocks to those of the representative's that they are aligned with."""
    place, slot = ({id(b): i for i, b in enumerate(preorder(t))} for t in (page, like))
    return {place[id(p)]: slot[id(q)] for p, q in align(page, like, {})}


def pieces_of(root: Block, link_share: float = 0.6) -> list[tuple[str, str, int]]:
    """(block key, text, number of the block) of the article's candidates in page order: slots that are not mostly links.

    A key tells a block's path of tags and whole own text; texts of one block have the same key.
    """
    keep = {id(b) for b in slots(root) if not (b.links and b.links > link_share * b.chars and b.tag in ("li", "td", "div", "ul"))}
    number = {id(b): i for i, b in enumerate(preorder(root))}
    out: list[tuple[str, str, int]] = []

    def walk(b: Block, path: str) -> None:
        path = f"{path}/{b.tag}"
        if len(path) > PATH_CHARS:
            path = str(digest(path))
        for c in b.children:
            if isinstance(c, Block):
                walk(c, path)
            elif id(b) in keep:
                out.append((f"{path}\n{b.own}", c, number[id(b)]))

    walk(root, "")
    return out


def digest(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_facts(page: str) -> tuple[int, int, list[tuple[int, int, int, str]], tuple[str, bytes]]:
    """(layout, content, pieces, skeleton) of a page; a piece is (path, block key, number of the block, text), path and key as hashes.

    Pages whose text lies in the same set of paths have one layout, pages with the same pieces one content.
    """
    sys.setrecursionlimit(max(sys.getrecursionlimit(), FRAMES))
    root = parse(page)
    found = [(key.partition("\n")[0], key, at, text) for key, text, at in pieces_of(root)]
    layout = digest(*sorted({path for path, _, _, _ in found}))
    return (layout, digest(*[key for _, key, _, _ in found]),
            [(digest(path), digest(key), at, text) for path, key, at, text in found], skeleton(root))


def is_constant(pages: int, seen: int, layout: bool) -> bool:
    return pages >= (LAYOUT_PAGES if layout else HOST_PAGES) and pages >= SAME_SHARE * seen


def induce(pages: list[str]) -> list[str]:
    """The article text of every page of one host, by what its pages have in common: ``extract`` without Spark."""
    facts = [page_facts(p) for p in pages]
    distinct: dict = {}
    for layout, content, pieces, tree in facts:
        held = distinct.get((layout, content))
        if held is None or tree < held[1]:
            distinct[layout, content] = ([p[:3] for p in pieces], tree)
    layouts = Counter(layout for layout, _ in distinct)
    likes = {layout: distinct[min(k for k in distinct if k[0] == layout)][1] for layout in layouts}
    if layouts:
        likes[None] = likes[min(layouts, key=lambda k: (-layouts[k], k))]
    seen, same = Counter(), Counter()
    for (layout, _), (pieces, tree) in distinct.items():
        page = from_skeleton(*tree)
        for of in (None, layout):
            slot = slots_of(page, from_skeleton(*likes[of]))
            seen.update((of, path) for path in {p for p, _, _ in pieces})
            same.update({(of, slot.get(at, path), path, key) for path, key, at in pieces})
    constant = {(of, key) for (of, _, path, key), n in same.items() if is_constant(n, seen[of, path], of is not None)}
    return ["\n".join(t for _, key, _, t in pieces if (None, key) not in constant and (layout, key) not in constant)
            for layout, _, pieces, _ in facts]


def _constants(of: DataFrame, by: list[str], slots: str, least: int) -> DataFrame:
    """``*by, keys``: the block keys that are template, from (``*by``, pieces, slots of the pieces) of distinct pages."""
    zipped = F.array_distinct(F.zip_with("pieces", slots, lambda p, s: F.struct(s.alias("slot"), p["path"].alias("path"), p["key"].alias("key"))))
    each = of.where(F.col(slots).isNotNull()).select(*by, F.explode(zipped).alias("p"))
    paths = of.select(*by, F.explode(F.array_distinct(F.transform("pieces", lambda p: p["path"]))).alias("path"))
    same = each.groupBy(*by, "p.slot", "p.path", "p.key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    seen = paths.groupBy(*by, "path").agg(F.count("*").alias("seen"))
    return (same.join(seen, [*by, "path"]).where(F.col("n") >= SAME_SHARE * F.col("seen"))
            .groupBy(*by).agg(F.collect_set("key").alias("keys")))


def _representatives(distinct: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Skeletons (``host, host_like``) of the most frequent layout and (``host, layout, layout_like``) of each, of those with pages enough."""
    layouts = stored(distinct.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min_by("tree", "content").alias("like")), "page_layouts")
    hosts = (layouts.groupBy("host").agg(F.sum("n").alias("n"), F.min_by("like", F.struct(-F.col("n"), F.col("layout"))).alias("host_like"))
             .where(F.col("n") >= HOST_PAGES).drop("n"))
    return hosts, layouts.where(F.col("n") >= LAYOUT_PAGES).select("host", "layout", F.col("like").alias("layout_like"))


def _short(df: DataFrame, tree: str) -> DataFrame:
    """``df`` marked for broadcast if its skeletons were found to be small together."""
    n = df.agg(F.sum(F.length(F.col(tree)["tags"]) + F.length(F.col(tree)["own"]))).first()[0] or 0
    return F.broadcast(df) if n <= BROADCAST_BYTES else df


def aligned(distinct: DataFrame) -> DataFrame:
    """Distinct pages (``host, layout, pieces``) with the slots of their pieces by the alignment with the host's and the
    layout's representative (null: it has none)."""
    hosts, layouts = _representatives(distinct)
    both = (distinct.join(_short(hosts, "host_like"), "host", "left").join(_short(layouts, "layout_like"), ["host", "layout"], "left")
            .where(F.col("host_like").isNotNull()))  # a layout with pages enough has a host with pages enough

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.setrecursionlimit(max(sys.getrecursionlimit(), FRAMES))
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_PAGES):
                b = whole.slice(lo, BATCH_PAGES)
                found: tuple[list, list] = [], []
                for pieces, tree, *likes in zip(*(b.column(c).to_pylist() for c in ("pieces", "tree", "host_like", "layout_like"))):
                    page = from_skeleton(**tree)
                    for out, like in zip(found, likes):
                        slot = like and slots_of(page, from_skeleton(**like))
                        out.append(slot and [slot.get(p["at"], p["path"]) for p in pieces])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("host", "layout", "pieces")), *(pa.array(x, pa.list_(pa.int64())) for x in found)],
                                                 names=["host", "layout", "pieces", "host_slots", "layout_slots"])

    return both.select("host", "layout", "pieces", "tree", "host_like", "layout_like").mapInArrow(
        released(run), "host string, layout long, pieces array<struct<path: long, key: long, at: int>>, host_slots array<long>, layout_slots array<long>")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, text, n_chars`` for every page."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.struct([("path", pa.int64()), ("key", pa.int64()), ("at", pa.int32()), ("text", pa.string())])
        skeletons = pa.struct([("tags", pa.string()), ("own", pa.binary())])
        for b in batches:
            columns = [b.column(i) for i in range(3)]
            for lo in range(0, b.num_rows, BATCH_PAGES):
                facts = [page_facts(h or "") for h in b.column(3).slice(lo, BATCH_PAGES).to_pylist()]
                layout, content, found, trees = zip(*facts)
                found = [[{"path": x, "key": y, "at": i, "text": t} for x, y, i, t in f] for f in found]
                trees = [{"tags": t, "own": o} for t, o in trees]
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, BATCH_PAGES) for c in columns), pa.array(layout, pa.int64()),
                                                  pa.array(content, pa.int64()), pa.array(found, pa.list_(piece)), pa.array(trees, skeletons)],
                                                 names=["page_id", "url", "host", "layout", "content", "pieces", "tree"])

    parsed = stored(p.mapInArrow(run, "page_id long, url string, host string, layout long, content long, "
                                      "pieces array<struct<path: long, key: long, at: int, text: string>>, tree struct<tags: string, own: binary>"), "page_pieces")
    keys = F.transform("pieces", lambda x: F.struct(x["path"].alias("path"), x["key"].alias("key"), x["at"].alias("at")))
    # copies have the same pieces, but maybe other trees around them
    distinct = stored(parsed.groupBy("host", "layout", "content").agg(F.min(F.struct(F.col("tree"), keys.alias("pieces"))).alias("m"))
                      .select("host", "layout", "content", "m.tree", "m.pieces"), "page_contents")
    slotted = stored(aligned(distinct), "page_slots")
    by_host = sized(stored(_constants(slotted, ["host"], "host_slots", HOST_PAGES).withColumnRenamed("keys", "host_keys"), "host_constants"))
    by_layout = sized(stored(_constants(slotted, ["host", "layout"], "layout_slots", LAYOUT_PAGES).withColumnRenamed("keys", "layout_keys"), "layout_constants"))
    none = F.array().cast("array<long>")
    out = parsed.join(by_host, "host", "left").join(by_layout, ["host", "layout"], "left")
    gone = F.concat(F.coalesce("host_keys", none), F.coalesce("layout_keys", none))
    left = F.filter("pieces", lambda x: ~F.array_contains(gone, x["key"]))
    text = F.array_join(F.transform(left, lambda x: x["text"]), "\n")
    return out.select("page_id", "url", "host", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
