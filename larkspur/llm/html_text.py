"""Main text of web pages, with site templates found by counting element subtrees per host.

Each page is parsed twice, for its subtrees and then for its text, so that texts are on disk once only, in the shuffle
that brings them to their templates.  Every element subtree of its body, before any rule by tag or class, gets a hash of its tags and text; Spark counts in how many different pages of its host (by a digest of their main text, so
copies of a page count once) each hash occurs, and subtrees on at least ``TEMPLATE_PAGES`` pages and ``TEMPLATE_SHARE`` of the host's
pages are deleted: menus, headers, footers, sidebars and notices that a site puts on its pages, whatever they are called.

Rules by tag, role, class and id then remove what templates cannot know: such elements on a host with few pages, and
those that differ from page to page, like comments and lists of related pages.  The main part is what is left inside the
articles of the page, or inside ``main`` where articles hold less than half of its text, or else the whole body.  Inside an
explicit main part only containers can be templates: a paragraph, heading or
list item there is the article's own, however often the site repeats it; the main part itself and what is around it is none.

Text blocks are the runs of text between block-level tags, in page order: character references decoded, white
space collapsed, joined by an empty line.  ``n_template_blocks`` counts the blocks that went as parts of
templates, ``n_rule_blocks`` the others outside the main text.

Defined cases: a null or empty page has empty text; broken, unclosed or truncated markup is read like a
browser does in outline (a block tag ends an open paragraph, an end tag without start is ignored);
a null url is a host of its own; repeated rows stay rows; extra columns stay out; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

TEMPLATE_PAGES, TEMPLATE_SHARE = 5, 0.01

TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"""
                 r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter
    nobr output progress q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dt dd figcaption".split())
DROPPED = frozenset("""nav footer aside form script style noscript template iframe svg canvas object button select
    textarea dialog menu head title audio video map applet datalist fieldset""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Words in a class or id that mark what is not article text, and those that mark the main part.
NOISE = re.compile(r"""(?:^|[^a-z])(?:ads?|adverts?|advertisements?|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?|cookies?
    |consent|gdpr|notices?|popups?|modals?|newsletters?|subscribe|subscription|sidebars?|menus?|nav|navbar|navigation|navs
    |breadcrumbs?|footers?|headers?|masthead|comments?|commentlist|disqus|replies|share|sharing|social|related
    |recommended|recommendations|widgets?|login|signup|signin|toolbar|pagination|pager|skip|skiplink|disclaimer|paywall)(?:$|[^a-z])""", re.X)
MAIN_WORDS = re.compile(r"(?:^|[^a-z])(?:article|main|content|post|entry|body|story|page|wrapper|container|layout)(?:$|[^a-z])")
ENDS_P = frozenset("""address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6
    header hr main menu nav ol p pre section table ul""".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                  "th": ("tr", "table"), "option": ("select",)}

Block = tuple[str, bool, tuple[int, ...]]
SALTS = 16                       # a template of a hot host meets its pages in so many groups


class Node:
    __slots__ = ("tag", "parent", "dropped", "parts", "size", "main")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, main: int):
        self.tag, self.parent, self.dropped, self.main = tag, parent, dropped, main
        self.parts: list = []                              # child nodes and raw text, in order
        self.size = 0                                      # characters of text below that is not dropped


def _noise(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is never article text."""
    if tag in DROPPED:
        return True
    if tag == "header":
        return not in_main
    if not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main") or name == "class" and tag == "article":
            if NOISE.search(value) and not (name == "class" and MAIN_WORDS.search(value) and tag != "article"):
                return True
    return False


def parse(page: str, rules: bool = True) -> tuple[Node, list[Node]]:
    """The tree of a page and its candidates for the main part; without ``rules`` no element is dropped."""
    root = Node("#root", None, False, 0)
    mains: list[Node] = []
    node, at, raw_end = root, 0, None
    for m in iter(lambda: TAG.search(page, at), None):
        if m.start() > at:
            node.parts.append(page[at:m.start()])
        at = m.end()
        end, start, attributes = m.group(1), m.group(2) or m.group(4), m.group(3) or m.group(5) or ""
        if end:
            end = end.lower()
            up = node
            while up is not None and up.tag != end:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
        elif start:
            tag = start.lower()
            if tag in ENDS_P:
                up = node
                while up.tag in INLINE or up.tag == "p":
                    up = up.parent
                # Only an open paragraph ends, with the inline elements inside it.
                p = node
                while p is not up and p.tag != "p":
                    p = p.parent
                if p is not up:
                    node = up
            if tag in CLOSED_BY_SAME:
                up = node
                while up.parent is not None and up.tag not in CLOSED_BY_SAME[tag] and up.tag != tag:
                    up = up.parent
                if up.tag == tag:
                    node = up.parent
            child = Node(tag, node, node.dropped or rules and _noise(tag, attributes, node.main > 0), node.main)
            node.parts.append(child)
            if tag in VOID or attributes.endswith("/") and tag not in INLINE and tag not in ENDS_P:
                continue
            if not child.dropped and (tag == "article" or tag == "main" or re.search(r"role\s*=\s*[\"']?main", attributes)):
                child.main = 2 if tag == "article" else max(1, child.main)
                mains.append(child)
            if tag in RAW:
                close = re.compile(f"</{tag}", re.I).search(page, at)
                at = close.start() if close else len(page)
            node = child
    if at < len(page):
        node.parts.append(page[at:])
    return root, mains


def _measure(root: Node) -> None:
    """Text sizes, bottom up without recursion."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(c for c in n.parts if isinstance(c, Node))
    for n in reversed(order):
        if not n.dropped:
            n.size = sum(c.size if isinstance(c, Node) else len(c.strip()) for c in n.parts)


def _main_parts(root: Node, mains: list[Node]) -> list[Node]:
    """The elements whose text is the page's: its outermost articles, or ``main``; none if it has neither."""
    held = [n for n in mains if n.size]
    inside: set[int] = set()                                # of an article or main further out
    for n in held:
        up = n.parent
        while up is not None:
            if any(up is m for m in held) and up.tag == n.tag:
                inside.add(id(n))
                break
            up = up.parent
    outer = [n for n in held if id(n) not in inside]
    articles, others = [n for n in outer if n.tag == "article"], [n for n in outer if n.tag != "article"]
    if not others:
        return articles
    largest = max(others, key=lambda n: n.size)

    def below(n: Node) -> bool:
        while n is not None and n is not largest:
            n = n.parent
        return n is largest
    return articles if 2 * sum(n.size for n in articles if below(n)) >= largest.size else [largest]


def blocks(page: str, rules: bool = True) -> list[Block]:
    """(text, whether of the main part, hashes of the subtrees around it that a template may be) of each block of the page."""
    root, mains = parse(page, rules)
    _measure(root)
    tops = _main_parts(root, mains)
    around = set()                                          # the main parts and all that holds them
    for n in tops:
        while n is not None:
            around.add(id(n))
            n = n.parent
    explicit = {id(n) for n in tops}
    out: list[tuple[str, bool, list[Node]]] = []
    texts: dict[int, list[str]] = {}                        # what each open subtree has held so far
    text: list[str] = []
    path: list[Node] = []
    within = [0, 0]                                         # open main parts, and open dropped elements

    def flush() -> None:
        s = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if s:
            out.append((s, not within[1] and (within[0] > 0 or not explicit), list(path)))
            for n in path:
                texts[id(n)].append(s)

    stack: list = [(root, 0, False)]
    while stack:
        n, i, gone = stack.pop()
        if i == 0 and n is not root and n.tag not in INLINE:
            flush()
            path.append(n)
            texts[id(n)] = [n.tag]
            within[0] += id(n) in explicit
            within[1] += gone
        while i < len(n.parts):
            c = n.parts[i]
            i += 1
            if isinstance(c, str):
                text.append(c)
            elif c.tag == "br" or c.tag == "wbr":
                text.append(" " if c.tag == "br" else "")
            elif c.tag in RAW or c.tag == "head":
                if c.tag not in INLINE:
                    flush()
            else:
                dropped = c.dropped or rules and c.tag == "header" and not c.main
                if c.tag in INLINE and dropped:
                    continue
                # Only the outermost of nested dropped elements counts.
                stack += [(n, i, gone), (c, 0, dropped and c.tag not in INLINE)]
                break
        else:
            if n.tag not in INLINE or n is root:
                flush()
                if n is not root:
                    within[0] -= id(n) in explicit
                    within[1] -= gone
                    path.pop()
                    for up in path:
                        texts[id(up)].append("/" + n.tag)
    hashes = {k: int.from_bytes(hashlib.blake2b("\n".join(v).encode(errors="replace"), digest_size=8).digest(), "big", signed=True)
              for k, v in texts.items() if len(v) > 1}

    def may_be(n: Node) -> bool:
        if id(n) in around or n.tag in ("html", "body"):
            return False
        # Outside an explicit main part a paragraph or list item goes with what holds it.
        return not explicit or n.tag not in PROSE
    return [(s if main else "", main, tuple(hashes[id(n)] for n in p if may_be(n))) for s, main, p in out]


def _spans(found: list[Block]) -> list[dict]:
    """The runs of blocks that each subtree covers."""
    runs: dict[int, list[list[int]]] = {}
    for i, (_, _, under) in enumerate(found):
        for h in set(under):
            at = runs.setdefault(h, [])
            if at and at[-1][1] == i - 1:
                at[-1][1] = i
            else:
                at.append([i, i])
    return [{"tree": h, "first": a, "last": z} for h, at in runs.items() for a, z in at]


def _texts(found: list[Block]) -> list[str]:
    return [t.encode("utf-8", "replace").decode() for t, main, _ in found if main]


def _subtrees(rules: bool):
    """Of (d1, d2, host, html) the rows (d1, d2, host, page, spans) of pages that have blocks; page is a digest of the main text."""
    kind = pa.list_(pa.struct([("tree", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(h or "", rules) for h in batch.column(3).to_pylist()]
            # No block has a line break, so different lists of blocks give different texts.
            page = [int.from_bytes(hashlib.blake2b("\n".join(_texts(f)).encode(), digest_size=8).digest(), "big", signed=True) for f in found]
            out = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(page, pa.int64()), pa.array([_spans(f) for f in found], kind)],
                                             names=["d1", "d2", "host", "page", "spans"])
            yield out.filter(pa.array([len(f) > 0 for f in found], pa.bool_()))
    return run


def _main_texts(rules: bool):
    """Of (page_id, url, d1, d2, html) the rows (page_id, url, d1, d2, n_blocks, at, texts): main texts, and which blocks they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(h or "", rules) for h in batch.column(4).to_pylist()]
            at = [[i for i, (_, main, _) in enumerate(f) if main] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([len(f) for f in found], pa.int32()), pa.array(at, pa.list_(pa.int32())),
                 pa.array([_texts(f) for f in found], pa.list_(pa.string()))],
                names=["page_id", "url", "d1", "d2", "n_blocks", "at", "texts"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_pages: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE, rules: bool = True) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars, n_template_blocks, n_rule_blocks; without ``rules`` templates alone remove text."""
    store.small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    # A row is known by a digest of all that it holds: both passes give it the same, in whatever order they read.
    source = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
              .withColumns({"d1": F.xxhash64("page_id", "url", "html"), "d2": F.xxhash64("html", "url", "page_id")}))
    rows = (source.select("d1", "d2", F.xxhash64(host).alias("host"), "html")
            .mapInArrow(_subtrees(rules), "d1 long, d2 long, host long, page long, spans array<struct<tree long, first int, last int>>"))
    # A subtree of a host: one number, salted into groups for its join with the pages.
    of_host = lambda s: F.struct(F.xxhash64("host", s["tree"]).alias("tree"), s["first"].alias("first"), s["last"].alias("last"))
    rows = store.saved(rows.withColumn("spans", F.transform("spans", of_host)).withColumn("row", F.monotonically_increasing_id()),
                       "page-subtrees")

    # Copies of a page are no evidence of a template, so different pages are counted.
    pages_of = rows.groupBy("host").agg(F.countDistinct("page").alias("pages"))
    first = rows.groupBy("host", "page").agg(F.min("row").alias("row"))
    trees = F.array_distinct(F.transform("spans", lambda s: s["tree"]))
    templates = (rows.select("row", trees.alias("trees")).join(first.select("row"), "row", "left_semi").select("row", F.explode("trees").alias("tree"))
                 .groupBy("tree").agg(F.count("*").alias("n"), F.min("row").alias("row")).where(F.col("n") >= least_pages)
                 .join(rows.select("row", "host"), "row").join(pages_of, "host").where(F.col("n") >= share * F.col("pages")).select("tree"))
    # Written first, so that Spark knows their size and need not shuffle where it is small.
    salts = F.expr(f"sequence(0, {SALTS - 1})")
    templates = (store.saved(templates, "templates").withColumn("salt", F.explode(salts))
                 .select(F.xxhash64("tree", F.col("salt").cast("long")).alias("salted")))
    group = F.pmod("row", F.lit(SALTS))
    seen = (rows.select("d1", "d2", "row", F.explode("spans").alias("span"))
            .select("d1", "d2", F.struct("span.first", "span.last").alias("span"), F.xxhash64("span.tree", group).alias("salted")))
    cut = store.saved(seen.join(templates, "salted").groupBy("d1", "d2").agg(F.collect_set("span").alias("gone")), "page-templates")

    # The texts are parsed again rather than kept: what is shuffled to meet the templates is all of them that is on disk.
    texts = (source.select("page_id", "url", "d1", "d2", "html")
             .mapInArrow(_main_texts(rules), "page_id long, url string, d1 long, d2 long, n_blocks int, at array<int>, texts array<string>"))
    none = F.array().cast("array<struct<first int, last int>>")
    of_template = lambda i: F.exists("gone", lambda s: (s["first"] <= i) & (s["last"] >= i))
    every = F.when(F.col("n_blocks") > 0, F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array().cast("array<int>"))
    kept = F.transform(F.filter(F.arrays_zip("at", "texts"), lambda b: ~of_template(b["at"])), lambda b: b["texts"])
    return (texts.join(cut, ["d1", "d2"], "left").withColumn("gone", F.coalesce("gone", none))
            .select("page_id", "url", "n_blocks", kept.alias("kept"), F.size(F.filter(every, of_template)).alias("n_gone"))
            .select("page_id", "url", F.array_join("kept", "\n\n").alias("text"), F.col("n_gone").cast("long").alias("n_template_blocks"),
                    (F.col("n_blocks") - F.col("n_gone") - F.size("kept")).cast("long").alias("n_rule_blocks"))
            .withColumn("n_chars", F.length("text").cast("long"))
            .select("page_id", "url", "text", "n_chars", "n_template_blocks", "n_rule_blocks"))
