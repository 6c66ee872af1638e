"""Main text of pages: subtrees that a site repeats go, and then what is declared page furniture.

Each page is parsed into a tree and all its subtrees are hashed, menus and footers too. Spark counts
for each host on how many different pages a hash occurs; near copies of an article count once. What
occurs often enough is deleted first. Rules on names, roles and classes then take out what counts
cannot show, such as the furniture of a host with few pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import BROADCAST_BYTES, small_side
from tarmac.session import cut

#: A template occurs on at least so many different pages of a host; a plain paragraph or the like
#: inside an article, which other articles may quote, on so many.
PAGES, QUOTED = 5, 20
#: Subtrees of fewer letters repeat by chance ("Yes.", a number in a table).
SHORT = 25

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Elements whose start ends an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Start tags that end an open element of the second kind, unless one of the third lies between.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)),
         "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
         "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
         "option": (("option",), ("select",))}
#: Elements that are never part of an article.
FURNITURE = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input label menu meter "
    "nav noscript object output progress script search select style svg template textarea title "
    "video".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split())
#: Words of a class or id that name what is no article, and words that may stand beside them.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus disclaimer footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice notices pagination paywall popup promo related replies respond share sharing "
    "sidebar sitenav social sponsor sponsored subscribe toolbar topbar widget".split())
BESIDE = frozenset(
    "area bar block bottom box btn button buttons col column container content form group header icons "
    "inner item items left link links list main outer page panel post posts primary right row section "
    "secondary side site top unit wrap wrapper".split())
#: Headings, which no count takes out of an article, and elements that no class or id takes out.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TEXT = HEADINGS | {"p", "section"}
#: Elements without text of their own, left out before anything is hashed.
UNSEEN = frozenset("head script style template".split())
#: Elements that are boxes of a page when they have a class or id, however short their text.
BOXES = frozenset("aside div footer form header nav ol section ul".split())
#: A tag that the end of the page cuts off is no text.
_CUT_OFF = re.compile(r"<[/!a-zA-Z][^<>]*\Z")
#: Elements that hold the article itself and so are never taken for furniture by their class.
_WHOLE = frozenset(("html", "body", "main", "article"))


class Node:
    __slots__ = ("tag", "label", "kids", "hash", "alone", "prose", "out", "size", "rest")

    def __init__(self, tag: str, label: str):
        self.tag, self.label, self.kids, self.hash = tag, label, [], 0
        #: no running text beside it; words of an article; left out
        self.alone, self.prose, self.out = False, False, False
        #: letters of the subtree, and those of what stays of it
        self.size, self.rest = 0, 0


class _Tree(HTMLParser):
    """Builds the tree; unclosed and stray tags are taken as browsers mostly take them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", "")
        self.open = [self.root]

    def _end_open(self, tags, stop) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                del self.open[i:]
                return
            if tag in stop or tag in _WHOLE:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._end_open(("p",), ("button", "td", "th", "table", "li"))
        if tag in _ENDS:
            self._end_open(*_ENDS[tag])
        if tag == "body":  # a head left open ends here
            self._end_open(("head",), ())
        given = dict(attrs)
        label = f"{given.get('class') or ''} {given.get('id') or ''}".strip().lower()
        if (given.get("role") or "").lower() in ROLES or "hidden" in given or (
                given.get("aria-hidden") or "").lower() == "true":
            label += " _furniture"
        node = Node(tag, label)
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("article", "main", "body", "table") and tag not in BLOCK:
                return

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def _named(label: str) -> bool:
    words = [w for w in re.split(r"[-_\s]+", label) if w]
    return any(w in NAMED for w in words) and all(
        w in NAMED or w in BESIDE or w.isdigit() for w in words)


def _furniture(node: Node, inside: bool) -> bool:
    if node.tag in FURNITURE or (node.tag == "header" and not inside):
        return True
    if not node.label or node.tag in ("html", "body", "main"):
        return False
    if node.label.endswith("_furniture"):
        return node.tag != "article"
    return node.tag not in TEXT and _named(node.label)


def page_of(html: str) -> Node:
    """The tree of a page, each subtree with its hash, furniture marked ``out``."""
    tree = _Tree()
    tree.feed(_CUT_OFF.sub("", html))
    tree.close()
    stack = [(tree.root, False)]
    while stack:  # without recursion: pages may nest deeply
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        node.kids = [kid for kid in node.kids if isinstance(kid, str) or kid.tag not in UNSEEN]
        running = any(isinstance(kid, str) and kid.strip() for kid in node.kids)
        for kid in node.kids:
            if not isinstance(kid, str):
                kid.out = node.out or _furniture(kid, inside)
                kid.alone = not running and not (inside and not kid.out and kid.tag in HEADINGS)
                kid.prose = inside and not (
                    kid.out or kid.label or "-" in kid.tag or kid.tag in BOXES)
                stack.append((kid, inside))
    _hash(tree.root)
    return tree.root


def _postorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(k for k in node.kids if not isinstance(k, str))
    return out[::-1]


def _hash(root: Node) -> None:
    """Hashes from the leaves up: name, class and id, text without its white space, and kids."""
    for node in _postorder(root):
        state = xxhash.xxh3_64(f"{node.tag}\0{node.label}\0".encode("utf-8", "surrogatepass"))
        for kid in node.kids:
            if isinstance(kid, str):
                words = kid.split()
                state.update(" ".join(words).encode("utf-8", "surrogatepass"))
                letters = sum(map(len, words))
                node.size += letters
                node.rest += 0 if node.out else letters
            else:
                state.update(kid.hash.to_bytes(8, "little"))
                node.size += kid.size
                node.rest += kid.rest
        node.hash = state.intdigest()


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _host_hash(host: str | None) -> int:
    return xxhash.xxh3_64_intdigest((host or "").encode("utf-8", "surrogatepass"))


def _may_repeat(node: Node) -> bool:
    """Whether a subtree may be a template: no article or heading of one, no part of a sentence."""
    if not node.alone or not node.size or node.tag in _WHOLE:
        return False
    return node.size >= SHORT or "-" in node.tag or bool(node.label) and node.tag in BOXES


def subtrees(root: Node) -> dict[int, tuple[int, bool]]:
    """Hashes of the subtrees that may be templates, with their letters and whether they are prose.

    Letters are counted where no other such subtree lies below, without those of furniture.
    """
    out: dict[int, tuple[int, bool]] = {}
    holds = set()
    for node in _postorder(root):
        below = any(id(kid) in holds for kid in node.kids if not isinstance(kid, str))
        if node is not root and _may_repeat(node):
            letters, prose = out.get(node.hash, (0, False))
            out[node.hash] = letters + (0 if below else node.rest), prose or node.prose
            below = True
        if below:
            holds.add(id(node))
    return out


def _delete(root: Node, is_template) -> None:
    """Leaves out the subtrees for which ``is_template`` is true and counts the letters that stay."""
    nodes = _postorder(root)
    asked = [node for node in nodes if node is not root and _may_repeat(node)]
    for node, gone in zip(asked, is_template([node.hash for node in asked])):
        node.out = node.out or bool(gone)
    for node in nodes:
        node.rest = 0 if node.out else sum(
            sum(map(len, kid.split())) if isinstance(kid, str) else kid.rest for kid in node.kids)


def _parts(root: Node) -> list[Node]:
    """The part of a page that holds its text, by the letters that stay.

    The ``main`` elements if they hold half of them. Else the outermost ``article`` elements and the
    first-level headings before them, if next to nothing stays beside these. Else the whole page.
    """
    mains: list[Node] = []
    articles: list[Node] = []
    heads: list[Node] = []
    stack = [(root, False, False)]
    while stack:
        node, in_main, in_article = stack.pop()
        if node.out:
            continue
        if node.tag == "main" and not in_main:
            mains.append(node)
        if node.tag == "article" and not in_article:
            articles.append(node)
        if node.tag == "h1" and not articles:
            heads.append(node)
        in_main, in_article = in_main or node.tag == "main", in_article or node.tag == "article"
        stack.extend((kid, in_main, in_article)
                     for kid in reversed(node.kids) if not isinstance(kid, str))
    if mains and 2 * sum(part.rest for part in mains) >= root.rest:
        return mains
    held = sum(part.rest for part in articles)
    beside = root.rest - held - sum(part.rest for part in heads)
    if articles and beside < min(SHORT, held):
        return heads + articles
    return [root]


def _text(parts: list[Node]) -> str:
    out: list[str] = []
    stack: list = list(reversed(parts))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        block = node.tag in BLOCK
        if block:
            out.append(" ")
        if node.out:
            continue
        if block:
            stack.append(" ")
        stack.extend(reversed(node.kids))
    return " ".join("".join(out).split())


def text_of(html: str | None, is_template=lambda hashes: [False] * len(hashes)) -> str:
    """The text of a page, its blocks in page order, without templates and furniture."""
    if not html:
        return ""
    root = page_of(html)
    _delete(root, is_template)
    return _text(_parts(root))


def _among(keys: np.ndarray, host: int):
    """Tells which hashes of a host are in the sorted ``keys``."""
    def found(hashes):
        asked = np.array([_signed(h ^ host) for h in hashes], np.int64)
        if not len(keys):
            return np.zeros(len(asked), bool)
        return keys[np.minimum(np.searchsorted(keys, asked), len(keys) - 1)] == asked

    return found


def templates(rows: DataFrame, least_pages: int, least_quoted: int) -> DataFrame:
    """``tree``: the hash of each subtree repeated by a host, combined with the hash of the host.

    A page is known by its text without furniture, so copies of an article are one page. Pages of
    whose text more than half is in repeated subtrees may be near copies of one article: of those
    that have the same longest repeated subtree, one is counted.
    """
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, html in zip(batch["_host"], batch["_html"]):
                root, mixed = page_of(html), _host_hash(host)
                page = xxhash.xxh3_64_intdigest(_text([root]).encode("utf-8", "surrogatepass")) ^ mixed
                out += [(_signed(page), _signed(tree ^ mixed), letters, root.rest,
                         least_quoted if prose else least_pages)
                        for tree, (letters, prose) in subtrees(root).items()]
            yield pd.DataFrame(out, columns=["page", "tree", "letters", "whole", "least"])

    seen = cut(rows.filter(F.length("_html") > 0).select("_host", "_html").mapInPandas(
        hashed, "page long, tree long, letters long, whole long, least int").groupBy("page", "tree").agg(
        *(F.max(c).alias(c) for c in ("letters", "whole", "least"))))
    common = cut(seen.groupBy("tree").agg(
        F.count(F.lit(1)).alias("n"), F.max("least").alias("enough")).filter("n >= enough").drop("n"))
    of_page = seen.join(small_side(common), "tree").groupBy("page").agg(
        F.collect_list(F.struct("tree", "enough")).alias("trees"), F.sum("letters").alias("shared"),
        F.max("whole").alias("whole"), F.max(F.struct("letters", "tree")).alias("longest"))
    voter = F.when(2 * F.col("shared") > F.col("whole"), F.col("longest.tree")).otherwise(F.col("page"))
    votes = of_page.select(voter.alias("voter"), F.inline("trees")).distinct()
    return cut(votes.groupBy("tree", "enough").agg(F.count(F.lit(1)).alias("n")).filter(
        "n >= enough").select("tree"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            least_pages: int = PAGES, least_quoted: int = QUOTED,
            broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``key, url, text, n_chars`` of every row.

    White space is what Unicode calls so. A null or empty html has an empty text. Pages with a null
    or unreadable url count as one host. ``least_pages`` says on how many different pages of a host
    a subtree must occur to be deleted from them, however many pages the host has; ``least_quoted``
    says it for paragraphs and the like without class or id inside an article. Copies and near
    copies make no template, and an article or its heading is never one. Repeated rows come back as
    often as they came in; other columns are left out.

    Up to ``broadcast_bytes`` the measured templates of all hosts go to every task and no page
    moves. Beyond, pages and templates meet in a shuffle, with the same result.
    """
    rows = pages.select(F.col(key).alias(key), F.col(url).alias(url), F.col(html).alias("_html"),
                        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)).alias("_host"))
    found = templates(rows, least_pages, least_quoted)
    if 8 * found.count() <= broadcast_bytes:
        sent = pages.sparkSession.sparkContext.broadcast(
            np.sort(found.toPandas()["tree"].to_numpy(np.int64)))

        @F.pandas_udf("string")
        def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for hosts, htmls in batches:
                yield pd.Series([text_of(page, _among(sent.value, _host_hash(host)))
                                 for host, page in zip(hosts, htmls)], dtype="object")

        texts = rows.withColumn("text", cleaned("_host", "_html"))
    else:
        def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame(
                    [(page, _signed(tree ^ _host_hash(host)))
                     for page, host, html in zip(batch["_page"], batch["_host"], batch["_html"])
                     for tree in subtrees(page_of(html))], columns=["_page", "tree"])

        @F.pandas_udf("string")
        def cleaned(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for hosts, htmls, lists in batches:
                yield pd.Series([
                    text_of(page, _among(np.sort(np.array([] if own is None else own, np.int64)),
                                         _host_hash(host)))
                    for host, page, own in zip(hosts, htmls, lists)], dtype="object")

        known = rows.withColumn("_page", F.xxhash64("_host", "_html"))
        lists = known.filter(F.length("_html") > 0).select("_page", "_host", "_html").mapInPandas(
            listed, "_page long, tree long").distinct().join(found, "tree").groupBy("_page").agg(
            F.collect_list("tree").alias("_templates"))
        texts = known.join(lists, "_page", "left").withColumn(
            "text", cleaned("_host", "_html", "_templates"))
    return texts.select(key, url, "text", F.char_length("text").cast("long").alias("n_chars"))
