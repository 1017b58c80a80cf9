"""Main text of web pages, with site templates removed.

Subtrees of block elements are hashed and counted for each host in Spark, inside articles too. A subtree is counted
once for each different text of its page, so copies of an article count once. Those that recur on many pages of the host
are its template and go, as do elements whose tag, role or class says what they are. A page whose article would lose
over half of its text to the template is a near copy of other articles, not made of template, and keeps it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
#: Elements that never hold main text.
DROPPED = frozenset("head title script style noscript template nav header footer aside form button select option textarea input fieldset iframe object embed svg canvas audio video map menu dialog datalist xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id names that mark what is no main text, where all other words of the name only say what part or place it is.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation breadcrumb breadcrumbs footer sidebar aside widget widgets cookie cookies consent popup disqus newsletter subscribe subscription pagination pager".split())
#: Words that mark reader comments in any name, but for blocks that hold sentences.
COMMENTS = frozenset("comment comments commentlist respond response responses reply replies disqus".split())
#: Words that mark outside articles in the same way, inside only as a whole name or with one of the endings.
WEAK_MARKS = frozenset("header masthead banner menu share sharing social related recommended notice notices promotion respond replies login signup skip modal overlay toolbar".split())
ENDINGS = frozenset("s bar block box buttons container form icons items links list nav posts section text top wrap wrapper".split())
#: Words beside a mark that leave it one, and first or last words that only tell of it (a page that has a sidebar, comments that are closed).
PARTS = ENDINGS | frozenset("area article body bottom button center central col column content contents desktop entry fixed global google group holder home inline inner item label left link lower main mini mobile module outer page panel panels part placeholder post primary region right root row secondary side site slot small sticky story sub tertiary third title trail unit upper view web zone".split())
TELLING = frozenset("has have with without no not non hide hides show is as if".split())
STATES = frozenset("open opened closed enabled disabled active allowed count off on free".split())
#: Names of an article or main element that is none.
NO_ARTICLE = frozenset("ad advert advertisement comment comments comment-body promo related reply response sponsored teaser widget".split())
#: Names that a heading group inside an article may have, and blocks that hold sentences: weak marks do not remove them there.
HEADINGS = frozenset("header masthead banner".split())
SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote dd dt figcaption td th caption".split())
#: Open elements that a start tag closes, up to the given borders.
P_CLOSERS = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
BORDERS = frozenset("article aside body div footer form header html main nav section table td th ul ol li blockquote".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_REST = re.compile(r"[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*>")
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?![A-Za-z0-9-])", re.I | re.A) for tag in RAW}
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "marks", "children", "inner")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.children, self.inner = tag, marks, [], False


def _marks(attributes: str) -> str:
    """What class, id and role of a start tag say, and whether it hides the element."""
    found = []
    for name, *values in _ATTR.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            found.append(f"{name}={value.lower()}")
        elif name == "hidden" or name == "style" and _UNSEEN.search(value):
            found.append("hidden")
    return " ".join(found)


class _Open:
    """The open elements, with the places of each tag and of the borders, so that no end tag has to search them."""

    def __init__(self, root: Node):
        self.stack, self.places, self.borders = [root], {}, [0]

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BORDERS:
            self.borders.append(len(self.stack))
        self.stack.append(node)

    def close_from(self, place: int, border: int = 0) -> None:
        """Closes the element at a place and all inside it, if it stands within the border."""
        if place and place >= border:
            for node in self.stack[place:]:
                self.places[node.tag].pop()
                if node.tag in BORDERS:
                    self.borders.pop()
            del self.stack[place:]


def parse(source: str) -> Node:
    """Tree of elements; children are nodes and strings. Unclosed elements end with their parents, a tag cut off by the end of the page goes.

    Time is in proportion to the length of the page, whatever its tags."""
    root = Node("html")
    opened = _Open(root)
    stack = opened.stack
    at, n = 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            stack[-1].children.append(source[at:])
            break
        nxt = source[lt + 1 : lt + 2]
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            if lt > at:
                stack[-1].children.append(source[at:lt])
            at = n if end < 0 else end + 3
            continue
        if not (nxt.isalpha() and nxt.isascii() or nxt in ("/", "!", "?") and nxt):
            stack[-1].children.append(source[at : lt + 1])
            at = lt + 1
            continue
        if lt > at:
            stack[-1].children.append(source[at:lt])
        if nxt in "!?":
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        name = _NAME.match(source, lt + 1 + closing)
        if not name:
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = name[0].lower()
        rest = _REST.match(source, name.end())
        if rest:
            stop = rest.end()
        else:
            end = source.find(">", name.end())
            if end < 0:
                break
            stop = end + 1
        at = stop
        if closing:
            opened.close_from(opened.last((tag,)), opened.borders[-1] if tag in INLINE else 0)
            continue
        if tag in ("html", "body"):
            continue
        if tag in P_CLOSERS:
            opened.close_from(opened.last(("p",)), opened.borders[-1])
        if tag in SIBLINGS:
            closes, borders = SIBLINGS[tag]
            opened.close_from(opened.last(closes), opened.last(borders))
        attributes = source[name.end() : stop - 1]
        node = Node(tag, _marks(attributes) if "=" in attributes or "hidden" in attributes.lower() else "")
        stack[-1].children.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in RAW and tag not in BORDERS:
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(source, at)
            node.children.append(source[at : end.start() if end else n])
            close = source.find(">", end.end()) if end else -1
            at = n if close < 0 else close + 1
            continue
        opened.push(node)
    return root


def _marked(name: str, tag: str, in_main: bool) -> bool:
    """True for one name of a class or id attribute that marks its element.

    All words of the name have to speak of a mark or its parts, so that names which only tell of one mark nothing (has-sidebar,
    ad-free-content). A comment's word marks in any name. Inside an article a weak mark counts only as the
    whole name or with an ending, and neither for a heading group nor for blocks that hold sentences."""
    words = [w for w in _SPLIT.split(name) if w]
    if not words or words[0] in TELLING or words[-1] in STATES:
        return False
    if tag not in SENTENCES and not COMMENTS.isdisjoint(words):
        return True
    others = [w for w in words if w not in MARKS]
    if len(others) < len(words) and all(len(w) < 3 or w in PARTS or w in WEAK_MARKS for w in others):
        return True
    if not in_main:
        return not WEAK_MARKS.isdisjoint(words) and all(len(w) < 3 or w in PARTS or w in WEAK_MARKS for w in words)
    if tag in SENTENCES or name in HEADINGS:
        return False
    return words[0] in WEAK_MARKS and all(w in WEAK_MARKS or w in ENDINGS for w in words)


def unwanted(node: Node, in_main: bool) -> bool:
    """True for elements that tag, role, class or a hiding attribute mark as no main text; a heading group inside an article
    stays, and so do its sentences unless a strong mark says otherwise."""
    tag = node.tag
    if tag == "header" and in_main and not node.marks:
        return False
    if tag in DROPPED and not (tag == "header" and in_main):
        return True
    return bool(node.marks) and (_hidden(node) or _named(node, in_main))


def _hidden(node: Node) -> bool:
    """True where an attribute hides the element, or its role says that it is no main text."""
    parts = node.marks.split()
    return "hidden" in parts or any(p.startswith("role=") and p[5:] in ROLES for p in parts)


def _named(node: Node, in_main: bool) -> bool:
    """True where a class or id name marks the element."""
    if node.tag == "header" and in_main:
        return False
    key = ""
    for part in node.marks.split():
        k, equals, value = part.partition("=")
        if equals and k in ("class", "id", "role"):
            key, part = k, value
        if key in ("class", "id") and (part in NO_ARTICLE if node.tag in ("article", "main") else _marked(part, node.tag, in_main)):
            return True
    return False


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or "role=main" in node.marks or "role=article" in node.marks


def main_nodes(root: Node) -> list[Node]:
    """Outermost article, main or role=main elements in page order, outside unwanted ones.

    If there are none, those that stand in elements with marking names count: a wrapper that is named for its sidebar is still
    the wrapper of the article. Comments never are."""
    for into_named in (False, True):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                continue
            if node is not root and unwanted(node, False):
                named_only = node.tag not in DROPPED and node.tag not in ("article", "main") and not _hidden(node)
                if not (into_named and named_only and COMMENTS.isdisjoint(_SPLIT.split(node.marks))):
                    continue
            if _is_main(node):
                found.append(node)
            else:
                todo += reversed(node.children)
        if found:
            break
    return found


def subtree_hashes(tops: list[Node]) -> dict[int, int]:
    """Signed hash of the subtree of each wanted block element with text below `tops`, by the element's id()."""
    known: dict[int, int] = {}
    texts: set[int] = set()
    order = []
    for top in tops:
        todo = [top]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += [x for x in node.children if not isinstance(x, str) and not unwanted(x, _is_main(top))]
    for node in reversed(order):
        digest = xxhash.xxh3_64(f"{node.tag} {node.marks}\0")
        for x in node.children:
            if isinstance(x, str):
                x = _SPACE.sub(" ", x).strip()
                if x:
                    texts.add(id(node))
                    digest.update(b"t" + x.encode("utf-8", "surrogatepass"))
            elif id(x) in known:
                digest.update(known[id(x)].to_bytes(8, "big"))
                if id(x) in texts:
                    texts.add(id(node))
        known[id(node)] = digest.intdigest()
    above = {id(x) for x in tops}
    return {id(x): _signed(known[id(x)]) for x in order if id(x) in texts and x.tag not in INLINE and id(x) not in above}


def blocks(nodes: list[Node], template: dict[int, int] | None = None, drop: frozenset[int] = frozenset()) -> list[str]:
    """Text blocks in page order: white space folded, empty ones left out."""
    out: list[str] = []
    part: list[str] = []

    def close() -> None:
        if part:
            text = _SPACE.sub(" ", entities.unescape("".join(part))).strip()
            if text:
                out.append(text)
            part.clear()

    for top in nodes:
        todo: list = [top]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                part.append(x)
            elif x is None:
                close()
            else:
                if x is not top and (unwanted(x, _is_main(top)) or template and template.get(id(x)) in drop):
                    if x.tag not in INLINE:
                        close()
                    continue
                if x.tag in INLINE:
                    todo += reversed(x.children)
                else:
                    close()
                    todo.append(None)
                    todo += reversed(x.children)
        close()
    return out


def host(url: Column) -> Column:
    """Lower-case host of an address, without user and port; empty if there is none."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, "[/?#](?s:.*)$", ""), "^.*@", ""), ":[^:]*$", ""))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def template_subtrees(pages: DataFrame, share: float, article_share: float, least_pages: int, most_broadcast: int) -> DataFrame:
    """host, inside and h: hashes of subtrees that stand on over `share` of a host's different pages without an article, or in over
    `article_share` of its different articles (inside), `least_pages` at least.

    Counts are of distinct (host, subtree, page text), made before and after the shuffle, so a hot host is spread over its subtrees and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hosts, inside, hashes, of_text = [], [], [], []
            for name, source in zip(batch.column("host").to_pylist(), batch.column("text").to_pylist()):
                root = parse(source)
                main = main_nodes(root)
                tops = main or [root]
                own = set(subtree_hashes(tops).values())
                text = _signed(xxhash.xxh3_64_intdigest("\n".join(blocks(tops)).encode("utf-8", "surrogatepass")))
                hosts += [name] * (len(own) + 1)
                inside += [bool(main)] * (len(own) + 1)
                hashes += [None, *own]
                of_text += [text] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(inside, pa.bool_()), pa.array(hashes, pa.int64()), pa.array(of_text, pa.int64())], names=["host", "inside", "h", "m"])

    seen = pages.select("host", "text").mapInArrow(run, "host string, inside boolean, h bigint, m bigint").distinct()
    counts = seen.groupBy("host", "inside", "h").agg(F.count("*").alias("n"))
    counts = checkpointed(counts.where((F.col("n") >= least_pages) | F.col("h").isNull()))
    total = counts.where("h is null").select("host", "inside", F.col("n").alias("pages"))
    if total.count() <= most_broadcast:
        total = F.broadcast(total)
    least = F.col("pages") * F.when(F.col("inside"), article_share).otherwise(share)
    return counts.where("h is not null").join(total, ["host", "inside"]).where(F.col("n") > least).select("host", "inside", "h")


def main_text(source: str, drop: frozenset[int] = frozenset(), article_drop: frozenset[int] = frozenset()) -> str:
    """Main text of one page without the subtrees of these hashes: the first outside articles, the second inside."""
    root = parse(source)
    main = main_nodes(root)
    tops = main or [root]
    wanted = article_drop if main else drop
    hashes = subtree_hashes(tops) if wanted else {}
    whole = "\n".join(blocks(tops))
    if wanted.isdisjoint(hashes.values()):
        return whole
    rest = "\n".join(blocks(tops, hashes, wanted))
    return whole if main and 2 * len(rest) < len(whole) else rest


def extract_text(pages: DataFrame, share: float = 0.2, article_share: float = 0.5, least_pages: int = 5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_broadcast: int = 100_000) -> DataFrame:
    """page_id, url and text of each row: the main text of the whole page, one block a line.

    Main text is inside article, main or role=main elements, or else the body. Character references are
    decoded, white space in a block becomes one space. Null or empty pages and pages without main text have an
    empty text; null urls form a host of their own; repeated rows each come out. Pages of a host are never
    gathered: templates are counts, joined back on the host, by broadcast if they are few. A host's list is bounded: every
    page has a subtree of it for each 1 / share entries."""
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("text"), host(F.col(url_col)).alias("host"))
    templates = checkpointed(template_subtrees(rows, share, article_share, least_pages, most_broadcast))
    lists = [F.collect_list(F.when(F.col("inside") == inside, F.col("h"))).alias(name) for inside, name in ((False, "drop"), (True, "article_drop"))]
    by_host = templates.groupBy("host").agg(*lists)
    joined = rows.join(F.broadcast(by_host) if templates.count() <= most_broadcast else by_host, "host", "left").select("page_id", "url", "text", "drop", "article_drop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            columns = (batch.column(c).to_pylist() for c in ("text", "drop", "article_drop"))
            out = [main_text(source, frozenset(a or ()), frozenset(b or ())) for source, a, b in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string")
