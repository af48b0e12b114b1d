"""Main text of web pages by consensus of a host's pages.

Pass 1 parses every page and scores its containers: text in blocks, less what lies in links, weighed by how article-like
or menu-like the container's tag and class are.  A container's path of tags and classes is generalised (digits become
#, positions are dropped), and every path with a score votes.  Votes are summed for each host and path in Spark, salted first,
so a host that holds a third of all pages is never gathered in one task, and all voted paths are kept.  Pass 2 brings to
each page the votes for the paths that it has and extracts it again: with the path that is best by the host's votes times
the page's own score, paths left out that only surround a better one; without votes, with its own best container.

Inside the container, menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are left
out by tag, role, class or id.  Character references are decoded once, white space inside a block becomes one blank,
blocks are trimmed and joined by one line feed.  Nothing else is dropped or cut.

Null html counts as empty: empty text.  Null URLs, and URLs without a host, share the empty host.  Broken markup (unclosed
or crossed tags) is read leniently.  Repeated rows are extracted alike; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import cut, map_batches, schema_of

#: A tag's attributes by the states of the standard's tokenizer: a quote opens a value only right after the equals sign;
#: in names and unquoted values it is a character like any other.  Atomic, so a page is scanned once.
ATTRIBUTES = (r"(?>[\s/]++|[^\s/>][^\s/>=]*+(?>\s*+=\s*+(?>\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|(?=>)|\Z))?+)*+")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(" + ATTRIBUTES + r")(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>\"'][^\s>]*))?)?+")
READ = frozenset("class id role hidden aria-hidden style".split())
BLANKS = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")

# Names of HTML elements (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img br").split())
SKIPPED = frozenset(("script style noscript template iframe textarea title head nav header footer aside form button select "
                     "option input svg canvas object embed audio video dialog menu noembed noframes").split())
CONTAINERS = frozenset("article main section div td body center blockquote".split())
#: Opening one of these closes an open element of the listed kinds within the nearest enclosing box.
P_CLOSERS = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                       "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
BOXES = frozenset("ul ol dl table tr tbody thead tfoot div section article main aside nav header footer form body td th".split())

BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner\w*|sponsor\w*|promo\w*|cookie\w*|consent|notice\w*|alert|popup|modal|overlay|newsletter|"
    r"subscri\w*|nav|navbar|navigation|menu\w*|breadcrumb\w*|sidebar\w*|side|aside|widget\w*|footer\w*|header|masthead|topbar|"
    r"toolbar|comment\w*|disqus\w*|respond|reply|replies|share|sharing|social\w*|related|recommend\w*|pagination|pager|skip|"
    r"search\w*|login|signup|byline-share|tags|tagcloud|copyright|legal|disclaimer|gdpr)(?:$|[\s_-])", re.I)
#: Elements that hold running text: their class must name boilerplate more plainly, as articles have headers and legal notes.
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th tr pre blockquote figure figcaption span em strong b i a code".split())
TEXT_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner\w*|sponsor\w*|promo\w*|cookie\w*|consent|popup|modal|newsletter|subscri\w*|nav|navbar|"
    r"navigation|menu\w*|breadcrumb\w*|sidebar\w*|widget\w*|footer\w*|masthead|topbar|toolbar|comment\w*|disqus\w*|share|sharing|"
    r"social\w*|pagination|pager|login|signup|byline-share|tagcloud|copyright|gdpr)(?:$|[\s_-])", re.I)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ARTICLE_LIKE = re.compile(r"(?:^|[\s_-])(?:article\w*|post|story\w*|content|main|entry|text|body|blog)(?:$|[\s_-])", re.I)
TAG_WEIGHT = {"article": 3.0, "main": 2.0, "section": 1.1, "div": 1.0, "td": 0.9, "center": 0.9, "blockquote": 0.6, "body": 0.5}
#: Share of a voted container's score at which a container around it is a bare one.
BARE = 0.5
SALTS = 64


class Node:
    __slots__ = ("tag", "label", "parent", "items", "skip", "inline", "path")

    def __init__(self, tag: str, label: str, parent: "Node | None", skip: bool):
        self.tag, self.label, self.parent, self.skip = tag, label, parent, skip
        self.items: list = []  # texts and nodes in order
        self.inline = tag in INLINE
        # the generalised path of tags and classes as a chain of hashes, so that deep pages stay small
        self.path = b"" if parent is None else parent.path if self.inline or tag == "html" else xxhash.xxh128_digest(parent.path + label.encode())


def attributes(raw: str) -> dict[str, str]:
    """The attributes that are read; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        if (name := m[1].lower()) in READ:
            found.setdefault(name, html_lib.unescape(m[2] or m[3] or m[4] or ""))
    return found


def new_node(tag: str, raw: str, parent: Node) -> Node:
    a = attributes(raw) if raw and not raw.isspace() else {}
    names = f"{a.get('class', '')} {a.get('id', '')}"
    first = (a.get("class") or "").split()
    label = DIGITS.sub("#", tag + ("." + first[0] if first else ""))
    skip = (tag in SKIPPED or "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in BOILERPLATE_ROLES
            or "display:none" in a.get("style", "").replace(" ", "").lower()
            or (tag not in ("html", "body", "article", "main") and bool(names.strip()) and bool((TEXT_BOILERPLATE if tag in TEXTS else BOILERPLATE).search(names))))
    return Node(tag, label, parent, skip)


def closes(tag: str, open_tag: str) -> bool:
    return (open_tag == "p" and tag in P_CLOSERS) or open_tag in SAME.get(tag, ())


def parse(source: str) -> Node:
    """A tree of a page, comments and the insides of scripts and styles left out."""
    root = node = Node("#root", "", None, False)
    at, n = 0, len(source)
    opened: Counter[str] = Counter()  # open elements by tag, so a search for one that is not open ends at once

    def close(up: Node) -> Node:
        """Ends the open elements up to and with ``up``."""
        at_ = node
        while True:
            opened[at_.tag] -= 1
            if at_ is up:
                return up.parent
            at_ = at_.parent

    while at < n:
        m = TOKEN.search(source, at)
        if not m:
            node.items.append(source[at:])
            break
        if m.start() > at:
            node.items.append(source[at:m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            if m[0].startswith("<![CDATA["):
                node.items.append(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            up = node if opened[tag] else root
            while up is not root and up.tag != tag:
                if up.tag in BOXES and tag in INLINE | {"p", "li"}:  # a stray end tag does not leave its box
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = close(up)
            continue
        if tag not in INLINE and tag not in RAW:
            up = node if (tag in P_CLOSERS and opened["p"]) or any(opened[t] for t in SAME.get(tag, ())) else root
            while up is not root and not (up.tag in BOXES and not closes(tag, up.tag)):
                if closes(tag, up.tag):
                    node = close(up)
                    break
                up = up.parent
        child = new_node(tag, m[3], node)
        node.items.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            if tag in ("noscript", "iframe", "template"):
                child.skip = True
            at = end.end() if end else n
        elif tag not in VOID:  # as in the standard, a closing slash says nothing
            node = child
            opened[tag] += 1
    return root


def blocks(node: Node) -> list[str]:
    """Texts of the node's blocks in page order, boilerplate left out."""
    out, line = [], []

    def end():
        text = BLANKS.sub(" ", html_lib.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    stack = [iter(node.items)]
    boxes = [True]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
            if boxes.pop():
                end()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif not item.skip:
            if not item.inline:
                end()
            stack.append(iter(item.items))
            boxes.append(not item.inline)
        elif not item.inline:
            end()
    return out


def measure(root: Node) -> list[tuple[float, bytes, Node]]:
    """(score, generalised path, node) of every container outside boilerplate, in page order.

    A container's text is what its own blocks hold, and half of what its inner containers hold, so that the innermost
    container around the paragraphs wins over the ones around it.
    """
    found: list[tuple[float, bytes, Node]] = []
    own: dict[int, list[float]] = {}  # text and link text of nodes whose children are done
    stack: list[tuple[Node, bool, bool]] = [(root, False, False)]
    while stack:
        node, linked, done = stack.pop()
        if not done:
            stack.append((node, linked, True))
            for item in reversed(node.items):
                if not isinstance(item, str) and not item.skip:
                    stack.append((item, linked or item.tag == "a", False))
            continue
        text = link = 0.0
        for item in node.items:
            if isinstance(item, str):
                k = len(item.strip())
                text += k
                link += k * linked
            elif id(item) in own:
                t, l = own.pop(id(item))
                share = 0.5 if item.tag in CONTAINERS else 1.0
                text += t * share
                link += l * share
        own[id(node)] = [text, link]
        if node.tag in CONTAINERS:
            weight = TAG_WEIGHT[node.tag] * (1.5 if ARTICLE_LIKE.search(node.label.partition(".")[2]) else 1.0)
            found.append(((text - link) * weight * (1 - link / (text + 1)), node.path, node))
    return found


def path_scores(found: list[tuple[float, bytes, Node]]) -> dict[bytes, float]:
    """Scores of the page's paths above zero, as shares of the best one's."""
    scores: dict[bytes, float] = {}
    for s, p, _ in found:
        scores[p] = scores.get(p, 0.0) + s
    best = max(scores.values(), default=0.0)
    return {p: s / best for p, s in scores.items() if s > 0}


def path_key(host: str, path: bytes) -> bytes:
    return xxhash.xxh128_digest(host.encode() + b"\n" + path)


def consensus(found: list[tuple[float, bytes, Node]], votes: dict[bytes, tuple[float, int]]) -> bytes | None:
    """The page's path with the most of its host's votes (sum, pages) times its own score.

    Every page has a small vote for the containers around its text, so on a large host their votes are many.  Such a
    path is left out where a voted container inside it has a better score and either it has at most ``BARE`` of that
    score or its mean vote on the host is below ``BARE``.
    """
    own = {p: s for p, s in path_scores(found).items() if p in votes}
    inside: dict[int, float] = {}  # the best score of voted paths inside a node; inner nodes come first
    best: dict[bytes, float] = {}
    for _, p, node in found:
        within = inside.pop(id(node), 0.0)
        best[p] = max(best.get(p, 0.0), within)
        up = node.parent
        while up is not None and up.tag not in CONTAINERS:
            up = up.parent
        if up is not None:
            inside[id(up)] = max(inside.get(id(up), 0.0), within, own.get(p, 0.0))
    kept = [(votes[p][0] * s, p) for p, s in own.items()
            if s >= best[p] or (s > BARE * best[p] and votes[p][0] >= BARE * votes[p][1])]
    return max(kept, key=lambda f: (f[0], f[1]), default=(0.0, None))[1]


def extract(source: str | None, winners: list[bytes], votes: dict[bytes, tuple[float, int]] | None = None, host: str = "") -> str:
    """Text of the nodes on the path that ``votes`` (by path key) make best, else on the first of ``winners`` that the page
    has; without one, of its best container, else of all."""
    root = parse(source or "")
    found = measure(root)
    by_path: dict[bytes, list[Node]] = {}
    for s, p, node in found:
        if s > 0:
            by_path.setdefault(p, []).append(node)
    if votes:
        of_path = {p: votes[k] for p in by_path if (k := path_key(host, p)) in votes}
        winners = [p for p in [consensus(found, of_path)] if p is not None] + winners
    nodes = next((by_path[p] for p in winners if p in by_path), None)
    if nodes is None:
        best = max(found, key=lambda f: f[0], default=None)
        nodes = [best[2]] if best and best[0] > 0 else [root]
    # nodes on one path have the same number of boxes around them, so none is inside another
    return "\n".join(b for node in nodes for b in blocks(node))


def with_keys(pages: DataFrame, key: str, url: str, source: str) -> DataFrame:
    """(key, url, html, host, page): the page's key is of its host and html, so equal pages share what is found for one."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = pages.select(F.col(key).cast("long").alias(key), F.col(url).alias("url"), F.col(source).alias("html"), host.alias("host"))
    return own.withColumn("page", F.unhex(F.md5(F.concat_ws("\n", "host", F.coalesce("html", F.lit(""))))))


def voted_paths(own: DataFrame) -> DataFrame:
    """(page, votes array<path, votes, pages>): for each distinct page, its host's votes for every path that it has."""
    def vote(batch):
        rows = []
        for host, page, source in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
            scores = path_scores(measure(parse(source or "")))
            rows += [(page, path_key(host, p), s) for p, s in scores.items()]
        return dict(zip(("page", "path", "vote"), zip(*rows))) if rows else {"page": [], "path": [], "vote": []}

    kinds = schema_of(("page", T.BinaryType()), ("path", T.BinaryType()), ("vote", T.DoubleType()))
    seen = cut(map_batches(own.select("host", "page", "html"), vote, kinds))
    salted = seen.where(F.col("vote").isNotNull()).groupBy("path", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt")).agg(
        F.sum("vote").alias("votes"), F.count(F.lit(1)).alias("pages"))
    totals = salted.groupBy("path").agg(F.round(F.sum("votes"), 6).alias("votes"), F.sum("pages").alias("pages"))
    had = seen.select("page", "path").distinct().join(totals, "path")
    return had.groupBy("page").agg(F.collect_list(F.struct("path", "votes", "pages")).alias("voted"))


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of every page."""
    own = with_keys(pages, key, url, source)

    def run(batch):
        texts = [extract(h, [], {v["path"]: (v["votes"], v["pages"]) for v in voted or []}, host)
                 for h, host, voted in zip(*(batch.column(c).to_pylist() for c in ("html", "host", "voted")))]
        return {key: batch.column(key), "url": batch.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}

    kinds = schema_of((key, T.LongType()), ("url", T.StringType()), ("text", T.StringType()), ("n_chars", T.LongType()))
    return map_batches(own.join(voted_paths(own), "page", "left").select(key, "url", "html", "host", "voted"), run, kinds)
