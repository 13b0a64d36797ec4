"""Main-text extraction from HTML by tree scoring.

A page becomes a tree (unclosed and misnested tags as browsers take them, roughly). Subtrees that
can't be prose by tag, class, id or role (menus, forms, adverts, notices, comments and the like) are
left out. Every paragraph passes points to its ancestors: one, one per comma, one per hundred
characters up to three; the parent gets them whole, its parent a half, the ones above a third, a
quarter and so on, REACH elements up at most and only as far as the sectioning element around. A container's points are discounted
by its link density. The best container is kept whole, with those siblings that score at
least a fifth of it, or are prose themselves (long with few links, or a heading or paragraph next to it).

Text: character references decoded, white space inside a block (a paragraph, a heading, a list
item, a table cell, a run of text between block tags) made one space, blocks joined by a newline.

Defined cases: null or empty html, or html without text outside of what is left out, gives an empty
text; a page without paragraphs is scored by its runs of text; ties go to the deeper container,
then to the earlier one; null and repeated page ids are rows of their own; extra columns are ignored. White space is Unicode's; characters of
no width stay. The time follows a page's length, however deep its elements are nested.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML's element names by kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas title textarea xmp noembed noframes".split())
DROPPED = frozenset("nav footer aside form button select option head dialog menu audio video map datalist fieldset label input header".split()) | RAW
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul search".split())
CLOSES_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr legend summary".split())
IMPLIED = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "thead tbody tfoot tr td th", "tfoot": "thead tbody tfoot tr td th"}
SCOPES = frozenset("table td th ul ol dl div article section main aside body html blockquote".split())
SECTIONS = frozenset("article main body html".split())
_NAME = r"(?:^|[\s_-])(?:%s)(?:$|[\s_-])"
#: words of class, id and role that mark what is no prose, whatever stands beside them
UNLIKELY = re.compile(
    _NAME
    % "ad|ads|adbox|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|navigation|nav|navbar|menu|menubar|breadcrumb|breadcrumbs|pagination|pager|footer|topbar|toolbar|sidebar|aside|widget|"
    "comment|comments|disqus|respond|reply|replies|cookie|cookies|consent|gdpr|notices|notification|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|related|recommended|recommendations|hidden|copyright|disclaimer|contentinfo|complementary|alertdialog",
    re.I,
)
#: words that mark it unless one of LIKELY stands beside them, as in the header of a post
DOUBTFUL = re.compile(_NAME % "banner|foot|header|masthead|side|rail|notice|alert|tags|skip|legal", re.I)
LIKELY = re.compile(_NAME % "article|post|entry|story", re.I)
#: what the words say of a layout, not of the element
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|no|without)-[\w-]+", re.I)
#: words that make even an article a reader's comment
COMMENT = re.compile(_NAME % "comment|comments|respond|reply|replies", re.I)
#: Ancestors that a paragraph's points reach.
REACH = 32

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("children", "depth", "dropped", "points", "parent", "tag")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.depth = parent.depth + 1 if parent is not None else 0
        self.children: list[Node | str] = []
        self.points = 0.0


def _unlikely(tag: str, raw: str) -> bool:
    if not raw or raw.isspace():
        return False
    values = {m[0].lower(): next((x for x in m[1:] if x), "") for m in _ATTRIBUTE.findall(raw)}
    if "hidden" in values or re.search(r"display\s*:\s*none", values.get("style", "")) or values.get("aria-hidden") == "true":
        return True
    named = LAYOUT.sub(" ", " ".join(values.get(k, "") for k in ("class", "id", "role")))
    if not named.strip() or tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return bool(COMMENT.search(named))
    return bool(UNLIKELY.search(named)) or bool(DOUBTFUL.search(named)) and not LIKELY.search(named)


def parse(page: str) -> Node:
    root = node = Node("html", None)
    open_: Counter = Counter(["html"])
    endless: set[str] = set()  # raw tags that aren't closed further on
    at = 0
    find = _TOKEN.search

    def close(n: Node) -> Node:
        """Leave every element up to n; the node then open."""
        x = node
        while x is not n.parent:
            open_[x.tag] -= 1
            x = x.parent
        return n.parent

    while m := find(page, at):
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        if not (tag := m[2]):
            continue
        tag = tag.lower()
        if m[1]:
            n = node if open_[tag] else None
            while n is not None and n.tag != tag:
                n = n.parent if tag in BLOCK or n.tag not in BLOCK else None
            if n is not None and n.parent is not None:
                node = close(n)
            elif tag == "p" or tag == "br":
                node.children.append(Node("br", node))
            continue
        if tag in ("html", "body") and node.tag in ("html", "body", "head"):
            if tag == "body":
                node = Node("body", root)
                open_["body"] += 1
                root.children.append(node)
            continue
        if tag in CLOSES_P and open_["p"]:
            n = node
            while n is not None and n.tag != "p" and n.tag not in SCOPES:
                n = n.parent
            if n is not None and n.tag == "p":
                node = close(n)
        ends = IMPLIED.get(tag, "").split()
        if any(open_[t] for t in ends):
            n, top = node, None
            while n is not None and (n.tag not in SCOPES or n.tag in ends):
                if n.tag in ends:
                    top = n
                n = n.parent
            if top is not None:
                node = close(top)
        new = Node(tag, node, tag in DROPPED and not (tag == "header" and open_["article"]) or _unlikely(tag, m[3]))
        node.children.append(new)
        if tag in RAW:
            end = None if tag in endless else re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
            if end is None:
                endless.add(tag)
            at = end.end() if end else len(page) if tag not in ("title", "noscript", "template", "svg", "math", "object", "canvas") else at
        elif tag not in VOID and not m[3].endswith("/"):
            node = new
            open_[tag] += 1
    if at < len(page):
        node.children.append(page[at:])
    return root


def _inside(node: Node | None, tag: str) -> bool:
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def blocks(node: Node, skip: frozenset = frozenset()) -> list[tuple[Node, str, int]]:
    """(block, text, characters in links) in page order, without what is dropped."""
    out: list[tuple[Node, str, int]] = []
    run: list[str] = []
    linked = 0

    def flush(owner: Node) -> None:
        nonlocal linked
        text = _WHITE.sub(" ", entities.unescape("".join(run))).strip()
        if text:
            out.append((owner, text, min(linked, len(text))))
        run.clear()
        linked = 0

    owner = node
    while owner.tag not in BLOCK and owner.parent is not None:
        owner = owner.parent
    stack: list[tuple[Node, int, bool, Node]] = [(node, 0, False, owner)]
    while stack:
        n, k, link, owner = stack.pop()
        if k == len(n.children):
            if n.tag in BLOCK:
                flush(n)
            continue
        stack.append((n, k + 1, link, owner))
        c = n.children[k]
        if isinstance(c, str):
            run.append(c)
            linked += link and len(c.strip())
        elif c.tag == "br":
            run.append(" ")
        elif not c.dropped and c not in skip:
            if c.tag in BLOCK:
                flush(owner)
            stack.append((c, 0, link or c.tag == "a", c if c.tag in BLOCK else owner))
    flush(node)
    return out


def extract(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    found = blocks(root)
    if not found:
        return ""
    text_of: dict[Node, int] = {}
    links_of: dict[Node, int] = {}
    scored: dict[Node, int] = {}
    for owner, text, linked in found:
        text_of[owner] = text_of.get(owner, 0) + len(text)
        links_of[owner] = links_of.get(owner, 0) + linked
        depth = 0
        points = (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - linked / len(text))
        n = owner if owner.tag in ("div", "section", "article", "main", "body", "html", "td") else owner.parent or owner
        while n is not None and depth < REACH:
            n.points += points / (depth + 1 if depth < 2 else depth * 2)
            scored.setdefault(n, len(scored))
            if n.tag in SECTIONS:
                break
            depth += 1
            n = n.parent
    for n in _deepest_first(text_of):
        if n.parent is not None:
            text_of[n.parent] = text_of.get(n.parent, 0) + text_of[n]
            links_of[n.parent] = links_of.get(n.parent, 0) + links_of[n]
    value = {n: n.points * (1 - links_of[n] / text_of[n]) * (1.5 if n.tag in ("article", "main") else 1) for n in scored}
    best = max(scored, key=lambda n: (value[n], n.depth, -scored[n]))
    if _inside(best, "article"):
        while best.tag != "article" or _inside(best.parent, "article"):
            best = best.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("body", "main"):
        kept = []
        for c in best.parent.children:
            if isinstance(c, str) or c.dropped or c not in text_of:
                continue
            dense = links_of[c] / text_of[c]
            if c is best or value.get(c, 0) >= 0.2 * value[best] > 0 or (c.tag == "p" and dense < 0.25 and text_of[c] >= 80) or c.tag in ("h1", "h2"):
                kept.append(c)
    return "\n".join(text for n in kept for _, text, _ in blocks(n))


def _deepest_first(some: dict[Node, int]) -> list[Node]:
    """The nodes and all their ancestors, each after every one of its descendants."""
    seen: set[Node] = set()
    for n in some:
        while n is not None and n not in seen:
            seen.add(n)
            n = n.parent
    return sorted(seen, key=lambda n: -n.depth)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(h) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages: (page_id, url, html). One row per row: page_id, url, text, n_chars."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(_run, "page_id long, url string, text string, n_chars long")
