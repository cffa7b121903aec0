"""Main-text extraction by scoring the element tree.

A page is read once into blocks of text (what stands between two block-level tags) and the tree of
block-level elements around them. A paragraph passes points for its length and its commas to
its ancestors: all to the parent, half to the next, then a third of that per level. Element names and class or id names that
speak for content or against it shift an element's points, and the share of its text that is in links discounts
them. The best container is kept, widened to the article around it or to an ancestor that holds clearly more
running text, with those siblings that score well or hold running text; articles beside the best one that hold running text are parts of the same story. Inside them, elements
that are never content are left out, and outside an article element also blocks that are mostly links.

Elements that are never content: scripts, styles, hidden elements, menus, headers and footers outside the article, asides, forms (unless the article
is inside), and elements with a class or id that says so in full, such as ``sidebar``, ``post-comments`` or ``cookie-banner``. A class that only mentions such
a thing (``has-sidebar``, ``comments-open``, ``tag-politics``) lowers the score, and leaves an element out when most of its text is links. An element that
holds the article is never left out for its name, and a page of which nothing would remain is read without regard to names.

Pages are independent: rows are handled in Arrow batches, nothing is shuffled. Each page is linear in its length and depth.

Defined results: null and empty pages and pages without text give an empty text of length 0; broken markup (unclosed or
stray tags, unclosed comments) is read on, never an error; any length is read whole; further columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsync.llm.common import bounded_batches, tidy

# Names of HTML elements by their role.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = set("p pre td blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption th".split())
RAW = set("script style noscript template iframe textarea title svg canvas object xmp math noframes noembed".split())
NEVER = set("nav aside form footer menu fieldset select dialog button search head datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that end tags and implied ends of list items, cells and paragraphs do not reach out of.
KEEPERS = set("ul ol dl table tbody thead tfoot menu dir select article main body".split())
ENCLOSED = set("p li dt dd tr td th option".split())
PRIOR = {"article": 30.0, "main": 20.0, "div": 5.0, "section": 3.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ol": -3.0, "ul": -3.0, "dl": -3.0, "li": -3.0}
# Words of class and id names: those of elements that are never content, those that stand beside them, and those of the article.
LEFT_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adbox adsense banner banners sponsor sponsors sponsored promo promos promotion breadcrumb breadcrumbs combx comment comments "
    "commentlist respond replies disqus cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login side sidebar sidebars rail menu menus nav navbar "
    "navigation topbar toolbar header masthead footer footers foot related recommended recommendations share sharing social widget widgets pagination pager toc skip skiplink copyright legal disclaimer tags search".split()
)
COMMENT_WORDS = set("comment comments commentlist respond replies disqus combx".split())
BESIDE_WORDS = set(
    "area article articles aside bar block blog body bottom box button buttons card col column container content cloud entry fixed form global group head icons inner item items left link links list message middle mobile "
    "outer page panel post posts primary reader readers right secondary section site slot sticky story text the title top unit user users wrap wrapper center main row small large first last".split()
)
ARTICLE_WORDS = set("article body content entry hentry main page post story text".split())
HEADING_WORDS = set("header head foot toc title".split())
LEFT_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())

COMMENT_END = re.compile(r"--!?>")
#: A tag; a quoted value, which stands after an equals sign, may hold any character.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
BOGUS = re.compile(r"<[!?/][^>]*+>")
NAMED = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|itemprop|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
UNSHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Tags that do not end after which quotes are no longer looked at, and the running text from which a block counts as a paragraph of an article.
BROKEN, RUNNING = 50, 80


@dataclass(slots=True, eq=False)
class Node:
    """An element of the tree: its place, whether it is left out and why it might be, its points, and how much text it holds."""

    name: str
    parent: Node | None
    out: bool = False
    named: str = ""
    weight: float = 0.0
    label: str = ""
    article: Node | None = None
    link_was: bool = False
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    running: int = 0
    holds: bool = False
    children: list[Node] = field(default_factory=list)


@dataclass(slots=True)
class Block:
    node: Node
    text: str
    linked: int


@lru_cache(maxsize=4096)
def judged(label: str) -> tuple[str, bool]:
    """What the class and id names say: ``full`` for a name of something that is never content, ``comments`` for readers' comments, ``part`` for
    one that mentions such a thing; and whether one speaks for the article."""
    said, good = "", False
    for token in label.split():
        parts = [p.lower() for p in PARTS.findall(token)]
        words = {p for p in parts if not p.isdigit()}
        left = words & LEFT_WORDS
        good = good or bool(words & ARTICLE_WORDS) and not left
        if not left or left <= HEADING_WORDS and words & {"article", "entry", "post", "story"}:
            continue
        if words <= LEFT_WORDS | BESIDE_WORDS:
            said = "comments" if words & COMMENT_WORDS else said if said == "comments" else "full"
        else:
            said = said or "part"
    return said, good


def _attributes(name: str, raw: str) -> tuple[str, str, bool, float]:
    """The element's class and id, what they say, whether it is hidden or has the role of something else, and the points its name is worth."""
    label = role = ""
    hidden = False
    if raw and not raw.isspace():
        for m in NAMED.finditer(raw):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in ("class", "id"):
                label = f"{label} {value}".strip()
            elif key == "role":
                role = value.lower()
            elif key == "style":
                hidden = hidden or bool(UNSHOWN.search(value))
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                hidden = True
            elif key == "itemprop" and value.lower() == "articlebody":
                label = f"{label} article".strip()
    said, good = judged(label)
    if name in ("html", "body", "article", "main"):
        said = said if said == "comments" else ""
    weight = PRIOR.get(name, 0.0) + (25.0 if good else 0.0) - (25.0 if said else 0.0)
    return label, said, hidden or role in LEFT_ROLES, weight


def parse(page: str) -> tuple[list[Node], list[Block]]:
    """The block-level elements (parents before children, the page itself first) and the blocks of text in page order."""
    node = Node("#page", None)
    nodes, blocks, pieces = [node], [], []
    open_, scopes = Counter(), [Counter()]  # open elements by name: of the page, and since each keeper
    in_link, link_chars, at, broken = False, 0, 0, 0
    last, size, tag = page.rfind(">"), len(page), TAG

    def flush() -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                blocks.append(Block(node, text, min(link_chars, len(text))))
        link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw:
            pieces.append(raw)
            if in_link:
                link_chars += len(html.unescape(raw).strip())

    def close_to(names: tuple[str, ...]) -> None:
        """Close the innermost open element of these names, and all inside it."""
        nonlocal node, in_link
        while True:
            done = node
            open_[done.name] -= 1
            if done.name in KEEPERS:
                scopes.pop()
            else:
                scopes[-1][done.name] -= 1
            in_link, node = done.link_was, done.parent
            if done.name in names:
                return

    while at < size:
        start = page.find("<", at)
        if start < 0 or start > last:
            add(page[at:].partition("<!--")[0])
            break
        add(page[at:start])
        if page.startswith("<!--", start):
            end = COMMENT_END.search(page, start + 4)
            at = end.end() if end else size
            continue
        m = tag.match(page, start)
        if not m:
            skipped = BOGUS.match(page, start)
            if skipped:
                at = skipped.end()
            else:
                add("<")
                at = start + 1
                broken += page[start + 1 : start + 2].isalpha()
                if broken > BROKEN:
                    tag = PLAIN_TAG
            continue
        at = m.end()
        ending, name, raw = bool(m[1]), m[2].lower(), m[3]
        if name in RAW and not ending:
            if not raw.endswith("/") or name in ("script", "style", "textarea", "title"):
                end = _end_of(name).search(page, at)
                at = end.end() if end else size
            pieces.append(" ")
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name == "a":
            in_link = not ending
            continue
        if name not in BLOCKS and name not in NEVER:
            continue
        flush()
        if name in VOID:
            continue
        if ending:
            if (scopes[-1] if name in ENCLOSED else open_)[name] > 0:
                close_to((name,))
            continue
        if node.name == "p":
            close_to(("p",))
        ends = CLOSED_BY.get(name, ())
        if any(scopes[-1][e] > 0 for e in ends):
            close_to(ends)
        label, said, never, weight = _attributes(name, raw)
        inside = node.article
        out = node.out or never or name in NEVER and name != "form" or name == "header" and inside is None
        child = Node(name, node, out, "form" if name == "form" else said, weight, label, inside, in_link)
        if name in ("article", "main") and (inside is None or name == "article"):
            child.article = child
        node.children.append(child)
        nodes.append(child)
        node = child
        open_[name] += 1
        if name in KEEPERS:
            scopes.append(Counter())
        else:
            scopes[-1][name] += 1
    flush()
    return nodes, blocks


@lru_cache(maxsize=64)
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I)


def weigh(nodes: list[Node], blocks: list[Block], names: int) -> list[Node]:
    """Leave out what is never content, pass every paragraph's points up the tree, and add up texts; the containers with points, in page order.
    ``names``: 2 to go by names, 1 to spare the largest of the elements that are named in full, 0 to take no notice of names."""
    for x in nodes:
        x.points, x.chars, x.linked, x.running = 0.0, 0, 0, 0
    for b in blocks:
        b.node.chars += len(b.text)
        b.node.linked += b.linked
    for x in reversed(nodes[1:]):
        x.parent.chars += x.chars
        x.parent.linked += x.linked
        x.parent.holds = x.parent.holds or x.holds or x.name in ("article", "main") and not x.out and x.named != "comments"
    whole = nodes[0].chars
    if names == 1:
        max((x for x in nodes if x.named == "full"), key=lambda x: x.chars, default=nodes[0]).named = ""
    for x in nodes[1:]:
        left = x.named == "comments" or not x.holds and (x.named == "full" or x.named == "part" and x.linked > 0.5 * x.chars or x.named == "form" and 2 * x.chars <= whole)
        x.out = x.out or x.parent.out or names > 0 and left
    seen = []
    for b in blocks:
        if b.node.out:
            continue
        b.node.running += len(b.text) if len(b.text) >= RUNNING and b.linked <= 0.3 * len(b.text) else 0
        worth = min(1.0, len(b.text) / 25) + b.text.count(",") + min(len(b.text) / 100, 3.0)
        up = b.node.parent if b.node.name in PARAGRAPHS and b.node.parent is not None else b.node
        share, level = 1.0, 0
        while up is not None and level < 5:
            if not up.points:
                seen.append(up)
            up.points += worth * share
            level += 1
            share = 0.5 if level == 1 else 1 / (3 * level)
            up = up.parent
    for x in reversed(nodes[1:]):
        x.parent.running += x.running
    return seen


def rating(node: Node, named: bool = True) -> float:
    return (node.points + (node.weight if named else 0.0)) * (1 - node.linked / max(1, node.chars))


def chosen_of(best: Node) -> set[Node]:
    """The container to keep, the best one widened, and its siblings."""
    if best.article is not None:
        whole = best.article  # a story may be split into articles beside each other
        beside = whole.parent.children if whole.name == "article" and whole.parent is not None else []
        return {whole} | {x for x in beside if x.name == "article" and not x.out and x.running > 0 and x.linked <= 0.3 * x.chars}
    up = best.parent
    while up is not None and up.name not in ("body", "html", "#page"):  # parts of an article in containers of their own
        if up.running >= 1.2 * max(best.running, 1):
            best = up
        up = up.parent
    chosen = {best}
    least = max(10.0, 0.2 * rating(best, named=False))
    for other in best.parent.children if best.parent is not None else []:
        if other is best or other.out or not other.chars:
            continue
        dense = other.linked / other.chars
        if other.name in PARAGRAPHS:
            good = other.chars > RUNNING and dense < 0.25 or dense == 0 and other.name == "p"
        elif other.name in ("ul", "ol", "dl", "table"):
            good = dense < 0.1 and other.named == ""
        else:
            good = dense < 0.5 and rating(other, named=False) >= least or dense < 0.25 and other.named == "" and other.running > 0
        if good or other.name in ("h1", "h2"):
            chosen.add(other)
    return chosen


def main_text(page: str | None) -> str:
    """The article's blocks, one per line."""
    if not page:
        return ""
    for names in (2, 1, 0):
        nodes, blocks = parse(page)
        containers = weigh(nodes, blocks, names)
        if containers or not blocks:
            break
    if not containers:
        return ""
    chosen, kept = chosen_of(max(containers, key=rating)), set()
    for x in nodes:
        if x in chosen or x.parent in kept:
            kept.add(x)
    out = []
    for b in blocks:
        if b.node.out or b.node not in kept:
            continue
        inside = b.node.article
        if inside is not None and inside.name == "article" and 2 * inside.linked <= inside.chars:  # in an article a list of links is content, unless its names say otherwise
            out.append(b.text)
            continue
        lists = b.node if b.node.name in ("ul", "ol", "dl", "table", "article") else b.node.parent
        if b.linked > 0.5 * len(b.text) and (lists is None or lists.linked > 0.5 * max(1, lists.chars)):
            continue
        out.append(b.text)
    return "\n".join(out)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per page."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 256):
                part = frame.iloc[start : start + 256]
                texts = [main_text(page) for page in part["html"]]
                yield pd.DataFrame({"id": part["id"].array, "url": part["url"].array, "text": texts, "n_chars": [len(t) for t in texts]})

    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    got = bounded_batches(given).mapInPandas(tidy(run), f"id {id_type}, url {url_type}, text string, n_chars long")
    return got.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
