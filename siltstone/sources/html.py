"""Readable text, links and pictures of HTML pages. Only this needs Python: a page is a tree, not a pattern."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..tables import bound_batches

# Elements that hold the article, best first; and elements that never do.
CONTENT = [
    '[data-testid="article-body"]', 'article', '[role="article"]', '.post-content', '.article-content', '.entry-content', '.post-body',
    '.story-body', '.main-content', '#main-content', '#article-body', '.article-body', '.ArticleBody', '.styled-body', '[data-article]',
    '.blog-post-content', '.content-body', 'main', '[role="main"]',
]
REMOVED = [
    'nav', 'header', 'footer', 'aside', '[role="navigation"]', '[role="banner"]', '[role="contentinfo"]', '[role="complementary"]', '.sidebar',
    '.ad', '.advertisement', '.social-share', '.share-buttons', '.related-posts', '.comments', '#comments', '.newsletter', '.popup',
    '.modal', 'script', 'style', 'noscript', 'iframe',
]
# The same for pages of single posts.
POST_CONTENT = [
    '.update-components-text', '.feed-shared-update-v2__description', '.break-words', '.article-content', 'article', '[role="article"]',
    '.reader-article-content', '[data-article-body]', '.main-content',
]
POST_REMOVED = [
    'nav', 'footer', 'aside', '[role="navigation"]', '[role="banner"]', '[role="contentinfo"]', '.sidebar', '.ad', '.social-share',
    '.share-buttons', '.comments-container', '#comments', 'script', 'style', 'noscript', 'iframe',
]
# Where links of a post stand; pictures that are no content, and what marks those that are.
LINK_HOLDERS = ['.update-components-text', '.feed-shared-update-v2__description', '.break-words', '[dir="ltr"]', 'article']
NO_IMAGE = ["profile_images", "profile-displayphoto", "emoji", "avatar", "logo", "icon", "sprite"]
IMAGE_MARKS = [".jpg", ".jpeg", ".png", ".webp", "pbs.twimg.com/media", "media.licdn.com"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LINES = {"address", "article", "blockquote", "br", "div", "dl", "dt", "dd", "fieldset", "figure", "form", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li", "main", "ol", "p", "pre", "section", "table", "tr", "ul"}


@lru_cache(maxsize=1000)
def read_selector(selector: str) -> tuple[str, str, str, str]:
    """(tag, attribute, '' or '=' or '*=', value) of a selector of one condition."""
    tag, sign, rest = re.fullmatch(r"([a-z0-9]*)([.#[]?)(.*)", selector).groups()
    if sign in (".", "#"):
        return tag, "class" if sign == "." else "id", "~=" if sign == "." else "=", rest
    name, how, value = re.fullmatch(r"([^*=]*)(\*?=?)(.*)", rest.removesuffix("]")).groups()
    return tag, name, how, value.strip("\"'")


@lru_cache(maxsize=1000)
def any_of(selectors: tuple[str, ...]) -> Callable[[Node], bool]:
    """Whether an element matches one of the selectors. Most have no attributes and are told by their tag alone."""
    read = [read_selector(s) for s in selectors]
    tags = frozenset(tag for tag, name, _, _ in read if not name)
    conditions = [x for x in read if x[1]]

    def found(node: Node) -> bool:
        if node.tag in tags:
            return True
        attrs = node.attrs
        if attrs:
            for tag, name, how, value in conditions:
                if name in attrs and (not tag or tag == node.tag):
                    own = attrs[name]
                    if value in own.split() if how == "~=" else value in own if how == "*=" else own == value if how == "=" else True:
                        return True
        return False

    return found


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def matches(self, selector: str) -> bool:
        return any_of((selector,))(self)

    def below(self, *selectors: str) -> Iterator[Node]:
        """Elements below this one that match one of the selectors."""
        wanted = any_of(selectors)
        return (n for n in self.walk() if n is not self and wanted(n))

    def walk(self) -> Iterator[Node]:
        """This element and all below it, in the order of the page."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, removed: list[str]) -> str:
        out, stack, left_out = [], [self], any_of(tuple(removed))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            elif not left_out(node):
                if node.tag in LINES:
                    out.append("\n")
                    stack.append("\n")
                stack += reversed(node.children)
        lines = (" ".join(x.split()) for x in "".join(out).split("\n"))
        return "\n".join(x for x in lines if x)


# Tags as most are: lower-case names, values in double quotes without references. What they say needs no closer look.
PLAIN_START = re.compile(r'<([a-z][a-z0-9]*)((?:[ ]+[a-z][a-z0-9_-]*="[^"&<>]*")*)>')
PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")
PLAIN_ATTRIBUTE = re.compile(r'([a-z][a-z0-9_-]*)="([^"]*)"')
#: Elements whose content the parser reads in another way.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class TreeParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        self.open_tags: Counter[str] = Counter()

    def updatepos(self, i, j):
        return j  # lines are not counted

    def parse_starttag(self, i):
        found = PLAIN_START.match(self.rawdata, i)
        if found is None or found[1] in RAW:
            return super().parse_starttag(i)
        self.lasttag = found[1]
        self.handle_starttag(found[1], PLAIN_ATTRIBUTE.findall(found[2]) if found[2] else ())
        return found.end()

    def parse_endtag(self, i):
        found = PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if found is None or found[1] in RAW:
            return super().parse_endtag(i)
        self.handle_endtag(found[1])
        return found.end()

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li", "tr") and self.open[-1].tag == tag:
            self.close_one()
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.open_tags[tag] += 1

    def close_one(self) -> str:
        tag = self.open.pop().tag
        self.open_tags[tag] -= 1
        return tag

    def handle_endtag(self, tag):
        if self.open_tags[tag]:  # else it closes nothing, and nothing is searched
            while self.close_one() != tag:
                pass

    def handle_data(self, data):
        self.open[-1].children.append(data.replace("\n", " ").replace("\r", " "))


def parse(html: str | None) -> Node:
    parser = TreeParser()
    parser.feed(html or "")
    parser.close()
    return parser.root


def readable_text(root: Node, selectors: list[str], least: int, removed: list[str] = REMOVED, last: tuple[str, ...] = ("body",)) -> str:
    """The text of the first element in the order of ``selectors`` with more than ``least`` characters, else of ``last``."""
    nodes = list(root.walk())
    for selector in selectors:
        found = next(filter(any_of((selector,)), nodes), None)
        if found is not None and len(text := found.text(removed)) > least:
            return text
    return next(filter(any_of(last), nodes), root).text(removed)


def post_text(root: Node) -> str:
    """The text of a single post's page; as an article's page if it holds less than 50 characters."""
    text = readable_text(root, POST_CONTENT, 50, POST_REMOVED, ("main", '[role="main"]'))
    return text if len(text.strip()) >= 50 else readable_text(root, CONTENT, 200)


def status_text(root: Node) -> str | None:
    """The text of a single status: its text element, else the first element with a language in an article or card."""
    for n in root.below('[data-testid="tweetText"]'):
        if len(text := n.text([])) > 10:
            return text
        break
    for holder in root.below("article"):
        for n in holder.below("[lang]"):
            text = n.text([])
            return text if len(text) > 10 else None
    for holder in root.below('[data-testid="tweet"]'):
        if (n := next(holder.below("[lang]"), None)) is not None and len(text := n.text([])) > 10:
            return text
    return None


def links(root: Node, own_domain: str) -> list[str]:
    def inside(selectors: list[str]) -> list[str]:
        hrefs, stack, holds = [], [(root, False)], any_of(tuple(selectors))
        while stack:  # one walk, however deep holders stand in each other
            node, within = stack.pop()
            if within and node.tag == "a" and "href" in node.attrs:
                hrefs.append(node.attrs["href"])
            within = within or holds(node)
            stack += [(c, within) for c in reversed(node.children) if isinstance(c, Node)]
        good = [h for h in hrefs if h.startswith("http") and own_domain not in h and "/help/" not in h and "/hashtag/" not in h]
        return list(dict.fromkeys(good))

    return inside(LINK_HOLDERS) or inside(["main", '[role="main"]'])


def images(root: Node, most: int = 20) -> list[str]:
    found, stack, holds = [], [(root, False)], any_of(("article", "main", '[role="main"]'))
    while stack:
        node, within = stack.pop()
        if within and node.tag == "img":
            found.append(node.attrs.get("src", ""))
        within = within or holds(node)
        stack += [(c, within) for c in reversed(node.children) if isinstance(c, Node)]
    found += [n.attrs.get("content", "") for n in root.walk() if n.tag == "meta" and ("og:image" == n.attrs.get("property") or "twitter:image" == n.attrs.get("name"))]
    good = [u for u in found if u.startswith("http") and not any(m in u.lower() for m in NO_IMAGE) and any(m in u.lower() for m in IMAGE_MARKS)]
    return list(dict.fromkeys(good))[:most]


def parsed_once(parts: list[tuple[str, str, Callable[[Node], object]]], html: Column, *others: Column) -> Column:
    """A struct of (name, type, function of a page's tree); a page is parsed once for all of them. ``others`` are flags that
    follow the tree as arguments."""
    bound_batches()
    functions = [f for _, _, f in parts]

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind, _ in parts))
    def run(pages: pd.Series, *flags: pd.Series) -> pd.DataFrame:
        rows = []
        for page, *given in zip(pages, *flags, strict=True):
            root = parse(page)
            rows.append([f(root, *given) for f in functions])
        return pd.DataFrame(rows, columns=[name for name, _, _ in parts], dtype=object)

    return run(html, *others)


def html_text(html: Column, selectors: list[str] = CONTENT, least: int = 200) -> Column:
    """Readable text; clean it with ``functions.texts.clean_text``."""

    bound_batches()
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: readable_text(parse(p), selectors, least))

    return run(html)


def html_links(html: Column, own_domain: str = "linkedin.com") -> Column:
    bound_batches()
    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: links(parse(p), own_domain))

    return run(html)


def html_images(html: Column) -> Column:
    bound_batches()
    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: images(parse(p)))

    return run(html)


def html_status(html: Column) -> Column:
    bound_batches()
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: status_text(parse(p)))

    return run(html)


def html_post(html: Column) -> Column:
    bound_batches()
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: post_text(parse(p)))

    return run(html)


def page_content(url: Column, html: Column, of_post: bool = False) -> Column:
    """struct(url, full_text, image_urls): cleaned text of at most 50,000 characters, null if under 50.

    ``of_post``: the page of a single post of the second feed."""
    from ..functions.strings import some
    from ..functions.texts import clean_text

    read = post_text if of_post else partial(readable_text, selectors=CONTENT, least=200)
    found = parsed_once([("text", "string", read), ("images", "array<string>", images)], html)
    text = clean_text(found["text"])
    return F.struct(url.alias("url"), F.when(F.length(text) >= 50, F.substring(text, 1, 50_000)).alias("full_text"), some(found["images"]).alias("image_urls"))
