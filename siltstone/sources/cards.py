"""Cards of a page as rows: one row for each card, by a table function that is joined laterally to the pages.

A page is walked once. The walk lays its text out in one string and notes for each element which stretch of it is its own,
so the length of an element's text, its first author, link, picture or age are looked up in sorted places; a card's own text
is rendered once, however many links share it. The work grows with the page and with what comes out of it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urljoin

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import bound_batches
from .html import LINES, any_of, parse

# Links, authors and cards of a page of saved posts, ages as it writes them, and what is no part of a text or name.
POST_LINKS = ['a[href*="/feed/update/"]', 'a[href*="/posts/"]', 'a[href*="/activity/"]']
POST_AUTHORS = ['[class*="actor"]', '[class*="author"]', 'a[href*="/in/"]']
POST_URNS = ['[data-urn*="activity"]', '[data-urn*="update"]', '[data-urn*="post"]']
POST_CARDS = ['[class*="save-caFE"]', '[class*="saved-item"]', '[class*="entity-result"]', '[class*="occludable"]']
AGE = re.compile(r"\b\d+\s*(?:s|sec|secs|m|min|mins|h|hr|hrs|d|day|days|w|wk|wks|mo|mos|month|months|y|yr|yrs|year|years)\b\s*•", re.IGNORECASE)
BLANK_LINES = re.compile(r"\n{3,}")
STATUS_LINE = re.compile(r"^Status is (?:online|offline)\n", re.MULTILINE)
VIEW_PROFILE = re.compile(r"\nView .*?profile.*$", re.IGNORECASE | re.DOTALL)
VIEW_COMPANY = re.compile(r"\nView company:.*$", re.IGNORECASE | re.DOTALL)
#: How far up a link's card and age are looked for, and the characters that a card has more of.
CARD_STEPS, AGE_STEPS, CARD_CHARS = 12, 10, 80

SPACES = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)


def tidy(text: str) -> str:
    return STATUS_LINE.sub("", BLANK_LINES.sub("\n\n", text)).strip()


def absolute(base: str, href: str) -> str:
    try:
        return urljoin(base, href)
    except ValueError:
        return href


class Page:
    """Elements in the order of the page; those below element i are the ones from i + 1 to ``end[i]``."""

    def __init__(self, html: str | None):
        self.nodes, self.end, self.span, self.parent = [], [], [], []
        pieces: list[str] = []
        at, stack = 0, [(parse(html), -1)]
        while stack:
            node, i = stack.pop()
            if isinstance(node, int):  # everything below this one has been seen
                if self.nodes[node].tag in LINES:
                    pieces.append("\n")
                    at += 1
                self.end[node], self.span[node] = len(self.nodes), (self.span[node][0], at)
            elif isinstance(node, str):
                pieces.append(node)
                at += len(node)
            else:
                own = len(self.nodes)
                self.nodes.append(node)
                self.end.append(0)
                self.span.append((at, 0))
                self.parent.append(i)
                if node.tag in LINES:
                    pieces.append("\n")
                    at += 1
                stack.append((own, -1))
                stack += [(c, own) for c in reversed(node.children)]
        self.raw = "".join(pieces)
        space = np.isin(np.frombuffer(self.raw.encode("utf-32-le", "surrogatepass"), "<u4"), SPACES)
        begins = ~space
        begins[1:] &= space[:-1]
        self.ink, self.words = (np.concatenate([[0], np.cumsum(x)]).tolist() for x in (~space, begins))
        self.ages = [m.span() for m in AGE.finditer(self.raw)]
        self.texts: dict[int, str] = {}

    def chars(self, i: int) -> int:
        """The length of ``text(i)``: its words' letters, and one character between neighbours."""
        a, b = self.span[i]
        words = self.words[b] - self.words[a] + (a < b and self.ink[a + 1] > self.ink[a] and self.words[a + 1] == self.words[a])
        return self.ink[b] - self.ink[a] + max(0, words - 1)

    def text(self, i: int) -> str:
        if i not in self.texts:
            lines = (" ".join(x.split()) for x in self.raw[slice(*self.span[i])].split("\n"))
            self.texts[i] = "\n".join(x for x in lines if x)
        return self.texts[i]

    def age(self, i: int) -> str | None:
        """The first age in an element's text; one that begins within a word counts where the element does."""
        a, b = self.span[i]
        k = bisect_left(self.ages, (a, 0))
        found = AGE.match(self.raw[a:b]) if a < b and self.raw[a].isdigit() else None
        if found is None and k < len(self.ages) and self.ages[k][1] <= b:
            return " ".join(self.raw[slice(*self.ages[k])].replace("•", "").split())
        return " ".join(found[0].replace("•", "").split()) if found else None

    def places(self, *selectors: str) -> list[int]:
        wanted = any_of(selectors)
        return [i for i, n in enumerate(self.nodes) if wanted(n)]

    def first(self, places: list[int], i: int) -> int | None:
        """The first of the places below element i."""
        k = bisect_left(places, i + 1)
        return places[k] if k < len(places) and places[k] < self.end[i] else None

    def below(self, places: list[int], i: int) -> list[int]:
        return places[bisect_left(places, i + 1) : bisect_left(places, self.end[i])]

    def up(self, i: int, steps: int) -> Iterator[int]:
        """Element i and those around it, up to the body."""
        while steps and i >= 0 and self.nodes[i].tag not in ("body", ""):
            yield i
            i, steps = self.parent[i], steps - 1


def status_cards(html: str | None, base: str = "https://x.com/") -> Iterator[tuple]:
    """Cards of a page of saved statuses, each address once, in the order of the page."""
    page = Page(html)
    hrefs = {i: absolute(base, page.nodes[i].attrs["href"]) for i in page.places("a[href]")}
    anchors, numbered = list(hrefs), [i for i, h in hrefs.items() if re.search(r"/status/\d+", h)]
    texts, times, pictures = page.places('[data-testid="tweetText"]'), page.places("time[datetime]"), [i for i in page.places("img[src]") if "pbs.twimg.com/media/" in page.nodes[i].attrs["src"]]
    found = set()
    for card in page.places("article"):
        link = page.first(numbered, card)
        if link is None or (url := hrefs[link]) in found:
            continue
        found.add(url)
        own, time, author = page.first(texts, card), page.first(times, card), re.search(r"x\.com/([^/]+)/status/", url)
        yield (
            url,
            page.text(card if own is None else own),
            author[1] if author else "unknown",
            None if time is None else page.nodes[time].attrs["datetime"],
            [h for i in page.below(anchors, card) if (h := hrefs[i]).startswith("http") and "x.com" not in h and "twitter.com" not in h],
            [hrefs[i] for i in page.below(numbered, card) if hrefs[i] != url],
            [page.nodes[i].attrs["src"] for i in page.below(pictures, card)],
        )


def post_cards(html: str | None, base: str = "https://www.linkedin.com/") -> Iterator[tuple]:
    """Cards of a page of saved posts, each address once: around links to posts, elements named as posts, and saved cards."""
    page = Page(html)
    links, anchors, authors = page.places(*POST_LINKS), page.places("a[href]"), page.places(*POST_AUTHORS)
    pictures = [i for i in page.places("img[src]") if (u := page.nodes[i].attrs["src"]).startswith("http") and "profile-displayphoto" not in u]
    # (element that tells the address, card, element near which the age stands), in the order in which they count
    wanted = ((i, None, i) for i in links)
    named = ((page.first(anchors, i), i, i) for i in page.places(*POST_URNS))
    saved = ((page.first(links, i), i, i) for i in page.places(*POST_CARDS))
    found, facts = set(), {}
    for kind in (wanted, named, saved):
        for link, card, near in kind:
            if link is None or (url := absolute(base, page.nodes[link].attrs["href"])) in found or not url:
                continue
            found.add(url)
            if card is None:
                card = next((n for n in page.up(link, CARD_STEPS) if page.chars(n) > CARD_CHARS and page.first(links, n) is not None), link)
            if card not in facts:
                author = page.first(authors, card)
                name = "" if author is None else VIEW_COMPANY.sub("", VIEW_PROFILE.sub("", tidy(page.text(author)))).strip()
                facts[card] = (tidy(page.text(card)), name or "unknown", [page.nodes[i].attrs["src"] for i in page.below(pictures, card)])
            text, author, images = facts[card]
            yield url, text, author, next((a for n in page.up(near, AGE_STEPS) if (a := page.age(n))), None), images


def thread_cards(html: str | None) -> Iterator[tuple]:
    """Cards of a thread's page; the author is null where the card does not tell."""
    page, nth = Page(html), 0
    names, texts, anchors = page.places('[data-testid="User-Name"]'), page.places('[data-testid="tweetText"]'), page.places("a[href]")
    for card in page.places('[data-testid="tweet"]'):
        name, text = page.first(names, card), page.first(texts, card)
        inside = page.below(anchors, name) if name is not None else []
        handles = (re.fullmatch(r"/([A-Za-z0-9_]+)", page.nodes[i].attrs["href"].partition("?")[0]) for i in inside)
        handle = next((m for m in handles if m), None)
        if text is not None:
            yield nth, handle[1].lower() if handle else None, page.text(text)
            nth += 1


@F.udtf(returnType="url: string, text: string, author: string, published_at: string, external_urls: array<string>, referenced_tweet_urls: array<string>, image_urls: array<string>", useArrow=True)
class StatusCards:
    def eval(self, html: str) -> Iterator[tuple]:
        yield from status_cards(html)


@F.udtf(returnType="url: string, text: string, author: string, created_text: string, image_urls: array<string>", useArrow=True)
class PostCards:
    def eval(self, html: str) -> Iterator[tuple]:
        yield from post_cards(html)


@F.udtf(returnType="ord: int, author: string, text: string", useArrow=True)
class ThreadCards:
    def eval(self, html: str) -> Iterator[tuple]:
        yield from thread_cards(html)


def _rows(pages: DataFrame, function, html: str, keep: list[str]) -> DataFrame:
    bound_batches(pages.sparkSession)
    return pages.select(*keep, F.col(html).alias("_html")).lateralJoin(function(F.col("_html").outer())).drop("_html")


def status_rows(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` of a page beside each of its cards, as ``feeds.bookmarks_from_visible_statuses`` reads them."""
    return _rows(pages, StatusCards, html, keep)


def post_rows(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` of a page beside (url, text, author, created_text, image_urls) of each of its cards."""
    return _rows(pages, PostCards, html, keep)


def thread_rows(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` of a page beside (ord, author, text) of each card of its thread, as ``content.thread_texts`` reads them."""
    return _rows(pages, ThreadCards, html, keep)
