"""Article text by density: the block in which most text stands with the fewest elements, links apart.

A second extractor beside the fixed selectors of ``sources.html``, for pages that these do not know. One walk lists the
elements, without those that never hold an article, and one pass back over the list adds up for each element the letters
below it, those of them inside links, and the block elements. An element's density is its letters outside links for each
block element (itself included); it scores the sum of its children's densities, its own text being such a child. So a
container whose paragraphs stand side by side scores their letters, and one around several containers less. The first of the
best is the article. Menus, blocks with more than half of their letters in links, are left out of it; tables are kept, a line
for each row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import some
from ..functions.texts import clean_text
from ..tables import bound_batches
from .html import CONTENT, LINES, REMOVED, Node, any_of, images, parse, parsed_once, post_text, readable_text

CELL = " | "


class Blocks:
    """Elements of a page in order, with sums over what is below each."""

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.parent: list[int] = []
        self.own: list[int] = []  # letters of the element's own text
        linked, left_out = [], any_of(tuple(REMOVED))
        stack = [(root, -1, False)]
        while stack:
            node, up, within = stack.pop()
            if left_out(node):
                continue
            here, within = len(self.nodes), within or node.tag == "a"
            self.nodes.append(node)
            self.parent.append(up)
            self.own.append(sum(len("".join(c.split())) for c in node.children if isinstance(c, str)))
            linked.append(within)
            stack += [(c, here, within) for c in reversed(node.children) if isinstance(c, Node)]
        n = len(self.nodes)
        self.letters, self.in_links = self.own.copy(), [k * link for k, link in zip(self.own, linked, strict=True)]
        self.blocks, self.score = [1] * n, [0.0 if link else float(k) for k, link in zip(self.own, linked, strict=True)]
        for i in range(n - 1, 0, -1):  # an element comes after the one that holds it
            up = self.parent[i]
            self.letters[up] += self.letters[i]
            self.in_links[up] += self.in_links[i]
            self.score[up] += self.density(i)
            self.blocks[up] += self.blocks[i] if self.nodes[i].tag in LINES else self.blocks[i] - 1

    def density(self, i: int) -> float:
        return (self.letters[i] - self.in_links[i]) / self.blocks[i]

    def menu(self, i: int) -> bool:
        return self.nodes[i].tag in LINES and 2 * self.in_links[i] > self.letters[i]

    def best(self) -> int:
        return max(range(len(self.nodes)), key=lambda i: (self.score[i], -i))

    def text(self, i: int) -> str:
        """Lines of an element's text without menus in it; cells of a row stand on one line."""
        at = {id(n): k for k, n in enumerate(self.nodes)}
        out, stack = [], [(self.nodes[i], False)]
        while stack:
            node, in_row = stack.pop()
            if isinstance(node, str):
                out.append(node)
                continue
            k = at.get(id(node))
            if k is None or (k != i and self.menu(k)):
                continue
            if node.tag in ("td", "th"):
                out.append("\0")
            elif node.tag in LINES and not in_row:
                out.append("\n")
                stack.append(("\n", in_row))
            elif node.tag in LINES:
                out.append(" ")
            in_row = in_row or node.tag == "tr"
            stack += [(c, in_row) for c in reversed(node.children)]
        lines = (CELL.join(c for x in line.split("\0") if (c := " ".join(x.split()))) for line in "".join(out).split("\n"))
        return "\n".join(x for x in lines if x)


def dense_text(html: str | None) -> str:
    return densest(parse(html))


def densest(root: Node) -> str:
    blocks = Blocks(root)
    return blocks.text(blocks.best()) if blocks.nodes else ""


def html_dense_text(html: Column) -> Column:
    """The text of a page's densest block; clean it with ``functions.texts.clean_text``."""
    bound_batches()

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(dense_text)

    return run(html)


def extracted_pages(pages: DataFrame, of_post: Column | None = None) -> DataFrame:
    """pages(page_url, html) -> (page_url, full_text, fallback_text, image_urls, thread_text), as ``content.with_content`` reads them.

    The first text is that of the known selectors (a single post's where ``of_post``), the second that of the densest block."""
    least = lambda text: F.when(F.length(text) >= 50, F.substring(text, 1, 50_000))
    texts = lambda root, post: post_text(root) if post else readable_text(root, CONTENT, 200)
    parts = [("first", "string", texts), ("second", "string", lambda root, post: densest(root)), ("images", "array<string>", lambda root, post: images(root))]
    found = pages.select("page_url", parsed_once(parts, F.col("html"), F.coalesce(F.lit(False) if of_post is None else of_post, F.lit(False))).alias("found"))
    return found.select("page_url", least(clean_text(F.col("found.first"))).alias("full_text"), least(clean_text(F.col("found.second"))).alias("fallback_text"), some(F.col("found.images")).alias("image_urls"), F.lit(None).cast("string").alias("thread_text"))
