"""Main text of web pages by tag-path ratios.

A page is read once into blocks: the text between two tags that are not inline, with the
path of open elements from the root.  Per path the text length and the punctuation per
block are aggregated; these two ratios are smoothed over the blocks in page order with a
Gaussian, fused by their product, and a path whose mean fused ratio reaches the standard
deviation of all blocks is content, lists of links outside an article element excepted;
where most content is in article elements, only that counts.  Blocks that share the nearest
container of a content block (headings, short paragraphs, list items) belong to the same
article.  Elements that never hold the article (navigation, forms, scripts, ...) take no
part from the start.

Each page is worked on alone, in one pass over its whole html, so there is no shuffle.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import small_batches

# Element names of HTML by the part they play.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr br img nobr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = frozenset(
    "head nav footer aside form script style noscript template iframe object svg math canvas "
    "button select option textarea title dialog menu audio video noembed noframes".split()
)
CONTAINERS = frozenset("html body main article section div td center".split())
CLOSED_BY = {
    "li": frozenset({"p", "li"}),
    "dt": frozenset({"p", "dt", "dd"}),
    "dd": frozenset({"p", "dt", "dd"}),
    "tr": frozenset({"p", "tr", "td", "th"}),
    "td": frozenset({"p", "td", "th"}),
    "th": frozenset({"p", "td", "th"}),
    "body": frozenset({"head"}),
}
PARAGRAPH = frozenset({"p"})
# Words in class, id or role that mark what is not the article.
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist "
    "respond reply replies disqus widget toolbar pagination pager search contentinfo "
    "complementary dialog alert".split()
)
HEADER_WORDS = frozenset({"header", "topbar"})

_OPEN = re.compile(r"([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE = re.compile(r"([a-zA-Z][^\s/>]*)([^>]*+)>")
_CLOSE = re.compile(r"/([a-zA-Z][^\s/>]*)[^>]*+>")
_MARK = re.compile(
    r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?",
    re.IGNORECASE,
)
_WORD = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？；：]")


class Block(NamedTuple):
    text: str
    path: int  # number of the tag path
    home: int  # number of the nearest container element
    linked: bool  # more than half of its characters are in links
    article: bool  # in an article or main element


class _Element(NamedTuple):
    name: str
    path: int
    home: int
    chrome: bool
    article: bool


def _is_chrome(name: str, marks: str, inside_article: bool) -> bool:
    if name in NEVER or (name == "header" and not inside_article):
        return True
    if name in ("html", "body", "main", "article") or not marks:
        return False
    for kind, value in _MARK.findall(marks):
        kind, value = kind.lower(), value.strip("\"'").lower()
        if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
            return True
        if kind == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif kind != "aria-hidden":
            words = set(_WORD.findall(value))
            if words & CHROME_WORDS or (words & HEADER_WORDS and not inside_article):
                return True
    return False


def read_blocks(page: str) -> list[Block]:
    """Blocks with text that are not in elements which never hold the article."""
    root = _Element("", 0, 0, False, False)
    stack, names = [root], Counter()
    paths: dict[tuple[int, str], int] = {}
    blocks: list[Block] = []
    parts: list[str] = []
    homes, in_link, linked = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            top = stack[-1]
            if text:
                blocks.append(Block(text, top.path, top.home, 2 * linked > len(text), top.article))
            parts.clear()
        linked = 0

    def close(count: int) -> None:
        for _ in range(count):
            names[stack.pop().name] -= 1

    raw_ends: dict[str, re.Pattern] = {}
    at, n = 0, len(page)
    while at < n:
        found = page.find("<", at)
        if found < 0:
            found = n
        if found > at and not stack[-1].chrome:
            parts.append(page[at:found])
            linked += len(page[at:found].strip()) if in_link else 0
        if found == n:
            break
        at = found + 1
        if page.startswith("!--", at):
            end = page.find("-->", at + 1)
            if end < 0:
                break  # an open comment lasts to the end
            at = end + 3
            continue
        if page.startswith(("!", "?"), at):
            end = page.find(">", at)
            if end < 0:
                break
            at = end + 1
            continue
        closing = _CLOSE.match(page, at)
        if closing:
            at = closing.end()
            name = closing[1].lower()
            if name in INLINE:
                in_link = in_link and name != "a"
                continue
            flush()
            if names[name]:
                depth = 1
                while stack[-depth].name != name:
                    depth += 1
                close(depth)
            continue
        opening = _OPEN.match(page, at) or _LOOSE.match(page, at)
        if not opening:
            if page[at : at + 1].isalpha() or page.startswith("/", at):
                break  # a tag that the page's end cuts off
            if not stack[-1].chrome:
                parts.append("<")
            continue
        at = opening.end()
        name, marks = opening[1].lower(), opening[2]
        if name in INLINE:
            in_link = in_link or name == "a"
            if name == "br" and not stack[-1].chrome:
                parts.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        closes = CLOSED_BY.get(name, PARAGRAPH)
        while stack[-1].name in closes:
            close(1)
        if name in RAW:
            ends = raw_ends.setdefault(name, re.compile(rf"</{name}[\s/>]", re.IGNORECASE))
            end = ends.search(page, at)
            if end is None:
                break  # raw text lasts to the end
            close_at = page.find(">", end.start())
            at = n if close_at < 0 else close_at + 1
            continue
        if marks.endswith("/") and name in ("svg", "math"):
            continue
        top = stack[-1]
        label = name
        if marks:
            kinds = [v.strip("\"'") for k, v in _MARK.findall(marks) if k.lower() == "class"]
            label = ".".join([name, *kinds])
        path = paths.setdefault((top.path, label), len(paths) + 1)
        home = top.home
        if name in CONTAINERS:
            homes += 1
            home = homes
        chrome = top.chrome or _is_chrome(name, marks, top.article)
        stack.append(_Element(name, path, home, chrome, top.article or name in ("article", "main")))
        names[name] += 1
    flush()
    return blocks


def _smooth(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    near = np.convolve(values, weights, "full")[reach : reach + len(values)]
    return near / np.convolve(np.ones(len(values)), weights, "full")[reach : reach + len(values)]


def path_ratios(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Fused, smoothed ratio of each block, and the number of its path from 0."""
    _, path = np.unique([b.path for b in blocks], return_inverse=True)
    sizes = np.bincount(path)
    chars = np.bincount(path, [len(b.text) for b in blocks]) / sizes
    marks = np.bincount(path, [len(_PUNCTUATION.findall(b.text)) for b in blocks]) / sizes
    return _smooth(chars[path]) * _smooth(marks[path]), path


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; empty if there is none."""
    blocks = read_blocks(page or "")
    if not blocks:
        return ""
    fused, path = path_ratios(blocks)
    means = np.bincount(path, fused) / np.bincount(path)
    chosen = means[path] >= min(fused.std(), means.max())
    content = [b for b, high in zip(blocks, chosen) if high and (b.article or not b.linked)]
    marked = [b for b in content if b.article]
    if 2 * sum(len(b.text) for b in marked) > sum(len(b.text) for b in content):
        content = marked
    homes = {b.home for b in content}
    return "\n\n".join(b.text for b in blocks if b.home in homes)


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in ``keep`` with ``text`` and ``n_chars``, its number of code points.

    A null or empty page, and one without any article, has an empty text.  Repeated rows
    give repeated results; columns not in ``keep`` are left out, so none can clash.  Long
    pages are read whole; time and memory grow with their length.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch[html].to_pylist()]
            columns = {name: batch[name] for name in keep}
            columns["text"] = pa.array(texts, pa.string())
            columns["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    source = pages.select(*keep, F.col(html))
    schema = source.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    with small_batches(pages.sparkSession):
        return source.mapInArrow(extract, schema)
