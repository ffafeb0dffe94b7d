"""Main text of web pages by the distribution of text over lines.

Markup is stripped so that every block of text is one line and everything that is not running text
(menus, headers outside the article, footers, sidebars, notices, adverts, forms, comments) leaves
an empty line. Where articles are marked, those with a share of the largest one's text are kept, so a teaser beside them goes. On other
pages text lengths are summed over windows of WINDOW lines of text; the main stretch goes from the first window whose sum surges to a
share of the largest, to the last before the sums dive below it. All its lines are kept, however short, but for lines of links and a
copyright line at either end.

An element is no running text by its name, or by its class, id or role: by a whole word of it, or the first or last part of a hyphened
one. By class and the like nothing is dropped that holds an article or most of the page's text, and inside an article
a first part alone (related-work) counts only where links make up most of the element.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayspark.llm.common import fresh_name

WINDOW = 5
#: A window is dense, and an article kept, from one part in so many of the largest one's text.
DENSE = 8
#: A line of links has this share of its text in links.
LINKS = 0.8
# Element names of HTML.
DROPPED = frozenset("""script style noscript template head title svg math canvas iframe object select option textarea
    button nav aside footer form menu dialog audio video""".split())
RAW = frozenset(["script", "style", "textarea", "title"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small
    span strike strong sub sup time tt u var wbr img""".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo comment comments
    respond sidebar cookie cookies consent notice popup modal newsletter subscribe share social related breadcrumb
    breadcrumbs menu nav navbar navigation footer masthead pagination widget disqus""".split())
NOISE_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert".split())
MAIN = frozenset(["article", "main"])
_CELLS, _ROWS = ["td", "th"], ["tr", "tbody", "thead", "tfoot"]
#: Elements without need of an end tag, and the start tags that end them.
ENDED_BY = {
    "p": frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2
        h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd td th tr tbody thead tfoot""".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    **{k: frozenset(_CELLS + _ROWS) for k in _CELLS}, "tr": frozenset(_ROWS), **{k: frozenset(_ROWS[1:]) for k in _ROWS[1:]},
}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_MAIN_TAG = re.compile(r"<(?:article|main)\b", re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PARTS = re.compile(r"[-_]+")
_COPYRIGHT = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)", re.I)
#: First parts of class names that tell about the element, not what it is.
MODIFIERS = frozenset("has no with without is not hide show".split())
SURE, BY_NAME, BY_FIRST_PART = "sure", "name", "first part"


def _noise(name: str, attributes: str, depth_main: int) -> str:
    """Why the element is no running text: its name or that it is hidden (SURE), or its class, id or role; empty if it may be."""
    if name in DROPPED or name == "header" and not depth_main:
        return SURE
    if _hidden(attributes) and name not in ("html", "body"):
        return SURE
    if not attributes or name in ("html", "body") or name in MAIN and not depth_main:
        return ""
    found = ""
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if key.lower() == "role" and value in NOISE_ROLES:
            return BY_NAME
        if key.lower() not in ("class", "id"):
            continue
        for word in value.split():
            parts = _PARTS.split(word)
            if word in NOISE_WORDS or parts[-1] in NOISE_WORDS and parts[0] not in MODIFIERS:
                return BY_NAME
            if parts[0] in NOISE_WORDS:
                found = BY_FIRST_PART
    return found


def _extent(page: str, at: int, name: str) -> tuple[bool, int, int]:
    """Of the element whose start tag ends at ``at``: whether it holds an article, its text's length, and that in links."""
    depth, text, linked, links = 1, 0, 0, 0
    while depth:
        found = _TAG.search(page, at)
        size = len(page[at:found.start() if found else len(page)].strip())
        text, linked = text + size, linked + size * (links > 0)
        if not found:
            break
        at = found.end()
        tag, closing = (found[2] or "").lower(), bool(found[1])
        if tag in MAIN:
            return True, text, linked
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        if tag in RAW and not closing:
            at = _end_of_raw(page, at, tag)
        elif tag == name and not found[3].rstrip().endswith("/"):
            depth += -1 if closing else 1
    return False, text, linked


def _end_of_raw(page: str, at: int, name: str) -> int:
    ended = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return ended.end() if ended else len(page)


def _hidden(attributes: str) -> bool:
    return any(
        k.lower() == "hidden" or k.lower() == "aria-hidden" and "".join(v).lower() == "true"
        for k, *v in _ATTRIBUTE.findall(attributes or "")
    )


def _ends(dropping: str, nested: list[str], closing: bool, name: str) -> bool:
    """Whether a tag ends a dropped element without an end tag of its own; ``nested`` has the elements open in it, and is kept up."""
    if name in VOID and name not in ENDED_BY[dropping] or name in INLINE:
        return False
    if not closing:
        if name in ENDED_BY[dropping] and all(n in ENDED_BY for n in nested):
            return True
        nested.append(name)
    elif name in nested:
        while nested.pop() != name:
            pass
    else:
        return name != "p" and name not in VOID
    return False


def text_lines(page: str) -> tuple[list[str], list[int], list[float]]:
    """Blocks of text with empty lines where something was dropped, and for each the number of its outermost article on the
    page, 0 outside, and its share of text in links.
    """
    lines: list[str] = []
    inside: list[int] = []
    shares: list[float] = []
    held: list[str] = []
    linked = links = 0
    whole = -1
    open_main = dropped = article = 0
    dropping = ""
    nested: list[str] = []
    at, n = 0, len(page)

    def end_line(gap: bool = False) -> None:
        nonlocal linked
        size = sum(len(piece.strip()) for piece in held)
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append(text)
            inside.append(article if open_main else 0)
            shares.append(linked / max(size, 1))
        linked = 0
        if gap and lines and lines[-1]:
            lines.append("")
            inside.append(article if open_main else 0)
            shares.append(0.0)

    def is_noise(name: str, attributes: str, at: int) -> bool:
        nonlocal whole
        why = _noise(name, attributes, open_main)
        if why in ("", SURE) or name in VOID or name in ENDED_BY:
            return bool(why)
        holds, text, in_links = _extent(page, at, name)
        if why == BY_FIRST_PART and open_main and 2 * in_links < text:
            return False
        if whole < 0:
            whole = _extent(page, 0, "")[1] if not _MAIN_TAG.search(page) else 0
        return not (holds or whole and 2 * text > whole)

    while at < n:
        found = _TAG.search(page, at)
        if not dropped:
            piece = page[at:found.start() if found else n]
            held.append(piece)
            linked += len(piece.strip()) * (links > 0)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        closing, name = bool(found[1]), found[2].lower()
        if dropped and dropping in ENDED_BY and not (closing and name == dropping and name not in nested):
            if not _ends(dropping, nested, closing, name):
                continue
            dropped = 0
            end_line(gap=True)
        elif dropped:
            if name == dropping:
                dropped += -1 if closing else not found[3].rstrip().endswith("/") and name not in VOID
            if not dropped:
                end_line(gap=True)
            continue
        if not closing and is_noise(name, found[3], at):
            end_line(gap=True)
            if name in RAW:
                at = _end_of_raw(page, at, name)
            elif name not in VOID and not found[3].rstrip().endswith("/"):
                dropped, dropping = 1, name
                nested.clear()
            continue
        if name in MAIN:
            end_line(gap=True)
            article += not closing and not open_main
            open_main = max(0, open_main + (-1 if closing else 1))
        elif name not in INLINE:
            end_line()
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
    end_line()
    return lines, inside, shares


def main_text(page: str | None) -> str:
    """Blocks of the main text, joined by one space; empty if there is none."""
    lines, inside, shares = text_lines(page or "")
    if not any(lines):
        return ""
    if any(line and within for line, within in zip(lines, inside, strict=True)):
        sizes = np.bincount(inside, [len(line) for line in lines])
        sizes[0] = 0
        kept = sizes * DENSE >= sizes.max()
        return " ".join(line for line, within in zip(lines, inside, strict=True) if line and within and kept[within])
    shares = [share for line, share in zip(lines, shares, strict=True) if line]
    lines = [line for line in lines if line]
    width = min(WINDOW, len(lines))
    sums = np.convolve([len(line) for line in lines], np.ones(width, dtype=np.int64), "valid")
    dense = np.flatnonzero(sums * DENSE >= sums.max())
    first, last = int(dense[0]), int(dense[-1]) + width - 1
    while first < last and shares[first] >= LINKS:
        first += 1
    while first < last and (shares[last] >= LINKS or _COPYRIGHT.match(lines[last])):
        last -= 1
    return " ".join(lines[first:last + 1])


def extract_main_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """The rows with ``text`` and ``n_chars``, its code points; columns of these names are replaced.

    A null or empty page, and one without main text, gives an empty text. Pages cut off in the middle of a
    tag, an element or a reference give what stands before. No rows give no rows.
    """

    @F.pandas_udf("text string, n_chars long")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for found in batches:
            texts = [main_text(p) for p in found]
            yield pd.DataFrame({"text": texts, "n_chars": np.array([len(t) for t in texts], dtype=np.int64)})

    own = fresh_name(pages.columns, "_found")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*kept, extract(F.col(page)).alias(own)).select(
        *kept, F.col(f"{own}.text").alias("text"), F.col(f"{own}.n_chars").alias("n_chars")
    )
