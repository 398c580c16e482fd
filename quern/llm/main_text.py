"""Main text of web pages by the distribution of line blocks.

Markup is stripped; every block element ends a line. The lengths of WINDOW lines in a row are summed along the page.
Where the sums rise above a threshold text begins (surge), where they fall to nothing it ends (dive), and the lines
between are the page's text. Elements that are never main text (menus, forms, scripts, ...), by tag or by the words of
class, id and role, leave a gap in the distribution; a line made of links has no length. Where a page marks its article
or main part, the sums run over the lines inside, with the same threshold; a surge there reaches back to the dive before
it, so short first lines stay.

A layout wrapper may be a form or bear the name of another part (has-sidebar). So a part that contains an article, or the
larger part of the page's unlinked text, is not left out; its lines weigh less and the sums decide.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.frames import slices

WINDOW = 3
THRESHOLD = 86
# Weight of lines in a part that is kept although it is a form or a name like has-sidebar, or a name like sidebar, says no.
WRAPPER, OTHER, LEAST = 1 / 2, 1 / 16, 2.0**-64

# Attributes as browsers read them: a quote sign opens a value only right after the equals sign.
VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+|(?=>)|\Z)"""
ATTRIBUTES = rf"""(?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{VALUE})?+|=)*+"""
TAG = re.compile(rf"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NEVER = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "object", "audio", "video", "canvas"}
MAIN = {"article", "main"}
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
OTHER_PARTS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside widget footer foot header masthead topbar comment comments disqus respond "
    "reply replies cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended pagination pager toolbar tags search skip complementary "
    "contentinfo disclaimer copyright".split()
)

NOT_ARTICLES = set("comment comments reply replies related recommended promo sponsored teaser".split())


def _other_part(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is never main text; ``inside``: it stands in an article or main part."""
    if name in NEVER or name == "header" and not inside:
        return True
    if name in ("body", "html") or not attributes:
        return False
    if HIDDEN.search(attributes):
        return True
    words = NOT_ARTICLES if name in MAIN else OTHER_PARTS
    values = (found[1] or found[2] or found[3] or "" for found in NAMES.finditer(attributes))
    return any(w.lower() in words for value in values for w in CAMEL.findall(value))


Tag = tuple[int, int, str, bool, str]
Line = tuple[str, int, bool, float]


def page_tags(html: str) -> list[Tag]:
    """(start, end, name, whether it closes, attributes) of every tag, comments without a name; an element of RAW is one."""
    tags, place = [], 0
    while (tag := TAG.search(html, place)) is not None:
        place, name = tag.end(), (tag[2] or "").lower()
        if name in RAW and not tag[1] and not tag[3].endswith("/"):
            found = re.compile(rf"</{name}\s*>?", re.I).search(html, place)
            place = found.end() if found else len(html)
        tags.append((tag.start(), place, name, bool(tag[1]), tag[3] or ""))
    return tags


class Outline:
    """Where the elements of a page end, and how much unlinked text and how many article or main parts they hold."""

    def __init__(self, html: str, tags: list[Tag]):
        n = len(tags)
        self.end, self.stop = [n] * n, [n] * (n + 1)
        opened: dict[str, list[int]] = {}
        for k, (_, _, name, closes, _) in enumerate(tags):
            if not closes:
                opened.setdefault(name, []).append(k)
            elif opened.get(name):
                self.end[opened[name].pop()] = k
        for k in range(n - 1, -1, -1):
            self.stop[k] = k if tags[k][3] and tags[k][2] in ("body", "html") else self.stop[k + 1]
        self.text, link, never = [len(html[: tags[0][0]].strip()) if tags else 0], 0, 0
        for k, (_, after, name, closes, _) in enumerate(tags):
            link = max(0, link + (-1 if closes else 1)) if name == "a" else link
            if not closes and name in NEVER and name != "form":
                never = max(never, min(self.end[k], self.stop[k]))
            until = tags[k + 1][0] if k + 1 < n else len(html)
            counts = until > after and not link and k >= never
            self.text.append(self.text[-1] + (len(html[after:until].strip()) if counts else 0))
        self.marks = [0]
        for k, (_, _, name, closes, attributes) in enumerate(tags):
            plain = name in MAIN and not closes and self.size(k, self.end[k]) and not _other_part(name, attributes, True)
            self.marks.append(self.marks[-1] + bool(plain))

    def size(self, start: int, end: int) -> int:
        return self.text[end] - self.text[start]

    def kept(self, start: int, end: int, tag: Tag) -> float:
        """Weight of a part that is like none of the main text: 0 where it can be left out."""
        if tag[2] in MAIN or tag[2] in NEVER and tag[2] != "form" or HIDDEN.search(tag[4]):
            return 0
        if self.marks[end] == self.marks[start] and 2 * self.size(start, end) <= self.text[-1]:
            return 0
        values = (found[1] or found[2] or found[3] or "" for found in NAMES.finditer(tag[4]))
        return OTHER if any(w.lower() in OTHER_PARTS for value in values for w in value.split()) else WRAPPER


def page_lines(html: str) -> tuple[list[Line], bool]:
    """((text, length outside links, inside the marked part, weight) of every line, whether a part with text is marked).

    A gap is WINDOW lines without text.
    """
    lines: list[Line] = []
    parts: list[tuple[str, bool]] = []
    mains: list[int] = []  # where the article and main parts around end, the first of them
    kept: list[tuple[int, float]] = []
    tags, link = page_tags(html), 0
    outline = Outline(html, tags)

    def flush() -> None:
        whole = " ".join(html_lib.unescape("".join(t for t, _ in parts)).split())
        if whole:
            linked = sum(len(t.strip()) for t, in_link in parts if in_link)
            lines.append((whole, 0 if 2 * linked > len(whole) else len(whole), bool(mains), kept[-1][1] if kept else 1.0))
        parts.clear()

    place = k = 0
    while k < len(tags):
        start, after, name, closes, attributes = tags[k]
        if start > place:
            parts.append((html[place:start], link > 0))
        place, k = after, k + 1
        if not name:
            continue
        if name not in INLINE:
            flush()
        while kept and kept[-1][0] < k:
            flush()
            kept.pop()
        if closes:
            if name in MAIN and mains:
                mains.pop()
            link -= name == "a" and link > 0
            continue
        if name == "br":
            parts.append((" ", False))
        if name in VOID or name in RAW or attributes.endswith("/") and name not in MAIN:
            continue
        if _other_part(name, attributes, bool(mains)):
            flush()
            own = outline.end[k - 1]
            # A part that is never closed ends with the article around it, or with the page.
            end = min(own, outline.stop[k - 1], mains[-1] if mains else len(tags))
            weight = outline.kept(k - 1, end, tags[k - 1])
            if weight:
                kept.append((min(end, kept[-1][0]) if kept else end, max(weight * (kept[-1][1] if kept else 1.0), LEAST)))
                continue
            place = tags[end][1 if end == own else 0] if end < len(tags) else len(html)
            k = end + (end == own)
            if not mains:
                lines.extend([("", 0, False, 1.0)] * WINDOW)
            continue
        if name in MAIN:
            mains.append(min(outline.end[k - 1], mains[-1] if mains else len(tags)))
        link += name == "a"
    if place < len(html):
        parts.append((html[place:], link > 0))
    flush()
    return lines, any(inside and text for text, _, inside, _ in lines)


def chosen(lengths: list[int], threshold: int, marked: bool) -> list[bool]:
    """Which lines stand between a surge and the next dive.

    In a marked part also those from the dive before the surge, without the links that end the dive; links that begin
    the part, like a linked title, stay.
    """
    upto = np.concatenate([[0], np.cumsum([*lengths, *[0] * WINDOW])])
    sums = upto[WINDOW:] - upto[:-WINDOW]
    kept, inside, start = [False] * len(lengths), False, 0
    for k, length in enumerate(lengths):
        if sums[k] == 0:
            inside, start = False, k + 1
        elif start == k > 0 and length == 0:
            start = k + 1
        elif not inside and sums[k] > threshold and length > 0:
            inside = True
            if marked:
                kept[start:k] = [True] * (k - start)
        kept[k] = inside
    return kept


def largest_sum(lengths: list[int]) -> int:
    upto = np.concatenate([[0], np.cumsum([*lengths, *[0] * WINDOW])])
    return int((upto[WINDOW:] - upto[:-WINDOW]).max())


def weighed(lines: list[Line]) -> list[float]:
    """Weights of lines against those that hold most of the text, 1 at most."""
    held: dict[float, float] = {}
    for _, length, _, weight in lines:
        held[weight] = held.get(weight, 0.0) + length * weight
    most = max(held, key=lambda w: (held[w], w))
    return [min(1.0, weight / most) for _, _, _, weight in lines]


def main_text(html: str) -> str:
    """The page's blocks of main text, joined by an empty line."""
    lines, marked = page_lines(html)
    if marked and not any(inside and weight == 1 for _, _, inside, weight in lines):
        # The only articles stand in parts of another name: they count if they outweigh the rest.
        marked = sum(n * w * (1 if inside else -1) for _, n, inside, w in lines) >= 0
    if marked:
        lines = [line for line in lines if line[2]]
    if not any(line[0] for line in lines):
        return ""
    lengths = [n for _, n, _, _ in lines]
    if not any(lengths):  # nothing but links
        lengths = [len(line[0]) for line in lines] if marked else lengths
    weights, gap = weighed(lines), [-1] * WINDOW
    # Lines of full weight in their order, then each stretch of lighter ones, set apart by gaps.
    order, light = [], []
    for k, weight in enumerate(weights):
        new = k == 0 or weight != weights[k - 1]
        if weight < 1:
            order += gap if new and not marked else []
            light += [*gap, k] if new else [k]
        else:
            order.append(k)
    order += light
    sums = [int(lengths[k] * weights[k]) if k >= 0 else 0 for k in order]
    told = chosen(sums, min(THRESHOLD, largest_sum(sums) - 1), marked)
    kept = sorted(k for k, stays in zip(order, told, strict=True) if stays and k >= 0)
    return "\n\n".join(lines[k][0] for k in kept if lines[k][0])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page.

    A null or empty page, and one without any text, gives an empty text. Pages are read whole, however long; null and
    repeated ids stay row by row; an empty table gives no rows; other columns are ignored. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), batch.column("url"), pa.array(texts, pa.string()), sizes], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
