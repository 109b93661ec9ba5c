"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of text.  Everything that
is no article text by its element (navigation, page headers and footers,
sidebars, forms, scripts, styles) leaves an empty line.  So does a part that
is none by its class, id or role (also notices, adverts, comments of readers),
unless it holds an article or most of the page's largest block: names are a
hint, and ``has-sidebar`` or ``no-comments`` are none.  Line i then has the length of its text outside
links, and block i the sum of lines i to i + ``WINDOW`` - 1.  A surge is the
point where that sum rises from nothing above the threshold, the next dive the
point where it is nothing again; lines between the two are kept.  A region
needs a block of ``MIN_BLOCK`` characters or, if no region has one, the page's
largest.  Around a kept region the rest of its container goes with it: of the
element that holds more than half of the region's text (not counting
paragraphs, sections, lists and the like, nor an element of one line unless
the page itself is next), everything from its first to its last line with text
outside links stays, so a list of links or an advert does not cut off a short
closing section.

A marked article (article, main) is evidence and no rule: its text counts
``MARKED_WEIGHT`` times, a region ends at its border, and an article with a
kept region is kept whole, with its link lists.  Text outside is kept or not by
its own block sums, and so is an article.  On a page with no text but links
those in articles count.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by a line feed; nothing else is dropped or cut.  The
whole html of a page is read by one small function in a narrow, Arrow-batched
step; nothing is shuffled.

Defined cases: html that is null or without text gives the empty string;
pages cut off in the middle, unclosed and stray tags are read like a browser
does (an open paragraph ends at the next block); repeated rows stay rows.
"""

import bisect
import html as html_lib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm import tables as T

WINDOW = 3
MIN_BLOCK = 80
#: A character in a marked article counts as this many.
MARKED_WEIGHT = 2

#: A block: text, characters outside links, article number; of a page also its box.
Line = tuple

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Fixed element and name lists of HTML practice.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "object", "audio", "video", "canvas",
       "math", "title", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html",
         "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
         "thead", "tr", "ul"}
DROP = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "head", "label", "fieldset"}
OUTSIDE_ONLY = {"header"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
#: Where a raw element ends: what stands before is no markup.
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
DROP_NAMES = {"nav", "navigation", "navbar", "menu", "sidebar", "aside", "ad", "ads", "advert", "adverts", "advertisement", "sponsor",
              "sponsored", "promo", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
              "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment",
              "comments", "reply", "replies", "respond", "disqus", "breadcrumb", "breadcrumbs", "pagination", "pager", "footer",
              "toolbar", "widget", "skip", "search", "complementary", "contentinfo", "dialog"}
OUTSIDE_NAMES = {"header", "masthead", "topbar"}
#: Elements whose lines belong together.
BOXES = {"div", "article", "main", "center", "td", "th"}
#: What follows these in a name says what the page has around the text or lacks.
ABOUT = {"has", "no", "with", "without"}
#: Elements inside a block; a block whose words all are in such with a name of the lists goes.
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}


def _names(attributes: str) -> set[str]:
    names: set[str] = set()
    if "=" in attributes:
        for m in _NAME.finditer(attributes):
            for name in (m[1] or m[2] or m[3] or "").split():
                for part in _PART.findall(name):
                    if part.lower() in ABOUT:
                        break
                    names.add(part.lower())
    return names


def _weights(lines: list[Line]) -> list[int]:
    weight = [MARKED_WEIGHT * line[1] if line[2] else line[1] for line in lines]
    return weight if any(weight) else [len(line[0]) if line[2] else 0 for line in lines]


def _drop_named(lines: list[Line], boxes: list[list[int]], named: list[list[int]]) -> list[Line]:
    """The lines (boxes are moved along) with one empty line for each named part (first line, end, holds
    an article) that holds neither an article nor most of the largest block;
    beside article text that block needs ``MIN_BLOCK`` and two lines of the part."""
    if not named:
        return lines
    total = [0]
    for n in _weights(lines):
        total.append(total[-1] + n)
    ends = [min(len(lines), i + WINDOW) for i in range(len(lines))]
    at = max(range(len(lines)), key=lambda i: total[ends[i]] - total[i], default=0)
    most = total[ends[at]] - total[at] if lines else 0
    end, article = 0, False
    for a, b, _ in [*named, (len(lines), len(lines), 0)]:
        article = article or any(line[2] and line[1] for line in lines[end:a])
        end = max(end, b)
    out, done, place = [], 0, list(range(len(lines) + 1))
    for a, b, holds in named:  # by first line, outer parts first
        if a < done or holds:
            continue
        low, high = max(a, at), min(b, ends[at]) if lines else 0
        if low < high and 2 * (total[high] - total[low]) > most and not (
                article and (most < MIN_BLOCK or sum(line[1] > 0 for line in lines[low:high]) < 2)):
            continue
        for i in range(done, a):
            place[i] = len(out) + i - done
        out += lines[done:a]
        place[a:b] = [len(out)] * (b - a)
        out.append(("", 0, 0, lines[a][3] if a < b else 0))
        done = b
    for i in range(done, len(lines) + 1):
        place[i] = len(out) + i - done
    for box in boxes:
        box[0], box[1] = place[box[0]], place[box[1]]
    return out + lines[done:]


def lines_of(page: str) -> tuple[list[Line], list[list[int]]]:
    """(text, characters outside links, number of the outermost marked article
    or 0, place of the innermost box) of each block in page order, where a
    dropped part gives one empty line; (first line, end, place of the outer
    box) of each box, the page first."""
    lines: list[Line] = []
    boxes = [[0, 0, 0]]
    box = 0
    stack: list[tuple[str, bool, bool, int, int, bool]] = []  # element, dropped, article, place in named and in boxes or -1, aside
    places: dict[str, list[int]] = {}  # element: its places in the stack
    named: list[list[int]] = []
    open_parts: list[int] = []
    text: list[tuple[str, bool, bool]] = []  # piece, in a link, in an inline element with a listed name
    drop = article = links = articles = asides = 0

    def flush() -> None:
        if text:
            whole = " ".join(html_lib.unescape("".join(t for t, _, _ in text)).split())
            if any(aside for _, _, aside in text) and not any(
                    c.isalnum() for t, _, aside in text if not aside for c in html_lib.unescape(t)):
                whole = ""
                lines.append(("", 0, articles if article else 0, box))
            plain = " ".join(html_lib.unescape("".join(t for t, link, _ in text if not link)).split())
            text.clear()
            if whole:
                lines.append((whole, len(plain), articles if article else 0, box))

    def last(*names: str) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def pop() -> None:
        nonlocal drop, article, links, box, asides
        name, dropped, marked, part, own, aside = stack[-1]
        if name in BLOCK or part >= 0:
            flush()
        stack.pop()
        places[name].pop()
        if part >= 0:
            named[part][1] = len(lines)
            open_parts.pop()
        if own >= 0:
            boxes[own][1], box = len(lines), boxes[own][2]
        drop -= dropped
        article -= marked
        asides -= aside
        links -= name == "a"
        if dropped and not drop:
            lines.append(("", 0, articles if article else 0, box))

    def pop_to(place: int) -> None:
        while len(stack) > place:
            pop()

    at = 0
    while m := _TOKEN.search(page, at):
        name = (m[2] or "").lower()
        if m.start() > at and not drop:
            text.append((page[at:m.start()], links > 0, asides > 0))
        at = m.end()
        if not name:
            continue
        if m[1]:
            if places.get(name):
                pop_to(places[name][-1])
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            if not m[3].endswith("/"):
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
            continue
        if name == "br" or name == "wbr":
            text.append((" " if name == "br" else "", False, asides > 0))
            continue
        if name in BLOCK:
            flush()
            if places.get("p") and name not in ("html", "body"):
                pop_to(places["p"][-1])
        ends = CLOSES.get(name)
        if ends:
            k = last(*ends)
            if k > last("ul", "ol", "dl", "table", "menu", "select"):
                pop_to(k)
        if name in VOID or m[3].endswith("/"):
            continue
        names = _names(m[3])
        exempt = name in ("html", "body", "article", "main")
        hint = not exempt and bool(names & DROP_NAMES or not article and names & OUTSIDE_NAMES)
        marked = (name in ("article", "main") or "main" in names and "role" in m[3].lower()) and not names & DROP_NAMES
        dropped = name in DROP or not article and name in OUTSIDE_ONLY
        aside = hint and name in INLINE
        part = -1
        if hint and not aside and not dropped and not drop:
            flush()
            part = len(named)
            named.append([len(lines), 0, 0])
            open_parts.append(part)
        if marked and not dropped and not drop:
            for k in reversed(open_parts):
                if named[k][2]:
                    break
                named[k][2] = 1
        own = -1
        if name in BOXES and not dropped and not drop:
            flush()
            own = len(boxes)
            boxes.append([len(lines), 0, box])
            box = own
        places.setdefault(name, []).append(len(stack))
        stack.append((name, dropped, marked and not dropped, part, own, aside))
        drop += dropped
        asides += aside
        articles += marked and not dropped and not article
        article += marked and not dropped
        links += name == "a"
    if not drop and at < len(page):
        text.append((page[at:], links > 0, asides > 0))
    pop_to(0)
    flush()
    boxes[0][1] = len(lines)
    return _drop_named(lines, boxes, named), boxes


def _container(a: int, b: int, total: list[int], text: list[int], lines: list[Line], boxes: list[list[int]]) -> int:
    """The place of the box that lines a to b belong to; total and text are
    running sums of weights and of lines with text."""
    middle = bisect.bisect_right(total, (total[a] + total[b]) / 2, a, b) - 1
    at = lines[middle][3]
    while at:
        low, high, outer = boxes[at]
        if (2 * (total[min(b, high)] - total[max(a, low)]) > total[b] - total[a]
                and (text[high] - text[low] > 1 or not outer)):
            break
        at = outer
    return at


def main_lines(lines: list[Line], boxes: list[list[int]] | None = None) -> list[str]:
    """The kept lines by surge and dive of the block sums, joined inside boxes."""
    weight = _weights(lines)
    total = [0]
    for n in weight:
        total.append(total[-1] + n)
    regions, start, last = [], 0, -1  # last: the newest line with weight
    for i, n in enumerate(weight):
        if n:
            if last >= 0 and (i - last > WINDOW or bool(lines[i][2]) != bool(lines[last][2])):
                regions.append((start, last + 1))
                last = -1
            start, last = i if last < 0 else start, i
    if last < 0:
        return []
    regions.append((start, last + 1))
    peak = [max(total[min(b, i + WINDOW)] - total[i] for i in range(a, b)) for a, b in regions]
    threshold = min(MIN_BLOCK, max(peak))
    regions = [r for r, n in zip(regions, peak) if n >= threshold]
    articles = {lines[i][2] for a, b in regions for i in range(a, b) if lines[i][2]}
    keep = bytearray(len(lines))
    for a, b in regions:
        keep[a:b] = b"\1" * (b - a)
    if boxes:
        text = [0]
        for line in lines:
            text.append(text[-1] + bool(line[0]))
        weighted = [i for i, n in enumerate(weight) if n]
        for low, high, _ in (boxes[k] for k in {_container(a, b, total, text, lines, boxes) for a, b in regions}):
            first, end = bisect.bisect_left(weighted, low), bisect.bisect_left(weighted, high)
            if first < end:
                a, b = weighted[first], weighted[end - 1] + 1
                keep[a:b] = b"\1" * (b - a)
    return [line[0] for i, line in enumerate(lines) if line[0] and (keep[i] or line[2] in articles)]


def main_text(page: str | None) -> str:
    return "\n".join(main_lines(*lines_of(page))) if page else ""


def extractor():
    """A column function: html to main text."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p) for p in batch.to_pylist()], pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                     extractor()(F.col(f"`{html_col}`").cast("string")).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
