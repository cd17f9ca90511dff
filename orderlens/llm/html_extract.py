"""Main text of web pages by two-pass block rules (operator 7).

Method. A page is cut into blocks at block-level tags. Pass one decides blocks
by stop-word density, length and link density, and by what encloses them
(navigation, footer, sidebar, advert, comments, ...); short blocks without
evidence stay open. Pass two gives an open block the label of the nearest
decided neighbours: of both if they agree, else of the nearer one (at equal
distance main text wins); with no decided neighbour it is main text. On a page
with an article element only its inside can be main text.

Marks (words of class, id and role names) are evidence, not proof: names like
``with-sidebar`` mark nothing, and where the marks would leave no text that is
evidently prose, those around most of it are set aside (comments stay out).

Scale. One pass over the pages without a shuffle. A page is read forward once by
a tokenizer with explicit states; whatever is in it, the time is linear.

Results in odd cases. Null, empty or text-free html gives the empty text. A tag
ends at ``>`` or before the next ``<`` outside quotes; from the first quote that
never closes on, quotes say nothing. Unclosed tags end with their container; an
unclosed script, style, title or textarea runs to the end of the page, other
hidden elements hide nothing then (a head ends at the body). A ``<`` that starts no
tag is text. Repeated rows repeat; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Elements of HTML by role.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
HIDDEN = frozenset("head noscript template svg object select math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINER = frozenset("article aside blockquote body center details dialog dir div dl fieldset figure footer form header main menu nav ol section table ul".split())
ASIDE = frozenset("aside dialog footer form menu nav".split())
# Words of class, id and role names that mark what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline-share comment comments complementary consent contentinfo "
    "cookie cookies copyright dialog disqus donate footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification outbrain overlay pager pagination paywall popup promo promoted promotion related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget".split()
)
# Marks that no amount of text outvotes, and words before a mark that say the element only has one.
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
HAS = frozenset("with without has no show hide is not".split())
# Frequent function words of some languages.
STOP = frozenset(
    (
        "the of and to a in is it that for was on are as with be by at this from or an have not but they his her which you we were been has had "
        "their will would there what all if can more when who so no out up its about into than them then "
        "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
        "einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis "
        "le la les de des du un une et à en que qui dans pour pas au sur ne se ce il par sont avec plus son est sa aux ses mais on ou nous vous "
        "comme été cette leur elle tout "
        "el los las del y que en un una por con no para su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre es "
        "también me hasta hay donde"
    ).split()
)
SHORT, LONG = 70, 200
STOP_DENSITY, LINK_DENSITY = 0.2, 0.5

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
_QUOTED_STOP, _PLAIN_STOP = re.compile(r"[<>]|=\s*([\"'])"), re.compile(r"[<>]")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[_-]+|(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")


def marks_of(attrs: str) -> set[str]:
    """The marks in the class, id and role of an element; a name that says the element has such a thing marks nothing."""
    found: set[str] = set()
    for m in _NAMES.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = [x.lower() for x in _PART.split(name) if x]
            if not HAS.intersection(parts):
                found.update(MARKS.intersection(parts))
    return found


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes) of what a page holds, in order: "text", "start" and "end" of an element (lower-case name)."""
    at, size, quotes = 0, len(page), True
    last_end: dict[str, int] = {}

    def last(pattern: str) -> int:
        """Where a pattern occurs last; looked up once a page."""
        if pattern not in last_end:
            last_end[pattern] = max((x.start() for x in re.finditer(pattern + r"(?![a-zA-Z0-9:-])", page, re.I)), default=-1)
        return last_end[pattern]

    def tag_end(start: int) -> int:
        """Where the tag whose name ends at ``start`` ends: at its ">", or at the next "<"; -1 at the end of the page."""
        while True:
            m = (_QUOTED_STOP if quotes else _PLAIN_STOP).search(page, start)
            if m is None:
                return -1
            if m[0] in "<>":
                return m.start()
            close = page.find(m[1], m.end())
            if close < 0:
                return -1
            start = close + 1

    def after(tag: str, start: int) -> int:
        """The place of the next end tag of a raw element; the end of the page without one."""
        m = re.compile(rf"</{re.escape(tag)}(?![a-zA-Z0-9:-])", re.I).search(page, start)
        return m.start() if m else size

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        following = page[lt + 1 : lt + 2]
        if following in ("!", "?"):
            comment = page.startswith("<!--", lt)
            close = page.find("-->" if comment else ">", lt + (4 if comment else 2))
            at = size if close < 0 else close + (3 if comment else 1)
            continue
        end = following == "/"
        m = _NAME.match(page, lt + 1 + end)
        if m is None:
            yield "text", "<", ""
            at = lt + 1
            continue
        stop = tag_end(m.end())
        if stop < 0 and quotes:  # a quote or the tag never closes: from here on quotes say nothing
            quotes = False
            stop = tag_end(m.end())
        if stop < 0:
            yield "text", page[lt:], ""
            return
        at = stop + (page[stop] == ">")
        tag = m[0].lower()
        yield "end" if end else "start", tag, page[m.end() : stop]
        if end:
            continue
        closed_itself = page[stop - 1] == "/"
        if tag in RAW and not (closed_itself and tag == "iframe"):
            at = after(tag, at)
        elif tag in HIDDEN and not closed_itself:
            if last(f"</{tag}") > at:
                at = after(tag, at)
            elif tag == "head" and last("<body") > at:
                at = re.compile(r"<body(?![a-zA-Z0-9:-])", re.I).search(page, at).start()


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters inside links, aside, in an article) of each block with text, in page order."""
    found: list[tuple[str, int, bool, bool, int]] = []
    stack: list[tuple[str, bool, int]] = []
    opened: dict[str, int] = {}
    marks: list[tuple[int, bool]] = []  # (enclosing mark, comments) of each marked container
    text: list[str] = []
    linked, in_link, aside, article, mark = 0, 0, 0, 0, -1

    def flush() -> None:
        nonlocal linked
        if text:
            s = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
            if s:
                found.append((s, linked, aside > 0, article > 0, mark))
        text.clear()
        linked = 0

    def pop() -> None:
        nonlocal aside, article, mark
        tag, off, own = stack.pop()
        opened[tag] -= 1
        aside -= off
        article -= tag in ("article", "main")
        mark = marks[own][0] if own >= 0 else mark

    for kind, tag, attrs in tokens(page):
        if kind == "text":
            text.append(tag)
            if in_link:
                linked += len(tag)
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            in_link = kind == "start"
        if tag not in BLOCK:
            continue
        flush()
        if tag not in CONTAINER:
            continue
        in_link = 0
        if kind == "start":
            off = tag in ASIDE or (tag == "header" and not article)
            own = -1
            # a mark on the body or the article itself says nothing about its text
            words = marks_of(attrs) if tag not in ("article", "main", "body") else ()
            if words:
                own = len(marks)
                marks.append((mark, not COMMENTS.isdisjoint(words)))
                mark = own
            stack.append((tag, off, own))
            opened[tag] = opened.get(tag, 0) + 1
            aside += off
            article += tag in ("article", "main")
        elif opened.get(tag):
            while stack[-1][0] != tag:
                pop()
            pop()
    flush()
    out = _outvoted(found, marks)
    return [(s, links, off or (m >= 0 and out[m]), art) for s, links, off, art, m in found]


def stop_density(s: str) -> float:
    words = _WORD.findall(s.lower())
    return sum(w in STOP for w in words) / max(1, len(words))


def _outvoted(found: list[tuple[str, int, bool, bool, int]], marks: list[tuple[int, bool]]) -> list[bool]:
    """For each marked container whether it is out of the main text.

    It is, as are those inside it, unless all evident prose of the page is inside
    marks: then the innermost mark around half of that prose and the marks around
    it are set aside, unless one of them marks comments.
    """
    void = [False] * len(marks)
    if marks:
        prose = [0] * len(marks)
        plain = False
        for s, linked, off, _, m in found:
            if off or len(s) < SHORT or linked > LINK_DENSITY * len(s) or (m < 0 and plain) or stop_density(s) < STOP_DENSITY:
                continue
            plain = plain or m < 0
            if m >= 0:
                prose[m] += len(s)
        if not plain:
            for k in range(len(marks) - 1, -1, -1):
                if marks[k][0] >= 0:
                    prose[marks[k][0]] += prose[k]
            whole = sum(prose[k] for k in range(len(marks)) if marks[k][0] < 0)
            most = [k for k in range(len(marks)) if 2 * prose[k] > whole]
            if most:
                path, k = [], most[-1]
                while k >= 0:
                    path.append(k)
                    k = marks[k][0]
                if not any(marks[k][1] for k in path):
                    for k in path:
                        void[k] = True
    out = []
    for k, (up, _) in enumerate(marks):
        out.append(not void[k] or (up >= 0 and out[up]))
    return out


def decide(found: list[tuple[str, int, bool, bool]]) -> list[bool]:
    """Which blocks are main text."""
    inside = any(article and not aside for _, _, aside, article in found)
    labels: list[bool | None] = []
    for s, linked, aside, article in found:
        density = linked / len(s)
        if aside or (inside and not article):
            labels.append(False)
        elif density > LINK_DENSITY:
            labels.append(False if len(s) > SHORT or not article else None)
        elif len(s) < SHORT:
            labels.append(False if not article and ("©" in s or density > 0) else None)
        else:
            labels.append(True if stop_density(s) >= STOP_DENSITY or len(s) >= LONG or article else None)
    # the decided neighbours that count: the page's frame says nothing about the text beside it
    n = len(labels)
    counts = [labels[i] is not None and not found[i][2] and (found[i][3] or not inside) for i in range(n)]
    before, after = [-1] * n, [n] * n
    last = -1
    for i in range(n):
        before[i] = last
        last = i if counts[i] else last
    last = n
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if counts[i] else last
    out = []
    for i, label in enumerate(labels):
        if label is None:
            a, b = before[i], after[i]
            if a < 0 and b >= n:
                label = True
            elif a < 0 or b >= n:
                label = labels[b if a < 0 else a]
            elif i - a == b - i:
                label = labels[a] or labels[b]
            else:
                label = labels[a if i - a < b - i else b]
        out.append(bool(label))
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return " ".join(b[0] for b, good in zip(found, decide(found), strict=True) if good)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    fields = [pages.schema[c] for c in (id_col, url_col)]
    schema = StructType([*fields, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x.as_py()) for x in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names,
                )

    return pages.select(id_col, url_col, html_col).mapInArrow(run, schema)
