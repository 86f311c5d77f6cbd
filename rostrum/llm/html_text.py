"""Main text of web pages by the line-block distribution of their text.

1. Markup is stripped: every block element begins a new line, so the page
   becomes lines in page order. Lines of scripts, styles, menus, headers,
   footers, sidebars, notices, adverts, forms and reader comments (by element,
   or by the words of class, id and role) keep their place but have length 0;
   so have lines outside ``article`` and ``main`` that are mostly links.
2. Where the page has an ``article`` or ``main`` that holds at least ``MARKED_SHARE``
   of the text that is left, its lines are the result; the distribution decides
   nothing there. A mark around less (a teaser, an empty frame) counts for nothing.
3. Elsewhere text lengths are summed over windows of ``window`` lines. A surge
   point is where the sum rises above ``SURGE`` characters, the dive point after it
   is where the sum falls to 0. All lines with a length from the first surge, or a
   main heading before it, to the last dive are kept, however far apart the parts
   are and whatever their sizes; on a page without a surge all lines are.

Character references are decoded, white space inside a line is one space.

Defined results: null, empty or text-free html gives an empty text of 0
characters; plain text without markup is one line; unclosed elements end with
the element around them, broken tags are text. Whole pages are read, nothing is
cut. Columns beside id, url and html aren't read; repeated rows, null ids and
empty tables pass through.
"""
from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame

from .common import arrow_schema, as_batches, rows_of

WINDOW = 3
SURGE = 40               # characters in a window
LINK_SHARE = 0.6

# Elements of HTML.
RAW = "script|style|noscript|template|textarea|iframe|svg|math|canvas|object|select|title|xmp"
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("head nav footer aside form button fieldset menu dialog audio video applet".split())
CLOSED_BY_BLOCK = set("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id that name something beside the article.
NAMES = set("""ad ads advert adverts advertisement advertising adbox adsense sponsor sponsored sponsorship promo promos
promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe
subscription signup login register paywall sidebar side rail related recommended recommendations recirc trending popular
share sharing social follow comments comment commentlist replies reply respond disqus discussion breadcrumb breadcrumbs
menu menus nav navbar navigation topnav subnav pagination pager footer header masthead topbar toolbar widget widgets
skip hidden outbrain taboola""".split())

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[!?][^>]*>""", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def is_aside(name: str, attributes: str, inside_main: bool) -> bool:
    """Does the element hold something beside the article?"""
    if name in DROPPED or name == "header" and not inside_main:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            if any(w.lower() in NAMES for w in WORDS.findall(value)):
                return True
        elif key == "role":
            if value.lower() in ROLES:
                return True
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def page_lines(page: str) -> tuple[list[tuple[str, bool, bool, int, bool]], bool]:
    """Lines in page order as (text, beside the article, in a marked article, characters in links, in h1); is one marked?"""
    lines: list[tuple[str, bool, bool, int, bool]] = []
    parts: list[str] = []
    links: list[str] = []
    stack: list[tuple[str, bool]] = []       # open elements: name, does it begin something beside the article
    aside = main = link = 0
    marked = False

    def end_line():
        nonlocal parts, links
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                heading = any(open_ == "h1" for open_, _ in stack[-8:])
                lines.append((text, aside > 0, main > 0, len(" ".join(html_lib.unescape("".join(links)).split())), heading))
            parts, links = [], []

    def pop():
        nonlocal aside, main, link
        name, beside = stack.pop()
        open_names[name] -= 1
        aside -= beside
        main -= name in ("article", "main")
        link -= name == "a"

    open_names: Counter = Counter()
    at = 0
    # behind the last ">" no tag can end: what looks like one there is text, unless a comment or script is still open
    tags_end = page.rfind(">") + 1
    for token in TOKEN.finditer(page, 0, tags_end):
        if token.start() > at:
            parts.append(page[at:token.start()])
            if link:
                links.append(parts[-1])
        at = token.end()
        if at == tags_end and _unclosed(token):
            at = len(page)
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        attributes = token["attrs"] or token["attrs2"] or ""
        if token["close"] or token["close2"]:
            if name not in INLINE:
                end_line()
            if open_names[name] > 0:
                # An inline end tag doesn't reach out of its block.
                if name in INLINE and not _open_in_block(stack, name):
                    continue
                while stack[-1][0] != name:
                    pop()
                pop()
            elif name == "p":
                end_line()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            end_line()
            while stack and stack[-1][0] in INLINE and _closes(stack, name):
                pop()
            if stack and stack[-1][0] in CLOSED_BY_BLOCK and (stack[-1][0] == "p" or stack[-1][0] == name):
                pop()
        if name in VOID or attributes.endswith("/"):
            continue
        if name == "body":           # an unclosed head ends here
            while stack and stack[-1][0] != "html":
                pop()
        beside = is_aside(name, attributes, main > 0)
        if beside and name in INLINE:
            beside = False if not attributes else beside
        if name in ("article", "main") and not aside:
            marked = True
        stack.append((name, beside))
        open_names[name] += 1
        aside += beside
        main += name in ("article", "main")
        link += name == "a"
    parts.append(page[at:].partition("<!--")[0])
    end_line()
    return lines, marked


def _unclosed(token: re.Match) -> bool:
    """Does a comment or an element of raw text go on to the end of the page?"""
    text = token[0]
    if token["raw"]:
        return not re.search(rf"</{token['raw']}\s*>\Z", text, re.I)
    return text.startswith("<!--") and (len(text) < 7 or not text.endswith("-->"))


def _open_in_block(stack: list, name: str) -> bool:
    for open_, _ in reversed(stack):
        if open_ == name:
            return True
        if open_ not in INLINE:
            return False
    return False


def _closes(stack: list, name: str) -> bool:
    """A new block ends inline elements that were left open in a paragraph."""
    for open_, _ in reversed(stack):
        if open_ not in INLINE:
            return open_ in CLOSED_BY_BLOCK
    return False


def surge_and_dive(lengths: list[int], window: int) -> tuple[int, int] | None:
    """The lines from the first window that surges to the dive behind the last one; None where none surges."""
    n = len(lengths)
    ends = [0, *accumulate(lengths)]
    sums = [ends[min(n, i + window)] - ends[i] for i in range(n)]
    surges = [i for i in range(n) if sums[i] > SURGE]
    if not surges:
        return None
    last = surges[-1]
    while last < n and sums[last] > 0:
        last += 1
    return surges[0], last


def main_text(page: str | None, window: int = WINDOW) -> str:
    """The lines between the first surge and the last dive, joined by line ends.

    On a page with a marked article only its lines weigh when the points are located, unless they never surge; an h1 before
    the first surge belongs to the text; a page without a surge is kept whole."""
    if not page:
        return ""
    lines, marked = page_lines(page)
    lengths = [0 if beside or not inside and links > LINK_SHARE * len(text) else len(text)
               for text, beside, inside, links, _ in lines]
    points = None
    if marked:
        points = surge_and_dive([n if line[2] else 0 for n, line in zip(lengths, lines, strict=True)], window)
    first, last = points or surge_and_dive(lengths, window) or (0, len(lengths))
    first = next((i for i in range(first) if lines[i][4] and lengths[i]), first)
    return "\n".join(lines[k][0] for k in range(first, last) if lengths[k])


def extract_pages(pages: DataFrame, window: int = WINDOW, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page: a map over rows, no shuffle."""
    types = {c: pages.schema[c].dataType.simpleString() for c in (id_col, url_col)}
    ddl = f"{id_col} {types[id_col]}, {url_col} {types[url_col]}, text string, n_chars long"
    schema = arrow_schema(ddl)

    def extract(batches):
        def results():
            for key, url, page in rows_of(batches, [id_col, url_col, html_col]):
                text = main_text(page, window)
                yield key, url, text, len(text)
        yield from as_batches(results(), schema, 500)

    return pages.select(id_col, url_col, html_col).mapInArrow(extract, ddl)
