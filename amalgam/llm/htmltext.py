"""Main text of web pages by the line-block distribution.

Markup is stripped to lines: the text of each block element, its references
decoded and its white space turned into single spaces. Every line has a
length: its characters less those in links; 0 in menus, headers, footers,
sidebars, notices, adverts, forms and reader comments. In a page that marks its
article, a line inside counts ``SURGE`` more and with its links, one outside
``OUTSIDE`` less. The lengths are summed over sliding windows of lines. Where a
sum rises from nothing a stretch starts, where it dives to nothing it ends; of
the stretches the text is kept from the first to the last whose sums surge
above ``SURGE``, those between included however short. If none surges all are.

Pages are read in time linear in their length. Defined results: a null or empty
page, or one without main text, gives an empty text; unclosed elements end with
their parent, and one without any end tag that would hide its content hides
nothing, but for code (script, style and the like); a quote opens a value only
after =; a < that begins no tag is text; a page is read whole; repeated rows
give equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amalgam.llm.common import map_arrow

WINDOW = 3
#: Characters in a window that mark a surge.
SURGE = 86
#: Characters that a line outside the article loses in a page that marks it.
OUTSIDE = 400

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PART = re.compile(r"""[^=>]*(?:(>)|=\s*(?:"[^"]*"|'[^']*')?)""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_ROLE_MAIN = re.compile(r"role\s*=\s*[\"']?main\b", re.I)

# Element names and the words of classes, ids and roles.
_RAW = set("script style textarea title iframe noembed noframes xmp".split())
_HIDDEN = set("noscript template svg math select option optgroup datalist button object canvas audio video head".split())
_HIDDEN_IN_LINE = set("svg math select option optgroup button".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split()
)
_VOID = set("img input wbr".split())
_BOILER = set("nav footer aside form menu dialog".split())
_NESTS = set("nav footer aside form menu dialog header article main section div ul ol dl table tr td th tbody thead figure fieldset body html details center".split())
_MAIN = set("article main".split())
_COMMENTS = set("comment comments commentlist reply replies respond disqus".split())
_BOILER_WORDS = _COMMENTS | set(
    """ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
    sidebar menu nav navbar navigation navi breadcrumb breadcrumbs footer share sharing social related recommended subscribe newsletter popup modal
    overlay widget toolbar pagination pager login signup search contentinfo complementary alert dialog alertdialog""".split()
)
_HEADER_WORDS = set("header masthead topbar".split())
# Words that may stand beside those in one name: a "comment-list" holds comments, a "comment-on-law" does not.
_BESIDE = set(
    """a area bar block body bottom box button buttons container content desktop fixed form global group header holder icons inner js left line link links list main
    mobile module outer page panel popup post posts primary region right row secondary section site slot sticky stories story text thread title top unit user users
    wrap wrapper zone""".split()
)


def _named(value: str, words: set[str]) -> bool:
    """Whether a name of an attribute's value consists of ``words`` and of what may stand beside them."""
    for name in value.split():
        parts = {x.lower() for x in _WORD.findall(name) if not x.isdigit()}
        if parts & words and parts <= words | _BESIDE | _BOILER_WORDS:
            return True
    return False


def _is_boiler(name: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """(whether an element holds no main text, whether it holds reader comments)."""
    boiler, comments = name in _BOILER or (name == "header" and not in_main), False
    if attributes:
        for key, value in _ATTR.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id", "role"):
                comments |= _named(value, _COMMENTS)
                boiler |= _named(value, _BOILER_WORDS) or (not in_main and _named(value, _HEADER_WORDS))
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and "display:none" in value.lower().replace(" ", "")):
                boiler = True
    return boiler, comments


class _Lines:
    """The lines of a page: text, whether inside the article, whether boilerplate, characters in links."""

    def __init__(self):
        self.rows: list[tuple[str, bool, bool, int]] = []
        self.parts: list[str] = []
        self.linked = 0

    def flush(self, in_main: bool, boiler: bool) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.rows.append((text, in_main, boiler, self.linked))
            self.parts, self.linked = [], 0


class _Stack:
    """The open elements: (name, boilerplate, comments, main, hidden), and how many there are of each kind."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.of_name: dict[str, int] = {}
        self.boiler = self.comments = self.main = self.hidden = 0

    def push(self, name: str, boiler: bool, comments: bool, main: bool, hidden: bool) -> None:
        self._count((name, boiler, comments, main, hidden), 1)
        self.rows.append((name, boiler, comments, main, hidden))

    def close(self, name: str) -> None:
        """Close the innermost element of that name and all inside it, if there is one."""
        if self.of_name.get(name):
            while True:
                row = self.rows.pop()
                self._count(row, -1)
                if row[0] == name:
                    break

    def free(self) -> None:
        """An article is in no menu: those around it were left open."""
        self.rows = [(x[0], False, *x[2:]) for x in self.rows]
        self.boiler = 0

    def _count(self, row: tuple, by: int) -> None:
        self.of_name[row[0]] = self.of_name.get(row[0], 0) + by
        self.boiler += by * row[1]
        self.comments += by * row[2]
        self.main += by * row[3]
        self.hidden += by * row[4]


class _Ends:
    """Where the next end tag of a name is; the page is searched once for each."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def after(self, name: str, at: int) -> int | None:
        """The place behind the next end tag of ``name`` from ``at`` on."""
        if name in self.known and (self.known[name] is None or self.known[name].start() >= at):
            found = self.known[name]
        else:
            found = self.known[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(self.page, at)
        return found and found.end()


def _markup(page: str):
    """(text before, name, whether an end tag, attributes, place of the tag, end tags) of every tag, then the text that is left; name is empty for comments."""
    text_from = at = 0
    end = len(page)
    ends = _Ends(page)
    last = page.rfind(">")
    while (start := page.find("<", at)) >= 0:
        sign = page[start + 1 : start + 2]
        if sign in ("!", "?"):
            mark, skip = ("-->", 2) if page.startswith("<!--", start) else ("]]>", 9) if page.startswith("<![CDATA[", start) else (">", 2)
            over = page.find(mark, start + skip)
            yield page[text_from:start], "", False, "", start, ends
            text_from = at = end if over < 0 else over + len(mark)
            continue
        closes = sign == "/"
        named = _NAME.match(page, start + 1 + closes)
        if not named or start > last:
            at = start + 1
            continue
        at = named.end()
        while (part := _PART.match(page, at)) and not part[1]:
            at = part.end()
        if not part:  # no > is left
            at = start + 1
            last = start
            continue
        name, attributes = named[0].lower(), page[named.end() : part.end() - 1]
        text, at = page[text_from:start], part.end()
        if not closes and name in _RAW:
            at = ends.after(name, at) or end
        text_from = at
        yield text, name, closes, attributes, start, ends
    yield page[text_from:], "", False, "", end, ends


def lines_of(page: str) -> list[tuple[str, bool, bool, int]]:
    """(text, in article, boilerplate, characters in links) of every line, in page order."""
    out, stack = _Lines(), _Stack()
    in_link = seen_main = False
    line_boiler = False  # of the paragraph or heading that is open
    skipped, depth = "", 0  # an inline advert or notice, and how often its name is open inside it
    for text, name, closes, attributes, at, ends in _markup(page):
        if text and not skipped and not stack.hidden:
            text = html.unescape(text)
            out.parts.append(text)
            if in_link:
                out.linked += len(text)
        if not name:
            continue
        if name == "a":
            in_link = not closes
        if name in _INLINE:
            if name == skipped:
                depth += -1 if closes else 1
                skipped = skipped if depth else ""
            elif not closes and not skipped and name not in _VOID and attributes.strip() and _is_boiler(name, attributes, bool(stack.main))[0]:
                skipped, depth = name, 1
            continue
        if stack.rows and stack.rows[-1][0] == "option" and not closes:
            stack.close("option")  # has an end tag seldom
        if name in _HIDDEN:
            if name not in _HIDDEN_IN_LINE:
                out.flush(bool(stack.main), bool(stack.boiler) or line_boiler)
            if closes:
                stack.close(name)
            elif not attributes.endswith("/") and (name == "option" or ends.after(name, at) is not None):
                stack.push(name, False, False, False, True)
            continue
        out.flush(bool(stack.main), bool(stack.boiler) or line_boiler)
        skipped, depth = "", 0
        if name == "body":
            stack.close("head")
        if name not in ("br", "hr"):
            line_boiler = False
        if name not in _NESTS:
            line_boiler |= not closes and bool(attributes.strip()) and _is_boiler(name, attributes, bool(stack.main))[0]
        elif closes:
            stack.close(name)
        elif not attributes.rstrip().endswith("/"):
            own, comments = _is_boiler(name, attributes, bool(stack.main))
            is_main = (name in _MAIN or bool(_ROLE_MAIN.search(attributes))) and not own and not stack.comments
            if is_main and not seen_main:
                stack.free()
                seen_main = True
            stack.push(name, own, comments, is_main, False)
    out.flush(bool(stack.main), bool(stack.boiler) or line_boiler)
    return out.rows


def stretches(lengths: list[int], window: int = WINDOW, surge: int = 0) -> list[tuple[int, int]]:
    """(from, to) of the lines between a rise from nothing and the next dive, from the first to the last that surges above ``surge``."""
    n, out, tops = len(lengths), [], []
    sums = [sum(lengths[i : i + window]) for i in range(n)]
    i = 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        first = next(j for j in range(i, n) if lengths[j])
        last = i
        while last < n and sums[last]:
            last += 1
        out.append((first, max(j for j in range(first, last) if lengths[j]) + 1))
        tops.append(max(sums[i:last]))
        i = last
    surging = [k for k, top in enumerate(tops) if top > surge]
    return out[surging[0] : surging[-1] + 1] if surging else out


def lengths_of(lines: list[tuple[str, bool, bool, int]], surge: int = SURGE, outside: int = OUTSIDE) -> list[int]:
    """The lengths of lines (text, in article, boilerplate, characters in links)."""
    marked = any(main and not boiler for _, main, boiler, _ in lines)

    def length(text: str, main: bool, boiler: bool, linked: int) -> int:
        if boiler:
            return 0
        if main:
            return len(text) + surge
        return max(0, len(text) - linked - (outside if marked else 0))

    return [length(*line) for line in lines]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of one page."""
    lines = lines_of(page or "")
    lengths = lengths_of(lines, surge)
    marked = any(main and not boiler for _, main, boiler, _ in lines)
    keep = stretches(lengths, window, surge)
    return " ".join(lines[i][0] for a, b in keep for i in range(a, b) if lengths[i] or not (lines[i][2] or marked))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """(id, url, text): the main text of every page; ``url`` is null where the table has none."""

    def batch(part: pa.RecordBatch) -> dict:
        texts = [main_text(x, window, surge) for x in part.column(2).to_pylist()]
        return {"id": part.column(0), "url": part.column(1), "text": pa.array(texts, pa.string())}

    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"), F.col(html_col).alias("html"))
    return map_arrow(rows, batch, "id long, url string, text string", by="html")
