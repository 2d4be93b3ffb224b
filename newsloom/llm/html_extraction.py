"""Main text of raw pages by the distribution of text over line blocks.

A page is cut into lines, one for each block element (paragraph, heading, list item, table cell, ...). Markup is stripped,
and what stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments leaves
blank lines. The weight of a line is its text outside of links. The weights of `WINDOW` lines from each line on are summed up.
Where this sum surges above a threshold, text begins, back to where the sum was last 0; where it dives to 0, the text ends.
All lines between a surge and its dive are kept, short ones and lines of links included.

On a page that marks its article (`article`, `main` or the like) only marked lines have a weight, and any sum above 0 is a
surge, so that an article of one short line is found, too. Without marks the threshold is `SURGE` characters, or what
the page's best window holds if that is less, so that a few words beside the text are not taken for it.

Elements end as browsers have it: at their own end tag, at that of an element around them, or where the next paragraph, list
item or table cell begins. `br` is white space within its block. A header inside an article belongs to it. A header, a form, or
an element that only its class or id gives away stays if it holds the marked article.

Null and empty pages give an empty text, as do pages without any text. Every row is judged by itself, so repeated rows give
equal texts, and an empty table gives none. Pages of any length are read whole; the reading time is linear in the length. Input
columns are kept, but for those named `text` and `n_chars`, which the results replace.
"""

from __future__ import annotations

import html as html_std
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines whose weights are summed up, and the sum that is text on a page without marks.
WINDOW = 3
SURGE = 86

# Elements by their role in a page, and words in classes and ids that give a role away.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split())
RAW_TEXT = "script style title textarea iframe noembed noframes noscript xmp template svg select".split()
NEVER_TEXT = frozenset("head button object canvas audio video map datalist progress meter math".split())
BESIDE_TEXT = frozenset("nav footer aside menu dialog search".split())
ROLES = {
    "navigation": "beside", "contentinfo": "beside", "complementary": "beside", "search": "beside", "dialog": "beside",
    "alertdialog": "beside", "alert": "beside", "menu": "beside", "menubar": "beside", "banner": "header", "form": "class",
    "main": "main", "article": "article",
}
COMMENT_WORDS = ("comment", "comments", "commentary", "commentlist", "commentarea", "disqus", "replies", "respond", "responses",
                 "discussion")
BESIDE_WORDS = (
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adunit banner sponsor sponsored "
    "sponsors promo promos promoted promotion promotions outbrain taboola "
    "nav navbar navi navigation menu menus submenu topmenu breadcrumb breadcrumbs topbar toolbar pagination pager "
    "footer copyright masthead "
    "sidebar sidebars rail widget widgets related recommended recommendations trending popular teaser teasers "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay disclaimer paywall subscribe "
    "subscription newsletter signup login "
    "share sharing social").split()
HEADER_WORDS = ("header", "head", "top")
ARTICLE_WORDS = ("article", "post", "entry", "story", "page", "title", "content", "news", "text", "body")
# End of fixed values.

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW_TEXT)})\b(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>.*?(?:</\1\b[^>]*>|\Z)"
    r"|<[!?][^>]*>|</[^a-zA-Z][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S | re.I)
_ATTRIBUTE = re.compile(
    r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|$)""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_BROKEN_TAG = re.compile(r"<[/!?a-zA-Z]")

_ROOT = 0
#: Elements that a tag ends if one is open below its own kind of parent.
_ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}


def _kind(name: str, attributes: str) -> str | None:
    """What an element is to the text: `never`, `comments`, `beside`, `header`, `class`, `article`, `main`, `link`, `h1`, or just a part."""
    if name in ("html", "body"):
        return None
    if name in NEVER_TEXT:
        return "never"
    words: list[str] = []
    marked = None
    if attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), html_std.unescape(value.strip("\"'"))
            if key == "hidden" or (key == "style" and _UNSEEN.search(value)):
                return "never"
            if key == "role":
                marked = ROLES.get(value.lower().strip(), marked)
            elif key == "itemprop" and value.lower() == "articlebody":
                marked = "article"
            elif key in ("class", "id"):
                for token in value.split():
                    parts = _WORD.findall(_CAMEL.sub(" ", token).lower())
                    if parts and parts[0] not in ("has", "with", "no", "without"):
                        words += parts
    if words and any(w in COMMENT_WORDS for w in words):
        return "comments"
    if marked in ("article", "main") or name in ("article", "main"):
        return marked if marked in ("article", "main") else name
    if name in BESIDE_TEXT or marked == "beside":
        return "beside"
    if name == "header" or marked == "header":
        return "header"
    if name == "form" or marked == "class":
        return "class"
    if words:
        if any(w in BESIDE_WORDS for w in words):
            return "class"
        if any(w in HEADER_WORDS for w in words) and not any(w in ARTICLE_WORDS for w in words) and name not in (
                "h1", "h2", "h3", "h4", "h5", "h6", "p", "span", "a", "table", "thead", "tr", "td", "th"):
            return "header"
    return "link" if name == "a" else "h1" if name == "h1" else None


class _Page:
    """Lines of a page as pieces of text, each with the node of the told elements that it lies in."""

    def __init__(self, html: str):
        self.parents, self.kinds = [-1], [""]
        self.lines: list[list[tuple[str, int]]] = []
        self._line: list[tuple[str, int]] = []
        self._open: list[tuple[str, int]] = []  # name, and the node outside of the element
        self._n_open: Counter[str] = Counter()
        self._node = _ROOT
        self._read(html)

    def _read(self, html: str) -> None:
        # No tag can lie behind the last `>`; one that begins there is cut off.
        end = html.rfind(">") + 1
        at = 0
        for token in _TOKEN.finditer(html, 0, end):
            if token.start() > at:
                self._line.append((html[at:token.start()], self._node))
            at = token.end()
            name = token[3]
            if name is None:
                continue
            name = name.lower()
            if token[2]:
                self._end_tag(name)
            else:
                self._start_tag(name, token[4])
        rest = html[at:]
        broken = _BROKEN_TAG.search(rest, max(0, end - at))
        self._line.append((rest[:broken.start()] if broken else rest, self._node))
        self._break()

    def _break(self) -> None:
        self.lines.append(self._line)
        self._line = []

    def _pop_to(self, place: int) -> None:
        self._node = self._open[place][1]
        self._n_open.subtract(name for name, _ in self._open[place:])
        del self._open[place:]

    def _start_tag(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._break()
            self._end_implied(name)
        elif name == "br":
            self._line.append((" ", self._node))
        if name in VOID:
            return
        self._open.append((name, self._node))
        self._n_open[name] += 1
        kind = _kind(name, attributes)
        if kind:
            self.parents.append(self._node)
            self.kinds.append(kind)
            self._node = len(self.kinds) - 1

    def _end_implied(self, name: str) -> None:
        ended, within = _ENDED_BY.get(name, ({"p"}, BLOCKS))
        if not any(self._n_open[other] for other in ended):
            return
        for place in range(len(self._open) - 1, -1, -1):
            other = self._open[place][0]
            if other in ended:
                self._pop_to(place)
                return
            if other in within:
                return

    def _end_tag(self, name: str) -> None:
        block = name in BLOCKS
        if block:
            self._break()
        if not self._n_open[name]:
            return
        for place in range(len(self._open) - 1, -1, -1):
            other = self._open[place][0]
            if other == name:
                self._pop_to(place)
                return
            if not block and other in BLOCKS:
                return

    def dropped_and_marked(self) -> tuple[list[bool], list[bool]]:
        """For each node: does its text go, and does it lie in the marked article?"""
        kinds, parents = self.kinds, self.parents
        always = [False] * len(kinds)
        for node in range(1, len(kinds)):
            always[node] = always[parents[node]] or kinds[node] in ("never", "comments", "beside")
        holds = [False] * len(kinds)
        for node in range(len(kinds) - 1, 0, -1):
            if kinds[node] in ("article", "main") and not always[node]:
                holds[node] = True
            if holds[node]:
                holds[parents[node]] = True
        dropped, marked = list(always), [False] * len(kinds)
        whole = "article" if any(k == "article" and not a for k, a in zip(kinds, always)) else "main"
        in_main = [False] * len(kinds)
        for node in range(1, len(kinds)):
            up, kind = parents[node], kinds[node]
            inside = marked[up]
            if kind == "class":
                dropped[node] = always[node] or not holds[node]
            elif kind == "header":
                # The header of an article is part of it.
                dropped[node] = always[node] or not (holds[node] or inside)
            dropped[node] = dropped[node] or dropped[up]
            in_main[node] = in_main[up] or kind == "main"
            marked[node] = not dropped[node] and (inside or kind == whole or (kind == "h1" and in_main[node]))
        return dropped, marked


def _in_kind(page: _Page, kind: str) -> list[bool]:
    inside = [False] * len(page.kinds)
    for node in range(1, len(inside)):
        inside[node] = inside[page.parents[node]] or page.kinds[node] == kind
    return inside


def kept_lines(weights: Sequence[int], window: int = WINDOW, surge: int = SURGE) -> Iterator[tuple[int, int]]:
    """Stretches of lines from a surge of the windows' sums to the next dive, without weightless lines at their ends."""
    sums = [sum(weights[i:i + window]) for i in range(len(weights))]
    needed = min(surge, max(sums, default=0))
    begun = None
    risen = False
    for line, total in enumerate([*sums, 0]):
        if total:
            begun = line if begun is None else begun
            risen = risen or total >= needed
        elif begun is not None:
            if risen:
                full = [i for i in range(begun, min(line + window, len(weights))) if weights[i]]
                yield full[0], full[-1] + 1
            begun, risen = None, False


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The text of a page's article, its blocks on lines of their own."""
    if not html:
        return ""
    page = _Page(html)
    dropped, marked = page.dropped_and_marked()
    linked = _in_kind(page, "link")
    has_marks = any(marked)
    texts, weights = [], []
    for pieces in page.lines:
        stays = [(text, node) for text, node in pieces if not dropped[node] and (marked[node] or not has_marks)]
        text = " ".join(html_std.unescape("".join(t for t, _ in stays)).split())
        in_links = 0 if has_marks else sum(len("".join(t.split())) for t, node in stays if linked[node])
        texts.append(text)
        weights.append(max(0, len(text) - 2 * in_links) if text else 0)
    spans = kept_lines(weights, window, 1 if has_marks else surge)
    return "\n".join(t for first, end in spans for t in texts[first:end] if t)


def extract(pages: DataFrame, html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """Add `text`, the main text of each page, and `n_chars`, its number of code points."""
    @F.pandas_udf("string")
    def texts(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, window, surge) for page in html], dtype=object)

    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("text", "n_chars")]
    read = texts(F.col(f"`{html_col}`").cast("string")).alias("text")
    return pages.select(*kept, read).withColumn("n_chars", F.length("text").cast("long"))
