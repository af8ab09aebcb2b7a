"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of text.  The lengths of the lines
are summed over a sliding window; where the sum rises from nothing is a surge, where
it falls back a dive, and the text between them is kept if the sum gets high enough.
Lines of page furniture (menus, adverts, forms, comments and the like) and lists of links
weigh nothing, so they open and close the runs.  On a page that marks its article, lines
outside weigh nothing either, and each line inside weighs as much as a surge needs, on top
of its own length: the mark is a weight, and the same sums decide.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postmill.llm.common import append_columns

#: Lines in the sliding window.
WINDOW = 3
#: A run whose greatest window sum is less is no main text, unless no run has more.
SURGE = 86

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|noscript|template|svg|math|iframe|object|canvas|xmp|title)\b[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-z][^\s/<>]*)((?:"[^"]*"|'[^']*'|[^"'<>])*)>"""
    r"|</?[a-z][^<>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
#: What a page's legal line begins with; a sentence on copyright does not.
_NOTICE = re.compile(r"\s*(?:©|\(c\)\s*\d|copyright\s*(?:©|\(c\)|\d)|all rights reserved\b)", re.IGNORECASE)
#: Characters of such a line at most.
NOTICE_CHARS = 200

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("aside button dialog footer form head header input menu nav select".split())
#: Of these an element that holds most of the page's text is not furniture but its wrapper.
_WRAPPERS = frozenset("form header".split())
_PARAGRAPHS = frozenset("blockquote figcaption h1 h2 h3 h4 h5 h6 p pre".split())
_ARTICLE = frozenset(["article", "main"])
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
#: Words of class and id names that mark page furniture, as the last word of a name.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination popup promo promotion recommended related replies search share "
    "sharing signup sponsor sponsored subscribe subscription toolbar topbar".split()
)
#: Layout words, which mark furniture only as a whole class or id name.
_WHOLE_NAMES = frozenset("sidebar social tags widget".split())
#: Words after which the word before them is the last; and words that say what a wrapper has.
_NEUTRAL = frozenset(
    "area bar block body bottom box col column container content group holder inner item items left list outer panel "
    "region right row section slot top unit wrap wrapper".split()
)
_HAVING = frozenset("has have no non with without".split())
#: First words of names such as related-articles.
_OTHERS = frozenset("recommended related sponsored suggested".split())
#: An article inside these stays furniture.
_CLOSED = frozenset("aside footer nav".split())
_REPLIES = frozenset("comment comments disqus replies".split())


@dataclass
class Line:
    text: str
    linked: int  # characters of it inside links
    links: int
    furniture: bool
    article: int  # the mark it lies in, by place among the tokens, or -1
    paragraph: bool
    container: int  # the element around the paragraph, by place among the tokens


def _attributes(text: str) -> list[tuple[str, str]]:
    return [(name.lower(), "".join(values)) for name, *values in _ATTRIBUTE.findall(text)]


def _words(attributes: list[tuple[str, str]]) -> list[list[str]]:
    """The words of each class and id name."""
    names = [name for key, value in attributes if key in ("class", "id") for name in value.split()]
    return [[w.lower() for w in _WORD.findall(name)] for name in names]


def _hidden(attributes: list[tuple[str, str]]) -> bool:
    """By an attribute of that name or by its style, whatever other attributes say."""
    return any(key == "hidden" or (key == "style" and _NO_DISPLAY.search(value)) for key, value in attributes)


def _names_furniture(words: list[str]) -> bool:
    """Whether a class or id name is one of furniture: a compound is what its last word is."""
    if not words or _HAVING.intersection(words):
        return False
    if len(words) == 1 and words[0] in _WHOLE_NAMES:
        return True
    if words[0] in _OTHERS and len(words) <= 2:
        return True
    while len(words) > 1 and (words[-1] in _NEUTRAL or words[-1].isdigit()):
        words = words[:-1]
    return words[-1] in _NAMES or (len(words) == 1 and words[0] in _WHOLE_NAMES)


def _is_closed(tag: str, attributes: list[tuple[str, str]]) -> bool:
    """Furniture that no article inside opens: comments, aside, nav, footer and what is hidden."""
    if tag in _CLOSED or _hidden(attributes):
        return True
    return any(_names_furniture(words) and _REPLIES.intersection(words) for words in _words(attributes))


def _is_furniture(tag: str, attributes: list[tuple[str, str]], in_article: bool, most: bool) -> bool:
    """``most``: the element holds more than four fifths of the page's text."""
    if tag in ("html", "body", "article", "main"):
        return False
    if tag in _FURNITURE and not (tag == "header" and in_article) and not (most and tag in _WRAPPERS):
        return True
    if not attributes:
        return False
    if _hidden(attributes):
        return True
    for words in _words(attributes):
        if _names_furniture(words) and not (most and not _REPLIES.intersection(words)):
            return True
    return not most and any(key == "role" and value.lower() in _ROLES for key, value in attributes)


def _matched(tokens: list) -> dict[int, int]:
    """The end tag of each start tag that has one, by place among the tokens."""
    opened: dict[str, list[int]] = {}
    order: list[tuple[int, str]] = []
    ends: dict[int, int] = {}
    for i, token in enumerate(tokens):
        tag = (token[3] or "").lower()
        if not tag or tag in _VOID:
            continue
        if not token[2]:
            if not token[4].endswith("/"):
                opened.setdefault(tag, []).append(i)
                order.append((i, tag))
        elif opened.get(tag):
            start = opened[tag].pop()
            ends[start] = i
            # What was opened inside and not closed ends here as well, without an end of its own.
            while order and order[-1][0] > start:
                inner, name = order.pop()
                if opened[name] and opened[name][-1] == inner:
                    opened[name].pop()
            if order and order[-1][0] == start:
                order.pop()
    return ends


def lines_of(page: str) -> list[Line]:
    tokens = list(_TOKEN.finditer(page))
    ends = _matched(tokens)
    out: list[Line] = []
    held: list[str] = []
    linked = links = 0
    furniture_until = article_until = link_until = closed_until = -1
    resumed: list[tuple[int, int]] = []  # end of an article, end of the furniture around it
    around: list[tuple[int, int]] = []  # open elements: place of the start and of the end
    place = 0
    # Characters of text before each token: how much of the page an element holds.
    before = [0]
    for token in tokens:
        before.append(before[-1] + len(page[place : token.start()].strip()))
        place = token.end()
    total = before[-1] + len(page[place:].strip())
    place = 0

    def flush() -> None:
        nonlocal linked, links
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Line(text, linked, links, furniture, article, paragraph, container))
        held.clear()
        linked = links = 0

    furniture, article, own = False, -1, -1
    paragraph, container = False, -1
    for i, token in enumerate(tokens):
        text = page[place : token.start()]
        place = token.end()
        if text:
            held.append(text)
            if i <= link_until:
                linked += len(text.strip())
        tag = (token[3] or "").lower()
        if not tag:
            if token[1]:
                held.append(" ")
            continue
        starts = not token[2]
        opens = starts and tag not in _VOID and not token[4].endswith("/")
        while around and around[-1][1] <= i:
            around.pop()
        while resumed and resumed[-1][0] <= i:
            furniture_until = max(furniture_until, resumed.pop()[1])
        now_furniture, now_inside = i < furniture_until, i < article_until
        outer = around[-1][0] if around else -1
        if opens:
            end = ends.get(i, len(tokens))
            attributes = _attributes(token[4]) if token[4].strip(" /") else []
            closed = end if _is_closed(tag, attributes) else -1
            if tag in _ARTICLE and (
                not now_furniture or furniture_until == len(tokens) or (i >= closed_until and not now_inside)
            ):
                # Neither a wrapper nor an element without an end swallows the article;
                # after it, the wrapper is furniture again.
                if now_furniture and furniture_until < len(tokens):
                    resumed.append((end, furniture_until))
                now_furniture, furniture_until = False, -1
                closed_until = -1
                if not now_inside or (tag == "article" and tokens[own][3].lower() == "main"):
                    own = i
                article_until = max(article_until, end)
                now_inside = True
            elif tag == "body" and furniture_until == len(tokens):
                now_furniture, furniture_until = False, -1
            elif not now_furniture and _is_furniture(
                tag, attributes, now_inside, 5 * (before[min(end + 1, len(tokens))] - before[i + 1]) > 4 * total
            ):
                now_furniture, furniture_until = True, end
            if tag not in ("html", "body") and closed < len(tokens):
                closed_until = max(closed_until, closed)
            if tag == "a":
                link_until = ends.get(i, -1)
                links += 1
            if i in ends:
                around.append((i, end))
        now_article = _mark_at(i, own, ends, tokens, article_until) if now_inside else -1
        if tag in _BLOCKS or now_furniture != furniture or now_article != article:
            flush()
            if tag in _BLOCKS:
                paragraph = starts and tag in _PARAGRAPHS
                container = outer if paragraph else (around[-1][0] if around else -1)
        elif tag == "br":
            held.append(" ")
        furniture, article = now_furniture, now_article
    held.append(page[place:])
    flush()
    return out


def _mark_at(i: int, own: int, ends: dict[int, int], tokens: list, until: int) -> int:
    """The mark that a place inside of marks lies in: the article, or else the main part around it."""
    if i < ends.get(own, len(tokens)):
        return own
    return -2  # between the articles of a main part


def _main_marks(lines: list[Line]) -> set[int]:
    """The marks that hold the main text: the largest, and others of at least half its text."""
    held: dict[int, int] = {}
    for line in lines:
        if line.article != -1 and not line.furniture:
            held[line.article] = held.get(line.article, 0) + len(line.text)
    most = max(held.values(), default=0)
    return {mark for mark, size in held.items() if 2 * size >= most}


def _is_menu(line: Line) -> bool:
    """A list of links; a paragraph may be one link, or mostly links."""
    if not line.paragraph:
        return 2 * line.linked > len(line.text)
    return line.links >= 3 and 5 * line.linked > 4 * len(line.text)


def main_text(page: str | None) -> str:
    """The blocks of main text in page order, joined by line ends; empty if there is none."""
    lines = lines_of(page or "")
    marks = _main_marks(lines)
    weights = []
    for line in lines:
        if line.furniture or (marks and line.article not in marks) or (not marks and _is_menu(line)):
            weights.append(0)
        else:
            weights.append(len(line.text) + (SURGE if marks else 0))
    for i in reversed(range(len(lines))):  # legal lines at the end of the page
        if weights[i] and not marks:
            if len(lines[i].text) > NOTICE_CHARS or not _NOTICE.match(lines[i].text):
                break
            weights[i] = 0
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    runs: list[tuple[int, int, int]] = []  # first line, end, greatest sum
    surge = None
    for i in range(len(sums) + 1):
        value = sums[i] if i < len(sums) else 0
        if value and surge is None:
            surge = i
        elif not value and surge is not None:
            runs.append((surge, i, max(sums[surge:i])))
            surge = None
    enough = min(SURGE, max((run[2] for run in runs), default=0))
    kept = {i for first, end, most in runs if most >= enough for i in range(first, end) if weights[i]}
    # A short paragraph beside kept ones, in the same element, is text as they are.
    beside = {lines[i].container for i in kept if lines[i].paragraph}
    kept |= {i for i, line in enumerate(lines) if weights[i] and line.paragraph and line.container in beside}
    return "\n".join(lines[i].text for i in sorted(kept))


def with_main_text(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """``pages`` and the main text of each whole page.

    Character references are decoded, white space inside a block becomes one space.
    The new column replaces one of its name; other columns may have any name.  A null or
    empty page, and one of furniture alone, has an empty text; a page without any
    markup is one block.  Repeated rows have equal texts; an empty table gives no rows.
    """
    return append_columns(
        pages,
        lambda batch: [pa.array([main_text(p) for p in batch.column(page).to_pylist()], pa.string())],
        [T.StructField(text, T.StringType())],
    )
