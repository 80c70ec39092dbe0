"""The main text of web pages by tree scoring.

A page's tags become a tree. Every block with text of its own is a paragraph and passes points for its length and its commas
to the blocks around it: all of them to the one it lies in, half to the next, fewer to those further out. A block's points are
discounted by the share of its text that lies in links. The block with the most points, or the article around it, is the
container; its siblings are kept where they hold text of their own kind. Menus, headers, footers, sidebars, notices, adverts,
forms, comments and everything invisible are left out, wherever they stand.

Tags are read as browsers read them: attributes with or without quotes, end tags left out, raw text of scripts, marks cut off at
the end of the page. Character references are decoded, white space inside a block is one space, blocks are joined by one space.

Each page is worked on alone, without a shuffle, in time and memory proportional to its length; nothing is cut short. A null or
empty page, or one without any text outside of what is left out, gives an empty text; so does a page of links only. Pages
repeated or without an id give a row each. Empty tables give empty results; further columns are left out, so no name can clash.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

OUTPUT = "page_id long, url string, text string, n_chars long"
LEVELS = 5  # so many blocks around a paragraph get points of it
LINKED = 0.25  # a sibling with a larger share of linked text is no text of the page
MENU_LINKS, MENU_SHARE = 3, 0.8  # a list of at least so many links with such a share of linked text is a menu
SIBLING_SHARE = 0.2  # of the container's points

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | set("dd dt figcaption li p pre".split())  # pass their points on; other blocks keep them
ENDS_PARAGRAPH = BLOCKS - set("body head html legend optgroup option tbody td tfoot th thead tr".split()) | {"hr"}
# A start tag ends what is open of these, as far as the nearest element that bounds it.
ENDS = {
    "li": ({"li"}, {"ol", "ul", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "tbody", "thead", "tfoot"}, {"table"}),
    "a": ({"a"}, {"table", "td", "th"}),
}
BOUNDS = set("table td th caption button object template".split())  # a paragraph outside stays open
TABLE_PARTS = set("tbody td tfoot th thead tr".split())
LISTS = set("dl div menu ol section table ul".split())
LEFT_OUT = set(
    "aside audio button canvas datalist dialog footer form frameset head iframe input label menu nav noembed noframes noscript object "
    "option script select style svg template textarea title video".split()
)
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Words in names of classes and ids that mark what is no article.
NAMES = set(
    "ad ads adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
WITHOUT = set("has no with without".split())  # "has-sidebar" names what holds one, or none
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TAG = re.compile(
    r"<(?:(?P<comment>!--)|(?P<bogus>[!?]|/[^A-Za-z])|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<attributes>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))?+)*+)>)"
)
START = re.compile(r"<(?=[A-Za-z/!?])")
COMMENT_END = re.compile(r"--!?>|(?<=<!--)-?>")
ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?+")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
LONG_NUMBER = re.compile(r"&#0*(\d{8,})")
COMMA = re.compile("[,،、，]")


def decoded(text: str) -> str:
    """Text with its character references replaced."""
    if "&" not in text:
        return text
    return html.unescape(LONG_NUMBER.sub("&#1114112", text))  # no code point is so large: the replacement character


def is_named_so(value: str) -> bool:
    """Whether a class or id marks what is no article."""
    for name in value.split():
        words = {word.lower() for word in NAME_WORDS.findall(name)}
        if words & NAMES and not words & WITHOUT:
            return True
    return False


def is_left_out(name: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether an element is left out; and whether only if no article lies in it."""
    if name in ("html", "body"):
        return False, False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or HIDDEN.search(attributes.get("style", "")):
        return True, False
    named = is_named_so(attributes.get("class", "")) or is_named_so(attributes.get("id", ""))
    if name in ("article", "main"):
        return named and name == "article", False
    if name == "form" or named or attributes.get("role") in ROLES:
        return True, True
    return name in LEFT_OUT, False


class Tree:
    """The elements of a page in order, each with its parent, and its pieces of text with the element each lies in."""

    def __init__(self, page: str):
        self.names, self.parents, self.kinds = ["html"], [-1], [""]
        self.out, self.unless = [False], [False]  # left out; only if no article lies in it
        self.holds_article = [False]
        self.pieces: list[tuple[int, str]] = []  # a piece of the element -1 is the border of a block
        self.open, self.places = [0], {"html": [0]}  # the open elements, and their places among these by name
        self._read(page)

    def _push(self, name: str, attributes: dict[str, str]) -> None:
        parent, node = self.open[-1], len(self.names)
        out, unless = is_left_out(name, attributes)
        if name == "header":
            out = out or not self.places.get("article")  # an article's own header holds its headline
        self.names.append(name)
        self.parents.append(parent)
        self.kinds.append(f"{name} {attributes.get('class', '')}")
        self.out.append(out)
        self.unless.append(unless)
        self.holds_article.append(False)
        if name in ("article", "main") and not out:
            above = node
            while above >= 0 and not self.holds_article[above]:
                self.holds_article[above] = True
                above = self.parents[above]
        self.places.setdefault(name, []).append(len(self.open))
        self.open.append(node)

    def _pop_to(self, place: int) -> None:
        while len(self.open) > place:
            name = self.names[self.open.pop()]
            self.places[name].pop()
            if name in BLOCKS:
                self.pieces.append((-1, ""))

    def _last(self, names: set[str]) -> int:
        """Place of the innermost open element of these, 0 if none is open."""
        return max((places[-1] for name in names if (places := self.places.get(name))), default=0)

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name in ("html", "body", "head") and (name == "html" or self.places.get(name)):
            return
        if name in ENDS_PARAGRAPH:
            place = self._last({"p"})
            if place > self._last(BOUNDS):
                self._pop_to(place)
        if name == "body" and self.places.get("head"):
            self._pop_to(self.places["head"][-1])
        ended, bounds = ENDS.get(name, ((), ()))
        if ended:
            bound = self._last(bounds)
            first = min((place for other in ended for place in self.places.get(other, ())[-1:] if place > bound), default=0)
            if first:
                self._pop_to(first)
        if name in BLOCKS or name in ("br", "hr"):
            self.pieces.append((-1, ""))
        if name not in VOID:
            self._push(name, attributes)

    def _end(self, name: str) -> None:
        places = self.places.get(name)
        if not places or name in ("html", "body"):
            return
        if name in TABLE_PARTS:
            bound = self._last({"table"})
        elif name == "table":
            bound = 0
        else:  # an inline end tag does not end the block that it stands in
            bound = self._last(BOUNDS - {name} if name in BLOCKS | BOUNDS else BLOCKS)
        if places[-1] > bound:
            self._pop_to(places[-1])

    def _read(self, page: str) -> None:
        at, upto, size = 0, 0, len(page)
        while upto < size:
            found = START.search(page, upto)
            if found is None:
                break
            begin = found.start()
            tag = TAG.match(page, begin)
            if begin > at:
                self.pieces.append((self.open[-1], decoded(page[at:begin])))
            if tag is None:  # the page ends inside a tag
                return
            upto = tag.end()
            if tag["comment"]:
                end = COMMENT_END.search(page, begin + 4)
                upto = size if end is None else end.end()
            elif tag["bogus"]:
                end = page.find(">", begin + 1)
                upto = size if end < 0 else end + 1
            else:
                name = tag["name"].lower()
                if tag["end"]:
                    self._end(name)
                else:
                    attributes = {}
                    for key, *values in ATTRIBUTE.findall(tag["attributes"]):
                        attributes.setdefault(key.lower(), decoded(values[0] or values[1] or values[2]))
                    self._start(name, attributes)
                    if name in RAW:
                        end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, upto)
                        upto = size if end is None else end.start()
            at = upto
        if at < size:
            self.pieces.append((self.open[-1], decoded(page[at:])))


def main_text(page: str) -> str:
    """The article of a page."""
    tree = Tree(page)
    names, parents, n = tree.names, tree.parents, len(tree.names)
    out = [False] * n
    block, linked = [0] * n, [False] * n  # the block an element lies in or is, and whether it lies in a link
    for node in range(1, n):
        above = parents[node]
        out[node] = out[above] or (tree.out[node] and not (tree.unless[node] and tree.holds_article[node]))
        block[node] = node if names[node] in BLOCKS else block[above]
        linked[node] = linked[above] or names[node] == "a"

    chars, in_links, commas = [0] * n, [0] * n, [0] * n  # of the text that a block holds itself
    for node, text in tree.pieces:
        if node >= 0 and not out[node]:
            length = len(" ".join(text.split()))
            chars[block[node]] += length
            in_links[block[node]] += length * linked[node]
            commas[block[node]] += len(COMMA.findall(text))

    points = [0.0] * n
    for node in range(n):
        if not chars[node]:
            continue
        given = chars[node] / 100
        if names[node] not in HEADINGS:
            given += commas[node] + (chars[node] >= 25)
        given *= 1 - in_links[node] / chars[node]
        above = node if names[node] not in PARAGRAPHS or not node else block[parents[node]]
        for level in range(LEVELS):
            points[above] += given if level == 0 else given / 2 if level == 1 else given / (3 * level)
            if not above:
                break
            above = block[parents[above]]

    whole, whole_links, links = chars[:], in_links[:], [0] * n  # of all the text below an element
    for node in range(n - 1, 0, -1):
        links[node] += names[node] == "a" and not out[node]
        for sums in (whole, whole_links, links):
            sums[parents[node]] += sums[node]
    share = [whole_links[node] / whole[node] if whole[node] else 0.0 for node in range(n)]
    scores = [points[node] * (1 - share[node]) for node in range(n)]
    best = max(range(n), key=lambda node: (scores[node], -node))
    if scores[best] <= 0:
        return ""

    around = best
    while around >= 0 and names[around] not in ("article", "main"):
        around = parents[around]
    root = around if around >= 0 else best
    kept = [False] * n
    for node in range(n):
        above = parents[node]
        if node == root:
            kept[node] = True
        elif node and above == parents[root] and names[root] != "main":
            alike = scores[node] >= SIBLING_SHARE * scores[best] and (around < 0 or names[node] == "article")
            text = around < 0 and (names[node] in PARAGRAPHS or names[node] not in BLOCKS or tree.kinds[node] == tree.kinds[root])
            kept[node] = whole[node] > 0 and share[node] < LINKED and (alike or text)
        elif node:
            kept[node] = kept[above]
        menu = names[node] in LISTS and node != root and links[node] >= MENU_LINKS and share[node] >= MENU_SHARE
        kept[node] = kept[node] and not out[node] and not menu

    # Loose text beside the container belongs to it, unless it lies directly in the page.
    texts: list[str] = []
    loose = parents[root] if around < 0 and root and names[parents[root]] not in ("html", "body") else -2
    border = False
    for node, text in tree.pieces:
        if node < 0:
            border = True
        elif kept[node] or node == loose:
            texts.append(" " + text if border else text)
            border = False
    return " ".join("".join(texts).split())


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of (page_id, url, html) rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for rows in batches:
            texts = [main_text(page.as_py() or "") for page in rows.column(2)]
            columns = [rows.column(0).cast(pa.int64()), rows.column(1).cast(pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, OUTPUT)
