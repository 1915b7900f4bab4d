"""A forgiving HTML reader: the block elements of a page and the runs of text in them, as one tree in page order."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Elements by the part they play. Elements that are in no list are inline and add nothing but their text.
GROUPS = {
    "page": "html body",
    "head": "head",
    "article": "article",
    "main": "main",
    "menu": "nav menu",
    "header": "header hgroup",
    "footer": "footer address",
    "aside": "aside dialog",
    "form": "form fieldset",
    "section": "section",
    "division": "div center",
    "paragraph": "p",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl dir",
    "item": "li dt dd",
    "table": "table caption colgroup thead tbody tfoot tr td th",
    "quote": "blockquote pre listing",
    "figure": "figure figcaption details summary",
}
KIND = {tag: group for group, tags in GROUPS.items() for tag in tags.split()}
# Never text of a page; their content is skipped up to the end tag.
SKIPPED = frozenset("script style title textarea noscript template iframe noframes noembed xmp select button svg math object canvas audio video".split())
BREAKS = frozenset("br hr wbr img".split())
# What an opening tag ends: an item the item before it, a cell the cell before it, within the nearest of the others.
ENDS = {
    "li": (("li",), ("ul", "ol", "dir", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
# Words of class, id and role that name what a part is for.
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
OTHER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies copyright "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice pagination popup promo related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)

# Where something other than text may begin, and a tag: with its quoted values if the quotes are in order, else up to >.
BEGIN = re.compile(r"<(?=[!?]|/?[A-Za-z])")
TAG = re.compile(r"""</?[A-Za-z](?:[^<>"']|"[^"]*"|'[^']*')*+>|</?[A-Za-z][^>]*>""")
COMMENT = re.compile(r"--!?>")
NAME = re.compile(r"[^\s/>]+")
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node(NamedTuple):
    """A block element, or a run of text (``text`` is not None) without any block in it."""

    parent: int
    kind: str
    hint: str
    text: str | None
    linked: int
    given: str | None


def described(attributes: str) -> tuple[str, str | None]:
    """(hint of the words in class, id, role and itemprop; what ``data-main`` says)."""
    hint, given = "", None
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values)
        if name.lower() == "data-main":
            given = value
            continue
        words = set(WORDS.findall(CAMEL.sub(" ", value).lower())) | set(WORDS.findall(value.lower()))
        if words & OTHER_WORDS:
            hint = "other"
        elif not hint and words & CONTENT_WORDS:
            hint = "content"
    return hint, given


class Reader:
    """One page on its way from tags to nodes; open elements are a stack."""

    def __init__(self) -> None:
        self.nodes = [Node(-1, "page", "", None, 0, None)]
        self.open: list[tuple[int, str]] = [(0, "")]
        self.opened: dict[str, int] = {}
        self.buffer: list[str] = []
        self.linked, self.in_link = 0, False

    def text(self, raw: str) -> None:
        if raw:
            found = html.unescape(raw) if "&" in raw else raw
            self.buffer.append(found)
            if self.in_link:
                self.linked += len(found.strip())

    def flush(self) -> None:
        """The text since the last block tag becomes a node, if there is any."""
        if self.buffer:
            found = " ".join("".join(self.buffer).split())
            if found:
                self.nodes.append(Node(self.open[-1][0], "text", "", found, min(self.linked, len(found)), None))
            self.buffer, self.linked = [], 0

    def pop(self) -> None:
        _, tag = self.open.pop()
        self.opened[tag] -= 1

    def start(self, tag: str, attributes: str) -> None:
        self.flush()
        self.in_link = False
        if self.open[-1][1] == "p":
            self.pop()
        if tag == "body" and self.opened.get("head"):
            self.end("head")
        if tag in ENDS:
            ended, bounds = ENDS[tag]
            if any(self.opened.get(t) for t in ended):
                for i in range(len(self.open) - 1, 0, -1):
                    if self.open[i][1] in bounds:
                        break
                    if self.open[i][1] in ended:
                        while len(self.open) > i:
                            self.pop()
                        break
        hint, given = described(attributes) if "=" in attributes else ("", None)
        self.nodes.append(Node(self.open[-1][0], KIND[tag], hint, None, 0, given))
        self.open.append((len(self.nodes) - 1, tag))
        self.opened[tag] = self.opened.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if not self.opened.get(tag) and tag != "p":
            return
        self.flush()
        self.in_link = False
        if self.opened.get(tag):
            while self.open[-1][1] != tag:
                self.pop()
            self.pop()


def read(page: str) -> list[Node]:
    """The nodes of a page, every parent before its children; node 0 is the page itself.

    Character references are decoded, white space within a run of text is one space, runs of white space only are left
    out. Comments, declarations and the content of scripts, styles and other elements that show no text are skipped,
    those without an end tag up to the end of the page, as browsers do. The time is in proportion to the page's length.
    """
    reader, at, last = Reader(), 0, page.rfind(">")
    while at < len(page):
        match = BEGIN.search(page, at)
        begin = match.start() if match else len(page)
        if match and begin > last and page[begin + 1] not in "!?":
            # No tag ends any more, but a comment or a declaration may begin.
            begin = min((i for i in (page.find("<!", begin), page.find("<?", begin)) if i >= 0), default=len(page))
        reader.text(page[at:begin])
        if begin == len(page):
            break
        if page[begin + 1] in "!?":
            found = COMMENT.search(page, begin + 4) if page.startswith("<!--", begin) else None
            end = found.end() if found else -1 if page.startswith("<!--", begin) else page.find(">", begin) + 1 or -1
            at = len(page) if end < 0 else end
            continue
        token = TAG.match(page, begin)[0]
        at = begin + len(token)
        closing = token[1] == "/"
        name = NAME.match(token, 2 if closing else 1)
        tag = name[0].lower()
        if tag in KIND:
            if closing:
                reader.end(tag)
            else:
                reader.start(tag, token[name.end() : -1])
        elif tag == "a":
            reader.in_link = not closing
        elif tag in BREAKS:
            reader.text(" ")
        elif tag in SKIPPED and not closing and not token.endswith("/>"):
            found = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = found.end() if found else len(page)
            reader.text(" ")
    reader.flush()
    return reader.nodes
