"""A tolerant HTML reader: block tree and clean block texts of one page.

Only block elements become nodes; inline markup joins its block's text.
Scripts, styles and other unread elements, comments and declarations vanish,
so do inline elements that are named as adverts; character references are
decoded, white space inside a block is one blank.
"""
from __future__ import annotations

import html as _html
import re

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

# --- fixed values: element classes of the HTML vocabulary ---
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup",
         "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary",
         "svg", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "button", "object", "audio", "video", "canvas", "math"}
#: Names of adverts, on inline elements too.
ADVERTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "taboola", "outbrain"}
#: An opening tag closes an open element of these kinds (up to the given borders).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
          "body": ({"head"}, set())}
#: Blocks that cannot stand inside a paragraph.
ENDS_P = BLOCK - {"button", "object", "audio", "video", "canvas", "math", "svg", "select", "option", "optgroup"}


def name_words(names: str) -> tuple[str, ...]:
    """The words of class and id names, split at signs and inner capitals."""
    return tuple(re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()))


def _advert(attrs: str) -> bool:
    """Do an inline element's attributes name it an advert?"""
    if "class" not in attrs and "id" not in attrs:
        return False
    got = {k.lower(): _html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
    return bool(ADVERTS & set(name_words(f"{got.get('class', '')} {got.get('id', '')}")))


class Node:
    """A block element: ``content`` holds its texts and child nodes in order,
    ``links`` the characters of its own texts that stand in links."""
    __slots__ = ("tag", "names", "role", "hidden", "content", "label", "links")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.names, self.role, self.hidden, self.links = tag, (), "", False, 0
        self.content: list[str | Node] = []
        if attrs and "=" in attrs or "hidden" in attrs:
            got = {k.lower(): _html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
            self.names = name_words(f"{got.get('class', '')} {got.get('id', '')}")
            self.role = got.get("role", "").strip().lower()
            self.hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()
        self.label = f"{tag}.{'.'.join(self.names)}"

    def texts(self) -> list[str]:
        return [c for c in self.content if isinstance(c, str)]

    def nodes(self) -> list[Node]:
        return [c for c in self.content if not isinstance(c, str)]


def parse(page: str | None) -> Node:
    """The page's block tree under a root; an empty page gives an empty root."""
    root = Node("#root")
    stack = [root]
    run: list[str] = []
    linked = 0                    # characters of the run that stand in a link
    in_link = False
    skipped, depth = "", 0        # the inline advert that is open, and how deep

    def flush() -> None:
        nonlocal linked
        if run:
            text = " ".join(_html.unescape("".join(run)).split())
            run.clear()
            if text:
                stack[-1].content.append(text)
                stack[-1].links += linked
        linked = 0

    page = page or ""
    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if m is None:
            if not depth:
                run.append(page[pos:])
            break
        if m.start() > pos and not depth:
            run.append(page[pos:m.start()])
            linked += (m.start() - pos) * in_link
        pos = m.end()
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not close:
            stop = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, pos)
            pos = stop.end() if stop else end
            continue
        if tag == "br" or tag in VOID:
            run.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag not in BLOCK:
            if depth:
                depth += (tag == skipped) * (-1 if close else 1)
            elif not close and not attrs.endswith("/") and _advert(attrs):
                skipped, depth = tag, 1
            elif tag == "a":
                in_link = not close
            continue
        depth, in_link = 0, False         # inline elements end where a block begins or ends
        flush()
        if close:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            # A stray end tag of a small block never closes the structure around it.
            if at and not (tag in ("p", "li", "dt", "dd") and any(n.tag in ("article", "main", "section", "body", "td", "div") for n in stack[at + 1:])):
                del stack[at:]
            continue
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in ("button", "td", "th", "object", "table", "caption"):
                    break
        if tag in CLOSES:
            kinds, border = CLOSES[tag]
            low = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in border:
                    break
                if stack[i].tag in kinds:
                    low = i
            if low is not None:
                del stack[low:]
        node = Node(tag, attrs)
        stack[-1].content.append(node)
        if not attrs.endswith("/") or tag not in ("svg",):
            stack.append(node)
    flush()
    return root
