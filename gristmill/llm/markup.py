"""A small tree of an HTML page: elements, their text, the part a page's main text lies in.

Everything works on one page's text inside a task. Parsing never fails: stray end tags are ignored, open
elements end with their parents, a page may stop anywhere.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option optgroup p pre search section summary table tbody tfoot thead tr ul".split()
)
CELL = frozenset(("td", "th"))
#: Start tags that end an open element of these names, and what that doesn't reach through.
_LISTS = frozenset("ul ol dir menu".split())
_TABLES = frozenset(("table",))
ENDS = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "tr": (frozenset(("tr", "td", "th", "caption")), _TABLES),
    "td": (frozenset(("td", "th", "caption")), _TABLES),
    "th": (frozenset(("td", "th", "caption")), _TABLES),
    "tbody": (frozenset(("tr", "td", "th", "tbody", "thead", "tfoot", "caption")), _TABLES),
    "tfoot": (frozenset(("tr", "td", "th", "tbody", "thead", "tfoot", "caption")), _TABLES),
}
#: Start tags inside a paragraph that belong to it; any other block ends it.
_IN_PARAGRAPH = CELL | frozenset("tbody thead tfoot tr caption option optgroup legend html head body".split())
_PARAGRAPH_STOPS = frozenset("td th caption table button object".split())

#: Elements that are never main text.
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea input datalist iframe noembed noframes svg object canvas audio video dialog menu search".split()
)
#: Words of class, id and role that name a menu, header, footer, sidebar, notice, advert, form or readers' comments.
ROLES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar header masthead topbar banner footer colophon contentinfo sidebar complementary aside rail widget widgets "
    "notice notices cookie cookies consent gdpr alert popup modal overlay paywall newsletter subscribe subscription signup login ad ads advert adverts adbox adslot advertisement "
    "advertisements advertising sponsor sponsored sponsors promo promos promotion promotions search form share sharing social related recommended comment comments commentlist replies "
    "respond disqus".split()
)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))
_MAIN_NAMES = frozenset("article articlebody story storybody post postbody postcontent entry entrycontent content maincontent main".split())

_TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)(?:>|\Z)|/>|/[^a-zA-Z][^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Element:
    """An element: its name, the words of class, id and role, and children that are elements or texts."""

    __slots__ = ("name", "words", "names", "parent", "children", "main_role")

    def __init__(self, name: str, parent: Element | None, words: frozenset = frozenset(), names: tuple = (), main_role: bool = False):
        self.name, self.parent, self.words, self.names, self.main_role = name, parent, words, names, main_role
        self.children: list[Element | str] = []


def _described(name: str, attributes: str, parent: Element) -> Element:
    """Words of class, id and role, whole and by their parts (`cookie-notice`, `adSlot`); names are the values as they stand."""
    if not attributes or attributes.isspace():
        return Element(name, parent)
    found = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), html.unescape(value.strip("\"'")))
    values = [*found.get("class", "").split(), found.get("id", ""), found.get("role", "")]
    words = frozenset(w.lower() for v in values if v for w in (v, *_WORD.findall(v)))
    squeezed = {re.sub(r"[^a-z]", "", v.lower()) for v in (*found.get("class", "").split(), found.get("id", ""), found.get("itemprop", ""))}
    return Element(name, parent, words, tuple(sorted(v for v in values if v)), found.get("role", "").lower() == "main" or bool(squeezed & _MAIN_NAMES))


class _Open:
    """The innermost open element, and how many of each name are open: nothing is looked for that isn't there."""

    def __init__(self, root: Element):
        self.here = root
        self.count: dict[str, int] = {}

    def enter(self, e: Element) -> None:
        self.here = e
        self.count[e.name] = self.count.get(e.name, 0) + 1

    def leave(self, e: Element) -> None:
        """End `e` and all that is open in it."""
        x = self.here
        while x is not e.parent:
            self.count[x.name] -= 1
            x = x.parent
        self.here = x

    def find(self, names, stops) -> Element | None:
        """The innermost open element of one of the names that lies above any of the stops."""
        if any(self.count.get(n) for n in names):
            x = self.here
            while x.parent is not None and x.name not in stops:
                if x.name in names:
                    return x
                x = x.parent
        return None

    def before(self, name: str) -> None:
        """End what the start tag of `name` ends."""
        if name in BLOCK and name not in _IN_PARAGRAPH and (p := self.find(("p",), _PARAGRAPH_STOPS)):
            self.leave(p)
        if name in ENDS:
            while x := self.find(*ENDS[name]):
                self.leave(x)

    def after(self, name: str) -> None:
        """An end tag. Inline elements don't end the blocks they stand around, cells are ended by parts of their table alone."""
        if not self.count.get(name):
            return
        inline, in_table = name not in BLOCK and name not in CELL, name in ("table", "tr", "tbody", "thead", "tfoot", "body", "html")
        x = self.here
        while x.name != name:
            if inline and (x.name in BLOCK or x.name in CELL) or x.name in CELL and not in_table:
                return
            x = x.parent
        self.leave(x)


def parse(text: str) -> Element:
    """The tree of a page; its root is an element without a name."""
    root = Element("", None)
    tree, at, n = _Open(root), 0, len(text)
    while at < n:
        m = _TAG.search(text, at)
        if m is None:
            tree.here.children.append(html.unescape(text[at:]))
            break
        if m.start() > at:
            tree.here.children.append(html.unescape(text[at : m.start()]))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            tree.after(name)
            continue
        tree.before(name)
        made = _described(name, m[3], tree.here)
        tree.here.children.append(made)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(text, at)
            inside = text[at : end.start() if end else n]
            made.children.append(html.unescape(inside) if name in ("textarea", "title") else inside)
            if end is None:
                break
            close = text.find(">", end.end())
            at = n if close < 0 else close + 1
        elif name not in VOID and not (m[3].endswith("/") and name in ("svg", "path")):
            tree.enter(made)
    return root


def is_dropped(e: Element) -> bool:
    """Whether an element by its name, class, id or role is no main text.

    The page's header goes; a header inside an article stays if it holds a heading. An article nested in
    an article is a reader's comment only if its class says so.
    """
    if e.name in DROPPED:
        return True
    if e.name in ("html", "body", "main", "") or e.name in _HEADINGS:
        return False
    said = e.words & ROLES
    if e.name == "header" or said and said <= {"header", "masthead"}:
        return not (_inside_article(e) and any(isinstance(c, Element) and c.name in _HEADINGS for c in _below(e)))
    if not said:
        return False
    if e.main_role and not e.words & {"ad", "ads", "comment", "comments", "sidebar", "footer", "nav", "menu", "related"}:
        return False
    return not (e.name == "article" and not e.words & {"comment", "comments", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "related"})


def _inside_article(e: Element) -> bool:
    while e.parent is not None:
        e = e.parent
        if e.name in ("article", "main") or e.main_role:
            return True
    return False


def _below(e: Element) -> Iterator[Element | str]:
    todo = [iter(e.children)]
    while todo:
        for c in todo[-1]:
            yield c
            if isinstance(c, Element):
                todo.append(iter(c.children))
                break
        else:
            todo.pop()


def empty(root: Element, gone) -> None:
    """Empty every element that `gone` says; it still parts the blocks before and after it."""
    todo = [root]
    while todo:
        for c in todo.pop().children:
            if not isinstance(c, str):
                if gone(c):
                    c.children = []
                else:
                    todo.append(c)


def prune(root: Element) -> None:
    """Empty every element that by itself is no main text."""
    empty(root, is_dropped)


def subtree_hashes(root: Element) -> dict[Element, int]:
    """64-bit hash of every element that holds text: name, class, id, role and what is below, white space evened out."""
    out: dict[Element, int] = {}
    order = [root]
    for x in order:
        order += [c for c in x.children if not isinstance(c, str)]
    own: dict[Element, bytes] = {}
    for x in reversed(order):
        parts, said = [x.name, *x.names], False
        for c in x.children:
            if isinstance(c, str):
                if words := " ".join(c.split()):
                    parts.append("=" + words)
                    said = True
            elif c in own:
                parts.append("<" + own[c].hex())
                said = True
        if said:
            own[x] = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest()
            out[x] = int.from_bytes(own[x], "little", signed=True)
    return out


def main_parts(root: Element) -> list[Element]:
    """The outermost articles that hold text; without any the outermost main elements (`main`, a role, class or id that says so); else the page."""
    for fits in (lambda e: e.name == "article", lambda e: e.name == "main" or "main" in e.words and e.main_role, lambda e: e.main_role):
        found, todo = [], [root]
        while todo:
            x = todo.pop()
            if x is not root and fits(x):
                found.append(x)
            else:
                todo += [c for c in reversed(x.children) if not isinstance(c, str)]
        found = [e for e in found if any(isinstance(c, str) and not c.isspace() for c in _below(e))]
        if found:
            return found
    return [root]


def blocks(e: Element) -> list[str]:
    """Texts of the blocks below an element, in page order: white space evened out, empty ones left out.

    Line breaks and cells of a table row are white space inside a block.
    """
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if said := " ".join("".join(line).split()):
            out.append(said)
        line.clear()

    todo: list[tuple[Element, Iterator]] = [(e, iter(e.children))]
    while todo:
        x, rest = todo[-1]
        for c in rest:
            if isinstance(c, str):
                line.append(c)
                continue
            if c.name in BLOCK:
                end()
            elif c.name in CELL or c.name == "br":
                line.append(" ")
            todo.append((c, iter(c.children)))
            break
        else:
            todo.pop()
            if x.name in BLOCK:
                end()
            elif x.name in CELL:
                line.append(" ")
    end()
    return out


def main_text(root: Element) -> str:
    return "\n\n".join(b for part in main_parts(root) for b in blocks(part))
