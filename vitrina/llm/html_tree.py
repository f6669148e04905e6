"""A small tolerant reader of HTML: elements with their subtrees' hashes, and the text of what is left of a page."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import xxhash

# fixed values: element names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math xmp noembed noframes object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr img".split())
#: A start tag of the first kind ends an open element of the second, unless one of the third lies between.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr main menu nav ol p pre search section summary table ul".split())
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
#: Elements that hold no article text.
APART_TAGS = frozenset("nav footer aside form button dialog fieldset menu head".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of class names and ids that mark what is not the article.
APART_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidenav menu nav"
    " navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr notice popup modal overlay newsletter"
    " subscribe subscription signup login comment comments reply replies disqus social share sharing related recommended widget"
    " toolbar pagination pager skiplink".split())
HEADER_WORDS = frozenset(("header", "topbar"))

_OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
_TAG = re.compile(_OTHER + r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
#: The same without regard to quotes, with the same groups.
_LOOSE_TAG = re.compile(_OTHER + r"|<(?!)()()>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
#: An element that a start tag ends by implication is looked for so many levels up.
_LEVELS = 256
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: str, parent: Element | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []

    def get(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.attributes)}


def parse(page: str) -> Element:
    """The tree of a page; never fails.  End tags without a start are passed over, open elements end with their parent.

    Broken pages take time in proportion to their length too: what follows the last ``>`` is text, after the first tag whose quotes don't close, quotes
    are not minded, and a count of the open elements by name tells at once that an end tag has no start.
    """
    root = here = Element("", "", None)
    open_tags: Counter[str] = Counter()
    at, end, last, tag = 0, len(page), page.rfind(">"), _TAG
    while at < end:
        found = tag.search(page, at, last + 1) if at <= last else None
        text = page[at:found.start() if found else end]
        if text:
            here.children.append(html.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        closing, opening, attributes, odd, odd_attributes = found.groups()
        if closing:
            name = closing.lower()
            if open_tags[name]:
                here = _ended(here, name, open_tags)
            continue
        if odd:
            opening, attributes, tag = odd, odd_attributes, _LOOSE_TAG
        if not opening:
            continue
        name = opening.lower()
        until = _implied_end(here, name, open_tags)
        while until is not None and here is not until.parent:
            open_tags[here.tag] -= 1
            here = here.parent
        element = Element(name, attributes, here)
        if name in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            here.children.append(element)  # its content is never text
        else:
            here.children.append(element)
            if name not in VOID and not attributes.endswith("/"):
                here = element
                open_tags[name] += 1
    return root


def _ended(here: Element, name: str, open_tags: Counter[str]) -> Element:
    """The parent of the innermost open element of the name; it and all within it end."""
    while True:
        open_tags[here.tag] -= 1
        if here.tag == name:
            return here.parent
        here = here.parent


def _implied_end(here: Element, name: str, open_tags: Counter[str]) -> Element | None:
    """The open element that a start tag of the name ends, if any."""
    targets, bounds = _IMPLIED.get(name, (None, None))
    if name in _ENDS_P:
        targets, bounds = {"p"}, {"button", "td", "th", "table", "article", "section", "div", "li", "blockquote"}
    outermost = None
    if targets and any(open_tags[t] for t in targets):
        up = here
        for _ in range(_LEVELS):
            if up.parent is None or up.tag in bounds:
                break
            if up.tag in targets:
                outermost = up
                if name in _ENDS_P:
                    break
            up = up.parent
    return outermost


def elements(root: Element) -> list[Element]:
    """All elements below the root, each before what it holds."""
    out: list[Element] = []
    todo = [c for c in reversed(root.children) if not isinstance(c, str)]
    while todo:
        element = todo.pop()
        out.append(element)
        todo += [c for c in reversed(element.children) if not isinstance(c, str)]
    return out


def subtree_hashes(found: Iterable[Element]) -> dict[int, tuple[int, bool]]:
    """By id(): hash of each element's subtree (names, class and id, texts without white space runs), and if it has text."""
    out: dict[int, tuple[int, bool]] = {}
    for element in reversed(list(found)):
        own = element.get()
        parts, text = [f"<{element.tag}|{own.get('class', '')}|{own.get('id', '')}"], False
        for child in element.children:
            if isinstance(child, str):
                bare = " ".join(child.split())
                parts.append(bare)
                text = text or bool(bare)
            else:
                value, has_text = out[id(child)]
                parts.append(f"#{value}")
                text = text or has_text
        out[id(element)] = xxhash.xxh3_64_intdigest("\n".join(parts)) - (1 << 63), text
    return out


def is_apart(element: Element, in_article: bool) -> bool:
    """Whether the element's own name or attributes say that it isn't part of the article."""
    if element.tag in RAW or element.tag in APART_TAGS or element.tag == "header" and not in_article:
        return True
    if not element.attributes:
        return False
    own = element.get()
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return True
    if own.get("role", "").lower() in APART_ROLES:
        return True
    if element.tag in ("html", "body", "main", "article") and "comment" not in own.get("class", ""):
        return False
    words = set(_NAME_WORD.findall(f"{own.get('class', '')} {own.get('id', '')}".lower()))
    return bool(words & APART_WORDS) or not in_article and bool(words & HEADER_WORDS)


def holders(root: Element) -> set[int]:
    """By id(): the elements that hold an article or main element."""
    out: set[int] = set()
    for element in reversed(elements(root)):
        if element.tag in ("article", "main") or id(element) in out:
            out.add(id(element.parent))
    return out


def main_roots(root: Element, skip: frozenset[int] | set[int] = frozenset()) -> list[Element]:
    """The articles of the page, else its main elements, else the whole page; what lies in one of them is no root of its own.

    Articles in one main element belong together, else those in one parent below the body; an article right in the body stands
    alone.  Of several such groups the one with the most text is taken, text of skipped subtrees not counted.  A form around an article or main element is
    a mere container.
    """
    around = holders(root)
    groups: dict[int, list[Element]] = {}
    mains: list[Element] = []
    todo: list[tuple[Element, Element | None]] = [(root, None)]
    while todo:
        element, main = todo.pop()
        if element.tag == "article":
            group = main or (element if element.parent.tag in ("", "html", "body") else element.parent)
            groups.setdefault(id(group), []).append(element)
            continue
        if main is None and (element.tag == "main" or element.attributes and element.get().get("role", "").lower() == "main"):
            mains.append(element)
            main = element
        todo += [(c, main) for c in reversed(element.children) if not isinstance(c, str) and id(c) not in skip
                 and (c.tag == "form" and id(c) in around or not is_apart(c, False))]
    if len(groups) > 1:
        return max(groups.values(), key=lambda articles: sum(len(text_of(a, skip)) for a in articles))
    return next(iter(groups.values()), mains) or [root]


def _pieces(element: Element, skip: frozenset[int] | set[int]) -> Iterator[str]:
    """Texts of the element in page order, with a blank where a block begins or ends."""
    inside = element.tag in ("article", "main")
    todo: list[Element | str] = list(reversed(element.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            yield child
        elif id(child) in skip or is_apart(child, inside):
            yield " "
        elif child.tag in INLINE:
            todo += reversed(child.children)
        else:
            yield " "
            todo.append(" ")
            todo += reversed(child.children)


def text_of(element: Element, skip: frozenset[int] | set[int] = frozenset()) -> str:
    """The element's text without what is apart or skipped, white space runs as one blank."""
    return " ".join("".join(_pieces(element, skip)).split())


def texts_by_owner(roots: Iterable[Element], owners: set[int]) -> dict[int, str]:
    """The texts of the roots without what is apart, each under the innermost owner that holds it, 0 if none does."""
    parts: dict[int, list[str]] = {}
    for root in roots:
        inside = root.tag in ("article", "main")
        todo: list[tuple[Element | str, int]] = [(c, 0) for c in reversed(root.children)]
        while todo:
            child, owner = todo.pop()
            if isinstance(child, str):
                parts.setdefault(owner, []).append(child)
            elif not is_apart(child, inside):
                owner = id(child) if id(child) in owners else owner
                todo += [(c, owner) for c in reversed(child.children)]
    return {owner: " ".join(" ".join(own).split()) for owner, own in parts.items()}
