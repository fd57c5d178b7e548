"""Blocks of text in an HTML page, with where they stand. Never fails: what is malformed is read as browsers roughly do."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Elements of HTML by how their content counts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre section select summary "
    "table tbody td template tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME = frozenset(
    "nav footer aside form script style noscript template iframe object embed svg canvas button select option input textarea "
    "dialog menu audio video map head title label fieldset legend applet noembed noframes xmp".split())
CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
#: Words of class names and ids that name what surrounds an article, if nothing but ``PLAIN_WORDS`` stands beside them.
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored promo promos promotion "
    "banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter "
    "subscribe subscription signup login signin search share sharing sharebar social related recommended recommendations "
    "widget widgets comment comments commentlist discussion disqus respond replies reply skip skiplink pagination pager paging "
    "copyright legal disclaimer hidden paywall outbrain taboola".split())
PLAIN_WORDS = frozenset(
    "area bar block body box btn button buttons container content el form group holder icon icons inner item items label left link "
    "links list main module outer page panel placeholder post posts right row section site slot text title top bottom unit user "
    "view wrap wrapper zone".split())
HEADER_WORDS = frozenset(("header", "topheader", "pageheader", "siteheader"))
MAIN_WORDS = frozenset(
    ("main", "content", "article", "articlebody", "main-content", "maincontent", "post-content", "entry-content", "article-body",
     "article-content", "post-body", "story-body", "articletext", "article-text"))
_NEGATED = re.compile(r"(^|[-_])(has|no|with|without|not)([-_]|$)")
_WORDS = re.compile(r"[a-z0-9]+|[A-Z]+(?![a-z])|[A-Z][a-z0-9]*")
#: Elements whose opening ends others that are still open, up to the nearest of the elements named last.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)"
                     r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    """A run of text between block boundaries; ``path`` names the open elements, ``order`` its place among all tokens.

    ``chrome``: its elements or their roles say that it is no article; ``named``: path of the outermost element whose class or id
    says so."""

    text: str
    path: str
    chrome: bool
    header: bool
    heading: bool
    article: bool
    main: bool
    linked: int
    order: int
    named: str


class _Open(NamedTuple):
    tag: str
    path: str
    chrome: bool
    header: bool
    heading: bool
    article: bool
    main: bool
    link: bool
    named: str


_ROOT = _Open("", "", False, False, False, False, False, False, "")


def _words(value: str) -> list[list[str]]:
    """The words of each name in a class or id attribute, without names that deny something."""
    names = [[w.lower() for w in _WORDS.findall(name)] for name in value.split() if not _NEGATED.search(name)]
    return [w for w in names if w]


def _is_chrome(words: list[str]) -> bool:
    """Whether a name says that its element is no article, and says nothing else."""
    known = [w for w in words if w in CHROME_WORDS]
    return "".join(words) in CHROME_WORDS or bool(known) and all(w in CHROME_WORDS or w in PLAIN_WORDS or w.isdigit() for w in words)


def _opened(tag: str, rest: str, parent: _Open) -> _Open:
    attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if rest else {}
    classes = attributes.get("class", "")
    step = tag + "".join(f".{c}" for c in sorted(classes.split())) if classes else tag
    names = _words(classes) + _words(attributes.get("id", "")) if attributes else []
    role = attributes.get("role", "").lower()
    whole = tag in ("html", "body", "main")
    main = (tag == "main" or role == "main" or "articlebody" in attributes.get("itemprop", "").lower()
            or bool(MAIN_WORDS & {x.lower() for x in (classes + " " + attributes.get("id", "")).split()}))
    header = not whole and (tag == "header" or any(w[-1] in HEADER_WORDS or "".join(w) in HEADER_WORDS for w in names))
    chrome = (tag in CHROME or role in CHROME_ROLES and not header or "hidden" in attributes
              or attributes.get("aria-hidden", "").lower() == "true"
              or "display:none" in attributes.get("style", "").replace(" ", "").lower())
    path = f"{parent.path}/{step}"
    named = parent.named or (path if not whole and not main and any(map(_is_chrome, names)) else "")
    return _Open(tag, path, parent.chrome or chrome and not whole, parent.header or header,
                 parent.heading or tag in HEADINGS, parent.article or tag == "article" or role == "article",
                 parent.main or main and tag not in ("html", "body"), parent.link or tag == "a", named)


def parse(page: str) -> tuple[list[Block], list[tuple[str, int]]]:
    """The text blocks of a page in order, and ``(path, order)`` of its elements.

    Character references are decoded, runs of white space become one space, blocks without text are left out. Line breaks
    within a block are white space. Comments, declarations and the content of scripts and styles are no text.
    """
    blocks: list[Block] = []
    tags: list[tuple[str, int]] = []
    stack = [_ROOT]
    parts: list[str] = []
    linked = order = at = 0

    def flush() -> None:
        nonlocal linked, order
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                top = stack[-1]
                near = next((o for o in reversed(stack) if o.tag in BLOCK or not o.tag), _ROOT)
                blocks.append(Block(text, near.path, top.chrome, top.header, top.heading, top.article, top.main, linked, order, top.named))
                order += 1
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if stack[-1].link:
                linked += len(piece.strip())

    def close(index: int) -> None:
        if any(o.tag in BLOCK for o in stack[index:]) or any(
                (o.chrome, o.named) != (stack[index - 1].chrome, stack[index - 1].named) for o in stack[index:]):
            flush()
        del stack[index:]

    while at < len(page):
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        add(page[at:begin])
        match = _MARKUP.match(page, begin)
        if match is None:
            add("<")
            at = begin + 1
            continue
        at = match.end()
        tag = match[2] or match[5]
        if tag is None:
            continue
        tag, ending = tag.lower(), match[1] or match[4]
        if ending:
            if tag == "p" and not any(o.tag == "p" for o in stack) or tag == "br":
                flush() if tag == "p" else add(" ")
                continue
            index = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if index:
                close(index)
            continue
        if tag in BLOCK:
            flush()
            index = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "p"), 0)
            if index and not any(o.tag in ("table", "button", "object") for o in stack[index:]):
                close(index)
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            k = len(stack) - 1
            lowest = 0
            while k > 0 and stack[k].tag not in limits:
                if stack[k].tag in ends:
                    lowest = k
                k -= 1
            if lowest:
                close(lowest)
        opened = _opened(tag, match[3] or match[6] or "", stack[-1])
        begins = (opened.chrome, opened.named) != (stack[-1].chrome, stack[-1].named)
        if begins and tag not in VOID:
            flush()
        if tag in BLOCK or tag in CHROME or begins:
            tags.append((opened.path, order))
            order += 1
        if tag in VOID:
            add(" ")
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            stack.append(opened)
            if end is None:
                break
        elif not (match[3] or "").endswith("/") or tag in BLOCK:
            stack.append(opened)
    flush()
    return blocks, tags
