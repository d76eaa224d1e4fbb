"""Leaf blocks of an HTML page, with what their ancestors say about them.

Tags and whole class, id and role names that stand for a part of a page are one kind of evidence. A name that only holds such a
word (``site-footer``, ``commentlist``, but ``popular-science`` and ``ad-free`` as well) is another, weaker kind: the model
learns what each is worth next to the text.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

#: not text of the page, whatever is inside
RAW = {"script", "style", "template", "noscript", "title", "textarea", "svg", "iframe", "object", "select", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
    "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: an opening tag closes these, if they are open above it
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: part of a page: tag names, and words of class, id and role
REGIONS = {
    "nav": ({"nav", "menu"}, {"nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "tabs", "topbar"}),
    "header": ({"header"}, {"header", "masthead", "banner", "logo", "branding", "hd"}),
    "footer": ({"footer"}, {"footer", "copyright", "legal", "contentinfo", "ft", "colophon"}),
    "aside": ({"aside"}, {"sidebar", "aside", "complementary", "related", "widget", "rail", "recommended", "trending", "popular"}),
    "ad": (set(), {"ad", "ads", "adv", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner-ad", "commercial"}),
    "notice": ({"dialog"}, {"cookie", "cookies", "consent", "notice", "alert", "gdpr", "newsletter", "subscribe", "modal", "popup", "overlay", "dialog", "alertdialog", "paywall", "toast"}),
    "form": ({"form", "button", "fieldset", "legend"}, {"form", "search", "login", "signup", "button", "btn"}),
    "comment": (set(), {"comment", "comments", "disqus", "discussion", "reply", "replies", "responses", "respond"}),
    "share": (set(), {"share", "social", "sharing", "follow"}),
    "hidden": (set(), {"hidden", "sr-only", "visually-hidden", "screen-reader-text"}),
    "main": ({"article", "main"}, {"article", "content", "main", "post", "entry", "story", "body", "text", "maincontent"}),
}
BIT = {name: 1 << i for i, name in enumerate(REGIONS)}
_BY_TAG = {t: BIT[r] for r, (tags, _) in REGIONS.items() for t in tags}
_BY_WORD = {w: BIT[r] for r, (_, words) in REGIONS.items() for w in words}
_ATTR = re.compile(r"""(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LONG_WORDS = [(w, b) for w, b in _BY_WORD.items() if len(w) >= 5]


@dataclass(slots=True)
class Block:
    tag: str  # innermost block-level tag
    regions: int  # bits of all ancestors' regions
    hints: int  # bits of regions that words inside ancestors' names hint at
    nearest: int  # regions of the innermost ancestor that has any region or hint
    nearest_hints: int
    words: tuple[int, ...]  # hashed words of the names of that ancestor
    text: str
    linked: int  # characters inside links


@dataclass(slots=True)
class _Open:
    name: str
    regions: int
    hints: int
    nearest: int
    nearest_hints: int
    words: tuple[int, ...]
    block: str
    links: int = field(default=0)


#: slots that words of names are hashed into
SLOTS = 256


@lru_cache(maxsize=1 << 16)
def _named(name: str) -> tuple[int, int, tuple[int, ...]]:
    """Regions that a class, id or role stands for, or, if it is none of the known names, those it hints at and its hashed words."""
    whole = _BY_WORD.get(name.lower(), 0)
    if whole:
        return whole, 0, ()
    hints, words = 0, []
    for part in _PARTS.findall(name):
        part = part.lower()
        words.append(zlib.crc32(part.encode()) % SLOTS)
        hints |= _BY_WORD.get(part, 0)
        for word, bit in _LONG_WORDS:
            if part != word and (part.startswith(word) or part.endswith(word)):
                hints |= bit
    return 0, hints, tuple(words)


def _regions(name: str, attributes: str) -> tuple[int, int, tuple[int, ...]]:
    out, hints, words = _BY_TAG.get(name, 0), 0, ()
    if attributes and name not in ("html", "body"):
        for key, *values in _ATTR.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key == "style":
                out |= BIT["hidden"] if "display:none" in value.lower().replace(" ", "") else 0
            elif key == "aria-hidden":
                out |= BIT["hidden"] if value.lower() == "true" else 0
            elif key == "hidden":
                out |= BIT["hidden"]
            else:
                for word in value.split():
                    whole, hint, parts = _named(word)
                    out, hints, words = out | whole, hints | hint, words + parts
    return out, hints, tuple(sorted(set(words)))[:16]


#: to the > that ends a tag: a quote after = opens a value that ends with the same quote, other quotes are stray
_TAG = re.compile(r"""(?>[^>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*+>""")


def _tag_end(page: str, at: int) -> int:
    """The place of the > that ends the tag at ``at``, quotes minded; -1 if the page ends before."""
    found = _TAG.match(page, at)
    return found.end() - 1 if found else -1


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks in page order."""
    page = page or ""
    out: list[Block] = []
    root = _Open("", 0, 0, 0, 0, (), "body")
    stack, count = [root], {"": 1}
    text: list[str] = []
    linked, at, size, lower = 0, 0, len(page), None

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                top = stack[-1]
                out.append(Block(top.block, top.regions, top.hints, top.nearest, top.nearest_hints, top.words, joined, linked))
            text.clear()
        linked = 0

    def pop_to(name: str) -> None:
        while len(stack) > 1:
            top = stack.pop()
            count[top.name] -= 1
            if top.name == name:
                return

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            piece = page[at:lt]
            text.append(piece)
            if stack[-1].links:
                linked += len(piece)
            at = lt
            continue
        nxt = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if nxt in ("!", "?"):
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        closing = nxt == "/"
        if not page[at + 1 + closing:at + 2 + closing].isalpha():
            text.append("<")
            at += 1
            continue
        end = _tag_end(page, at)
        if end < 0:
            break
        inside = page[at + 1 + closing:end]
        at = end + 1
        name, _, attributes = inside.replace("/", " ", 1).partition(" ") if inside[:1].isalpha() and "/" in inside[:12] else inside.partition(" ")
        parts = name.split(None, 1)
        name, attributes = parts[0].lower(), " ".join([*parts[1:], attributes])
        if name == "br":
            text.append(" ")
            continue
        inline = name in INLINE
        if not inline:
            flush()
        if closing:
            if count.get(name):
                pop_to(name)
            continue
        if name in RAW:
            if not inside.endswith("/"):
                lower = page.lower() if lower is None else lower
                if len(lower) != size:  # some letters change length
                    lower = re.sub("[A-Z]", lambda m: m[0].lower(), page)
                end = lower.find("</" + name, at)
                end = size if end < 0 else page.find(">", end)
                at = size if end < 0 else end + 1
            continue
        if name in VOID:
            continue
        if not inline:
            if count.get("p"):
                pop_to("p")
            shut = CLOSES.get(name)
            while shut and len(stack) > 1 and (stack[-1].name in shut or stack[-1].name in INLINE):
                count[stack.pop().name] -= 1
        top, (own, hint, words) = stack[-1], _regions(name, attributes)
        near = (own, hint, words) if own or hint else (top.nearest, top.nearest_hints, top.words)
        stack.append(_Open(name, top.regions | own, top.hints | hint, *near, top.block if inline else name, top.links + (name == "a")))
        count[name] = count.get(name, 0) + 1
    flush()
    return out
