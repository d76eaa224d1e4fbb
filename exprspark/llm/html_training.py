"""Labelled pages for the block model: page layouts of many kinds around made-up text, each block labelled main text or not."""

from __future__ import annotations

import random

_SYLLABLES = "an be co da el fi go ha in ja ka lo mi no on pe qu re sa ti un va we xi yo zu ér çã für ble tion ment keit ción".split()


class _Writer:
    """Collects markup and the label of every block that it holds."""

    def __init__(self, seed: int):
        self.r, self.out, self.labels = random.Random(seed), [], []

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join((self.words(2, 18) + self.r.choice(".....!?")).capitalize() for _ in range(self.r.randint(low, high)))

    def raw(self, markup: str) -> None:
        self.out.append(markup)

    def block(self, tag: str, text: str, main: bool, attributes: str = "") -> None:
        self.out.append(f"<{tag}{attributes}>{text}</{tag}>")
        self.labels.append(int(main))

    def pick(self, *options):
        return self.r.choice(options)

    def maybe(self, share: float) -> bool:
        return self.r.random() < share


#: words of page parts as they occur inside names, and words that sites put beside them
_PART_WORDS = {
    "nav": ["nav", "menu", "navigation", "breadcrumb", "topbar", "pagination"], "header": ["header", "masthead", "branding"], "footer": ["footer", "colophon", "legal"],
    "aside": ["sidebar", "related", "widget", "popular", "trending", "recommended", "rail"], "ad": ["ad", "ads", "advert", "sponsored", "promo", "adsense"],
    "notice": ["cookie", "consent", "notice", "newsletter", "subscribe", "popup", "modal", "gdpr", "alert"], "form": ["search", "login", "signup", "form"],
    "comment": ["comment", "comments", "reply", "responses", "discussion"], "share": ["share", "social", "follow"], "main": ["content", "main", "post", "entry", "article", "story", "body", "text"],
}
_BESIDE = ["site", "page", "box", "list", "wrapper", "inner", "block", "area", "section", "container", "top", "left", "right", "items", "wrap", "row", "col", "js", "item", "panel", "global", "primary", "group"]
_ODD = ["no", "with", "has", "free", "science", "work", "less", "without", "non", "long", "special", "theory", "history", "money", "culture", "feature", "template", "single", "type"]


def _named(w: _Writer, part: str) -> str:
    """A name that holds a word of a page part: ``site-footer``, ``commentList``, ``sidebar__inner``, ``navlinks``."""
    word, other = w.r.choice(_PART_WORDS[part]), w.r.choice(_BESIDE)
    one, two = (word, other) if w.maybe(0.6) else (other, word)
    return w.pick(f"{one}-{two}", f"{one}_{two}", one + two.capitalize(), f"{one}__{two}", f"{one}-{two}-{w.r.randint(1, 9)}", one + two)


def _odd(w: _Writer) -> str:
    """A name that holds such a word by accident: ``popular-science``, ``no-subscribe``, ``ad-free``, ``with-sidebar``."""
    word, other = w.r.choice(_PART_WORDS[w.r.choice(list(_PART_WORDS))]), w.r.choice(_ODD)
    return w.pick(f"{word}-{other}", f"{other}-{word}", f"{other}{word.capitalize()}")


def _wrap(w: _Writer, part: str, tag: str = "") -> tuple[str, str]:
    """Opens and closes an element that is known by its name alone."""
    tag = tag or w.pick("div", "div", "div", "section", "ul" if part in ("nav", "share") else "div", "ol" if part == "comment" else "div")
    names = [_named(w, part), *([w.word()] if w.maybe(0.4) else []), *([_named(w, "main")] if part != "main" and w.maybe(0.08) else [])]
    w.r.shuffle(names)
    return f'<{tag} {w.pick("class", "class", "id")}="{" ".join(names)}">', f"</{tag}>"


def _menu(w: _Writer) -> None:
    start, end = _wrap(w, "nav") if w.maybe(0.4) else w.pick(("<nav>", "</nav>"), ('<div class="menu">', "</div>"), ('<div id="navbar">', "</div>"), ('<div role="navigation">', "</div>"), ("<div>", "</div>"), ('<nav class="breadcrumb">', "</nav>"))
    w.raw(start + "<ul>")
    for _ in range(w.r.randint(3, 9)):
        w.block("li", f'<a href="/x">{w.words(1, 2)}</a>', False)
    w.raw("</ul>" + end)


def _header(w: _Writer) -> None:
    start, end = _wrap(w, "header") if w.maybe(0.4) else w.pick(("<header>", "</header>"), ('<div class="header">', "</div>"), ('<div id="masthead">', "</div>"))
    w.raw(start)
    w.block(w.pick("div", "h1", "p", "h2"), w.pick(w.words(1, 3), f'<a href="/">{w.words(1, 3)}</a>'), False)
    if w.maybe(0.5):
        w.block("p", w.words(3, 8), False)
    if w.maybe(0.4):
        _menu(w)
    w.raw(end)


def _plain_block(w: _Writer, options: list[str], text: str) -> None:
    """One element that is itself the block."""
    w.block(w.pick("div", "div", "p", "aside"), text, False, w.r.choice(options))


def _ad(w: _Writer) -> None:
    if w.maybe(0.4):
        start, end = _wrap(w, "ad")
        w.raw(start)
        w.block(w.pick("p", "span", "div"), w.pick(w.sentences(1, 3), w.words(3, 10), f'<a href="/x">{w.words(2, 8)}</a>'), False)
        w.raw(end)
        return
    _plain_block(w, [' class="ad"', ' class="advert"', ' id="ad-top"', ' class="sponsored"', ' class="promo box"', ' class="ads"'], w.pick(w.sentences(1, 3), w.words(3, 10), f'<a href="/x">{w.words(2, 8)}</a>'))


def _notice(w: _Writer) -> None:
    if w.maybe(0.5):
        _plain_block(w, [' class="cookie-notice"', ' id="consent"', ' class="notice"', ' role="alert"', ' class="newsletter"', ' class="popup"'], w.sentences(1, 3))
    else:
        _boxed(w, "notice", ['<div class="cookie-banner">', '<div id="gdpr">', '<div class="modal">', '<div class="alert">', '<div class="subscribe">'], 1, 2, 0.1)


def _boxed(w: _Writer, part: str, starts: list[str], low: int, high: int, link: float) -> None:
    start = _wrap(w, part)[0] if w.maybe(0.4) else w.r.choice(starts)
    w.raw(start)
    for _ in range(w.r.randint(low, high)):
        text = w.pick(w.words(2, 6), w.sentences(1, 2), w.sentences(1, 4))
        w.block(w.pick("p", "div", "p", "h3"), f'<a href="/x">{text}</a>' if w.maybe(link) else text, False)
    w.raw("</" + start[1:].split(">")[0].split(" ")[0] + ">")


def _sidebar(w: _Writer) -> None:
    _boxed(w, "aside", ["<aside>", '<div class="sidebar">', '<aside class="related">', '<div id="sidebar">', '<div class="widget">', '<section class="related">'], 2, 6, 0.5)


def _form(w: _Writer) -> None:
    start, end = _wrap(w, "form") if w.maybe(0.25) else w.pick(("<form>", "</form>"), ('<form class="search">', "</form>"), ('<form id="login">', "</form>"))
    w.raw(start)
    w.block(w.pick("p", "div", "label"), w.words(1, 4), False) if w.maybe(0.4) else None
    w.raw('<input type="text">')
    w.block("button", w.words(1, 2), False)
    w.raw(end)


def _share(w: _Writer) -> None:
    start, end = _wrap(w, "share") if w.maybe(0.4) else w.pick(('<div class="share">', "</div>"), ('<ul class="social">', "</ul>"))
    w.raw(start)
    for _ in range(w.r.randint(2, 4)):
        w.block("li", f'<a href="/x">{w.word()}</a>', False)
    w.raw(end)


def _comments(w: _Writer) -> None:
    start, end = _wrap(w, "comment") if w.maybe(0.5) else w.pick(('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<div id="disqus">', "</div>"), ('<ol class="comment-list">', "</ol>"), ('<section id="responses">', "</section>"))
    w.raw(start)
    w.block("h3", w.words(1, 3), False) if w.maybe(0.6) else None
    for _ in range(w.r.randint(1, 5)):
        one, done = _wrap(w, "comment") if w.maybe(0.2) else w.pick(('<div class="comment">', "</div>"), ("<div>", "</div>"), ("<article>", "</article>"), ('<li class="reply">', "</li>"), ("<li>", "</li>"), ("<li>", "</li>"))
        w.raw(one)
        w.block("p", w.sentences(1, 4), False)
        w.raw(done)
    w.raw(end)


def _article(w: _Writer) -> None:
    start, end = w.pick(("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main">', "</div>"),
                        ('<div class="post-body">', "</div>"), ('<section class="entry">', "</section>"), ("<div>", "</div>"), ('<div class="story">', "</div>"), ('<div role="main">', "</div>"))
    if w.maybe(0.35):
        start, end = _wrap(w, "main")
    if w.maybe(0.3):  # names that only look like another part, on the article or around it
        odd, close = f'<div class="{" ".join([_odd(w), *([w.word()] if w.maybe(0.5) else []), *([_odd(w)] if w.maybe(0.3) else [])])}">', "</div>"
        start, end = (odd + start, end + close) if w.maybe(0.5) else (odd, close) if w.maybe(0.5) else (start + odd, close + end)
    w.raw(start)
    short = w.maybe(0.15)  # a page may hold a few words only
    if w.maybe(0.3 if short else 0.8):
        w.block("h1", w.pick(w.words(2, 12), w.sentences(1, 3)), True)
    for _ in range(w.r.randint(1, 2) if short else w.r.randint(1, 14)):
        kind = 0.0 if short else w.r.random()
        if kind < 0.62:
            text = w.sentences(1, 2) if short else w.pick(w.sentences(1, 2), w.sentences(2, 9), w.sentences(3, 9), w.words(1, 3) + ".", f"<b>{w.words(1, 4)}</b> {w.sentences(1, 4)}", f'{w.sentences(1, 3)} <a href="/x">{w.words(1, 4)}</a> {w.sentences(1, 2)}', " | ".join(w.word() for _ in range(12)))
            w.block("p", text, True)
        elif kind < 0.72:
            w.block(w.pick("h2", "h3"), w.words(1, 8), True)
        elif kind < 0.80:
            w.raw("<ul>")
            for _ in range(w.r.randint(2, 5)):
                w.block("li", w.pick(w.words(1, 9), w.sentences(1, 2)), True)
            w.raw("</ul>")
        elif kind < 0.85:
            w.raw("<blockquote>")
            w.block("p", w.sentences(1, 4), True)
            w.raw("</blockquote>")
        elif kind < 0.88:
            w.raw("<table><tr>")
            for _ in range(w.r.randint(2, 4)):
                w.block("td", w.words(1, 5), True)
            w.raw("</tr></table>")
        elif kind < 0.90:
            w.block("pre", w.words(3, 20), True)
        elif kind < 0.91:
            w.block("div", w.sentences(1, 5), True)
        elif kind < 0.95:
            w.raw(f'<section id="{_odd(w)}">')
            w.block("h2", w.words(1, 4), True)
            for _ in range(w.r.randint(1, 3)):
                w.block("p", w.sentences(2, 6), True)
            w.raw("</section>")
        elif kind < 0.965:
            _ad(w)
        elif kind < 0.98:
            _sidebar(w)
        else:
            w.pick(_share, _notice, _form)(w)
    if w.maybe(0.15):
        _comments(w)
    w.raw(end)


def _footer(w: _Writer) -> None:
    if w.maybe(0.15):  # without any name
        w.block(w.pick("p", "div", "small"), w.pick(f"&copy; {w.r.randint(1990, 2030)} {w.words(1, 3)}.", f"Copyright {w.words(1, 3)}. All rights reserved.", f"(c) {w.r.randint(1990, 2030)} {w.words(1, 3)}"), False)
        return
    start, end = _wrap(w, "footer") if w.maybe(0.4) else w.pick(("<footer>", "</footer>"), ('<div class="footer">', "</div>"), ('<div id="footer">', "</div>"))
    if w.maybe(0.5):
        w.raw(start + f"&copy; {w.word()}.example &middot; {w.sentences(1, 3)}" + end)
        w.labels.append(0)
        return
    w.raw(start)
    for _ in range(w.r.randint(1, 4)):
        w.block("p", w.pick("&copy; " + w.words(1, 5), f'<a href="/x">{w.words(1, 3)}</a>', w.sentences(1, 2)), False)
    w.raw(end)


def labelled_pages(n: int, seed: int = 3) -> list[tuple[str, list[int]]]:
    """``n`` pages with the label of each block."""
    out = []
    for i in range(n):
        w = _Writer(seed * 1_000_003 + i)
        w.raw("<!DOCTYPE html><html><head><title>x</title></head><body>")
        few = w.pick(1.0, 1.0, 0.3)  # some pages are little more than their article
        for part, share in ((_notice, 0.25), (_header, 0.5), (_menu, 0.7), (_ad, 0.4), (_form, 0.2), (_sidebar, 0.2)):
            if w.maybe(few * share):
                part(w)
        _article(w)
        for part, share in ((_share, 0.2), (_ad, 0.2), (_sidebar, 0.3), (_comments, 0.4), (_form, 0.2), (_footer, 0.8), (_notice, 0.15)):
            if w.maybe(few * share):
                part(w)
        w.raw("</body></html>" if w.maybe(0.9) else "")
        out.append(("".join(w.out), w.labels))
    return out
