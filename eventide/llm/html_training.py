"""Labelled pages the block model is trained on.

Pages are put together from seeded choices of layout, wrapper, class name and
block type, with made-up words, so that labels come with the page: every block
is article text (1) or not (0). They vary what real pages vary: containers
with and without ``article`` or ``main``, unclosed paragraphs, adverts and
forms inside the article, comments below it, menus as lists or link rows.
"""

from __future__ import annotations

import random

PAGES, SEED = 240, 11
# Wrappers of article text and of the rest of a page.
CONTAINERS = ('<article>', '<article class="post">', '<main>', '<main><article>', '<div class="article-body">',
              '<div id="content">', '<section class="entry-content">', '<div class="story">', '<div>',
              '<div class="post-text">', '<table><tr><td class="content">', '<div itemprop="articleBody">')
ABOVE = ('<header class="site-header">', '<header>', '<nav>', '<nav class="menu">', '<div class="nav">',
         '<div id="menu">', '<div class="topbar">', '<div class="breadcrumbs">', '<ul class="navigation">')
BETWEEN = ('<div class="ad">', '<div class="advert">', '<div class="banner">', '<aside class="promo">',
           '<div class="sponsored">', '<div class="cookie-notice">', '<div class="notice">', '<div id="consent">',
           '<div class="alert">', '<form class="search">', '<form>', '<div class="newsletter">', '<div class="share">',
           '<div class="popup">', '<div role="dialog">', '<div class="subscribe">')
BESIDE = ('<aside>', '<aside class="sidebar">', '<div class="sidebar">', '<div class="widget">', '<div id="side">',
          '<div class="related">', '<section class="recommended">')
COMMENTS = ('<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<ol class="commentlist">',
            '<div class="replies">', '<section id="discussion">')
BELOW = ('<footer>', '<footer class="site-footer">', '<div class="footer">', '<div id="footer">', '<div class="copyright">')
SYLLABLES = "an be ca do er fi go ha in ju ka lo mi no or pa que ra st ti un ve wi ré ß ñ üb ção".split()


class _Maker:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.label: dict[str, int] = {}

    def words(self, low: int, high: int, dot: bool) -> str:
        n = self.rng.randint(low, high)
        out = ["".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 4))) for _ in range(n)]
        for i in range(6, n - 1, 9):
            out[i] += self.rng.choice(",.")
        text = " ".join(out).capitalize() + ("." if dot else "")
        return text

    def block(self, text: str, label: int) -> str:
        if text in self.label:
            text += " " + "".join(self.rng.choices(SYLLABLES, k=5))
        self.label[text] = label
        return text

    def close(self, opening: str) -> str:
        return "".join(f"</{part.split()[0].rstrip('>')}>" for part in reversed(opening.split("<")[1:]))

    def links(self) -> str:
        rng = self.rng
        items = [f'<a href="/{i}">{self.block(self.words(1, 3, False), 0)}</a>' for i in range(rng.randint(2, 7))]
        if rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return "".join(f"<div>{i}</div>" for i in items)

    def other(self, opening: str) -> str:
        rng = self.rng
        kind = rng.random()
        if kind < 0.35:
            inner = self.links()
        elif kind < 0.7:
            inner = self.block(self.words(3, 30, rng.random() < 0.7), 0)
        else:
            inner = "".join(f"<p>{self.block(self.words(2, 25, rng.random() < 0.6), 0)}</p>"
                            for _ in range(rng.randint(1, 3)))
        if opening.startswith("<form"):
            inner += '<label>' + self.block(self.words(1, 3, False), 0) + '</label><input name="q"><button>' \
                + self.block(self.words(1, 2, False), 0) + "</button>"
        return opening + inner + self.close(opening)

    def comments(self) -> str:
        rng = self.rng
        opening = rng.choice(COMMENTS)
        tag = "li" if opening.startswith("<ol") else "div"
        out = [f"<h3>{self.block(self.words(1, 3, False), 0)}</h3>"] if tag == "div" else []
        for _ in range(rng.randint(1, 5)):
            out.append(f'<{tag} class="comment"><p>{self.block(self.words(4, 40, True), 0)}</p></{tag}>')
        return opening + "".join(out) + self.close(opening)

    def article(self) -> str:
        rng = self.rng
        opening = rng.choice(CONTAINERS)
        out = []
        if rng.random() < 0.85:
            out.append(f"<h1>{self.block(self.words(1, 10, rng.random() < 0.4), 1)}</h1>")
        unclosed = rng.random() < 0.3
        for i in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.72:
                text = self.block(self.words(1, 70, rng.random() < 0.95), 1)
                out.append(f"<p><b>{text}<br>" if unclosed and rng.random() < 0.4 else f"<p>{text}</p>")
            elif kind < 0.8:
                out.append(f"<h2>{self.block(self.words(1, 8, rng.random() < 0.3), 1)}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.block(self.words(2, 15, rng.random() < 0.5), 1)}</li>"
                                            for _ in range(rng.randint(2, 4))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote>{self.block(self.words(5, 30, True), 1)}</blockquote>")
            elif kind < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.block(self.words(1, 6, False), 1)}</td></tr>"
                                               for _ in range(2)) + "</table>")
            elif i:
                out.append(self.other(rng.choice(BETWEEN + BESIDE)))
        if rng.random() < 0.25:
            out.append(self.comments())
        return opening + "".join(out) + self.close(opening)

    def page(self) -> str:
        rng = self.rng
        out = [self.other(o) if rng.random() < 0.4 else o + self.links() + self.close(o)
               for o in rng.sample(ABOVE, rng.randint(0, 2))]
        out += [self.other(o) for o in rng.sample(BETWEEN, rng.randint(0, 2))]
        side = [self.other(o) for o in rng.sample(BESIDE, rng.randint(0, 2))]
        out += side[:1] if rng.random() < 0.5 else []
        out.append(self.article())
        out += [self.other(o) for o in rng.sample(BETWEEN, rng.randint(0, 1))]
        out += [self.comments()] if rng.random() < 0.4 else []
        out += side[1:]
        foot = rng.choice(BELOW)
        if rng.random() < 0.9:
            out.append(foot + self.block("© " + self.words(1, 12, rng.random() < 0.6), 0) + self.close(foot))
        return "<html><head><title>x</title></head><body>" + "".join(out) + "</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> list[tuple[str, dict[str, int]]]:
    """(html, label of each block text)."""
    rng = random.Random(seed)
    out = []
    for _ in range(pages):
        m = _Maker(rng)
        out.append((m.page(), m.label))
    return out
