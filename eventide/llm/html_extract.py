"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: runs of text without a block-level tag between
them, in page order. Each block has features from its ancestors (tags, and
words of their class, id and role) and from its text (length, links, sentence
end, copyright signs). The field has two labels, article or not, with weights
for features and for neighbouring labels; it is trained by conditional maximum
likelihood (forward-backward, Adagrad) on the labelled pages of
``html_training`` and decodes by Viterbi. Pages are independent: one pass, no
shuffle, a page at a time in memory.

Defined results: null and empty html give an empty text; scripts, styles,
comments, forms' fields and other hidden content are no blocks; character
references are decoded once, white space in a block becomes one space, blocks
are joined by an empty line; repeated rows give repeated results; unclosed and
stray tags are taken as a browser would for block structure: a tag or comment
that never ends takes the rest of the page, and so does a script or style
without an end tag; other hidden content without an end tag is read as text.
The time is linear in the page, whatever it holds.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventide.llm.html_training import labelled_pages

# Tags that end a run of text, and words of class and id names.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu
nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAME_GROUPS = {
    "menu": "nav menu navigation breadcrumb breadcrumbs topbar navbar toolbar tabs pagination pager skip",
    "head": "header masthead logo brand hero",
    "foot": "footer copyright legal imprint colophon bottom",
    "side": "sidebar side widget aside rail related recommended recommend more trending popular",
    "ad": "ad ads advert adverts advertisement banner promo sponsor sponsored adsense promotion teaser",
    "notice": "cookie cookies consent notice gdpr popup modal overlay dialog alert privacy warning",
    "form": "form search login signup subscribe newsletter register contact field input",
    "comment": "comment comments commentlist reply replies disqus discussion respond responses reviews review feedback",
    "share": "share social sharing follow tags tag byline author meta",
    "text": "article content post entry story text body main articlebody page",
}
_GROUP = {w: g for g, ws in NAME_GROUPS.items() for w in ws.split()}
_SPACE = r"[\t\n\f\r ]"
_ATTRS = (rf"(?:(?:{_SPACE}|/)++"
          rf"|[^\t\n\f\r />][^\t\n\f\r />=]*+"
          rf"(?:{_SPACE}*+={_SPACE}*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\t\n\f\r >\"'][^\t\n\f\r >]*+)?+)?+)*+")
# A mark that starts at a "<"; it always ends at the place given or at the end of
# the page, so no character is read again for a later mark.
_MARK = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\t\n\f\r />]*+)(?P<attrs>{_ATTRS})(?:>|\Z)", re.S)
CODE = frozenset(("script", "style"))  # without an end tag they hold the rest of the page
HIDDEN = frozenset("noscript template textarea title iframe svg select object canvas".split())
_CLOSE = {t: re.compile(rf"</{t}(?=[\t\n\f\r />])[^>]*+(?:>|\Z)", re.I) for t in CODE | HIDDEN}
# Numeric references: zeros in front say nothing, nine further digits are no character.
_ZEROS, _NO_CHARACTER = re.compile(r"&#0{2,}"), re.compile(r"&#0?[1-9][0-9]{8,};?")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+")
EPOCHS, RATE, RIDGE = 12, 0.3, 1e-3


def _read_names(attrs: str) -> tuple[str, ...]:
    words = {w.lower() for m in _NAMES.finditer(attrs) for w in _PART.findall(m.group(1))}
    return tuple(sorted({_GROUP[w] for w in words if w in _GROUP}))


@functools.lru_cache(50_000)
def _kept_names(attrs: str) -> tuple[str, ...]:
    return _read_names(attrs)


def _names(attrs: str) -> tuple[str, ...]:
    if not attrs:
        return ()
    return _kept_names(attrs) if len(attrs) <= 1000 else _read_names(attrs)  # the cache has a bound in bytes


class Place(NamedTuple):
    """What a block's features need of its ancestors, whatever their number."""
    leaf: str = "none"
    near: str = "none"  # the name group nearest to the block
    tags: frozenset[str] = frozenset()
    groups: frozenset[str] = frozenset()

    def inside(self, tag: str, groups: tuple[str, ...]) -> Place:
        return Place(tag, groups[0] if groups else self.near, self.tags if tag in self.tags else self.tags | {tag},
                     self.groups if self.groups.issuperset(groups) else self.groups.union(groups))


def _decoded(raw: str) -> str:
    if "&" not in raw:
        return raw
    if "&#" in raw:
        raw = _NO_CHARACTER.sub("\ufffd", _ZEROS.sub("&#0", raw))
    return html.unescape(raw)


def leaf_blocks(page: str) -> list[tuple[str, Place, int]]:
    """(text, place among the ancestors, linked chars), in time linear in the page."""
    out, buffer = [], []
    stack, held = [("none", Place())], Counter()  # open tags, and how many of each
    linked, in_link = 0, False

    def flush():
        nonlocal linked, in_link
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append((text, stack[-1][1], linked))
            buffer.clear()
        linked, in_link = 0, False

    def add(raw):
        nonlocal linked
        if raw:
            text = _decoded(raw)
            buffer.append(text)
            if in_link:
                linked += len(text)

    def leave():
        held[stack.pop()[0]] -= 1

    closes = {}  # hidden tag -> (start, end) of its next end tag, None: no more of them

    def close_after(tag, at):
        if tag not in closes or (closes[tag] and closes[tag][0] < at):
            m = _CLOSE[tag].search(page, at)
            closes[tag] = m and m.span()
        return closes[tag]

    at = look = 0
    while (look := page.find("<", look)) >= 0:
        m = _MARK.match(page, look)
        if m is None:  # a sign in the text
            look += 1
            continue
        add(page[at:look])
        at = look = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag, end, attrs = tag.lower(), m.group("end"), m.group("attrs")
        if tag in _CLOSE and not end and not (tag == "svg" and attrs.endswith("/")):
            close = close_after(tag, at)
            if close or tag in CODE:
                at = look = close[1] if close else len(page)
                continue
        if tag == "br":
            buffer.append(" ")
        elif tag == "a":
            in_link = not end
        elif tag in BLOCK_TAGS:
            flush()
            if end:
                if held[tag]:
                    while stack[-1][0] != tag:
                        leave()
                    leave()
            else:
                if stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    leave()  # these never hold blocks
                if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    family = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
                              "option": ("option",)}.get(tag, ("dt", "dd"))
                    while stack[-1][0] in family:
                        leave()
                if tag not in VOID:
                    stack.append((tag, stack[-1][1].inside(tag, _names(attrs))))
                    held[tag] += 1
    add(page[at:])
    flush()
    return out


@functools.lru_cache(50_000)
def _ancestor_features(place: Place) -> tuple[str, ...]:
    tags, near = place.tags - {"html", "body"}, place.near
    held = "article" in tags or "main" in tags or "text" in place.groups
    return (f"leaf={place.leaf}", f"near={near}", *sorted(f"in={t}" for t in tags),
            *sorted(f"name={g}" for g in place.groups), f"held={held}", f"held={held}&near={near}")


def features(blocks) -> Iterator[list[str]]:
    for i, (text, place, linked) in enumerate(blocks):
        words = text.count(" ") + 1
        size = "1" if words < 2 else "3" if words < 4 else "10" if words < 11 else "25" if words < 26 else "more"
        links = "all" if linked >= 0.8 * len(text) else "some" if linked else "none"
        f = ["bias", f"words={size}", f"links={links}", f"stop={text[-1] in '.!?…»”\"'}", *_ancestor_features(place)]
        f.append(f"leaf&words={place.leaf}&{size}")
        if "©" in text[:40] or "copyright" in text[:60].lower():
            f.append("copyright")
        if i == 0:
            f.append("first")
        if i == len(blocks) - 1:
            f.append("last")
        yield f


class Field:
    """Weights of the linear-chain field: per feature and label, per pair of
    neighbouring labels."""

    def __init__(self, names: list[str]):
        self.index = {n: i for i, n in enumerate(names)}
        self.unary = np.zeros((len(names), 2))
        self.pair = np.zeros((2, 2))

    def scores(self, feats: Iterable[list[int]]) -> np.ndarray:
        return np.array([self.unary[f].sum(axis=0) for f in feats]).reshape(-1, 2)

    def ids(self, feats: Iterable[list[str]]) -> Iterator[list[int]]:
        return ([self.index[n] for n in f if n in self.index] for f in feats)

    def marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(s)
        fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
        fwd[0] = s[0]
        for i in range(1, n):
            fwd[i] = s[i] + np.logaddexp(fwd[i - 1, 0] + self.pair[0], fwd[i - 1, 1] + self.pair[1])
        for i in range(n - 2, -1, -1):
            t = s[i + 1] + bwd[i + 1]
            bwd[i] = np.logaddexp(self.pair[:, 0] + t[0], self.pair[:, 1] + t[1])
        log_z = np.logaddexp(*fwd[-1])
        one = np.exp(fwd + bwd - log_z)
        two = np.exp(fwd[:-1, :, None] + self.pair + (s[1:] + bwd[1:])[:, None, :] - log_z).sum(axis=0)
        return one, two

    def decode(self, s: np.ndarray) -> list[int]:
        """Viterbi: the likeliest labels of the whole chain."""
        if not len(s):
            return []
        (a, b), back = s[0].tolist(), []
        (p00, p01), (p10, p11) = self.pair.tolist()
        for u, v in s[1:].tolist():
            from_a, from_b = (a + p00, b + p10), (a + p01, b + p11)
            back.append((int(from_a[1] > from_a[0]), int(from_b[1] > from_b[0])))
            a, b = max(from_a) + u, max(from_b) + v
        out = [int(b > a)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def fit(pages: list[tuple[str, dict[str, int]]], epochs: int = EPOCHS) -> Field:
    data = []
    for page, label in pages:
        blocks = leaf_blocks(page)
        data.append((list(features(blocks)), np.array([label[t] for t, _, _ in blocks])))
    field = Field(sorted({n for f, _ in data for names in f for n in names}))
    data = [(list(field.ids(f)), y) for f, y in data if len(y)]
    seen_u, seen_p = np.full_like(field.unary, 1e-6), np.full_like(field.pair, 1e-6)
    for _ in range(epochs):
        for ids, y in data:
            one, two = field.marginals(field.scores(ids))
            grad = np.zeros_like(field.unary)
            delta = np.eye(2)[y] - one
            for f, d in zip(ids, delta, strict=True):
                grad[f] += d
            grad -= RIDGE * field.unary
            pair = -two - RIDGE * field.pair
            np.add.at(pair, (y[:-1], y[1:]), 1)
            seen_u += grad ** 2
            seen_p += pair ** 2
            field.unary += RATE * grad / np.sqrt(seen_u)
            field.pair += RATE * pair / np.sqrt(seen_p)
    return field


@functools.lru_cache(1)
def trained() -> Field:
    return fit(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page or "")
    if not blocks:
        return ""
    labels = field.decode(field.scores(field.ids(features(blocks))))
    return "\n\n".join(b[0] for b, y in zip(blocks, labels, strict=True) if y)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page row."""
    field = trained()
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches):
        for b in batches:
            text = [main_text(h, field) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
